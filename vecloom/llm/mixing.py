"""Mixing sources to target weights by Poisson replication.

Every source gets a mean repetition rate (target weight x wanted rows / its rows);
every document gets a Poisson number of copies with that mean, found by inverting
the distribution at a uniform number hashed from the seed and ``doc_id``.  Copies
are exploded and spread over a global random order, again hashed, so reruns and
retried tasks give the same rows.

One row per source holds its rate and its cumulative distribution; documents read
it through a join, without a shuffle while that table is measured small.  Nothing is grouped by source beyond two counters, so a source
that holds a third of all rows only costs its rows.

Defined results: a null source is a source of its own.  Rows that repeat an id get
the same number of copies each; a document with a null id draws its number by its
text (null: empty).  A source whose weight is missing or not positive gets no rows.  Columns of the input named like
the results are replaced.  An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import fresh_name, without
from vecloom.sources.scratch import materialize, small_copy

SEED, TEMPERATURE, EPOCHS = 17, 0.5, 1.0
_DIGITS = 13  # hexadecimal digits of a digest that make a uniform number: 52 bits


def uniform(*parts: Column | str) -> Column:
    """A number in (0, 1) from the digest of the parts."""
    digest = F.substring(F.md5(F.concat_ws("|", *parts)), 1, _DIGITS)
    return (F.conv(digest, 16, 10).cast("double") + 0.5) / F.lit(float(16**_DIGITS))


def poisson_cdf(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... until what is left is below the uniform number's resolution.

    Terms are summed as logarithms, so that large rates do not underflow.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct((-rate).alias("log"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("cdf"))

    def step(state: Column, k: Column) -> Column:
        log = F.when(k == 0, state["log"]).otherwise(state["log"] + F.log(rate) - F.log(k.cast("double")))
        total = state["sum"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("sum"), F.concat(state["cdf"], F.array(total)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(0), last), start, step, lambda s: s["cdf"])


def source_rates(
    docs: DataFrame, *, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE,
    epochs: float = EPOCHS, source: str = "source",
) -> DataFrame:
    """Per source: its rows, target weight and mean number of copies.

    Without ``weights`` a source's weight is its row count to the power
    ``temperature``.  The wanted number of rows is ``epochs`` times all rows.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n_rows"))
    if weights is None:
        weight = F.pow(F.col("n_rows").cast("double"), F.lit(float(temperature)))
        counts = counts.withColumn("raw_weight", weight)
    else:
        rows = [(s, float(w)) for s, w in weights.items()]
        given = docs.sparkSession.createDataFrame(rows, "given string, raw_weight double")
        counts = counts.join(given, F.col("source").eqNullSafe(F.col("given")), "left").drop("given")
    counts = counts.withColumn("raw_weight", F.greatest(F.coalesce("raw_weight", F.lit(0.0)), F.lit(0.0)))
    totals = counts.agg(F.sum("raw_weight").alias("all_weight"), F.sum("n_rows").alias("all_rows"))  # one row
    rate = F.col("weight") * F.col("all_rows") * F.lit(float(epochs)) / F.col("n_rows")
    return (
        counts.join(F.broadcast(totals))
        .withColumn("weight", F.when(F.col("all_weight") > 0, F.col("raw_weight") / F.col("all_weight")).otherwise(0.0))
        .select("source", "n_rows", "weight", rate.alias("rate"))
    )


def mix_sources(
    docs: DataFrame, *, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE,
    epochs: float = EPOCHS, seed: int = SEED, doc_id: str = "doc_id", source: str = "source", text: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """Replicated documents in global random order, with ``copy`` (from 1) and ``n_copies``."""
    rates = source_rates(docs, weights=weights, temperature=temperature, epochs=epochs, source=source)
    own = without(docs, "copy", "n_copies")
    drawn, origin, chances, place = (fresh_name(own, n) for n in ("__u", "__source", "__cdf", "__order"))
    table = rates.where("rate > 0").select(F.col("source").alias(origin), poisson_cdf(F.col("rate")).alias(chances))
    table = materialize(table, "source-rates")
    table = small_copy(table) or table  # one row per source: sent to the tasks if measured small, else joined
    identity = F.coalesce(own[doc_id].cast("string"), F.md5(F.coalesce(own[text], F.lit(""))))
    keyed = own.withColumn(drawn, uniform(F.lit(str(seed)), identity))
    counted = keyed.join(table, F.col(f"`{source}`").eqNullSafe(F.col(origin)), "inner").withColumn(
        "n_copies", F.size(F.filter(chances, lambda c: c < F.col(drawn)))
    )
    copies = counted.where("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    order = uniform(F.lit(str(seed)), F.lit("order"), identity, F.col("copy").cast("string"))
    copies = copies.drop(origin, chances, drawn).withColumn(place, order)
    # The hashed key deals rows over partitions at random and orders them inside: a global shuffle without the
    # second read of all texts that sampling range bounds would take.
    dealt = copies.repartition(partitions, place) if partitions else copies.repartition(F.col(place))
    return dealt.sortWithinPartitions(place).drop(place)
