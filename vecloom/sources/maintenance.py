"""Keep stored embeddings in step with the rows they describe.

Rows that need no new vector pass their text as NULL to the encoder, so one
narrow pass over the table encodes exactly the rows that need it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.encoders import HASHING, EncoderSpec, embed_encode, embed_query
from vecloom.sources.scratch import small_copy


def _column(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def encode_documents(df: DataFrame, text, spec: EncoderSpec = HASHING, vec_col: str = "embedding") -> DataFrame:
    """Set the document vector of every row, with its model and dimension."""
    return df.withColumns({vec_col: embed_encode(text, spec), "model": F.lit(spec.name), "dim": F.lit(spec.dim)})


def encode_queries(df: DataFrame, text, spec: EncoderSpec = HASHING, vec_col: str = "embedding") -> DataFrame:
    """Set the query vector of every row, with its model and dimension."""
    return df.withColumns({vec_col: embed_query(text, spec), "model": F.lit(spec.name), "dim": F.lit(spec.dim)})


def _encode_where(df: DataFrame, condition: Column, text, spec: EncoderSpec, vec_col: str) -> DataFrame:
    flagged = df.withColumn("_stale", condition)
    fresh = embed_encode(F.when(F.col("_stale"), _column(text)), spec)
    stamped = {"model": F.lit(spec.name), "dim": F.lit(spec.dim)}
    columns = {vec_col: F.when(F.col("_stale"), fresh).otherwise(F.col(vec_col))}
    for name, value in stamped.items():
        if name in df.columns:
            columns[name] = F.when(F.col("_stale"), value).otherwise(F.col(name))
    return flagged.withColumns(columns).drop("_stale")


def backfill_missing(df: DataFrame, text, spec: EncoderSpec = HASHING, vec_col: str = "embedding") -> DataFrame:
    """Encode the rows without a vector; keep all others as they are."""
    return _encode_where(df, F.col(vec_col).isNull(), text, spec, vec_col)


def reembed_stale(df: DataFrame, text, spec: EncoderSpec, vec_col: str = "embedding") -> DataFrame:
    """Encode again where model or dimension differ from ``spec``, or are missing."""
    stale = (
        ~F.col("model").eqNullSafe(F.lit(spec.name))
        | ~F.col("dim").eqNullSafe(F.lit(spec.dim))
        | F.col(vec_col).isNull()
    )
    return _encode_where(df, stale, text, spec, vec_col)


def append_ignore_conflicts(new: DataFrame, existing: DataFrame, keys: Sequence[str], first_by=None) -> DataFrame:
    """Rows of ``new`` whose key is neither in ``existing`` nor seen before.

    Of several new rows with one key the lowest by ``first_by`` stays (any one
    where it is not given).  A key with a NULL conflicts with nothing: such rows
    all stay.  Only keys of the existing table are read: those of a few new rows
    are looked up in place, without a shuffle of the table; else they are made
    distinct inside each task before they move, so a key that fills the table
    crosses the shuffle once per task.
    """
    keys = list(keys)
    keyed = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
    free, new = new.where(~keyed), new.where(keyed)
    known = existing.select(*keys).where(keyed)
    few = small_copy(new.select(*keys))
    if few is not None:
        known = known.join(few, keys, "left_semi")
    if first_by is None:
        candidates = new.dropDuplicates(keys)
    else:
        first = F.min_by(F.struct(*[F.col(c) for c in new.columns]), first_by).alias("_row")
        candidates = new.groupBy(*keys).agg(first).select("_row.*")
    return candidates.join(known.distinct(), keys, "left_anti").select(*new.columns).unionByName(free)


def latest_changes(changes: DataFrame, key: str, order_by) -> DataFrame:
    """The last row per key, reduced inside each task before the shuffle."""
    last = F.max_by(F.struct(*[F.col(c) for c in changes.columns]), order_by).alias("_row")
    return changes.groupBy(key).agg(last).select("_row.*")


def upsert_embeddings(existing: DataFrame, changes: DataFrame, key: str, watched: Sequence[str], text,
                      spec: EncoderSpec = HASHING, mode: str = "on_change", vec_col: str = "embedding") -> DataFrame:
    """Insert or update rows by key and keep their vectors in step.

    ``on_change`` encodes new rows and rows whose watched columns differ
    (NULL-safe).  ``if_null`` encodes new rows that bring no vector and leaves
    updated rows with the vector they have or bring.  Columns that the changes
    do not carry keep their values; a watched one among them is unchanged.

    Both tables have one row per key (see :func:`latest_changes`).  Where the
    changed keys are few they go to the table, which is not shuffled; else one
    outer join moves it once.
    """
    if mode not in ("on_change", "if_null"):
        raise ValueError("mode must be 'on_change' or 'if_null'")
    own = [c for c in existing.columns if c != key]
    old = existing.select(key, *[F.col(c).alias(f"_old_{c}") for c in own], F.lit(True).alias("_known"))
    changes = changes.withColumn("_changed", F.lit(True))
    few = small_copy(changes.select(key))
    if few is not None:
        untouched = existing.join(few, key, "left_anti").select(*existing.columns)
        merged = changes.join(old.join(few, key, "left_semi"), key, "left")
    else:
        untouched, merged = None, old.join(changes, key, "full_outer")
    stamps = ("model", "dim")
    carried = [c for c in changes.columns if c not in (key, "_changed")]
    # What the change does not carry is what the row had, also for the text to encode.
    absent = {c: F.col(f"_old_{c}") for c in own if c not in carried and c not in (vec_col, *stamps)}
    merged = merged.withColumns(absent | {"_new": F.col("_known").isNull(), "_changed": F.coalesce("_changed", F.lit(False))})
    brought = F.col(vec_col) if vec_col in carried else F.lit(None).cast("array<float>")
    if mode == "on_change":
        differs = [~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in watched if c in carried]
        encode = reduce(lambda a, b: a | b, differs, F.col("_new"))
        kept, supplied = F.col(f"_old_{vec_col}"), F.lit(False)
    else:
        encode = F.col("_new") & brought.isNull()
        kept, supplied = F.coalesce(brought, F.col(f"_old_{vec_col}")), brought.isNotNull()
    merged = merged.withColumns({"_encode": F.col("_changed") & encode, "_supplied": supplied})
    merged = merged.withColumn("_fresh", embed_encode(F.when(F.col("_encode"), _column(text)), spec))
    columns = []
    for c in existing.columns:
        if c == key:
            columns.append(F.col(key))
            continue
        before = F.col(f"_old_{c}")
        if c == vec_col:
            value = F.when(F.col("_encode"), F.col("_fresh")).otherwise(kept)
        elif c in stamps:
            stamp = F.lit(spec.name if c == "model" else spec.dim)
            named = F.coalesce(F.col(c), before) if c in carried else before
            value = F.when(F.col("_encode"), stamp).when(F.col("_supplied"), named).otherwise(before)
        else:
            value = F.col(c)
        columns.append(F.when(F.col("_changed"), value).otherwise(before).alias(c))
    merged = merged.select(*columns)
    return merged if untouched is None else untouched.unionByName(merged)
