"""Which documents contain a passage, word for word."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.encoders import words
from vecloom.sources.scratch import materialize

_ANCHOR_WORDS = 6


def _normal(text: str) -> Column:
    return F.concat(F.lit(" "), F.array_join(words(text), " "), F.lit(" "))


def _hashes(tokens) -> Column:
    return F.transform(tokens if isinstance(tokens, Column) else F.col(tokens), lambda t: F.xxhash64(t))


def _window(hashes: Column, start: Column, n: int) -> Column:
    return F.xxhash64(F.lit(n), *[F.get(hashes, start + j) for j in range(n)])


def _windows(hashes: Column, lengths: list[int]) -> Column:
    """Hash of every run of so many words, the length hashed with it; none where the text is shorter."""
    none = F.array().cast("array<bigint>")

    def runs(h: Column, n: int) -> Column:
        starts = F.when(F.size(h) >= n, F.sequence(F.lit(0), F.size(h) - n))
        return F.coalesce(F.transform(starts, lambda i: _window(h, i, n)), none)

    def over(h: Column) -> Column:
        return F.concat(*[runs(h, n) for n in lengths])

    # Binding the hashes as a lambda variable computes them once per text, not
    # once per window.
    return F.get(F.transform(F.array(hashes), over), F.lit(0))


def passage_documents(passages: DataFrame, documents: DataFrame, passage_id: str, doc_id: str,
                      text_col: str = "text") -> DataFrame:
    """Pairs (passage, document) where the passage's words run inside the document.

    Comparing every passage with every document would be a cross join, so they
    meet on the hash of the passage's first words: one narrow row per distinct
    word window of a document.  Only pairs that share an anchor are verified,
    on the whole texts.
    """
    p = passages.select(F.col(passage_id).alias("p"), words(text_col).alias("w")).filter(F.size("w") > 0)
    p = p.withColumn("n", F.least(F.size("w"), F.lit(_ANCHOR_WORDS)))
    # At most one value per anchor length up to the constant above.
    lengths = sorted(r["n"] for r in p.select("n").distinct().collect())
    if not lengths:
        return p.select("p", F.lit(None).cast(documents.schema[doc_id].dataType).alias("d")).limit(0)
    firsts = [p.filter(F.col("n") == n).select("p", _window(_hashes("w"), F.lit(0), n).alias("anchor")) for n in lengths]
    anchors = reduce(DataFrame.unionByName, firsts)
    runs = F.array_distinct(_windows(_hashes(words(text_col)), lengths))  # all lengths in one pass over the documents
    found = documents.select(F.col(doc_id).alias("d"), F.explode(runs).alias("anchor"))
    pairs = found.join(anchors, "anchor").select("p", "d").distinct()
    # Few pairs share an anchor; with their size known, the texts need not move.
    pairs = materialize(pairs, "passage_pairs")
    # Texts are normalised after the join, so only those of matching pairs are.
    whole_p = passages.select(F.col(passage_id).alias("p"), F.col(text_col).alias("p_text"))
    whole_d = documents.select(F.col(doc_id).alias("d"), F.col(text_col).alias("d_text"))
    verified = pairs.join(whole_p, "p").join(whole_d, "d").filter(F.contains(_normal("d_text"), _normal("p_text")))
    return verified.select("p", "d")


def expected_documents(passages: DataFrame, documents: DataFrame, passage_id: str, doc_id: str) -> DataFrame:
    """One expected document per passage: the lowest id that contains it."""
    pairs = passage_documents(passages, documents, passage_id, doc_id)
    return pairs.groupBy("p").agg(F.min("d").alias("expect"))
