"""Text encoders as row-local column expressions.

An :class:`EncoderSpec` names an encoder and fixes its rules: dimension, token
limit, pooling and the prefix that only queries carry.  The default encoder is
signed feature hashing (Weinberger et al. 2009): it needs no weights, it is
deterministic, and it is lexical, so texts are close when they share words, not
when they share meaning.  :mod:`vecloom.functions.model_encoder` runs a
user-supplied model under the same interface.

Encoding never shuffles: one Arrow batch of texts at a time is split into words
and turned into vectors by vectorised kernels (several times faster here than
splitting with JVM expressions), so a text that fills a third of the table costs
its rows and nothing more.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The embedding size, the token limit, and the query instruction
# of the asymmetric model family.
EMBEDDING_DIM = 384
MAX_TOKENS = 512
RETRIEVAL_PREFIX = "Represent this sentence for searching relevant passages: "

# Words are runs of letters and digits; everything else separates them.
_BETWEEN_WORDS = r"[^\p{L}\p{N}]+"
_SLICE_BYTES = 4 << 20


@dataclass(frozen=True)
class EncoderSpec:
    """What must agree for two vectors to be comparable.

    Hashing reads whole texts unless ``max_tokens`` cuts them.  ``model_dir``
    switches to a model kept in that directory, whose limit is ``MAX_TOKENS``
    unless another is given.  A text
    the model fails on gets a zero vector, or fails the job when ``strict``.
    """

    name: str = "hashing-384"
    dim: int = EMBEDDING_DIM
    max_tokens: int | None = None
    pooling: str = "mean"
    query_prefix: str | None = None
    model_dir: str | None = None
    strict: bool = False

    def __post_init__(self):
        if self.model_dir is not None and self.max_tokens is None:
            object.__setattr__(self, "max_tokens", MAX_TOKENS)
        if self.dim < 1:
            raise ValueError("dim must be positive")
        if self.max_tokens is not None and self.max_tokens < 1:
            raise ValueError("max_tokens must be positive or None")
        if self.pooling not in ("mean", "cls"):
            raise ValueError("pooling must be 'mean' or 'cls'")

    @property
    def is_asymmetric(self) -> bool:
        return self.query_prefix is not None

    def whole_text(self) -> EncoderSpec:
        """The same encoder without the token limit, under its own name."""
        return replace(self, name=f"{self.name}-whole", max_tokens=None)

    def info(self) -> str:
        """The spec as ``name=value`` pairs."""
        limit = "none" if self.max_tokens is None else self.max_tokens
        return f"name={self.name};dim={self.dim};max_tokens={limit};pooling={self.pooling};query_prefix={int(self.is_asymmetric)}"


HASHING = EncoderSpec()
HASHING_512 = EncoderSpec(name="hashing-384-512", max_tokens=MAX_TOKENS)
HASHING_WHOLE = HASHING.whole_text()
HASHING_ASYMMETRIC = EncoderSpec(name="hashing-384-asymmetric", query_prefix=RETRIEVAL_PREFIX)


def word_lists(batch: pa.Array) -> pa.Array:
    """The words of every text; a batch with much text in slices."""
    n = len(batch)
    if n > 1 and batch.nbytes > _SLICE_BYTES:
        return pa.concat_arrays([word_lists(batch[: n // 2]), word_lists(batch[n // 2 :])])
    flat, rows = _words_by_row(batch, None)
    offsets = np.searchsorted(rows, np.arange(len(batch) + 1)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), flat)
    return pc.if_else(batch.is_valid(), lists, pa.scalar(None, lists.type))


def words(text) -> Column:
    """Lower-cased words of a text as an array, split as the encoder splits them."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def split(batch: pa.Array) -> pa.Array:
        return word_lists(batch)

    return split(text if isinstance(text, Column) else F.col(text))


def compose_text(*parts, required: tuple[int, ...] = ()) -> Column:
    """Join columns with single spaces, NULL parts as ``''``.

    A NULL in a ``required`` position makes the whole text NULL.  The separators
    of NULL parts stay, so two NULLs give one space.
    """
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        part = part if isinstance(part, Column) else F.col(part)
        if pieces:
            pieces.append(F.lit(" "))
        pieces.append(part if i in required else F.coalesce(part, F.lit("")))
    return F.concat(*pieces)


def _word_slots(vocabulary: list[str], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot and sign of each distinct word, from its MD5 digest."""
    raw = b"".join(hashlib.md5(w.encode("utf-8"), usedforsecurity=False).digest() for w in vocabulary)
    digests = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 16)
    heads = digests[:, :4].copy().view(">u4").ravel().astype(np.int64)
    return heads % dim, np.where(digests[:, 4] < 0x80, 1.0, -1.0)


def _words_by_row(texts: pa.Array, limit: int | None) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch, at most ``limit`` per text, and the row of each."""
    if not pa.types.is_string(texts.type):
        # An untyped NULL from SQL, for one.
        texts = texts.cast(pa.string())
    parts = pc.split_pattern_regex(pc.utf8_lower(texts), pattern=_BETWEEN_WORDS)
    lengths = pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False)
    flat, rows = parts.flatten(), np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    # Separators at the ends of a text leave empty pieces.
    real = pc.not_equal(flat, "")
    flat, rows = flat.filter(real), rows[real.to_numpy(zero_copy_only=False)]
    if limit is not None:
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        flat, rows = flat.filter(pa.array(place < limit)), rows[place < limit]
    return flat, rows


def _hash_texts(texts: pa.Array, dim: int, limit: int | None) -> np.ndarray:
    """Sum word signs per slot and scale each row to unit length.

    A batch with much text is worked on in slices, so that its words never lie
    in memory at once.
    """
    n = len(texts)
    if n > 1 and texts.nbytes > _SLICE_BYTES:
        return np.concatenate([_hash_texts(part, dim, limit) for part in (texts[: n // 2], texts[n // 2 :])])
    flat, rows = _words_by_row(texts, limit)
    if len(flat) == 0:
        return np.zeros((n, dim))
    coded = flat.dictionary_encode()
    slot, sign = _word_slots(coded.dictionary.to_pylist(), dim)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    sums = np.bincount(rows * dim + slot[codes], weights=sign[codes], minlength=n * dim).reshape(n, dim)
    norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
    return sums / np.where(norms > 0, norms, 1.0)


def as_float_lists(matrix: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Arrow list<float> column from a row matrix, NULL where not ``valid``."""
    n, dim = matrix.shape
    keep = np.ones(n, dtype=bool) if valid is None else valid
    offsets = np.concatenate(([0], np.cumsum(np.where(keep, dim, 0)))).astype(np.int32)
    values = pa.array(matrix[keep].astype(np.float32).ravel())
    mask = None if valid is None else pa.array(~keep)
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=mask)


def hashing_udf(spec: EncoderSpec):
    """Arrow function from texts to vectors; NULL gives NULL."""
    dim, limit = spec.dim, spec.max_tokens

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def hash_texts(batch: pa.Array) -> pa.Array:
        return as_float_lists(_hash_texts(batch, dim, limit), batch.is_valid().to_numpy(zero_copy_only=False))

    return hash_texts


def hashing_batch_udf(spec: EncoderSpec):
    """Arrow function from lists of texts to lists of vectors."""
    dim, limit = spec.dim, spec.max_tokens

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.FloatType())))
    def hash_lists(batch: pa.Array) -> pa.Array:
        texts = batch.flatten()
        known = texts.is_valid().to_numpy(zero_copy_only=False)
        return relist(batch, as_float_lists(_hash_texts(texts, dim, limit), known))

    return hash_lists


def relist(lists: pa.Array, values: pa.Array) -> pa.Array:
    """Put one value per flattened element back into the shape of ``lists``."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, mask=lists.is_null())


def encoder_udf(spec: EncoderSpec):
    """The Arrow function that ``spec`` stands for."""
    if spec.model_dir is not None:
        from vecloom.functions.model_encoder import model_udf

        return model_udf(spec)
    return hashing_udf(spec)


def batch_encoder_udf(spec: EncoderSpec):
    """The same for lists of texts."""
    if spec.model_dir is not None:
        from vecloom.functions.model_encoder import model_batch_udf

        return model_batch_udf(spec)
    return hashing_batch_udf(spec)


def embed_encode(text, spec: EncoderSpec = HASHING) -> Column:
    """Document-side vector; ``''`` gives zeros and NULL gives NULL."""
    return encoder_udf(spec)(text if isinstance(text, Column) else F.col(text))


def query_text(text: Column, spec: EncoderSpec) -> Column:
    """Add the query prefix, except to ``''`` which stays empty."""
    if not spec.is_asymmetric:
        return text
    return F.when(text == "", text).otherwise(F.concat(F.lit(spec.query_prefix), text))


def embed_query(text, spec: EncoderSpec = HASHING) -> Column:
    """Query-side vector: the same as :func:`embed_encode` without a prefix."""
    text = text if isinstance(text, Column) else F.col(text)
    return encoder_udf(spec)(query_text(text, spec))


def embed_text(text, spec: EncoderSpec = HASHING) -> Column:
    """Document-side vector as a ``[v1,v2,…]`` literal."""
    from vecloom.functions.vectors import vector_literal

    return vector_literal(embed_encode(text, spec))


def embed_query_text(text, spec: EncoderSpec = HASHING) -> Column:
    """Query-side vector as a ``[v1,v2,…]`` literal."""
    from vecloom.functions.vectors import vector_literal

    return vector_literal(embed_query(text, spec))


def embed_encode_batch(texts, spec: EncoderSpec = HASHING) -> Column:
    """One document-side vector per array element, in order.

    Like the scalar form, an empty text gives zeros and a NULL element NULL, so
    the result always has one entry per input.
    """
    return batch_encoder_udf(spec)(texts if isinstance(texts, Column) else F.col(texts))
