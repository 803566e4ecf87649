"""Column functions: vector maths, encoders and their SQL registration."""

from vecloom.functions.encoders import (
    HASHING,
    HASHING_512,
    HASHING_ASYMMETRIC,
    HASHING_WHOLE,
    EncoderSpec,
    compose_text,
    embed_encode,
    embed_encode_batch,
    embed_query,
    embed_query_text,
    embed_text,
    words,
)
from vecloom.functions.vectors import (
    assert_dim,
    cosine_distance,
    cosine_similarity,
    dot_product,
    has_null_element,
    is_zero_vector,
    l2_distance,
    l2_normalize,
    parse_vector,
    vector_distance,
    vector_literal,
)

__all__ = [
    "HASHING",
    "HASHING_512",
    "HASHING_ASYMMETRIC",
    "HASHING_WHOLE",
    "EncoderSpec",
    "assert_dim",
    "compose_text",
    "cosine_distance",
    "cosine_similarity",
    "dot_product",
    "embed_encode",
    "embed_encode_batch",
    "embed_query",
    "embed_query_text",
    "embed_text",
    "has_null_element",
    "is_zero_vector",
    "l2_distance",
    "l2_normalize",
    "parse_vector",
    "vector_distance",
    "vector_literal",
    "words",
]
