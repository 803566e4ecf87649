"""A tiny ONNX model, written by hand, behind the encoder interface."""

import numpy as np
import pytest

import vecloom.functions as V
from vecloom.functions.sql import register_functions
from vecloom.sources import maintenance

pytest.importorskip("onnxruntime")
tokenizers = pytest.importorskip("tokenizers")

WORDS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "cat", "kitten", "bicycle", "query:"]
DIM = 4
TABLE = np.random.default_rng(0).normal(size=(len(WORDS), DIM)).astype(np.float32)


def varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def field(number, value):
    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    value = value.encode() if isinstance(value, str) else value
    return varint(number << 3 | 2) + varint(len(value)) + value


def tensor_info(name, kind, dims):
    shape = b"".join(field(1, field(2, d) if isinstance(d, str) else field(1, d)) for d in dims)
    return field(1, name) + field(2, field(1, field(1, kind) + field(2, shape)))


def write_model(folder):
    """hidden = table[input_ids], a lookup in place of a transformer."""
    weights = b"".join(field(1, d) for d in TABLE.shape) + field(2, 1) + field(8, "table") + field(9, TABLE.tobytes())
    node = field(1, "table") + field(1, "input_ids") + field(2, "hidden") + field(4, "Gather")
    graph = (field(1, node) + field(2, "g") + field(5, weights) + field(11, tensor_info("input_ids", 7, ["n", "len"]))
             + field(12, tensor_info("hidden", 1, ["n", "len", DIM])))
    model = field(1, 8) + field(7, graph) + field(8, field(2, 13))
    (folder / "model.onnx").write_bytes(model)
    tok = tokenizers.Tokenizer(tokenizers.models.WordLevel({w: i for i, w in enumerate(WORDS)}, unk_token="[UNK]"))
    tok.pre_tokenizer = tokenizers.pre_tokenizers.WhitespaceSplit()
    tok.post_processor = tokenizers.processors.TemplateProcessing(
        single="[CLS] $A [SEP]", special_tokens=[("[CLS]", 2), ("[SEP]", 3)])
    tok.save(str(folder / "tokenizer.json"))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("model")
    write_model(path)
    return str(path)


def by_hand(text, pooling="mean", limit=512):
    ids = ([2] + [WORDS.index(w) if w in WORDS else 1 for w in text.split()] + [3])[:limit]
    rows = TABLE[ids]
    v = rows[0] if pooling == "cls" else rows.mean(axis=0)
    return v / np.linalg.norm(v)


def encode(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(3)
    return [r[1] for r in sorted(df.select("i", column).collect())]


@pytest.mark.parametrize("pooling", ["mean", "cls"])
def test_matches_the_model_by_hand(spark, folder, pooling):
    spec = V.EncoderSpec(name="tiny", dim=DIM, pooling=pooling, model_dir=folder)
    texts = ["cat", "cat kitten bicycle", "unknown words here cat", "kitten " * 700]
    for text, vec in zip(texts, encode(spark, texts, V.embed_encode("text", spec))):
        assert np.allclose(vec, by_hand(text, pooling), atol=1e-5)


def test_empty_null_and_truncation(spark, folder):
    spec = V.EncoderSpec(name="tiny", dim=DIM, max_tokens=3, model_dir=folder)
    empty, null, long = encode(spark, ["", None, "cat kitten bicycle"], V.embed_encode("text", spec))
    assert empty == [0.0] * DIM and null is None
    # Three tokens: the start marker and two words; the end marker is cut off.
    assert np.allclose(long, by_hand("cat kitten bicycle", limit=3), atol=1e-5)


def test_query_prefix(spark, folder):
    spec = V.EncoderSpec(name="tiny", dim=DIM, query_prefix="query: ", model_dir=folder)
    query, empty = encode(spark, ["cat", ""], V.embed_query("text", spec))
    assert np.allclose(query, by_hand("query: cat"), atol=1e-5) and empty == [0.0] * DIM


def test_batch_and_sql(spark, folder):
    spec = V.EncoderSpec(name="tiny", dim=DIM, model_dir=folder)
    df = spark.createDataFrame([(["kitten", "", "cat"],)], "texts array<string>")
    got = df.select(V.embed_encode_batch("texts", spec)).first()[0]
    assert np.allclose(got[0], by_hand("kitten"), atol=1e-5) and got[1] == [0.0] * DIM
    register_functions(spark, spec)
    try:
        row = spark.sql("SELECT embed_encode('cat') AS e, embed_model() AS m").first()
        assert np.allclose(row["e"], by_hand("cat"), atol=1e-5) and row["m"] == "tiny"
    finally:
        register_functions(spark)


def test_failures_become_zero_vectors_unless_strict(spark, folder):
    # A spec that disagrees with the model's size fails on every text.
    loose = V.EncoderSpec(name="tiny", dim=DIM + 1, model_dir=folder)
    assert encode(spark, ["cat"], V.embed_encode("text", loose)) == [[0.0] * (DIM + 1)]
    with pytest.raises(Exception, match="dimensions"):
        encode(spark, ["cat"], V.embed_encode("text", V.EncoderSpec(name="tiny", dim=DIM + 1, model_dir=folder, strict=True)))


def test_backfill_runs_the_model_on_missing_rows_only(spark, folder):
    spec = V.EncoderSpec(name="tiny", dim=DIM, model_dir=folder)
    df = spark.createDataFrame([(1, "cat", None), (2, "cat", [9.0] * DIM)], "id int, text string, embedding array<float>")
    got = {r["id"]: r["embedding"] for r in maintenance.backfill_missing(df, "text", spec).collect()}
    assert np.allclose(got[1], by_hand("cat"), atol=1e-5) and got[2] == [9.0] * DIM
