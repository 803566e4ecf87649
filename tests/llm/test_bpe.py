"""Byte-level BPE against the tiktoken library, in both folds, and round trips."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from compare import SF_DIR
from pyspark.sql import functions as F

from vecloom.llm import bpe
from vecloom.llm.queries import QUERIES

TEXTS = [
    "", " ", "\n\n  \t x", "It's they'll WE'VE don't", "Straße naïve 東京 \U0001f600\U0001f468‍\U0001f469", "a\x1cb\x1d \x85c\xa0d ",
    "12345 678,9 !!! ???---", "x" * 3000, "ab" * 2000, "é" * 900, "The  quick   brown fox " * 50, "<|endoftext|>",
]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_texts_equal_the_library_and_round_trip(spark, ranks, library):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*TEXTS, None])], "doc_id int, text string, decoded string")
    for options in ({"head_words": 500}, {"head_words": 5, "sample_rows": 1}):
        rows = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN, **options), ranks).collect()
        for r in rows:
            assert list(r.ids) == library.encode_ordinary(r.text or "")
            assert bytes(r.decoded) == (r.text or "").encode()


def test_spark_fold_equals_the_library(spark, ranks, library):
    words = sorted({w for t in TEXTS[:7] for w in bpe.compiled(public_tokenizers.PATTERN).findall(t)}) + [" thnterontion", "q"]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    for r in frame.select("word", bpe.fold_words(F.col("word"), ranks).alias("ids")).collect():
        assert list(r.ids) == library.encode_ordinary(r.word)


def test_words_merged_together_equal_the_library(ranks, library, monkeypatch):
    rng = random.Random(5)
    words = list(dict.fromkeys(
        "".join(rng.choice("aeinrst hé東\U0001f600.") for _ in range(rng.choice([1, 2, 3, 7, 16, 17, 63, 64, 65, 90]))) for _ in range(3000)
    ))
    monkeypatch.setattr(bpe, "MEMO_WORDS", 700)
    monkeypatch.setattr(bpe, "_MATRIX_PARTS", 900)
    pairs, head = bpe.PairRanks(ranks), {" the": tuple(library.encode_ordinary(" the"))}
    coder, plain = bpe._Coder(ranks, pairs, head), bpe._Coder(ranks, pairs, {})
    for start in range(0, 2 * len(words), 400):
        part = (words + words[::-1])[start:start + 400]
        part = list(dict.fromkeys(part))
        for word, at in zip(part, coder.places(part), strict=True):
            found = coder.flat[coder.starts[at]:coder.starts[at] + coder.sizes[at]].tolist()
            assert found == list(plain._merged_long(word.encode()))
            if len(bpe.compiled(public_tokenizers.PATTERN).findall(word)) == 1:
                assert found == library.encode_ordinary(word)
        coder.forget(part)
        assert coder.index[" the"] == 0 and len(coder.index) <= 700 + 1


def test_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op5_byte_level_bpe"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_empty_table(spark, ranks):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN, head_words=5), ranks).count() == 0
