"""The string kernel and its regression against plain forms, and held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa
from compare import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from vecloom.llm import language
from vecloom.llm.queries import QUERIES


def plain_spectrum(text):
    raw = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in text.encode())
    runs = {raw[i:i + n] for n in range(1, language.SPECTRUM + 1) for i in range(len(raw) - n + 1)}
    return {int.from_bytes(r, "little") * 0x9E3779B1 % 2**32 >> (32 - language.BUCKET_BITS) for r in runs}


texts = st.lists(st.text(alphabet="abAZ é\n.9\x00ÿ你", max_size=30), max_size=6)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_spectrum_has_every_run_of_its_text_only(many):
    held = language.spectra(pa.array(many, pa.string()))
    assert [set(np.flatnonzero(row).tolist()) for row in held] == [plain_spectrum(t) for t in many]


def test_spectrum_across_pieces(monkeypatch):
    many = ["the quick brown fox " * 20, "", "é" * 31, "jumps over"]
    monkeypatch.setattr(language, "_PIECE_BYTES", 7)
    assert [set(np.flatnonzero(r).tolist()) for r in language.spectra(pa.array(many))] == [plain_spectrum(t) for t in many]


WORDS = {
    "en": "the of and to in that which with from were their about would there people water".split(),
    "fr": "le de et la les des que dans pour avec sont leur était comme très aussi où".split(),
    "de": "der und die das nicht von mit auf für sich wurde werden über zwischen müssen".split(),
}


def invented(n, first=0):
    rng = np.random.default_rng(first)
    names = list(WORDS)
    rows = []
    for i in range(first, first + n):
        lang = names[i % 3 if i % 7 else 0]
        rows.append((i, " ".join(rng.choice(WORDS[lang], size=5 + i % 40)), lang))
    return rows


SCHEMA = "doc_id long, text string, lang string"


def plain_scores(model_rows, landmark_texts, names, asked, ridge):
    """Kernel by sets, Nyström features, and weighted ridge regression by stacked least squares."""

    def values(some):
        marks = [plain_spectrum(t) for t in landmark_texts]
        own = [plain_spectrum(t) for t in some]
        return np.array([[len(a & b) / np.sqrt(max(1, len(a)) * max(1, len(b))) for b in marks] for a in own])

    eigen, vectors = np.linalg.eigh(values(landmark_texts))
    kept = eigen > 1e-6 * eigen.max()
    lift = vectors[:, kept] / np.sqrt(eigen[kept])
    features = lambda some: np.column_stack([values(some) @ lift, np.ones(len(some))])
    langs = [r[2] for r in model_rows]
    weight = np.array([1 / langs.count(x) for x in langs])
    x = features([r[1] for r in model_rows]) * np.sqrt(weight)[:, None]
    y = np.where(np.array(langs)[:, None] == np.array(names), 1.0, -1.0) * np.sqrt(weight)[:, None]
    stacked = np.vstack([x, np.sqrt(ridge * weight.sum()) * np.eye(x.shape[1])])
    solved = np.linalg.lstsq(stacked, np.vstack([y, np.zeros((x.shape[1], y.shape[1]))]), rcond=None)[0]
    return features(asked) @ solved


def test_scores_equal_plain_regression(spark):
    rows = invented(150)
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language.fit_language(docs, per_language=5)
    sample, _ = language._sample(docs, "doc_id", "text", "lang", language.MAX_ROWS, language.SEED)
    drawn = sorted((r["lang"], r["draw"], r["text"]) for r in sample.collect())
    assert sorted(t for _, _, t in drawn) == sorted(r[1] for r in learned)
    marks = [t for name in sorted(WORDS) for t in [x[2] for x in drawn if x[0] == name][:5]]
    asked = [r[1] for r in rows] + ["", "ü"]
    expected = plain_scores(learned, marks, sorted(WORDS), asked, language.RIDGE)
    assert model.languages == tuple(sorted(WORDS))
    np.testing.assert_allclose(model.scores(pa.array(asked)), expected, atol=1e-4)


def test_sample_is_bounded_and_even(spark):
    docs = spark.createDataFrame(invented(4000), SCHEMA)
    sample, counts = language._sample(docs, "doc_id", "text", "lang", 300, 1)
    taken = {r["lang"]: r["count"] for r in sample.groupBy("lang").count().collect()}
    assert all(60 <= taken[name] <= 140 for name in WORDS) and sum(counts.values()) > 2500
    got = language.predict_language(docs, language.fit_language(docs, max_rows=300)).where("lang <> lang_pred").count()
    assert got < 40


def test_odd_rows_and_clashing_names(spark):
    odd = [(1, None, "en"), (2, "", "fr"), (3, "123 !?", "de"), (None, "the of and", "xx"), (4, "the of", None), (4, "the of", None),
           (5, "the water of people " * 20_000, "en")]
    schema = SCHEMA + ", judged int, Score string"
    docs = spark.createDataFrame([(*r, 7, "s") for r in odd + invented(90, 100)], schema)
    judged = language.predict_language(docs, language.fit_language(docs))
    rows = {r["doc_id"]: r for r in judged.collect()}
    assert judged.columns == ["doc_id", "text", "lang", "judged", "lang_pred", "score"]
    assert all((rows[i]["lang_pred"], rows[i]["score"]) == ("und", 0.0) for i in (1, 2, 3))
    assert {rows[i]["lang_pred"] for i in (None, 4, 5)} == {"en"} and rows[5]["judged"] == 7
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    nothing = docs.where("lang = 'xx'")
    assert [r["lang_pred"] for r in language.predict_language(nothing, language.fit_language(nothing)).collect()] == ["und"]
    assert language.predict_language(docs.limit(0), language.fit_language(docs.limit(0))).collect() == []


def test_held_out_accuracy(spark):
    found = QUERIES["op13_string_kernel_language"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang", "text")
    rows = found.join(docs, "doc_id").where(r"held_out and text rlike '\\p{L}' and lang is not null").collect()
    assert rows and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.95
