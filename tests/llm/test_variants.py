"""Spelling variants against edit distances by definition."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vecloom.llm import variants
from vecloom.llm.queries import QUERIES


def one_edit(a, b):
    """By definition: some single deletion, or some single replacement, makes them equal."""
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts, min_chars=7, min_count=2, ratio=10):
    words = {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}
    near = {w: sorted((v for v in words if one_edit(v, w)), key=lambda v: (-words[v], v)) for w in words}
    form = {w: near[w][0] if near[w] and words[near[w][0]] >= ratio * n else None for w, n in words.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n, len(near[w]), words[form[w]] if form[w] else 0) for w, n in words.items())


def found(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text(alphabet="abé", min_size=2, max_size=6), max_size=40), st.integers(1, 4))
def test_tiles_meet_every_pair_once(words, tiles):
    met = []
    for m in range(2, 8):
        s = -(-m // tiles)
        for x in range(0, m, s):
            groups = {}
            for w in words:
                if len(w) in (m, m - 1):
                    groups.setdefault((w[:x], w[len(w) - max(0, m - x - s):]), []).append(w)
            for rows in groups.values():
                rows.sort(key=lambda w: len(w) < m)
                fill = lambda v: variants.np.full(len(rows), v)
                for a, b in variants.near_rows(rows, m, fill(x), fill(s), fill(len(rows))):
                    met += [tuple(sorted((rows[i], rows[j]))) for i, j in zip(a, b)]
    assert sorted(met) == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))


ALPHABET = "abcdefghijklmnopqrstuvwxyzàéÿ"


def invented():
    """Families of words around common ones, chains of forms, ties, and words of many lengths."""
    counts = {"kitchen": 5000, "kitchn": 900, "kitcheen": 400, "kitcheeen": 30, "kitcheeeen": 2, "kitchens": 4000}
    for i in range(400):
        base = "".join(ALPHABET[(i * i + 7 * j * i + j) % len(ALPHABET)] for j in range(7 + i % 9))
        counts[base] = 2 + (i * 37) % 900
        counts[base[:i % 7] + base[i % 7 + 1:]] = 2 + i % 30
        counts[base[:i % 7] + "z" + base[i % 7:]] = 2 + i % 50
    counts |= {"aaaaaaa" + a + b: 2 + (ord(a) * ord(b)) % 80 for a in ALPHABET for b in ALPHABET}  # one large tile
    return counts


@pytest.mark.parametrize("max_tile", [variants.MAX_TILE, 5])
def test_equals_definition(spark, max_tile):
    counts = invented()
    rows = [(w, n - 1) for w, n in counts.items()] + [(w, 1) for w in counts] + [(None, 50), ("nothing", None)]
    words = spark.createDataFrame(rows, "word string, n long")
    assert found(variants.group_variants(words, max_tile=max_tile)) == plain_variants(counts)


def test_split_tiles_are_bounded(spark):
    words = spark.createDataFrame(list(invented().items()), "word string, n long")
    sizes = variants.split_tiles(words, max_tile=40).groupBy(*variants._KEYS).count()
    assert sizes.agg({"count": "max"}).first()[0] <= 40


def test_very_long_words_and_empty_table(spark):
    long = "ab" * 50_000
    counts = {long: 100, long + "c": 3, "x" + long[1:]: 4, "b" + long: 2}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(variants.group_variants(words)) == plain_variants(counts)
    assert variants.group_variants(words.where("n < 0")).collect() == []


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(9)], "word string, form string")
    assert {r["root"] for r in variants.roots_of(forms, 9).collect()} == {"w9"}


def test_query_on_odd_texts(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "Straße STRASSEN straßen"), (4, "éléphant Éléphant éléphants " * 3), (None, "kitchen " * 4),
            (5, "kitchen kitchen"), (5, "kitchens×kitchens"), (6, "q" * 200_000 + " " + "q" * 200_000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["word"]: r for r in QUERIES["op12_spelling_variants"](spark, str(tmp_path)).collect()}
    assert got["kitchen"]["n"] >= 4 and got["éléphant"]["n_near"] == 1 + ("Éléphant" in got)
    assert any(len(w) >= 199_999 for w in got) and "straßen" not in got
