"""The training-data operators as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm import (
    bpe, cover_tree, html_text, language, line_dedup, mixing, multi_index, ngram_join, pii, quality, runs, url_filter, variants,
)
from vecloom.llm.common import whole_text

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the query's contract: (action, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.withColumn("base", base).select(
        "doc_id",
        *[number(kind) for kind in pii.KINDS],
        F.sha2(pii.describe(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.describe(F.col("spans")).alias("spans"),
    )


def op2_cover_tree_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.cosine_links(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_links(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return multi_index.search(vectors, vectors.where("vec_id % 20 = 0"))


def token_digests(docs: DataFrame) -> DataFrame:
    """Encode whole texts, decode the ids, and keep digests of both."""
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = bpe.decode(bpe.encode(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN), ranks)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op7_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op8_min_cut_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages).select("page_id", "url", "text", "n_chars")


def op9_rule_ensemble_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_rules(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(whole_text().cast("binary"), 256).alias("kept_sha256")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", kept)


def _with_periodic_tails(docs: DataFrame) -> DataFrame:
    """The contract's texts: in a tenth of the documents the words from some place on are made periodic."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words, n, a, p = (F.col(c) for c in ("words", "n", "a", "p"))
    split = F.regexp_extract_all(whole_text(), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # One projection a step: each value is used several times.
    rows = docs.withColumn("g", F.floor(h / 10)).withColumn("words", F.when(h % 10 == 0, split)).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    wrapped = F.array_join(F.concat(F.slice(words, 1, a), F.slice(tail, 1, n - a)), " ")
    return rows.select("doc_id", F.when(n > 0, wrapped).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.find_runs(_with_periodic_tails(docs))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    length, period = F.col("best.length"), -F.col("best.col3")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Shorter runs can not become words of the least length, so they are not taken out at all.
    found = F.regexp_extract_all(whole_text(), F.lit("[A-Za-z\u00C0-\u00FF]{%d,}" % variants.MIN_CHARS), F.lit(0))
    met = table(spark, sf_dir, "documents").select("doc_id", F.explode(found).alias("run"))
    met = met.select("doc_id", F.translate("run", _UPPER, _LOWER).alias("run"))
    met = met.withColumn("h", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = met.select(F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("run")).alias("word"))
    return variants.group_variants(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def op13_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = language.predict_language(docs, language.fit_language(docs))
    return judged.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


QUERIES: dict[str, Query] = {
    q.__name__: q for q in (op1_skip_chain_pii, op2_cover_tree_near_dedup, op3_ngram_jaccard_join, op4_multi_index_hashing, op5_byte_level_bpe, op6_url_filter, op7_poisson_mixing, op8_min_cut_html_text, op9_rule_ensemble_quality, op10_line_dedup,
                            op11_periodic_runs, op12_spelling_variants,
                            op13_string_kernel_language)
}

_URL_RULES_SQL = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in URL_RULES)

ORACLE: dict[str, str] = {
    "op6_url_filter": f"""
        WITH rules(action, rhost, rpath) AS (VALUES {_URL_RULES_SQL}),
        parts AS (
          SELECT page_id, COALESCE(strpos(url, '://'), 0) AS at, CASE WHEN strpos(url, '://') > 0
                 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        urls AS (
          SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
        fits AS (
          SELECT page_id, rhost || rpath AS rule, action, row_number() OVER (
                 PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS nth
          FROM urls JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
        SELECT u.page_id, u.host, u.path, f.rule, COALESCE(f.action, 'allow') AS verdict
        FROM urls u LEFT JOIN fits f ON f.page_id = u.page_id AND f.nth = 1""",
    "op7_poisson_mixing": f"""
        WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        rates AS (
          SELECT source, pow(n, {mixing.TEMPERATURE}) / (SELECT sum(pow(n, {mixing.TEMPERATURE})) FROM counts)
                 * (SELECT sum(n) FROM counts) * {mixing.EPOCHS} / n AS rate FROM counts),
        terms AS (
          SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
          FROM rates, LATERAL (SELECT unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT))) AS k)),
        drawn AS (
          SELECT *, (CAST('0x' || substr(md5('{mixing.SEED}|' || doc_id), 1, 13) AS BIGINT) + 0.5) / pow(16, 13) AS u
          FROM documents),
        counted AS (
          SELECT d.doc_id, count(*) AS n_copies FROM drawn d JOIN terms t ON t.source IS NOT DISTINCT FROM d.source
          AND t.cdf < d.u GROUP BY d.doc_id)
        SELECT d.*, CAST(c.n_copies AS INTEGER) AS n_copies, CAST(unnest(generate_series(1, c.n_copies)) AS INTEGER) AS copy
        FROM documents d JOIN counted c USING (doc_id)""",
    "op10_line_dedup": f"""
        WITH lines AS (
          SELECT doc_id, unnest(string_split(COALESCE(text, ''), chr(10))) AS line,
                 unnest(generate_series(1, len(string_split(COALESCE(text, ''), chr(10))))) AS at FROM documents),
        keyed AS (
          SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        hot AS (
          SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {line_dedup.MIN_CHARS}
          GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS})
        SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (h.key IS NOT NULL AND k.doc_id <> h.keeper) AS n_dropped,
               sha256(COALESCE(string_agg(k.line, chr(10) ORDER BY k.at)
               FILTER (h.key IS NULL OR k.doc_id = h.keeper), '')) AS kept_sha256
        FROM keyed k LEFT JOIN hot h ON h.key = k.key GROUP BY k.doc_id""",
    "op12_spelling_variants": f"""
        WITH RECURSIVE bits AS (
          SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
                 CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tbl),
        met AS (
          SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{_UPPER}', '{_LOWER}') AS run
          FROM documents),
        each AS (SELECT doc_id, run, count(*) AS times, hex(encode(doc_id || ':' || run)) AS code
                 FROM met WHERE length(run) >= {variants.MIN_CHARS} GROUP BY doc_id, run),
        hashed AS (
          SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
                 range(length(code) // 2), lambda i: CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT))),
                 lambda c, b: xor(c >> 8, tbl[1 + (xor(c, b) & 255)]))) AS h FROM each, bits),
        words AS (
          SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, 2 + h % length(run)) ELSE run END
                 AS word, CAST(sum(times) AS BIGINT) AS n FROM hashed GROUP BY 1
          HAVING length(word) >= {variants.MIN_CHARS} AND sum(times) >= {variants.MIN_COUNT}),
        cut AS (SELECT word, n, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) AS less
                FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS pos FROM words)),
        near AS (
          SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.pos = b.pos AND a.less = b.less AND a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM words a JOIN cut b ON a.word = b.less
          UNION SELECT b.word, a.word, a.n FROM words a JOIN cut b ON a.word = b.less),
        best AS (
          SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near,
                 row_number() OVER (PARTITION BY word ORDER BY n DESC, encode(other)) AS nth FROM near),
        linked AS (
          SELECT w.word, w.n, COALESCE(b.n_near, 0) AS n_near, CASE WHEN b.n >= {variants.RATIO} * w.n THEN b.other END AS form,
                 CASE WHEN b.n >= {variants.RATIO} * w.n THEN b.n END AS form_n
          FROM words w LEFT JOIN best b ON b.word = w.word AND b.nth = 1),
        chains AS (
          SELECT word, word AS root FROM linked
          UNION ALL SELECT c.word, l.form FROM chains c JOIN linked l ON l.word = c.root WHERE l.form IS NOT NULL)
        SELECT l.word, l.form, c.root, l.n, l.n_near, l.form_n FROM linked l JOIN chains c ON c.word = l.word
        JOIN linked e ON e.word = c.root AND e.form IS NULL""",
}
