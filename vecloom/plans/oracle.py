"""The same queries in plain SQL, for checking results on another engine."""

from __future__ import annotations

from vecloom.functions.encoders import RETRIEVAL_PREFIX
from vecloom.operators.ann import PROJECTIONS, TABLES
from vecloom.plans.queries import PRODUCT_TEXT, SEARCH_TEXT, THRESHOLD

WORDS = r"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(text: str) -> str:
    return WORDS.format(text=text)


def hashed(name: str, source: str, dim: int = 384, limit: int | None = None) -> str:
    """CTEs for sparse hashed vectors ``name(id, b, v)`` of ``source(id, text)``."""
    cut = "" if limit is None else f"[1:{limit}]"
    return f"""
    {name}_t AS (SELECT id, unnest({words('text')}{cut}) AS t FROM ({source})),
    {name}_s AS (SELECT id, ('0x' || substr(md5(t), 1, 8))::BIGINT % {dim} AS b,
                 sum(CASE WHEN substr(md5(t), 9, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) AS w
                 FROM {name}_t GROUP BY ALL),
    {name}_n AS (SELECT id, sqrt(sum(w * w)) AS n FROM {name}_s GROUP BY ALL),
    {name} AS (SELECT id, b, CAST(w / n AS FLOAT)::DOUBLE AS v
               FROM {name}_s JOIN {name}_n USING (id) WHERE n <> 0 AND w <> 0),
    {name}_u AS (SELECT id, b, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS u FROM {name})"""


def prints(name: str) -> str:
    """CTE ``name_f(id, nnz, checksum)``: one row per id with any word."""
    return f"{name}_f AS (SELECT id, count(*) AS nnz, sum(v * (b + 1)) AS checksum FROM {name} GROUP BY id)"


def fingerprint(source: str, select: str, base: str, limit: int | None = None, dim: int = 384) -> str:
    """Fingerprints of every row of ``base``, zeros where it has no words."""
    return f"""WITH {hashed('h', source, dim, limit)}, {prints('h')}
    SELECT {select}, coalesce(nnz, 0) AS nnz, round(coalesce(checksum, 0.0::DOUBLE), 6) AS checksum
    FROM ({base}) x LEFT JOIN h_f USING (id)"""


DOCS = "SELECT doc_id AS id, text FROM documents"
CHUNKS = """SELECT doc_id || '#' || (s - 1) // 450 AS id, doc_id AS parent_id, (s - 1) // 450 AS chunk_index,
    lang AS title, substr(text, s, 500) AS content, source
    FROM (SELECT *, unnest(range(1, length(text) + 1, 450)) AS s FROM documents)"""
PRODUCTS = "SELECT p_partkey AS id, coalesce(p_name, '') || ' ' || coalesce(p_type, '') AS text FROM part"
# The stored marker vector: 384 values of 0.5, weighted by position.
MARK_NNZ, MARK_SUM = "384", "36960.0::DOUBLE"

UNIT = "SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings"
PAIRS = "SELECT a.vec_id, a.embedding::DOUBLE[] AS a, b.embedding::DOUBLE[] AS b FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"
ONE = f"SELECT d.vec_id, d.label, round(list_cosine_similarity(d.e, q.e), 9) AS s FROM ({UNIT}) d, ({UNIT}) q WHERE q.vec_id = 0"


def text_scores(source: str, text: str, limit: int | None = None) -> str:
    """CTE ``scored(id, s)``: cosine of every row of ``source`` with a text."""
    query = f"SELECT 0 AS id, {quote(text)} AS text"
    return f"""{hashed('h', source, 384, limit)}, {hashed('q', query, 384, limit)},
    dots AS (SELECT h_u.id, sum(h_u.u * q_u.u) AS s FROM h_u JOIN q_u USING (b) GROUP BY h_u.id),
    scored AS (SELECT x.id, round(coalesce(s, 0.0::DOUBLE), 9) AS s FROM ({source}) x LEFT JOIN dots USING (id))"""


KNN = f"""SELECT q, id, round(s, 6) AS score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, id) AS rank FROM (
        SELECT q.vec_id AS q, d.vec_id AS id, round(list_cosine_similarity(d.e, q.e), 9) AS s
        FROM ({UNIT}) q CROSS JOIN ({UNIT}) d)) WHERE rank <= 5"""

KNN_WHERE = KNN.replace("CROSS JOIN", "JOIN").replace("d)) WHERE rank", "d ON d.label IN (2, 7) AND d.vec_id >= 10)) WHERE rank")

RANK_OF = f"""SELECT q, id, rank, round(s, 6) AS score, round(s - wrong, 6) AS margin FROM (
    SELECT q, own, id, s, row_number() OVER (PARTITION BY q ORDER BY s DESC, id) AS rank,
           CASE WHEN id = first(id) OVER best THEN nth_value(s, 2) OVER best ELSE first(s) OVER best END AS wrong FROM (
        SELECT q.label::BIGINT AS q, d.label = q.label AS own, d.vec_id AS id, round(list_cosine_similarity(d.e, q.e), 9) AS s
        FROM (SELECT label, arg_min(e, vec_id) AS e FROM ({UNIT}) GROUP BY label) q CROSS JOIN ({UNIT}) d)
    WINDOW best AS (PARTITION BY q ORDER BY s DESC, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) WHERE own"""


IVF = f"""WITH means AS (SELECT label, pos, avg(x) AS m FROM (
        SELECT label, unnest(e) AS x, unnest(range(64)) AS pos FROM ({UNIT})) GROUP BY ALL),
    centres AS (SELECT label AS cell, list(m ORDER BY pos) AS c FROM means GROUP BY label),
    near AS (SELECT vec_id, e, cell, row_number() OVER (PARTITION BY vec_id ORDER BY list_cosine_similarity(e, c) DESC) AS nth
             FROM ({UNIT}), centres)
    SELECT q, id, round(s, 6) AS score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, id) AS rank FROM (
            SELECT q.vec_id AS q, d.vec_id AS id, round(list_cosine_similarity(d.e, q.e), 9) AS s
            FROM near q JOIN near d ON d.cell = q.cell AND d.nth = 1 AND q.nth <= 4)) WHERE rank <= 5"""

LSH = f"""WITH signs AS (SELECT t, p, d, CASE WHEN substr(md5(t || ':' || p || ':' || d), 1, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS w
        FROM range({TABLES}) a(t), range({PROJECTIONS}) b(p), range(64) c(d)),
    sides AS (SELECT vec_id, t, p, sum(x * w) > 0 AS up FROM (
        SELECT vec_id, unnest(e) AS x, unnest(range(64)) AS d FROM ({UNIT})) JOIN signs USING (d) GROUP BY ALL),
    buckets AS (SELECT vec_id, t, sum(CASE WHEN up THEN 1 << p ELSE 0 END) AS key FROM sides GROUP BY ALL),
    pairs AS (SELECT DISTINCT q.vec_id AS q, d.vec_id AS id FROM buckets q JOIN buckets d USING (t, key))
    SELECT q, id, round(s, 6) AS score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, id) AS rank FROM (
            SELECT q, id, round(list_cosine_similarity(d.e, x.e), 9) AS s
            FROM pairs JOIN ({UNIT}) x ON x.vec_id = q JOIN ({UNIT}) d ON d.vec_id = id)) WHERE rank <= 5"""


def evaluated(name: str, dim: int) -> str:
    """CTE ``name(query, expected_doc, rank_of_expected, score, margin)``."""
    passages = "SELECT item_id AS id, text FROM benchmark"
    return f"""{hashed(f'{name}_d', DOCS, dim)}, {hashed(f'{name}_q', passages, dim)},
    {name}_dots AS (SELECT q.id AS q, d.id AS id, sum(q.u * d.u) AS s
                    FROM {name}_q_u q JOIN {name}_d_u d USING (b) GROUP BY q.id, d.id),
    {name}_all AS (SELECT t.item_id AS q, t.expect, d.doc_id AS id, round(coalesce(s, 0.0::DOUBLE), 9) AS s
                   FROM truth t CROSS JOIN documents d LEFT JOIN {name}_dots x ON x.q = t.item_id AND x.id = d.doc_id),
    {name}_ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, id) AS rank,
                      max(CASE WHEN id <> expect THEN s END) OVER (PARTITION BY q) AS wrong FROM {name}_all),
    {name} AS (SELECT q AS query, expect AS expected_doc, rank AS rank_of_expected, s AS score, s - wrong AS margin
               FROM {name}_ranked WHERE id = expect)"""


TRUTH = f"""truth AS (SELECT b.item_id, min(d.doc_id) AS expect
    FROM (SELECT item_id, ' ' || array_to_string({words('text')}, ' ') || ' ' AS t FROM benchmark) b
    JOIN (SELECT doc_id, ' ' || array_to_string({words('text')}, ' ') || ' ' AS t FROM documents) d ON contains(d.t, b.t)
    GROUP BY b.item_id)"""


def summary(name: str, model: str) -> str:
    return f"""SELECT '{model}' AS model, count(*) AS queries, sum((rank_of_expected = 1)::INT)::BIGINT AS top1_hits,
    round(avg((rank_of_expected = 1)::INT), 4) AS top1_accuracy, round(avg(1.0::DOUBLE / rank_of_expected), 4) AS mrr,
    round(avg(rank_of_expected), 3) AS mean_rank FROM {name}"""


def _measures() -> str:
    return ", ".join(
        f"round(b.{m} - a.{m}, 4) AS {m}_delta" if m in ("top1_accuracy", "mrr", "mean_rank") else f"b.{m} - a.{m} AS {m}_delta"
        for m in ("queries", "top1_hits", "top1_accuracy", "mrr", "mean_rank")
    )


EDITED = "CASE WHEN lang = 'en' THEN text || ' updated once' ELSE text END"
UPSERTED = f"SELECT doc_id AS id, {EDITED} AS text FROM documents"
EDITED_TWICE = "SELECT doc_id AS id, CASE WHEN lang = 'en' THEN text || ' updated twice' ELSE text END AS text FROM documents"


def kept_or_encoded(source: str, kept: str, extra: str = "") -> str:
    """Fingerprints where rows that match ``kept`` still hold the marker."""
    return f"""WITH {hashed('h', source)}, {prints('h')}
    SELECT d.doc_id{extra}, CASE WHEN {kept} THEN {MARK_NNZ} ELSE coalesce(nnz, 0) END::BIGINT AS nnz,
           CASE WHEN {kept} THEN {MARK_SUM} ELSE round(coalesce(checksum, 0.0::DOUBLE), 6) END AS checksum
    FROM documents d LEFT JOIN h_f ON h_f.id = d.doc_id"""


# Plain decimals: exponents are spelled out and trailing zeros dropped.
LITERAL = """SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x:
    CASE WHEN contains(x::VARCHAR, 'e') THEN rtrim(x::VARCHAR::DECIMAL(38, 20)::VARCHAR, '0')
         ELSE regexp_replace(x::VARCHAR, '\\.0$', '') END), ',') || ']' AS literal FROM embeddings"""

ZERO = "list_transform(embedding, lambda x: 0.0::DOUBLE)"


def _sum_by_position(values: str) -> str:
    return f"list_sum(list_transform({values}, lambda x, i: x::DOUBLE * i))"


PREFIXED = fingerprint(
    f"SELECT item_id AS id, CASE WHEN text = '' THEN text ELSE {quote(RETRIEVAL_PREFIX)} || text END AS text FROM benchmark",
    "id AS item_id", "SELECT item_id AS id FROM benchmark")

ORACLE: dict[str, str] = {
    "cosine_similarity": f"SELECT vec_id, round(list_cosine_similarity(a, b), 6) AS value FROM ({PAIRS})",
    "cosine_distance": f"SELECT vec_id, round(1 - list_cosine_similarity(a, b), 6) AS value FROM ({PAIRS})",
    "l2_distance": f"SELECT vec_id, round(list_distance(a, b), 6) AS value FROM ({PAIRS})",
    "dot_product": f"SELECT vec_id, round(list_dot_product(a, b), 6) AS value FROM ({PAIRS})",
    "vector_edge_cases": f"""SELECT vec_id, 0.0::DOUBLE AS cosine_mismatch, 0.0::DOUBLE AS cosine_empty,
        0.0::DOUBLE AS cosine_zero, NULL::DOUBLE AS cosine_null, NULL::DOUBLE AS cosine_null_element,
        1.0::DOUBLE AS distance_mismatch, 1.0::DOUBLE AS distance_zero,
        3.4028234663852886e38::DOUBLE AS l2_mismatch,
        round(list_distance(embedding::DOUBLE[], {ZERO}), 6) AS l2_zero, 0.0::DOUBLE AS dot_mismatch,
        true AS sort_distance_is_nan, true AS lenient_dim_is_null FROM embeddings""",
    "vector_literal": LITERAL,
    "vector_literal_roundtrip": "SELECT vec_id, true AS same FROM embeddings",
    "l2_normalize": f"""SELECT vec_id, round({_sum_by_position('list_transform(e, lambda x: (x / n)::FLOAT)')}, 4) AS checksum
        FROM (SELECT *, sqrt(list_dot_product(e, e)) AS n FROM
              (SELECT vec_id, list_transform(embedding, lambda x: (x * 3)::FLOAT)::DOUBLE[] AS e FROM embeddings))""",
    "mean_pool": """SELECT label, round(sum((s / greatest(w, 1e-9))::FLOAT::DOUBLE * i), 4) AS checksum FROM (
        SELECT label::BIGINT AS label, i, sum(x * m) AS s, sum(m) AS w FROM (
            SELECT label, (embedding[1] > 0)::INT::DOUBLE AS m, unnest(embedding::DOUBLE[]) AS x,
                   unnest(range(1, 65)) AS i FROM embeddings) GROUP BY ALL) GROUP BY label""",
    "cls_pool": f"""SELECT label::BIGINT AS label, round({_sum_by_position('arg_min(embedding, vec_id)')}, 5) AS checksum
        FROM embeddings GROUP BY label""",
    "encode_documents": fingerprint(DOCS, "id AS doc_id, 'hashing-384-whole' AS model", DOCS),
    "encode_documents_token_limit": fingerprint(DOCS, "id AS doc_id", DOCS, limit=512),
    "encode_queries": PREFIXED,
    "embed_query_text_literal": PREFIXED,
    "encode_composed_text": fingerprint(PRODUCTS, "id", PRODUCTS),
    "encode_batch": "WITH " + ", ".join(
        hashed(f"h{i}", f"SELECT p_partkey AS id, {c} AS text FROM part") + f", {prints(f'h{i}')}"
        for i, c in ((0, "p_name"), (1, "p_type"), (3, "p_brand"))
    ) + """ SELECT p_partkey, 4::BIGINT AS n, round(coalesce(h0_f.checksum, 0.0::DOUBLE), 6) AS checksum_0,
        round(coalesce(h1_f.checksum, 0.0::DOUBLE), 6) AS checksum_1, 0.0::DOUBLE AS checksum_2,
        round(coalesce(h3_f.checksum, 0.0::DOUBLE), 6) AS checksum_3
        FROM part LEFT JOIN h0_f ON h0_f.id = p_partkey LEFT JOIN h1_f ON h1_f.id = p_partkey
        LEFT JOIN h3_f ON h3_f.id = p_partkey""",
    "embed_text_literal": f"""WITH {hashed('h', "SELECT (conv_id, turn) AS id, text FROM conversations")}, {prints('h')}
        SELECT conv_id, turn, coalesce(nnz, 0) AS nnz, round(coalesce(checksum, 0.0::DOUBLE), 6) AS checksum
        FROM conversations c LEFT JOIN h_f ON h_f.id = (c.conv_id, c.turn)""",
    "text_similarity": f"""WITH {hashed('h', "SELECT (conv_id, turn) AS id, text FROM conversations")},
        dots AS (SELECT a.id, sum(a.u * b.u) AS s FROM h_u a JOIN h_u b
                 ON b.id = (a.id[1], a.id[2] + 1) AND a.b = b.b GROUP BY a.id)
        SELECT c.conv_id, c.turn, round(round(coalesce(s, 0.0::DOUBLE), 9), 6) AS similarity
        FROM conversations c JOIN conversations n ON n.conv_id = c.conv_id AND n.turn = c.turn + 1
        LEFT JOIN dots ON dots.id = (c.conv_id, c.turn)""",
    "sql_functions": f"""WITH {text_scores('SELECT item_id AS id, text FROM benchmark', SEARCH_TEXT)}
        SELECT id AS item_id, 'hashing-384-whole' AS model, 384::BIGINT AS dim, round(s::FLOAT::DOUBLE, 4) AS score
        FROM scored""",
    "search_topk": f"SELECT vec_id, label, round(s, 6) AS score FROM ({ONE}) ORDER BY s DESC, vec_id LIMIT 5",
    "search_threshold": f"SELECT vec_id, label, round(s, 6) AS score FROM ({ONE}) WHERE s > {THRESHOLD}",
    "search_filtered": f"SELECT vec_id, label, round(s, 6) AS score FROM ({ONE}) WHERE label = 2 ORDER BY s DESC, vec_id LIMIT 5",
    "search_distance": f"SELECT vec_id, round(s, 6) AS similarity FROM ({ONE}) ORDER BY s DESC, vec_id LIMIT 5",
    "search_documents": f"""WITH {text_scores(DOCS, SEARCH_TEXT)}
        SELECT doc_id, lang, round(s, 6) AS score FROM documents JOIN scored ON id = doc_id ORDER BY s DESC, doc_id LIMIT 10""",
    "search_products": f"""WITH {text_scores(PRODUCTS, PRODUCT_TEXT)}
        SELECT id, p_name AS name, p_type AS description, p_retailprice AS price, round(s, 6) AS similarity
        FROM part JOIN scored ON id = p_partkey ORDER BY s DESC, id LIMIT 5""",
    "search_products_by_category": f"""WITH {text_scores(PRODUCTS, PRODUCT_TEXT)}
        SELECT id, p_name AS name, p_retailprice AS price, round(s, 6) AS similarity
        FROM part JOIN scored ON id = p_partkey WHERE p_brand = 'Brand#2' ORDER BY s DESC, id LIMIT 5""",
    "chunk_documents": f"""SELECT *, '{{"type":"chunk","parent_id":' || parent_id || '}}' AS metadata FROM ({CHUNKS})""",
    "chunk_parents": """SELECT doc_id AS id, lang AS title, length(text) AS n_chars, source, '{"type":"parent"}' AS metadata
        FROM documents""",
    "rag_search": f"""WITH chunks AS ({CHUNKS}),
        {text_scores("SELECT id, title || ' ' || content AS text FROM chunks", SEARCH_TEXT)}
        SELECT id, title, content, source, round(s, 6) AS similarity FROM chunks JOIN scored USING (id)
        ORDER BY s DESC, id LIMIT 5""",
    "rag_search_with_context": f"""WITH chunks AS ({CHUNKS}),
        {text_scores("SELECT id, title || ' ' || content AS text FROM chunks", SEARCH_TEXT)},
        hits AS (SELECT c.*, s FROM chunks c JOIN scored USING (id) ORDER BY s DESC, id LIMIT 3)
        SELECT h.id AS chunk_id, h.title, string_agg(c.content, ' ' ORDER BY c.chunk_index) AS combined_content,
               h.source, round(h.s, 6) AS similarity
        FROM hits h LEFT JOIN chunks c ON c.parent_id = h.parent_id
             AND c.chunk_index BETWEEN h.chunk_index - 1 AND h.chunk_index + 1
        GROUP BY h.id, h.title, h.source, h.s""",
    "knn_join": KNN,
    "rank_of": RANK_OF,
    "sql_vector_search": f"SELECT vec_id, round(s, 6) AS similarity FROM ({ONE}) ORDER BY s DESC, vec_id LIMIT 5",
    "ann_ivf_full_probe": KNN,
    "knn_join_bounded": KNN,
    "ann_filtered": KNN_WHERE,
    "ann_ivf": IVF,
    "ann_lsh": LSH,
    "eval_per_query": f"""WITH {TRUTH}, {evaluated('e', 384)}
        SELECT query, expected_doc, rank_of_expected, round(score, 4) AS score, round(margin, 4) AS margin_over_best_wrong FROM e""",
    "eval_summary": f"WITH {TRUTH}, {evaluated('e', 384)} {summary('e', 'hashing-384-whole')}",
    "compare_models": f"""WITH {TRUTH}, {evaluated('x', 384)}, {evaluated('y', 64)}
        SELECT query, x.rank_of_expected AS rank_a, y.rank_of_expected AS rank_b,
               y.rank_of_expected - x.rank_of_expected AS rank_delta, round(x.score, 4) AS score_a,
               round(y.score, 4) AS score_b, round(y.score - x.score, 4) AS score_delta
        FROM x FULL JOIN y USING (query)""",
    "compare_summaries": f"""WITH {TRUTH}, {evaluated('x', 384)}, {evaluated('y', 64)},
        a AS ({summary('x', 'hashing-384-whole')}), b AS ({summary('y', 'hashing-64-whole')})
        SELECT a.model AS model_a, b.model AS model_b, {_measures()} FROM a, b""",
    "backfill_missing": kept_or_encoded(DOCS, "d.lang <> 'en'"),
    "reembed_stale": kept_or_encoded(DOCS, "d.lang NOT IN ('fr', 'de')", ", 'hashing-384-whole' AS model"),
    "upsert_embeddings": kept_or_encoded(UPSERTED, "d.lang NOT IN ('en', 'fr')", ", d.lang"),
    "upsert_if_null": kept_or_encoded(UPSERTED, "d.lang <> 'fr'", ", d.lang"),
    "append_ignore_conflicts": """SELECT doc_id, lang, least(source, 'again ' || source) AS source FROM documents
        WHERE lang NOT IN ('en', 'fr')""",
    "upsert_partial_columns": f"""SELECT doc_id, lang, CASE WHEN lang = 'de' THEN 'moved' ELSE source END AS source,
        length(text) AS n_chars, {MARK_NNZ}::BIGINT AS nnz, {MARK_SUM} AS checksum FROM documents""",
    "append_null_keys": """SELECT CASE WHEN lang <> 'fr' THEN doc_id END AS doc_id, source FROM documents
        WHERE lang = 'fr' OR doc_id % 2 <> 0""",
    "source_lookup": "SELECT doc_id, lang FROM documents WHERE source = 'src3'",
    "column_defaults": """SELECT doc_id, CASE WHEN lang <> 'en' THEN source ELSE 'unknown' END AS source, '{}' AS metadata,
        0::BIGINT AS chunk_index, true AS dated FROM documents""",
    "append_rows": "SELECT doc_id, lang, source FROM documents",
    "latest_changes": "SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role FROM conversations GROUP BY conv_id",
    "replace_table": fingerprint(DOCS, "id AS doc_id", DOCS),
    "add_vector_column": f"SELECT vec_id, 64::BIGINT AS dim, round({_sum_by_position('embedding')}, 5) AS checksum FROM embeddings",
    "embedding_status": """WITH c AS (SELECT count(*) AS n, count_if(embedding IS NULL) AS missing,
            count_if(len(list_filter(embedding, lambda x: x IS NULL)) > 0) AS null_elements,
            count_if(len(embedding) <> 64) AS wrong_dimension,
            count_if(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x <> 0)) = 0) AS zero_vectors FROM embeddings)
        SELECT 'embeddings' AS component, CASE WHEN n > 0 THEN 'ready' ELSE 'empty' END AS status, n || ' rows' AS details FROM c
        UNION ALL SELECT 'model', 'configured', 'table-64'
        UNION ALL SELECT 'dimension', 'configured', '64 dimensions'
        UNION ALL SELECT 'missing', CASE WHEN missing = 0 THEN 'ok' ELSE 'check' END, missing || ' rows' FROM c
        UNION ALL SELECT 'null_elements', CASE WHEN null_elements = 0 THEN 'ok' ELSE 'check' END, null_elements || ' rows' FROM c
        UNION ALL SELECT 'wrong_dimension', CASE WHEN wrong_dimension = 0 THEN 'ok' ELSE 'check' END, wrong_dimension || ' rows' FROM c
        UNION ALL SELECT 'zero_vectors', CASE WHEN zero_vectors = 0 THEN 'ok' ELSE 'check' END, zero_vectors || ' rows' FROM c
        UNION ALL SELECT 'stale_model', 'ok', '0 rows'""",
    "metadata_filter": "SELECT event_id, event_type FROM events WHERE json_extract_string(props, '$.k') = '7'",
    "stream_embed": fingerprint(DOCS, "id AS doc_id", DOCS),
    "stream_upsert_out_of_order": f"""WITH {hashed('h', DOCS)}, {prints('h')}
        SELECT d.doc_id, d.lang, coalesce(nnz, 0) AS nnz, round(coalesce(checksum, 0.0::DOUBLE), 6) AS checksum
        FROM documents d LEFT JOIN h_f ON h_f.id = d.doc_id""",
    "stream_upsert": f"""WITH {hashed('h', EDITED_TWICE)}, {prints('h')}
        SELECT d.doc_id, d.lang, coalesce(nnz, 0) AS nnz, round(coalesce(checksum, 0.0::DOUBLE), 6) AS checksum
        FROM documents d LEFT JOIN h_f ON h_f.id = d.doc_id""",
    "stream_upsert_watched": f"""WITH {hashed('h', EDITED_TWICE.replace("'en'", "'fr'"))}, {prints('h')}
        SELECT d.doc_id, d.lang, CASE WHEN d.lang = 'en' THEN 'moved' ELSE d.source END AS source,
               CASE WHEN d.lang = 'fr' THEN 2::BIGINT ELSE 1::BIGINT END AS vector_version,
               coalesce(nnz, 0) AS nnz, round(coalesce(checksum, 0.0::DOUBLE), 6) AS checksum
        FROM documents d LEFT JOIN h_f ON h_f.id = d.doc_id""",
}
ORACLE["rag_stored_context"] = ORACLE["rag_search_with_context"]
ORACLE["search_documents_postings"] = ORACLE["search_documents"]
ORACLE["upsert_bucketed"] = ORACLE["upsert_embeddings"]
for _name in ("search_products", "search_products_by_category", "rag_search", "rag_search_with_context"):
    ORACLE[f"sql_{_name}"] = ORACLE[_name]
ORACLE["sql_chunk_text"] = f"SELECT parent_id AS doc_id, chunk_index, content AS chunk FROM ({CHUNKS})"
ORACLE["encode_warnings"] = f"""WITH x AS (SELECT doc_id AS id, CASE WHEN lang = 'fr' THEN '' WHEN lang <> 'de' THEN text END AS text FROM documents),
    {hashed('h', 'SELECT id, text FROM x')}
    SELECT count(*) AS rows, count_if(text IS NULL)::BIGINT AS null_texts, count_if(text = '')::BIGINT AS empty_texts,
           count_if(text IS NOT NULL AND id NOT IN (SELECT id FROM h))::BIGINT AS zero_vectors FROM x"""
ORACLE["similarity_warnings"] = """SELECT count(*) AS rows, count_if(label = 3)::BIGINT AS missing,
    count_if(label = 1)::BIGINT AS unequal_lengths, count_if(label = 2)::BIGINT AS zero_vectors FROM embeddings"""
