import vecloom.functions as V
from vecloom.plans import queries
from vecloom.streaming import embed

SPEC = V.EncoderSpec(name="small", dim=8)
MARK = [0.5] * 8


def encoded(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in df.orderBy("i").select(V.embed_encode("text", SPEC)).collect()]


def test_appends_keep_supplied_vectors_and_resume(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "id int, text string, embedding array<float>"

    def run():
        stream = embed.stream_embed(spark.readStream.schema(schema).parquet(source), "text", SPEC)
        embed.write_appends(stream, out, check, once=True).awaitTermination()
        return {r["id"]: r["embedding"] for r in spark.read.parquet(out).collect()}

    a, b, c = encoded(spark, "a", "b", "c")
    spark.createDataFrame([(1, "a", None), (2, "b", MARK)], schema).write.parquet(source)
    assert run() == {1: a, 2: MARK}
    spark.createDataFrame([(3, "c", None), (4, None, None)], schema).write.mode("append").parquet(source)
    assert run() == {1: a, 2: MARK, 3: c, 4: None}
    assert spark.read.parquet(out).count() == 4


def test_upserts_take_the_last_change_and_replay_safely(spark, tmp_path):
    source, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    schema = "id int, text string, seq int"

    def run(checkpoint):
        stream = spark.readStream.schema(schema).parquet(source)
        embed.stream_upsert(stream, table, checkpoint, key="id", text="text", order_by="seq", spec=SPEC, once=True).awaitTermination()
        return {r["id"]: (r["text"], r["embedding"]) for r in embed.read_upserts(spark, table, "id", "seq").collect()}

    a, c, d = encoded(spark, "a", "c", "d")
    spark.createDataFrame([(1, "a", 1), (2, "b", 1), (2, "c", 2)], schema).coalesce(1).write.parquet(source)
    assert run(check) == {1: ("a", a), 2: ("c", c)}
    spark.createDataFrame([(1, "d", 3)], schema).coalesce(1).write.mode("append").parquet(source)
    want = {1: ("d", d), 2: ("c", c)}
    assert run(check) == want
    # A batch that runs again overwrites its own folder.
    spark.read.parquet(table)  # batches 0 and 1
    assert spark.read.parquet(table).select("batch_id").distinct().count() == 2
    target = str(tmp_path / "compacted")
    embed.compact(spark, table, target, "id", "seq")
    got = {r["id"]: (r["text"], r["embedding"]) for r in embed.read_upserts(spark, target, "id", "seq").collect()}
    assert got == want


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    schema = "id int, text string, seq int"
    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], schema).write.parquet(source)
    for attempt in range(2):
        stream = spark.readStream.schema(schema).parquet(source)
        embed.stream_upsert(stream, table, str(tmp_path / f"check{attempt}"), key="id", text="text", order_by="seq",
                            spec=SPEC, once=True).awaitTermination()
        assert spark.read.parquet(table).count() == 2


def test_embedding_a_stream_needs_no_state_or_shuffle(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "a")], "id int, text string").write.parquet(source)
    batch = embed.stream_embed(spark.read.parquet(source), "text", SPEC)
    assert "Exchange" not in batch._jdf.queryExecution().executedPlan().toString()


def test_a_late_change_loses_and_brought_vectors_stay(spark, tmp_path):
    source, table, check = (str(tmp_path / n) for n in ("in", "table", "check"))
    schema = "id int, text string, seq int, embedding array<float>, model string"
    for rows in ([(1, "a", 5, None, None), (2, "b", 1, MARK, "theirs")], [(1, "too late", 2, None, None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        embed.stream_upsert(stream, table, check, key="id", text="text", order_by="seq", spec=SPEC, mode="if_null",
                            once=True).awaitTermination()
    (a,) = encoded(spark, "a")
    got = {r["id"]: (r["text"], r["embedding"], r["model"]) for r in embed.read_upserts(spark, table, "id", "seq").collect()}
    assert got == {1: ("a", a, SPEC.name), 2: ("b", MARK, "theirs")}


def test_stream_embed_reads_a_table_of_several_files(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "doc_id long, text string")
    rows.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    found = {tuple(r) for r in queries.stream_embed(spark, str(tmp_path / "many")).collect()}
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    (part,) = (tmp_path / "one").glob("*.parquet")
    (tmp_path / "file").mkdir()
    (tmp_path / "file" / "documents.parquet").write_bytes(part.read_bytes())
    assert len(found) == 6
    assert {tuple(r) for r in queries.stream_embed(spark, str(tmp_path / "file")).collect()} == found
