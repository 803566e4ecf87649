"""Time the registered queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` an
optional comma-separated choice.  Every query is executed in full (all rows and
columns, to a sink that drops them); ``value`` is the sum over all queries.
Before it is timed, each query runs once on the smallest data beside the given
ones, so that no query pays for starting code paths that others share.
``measures`` has rates and retrieval quality, taken after the timed runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vecloom.plans.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("vecloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def measures(spark: SparkSession, seconds: dict[str, float]) -> dict[str, float]:
    """Encoding rows and kNN pairs per second, recall of the approximate searches, MRR of the evaluation."""
    out: dict[str, float] = {}
    count = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for t in ("documents", "embeddings")}
    if "encode_documents" in seconds:
        out["encoded_rows_per_s"] = round(count["documents"] / seconds["encode_documents"], 1)
    if "knn_join" in seconds:
        out["knn_pairs_per_s"] = round(count["embeddings"] ** 2 / seconds["knn_join"], 1)
        exact = {(r["q"], r["id"]) for r in QUERIES["knn_join"](spark, SF_DIR).collect()}
        for name in ("ann_ivf", "ann_lsh", "ann_graph", "ann_pq"):
            if name in seconds:
                found = {(r["q"], r["id"]) for r in QUERIES[name](spark, SF_DIR).collect()}
                out[f"{name}_recall_at_5"] = round(len(found & exact) / len(exact), 4)
                out[f"{name}_speedup"] = round(seconds["knn_join"] / seconds[name], 3)
    if "eval_summary" in seconds:
        out["mrr"] = QUERIES["eval_summary"](spark, SF_DIR).first()["mrr"]
    return out


def main() -> None:
    spark = session()
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else list(QUERIES)
    small = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    seconds = {}
    for name in names:
        if os.path.isdir(small):
            run(QUERIES[name](spark, small))
        start = time.perf_counter()
        run(QUERIES[name](spark, SF_DIR))
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds,
                      "measures": measures(spark, seconds),
                      "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
