"""Benchmark: wall time of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full through the ``noop`` sink (no collect to the
driver): one warm-up run, then the median of three timed runs. Prints one
JSON line: {"metric", "value" (sum of medians), "unit", "queries", "direct" (the
plainest built-in form of some of them, not in the sum), "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from strata.plans.queries import QUERIES  # noqa: E402
from strata.session import get_session  # noqa: E402

HEADLINE = [
    "customer_stats", "article_stats", "cross_metrics",
    "salary_silver", "salary_group_stats", "experience_trends", "education_impact",
    "gender_pay_overview", "job_title_analysis", "industry_benchmarks",
    "dedup", "upsert_latest", "group_stats", "gap_overview", "benchmarks", "ranked_groups",
    "profile", "diversity", "premium", "top_ranked",
]


def _lines(spark, d):
    return spark.read.parquet(f"{d}/lineitem.parquet")


def _stats(*more):
    return [F.avg("l_extendedprice"), F.avg("l_quantity"), F.count(F.lit(1)), F.min("l_extendedprice"),
            F.max("l_extendedprice"), *more]


def _direct_ranked(spark, d):
    groups = _lines(spark, d).groupBy("l_suppkey").agg(*_stats(
        F.countDistinct("l_returnflag"), F.stddev("l_extendedprice")))
    return groups.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("avg(l_extendedprice)").desc())))


def _direct_upsert(spark, d):
    newest = Window.partitionBy("user_id", "event_type").orderBy(F.col("value").desc(), F.col("event_id").desc())
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "event_type", "value")
    return e.withColumn("r", F.row_number().over(newest)).where("r = 1")


#: The plainest built-in form of the same work, to compare with: double means, Spark's
#: own median, one window over all groups.
DIRECT = {
    "group_stats": lambda spark, d: _lines(spark, d).groupingSets(
        [["l_returnflag"], ["l_linestatus"], ["l_suppkey"]], "l_returnflag", "l_linestatus", "l_suppkey").agg(*_stats()),
    "ranked_groups": _direct_ranked,
    "upsert_latest": _direct_upsert,
    "gap_overview": lambda spark, d: _lines(spark, d).groupBy("l_returnflag").agg(*_stats(
        F.countDistinct("l_suppkey"), F.countDistinct("l_partkey"), F.median("l_extendedprice"))),
    "benchmarks": lambda spark, d: _lines(spark, d).agg(*_stats(
        F.countDistinct("l_suppkey"), F.countDistinct("l_partkey"), F.countDistinct("l_returnflag"),
        F.median("l_extendedprice"), F.stddev("l_extendedprice"))),
}


def timed(fn, spark, sf_dir: str, runs: int) -> float:
    samples = []
    for i in range(runs + 1):
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        if i > 0:
            samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = get_session(f"local[{cpus}]", app="strata-bench", shuffle_partitions=cpus,
                        extra={"spark.ui.enabled": "false", "spark.driver.memory": "16g",
                               "spark.sql.files.maxPartitionBytes": str(64 << 20)})
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    for name in names:
        timings[name] = timed(QUERIES[name], spark, sf_dir, runs)
        print(f"# {name}: {timings[name]:.3f}s", file=sys.stderr)
    direct = {n: timed(fn, spark, sf_dir, runs) for n, fn in DIRECT.items() if n in timings}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "direct": direct,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
