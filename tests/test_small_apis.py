"""Small public entry points: keep_latest, cluster, namespaces."""

from pyspark.sql import functions as F

from strata.operators import keep_latest
from strata.tables import cluster, list_namespaces


def test_keep_latest_with_tie_break(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 2, "z"), ("k", 2, "a"), ("j", 0, "x")],
                               "key string, ts int, v string")
    got = {r.key: (r.ts, r.v) for r in keep_latest(df, ["key"], "ts", tie_break=["v"]).collect()}
    assert got == {"k": (2, "a"), "j": (0, "x")}


def test_cluster_plan_is_range_partitioned_and_sorted(spark):
    df = spark.range(100).withColumn("d", (F.col("id") * 37 % 100).cast("int"))
    plan = cluster(df, ["d"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(d" in plan and "Sort [d" in plan


def test_list_namespaces(spark):
    assert "default" in [r[0] for r in list_namespaces(spark).collect()]
