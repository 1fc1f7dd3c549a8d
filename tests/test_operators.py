"""Operators against Spark built-ins and hand-computed results."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import (category_breakdown, dedup, distinct_counts, exact_percentile,
                              global_dense_rank, group_stats, premium, profile, ranked_groups,
                              top_dense_rank)


def _hot_frame(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        # key "hot" holds a third of all rows; one null key group
        k = "hot" if i % 3 == 0 else (None if i % 97 == 0 else f"k{i % 11}")
        rows.append((k, float(rng.randint(0, 500)) / 4, i))
    return spark.createDataFrame(rows, "k string, v double, id int")


def test_exact_percentile_matches_builtin(spark):
    df = _hot_frame(spark)
    for p in (0.0, 0.25, 0.5, 0.9, 1.0):
        got = {r.k: r.x for r in exact_percentile(df, ["k"], "v", p, out="x").collect()}
        exp = {r.k: r.y for r in df.groupBy("k").agg(F.percentile("v", p).alias("y")).collect()}
        assert got == exp


def test_exact_percentile_global_and_rounded(spark):
    df = spark.createDataFrame([(1.01,), (1.02,), (5.0,), (7.0,)], "v double")
    assert exact_percentile(df, [], "v", 0.5, out="m").collect()[0].m == 3.01
    df2 = spark.createDataFrame([(258168.42,), (258168.43,)], "v double")
    assert exact_percentile(df2, [], "v", 0.5, out="m", digits=2).collect()[0].m == 258168.43


def test_dedup_survivor_is_deterministic(spark):
    df = _hot_frame(spark)
    a = dedup(df, ["k"], [F.col("v").desc(), F.col("id").asc()])
    b = dedup(df.repartition(7), ["k"], [F.col("v").desc(), F.col("id").asc()])
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}
    assert a.count() == df.select("k").distinct().count()


def test_dedup_plan_limits_before_shuffle(spark):
    df = _hot_frame(spark)
    plan = dedup(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_global_dense_rank_matches_window(spark):
    rng = random.Random(3)
    rows = [(i, None if i % 50 == 0 else float(rng.randint(0, 40))) for i in range(800)]
    df = spark.createDataFrame(rows, "id int, v double")
    got = {r.id: r.r for r in global_dense_rank(df, "v", out="r").collect()}
    exp = {r.id: r.r for r in df.withColumn(
        "r", F.dense_rank().over(Window.orderBy(F.col("v").desc()))).collect()}
    assert got == exp
    top = {r.id for r in top_dense_rank(df, "v", 5, out="r").collect()}
    assert top == {i for i, r in exp.items() if r <= 5}


def _jobs_before_an_action(spark, build):
    """(frame, Spark jobs that building it has run)."""
    spark.sparkContext.setJobGroup("build", "build")
    df = build()
    df._jdf.queryExecution().executedPlan()
    ran = spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("rest", "rest")
    return df, list(ran)


def test_global_dense_rank_is_one_lazy_plan(spark):
    rows = spark.range(1000).withColumn("v", (F.col("id") % 37).cast("double"))
    df, ran = _jobs_before_an_action(spark, lambda: global_dense_rank(rows.groupBy("id").agg(F.max("v").alias("v")), "v"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    # no job and no written table before the caller's action; the only window
    # over the values is row_number() within a range
    assert not ran and "dense_rank" not in plan and "Scan parquet" not in plan
    assert "row_number() windowspecdefinition(_b" in plan
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_global_dense_rank_of_few_and_of_no_values(spark):
    from pyspark.sql import Window
    for values in ([], [None, None], [5.0], [5.0, 5.0, None, -1.0], [float(k % 400) for k in range(1200)]):
        df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id int, v double")
        for down in (True, False):
            order = F.col("v").desc_nulls_last() if down else F.col("v").asc_nulls_last()
            want = {r.id: r.r for r in df.withColumn("r", F.dense_rank().over(Window.orderBy(order))).collect()}
            for ranges in (1, 7, 256):
                got = global_dense_rank(df, "v", out="r", descending=down, ranges=ranges)
                assert {r.id: r.r for r in got.collect()} == want


def test_exact_percentile_by_bracket(spark):
    hot = spark.range(60000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"),
                                    (F.rand(5) * 1000 - 300).alias("v"))
    same = spark.range(5000).select(F.lit("same").alias("k"), F.lit(7.0).alias("v"))
    few = spark.createDataFrame([(None, 1.0), (None, 4.0), (None, None), ("one", 3.0), ("none", None)], "k string, v double")
    two = spark.range(4001).select(F.lit("two").alias("k"), (F.col("id") % 2).cast("double").alias("v"))
    df = hot.unionByName(same).unionByName(few).unionByName(two)
    for p in (0.0, 0.01, 0.25, 0.5, 0.9, 1.0):
        want = {r.k: r.m for r in df.groupBy("k").agg(F.percentile("v", F.lit(p)).alias("m")).collect() if r.m is not None}
        got, ran = _jobs_before_an_action(spark, lambda: exact_percentile(df, ["k"], "v", p))
        assert not ran
        found = {r.k: r.percentile for r in got.collect()}
        assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-9 for k in want)
        (one,) = exact_percentile(df, [], "v", p).collect()
        assert abs(one[0] - df.agg(F.percentile("v", F.lit(p))).first()[0]) < 1e-9
    assert exact_percentile(df.limit(0), ["k"], "v", 0.5).count() == 0


def test_group_stats_labels_null_keys(spark):
    df = spark.createDataFrame([("a", None, 10.0, 1.0), ("a", "x", 20.0, 3.0),
                                (None, "x", 30.0, 5.0)],
                               "e string, g string, v double, s double")
    rows = group_stats(df, ["e", "g"], "v", "s").collect()
    by = {(r.stat_type, r.e, r.g): r for r in rows}
    assert by[("e", None, None)].record_count == 1      # the real null education group
    assert by[("e", "a", None)].avg_salary == 15.0
    assert by[("g", None, None)].record_count == 1      # the real null gender group
    assert by[("g", None, "x")].record_count == 2


def test_profile_quartiles_ordered(spark):
    df = _hot_frame(spark)
    for r in profile(df, ["k"], "v").collect():
        assert r.q1_v <= r.median_v <= r.q3_v
        assert r.iqr_v == r.q3_v - r.q1_v


def test_category_breakdown_sum_equals_total(spark):
    df = _hot_frame(spark).withColumn("cat", (F.col("id") % 4).cast("string"))
    out = category_breakdown(df, "k", "cat", list_name="cats").collect()
    counts = {r.k: r.c for r in df.groupBy("k").agg(F.count("*").alias("c")).collect()}
    for r in out:
        assert r.total_in_categories == counts[r.k]
        assert r.cats == sorted(r.cats)


def test_premium_multiset(spark):
    df = spark.createDataFrame([("e", "A", 70000.0, 1.0), ("e", "B", 60000.0, 3.0),
                                ("e", "A", 80000.0, 2.0)],
                               "edu string, job string, sal double, yrs double")
    r = premium(df, "edu", "sal", "yrs", "job").collect()[0]
    assert r.sample_size == 3 and r.unique_positions == 2
    assert [(p.job, p.n) for p in r.common_positions] == [("A", 2), ("B", 1)]
    assert r.avg_salary == 70000.0 and r.premium_score == 0.5


def test_ranked_groups_having_and_ties(spark):
    rows = [("two", 1.0)] * 2 + [("three", 5.0)] * 3 + [("tie", 5.0)] * 3 + [("low", 1.0)] * 4
    df = spark.createDataFrame([(k, v, 1.0, "e") for k, v in rows],
                               "job string, sal double, yrs double, edu string")
    got = {r.job: (r.pay_rank, r.salary_stddev) for r in
           ranked_groups(df, "job", "sal", "yrs", "edu").collect()}
    assert set(got) == {"three", "tie", "low"}
    assert got["three"][0] == got["tie"][0] == 1 and got["low"][0] == 2


def test_distinct_counts(spark):
    df = _hot_frame(spark)
    got = {r.k: r.n for r in distinct_counts(df, ["k"], {"n": "v"}).collect()}
    exp = {r.k: r.n for r in df.groupBy("k").agg(F.countDistinct("v").alias("n")).collect()}
    assert got == exp


def test_premium_top_n(spark):
    rows = [("e", j, 1.0, 1.0) for j in "AAABBC"] + [("f", "Z", 2.0, 1.0)]
    df = spark.createDataFrame(rows, "edu string, job string, sal double, yrs double")
    got = {r.edu: [(p.job, p.n) for p in r.common_positions]
           for r in premium(df, "edu", "sal", "yrs", "job", top_n=2).collect()}
    assert got == {"e": [("A", 3), ("B", 2)], "f": [("Z", 1)]}


def test_dedup_default_order_skips_map_columns(spark):
    df = spark.createDataFrame([("k", 2, {"a": 1}), ("k", 1, {"b": 2})],
                               "k string, v int, m map<string,int>")
    assert [r.v for r in dedup(df, ["k"]).collect()] == [1]


def test_top_dense_rank_includes_nulls_within_k(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 1.0), (3, None), (4, 2.0)], "id int, v double")
    got = {r.id: r.r for r in top_dense_rank(df, "v", 5, out="r").collect()}
    assert got == {1: 1, 4: 1, 2: 2, 3: 3}
    got2 = {r.id: r.r for r in top_dense_rank(df, "v", 2, out="r").collect()}
    assert got2 == {1: 1, 4: 1, 2: 2}


def test_means_and_medians_of_values_beyond_the_decimal_do_not_raise(spark):
    from pyspark.sql import functions as F

    from strata.functions.numeric import rounded_mean
    from strata.operators import gap_overview, premium
    inf, nan = float("inf"), float("nan")
    rows = [("big", "j", 1e30, 1.0), ("big", "k", 5.0, 1.0), ("nines", "j", float("9" * 30), 2.0),
            ("nan", "j", nan, 1.0), ("nan", "j", 3.0, 1.0), ("inf", "j", inf, 1.0),
            ("fine", "j", 1.005, 1.0), ("none", "j", None, None)]
    df = spark.createDataFrame(rows, "g string, job string, v double, s double")
    plain = {r.g: r.m for r in df.groupBy("g").agg(F.round(F.avg("v"), 2).alias("m")).collect()}
    ours = {r.g: r.m for r in df.groupBy("g").agg(rounded_mean("v").alias("m")).collect()}
    two = {r.g: r.avg_salary for r in premium(df, "g", "v", "s", "job").collect()}
    med = {r.g: r.median_salary for r in
           gap_overview(df, "g", "v", "s", distinct={"jobs": "job"}).collect()}
    for got in (ours, two):
        assert {k: str(x) for k, x in got.items()} == {
            k: "1.01" if k == "fine" else str(x) for k, x in plain.items()}
    assert med["big"] == 5e29 and med["inf"] == inf and med["none"] is None
