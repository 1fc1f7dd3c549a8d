"""Tables: upserts, partition-scoped upserts, layout, checks after the write."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from strata.tables import (Rows, Unique, check_rows, cluster, create_keyed_table, doubled, ensure_namespace,
                           global_upsert, in_domain, merge_on_read, not_null, observed, read_table,
                           touched_partitions, upsert, upsert_partitions, verify, violations,
                           write_catalog_table, write_table)
from strata.tables.keyed import in_partitions

SCHEMA = "id int, part string, ts int, v string"


def _rows(df):
    return sorted(tuple(r) for r in df.select("id", "part", "ts", "v").collect())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_cases(spark):
    base = spark.createDataFrame([(1, "a", 5, "old"), (2, "a", 5, "keep"), (3, "a", 5, "base")],
                                 SCHEMA)
    changes = spark.createDataFrame([
        (1, "a", 6, "newer"),      # newer row wins
        (2, "a", 4, "late"),       # older late row loses
        (3, "a", 5, "change"),     # equal precombine: the change wins
        (4, "b", 1, "new"),        # new key is inserted
    ], SCHEMA)
    out = upsert(base, changes, ["id"], "ts")
    assert _rows(out) == [(1, "a", 6, "newer"), (2, "a", 5, "keep"), (3, "a", 5, "change"),
                          (4, "b", 1, "new")]
    # idempotent: applying the same batch again changes nothing
    assert _rows(upsert(out, changes, ["id"], "ts")) == _rows(out)
    # replace: only the batch, duplicates inside it collapsed
    dup = changes.unionByName(spark.createDataFrame([(4, "b", 2, "newest")], SCHEMA))
    assert _rows(upsert(base, dup, ["id"], "ts", replace=True))[-1] == (4, "b", 2, "newest")


def test_global_upsert_moves_partition(spark):
    base = spark.createDataFrame([(1, "a", 1, "x"), (2, "a", 1, "y")], SCHEMA)
    moved = spark.createDataFrame([(1, "b", 2, "x2")], SCHEMA)
    out = global_upsert(base, moved, "id", "ts", "part")
    assert _rows(out) == [(1, "b", 2, "x2"), (2, "a", 1, "y")]


def test_upsert_collapses_base_and_ties_in_any_order(spark):
    twice = [(1, "a", 1, "x"), (1, "a", 2, "y"), (2, "a", 1, "p"), (2, "a", 1, "q"), (None, "a", 2, "n")]
    changes = spark.createDataFrame([(3, "a", 2, "c"), (3, "a", 2, "b")], SCHEMA)
    for rows in (twice, twice[::-1]):
        out = upsert(spark.createDataFrame(rows, SCHEMA), changes, ["id"], "ts")
        assert sorted(map(tuple, out.collect()), key=str) == [
            (1, "a", 2, "y"), (2, "a", 1, "p"), (3, "a", 2, "b"), (None, "a", 2, "n")]


def test_merge_on_read_equals_sequential_upserts(spark):
    base = spark.createDataFrame([(i, "p", 1, f"b{i}") for i in range(10)], SCHEMA)
    d1 = spark.createDataFrame([(1, "p", 2, "d1"), (2, "p", 0, "d1-old"), (11, "p", 1, "n")],
                               SCHEMA)
    d2 = spark.createDataFrame([(1, "p", 2, "d2"), (3, "p", 5, "d2")], SCHEMA)
    view = merge_on_read(base, [d1, d2], ["id"], "ts")
    step = upsert(upsert(base, d1, ["id"], "ts"), d2, ["id"], "ts")
    assert _rows(view) == _rows(step)
    # re-applying the last delta changes nothing
    assert _rows(merge_on_read(step, [d2], ["id"], "ts")) == _rows(step)


# partition-scoped upsert

def _files(spark, name):
    root = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first().data_type
    found = glob.glob(root.removeprefix("file:") + "/**/*.parquet", recursive=True)
    return {f: os.stat(f).st_mtime_ns for f in found}


def _of(files, part):
    return {f: t for f, t in files.items() if f"part={part}/" in f}


@pytest.fixture()
def keyed(spark, tmpdir_path):
    space = f"keyed_{time.time_ns()}"
    ensure_namespace(spark, space, root=tmpdir_path)
    rows = [(k, "abcd"[k % 4], 1, f"v{k}") for k in range(40)] + [(100, "lone", 1, "x"), (7, "d", 0, "older")]
    base = spark.createDataFrame(rows, SCHEMA).select("id", "ts", "v", "part")
    create_keyed_table(base, f"{space}.t", ["id"], "ts", ["part"])
    return f"{space}.t", base


def test_partition_upsert_equals_the_whole_upsert_and_leaves_other_files(spark, keyed):
    name, base = keyed
    assert _rows(spark.table(name)) == _rows(upsert(None, base, ["id"], "ts"))
    before = _files(spark, name)
    changes = spark.createDataFrame([(0, "b", 2, "moved"), (4, "a", 0, "late"), (100, "b", 2, "left alone"), (500, "new's", 1, "n"),
                                     (500, "b", 0, "older")], SCHEMA).select("id", "ts", "v", "part")
    want = _rows(upsert(upsert(None, base, ["id"], "ts"), changes, ["id"], "ts"))
    touched = {r.part for r in touched_partitions(spark.table(name), changes, ["id"], ["part"])}
    assert touched == {"a", "b", "lone", "new's"}
    assert upsert_partitions(spark, name, changes, ["id"], "ts", ["part"]) == 4
    spark.catalog.refreshTable(name)
    assert _rows(spark.table(name)) == want
    after = _files(spark, name)
    assert _of(after, "c") == _of(before, "c") and _of(after, "d") == _of(before, "d") and _of(before, "c")
    assert _of(after, "a").keys() != _of(before, "a").keys() and not _of(after, "lone")
    # applied again, and with nothing to do
    upsert_partitions(spark, name, changes, ["id"], "ts", ["part"])
    assert _rows(spark.table(name)) == want
    assert upsert_partitions(spark, name, changes.limit(0), ["id"], "ts", ["part"]) == 0
    assert _rows(spark.table(name)) == want
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_partition_upsert_reads_only_the_touched_partitions(spark, keyed):
    name, _ = keyed
    touched = [r for r in spark.table(name).select("part").distinct().collect() if r.part in "ab"]
    plan = _plan(spark.table(name).where(in_partitions(["part"], touched)))
    assert "PartitionFilters: [((part" in plan or "PartitionFilters: [(" in plan
    assert "DataFilters: []" in plan
    assert spark.table(name).where(in_partitions(["part"], touched)).inputFiles().__len__() < len(_files(spark, name))


def test_partition_upsert_with_the_partition_in_the_key(spark, tmpdir_path):
    space = f"inkey_{time.time_ns()}"
    ensure_namespace(spark, space, root=tmpdir_path)
    base = spark.createDataFrame([(1, 1, "x", 2023), (1, 1, "y", 2024), (2, 1, "z", None)], "id int, ts int, v string, year int")
    create_keyed_table(base, f"{space}.t", ["id", "year"], "ts", ["year"])
    changes = spark.createDataFrame([(1, 2, "y2", 2024), (2, 3, "z2", None)], base.schema)
    assert {r.year for r in touched_partitions(spark.table(f"{space}.t"), changes, ["id", "year"], ["year"])} == {2024, None}
    upsert_partitions(spark, f"{space}.t", changes, ["id", "year"], "ts", ["year"])
    got = {(r.id, r.year): r.v for r in spark.table(f"{space}.t").collect()}
    assert got == {(1, 2023): "x", (1, 2024): "y2", (2, None): "z2"}


# files

def test_partition_values_keep_their_type_and_reads_prune(spark, tmpdir_path):
    df = spark.createDataFrame([(i, "01" if i % 2 else "b", i, "v") for i in range(20)], SCHEMA)
    path = os.path.join(tmpdir_path, "t")
    write_table(df, path, ["part"], sort_within=["ts desc"])
    back = read_table(spark, path, df.schema)
    assert _rows(back) == _rows(df) and dict(back.dtypes)["part"] == "string"
    q = read_table(spark, path, df.schema, columns=["id", "part"]).where(F.col("part") == "01").select("id")
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(part" in plan and "EqualTo(part" not in plan
    assert "ReadSchema: struct<id:int>" in plan and q.count() == 10
    (one,) = glob.glob(f"{path}/part=b/*.parquet")
    assert [r.ts for r in spark.read.parquet(one).collect()] == list(range(18, -1, -2))


def test_target_file_size_rebalances_writes(spark, tmpdir_path):
    df = spark.range(0, 20000, numPartitions=8).select(
        F.col("id").cast("int").alias("id"), F.lit("p").alias("part"),
        F.col("id").cast("int").alias("ts"), F.lit("v").alias("v"))
    n = {}
    for name, options in (("plain", {"rebalance": False}), ("big", {"target_file_bytes": 256 << 20, "dictionary": False}),
                          ("cut", {"max_records_per_file": 5000})):
        write_table(df, os.path.join(tmpdir_path, name), **options)
        n[name] = len(glob.glob(os.path.join(tmpdir_path, name, "*.parquet")))
        assert _rows(read_table(spark, os.path.join(tmpdir_path, name))) == _rows(df)
    assert n["plain"] == 8 and n["big"] == 1 and n["cut"] >= 4
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) != str(256 << 20)


def test_layout_rewrite_keeps_rows_and_ranges_apart(spark, tmpdir_path):
    df = spark.range(2000).select((F.col("id") * 7919 % 2000).cast("int").alias("id"),
                                  F.lit("p").alias("part"), F.col("id").cast("int").alias("ts"),
                                  F.lit("v").alias("v"))
    path = os.path.join(tmpdir_path, "l")
    write_table(cluster(df, ["id"]), path, rebalance=False, max_records_per_file=500)
    assert _rows(read_table(spark, path)) == _rows(df)
    ranges = sorted(spark.read.parquet(f).agg(F.min("id"), F.max("id")).first() for f in glob.glob(f"{path}/*.parquet"))
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:])) and len(ranges) >= 4


def test_bucketed_tables_join_without_an_exchange(spark, tmpdir_path):
    space = f"bucketed_{time.time_ns()}"
    ensure_namespace(spark, space, root=tmpdir_path)
    df = spark.range(500).select("id", (F.col("id") % 7).alias("n"))
    for name in ("a", "b"):
        write_catalog_table(df, f"{space}.{name}", bucket_by=["id"], buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(f"{space}.a").join(spark.table(f"{space}.b").withColumnRenamed("n", "m"), "id")
        grouped = spark.table(f"{space}.a").groupBy("id").agg(F.sum("n"))
        assert "Exchange" not in _plan(joined) and "Exchange" not in _plan(grouped)
        assert joined.count() == grouped.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    with pytest.raises(ValueError):
        write_catalog_table(df, f"{space}.c", bucket_by=["id"])


# checks

def test_checks_count_what_breaks_them(spark):
    df = spark.createDataFrame([(1, "a", 1, "x"), (1, "a", 2, "x"), (2, None, 3, "y"), (None, "q", 4, None), (None, "b", 5, "z")], SCHEMA)
    checks = [Rows(1, 4), Rows(5), Unique(("id",)), Unique(("ts",)), not_null("part"), not_null("part", most=0.2),
              in_domain("part", ["a", "b"])]
    got = [(r.check_name, r.n_rows, r.n_bad, r.passed) for r in check_rows(df, checks).collect()]
    assert got == [("rows", 5, 0, False), ("rows", 5, 0, True), ("unique(id)", 5, 2, False), ("unique(ts)", 5, 0, True),
                   ("not_null(part)", 5, 1, False), ("not_null(part)", 5, 1, True), ("domain(part)", 5, 1, False)]
    assert [(r.ts, r.broken_checks) for r in violations(df, checks).orderBy("ts").collect()] == [
        (3, ["not_null(part)", "not_null(part)"]), (4, ["domain(part)"])]
    assert sorted(map(tuple, doubled(df, ["id"]).collect()), key=str) == [(1, 2), (None, 2)]
    empty = check_rows(df.limit(0), [Rows(1), Unique(("id",)), not_null("v")]).collect()
    assert [(r.n_rows, r.n_bad, r.passed) for r in empty] == [(0, 0, False), (0, 0, True), (0, 0, True)]


def test_verify_compares_what_was_written(spark, tmpdir_path):
    df = spark.createDataFrame([(k, "a", k, None) for k in range(100)], SCHEMA).repartition(5)
    path = os.path.join(tmpdir_path, "t")
    seen_df, seen = observed(df)
    write_table(seen_df, path, ["part"])
    table = read_table(spark, path, df.schema)
    assert verify(table, seen, [Unique(("id",)), Rows(100, 100)], "t") == 100
    assert verify(table.repartition(3), seen) == 100                       # order and layout don't matter
    with pytest.raises(ValueError, match="unique"):
        verify(table, seen, [Unique(("part",))], "t")
    for other in (table.where("id > 0"), table.withColumn("ts", F.when(F.col("id") == 5, 6).otherwise(F.col("ts")))):
        with pytest.raises(ValueError, match="read back"):
            verify(other, seen)
