"""Whole jobs and bounded tasks: what the third round's findings asked for."""

import datetime
import glob
import os
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from strata.operators import gap_overview
from strata.plans import queries, salary
from strata.session import PARTS, ensure_checkpoint_dir, small_tasks
from strata.tables import (COMMIT_ID, create_keyed_table, ensure_namespace, numbered, upsert_partitions,
                           with_curve_key)

SHARE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def spied(spark, monkeypatch):
    """(name, conf of shuffles) of each frame that a module stores."""
    seen = []

    def spy(module):
        real = module.materialize

        def store(df, name="materialized"):
            seen.append((name, spark.conf.get(FIRST, None)))
            return real(df, name)
        monkeypatch.setattr(module, "materialize", store)
        return seen
    return spy


def test_commit_reaches_partitions_without_changes(spark, tmpdir_path):
    ensure_namespace(spark, "commits", root=tmpdir_path)
    rows = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 1, None)], "id long, version int, part string")
    create_keyed_table(numbered(rows, 1), "commits.t", ["id"], "version", ["part"])
    moved = spark.createDataFrame([(1, 2, "c")], "id long, version int, part string")
    assert upsert_partitions(spark, "commits.t", moved, ["id"], "version", ["part"], commit=2) == 4
    got = {r.id: (r.version, r.part, r[COMMIT_ID]) for r in spark.table("commits.t").collect()}
    assert got == {1: (2, "c", 2), 2: (1, "b", 2), 3: (1, None, 2)}


def test_stored_rows_name_their_write(spark, tmpdir_path):
    at = datetime.datetime(1995, 3, 1)
    spark.createDataFrame([(1, "O", 5.0, "1-URGENT"), (2, "F", 7.0, "5-LOW")],
                          "o_orderkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"
                          ).write.parquet(f"{tmpdir_path}/orders.parquet")
    spark.createDataFrame([(1, "x", 2, 1.5, "B"), (2, "y", 3, 2.5, None)],
                          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
                          ).write.parquet(f"{tmpdir_path}/customer.parquet")
    spark.createDataFrame([(1, 1, at, 3.0), (1, 2, None, 4.0)],
                          "l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz, l_quantity double"
                          ).write.parquet(f"{tmpdir_path}/lineitem.parquet")
    assert sorted(map(tuple, queries.q_global_upsert(spark, tmpdir_path).collect())) == [
        (1, "U", 10.0, 2, 2), (2, "F", 7.0, 1, 2)]
    shot = queries.q_snapshot_roundtrip(spark, tmpdir_path)
    assert shot.columns[-1] == COMMIT_ID and sorted(map(tuple, shot.collect())) == [
        (1, "x", 2, 1.5, "B", 1), (2, "y", 3, 2.5, None, 1)]
    assert sorted(map(tuple, queries.q_layout_rewrite(spark, tmpdir_path).collect())) == [
        (1, 1, "1995-03-01", 3.0, 2), (1, 2, None, 4.0, 2)]


def test_csv_is_written_by_all_tasks(spark, tmpdir_path):
    docs = spark.createDataFrame([(k, f'a "{k}",\n b', "en") for k in range(40)], "doc_id long, text string, lang string")
    docs.repartition(4).write.parquet(f"{tmpdir_path}/documents.parquet")
    where = f"{ensure_checkpoint_dir(spark)}/documents_csv-*"
    before = set(glob.glob(where))
    got = queries.q_csv_multiline(spark, tmpdir_path).collect()
    (new,) = set(glob.glob(where)) - before
    assert len(glob.glob(os.path.join(new, "part-*.csv"))) > 1
    assert sorted(r.doc_id for r in got) == list(range(40)) and all(r.fits for r in got)


def test_small_tasks_restore_the_settings(spark):
    before = spark.conf.get(SHARE, None), spark.conf.get(FIRST, None)
    with small_tasks(spark):
        assert int(spark.conf.get(FIRST)) >= PARTS
    assert (spark.conf.get(SHARE, None), spark.conf.get(FIRST, None)) == before


def test_salary_groups_are_made_in_small_tasks(spark, tmpdir_path, spied, monkeypatch):
    seen, laid, real = spied(salary), {}, salary.write_table
    monkeypatch.setattr(salary, "write_table", lambda df, path, *a, **k: (
        laid.__setitem__(path.rsplit("/", 1)[1], k["rebalance"]), real(df, path, *a, **k))[1])
    with open(f"{tmpdir_path}/s.csv", "w") as f:
        f.write("Age,Gender,Education Level,Job Title,Years of Experience,Salary\n")
        f.writelines(f"{20 + k},m,PhD,Title {k % 3},{k}.5,{1000 * k}\n" for k in range(1, 20))
    rows = salary.run_salary(spark, f"{tmpdir_path}/s.csv", f"{tmpdir_path}/lake", as_of="2024-06-15 12:00:00")
    assert rows["silver.salary_detailed"] == 19
    assert {n for n, _ in seen} >= set(salary.LAYOUT) - {salary.DETAIL}
    assert all(int(parts) >= PARTS for _, parts in seen)
    assert laid[salary.DETAIL] is False and laid["salary_education_stats"] is True


def test_gap_overview_keeps_states_apart(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, None, 5), ("a", 3.0, 4.0, None, 5), (None, 5.0, 1.0, 7, None)],
                               "g string, v double, s double, x int, y int")
    out = gap_overview(df, "g", "v", "s", distinct={"nx": "x", "ny": "y"})
    assert "Expand" not in _plan(out)
    assert {tuple(r) for r in out.collect()} == {("a", 2, 2.0, 3.0, 0, 1, 2.0), (None, 1, 5.0, 1.0, 1, 0, 5.0)}


def test_curve_finds_ranges_by_halving(spark):
    values = [None, float("nan"), -3.0, 0.0, 0.0, 2.5, 7.0, 7.0, 9.0, 11.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = with_curve_key(df, ["v"], "k", bits=3)
    assert "filter(" not in _plan(out)
    cuts = df.select(F.percentile_approx("v", [k / 8 for k in range(1, 8)], 10_000)).first()[0]
    edges = list(dict.fromkeys(c for c in cuts if c == c))
    for r in out.collect():
        nan = r.v is not None and r.v != r.v
        assert r.k == (0 if r.v is None else len(edges) if nan else bisect_left(edges, r.v))


def test_distinct_rollup_is_made_in_small_tasks(spark, tmpdir_path, spied):
    seen = spied(queries)
    spark.createDataFrame([("A", "O", 1, 2, None, 3), ("R", "F", 1, 4, None, 3)],
                          "l_returnflag string, l_linestatus string, l_suppkey long, l_partkey long, "
                          "l_shipdate timestamp_ntz, l_orderkey long").write.parquet(f"{tmpdir_path}/lineitem.parquet")
    got = {tuple(r) for r in queries.q_distinct_rollup(spark, tmpdir_path).collect()}
    assert (None, None, 1, 2, 0, 1) in got and len(got) == 5
    assert [name for name, parts in seen if int(parts or 0) >= PARTS] == ["bitmaps"]


def test_least_of_a_key_takes_one_join(spark):
    from strata.llm.graph import with_least
    rows = spark.createDataFrame([(1, 5), (1, 4), (2, 9), (None, 1)], "k int, v int")
    out = with_least(rows, "k", "v", "m")
    assert _plan(out).count("Join") == 1
    assert sorted(map(tuple, out.collect())) == [(1, 4, 4), (1, 5, 4), (2, 9, 9)]
