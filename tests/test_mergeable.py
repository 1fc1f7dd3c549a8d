"""Parts that merge: exact moments, distinct bitmaps, stored profiles; the most
common items; the layout along a curve."""

import datetime
import math
import os
import random
import statistics
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.functions import add_sums, moment_sums, moments_of
from strata.operators import (compact_parts, counts_of_bitmaps, distinct_bitmaps, item_counts, most_common,
                              profile_of_parts, profile_parts, store_parts)
from strata.tables import cluster_by_curve, with_curve_key, write_table


def _moments(df, name="v"):
    m = moments_of("m")
    return df.groupBy("k").agg(*moment_sums(name, "m")).select("k", *[c.alias(n) for n, c in m.items()])


def test_moments_are_bit_equal_in_any_order(spark):
    rng = random.Random(3)
    rows = [(f"k{i % 3}", 1e9 + round(rng.uniform(-50, 50), 4)) for i in range(6000)]
    got = []
    for parts in (1, 3, 17):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
        got.append({tuple(r) for r in _moments(df).collect()})
    assert got[0] == got[1] == got[2]
    by_key = defaultdict(list)
    for k, v in rows:
        by_key[k].append(round(v * 10000))
    for k, mean, variance, stddev in got[0]:
        exact = statistics.variance(by_key[k]) / 1e8
        assert math.isclose(variance, exact, rel_tol=1e-12) and math.isclose(stddev, exact ** 0.5, rel_tol=1e-12)
        assert math.isclose(mean, statistics.mean(by_key[k]) / 1e4, rel_tol=1e-15)


@pytest.mark.parametrize("values, mean, variance", [
    ([], None, None), ([None], None, None), ([2.5], 2.5, None), ([7.0, 7.0, None], 7.0, 0.0),
    ([-1.5, 1.5], 0.0, 4.5), ([1 / 3, 2 / 3], 0.5, 1 / 18),
])
def test_moments_cases(spark, values, mean, variance):
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    got = _moments(df).collect()
    if not values:
        assert got == []
        return
    assert got[0].mean == pytest.approx(mean) if mean is not None else got[0].mean is None
    assert got[0].variance == pytest.approx(variance) if variance is not None else got[0].variance is None


def test_moments_off_the_grid_are_spark_own(spark):
    values = [("a", 1e300), ("a", 1.0), ("b", 1e15 + 1 / 3), ("b", 1e15), ("c", math.nan), ("c", 1.0), ("d", math.inf), ("d", 1.0)]
    df = spark.createDataFrame(values, "k string, v double").coalesce(1)
    got = {r.k: (str(r.mean), str(r.variance)) for r in _moments(df).collect()}
    own = df.groupBy("k").agg(F.avg("v").alias("mean"), F.variance("v").alias("variance")).collect()
    assert got == {r.k: (str(r["mean"]), str(r.variance)) for r in own}


def test_moments_of_added_sums(spark):
    """A part off the grid, or one whose exact sum overflowed, moves its group to doubles."""
    rows = [("a", 0, 1.25), ("a", 1, 2.5), ("a", 2, 9.0), ("b", 0, 1.5), ("b", 1, 1 / 3), ("c", 0, None)]
    df = spark.createDataFrame(rows, "k string, part int, v double")
    parts = df.groupBy("k", "part").agg(*moment_sums("v", "m"))
    m = moments_of("m")
    got = {r.k: r for r in parts.groupBy("k").agg(*add_sums("m")).select("k", m["mean"].alias("mean"), m["variance"].alias("var")).collect()}
    assert got["a"].mean == 4.25 and got["a"]["var"] == statistics.variance([1.25, 2.5, 9.0])
    assert got["b"]["var"] == pytest.approx(statistics.variance([1.5, 1 / 3]))
    assert got["c"].mean is None and got["c"]["var"] is None


def _values(spark):
    rng = random.Random(11)
    rows = []
    for i in range(4000):
        k = "hot" if i % 3 == 0 else (None if i % 89 == 0 else f"k{i % 7}")
        rows.append((k, rng.choice("xyz"), i % 4, rng.choice([None, "hot", f"v{rng.randint(0, 700)}"]),
                     round(rng.expovariate(0.01), 2)))
    rows.append(("empty", "x", 0, None, None))
    return spark.createDataFrame(rows, "k string, sub string, day int, item string, v double"), rows


def test_distinct_bitmaps_roll_up(spark, monkeypatch):
    import strata.operators.bitmaps as bitmaps
    df, rows = _values(spark)
    for per_shard in (24_000, 50):                # one shard, and many
        monkeypatch.setattr(bitmaps, "PER_SHARD", per_shard)
        bits = distinct_bitmaps(df, ["k", "sub"], ["item", "day"])
        for keys in (["k", "sub"], ["k"], []):
            got = {tuple(r) for r in counts_of_bitmaps(bits, keys, {"a": "item", "b": "day"}).select(*keys, "a", "b").collect()}
            exp = {tuple(r) for r in df.groupBy(*keys).agg(F.countDistinct("item").alias("a"), F.countDistinct("day").alias("b")).collect()}
            assert got == exp
    assert "Expand" not in bits._jdf.queryExecution().toString()
    assert counts_of_bitmaps(distinct_bitmaps(df.limit(0), ["k"], ["item"]), ["k"], {"a": "item"}).count() == 0


def test_most_common_equals_brute_force(spark):
    df, rows = _values(spark)
    counts = defaultdict(Counter)
    for k, _, _, item, _ in rows:
        if item is not None:
            counts[k][item] += 1
    for n, width in ((1, 1), (5, 7), (5, 4096), (1000, 64)):
        got = sorted((str(r.k), r["rank"], r.item, r.n) for r in most_common(df, ["k"], "item", n, width=width).collect())
        exp = sorted((str(k), i + 1, item, m) for k, c in counts.items()
                     for i, (item, m) in enumerate(sorted(c.items(), key=lambda e: (-e[1], e[0]))[:n]))
        assert got == exp
    assert item_counts(df, ["k"], "item").count() == sum(len(c) for c in counts.values())
    assert most_common(df.limit(0), ["k"], "item", 3).count() == 0


def test_profile_of_three_arrivals_equals_one_pass(spark, tmpdir_path):
    df, rows = _values(spark)
    for day in range(4):
        write_table(profile_parts(df.where(F.col("day") == day), ["k", "sub"], "v"), f"{tmpdir_path}/day={day}")
    stored = spark.read.parquet(tmpdir_path)
    fields = ["k", "n", "avg_v", "min_v", "max_v", "stddev_v", "variance_v"]
    one = {tuple(r) for r in profile_of_parts(profile_parts(df, ["k"], "v"), ["k"], "v").select(*fields).collect()}
    merged = profile_of_parts(stored, ["k"], "v").collect()
    folded = profile_of_parts(compact_parts(stored, ["k", "day"]), ["k"], "v").select(*fields).collect()
    assert {tuple(r[f] for f in fields) for r in merged} == one == {tuple(r) for r in folded}
    values = defaultdict(list)
    for k, _, _, _, v in rows:
        if v is not None:
            values[k].append(v)
    for r in merged:
        if r.k == "empty":
            assert (r.n, r.avg_v, r.q1_v, r.iqr_v) == (1, None, None, None)
            continue
        n = len(values[r.k])
        for got, at in ((r.q1_v, 0.25), (r.median_v, 0.5), (r.q3_v, 0.75)):
            assert sum(v < got for v in values[r.k]) <= n * (at + 0.01) + 1
            assert sum(v <= got for v in values[r.k]) >= n * (at - 0.01) - 1
    assert profile_of_parts(stored.limit(0), ["k"], "v").count() == 0


def test_store_parts_replaces_only_what_arrived(spark, tmpdir_path):
    df, _ = _values(spark)
    path = f"{tmpdir_path}/parts"

    def files(day):
        return sorted(os.listdir(f"{path}/day={day}"))

    for day in range(4):
        store_parts(df.where(F.col("day") == day), path, ["day"], ["k"], "v")
    before, second = [files(d) for d in range(4)], files(2)
    once = sorted(map(str, profile_of_parts(spark.read.parquet(path), ["k"], "v").collect()))
    store_parts(df.where(F.col("day") == 2), path, ["day"], ["k"], "v")
    assert [files(d) for d in (0, 1, 3)] == [before[d] for d in (0, 1, 3)] and files(2) != second
    again = profile_of_parts(spark.read.parquet(path), ["k"], "v").drop("q1_v", "median_v", "q3_v", "iqr_v")
    one = profile_of_parts(profile_parts(df, ["k"], "v"), ["k"], "v").drop("q1_v", "median_v", "q3_v", "iqr_v")
    assert set(again.collect()) == set(one.collect()) and len(once) == again.count()


def _groups_read(path, low, high, date_from, date_to):
    """Row groups whose statistics meet a filter on both columns."""
    hit = total = 0
    for part in pq.ParquetDataset(path).fragments:
        meta = part.metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            d, p = (meta.row_group(g).column(names.index(c)).statistics for c in ("day", "price"))
            total += 1
            hit += d.min <= date_to and d.max >= date_from and p.min <= high and p.max >= low
    return hit, total


def test_curve_reads_fewer_row_groups(spark, tmpdir_path):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select(
        F.unix_date(F.col("l_shipdate").cast("date")).alias("day"), F.col("l_extendedprice").alias("price"), "l_orderkey")
    days = li.select(F.percentile_approx("day", [0.5, 0.7]).alias("q")).first().q
    kw = {"rebalance": False, "max_records_per_file": 1000}
    write_table(li.repartitionByRange(8, "day").sortWithinPartitions("day"), f"{tmpdir_path}/day", **kw)
    write_table(cluster_by_curve(li, ["day", "price"], partitions=8), f"{tmpdir_path}/curve", **kw)
    write_table(li.repartitionByRange(8, "price").sortWithinPartitions("price"), f"{tmpdir_path}/price", **kw)
    narrow = {"day": (901.0, 200000.0, *days), "price": (30000.0, 50000.0, -10**6, 10**6)}
    both = (30000.0, 50000.0, days[0], days[1])
    by_day, by_price, curve = (_groups_read(f"{tmpdir_path}/{x}", *both)[0] for x in ("day", "price", "curve"))
    assert curve < by_day and curve < by_price
    # filters on one column alone skip most of the groups as well
    for low, high, a, b in narrow.values():
        hit, total = _groups_read(f"{tmpdir_path}/curve", low, high, a, b)
        assert hit < total * 0.6
    assert spark.read.parquet(f"{tmpdir_path}/curve").count() == li.count()


def test_curve_key_cases(spark):
    day = datetime.date(2024, 1, 1)
    rows = [(None, None, None), ("a", 1.0, day), ("b", 1.0, day), ("a", None, None), ("é" * 40, 5.0, day)]
    df = spark.createDataFrame(rows, "s string, v double, d date")
    got = with_curve_key(df, ["s", "v", "d"]).orderBy("s", "v").collect()
    assert len(got) == 5 and got[0].curve == 0
    assert with_curve_key(df.limit(0), ["v"]).count() == 0
    one = with_curve_key(spark.range(1000), ["id"]).orderBy("id").collect()
    assert [r.curve for r in one] == sorted(r.curve for r in one) and one[-1].curve > 200
    with pytest.raises(ValueError):
        with_curve_key(df, [])
