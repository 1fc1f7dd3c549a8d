"""Exact distinct counts that roll up.

A distinct count cannot be added up; a bitmap of the values can. Every value of
a counted column gets a dense number within its shard (the shard is a hash of the
value, the number its rank there), and a group's values become bitmaps of 32,768
numbers each. The counts of any coarser grouping, or of several tables of
bitmaps built together, are the bits set after an ``or``: rows are read once per
counted column, narrow, and combined before they move; no row is copied per
counted column.

There are as many shards as a sketch of the distinct number asks for, so that a
shard fills about one bitmap: few values do not scatter over many nearly empty
bitmaps, and many values do not gather in one task. The rank reads distinct
(group, value) pairs only, so a value that holds a third of all rows is one pair
for each group. Nulls are not counted; a group without a value counts 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Values that a shard is meant to hold, out of the 32,768 bits of a bitmap.
PER_SHARD = 24_000


def distinct_bitmaps(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per group of ``keys``, counted column, shard and bitmap number:
    ``keys``, ``counted``, ``shard``, ``part``, ``bits``."""
    keys, out = list(keys), None
    for c in columns:
        pairs = df.select(*keys, F.col(c).alias("_v")).distinct()
        shards = df.select(F.greatest(F.lit(1), F.ceil(F.approx_count_distinct(c) / F.lit(PER_SHARD)))).scalar()
        dealt = pairs.withColumn("shard", F.pmod(F.xxhash64("_v"), shards).cast("int"))
        rank = F.dense_rank().over(Window.partitionBy("shard").orderBy("_v"))
        numbered = dealt.select(*keys, "shard", F.when(F.col("_v").isNotNull(), rank.cast("long")).alias("_id"))
        made = numbered.groupBy(*keys, "shard", F.bitmap_bucket_number("_id").alias("part")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits"))
        made = made.select(*keys, F.lit(c).alias("counted"), "shard", "part", "bits")
        out = made if out is None else out.unionAll(made)
    if out is None:
        raise ValueError("no column to count")
    return out


def counts_of_bitmaps(bitmaps: DataFrame, keys: Sequence[str], names: dict[str, str]) -> DataFrame:
    """Distinct counts per group of ``keys``, some or none of the bitmaps' keys;
    ``names`` maps an output column to the counted column."""
    keys = list(keys)
    united = bitmaps.groupBy(*keys, "counted", "shard", "part").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("_n"))
    return united.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col("counted") == c, F.col("_n"))), F.lit(0)).alias(n) for n, c in names.items()])
