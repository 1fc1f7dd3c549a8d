"""Global ranking of grouped results without a single-partition window.

``dense_rank().over(Window.orderBy(x))`` moves every row into one task. Here
quantiles of the distinct values cut them into ranges; a value's range is an
expression, so nothing is written and no job runs before the caller's. Each
range ranks its own values and adds the number of those in the ranges before
it, a table of at most RANGES + 1 rows that is broadcast. The input stands in
the plan several times, but behind one exchange that Spark reuses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that the distinct values are cut into.
RANGES = 256


def global_dense_rank(df: DataFrame, value: str, out: str = "rank",
                      descending: bool = True, ranges: int = RANGES) -> DataFrame:
    """Add ``out`` = ``dense_rank()`` over all rows ordered by ``value``.

    Nulls rank last (after every non-null value), as ``ORDER BY x DESC`` /
    ``ASC NULLS LAST`` would place them. Returns all columns of ``df`` plus
    ``out`` (int). ``value`` is a number, a date or a time.
    """
    vcol = F.col(value)
    vals = df.select(vcol.alias("_v")).where(F.col("_v").isNotNull()).distinct()
    cuts = [k / ranges for k in range(1, ranges)]
    at = F.lit(0)
    placed = vals
    if cuts:
        bounds = vals.select(F.array_distinct(F.percentile_approx("_v", cuts, 10 * ranges)))
        placed = vals.withColumn("_q", bounds.scalar())
        at = F.size(F.filter("_q", lambda q: q < F.col("_v")))
    placed = placed.select("_v", (-at if descending else at).alias("_b"))
    order = F.col("_v").desc() if descending else F.col("_v").asc()
    ranked = placed.withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy(order)))
    counts = placed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_b", before.alias("_before"))      # one row per range
    ranked = ranked.join(F.broadcast(offsets), "_b").select("_v", (F.col("_before") + F.col("_r")).cast("int").alias("_r"))
    last = vals.select((F.count(F.lit(1)) + 1).cast("int")).scalar()
    joined = df.join(ranked, vcol == F.col("_v"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_r"), last)).drop("_v", "_r")


def top_dense_rank(df: DataFrame, value: str, k: int, out: str = "rank",
                   descending: bool = True) -> DataFrame:
    """Rows whose dense rank by ``value`` is at most ``k`` (ties kept).

    The k best distinct values come from a distributed top-k (each task keeps
    k, the driver merges k per task); that k-row table is broadcast back.
    """
    vcol = F.col(value)
    vals = df.select(vcol.alias("_v")).where(F.col("_v").isNotNull()).distinct()
    top = vals.orderBy(F.col("_v").desc() if descending else F.col("_v").asc()).limit(k)
    # At most k rows: a single-partition window over them is bounded.
    top = top.withColumn(out, F.dense_rank().over(
        Window.orderBy(F.col("_v").desc() if descending else F.col("_v").asc())))
    hits = df.join(F.broadcast(top), vcol == F.col("_v"), "inner").drop("_v")
    # Null values rank after all distinct non-null values; keep them only
    # when that rank is still within k. The k-row top table tells: with fewer
    # than k rows it holds every distinct value, else the null rank exceeds k.
    null_rank = (top.select(F.count(F.lit(1))).scalar() + 1).cast("int")
    nulls = df.where(vcol.isNull()).withColumn(out, null_rank).where(F.col(out) <= k)
    return hits.unionByName(nulls)
