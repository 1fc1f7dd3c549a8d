"""The most common items of every group, exact, without counting every item.

With a large vocabulary most (group, item) pairs are rare, and counting them all
shuffles nearly every row for nothing. Two narrow passes leave them out:

1. Items are dealt to ``width`` cells per group by hash, and cells are counted.
   A cell's count is at least that of any item in it (a count-min sketch of one
   row). These counts are bounded by groups times ``width``.
2. The items of a group's ``2 * n`` fullest cells are counted exactly. The count
   of the n-th best of them is a floor: every item of the true top n has it.
3. A cell below the floor holds no such item. The items of all other cells are
   counted exactly, and the best n stay.

The chosen cells, groups times cells at most, are joined to the rows; a cell
that holds a large share of them is split by AQE's skew join, and a small table
of cells is broadcast by it.

Nothing is estimated in the result; a floor that prunes little costs time and
no row. Ties end in the item, ascending. Nulls are no items; null keys are a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.quantiles import null_safe_on

#: Cells per group.
WIDTH = 4096


def item_counts(df: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """All (group, item) pairs as rows: ``keys``, ``item``, ``n``."""
    return df.where(F.col(item).isNotNull()).groupBy(*keys, item).agg(F.count(F.lit(1)).alias("n"))


def most_common(df: DataFrame, keys: Sequence[str], item: str, n: int, *, width: int = WIDTH) -> DataFrame:
    """``keys``, ``item``, ``n``, ``rank`` (1 to ``n``) of each group's most common items."""
    if n < 1 or width < 1:
        raise ValueError("n and width must be positive")
    keys = list(keys)
    rows = df.where(F.col(item).isNotNull()).select(
        *keys, F.col(item).alias("_item"), F.pmod(F.xxhash64(item), F.lit(width)).cast("int").alias("_cell"))
    cells = rows.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_most"))
    fullest = Window.partitionBy(*keys).orderBy(F.col("_most").desc(), "_cell")
    best = cells.withColumn("_r", F.row_number().over(fullest)).where(F.col("_r") <= 2 * n)

    def counted(chosen: DataFrame) -> DataFrame:
        r, c = rows.alias("r"), chosen.select(*keys, "_cell").alias("c")
        kept = r.join(c, null_safe_on(r, c, [*keys, "_cell"]), "left_semi")
        return kept.groupBy(*keys, "_item").agg(F.count(F.lit(1)).alias("_n"))

    order = Window.partitionBy(*keys).orderBy(F.col("_n").desc(), "_item")
    # fewer than n items in the fullest cells set no floor
    floors = (counted(best).withColumn("_r", F.row_number().over(order)).where(F.col("_r") == n)
              .select(*keys, F.col("_n").alias("_floor")))
    c, f = cells.alias("c"), floors.alias("f")
    open_cells = (c.join(f, null_safe_on(c, f, keys), "left").where(F.col("_most") >= F.coalesce("_floor", F.lit(0)))
                  .select(*[F.col(f"c.{k}").alias(k) for k in keys], "_cell"))
    return (counted(open_cells).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
            .select(*keys, F.col("_item").alias(item), F.col("_n").alias("n"), "rank"))
