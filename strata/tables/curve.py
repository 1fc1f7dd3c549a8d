"""Layout along a space-filling curve.

Sorting by one column makes files narrow in that column alone. Here each column
is replaced by the number of the quantile range that a value lies in, the bits
of these numbers are interleaved into one key (Z-order), and rows are range
partitioned and sorted by it: every file, and every row group in it, is then
narrow in all of the columns, and a filter on several of them skips most. With
two columns and g row groups it reads less than a sort by one column where the
filter on that column alone leaves more than about 1 / sqrt(g) of the rows.

Ranges come from a quantile sketch, so a skewed column still spreads evenly over
its bits; equal values share a range, and the columns themselves end the sort.
Numbers, dates and times are taken as they are, other types by the order of their
first bytes. Nulls lie in range 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits per column: 2 ** BITS ranges.
BITS = 8
_SKETCH = 10_000


def _number(df: DataFrame, column: str) -> Column:
    """A number in the column's order. Texts: their first six bytes."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return c.cast("timestamp").cast("double")
    if isinstance(kind, (T.NumericType, T.TimestampType, T.BooleanType)):
        return c.cast("double")
    raw = F.substring(F.rpad(F.substring(c.cast("string").cast("binary"), 1, 6), 6, F.lit(b"\0")), 1, 6)
    return F.conv(F.hex(raw), 16, 10).cast("double")


def _below(edges: Column, v: Column, bits: int) -> Column:
    """How many of the edges, ascending and fewer than ``2 ** bits``, lie below the
    value: one comparison per bit, the highest first."""
    steps = F.array(*[F.lit(2 ** b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(edges, at + step - 1) < v, at + step).otherwise(at))


def with_curve_key(df: DataFrame, columns: Sequence[str], out: str = "curve", bits: int = BITS) -> DataFrame:
    """``df`` and the rows' places on the curve, as a long. The sketch's bounds enter
    as one scalar subquery for all columns, which reads those alone."""
    columns = list(columns)
    if not columns or bits < 1 or bits * len(columns) > 62:
        raise ValueError("between 1 and 62 bits in all")
    cuts = [k / 2 ** bits for k in range(1, 2 ** bits)]
    bounds = df.select(F.struct(*[
        F.array_sort(F.array_distinct(F.percentile_approx(_number(df, c), cuts, _SKETCH))).alias(f"b{i}")
        for i, c in enumerate(columns)])).scalar()
    held, one = df.withColumn("_bounds", bounds), F.lit(1).cast("long")
    key = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        v, edges = _number(df, c), F.col(f"_bounds.b{i}")
        place = F.when(v.isNotNull() & edges.isNotNull(), _below(edges, v, bits)).otherwise(0).cast("long")
        for b in range(bits):
            bit = F.shiftright(place, b).bitwiseAND(one)
            key = key.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i))
    return held.withColumn(out, key).drop("_bounds")


def cluster_by_curve(df: DataFrame, columns: Sequence[str], bits: int = BITS, partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted along the curve, for a write as it is
    (``write_table(..., rebalance=False)``). Without ``partitions`` AQE sizes them."""
    keyed = with_curve_key(df, columns, "_curve", bits)
    order = [F.col("_curve"), *[F.col(c) for c in columns]]
    dealt = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).drop("_curve")
