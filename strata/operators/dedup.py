"""Deterministic de-duplication: one row per key, survivor by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def orderable(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return False
    if isinstance(t, T.ArrayType):
        return orderable(t.elementType)
    if isinstance(t, T.StructType):
        return all(orderable(f.dataType) for f in t.fields)
    return True


def _order(df: DataFrame, keys: Sequence[str], order_by) -> list[Column]:
    if order_by is None:
        # No business order given: fall back to every other (orderable) column,
        # ascending, so the survivor does not depend on partitioning or
        # arrival order.
        return [F.col(f.name).asc_nulls_last() for f in df.schema.fields
                if f.name not in keys and orderable(f.dataType)]
    out = []
    for o in order_by:
        out.append(F.col(o).asc_nulls_last() if isinstance(o, str) else o)
    return out


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """Keep the first row per ``keys`` under ``order_by``.

    Planned as ``row_number() = 1``, which Spark turns into a partial
    WindowGroupLimit *before* the shuffle: every map task forwards at most one
    row per key, so a key that holds a third of the input costs no more
    shuffle than any other key.
    """
    keys = list(keys)
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*_order(df, keys, order_by))
    return (df.withColumn("_strata_rn", F.row_number().over(w))
              .where(F.col("_strata_rn") == 1)
              .drop("_strata_rn"))


def keep_latest(df: DataFrame, keys: Sequence[str], precombine: str,
                tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Latest-wins: greatest ``precombine`` per key, then ``tie_break``."""
    order = [F.col(precombine).desc_nulls_last()] + [
        F.col(t).asc_nulls_last() if isinstance(t, str) else t for t in tie_break]
    return dedup(df, keys, order)
