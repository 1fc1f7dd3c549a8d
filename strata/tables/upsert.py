"""Latest-wins upsert, expressed as a union plus a per-key top-1.

``row_number() = 1`` per key is planned with a partial WindowGroupLimit
before the shuffle, so every map task ships at most one row per key -- a key
holding a third of the rows is reduced where it is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import dedup, orderable

_SRC = "_strata_src"


def _merge(rows: DataFrame, keys: Sequence[str], precombine: str, tie_break: Sequence[Column | str]) -> DataFrame:
    """One row per key: greatest ``precombine``, then the latest source, then
    ``tie_break``, then every other orderable column, so that the survivor
    never depends on the order of the input."""
    order = [F.col(precombine).desc_nulls_last(), F.col(_SRC).desc()]
    order += [F.col(t).asc_nulls_last() if isinstance(t, str) else t for t in tie_break]
    order += [F.col(f.name).asc_nulls_last() for f in rows.schema.fields
              if f.name not in (*keys, precombine, _SRC) and orderable(f.dataType)]
    return dedup(rows, keys, order).drop(_SRC)


def upsert(base: DataFrame | None, changes: DataFrame, keys: Sequence[str], precombine: str,
           tie_break: Sequence[Column | str] = (), replace: bool = False) -> DataFrame:
    """Merge ``changes`` into ``base``: one row per key, the one with the
    greatest ``precombine``; on equal ``precombine`` the change beats the base,
    then ``tie_break`` and the remaining columns decide. Duplicate keys within
    either side are collapsed too.

    ``replace=True`` drops ``base`` (an overwrite that still collapses
    duplicate keys inside the incoming batch).

    The plan is the same for every size of batch: one shuffle of at most one
    row per key and map task.
    """
    c = changes.withColumn(_SRC, F.lit(1))
    if base is not None and not replace:
        c = base.withColumn(_SRC, F.lit(0)).unionByName(c, allowMissingColumns=True)
    return _merge(c, keys, precombine, tie_break)


def global_upsert(base: DataFrame | None, changes: DataFrame, key: str, precombine: str,
                  partition_col: str, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Upsert keyed on the record key alone; ``partition_col`` is plain data.

    A key whose partition value changes moves: its old row is replaced, so
    after a partitioned write the key lives in exactly one partition.
    """
    if partition_col == key:
        raise ValueError("the partition column must not be the record key")
    return upsert(base, changes, [key], precombine, tie_break)


def merge_on_read(base: DataFrame | None, deltas: Sequence[DataFrame], keys: Sequence[str],
                  precombine: str, tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """View of ``base`` with ``deltas`` applied in order, evaluated at read.

    Equal to applying :func:`upsert` delta by delta: a later delta beats an
    earlier one on equal ``precombine``. One shuffle however many deltas.
    """
    if base is None and not deltas:
        raise ValueError("nothing to read")
    rows = None if base is None else base.withColumn(_SRC, F.lit(0))
    for i, d in enumerate(deltas, start=1):
        d = d.withColumn(_SRC, F.lit(i))
        rows = d if rows is None else rows.unionByName(d, allowMissingColumns=True)
    return _merge(rows, keys, precombine, tie_break)
