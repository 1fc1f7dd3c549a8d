"""Keyed catalog tables: upserts that touch the partitions they change.

``upsert_partitions`` finds the partitions that the changed keys lie in now or
move to, reads and merges only those, and overwrites only those (dynamic
partition overwrite). All other files stay as they are. The old places of the
keys come from one scan of the key and partition columns; where the key holds
the partition columns, a row cannot move and that scan is left out.

The driver gets the values of the touched partitions, which are no more than
the partitions that Spark lists for the table anyway. The merged rows are
written to the shared folder first: a run that is lost up to then has changed
nothing, and a repeated run gives the same table. A partition whose rows have
all moved is dropped last.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import materialize, setting
from strata.tables.files import file_size, laid_out, numbered, writer
from strata.tables.upsert import upsert


def create_keyed_table(df: DataFrame, name: str, keys: Sequence[str], precombine: str,
                       partition_by: Sequence[str], *, target_file_bytes: int | None = None) -> None:
    """Overwrite the table with the rows of ``df``, one per key: the one with the
    greatest ``precombine``."""
    with file_size(df.sparkSession, target_file_bytes):
        writer(laid_out(upsert(None, df, keys, precombine), partition_by), partition_by).format(
            "parquet").saveAsTable(name)


def in_partitions(columns: Sequence[str], values: Sequence) -> Column:
    """A condition on partition columns alone, so that only these are read."""
    one = [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v[c])) for c in columns]) for v in values]
    while len(one) > 1:                                  # halved, so that many stay a shallow tree
        one = [reduce(lambda a, b: a | b, one[k:k + 2]) for k in range(0, len(one), 2)]
    return one[0] if one else F.lit(False)


def touched_partitions(table: DataFrame, changes: DataFrame, keys: Sequence[str],
                       partition_by: Sequence[str]) -> list:
    """Values of the partitions that the changed keys lie in now or move to."""
    new = changes.select(*partition_by).distinct()
    if not set(partition_by) <= set(keys):
        k = changes.select(*[F.col(c).alias(f"_k_{c}") for c in keys]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys])
        columns = list(dict.fromkeys([*keys, *partition_by]))
        new = new.union(table.select(*columns).join(k, same, "left_semi").select(*partition_by)).distinct()
    return new.collect()                                 # at most the table's partitions


def upsert_partitions(spark: SparkSession, name: str, changes: DataFrame, keys: Sequence[str],
                      precombine: str, partition_by: Sequence[str], *,
                      tie_break: Sequence[Column | str] = (), target_file_bytes: int | None = None,
                      commit: int | None = None) -> int:
    """Merge ``changes`` into the catalog table; returns how many partitions were
    rewritten. One row per key: the greatest ``precombine`` wins, on a tie the
    change. No changes: nothing is read or written. With ``commit`` the table is
    one of :func:`strata.tables.files.numbered` rows and the merge a write of the
    whole table: all partitions are rewritten, and every row gets that number."""
    base = spark.table(name)
    if commit is not None:
        changes = numbered(changes, commit)
    changes = materialize(changes.select(*base.columns), "changes")
    if commit is None:
        touched = touched_partitions(base, changes, keys, partition_by)
    else:
        touched = base.select(*partition_by).union(changes.select(*partition_by)).distinct().collect()
    if not touched:
        return 0
    merged = upsert(base.where(in_partitions(partition_by, touched)), changes, keys, precombine, tie_break)
    if commit is not None:
        merged = numbered(merged, commit)
    merged = materialize(merged.select(*base.columns), "merged")
    with file_size(spark, target_file_bytes), setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        laid_out(merged, partition_by).write.mode("overwrite").insertInto(name)
    left = {tuple(r) for r in merged.select(*partition_by).distinct().collect()}
    for values in touched:
        if tuple(values) not in left:
            spec = ", ".join(f"{c} = {_literal(values[c])}" for c in partition_by)
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    return len(touched)


def _literal(value) -> str:
    if value is None:
        return "null"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return str(value) if isinstance(value, int) else f"'{text}'"
