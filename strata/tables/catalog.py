"""Catalog tables: namespaces, overwrite writes, listing (plain Spark SQL)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.tables.files import file_size, laid_out, writer


def ensure_namespace(spark: SparkSession, *names: str, root: str | None = None) -> None:
    """``CREATE NAMESPACE IF NOT EXISTS`` for each name (e.g. silver, gold);
    new ones keep their tables in a folder of ``root`` if it is given, else in
    the warehouse."""
    for n in names:
        where = f" LOCATION '{root}/{n}'" if root else ""
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {n}{where}")


def write_catalog_table(df: DataFrame, name: str, partition_by: Sequence[str] | None = None,
                        max_records_per_file: int | None = None, *, sort_within: Sequence[str] | None = None,
                        bucket_by: Sequence[str] | None = None, buckets: int = 0,
                        target_file_bytes: int | None = None, rebalance: bool = True) -> None:
    """Overwrite ``name`` in the session catalog, optionally partitioned, and then
    rebalanced on the partition columns unless ``rebalance`` is off. With
    ``bucket_by`` and ``buckets`` the rows lie in so many files by a hash of the
    key, sorted by it: joins and groupings on the key need no exchange of the
    table, and files of one bucket each are written by one task."""
    if bucket_by and not buckets:
        raise ValueError("bucket_by needs a number of buckets")
    with file_size(df.sparkSession, target_file_bytes):
        if bucket_by:
            df = df.repartition(buckets, *bucket_by)
        else:
            df = laid_out(df, partition_by, sort_within, rebalance=rebalance and bool(partition_by))
        w = writer(df, partition_by, max_records_per_file).format("parquet")
        if bucket_by:
            w = w.bucketBy(buckets, *bucket_by).sortBy(*bucket_by, *(sort_within or ()))
        w.saveAsTable(name)


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}")


def list_namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW NAMESPACES")
