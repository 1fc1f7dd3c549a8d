"""Tables as plain, optionally partitioned Parquet below a path."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import setting

_FILE_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

#: The column that holds the number of the write a stored row comes from.
COMMIT_ID = "_commit_id"


def numbered(df: DataFrame, commit: int) -> DataFrame:
    """``df`` as rows of the table's write of that number, from 1."""
    return df.withColumn(COMMIT_ID, F.lit(commit).cast("long"))


def cluster(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Layout rewrite: range-partition on ``cols`` and sort inside each
    partition, so each output file covers a narrow, non-overlapping key range
    (tight Parquet min/max statistics -> file skipping). Without an explicit
    partition count AQE sizes the partitions
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``)."""
    return df.repartitionByRange(*[F.col(c) for c in cols]).sortWithinPartitions(*cols)


@contextmanager
def file_size(spark: SparkSession, target_file_bytes: int | None) -> Iterator[None]:
    """Within, AQE aims at partitions, and so files, of the given size."""
    with setting(spark, _FILE_BYTES, target_file_bytes and str(int(target_file_bytes))):
        yield


def laid_out(df: DataFrame, partition_by: Sequence[str] | None = None,
             sort_within: Sequence[str] | None = None, rebalance: bool = True) -> DataFrame:
    """``df`` as it should be dealt to the writing tasks. With partition columns
    it is rebalanced on them: each task then holds few of their values, so that
    the output isn't tasks x values small files, and AQE splits a value that
    holds a large share of the rows. ``sort_within`` names columns, each perhaps
    with `` desc``."""
    if rebalance:
        df = df.hint("rebalance", *(partition_by or ()))
    if sort_within:
        order = [F.col(c.removesuffix(" desc")).desc() if c.endswith(" desc") else F.col(c) for c in sort_within]
        df = df.sortWithinPartitions(*(partition_by or ()), *order)
    return df


def writer(df: DataFrame, partition_by: Sequence[str] | None = None,
           max_records_per_file: int | None = None, dictionary: bool = True) -> DataFrameWriter:
    w = (df.write.mode("overwrite").option("compression", "snappy")
         .option("parquet.enable.dictionary", str(bool(dictionary)).lower()))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    return w.partitionBy(*partition_by) if partition_by else w


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, *,
                sort_within: Sequence[str] | None = None, rebalance: bool = True,
                target_file_bytes: int | None = None, max_records_per_file: int | None = None,
                dictionary: bool = True) -> None:
    """Overwrite the table at ``path``."""
    with file_size(df.sparkSession, target_file_bytes):
        writer(laid_out(df, partition_by, sort_within, rebalance), partition_by,
               max_records_per_file, dictionary).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               columns: Sequence[str] | None = None, cache: bool = False) -> DataFrame:
    """The table at ``path``. With its ``schema``, partition values keep their
    type (a string "01" isn't read back as the integer 1). ``columns`` are all
    that is read; ``cache`` keeps them for several aggregations."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    if columns:
        df = df.select(*columns)
    return df.cache() if cache else df
