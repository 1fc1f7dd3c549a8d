"""Bronze CSV: header row, every column read as string, bad rows set apart."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.records import csv_records

CORRUPT = "_corrupt_record"


def string_schema(columns: Sequence[str], corrupt_column: str | None = CORRUPT) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    if corrupt_column:
        fields.append(T.StructField(corrupt_column, T.StringType(), True))
    return T.StructType(fields)


def read_bronze_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, *,
                    multiline: bool = False, capture_corrupt: bool = True) -> DataFrame:
    """Read CSV with a header row as all-string columns.

    The schema is always declared: ``columns``, or else the names of the
    header row (the only row read for it). Rows that do not fit it land in
    ``_corrupt_record`` instead of failing the job. Files are split over
    tasks; with ``multiline`` quoted fields may hold line breaks, and files are
    split all the same (:func:`strata.sources.records.csv_records`). Empty
    fields and quoted empty strings read as null.
    """
    r = spark.read.option("header", True).option("escape", '"').option("mode", "PERMISSIVE")
    if columns is None:
        columns = r.option("inferSchema", False).csv(path).columns
    schema = string_schema(columns, CORRUPT if capture_corrupt else None)
    if multiline:
        options = {"escape": '"', "mode": "PERMISSIVE"}
        if capture_corrupt:
            options["columnNameOfCorruptRecord"] = CORRUPT
        fields = F.from_csv(F.col("record"), F.lit(schema.simpleString()), options)
        return csv_records(spark, path).select(fields.alias("r")).select("r.*")
    if capture_corrupt:
        # Without pruning, so that a row is bad or good whatever columns are asked for.
        r = r.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    return r.schema(schema).csv(path)


def read_bronze(spark: SparkSession, path: str, *, multiline: bool = False) -> tuple[DataFrame, DataFrame, Observation]:
    """(rows that fit the header; those that don't, as far as they could be read,
    with their text as ``bad_record``; the number of the latter as
    ``bad_rows``, filled by the first job that reads the good rows)."""
    rows = read_bronze_csv(spark, path, multiline=multiline)
    bad = Observation()
    good = rows.observe(bad, F.count(CORRUPT).alias("bad_rows")).where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    # Spark refuses to read the record's text alone, without any field.
    return good, rows.where(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "bad_record"), bad


def quarantine(bad_rows: DataFrame, bad: Observation, path: str, folder: str) -> int:
    """Number of bad rows of a source; if there are any, they are logged and
    written below ``folder``. Call after the job that read the good rows."""
    n = int(bad.get["bad_rows"])
    if n:
        logging.getLogger(__name__).warning("%s: %d rows do not fit the header, kept in %s", path, n, folder)
        bad_rows.write.mode("overwrite").parquet(folder)
    return n
