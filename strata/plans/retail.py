"""Retail layers: customers and articles, bronze CSV -> silver -> gold."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import (AGE_CATEGORY, audit_columns, bucketize, calculation_timestamp,
                              completeness, content_hash, legacy_int)
from strata.operators import category_breakdown, cross_summary, dedup, diversity, profile, summary
from strata.session import scratch_path
from strata.sources import quarantine, read_bronze
from strata.tables import (Unique, checked, create_keyed_table, ensure_namespace, not_null, observed, read_table,
                           upsert, upsert_partitions, verify, write_catalog_table, write_table)

# The 22 article columns scored for completeness, in source order.
ARTICLE_COLUMNS = (
    "article_id", "product_type_name", "product_type_no", "product_group_name",
    "graphical_appearance_no", "colour_group_code", "colour_group_name",
    "perceived_colour_value_id", "perceived_colour_value_name", "perceived_colour_master_id",
    "perceived_colour_master_name", "department_no", "department_name", "index_code",
    "index_name", "index_group_no", "index_group_name", "section_no", "section_name",
    "garment_group_no", "garment_group_name", "detail_desc",
)
CUSTOMER_COLUMNS = ("customer_id", "age", "club_member_status")
METRIC_VERSION = "v2.0"
# Target file sizes of the layers.
SILVER_FILE_BYTES = 128 * 1024 * 1024
GOLD_FILE_BYTES = 256 * 1024 * 1024


def _or_default(c: str, default: str):
    """Null or empty -> ``default``. These columns become partition folders,
    where an empty value would come back as null; mapping it first keeps one
    stable group."""
    return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(default))


# ------------------------------------------------------------------- silver
def customers_silver(bronze: DataFrame, as_of=None,
                     order_by: Sequence[Column | str] | None = None) -> DataFrame:
    """C16: age to int -> audit columns -> one row per customer -> hash ->
    age category -> customer_id not null.

    The survivor per customer follows ``order_by`` (default: every other
    column ascending, nulls last), never the arrival order.
    """
    df = bronze.withColumn("age", legacy_int("age"))
    # De-duplicate before adding the audit columns: they are constants of the
    # run, so the survivor is the same and the sort key stays narrow.
    df = dedup(df, ["customer_id"], order_by)
    df = audit_columns(df, as_of)
    return (df.withColumn("customer_hash", content_hash("customer_id", "age"))
              .withColumn("age_category", bucketize("age", AGE_CATEGORY))
              .where(F.col("customer_id").isNotNull()))


def articles_silver(bronze: DataFrame, as_of=None,
                    order_by: Sequence[Column | str] | None = None,
                    default_category: str = "UNKNOWN") -> DataFrame:
    """C17: audit columns -> category default -> completeness over the 22
    article columns -> article_id not null -> one row per article."""
    missing = [c for c in ARTICLE_COLUMNS if c not in bronze.columns]
    df = bronze.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else bronze
    # Key filter and de-duplication on the bronze columns first: the audit,
    # category and score columns are constants or functions of those
    # columns, so the survivor is the same and only survivors are scored.
    df = dedup(df.where(F.col("article_id").isNotNull()), ["article_id"], order_by)
    df = audit_columns(df, as_of, with_partitions=False)
    return (df.withColumn("product_category", _or_default("product_type_name", default_category))
              .withColumn("data_completeness_score", completeness(list(ARTICLE_COLUMNS))))


# --------------------------------------------------------------------- gold
def customers_gold(silver: DataFrame, as_of=None, accuracy: int = 10000,
                   compat: bool = False) -> DataFrame:
    """C19: age profile per member status, left-joined with the status's
    age-category breakdown.

    Null status is cleaned to ``UNKNOWN`` once, before both sides; with
    ``compat=True`` the breakdown uses the raw status, so the cleaned
    ``UNKNOWN`` row finds no breakdown (the source's behaviour).
    """
    clean = silver.withColumn("club_member_status", _or_default("club_member_status", "UNKNOWN"))
    stats = (profile(clean, ["club_member_status"], "age", count_of="customer_id",
                     count_name="total_customers", accuracy=accuracy)
             .withColumn("calculation_timestamp", calculation_timestamp(as_of))
             .withColumn("metric_version", F.lit(METRIC_VERSION)))
    breakdown = category_breakdown(silver if compat else clean, "club_member_status",
                                   "age_category", count_of="customer_id",
                                   list_name="age_categories")
    # Both sides are one row per status and already hash-partitioned on it.
    return stats.join(breakdown, "club_member_status", "left")


def articles_gold(silver: DataFrame, as_of=None, sort: bool = True,
                  default_category: str = "UNCATEGORIZED") -> DataFrame:
    """C20: diversity profile per product category (input returned as is when
    empty)."""
    if silver.isEmpty():
        return silver
    clean = silver.withColumn("product_category", _or_default("product_category", default_category))
    out = diversity(clean, "product_category", count_of="article_id",
                    count_name="total_articles",
                    distinct={"unique_colours": "colour_group_name",
                              "unique_perceived_colours": "perceived_colour_master_name",
                              "unique_indexes": "index_name"},
                    score="data_completeness_score", score_name="completeness_score",
                    set_col="garment_group_name", set_name="garment_groups")
    out = out.withColumn("calculation_timestamp", calculation_timestamp(as_of))
    return out.orderBy(F.col("total_articles").desc()) if sort else out


def cross_metrics(customers: DataFrame, articles: DataFrame, as_of=None) -> DataFrame:
    """C13 on the two silver tables: one row, no join."""
    c = summary(customers, count_of="customer_id", count_name="total_customers",
                distinct_of="club_member_status", distinct_name="unique_member_statuses",
                mean_of="age", mean_name="overall_avg_age", kind_name="customer_metric_type",
                kind="customers")
    a = summary(articles, count_of="article_id", count_name="total_articles",
                distinct_of="product_category", distinct_name="unique_categories",
                mean_of="data_completeness_score", mean_name="overall_avg_completeness",
                kind_name="article_metric_type", kind="articles")
    return cross_summary(c, a, left_count="total_customers", right_count="total_articles",
                         completeness="overall_avg_completeness", as_of=as_of)


# ---------------------------------------------------------------------- job
# Record key, partition columns and sort of each gold table.
GOLD_LAYOUT = {"customer_stats": ("club_member_status", ["club_member_status"], None),
               "article_stats": ("product_category", None, ["total_articles desc"]),
               "cross_metrics": ("metric_id", None, None)}


def gold_tables(customers: DataFrame, articles: DataFrame, as_of=None) -> dict[str, DataFrame]:
    """The three gold frames, one row per record key: of several, the one with
    the latest ``calculation_timestamp``. Without articles there are no article
    stats, and that table is left out."""
    frames = {"customer_stats": customers_gold(customers, as_of),
              "article_stats": articles_gold(articles, as_of, sort=False),
              "cross_metrics": cross_metrics(customers, articles, as_of)}
    return {k: upsert(None, df, [GOLD_LAYOUT[k][0]], "calculation_timestamp")
            for k, df in frames.items() if "calculation_timestamp" in df.columns}


def silver_checks(key: str) -> list:
    return [not_null(key), Unique((key,))]


def _sources(customers_csv: str, articles_csv: str) -> dict[str, tuple]:
    """Per silver table: bronze path, cleaning step, record key, partition
    columns, and whether fields may hold line breaks."""
    return {"customers": (customers_csv, customers_silver, "customer_id", ["year", "month"], False),
            "articles": (articles_csv, articles_silver, "article_id", ["product_category"], True)}


def run_retail(spark: SparkSession, customers_csv: str, articles_csv: str, root: str,
               as_of=None, preview: bool = False) -> dict[str, int]:
    """C22: bronze CSV -> silver tables -> gold tables, partitioned Parquet below
    ``root``. Returns the rows of each, as read back.

    Silver is written once and gold is computed from the written tables, so
    every gold table of a run sees the same silver rows. Article descriptions
    may hold line breaks. Rows that don't fit their file's header stay out of
    silver and are kept below ``root/quarantine``. Every table is read back
    after it was written, compared with what was written, and checked for its
    key; the job fails where either doesn't hold.
    """
    out: dict[str, int] = {}

    def put(name: str, df: DataFrame, key: str, parts, sort, size: int) -> DataFrame:
        df, seen = observed(df)
        write_table(df, f"{root}/{name}", parts, sort_within=sort, target_file_bytes=size)
        table = read_table(spark, f"{root}/{name}", df.schema)
        out[name.replace("/", ".")] = verify(table, seen, silver_checks(key), name)
        if preview:
            table.show(5, truncate=False)
        return table

    silver = {}
    for name, (path, clean, key, parts, multiline) in _sources(customers_csv, articles_csv).items():
        bronze, bad_rows, bad = read_bronze(spark, path, multiline=multiline)
        rows = upsert(None, clean(bronze, as_of), [key], "update_timestamp")
        silver[name] = put(f"silver/{name}", rows, key, parts, None, SILVER_FILE_BYTES)
        quarantine(bad_rows, bad, path, f"{root}/quarantine/{name}")
    for name, df in gold_tables(silver["customers"], silver["articles"], as_of).items():
        key, parts, sort = GOLD_LAYOUT[name]
        put(f"gold/{name}", df, key, parts, sort, GOLD_FILE_BYTES)
    return out


def run_retail_catalog(spark: SparkSession, customers_csv: str | None, articles_csv: str | None,
                       silver: str = "silver", gold: str = "gold", root: str | None = None, as_of=None,
                       preview: bool = False) -> dict[str, int]:
    """C22 through the session catalog, for one arrival after another: the rows
    of the bronze files are merged into the keyed silver tables (created where
    missing), of which only the partitions they lie in or move to are read and
    rewritten; the gold tables are made from the silver tables and overwritten.
    A key that arrives again takes its row of the later ``as_of``; of equal
    ones, that of the later run, so a repeated run changes nothing.

    A source without a file (None) keeps its table as it is; gold needs both
    silver tables, and is left out until both are there. Rows that don't fit
    their header are kept below ``root`` (else the checkpoint folder), by arrival.
    Silver tables are checked for their keys after the merge, and gold tables are
    compared with what was written. Returns the rows of each table.
    """
    as_of = as_of or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    arrival = re.sub("[^0-9]", "", str(as_of))
    ensure_namespace(spark, silver, gold, root=root)
    kept = f"{root}/quarantine" if root else scratch_path(spark, "quarantine")
    out: dict[str, int] = {}

    for name, (path, clean, key, parts, multiline) in _sources(customers_csv, articles_csv).items():
        if path is None:
            continue
        table = f"{silver}.{name}"
        bronze, bad_rows, bad = read_bronze(spark, path, multiline=multiline)
        rows = clean(bronze, as_of)
        if spark.catalog.tableExists(table):
            upsert_partitions(spark, table, rows, [key], "update_timestamp", parts, target_file_bytes=SILVER_FILE_BYTES)
        else:
            create_keyed_table(rows, table, [key], "update_timestamp", parts, target_file_bytes=SILVER_FILE_BYTES)
        quarantine(bad_rows, bad, path, f"{kept}/{name}/arrival={arrival}")
        out[table] = checked(spark.table(table), silver_checks(key), table)

    tables = [f"{silver}.customers", f"{silver}.articles"]
    if not all(spark.catalog.tableExists(t) for t in tables):
        return out
    for name, df in gold_tables(*[spark.table(t) for t in tables], as_of).items():
        key, parts, sort = GOLD_LAYOUT[name]
        table = f"{gold}.{name}"
        df, seen = observed(df)
        write_catalog_table(df, table, parts, sort_within=sort, target_file_bytes=GOLD_FILE_BYTES)
        out[table] = verify(spark.table(table), seen, silver_checks(key), table)
        if preview:
            spark.table(table).show(5, truncate=False)
    return out


def main(argv: list[str] | None = None) -> dict[str, int]:
    """``python -m strata.plans.retail --customers ... --articles ... --root ...``

    On a cluster: ``spark-submit --py-files strata.zip strata/plans/retail.py ...``.
    """
    import argparse
    import json

    from strata.session import get_session
    ap = argparse.ArgumentParser(description="retail layers: bronze CSV -> silver -> gold")
    ap.add_argument("--customers", required=True, help="bronze customers CSV path")
    ap.add_argument("--articles", required=True, help="bronze articles CSV path")
    ap.add_argument("--root", required=True, help="lake root (silver/ and gold/ below it)")
    ap.add_argument("--as-of", default=None, help="run instant, UTC (default: now)")
    ap.add_argument("--preview", action="store_true", help="show the gold tables")
    a = ap.parse_args(argv)
    spark = get_session(app="strata-retail")
    try:
        ids = run_retail(spark, a.customers, a.articles, a.root, as_of=a.as_of, preview=a.preview)
        print(json.dumps(ids))
        return ids
    finally:
        spark.catalog.clearCache()


if __name__ == "__main__":
    main()
