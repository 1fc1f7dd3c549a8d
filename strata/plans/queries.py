"""Registered queries: one per operator / layered step, over the test tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the DuckDB oracle of the same name (``strata.plans.oracle``). Output
rules: runs use the fixed ``AS_OF``, whose columns are rendered as text, lists
are joined strings, unrounded floating statistics are rounded to 9 decimals.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import (AGE_CATEGORY, AGE_GROUP, EXPERIENCE_LEVEL, SALARY_BUCKET,
                              bucketize, completeness, content_hash, education_level,
                              job_title, legacy_double, legacy_int, standardize,
                              strip_to_number)
from strata.functions.numeric import rounded_mean
from strata.functions.moments import moment_sums, moments_of
from strata.operators import (benchmarks, category_breakdown, counts_of_bitmaps, cross_summary, dedup,
                              distinct_bitmaps, diversity,
                              gap_overview, gap_pairs, group_stats, most_common, premium, profile, profile_of_parts,
                              profile_parts, ranked_groups, summary,
                              top_dense_rank)
from strata.plans import retail, salary
from strata.plans.standins import bronze_articles, bronze_customers, bronze_salary, table
from strata.session import materialize, scratch_path, small_tasks
from strata.sources import read_bronze_csv
from strata.tables import (COMMIT_ID, Rows, Unique, check_rows, cluster, cluster_by_curve, create_keyed_table, ensure_namespace, in_domain,
                           list_tables, merge_on_read, not_null, numbered, read_table, upsert, upsert_partitions,
                           write_table)

AS_OF = "2024-06-15 12:00:00"
CLOCK = {"update_timestamp": "yyyy-MM-dd HH:mm:ss", "etl_date": "yyyy-MM-dd",
         "calculation_timestamp": "yyyy-MM-dd HH:mm:ss"}

# Rules for the standardize query over part names (own values, not source rules).
SHAPE_RULES = ((("RING", "GEAR"), "Round"), (("BOLT", "ROD"), "Fastener"), ("PLATE", "Flat"))


def _r9(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in cols})


def _clock(df: DataFrame) -> DataFrame:
    """The run's time columns as text, the times in UTC."""
    def text(c: str, kind: str, form: str):
        return F.date_format(F.to_utc_timestamp(c, F.current_timezone()) if kind == "timestamp" else c, form)

    kinds = dict(df.dtypes)
    return df.withColumns({c: text(c, kinds[c], f) for c, f in CLOCK.items() if c in kinds})


def _joined(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.array_join(col, ","))


# ------------------------------------------------------------ column functions
def q_bucketize(spark, d):
    c = table(spark, d, "customer")
    return c.select("c_custkey",
                    bucketize(F.col("c_acctbal") / 100, AGE_CATEGORY).alias("age_category"),
                    bucketize(F.col("c_nationkey") / 2.0, EXPERIENCE_LEVEL).alias("experience_level"),
                    bucketize(F.col("c_acctbal") / 100, AGE_GROUP).alias("age_group"),
                    bucketize(F.col("c_acctbal") * 20, SALARY_BUCKET).alias("salary_bucket"))


def q_standardize(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey",
                    standardize("p_name", SHAPE_RULES, null_value="NONE").alias("shape"),
                    education_level("p_name").alias("education"),
                    job_title("p_type").alias("title"))


def q_numeric_clean(spark, d):
    c = table(spark, d, "customer")
    s = F.col("c_acctbal").cast("string")
    return c.select("c_custkey", strip_to_number("c_name").alias("name_number"),
                    legacy_int(s).alias("balance_int"), legacy_double(s).alias("balance"))


def q_completeness(spark, d):
    o = table(spark, d, "orders")
    cols = [F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")),
            F.col("o_totalprice")]
    return o.select("o_orderkey", completeness(cols).alias("completeness"))


def q_content_hash(spark, d):
    o = table(spark, d, "orders")
    st = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return o.select("o_orderkey",
                    content_hash("o_orderkey", st, "o_totalprice").alias("row_hash"),
                    content_hash("o_orderkey", st, "o_totalprice", sep="|",
                                 null_marker="<null>").alias("row_hash_sep"))


# ------------------------------------------------------------------- operators
def q_dedup(spark, d):
    e = table(spark, d, "events")
    out = dedup(e, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])
    return out.select("event_id", "user_id", "event_type", "value")


def q_profile(spark, d):
    c = table(spark, d, "customer")
    out = profile(c, ["c_mktsegment"], "c_acctbal", "acctbal", count_name="n")
    return _r9(out, "avg_acctbal", "stddev_acctbal", "variance_acctbal")


def q_group_stats(spark, d):
    # The supplier id is rendered as text: in the labelled output it is null
    # on the rows of the other keys, and a nullable integer column has no
    # common representation across engines' result frames.
    li = table(spark, d, "lineitem").withColumn("l_suppkey", F.col("l_suppkey").cast("string"))
    return group_stats(li, ["l_returnflag", "l_linestatus", "l_suppkey"], "l_extendedprice",
                       "l_quantity", value_name="price", second_name="quantity")


def q_category_breakdown(spark, d):
    c = table(spark, d, "customer").withColumn(
        "balance_band", bucketize("c_acctbal", (0, 2500, 5000, 7500),
                                  ("negative", "low", "mid", "high", "top")))
    out = category_breakdown(c, "c_mktsegment", "balance_band", count_of="c_custkey",
                             list_name="balance_bands", total_name="total_in_bands")
    return _joined(out, "balance_bands")


def q_diversity(spark, d):
    p = table(spark, d, "part").withColumns({
        "first_word": F.split("p_name", " ").getItem(0),
        "second_word": F.split("p_name", " ").getItem(1)})
    out = diversity(p, "p_brand", count_of="p_partkey", count_name="total_parts",
                    distinct={"unique_types": "p_type", "unique_sizes": "p_size",
                              "unique_first_words": "first_word"},
                    score="p_retailprice", score_name="retailprice",
                    set_col="second_word", set_name="second_words")
    return _joined(_r9(out, "avg_retailprice"), "second_words")


def _supplier_ranks(spark, d):
    return ranked_groups(table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice",
                         "l_quantity", "l_returnflag", min_n=3, value_name="price",
                         second_name="quantity", distinct_name="flag_variety",
                         rank_name="price_rank", count_name="n")


def q_ranked_groups(spark, d):
    return _supplier_ranks(spark, d)


def q_top_ranked(spark, d):
    li = table(spark, d, "lineitem")
    agg = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"),
                                      rounded_mean("l_extendedprice", 2).alias("avg_price"))
    return top_dense_rank(agg.where(F.col("n") >= 3), "avg_price", 10, out="price_rank")


def q_premium(spark, d):
    li = table(spark, d, "lineitem")
    out = premium(li, "l_returnflag", "l_extendedprice", "l_discount", "l_linestatus",
                  base=30000, step=10000, value_name="price", second_name="discount",
                  count_name="n", distinct_name="unique_statuses", list_name="statuses")
    return out.withColumn("statuses", F.array_join(F.transform(
        "statuses", lambda e: F.concat(e["l_linestatus"], F.lit(":"), e["n"].cast("string"))), ","))


LINE_NAMES = {"value_name": "price", "second_name": "quantity", "count_name": "n"}


def q_gap_overview(spark, d):
    return gap_overview(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice",
                        "l_quantity", distinct={"unique_suppliers": "l_suppkey",
                                                "unique_parts": "l_partkey"}, **LINE_NAMES)


def q_gap_pairs(spark, d):
    return gap_pairs(table(spark, d, "lineitem"), "l_returnflag", "l_linestatus",
                     "l_extendedprice", "l_quantity", **LINE_NAMES)


def q_benchmarks(spark, d):
    li = table(spark, d, "lineitem")
    return benchmarks(li, "l_extendedprice", "l_quantity",
                      distinct={"total_suppliers": "l_suppkey", "total_parts": "l_partkey",
                                "return_flags": "l_returnflag"},
                      benchmark_id="lineitem_overall", prefix="overall", value_name="price",
                      second_name="quantity", count_name="total_records")


def q_cross_summary(spark, d):
    c = summary(table(spark, d, "customer"), count_of="c_custkey", count_name="total_customers",
                distinct_of="c_mktsegment", distinct_name="unique_segments", mean_of="c_acctbal",
                mean_name="avg_balance", kind_name="customer_metric_type", kind="customers")
    p = summary(table(spark, d, "part"), count_of="p_partkey", count_name="total_parts",
                distinct_of="p_brand", distinct_name="unique_brands", mean_of="p_retailprice",
                mean_name="avg_retailprice", kind_name="part_metric_type", kind="parts")
    out = cross_summary(c, p, left_count="total_customers", right_count="total_parts",
                        completeness="avg_retailprice", as_of=AS_OF)
    return _r9(_clock(out), "avg_balance", "avg_retailprice")


def q_distinct_partitions(spark, d):
    o = table(spark, d, "orders")
    return (o.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
             .distinct().orderBy("year", "month"))


def q_moments(spark, d):
    """Mean, variance and stddev by exact sums: the same in any order of rows."""
    sums = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        *moment_sums("l_extendedprice", "p"), *moment_sums("l_discount", "q"))
    p, q = moments_of("p"), moments_of("q")
    return sums.select("l_returnflag", "l_linestatus", *[
        F.round(c, digits).alias(f"{k}_{name}") for name, m, digits in (("price", p, 4), ("discount", q, 8))
        for k, c in m.items()])


def q_distinct_rollup(spark, d):
    """Distinct counts by flag and status, by flag, and in all, from one set of bitmaps."""
    li = table(spark, d, "lineitem")
    names = {"n_suppliers": "l_suppkey", "n_parts": "l_partkey", "n_days": "l_shipdate", "n_orders": "l_orderkey"}
    with small_tasks(spark):
        bits = materialize(distinct_bitmaps(li, ["l_returnflag", "l_linestatus"], list(names.values())), "bitmaps")
    out = counts_of_bitmaps(bits, ["l_returnflag", "l_linestatus"], names)
    by_flag = counts_of_bitmaps(bits, ["l_returnflag"], names)
    return out.unionByName(by_flag, True).unionByName(counts_of_bitmaps(bits, [], names), True)


def q_common_parts(spark, d):
    """The ten parts that each supplier delivers most often."""
    return most_common(table(spark, d, "lineitem"), ["l_suppkey"], "l_partkey", 10, width=512)


#: Quartiles of parts come from sketches; rounded to the sketch's error they can't be
#: compared with exact ones, so the entry shows how far their ranks are off at most.
RANK_ERROR = 0.01


def q_profile_parts(spark, d):
    """Event values by type from the stored parts of single days, one write per
    week, against the rows: the quartiles' ranks must be within RANK_ERROR."""
    e = table(spark, d, "events").select("event_type", "value", F.to_date("ts").alias("day"), "ts")
    ts, edges = F.col("ts"), [F.lit(x).cast("timestamp_ntz") for x in DELTA_EDGES]
    arrivals = [e.where(ts < edges[0]), e.where((ts >= edges[0]) & (ts < edges[1])),
                e.where((ts >= edges[1]) & (ts < edges[2])), e.where(ts >= edges[2])]
    root = scratch_path(spark, "event_parts")
    for k, rows in enumerate(arrivals):
        write_table(profile_parts(rows, ["day", "event_type"], "value"), f"{root}/arrival={k}")
    gold = profile_of_parts(read_table(spark, root), ["event_type"], "value")
    points = {"q1_value": 0.25, "median_value": 0.5, "q3_value": 0.75}
    v = F.col("value")
    ranks = e.join(gold.select("event_type", *points), "event_type").groupBy("event_type").agg(*[
        ((F.count_if(v < F.col(q)) <= F.count(v) * (at + RANK_ERROR))
         & (F.count_if(v <= F.col(q)) >= F.count(v) * (at - RANK_ERROR))).alias(f"{q}_fits")
        for q, at in points.items()])
    out = gold.select("event_type", "n", "avg_value", "min_value", "max_value", "stddev_value").join(ranks, "event_type")
    return out.withColumns({c: F.round(c, 6) for c in ("avg_value", "stddev_value")})


# ---------------------------------------------------------------------- tables
def _events_split(spark, d):
    e = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return e


def q_upsert_latest(spark, d):
    e = _events_split(spark, d)
    base = e.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    changes = e.where(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    out = upsert(base, changes, ["user_id", "event_type"], "value", tie_break=["event_id"])
    return out.select("event_id", "user_id", "event_type", "value")


DELTA_EDGES = ("2024-01-09", "2024-01-16", "2024-01-23")


def q_merge_on_read(spark, d):
    """A base table and three delta tables, written one by one, read as one."""
    e = _events_split(spark, d)
    ts = F.col("ts")
    edges = [F.lit(x).cast("timestamp_ntz") for x in DELTA_EDGES]
    parts = [e.where(ts < edges[0]), e.where((ts >= edges[0]) & (ts < edges[1])),
             e.where((ts >= edges[1]) & (ts < edges[2])), e.where(ts >= edges[2])]
    root = scratch_path(spark, "mor_events")
    for k, df in enumerate(parts):
        write_table(df, f"{root}/{k}")
    base, *deltas = (read_table(spark, f"{root}/{k}", e.schema) for k in range(len(parts)))
    out = merge_on_read(base, deltas, ["user_id", "event_type"], "value", tie_break=["event_id"])
    return out.select("event_id", "user_id", "event_type", "value")


def _namespace(spark, d, name: str) -> str:
    """A namespace of its own for each call, below the checkpoint folder."""
    space = f"{name}_{zlib.crc32(scratch_path(spark, d).encode()):08x}"
    ensure_namespace(spark, space, root=scratch_path(spark, name))
    return space


def q_global_upsert(spark, d):
    """Urgent orders change their partition: keyed on the order alone."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice",
                                         "o_orderpriority")
    name = f"{_namespace(spark, d, 'orders_by_status')}.orders"
    first = numbered(o.withColumn("version", F.lit(1)), 1)
    create_keyed_table(first, name, ["o_orderkey"], "version", ["o_orderstatus"])
    moved = (o.where(F.col("o_orderpriority") == "1-URGENT")
              .withColumn("o_orderstatus", F.lit("U"))
              .withColumn("o_totalprice", F.col("o_totalprice") * 2)
              .withColumn("version", F.lit(2)))
    upsert_partitions(spark, name, moved, ["o_orderkey"], "version", ["o_orderstatus"], commit=2)
    return spark.table(name).select("o_orderkey", "o_orderstatus", "o_totalprice", "version", COMMIT_ID)


def q_upsert_partitions(spark, d):
    """Orders partitioned by year and month; the pending ones of 1995 are closed
    a year later, so that rows leave some partitions for others."""
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"), F.lit(1).alias("version"))
    name = f"{_namespace(spark, d, 'orders_by_month')}.orders"
    create_keyed_table(o, name, ["o_orderkey"], "version", ["year", "month"])
    late = (o.where((F.col("o_orderstatus") == "P") & (F.col("year") == 1995))
             .withColumns({"o_orderstatus": F.lit("F"), "year": F.col("year") + 1, "version": F.lit(2)}))
    upsert_partitions(spark, name, late, ["o_orderkey"], "version", ["year", "month"])
    return spark.table(name)


def q_snapshot_roundtrip(spark, d):
    c = numbered(table(spark, d, "customer"), 1)
    path = scratch_path(spark, "customer_snapshot")
    write_table(c, path, ["c_mktsegment"], sort_within=["c_custkey"])
    return read_table(spark, path, c.schema, c.columns)


def q_table_checks(spark, d):
    """The check rows of the line items: size, key, nulls, domains."""
    return check_rows(table(spark, d, "lineitem"), [
        Rows(least=1), Unique(("l_orderkey", "l_linenumber")), Unique(("l_orderkey",)), not_null("l_shipdate"),
        in_domain("l_returnflag", ["A", "N", "R"]), in_domain("l_linestatus", ["O"]),
        in_domain("l_returnflag", ["N", "R"], most=0.5)])


def q_history(spark, d):
    """What happened day by day: events, users and value by type."""
    e = table(spark, d, "events")
    out = e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("user_id").alias("n_users"),
        rounded_mean("value", 2).alias("avg_value"))
    return out


def q_retention(spark, d):
    """Users by the week of their first event who come back in later weeks."""
    week = F.floor(F.datediff("ts", F.lit("2024-01-01")) / 7).cast("int")
    seen = table(spark, d, "events").select("user_id", week.alias("week")).distinct()
    first = seen.groupBy("user_id").agg(F.min("week").alias("cohort"))
    return (seen.join(first, "user_id").groupBy("cohort", (F.col("week") - F.col("cohort")).alias("weeks_later"))
                .agg(F.count(F.lit(1)).alias("n_users")))


def q_layout_rewrite(spark, d):
    """Line items stored as they come, then that table rewritten by ship date."""
    li = numbered(table(spark, d, "lineitem"), 1)
    stored, path = scratch_path(spark, "lineitem_stored"), scratch_path(spark, "lineitem_layout")
    write_table(li, stored)
    write_table(cluster(numbered(read_table(spark, stored, li.schema), 2), ["l_shipdate"]), path, rebalance=False)
    return read_table(spark, path, li.schema).select(
        "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
        "l_quantity", COMMIT_ID)


def q_layout_curve(spark, d):
    """Line items written along a curve over ship date and price, read back."""
    li = table(spark, d, "lineitem")
    path = scratch_path(spark, "lineitem_curve")
    write_table(cluster_by_curve(li, ["l_shipdate", "l_extendedprice"]), path, rebalance=False)
    return read_table(spark, path, li.schema).select(
        "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"), "l_extendedprice")


CUSTOMER_CSV_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def q_csv_scan(spark, d):
    path = scratch_path(spark, "customer_csv")
    table(spark, d, "customer").write.option("header", True).csv(path)
    b = read_bronze_csv(spark, path, CUSTOMER_CSV_COLUMNS)
    return b.select(legacy_int("c_custkey").alias("c_custkey"), "c_name",
                    legacy_int("c_nationkey").alias("c_nationkey"),
                    legacy_double("c_acctbal").alias("c_acctbal"), "c_mktsegment",
                    "_corrupt_record")


def q_csv_multiline(spark, d):
    """Documents as CSV with their line breaks, quotes and commas, read in splits."""
    path = scratch_path(spark, "documents_csv")
    docs = table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.replace("text", F.lit("\r"), F.lit(" ")).alias("text"), "lang")
    docs.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    b = read_bronze_csv(spark, path, ["doc_id", "text", "lang"], multiline=True)
    return b.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2("text", 256).alias("text_sha256"), "lang",
                    F.col("_corrupt_record").isNull().alias("fits"))


# ---------------------------------------------------------- retail layered job
def _customers(spark, d):
    return retail.customers_silver(bronze_customers(spark, d), AS_OF)


def _articles(spark, d):
    return retail.articles_silver(bronze_articles(spark, d), AS_OF)


def _age_as_text(df: DataFrame) -> DataFrame:
    # age is null for unparseable input; a nullable integer column has no
    # common representation across engines' result frames, text does.
    return df.withColumn("age", F.col("age").cast("string"))


def q_customers_silver(spark, d):
    return _age_as_text(_clock(_customers(spark, d)))


def q_customer_stats(spark, d):
    out = retail.customers_gold(_silver_table(spark, _customers(spark, d), "customers"), AS_OF)
    out = _r9(_clock(out), "avg_age", "stddev_age", "variance_age")
    return _joined(out, "age_categories")


def q_articles_silver(spark, d):
    return _articles(spark, d).select("article_id", "product_category",
                                      "data_completeness_score", "colour_group_name",
                                      "garment_group_name")


def q_article_stats(spark, d):
    silver = _silver_table(spark, _articles(spark, d), "articles")
    out = _clock(retail.articles_gold(silver, AS_OF))
    out = _r9(out, "avg_completeness_score", "min_completeness_score", "max_completeness_score")
    return _joined(out, "garment_groups")


def q_cross_metrics(spark, d):
    out = _clock(retail.cross_metrics(_customers(spark, d), _articles(spark, d), AS_OF))
    return _r9(out, "overall_avg_age", "overall_avg_completeness")


# ---------------------------------------------------------- salary layered job
def _salary(spark, d):
    return salary.salary_silver(bronze_salary(spark, d), AS_OF)


def _silver_table(spark, df: DataFrame, name: str) -> DataFrame:
    """Write a silver frame as a table and read it back, as the layered job
    does: gold steps then scan a table (with column pruning) instead of
    re-running the silver chain once per consumer. (The versioned-table path
    itself is exercised by the whole-job, table and streaming queries.)"""
    return materialize(df, f"silver_{name}")


def _salary_table(spark, d):
    return _silver_table(spark, _salary(spark, d), "salary_detailed")


def q_salary_silver(spark, d):
    return _clock(_salary(spark, d))


def q_salary_group_stats(spark, d):
    stats = group_stats(_salary_table(spark, d), list(salary.STAT_KEYS), "salary",
                        "years_of_experience")
    return stats


# Quartiles here are compared with exact ones. The default sketch accuracy
# (10,000) is exact only for groups of a few thousand rows; 1,000,000 keeps
# the sketch exact up to ~10^6 rows per group (still a bounded sketch).
EXACT_REGIME_ACCURACY = 1_000_000


def q_experience_trends(spark, d):
    return _clock(salary.experience_trends(_salary_table(spark, d), AS_OF,
                                                 accuracy=EXACT_REGIME_ACCURACY))


def _positions_text(out: DataFrame) -> DataFrame:
    return out.withColumn("common_positions", F.array_join(F.transform(
        "common_positions",
        lambda e: F.concat(e["job_title"], F.lit(":"), e["n"].cast("string"))), ","))


def q_education_impact(spark, d):
    return _positions_text(_clock(salary.education_impact(_salary_table(spark, d), AS_OF)))


def q_gender_pay_overview(spark, d):
    return _clock(salary.gender_pay_overview(_salary_table(spark, d), AS_OF))


def q_gender_pay_by_education(spark, d):
    return _clock(salary.gender_pay_by_education(_salary_table(spark, d), AS_OF))


def q_job_title_analysis(spark, d):
    return _clock(salary.job_title_analysis(_salary_table(spark, d), AS_OF))


def q_top_paying_jobs(spark, d):
    """SQL text over the gold table, as the source's read-back does. The ten
    ranks come from a top-k over the groups; the others aren't made."""
    salary.top_paying_jobs(_salary_table(spark, d), salary.TOP_JOBS, AS_OF) \
        .createOrReplaceTempView("job_title_salary_analysis")
    return salary.view(spark, "top_jobs")


def q_industry_benchmarks(spark, d):
    return _clock(salary.industry_benchmarks(_salary_table(spark, d), AS_OF))


# ------------------------------------------------- whole jobs, CSV to gold
def _bronze_csv(spark, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    df.write.option("header", True).csv(path)
    return path


def _run_retail(spark, d) -> str:
    cust = _bronze_csv(spark, bronze_customers(spark, d), "bronze_customers")
    arts = _bronze_csv(spark, bronze_articles(spark, d), "bronze_articles")
    root = scratch_path(spark, "retail_lake")
    retail.run_retail(spark, cust, arts, root, as_of=AS_OF)
    return root


def _run_salary(spark, d) -> str:
    src = _bronze_csv(spark, bronze_salary(spark, d), "bronze_salary")
    root = scratch_path(spark, "salary_lake")
    salary.run_salary(spark, src, root, as_of=AS_OF, accuracy=EXACT_REGIME_ACCURACY)
    return root


# One run of a job serves the queries that read its other tables.
_LAKES: dict[tuple[str, str, str], str] = {}


def _job_table(spark, d, job: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, d, job)
    if key not in _LAKES:
        _LAKES[key] = (_run_retail if job == "retail" else _run_salary)(spark, d)
    return _clock(read_table(spark, f"{_LAKES[key]}/{name}"))


def q_retail_run_customers(spark, d):
    return _age_as_text(_job_table(spark, d, "retail", "silver/customers"))


def q_retail_run_articles(spark, d):
    return _job_table(spark, d, "retail", "silver/articles").select(
        "article_id", "product_category", "data_completeness_score", "colour_group_name",
        "garment_group_name")


def q_retail_run_article_stats(spark, d):
    out = _job_table(spark, d, "retail", "gold/article_stats")
    out = _r9(out, "avg_completeness_score", "min_completeness_score", "max_completeness_score")
    return _joined(out, "garment_groups")


def q_retail_run_cross_metrics(spark, d):
    return _r9(_job_table(spark, d, "retail", "gold/cross_metrics"), "overall_avg_age",
               "overall_avg_completeness")


def q_salary_run_detail(spark, d):
    return _job_table(spark, d, "salary", "silver/salary_detailed")


def q_salary_education_stats(spark, d):
    return _job_table(spark, d, "salary", "silver/salary_education_stats")


def q_salary_job_stats(spark, d):
    return _job_table(spark, d, "salary", "silver/salary_job_stats")


def q_salary_gender_stats(spark, d):
    return _job_table(spark, d, "salary", "silver/salary_gender_stats")


def q_salary_run_experience_trends(spark, d):
    return _job_table(spark, d, "salary", "gold/salary_experience_trends")


def q_salary_run_education_impact(spark, d):
    return _positions_text(_job_table(spark, d, "salary", "gold/education_salary_impact"))


def q_salary_run_gender_pay_overview(spark, d):
    return _job_table(spark, d, "salary", "gold/gender_pay_overview")


def q_salary_run_gender_pay_by_education(spark, d):
    return _job_table(spark, d, "salary", "gold/gender_pay_by_education")


def q_salary_run_benchmarks(spark, d):
    return _job_table(spark, d, "salary", "gold/industry_benchmarks")


def q_retail_run_customer_stats(spark, d):
    """The retail job end to end: bronze CSV files -> silver tables -> gold
    tables; the customer stats gold table is read back."""
    root = _run_retail(spark, d)
    out = _clock(read_table(spark, f"{root}/gold/customer_stats"))
    out = _r9(out, "avg_age", "stddev_age", "variance_age")
    return _joined(out, "age_categories")


def q_salary_run_job_titles(spark, d):
    """The salary job end to end; the job-title gold table is read back."""
    root = _run_salary(spark, d)
    return _clock(read_table(spark, f"{root}/gold/job_title_salary_analysis"))


# ------------------------------------------- the salary job in the catalog
def _salary_catalog(spark, d) -> tuple[str, str]:
    """(silver, gold) namespaces of one catalog run per session and folder."""
    key = (spark.sparkContext.applicationId, d, "catalog")
    tag = f"{zlib.crc32(d.encode()):08x}"
    names = f"salary_silver_{tag}", f"salary_gold_{tag}"
    if key not in _LAKES:
        src = _bronze_csv(spark, bronze_salary(spark, d), "bronze_salary")
        _LAKES[key] = scratch_path(spark, "salary_catalog")
        salary.run_salary_catalog(spark, src, *names, root=_LAKES[key], as_of=AS_OF,
                                  accuracy=EXACT_REGIME_ACCURACY)
    return names


def q_catalog_salary_detail(spark, d):
    return _clock(spark.table(f"{_salary_catalog(spark, d)[0]}.salary_detailed"))


def q_catalog_tables(spark, d):
    """The listing of both namespaces, with the rows of each table."""
    out = None
    for layer, name in zip(("silver", "gold"), _salary_catalog(spark, d)):
        for t in list_tables(spark, name).where("not isTemporary").collect():   # ten names
            rows = spark.table(f"{name}.{t.tableName}").select(
                F.lit(layer).alias("layer"), F.lit(t.tableName).alias("table_name"))
            out = rows if out is None else out.unionAll(rows)
    return out.groupBy("layer", "table_name").agg(F.count("*").alias("n_rows"))


def q_catalog_salary_sample(spark, d):
    """Ten detail rows; the first ones in order, so that every run agrees."""
    return salary.view(spark, "salary_sample", _salary_catalog(spark, d)[0])


def q_catalog_education_stats(spark, d):
    stats = spark.sql("TABLE IDENTIFIER(:stats)",
                      {"stats": f"{_salary_catalog(spark, d)[0]}.salary_education_stats"})
    return _clock(stats)


def q_catalog_education_view(spark, d):
    return salary.view(spark, "education_view", _salary_catalog(spark, d)[1])


def q_catalog_top_jobs(spark, d):
    return salary.view(spark, "top_jobs", _salary_catalog(spark, d)[1], f"pay_rank <= {salary.TOP_JOBS}")


def q_catalog_benchmark_view(spark, d):
    return salary.view(spark, "benchmark_view", _salary_catalog(spark, d)[1])


# ------------------------------------------- the retail job in the catalog
EARLIER = "2024-05-15 12:00:00"


def _retail_catalog(spark, d) -> tuple[str, str]:
    """(silver, gold) namespaces of one session and folder after two arrivals:
    customers of the first two batches and all articles a month earlier, then
    the last batch, and the promoted articles under a category of their own."""
    key = (spark.sparkContext.applicationId, d, "retail catalog")
    tag = f"{zlib.crc32(d.encode()):08x}"
    names = f"retail_silver_{tag}", f"retail_gold_{tag}"
    if key not in _LAKES:
        root = scratch_path(spark, "retail_catalog")
        customers, articles = bronze_customers(spark, d, with_batch=True), bronze_articles(spark, d)
        promoted = articles.where("product_group_name = 'PROMO'").withColumn("product_type_name", F.lit("Promoted"))
        for as_of, some, arts in ((EARLIER, "batch < 2", articles), (AS_OF, "batch = 2", promoted)):
            retail.run_retail_catalog(
                spark, _bronze_csv(spark, customers.where(some).drop("batch"), "bronze_customers"),
                _bronze_csv(spark, arts, "bronze_articles"), *names, root=root, as_of=as_of)
        _LAKES[key] = root
    return names


def q_catalog_retail_customers(spark, d):
    return _age_as_text(_clock(spark.table(f"{_retail_catalog(spark, d)[0]}.customers")))


def q_catalog_retail_articles(spark, d):
    return _clock(spark.table(f"{_retail_catalog(spark, d)[0]}.articles")).select(
        "article_id", "product_category", "data_completeness_score", "colour_group_name",
        "garment_group_name", "update_timestamp")


def q_catalog_retail_customer_stats(spark, d):
    out = _clock(spark.table(f"{_retail_catalog(spark, d)[1]}.customer_stats"))
    return _joined(_r9(out, "avg_age", "stddev_age", "variance_age"), "age_categories")


def q_catalog_retail_article_stats(spark, d):
    out = _clock(spark.table(f"{_retail_catalog(spark, d)[1]}.article_stats"))
    out = _r9(out, "avg_completeness_score", "min_completeness_score", "max_completeness_score")
    return _joined(out, "garment_groups")


def q_catalog_retail_cross_metrics(spark, d):
    return _r9(_clock(spark.table(f"{_retail_catalog(spark, d)[1]}.cross_metrics")), "overall_avg_age",
               "overall_avg_completeness")


def q_stream_customers_silver(spark, d):
    """Incremental ingestion: bronze customer files arrive in three batches
    (by order year); after each arrival one AvailableNow streaming run
    upserts the new file into the silver table. Per customer, the row of the
    latest batch holding it wins (equal run instant, later batch first)."""
    from strata.streaming import ingest_bronze_stream
    root = scratch_path(spark, "stream_customers")
    name = f"{_namespace(spark, d, 'stream_silver')}.customers"
    bronze = bronze_customers(spark, d, with_batch=True)
    for b in range(3):
        (bronze.where(F.col("batch") == b).drop("batch")
               .write.option("header", True).csv(f"{root}/bronze/batch={b}"))
        ingest_bronze_stream(spark, f"{root}/bronze/*/*.csv", retail.CUSTOMER_COLUMNS, name,
                             ["customer_id"], "update_timestamp",
                             lambda df: retail.customers_silver(df, AS_OF),
                             checkpoint=f"{root}/_stream", partition_by=["year", "month"])
    return _age_as_text(_clock(spark.table(name)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bucketize": q_bucketize,
    "standardize": q_standardize,
    "numeric_clean": q_numeric_clean,
    "completeness": q_completeness,
    "content_hash": q_content_hash,
    "dedup": q_dedup,
    "profile": q_profile,
    "group_stats": q_group_stats,
    "category_breakdown": q_category_breakdown,
    "diversity": q_diversity,
    "ranked_groups": q_ranked_groups,
    "top_ranked": q_top_ranked,
    "premium": q_premium,
    "moments": q_moments,
    "distinct_rollup": q_distinct_rollup,
    "common_parts": q_common_parts,
    "profile_parts": q_profile_parts,
    "gap_overview": q_gap_overview,
    "gap_pairs": q_gap_pairs,
    "benchmarks": q_benchmarks,
    "cross_summary": q_cross_summary,
    "distinct_partitions": q_distinct_partitions,
    "upsert_latest": q_upsert_latest,
    "merge_on_read": q_merge_on_read,
    "global_upsert": q_global_upsert,
    "upsert_partitions": q_upsert_partitions,
    "table_checks": q_table_checks,
    "snapshot_roundtrip": q_snapshot_roundtrip,
    "history": q_history,
    "retention": q_retention,
    "layout_rewrite": q_layout_rewrite,
    "layout_curve": q_layout_curve,
    "csv_scan": q_csv_scan,
    "csv_multiline": q_csv_multiline,
    "customers_silver": q_customers_silver,
    "customer_stats": q_customer_stats,
    "articles_silver": q_articles_silver,
    "article_stats": q_article_stats,
    "cross_metrics": q_cross_metrics,
    "salary_silver": q_salary_silver,
    "salary_group_stats": q_salary_group_stats,
    "experience_trends": q_experience_trends,
    "education_impact": q_education_impact,
    "gender_pay_overview": q_gender_pay_overview,
    "gender_pay_by_education": q_gender_pay_by_education,
    "job_title_analysis": q_job_title_analysis,
    "top_paying_jobs": q_top_paying_jobs,
    "industry_benchmarks": q_industry_benchmarks,
    "retail_run_customer_stats": q_retail_run_customer_stats,
    "salary_run_job_titles": q_salary_run_job_titles,
    "retail_run_customers": q_retail_run_customers,
    "retail_run_articles": q_retail_run_articles,
    "retail_run_article_stats": q_retail_run_article_stats,
    "retail_run_cross_metrics": q_retail_run_cross_metrics,
    "salary_run_detail": q_salary_run_detail,
    "salary_education_stats": q_salary_education_stats,
    "salary_job_stats": q_salary_job_stats,
    "salary_gender_stats": q_salary_gender_stats,
    "salary_run_experience_trends": q_salary_run_experience_trends,
    "salary_run_education_impact": q_salary_run_education_impact,
    "salary_run_gender_pay_overview": q_salary_run_gender_pay_overview,
    "salary_run_gender_pay_by_education": q_salary_run_gender_pay_by_education,
    "salary_run_benchmarks": q_salary_run_benchmarks,
    "catalog_salary_detail": q_catalog_salary_detail,
    "catalog_tables": q_catalog_tables,
    "catalog_salary_sample": q_catalog_salary_sample,
    "catalog_education_stats": q_catalog_education_stats,
    "catalog_education_view": q_catalog_education_view,
    "catalog_top_jobs": q_catalog_top_jobs,
    "catalog_benchmark_view": q_catalog_benchmark_view,
    "catalog_retail_customers": q_catalog_retail_customers,
    "catalog_retail_articles": q_catalog_retail_articles,
    "catalog_retail_customer_stats": q_catalog_retail_customer_stats,
    "catalog_retail_article_stats": q_catalog_retail_article_stats,
    "catalog_retail_cross_metrics": q_catalog_retail_cross_metrics,
    "stream_customers_silver": q_stream_customers_silver,
}
