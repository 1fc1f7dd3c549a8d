"""Bronze inputs derived from the shared test tables.

The source jobs read three external CSV files (customers, articles, salary
records). These functions derive equivalent all-string bronze frames from
the test tables, so the full layered chains run over data whose size grows
with the scale factor:

* customers <- ``orders``: one bronze row per order, keyed by customer
  (repeated keys to de-duplicate), price / 5000 as age (unparseable for
  low-priority orders), order status as member status (``P`` -> null);
* articles <- ``part``: brand as product type (``Brand#1`` -> null), words
  of the part name as colour / garment group, type as index;
* salary <- ``orders``: price as salary (formatted with ``$`` and commas;
  some unparseable), priority spelled as education text, customer as job
  title, status as gender, order date as years of experience.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Arrival batches for the incremental run: orders before 1997, 1997-1998, later.
ARRIVAL_YEARS = (1997, 1999)


def bronze_customers(spark: SparkSession, sf_dir: str, with_batch: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    age = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit("unknown"))
           .otherwise((F.col("o_totalprice") / 5000).cast("string")))
    cols = [F.col("o_custkey").cast("string").alias("customer_id"), age.alias("age"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
             .alias("club_member_status")]
    if with_batch:
        yr = F.year("o_orderdate")
        cols.append(F.when(yr < ARRIVAL_YEARS[0], 0).when(yr < ARRIVAL_YEARS[1], 1)
                     .otherwise(2).alias("batch"))
    return o.select(*cols)


def bronze_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    return p.select(
        F.col("p_partkey").cast("string").alias("article_id"),
        F.when(F.col("p_brand") != "Brand#1", F.col("p_brand")).alias("product_type_name"),
        F.col("p_size").cast("string").alias("product_type_no"),
        F.col("p_type").alias("product_group_name"),
        words.getItem(0).alias("colour_group_name"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("perceived_colour_master_name"),
        F.col("p_type").alias("index_name"),
        words.getItem(1).alias("garment_group_name"),
        F.col("p_name").alias("detail_desc"))


def bronze_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    age = (F.when((pr == "1-URGENT") & (st == "O"), F.lit("n/a"))
           .otherwise((F.lit(20) + F.col("o_totalprice") / 10000).cast("string")))
    edu = (F.when(pr == "1-URGENT", "Doctorate").when(pr == "2-HIGH", "master's degree")
           .when(pr == "3-MEDIUM", "Bachelor of Science").when(pr == "4-NOT SPECIFIED", " Diploma ")
           .otherwise("high school"))
    years = ((F.month("o_orderdate") - 1) + F.dayofmonth("o_orderdate") / 32.0).cast("string")
    salary = (F.when((pr == "4-NOT SPECIFIED") & (st == "F"), F.lit("negotiable"))
              .otherwise(F.concat(F.lit("$"), F.format_number("o_totalprice", 2))))
    return o.select(
        age.alias("Age"),
        F.when(pr.isin("1-URGENT", "2-HIGH"), F.lower(st)).otherwise(st).alias("Gender"),
        edu.alias("Education Level"),
        F.concat(F.lit("position "), F.col("o_custkey").cast("string")).alias("Job Title"),
        years.alias("Years of Experience"),
        salary.alias("Salary"))
