"""Incremental ingestion runs and catalog helpers."""

import os

from strata.plans.retail import CUSTOMER_COLUMNS, customers_silver, run_retail_catalog
from strata.streaming import ingest_bronze_stream
from strata.tables import ensure_namespace, list_tables, write_catalog_table


def test_incremental_runs_pick_up_only_new_files(spark, tmpdir_path):
    bronze = os.path.join(tmpdir_path, "bronze")
    os.makedirs(bronze)
    with open(os.path.join(bronze, "f1.csv"), "w") as fh:
        fh.write("customer_id,age,club_member_status\nc1,20,A\nc2,30,B\n")
    ensure_namespace(spark, "streamed", root=tmpdir_path)
    kw = dict(columns=CUSTOMER_COLUMNS, name="streamed.customers", partition_by=["year", "month"],
              keys=["customer_id"], precombine="update_timestamp",
              checkpoint=os.path.join(tmpdir_path, "ckpt"))
    run1 = ingest_bronze_stream(spark, bronze, transform=lambda b: customers_silver(
        b, "2024-01-01 00:00:00"), **kw)
    assert run1 == 1
    with open(os.path.join(bronze, "f2.csv"), "w") as fh:
        fh.write("customer_id,age,club_member_status\nc2,31,B\nc3,40,C\n")
    run2 = ingest_bronze_stream(spark, bronze, transform=lambda b: customers_silver(
        b, "2024-01-01 01:00:00"), **kw)
    assert run2 == 1
    assert ingest_bronze_stream(spark, bronze, transform=lambda b: customers_silver(
        b, "2024-01-01 02:00:00"), **kw) == 0                   # nothing new
    rows = {r.customer_id: r.age for r in
            spark.table("streamed.customers").collect()}
    assert rows == {"c1": 20, "c2": 31, "c3": 40}


def test_catalog_helpers(spark):
    ensure_namespace(spark, "silver_t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    write_catalog_table(df, "silver_t.demo", partition_by=["k"])
    write_catalog_table(df.where("id = 1"), "silver_t.demo", partition_by=["k"])
    assert spark.table("silver_t.demo").count() == 1
    assert [r.tableName for r in list_tables(spark, "silver_t").collect()
            if not r.isTemporary] == ["demo"]
    top = spark.sql("SELECT id FROM silver_t.demo WHERE id <= 10 ORDER BY id LIMIT 10")
    assert [r.id for r in top.collect()] == [1]


def _csv(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def _files(root):
    found = {}
    for folder, _, names in os.walk(root):
        found.update({os.path.join(folder, n): os.path.getmtime(os.path.join(folder, n))
                      for n in names if n.endswith(".parquet")})
    return found


def test_retail_catalog_merges_arrivals(spark, tmpdir_path):
    head = "customer_id,age,club_member_status\n"
    arts = "article_id,product_type_name,detail_desc\n"
    one = (_csv(tmpdir_path, "c1.csv", head + "c1,20,A\nc2,30,B\nc2,31,B\nc3,x,\n,50,A\nbad,1,2,3\n"),
           _csv(tmpdir_path, "a1.csv", arts + 'a1,Coat,"soft\ncotton"\na2,Hat,plain\na3,,none\n'))
    names = ("rc_silver", "rc_gold")

    def run(customers, articles, as_of):
        return run_retail_catalog(spark, customers, articles, *names, root=tmpdir_path, as_of=as_of)

    assert run(one[0], None, "2024-05-01 00:00:00") == {"rc_silver.customers": 3}      # no gold yet
    got = run(None, one[1], "2024-05-01 00:00:00")
    assert got == {"rc_silver.articles": 3, "rc_gold.customer_stats": 3, "rc_gold.article_stats": 3,
                   "rc_gold.cross_metrics": 1}
    before = _files(f"{tmpdir_path}/rc_silver/articles")
    assert len(before) == 3

    # a2 moves to another category, c2 to another month; one row doesn't fit
    two = (_csv(tmpdir_path, "c2.csv", head + "c2,60,B\nc4,40,A\nbad,1,2,3\nworse,1,2,3\n"),
           _csv(tmpdir_path, "a2.csv", arts + "a2,Coat,moved\n"))
    run(*two, "2024-06-01 00:00:00")

    def customers():
        return {r.customer_id: (r.age, r.month) for r in spark.table("rc_silver.customers").collect()}

    def articles():
        return {r.article_id: (r.product_category, r.detail_desc) for r in spark.table("rc_silver.articles").collect()}

    after_customers = {"c1": (20, 5), "c2": (60, 6), "c3": (None, 5), "c4": (40, 6)}
    after_articles = {"a1": ("Coat", "soft\ncotton"), "a2": ("Coat", "moved"), "a3": ("UNKNOWN", "none")}
    assert customers() == after_customers and articles() == after_articles
    after = _files(f"{tmpdir_path}/rc_silver/articles")
    kept = {f: t for f, t in before.items() if "UNKNOWN" in f}
    assert kept and all(after.get(f) == t for f, t in kept.items())                    # not rewritten
    assert not any("Hat" in f for f in after)                                          # moved away
    stats = {r.club_member_status: r.total_customers for r in spark.table("rc_gold.customer_stats").collect()}
    assert stats == {"A": 2, "B": 1, "UNKNOWN": 1}
    assert {r.product_category: r.total_articles for r in spark.table("rc_gold.article_stats").collect()} == {
        "Coat": 2, "UNKNOWN": 1}

    # an older arrival and a repeated one change nothing
    run(*one, "2024-05-01 00:00:00")
    run(*two, "2024-06-01 00:00:00")
    assert customers() == after_customers and articles() == after_articles
    bad = spark.read.parquet(f"{tmpdir_path}/quarantine/customers")                    # kept by arrival
    assert bad.count() == 3 and bad.select("arrival").distinct().count() == 2


def test_quality_index_does_not_hang_on_the_order_of_a_sum(spark):
    from pyspark.sql import functions as F

    from strata.operators import cross_summary
    one = spark.range(1).select(F.lit(2).alias("n"))
    for mean in (0.40025, 0.4002499999999999, 0.4002500000000001):
        other = spark.range(1).select(F.lit(3).alias("k"), F.lit(mean).alias("mean"))
        out = cross_summary(one, other, left_count="n", right_count="k", completeness="mean").first()
        assert (out.data_quality_index, out.potential_combinations) == (40.03, 6)
