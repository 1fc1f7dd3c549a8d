"""Bronze CSV reads and the two layered jobs end to end on small fixtures."""

import os

from pyspark.sql import functions as F

from strata.plans.retail import ARTICLE_COLUMNS, run_retail
from strata.plans.salary import run_salary, salary_silver
from strata.sources import read_bronze_csv
from strata.tables import read_table


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_csv_all_strings_multiline_and_nulls(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "a.csv"),
               'id,desc,n\n1,"comma, ""quote"" and\nline break",5\n2,,""\n')
    df = read_bronze_csv(spark, p, ["id", "desc", "n"], multiline=True)
    rows = df.orderBy("id").collect()
    assert all(t == "string" for _, t in df.dtypes)
    assert rows[0].desc == 'comma, "quote" and\nline break'
    assert rows[1].desc is None and rows[1].n is None
    inferred = read_bronze_csv(spark, p)
    assert all(t == "string" for _, t in inferred.dtypes)


CUSTOMERS = """customer_id,age,club_member_status
c1,30.9,ACTIVE
c1,17,ACTIVE
c1,x,ACTIVE
c2,,PRE-CREATE
c3,64,
c4,65,UNKNOWN
,40,ACTIVE
"""

SALARY = """Age,Gender,Education Level,Job Title,Years of Experience,Salary
30,m,bachelor's degree,data analyst,1.99,"$49,999.99"
30,m,bachelor's degree,data analyst,1.99,"$60,000"
41,F,Doctorate,Engineer,4.99,150000
41,F,PhD,engineer,10,149999
52, m ,,Engineer,5,-5
25,Other, Diploma ,Engineer,2,1.2.3
,F,Master,Engineer,9.99,70000
"""


def test_salary_silver_rules(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "s.csv"), SALARY)
    rows = salary_silver(read_bronze_csv(spark, p), "2024-06-15 12:00:00").collect()
    # duplicate key kept once (smallest salary), unparsable salary and null age dropped
    assert len(rows) == 4
    by_title = sorted((r.gender, r.education_level, r.job_title, r.salary, r.salary_bucket,
                       r.experience_level) for r in rows)
    assert ("Female", "PhD", "ENGINEER", 150000.0, "Over 150k", "Mid") in by_title
    assert ("Male", "Bachelor's", "DATA ANALYST", 49999.99, "Under 50k", "Entry") in by_title
    assert ("m", "UNKNOWN", "ENGINEER", 5.0, "Under 50k", "Senior") in by_title
    assert all(r.year == 2024 and r.month == 6 and len(r.data_hash) == 64 for r in rows)


def test_run_retail_end_to_end(spark, tmpdir_path):
    cust = _write(os.path.join(tmpdir_path, "customers.csv"), CUSTOMERS)
    header = ",".join(ARTICLE_COLUMNS)
    full = ",".join(["a1", "Shirt"] + ["x"] * 20)
    key_only = "a2" + "," * 21
    arts = _write(os.path.join(tmpdir_path, "articles.csv"), f"{header}\n{full}\n{key_only}\n")
    root = os.path.join(tmpdir_path, "lake")
    ids = run_retail(spark, cust, arts, root, as_of="2024-06-15 12:00:00")
    assert set(ids) == {"silver.customers", "silver.articles", "gold.customer_stats",
                        "gold.article_stats", "gold.cross_metrics"}
    silver = read_table(spark, f"{root}/silver/customers")
    assert silver.count() == 4                                   # null key dropped
    c1 = silver.where("customer_id = 'c1'").collect()[0]
    assert c1.age == 17 and c1.age_category == "junior"          # survivor: smallest age
    stats = {r.club_member_status: r for r in
             read_table(spark, f"{root}/gold/customer_stats").collect()}
    assert stats["UNKNOWN"].total_customers == 2                 # null + literal UNKNOWN
    assert stats["UNKNOWN"].total_in_categories == 2
    scores = {r.article_id: r.data_completeness_score for r in
              read_table(spark, f"{root}/silver/articles").collect()}
    assert scores == {"a1": 1.0, "a2": 1 / 22.0}
    cross = read_table(spark, f"{root}/gold/cross_metrics").collect()[0]
    assert cross.potential_combinations == 8 and cross.metric_id == "cross_1718452800"


def test_run_salary_end_to_end(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "salary.csv"), SALARY)
    root = os.path.join(tmpdir_path, "lake")
    ids = run_salary(spark, p, root, as_of="2024-06-15 12:00:00")
    assert len(ids) == 10
    bench = read_table(spark, f"{root}/gold/industry_benchmarks").collect()[0]
    assert bench.total_records == 4 and bench.data_quality_score == 0.4
    jobs = read_table(spark, f"{root}/gold/job_title_salary_analysis")
    assert jobs.collect()[0].job_title == "ENGINEER" and jobs.count() == 1
    by_edu = read_table(spark, f"{root}/gold/gender_pay_by_education")
    assert by_edu.select(F.sum("sample_size")).collect()[0][0] == 4


def test_customers_gold_compat_and_articles_empty(spark):
    from strata.plans.retail import articles_gold, customers_gold
    silver = spark.createDataFrame(
        [("a", 20, None, "young_adult"), ("b", 30, "UNKNOWN", "young_adult"),
         ("c", 40, "ACTIVE", "middle_age")],
        "customer_id string, age int, club_member_status string, age_category string")
    fixed = {r.club_member_status: r for r in customers_gold(silver, "2024-01-01").collect()}
    assert fixed["UNKNOWN"].total_customers == 2 and fixed["UNKNOWN"].total_in_categories == 2
    compat = {r.club_member_status: r for r in
              customers_gold(silver, "2024-01-01", compat=True).collect()}
    # raw breakdown keeps the null status apart: only the literal UNKNOWN row joins
    assert compat["UNKNOWN"].total_customers == 2 and compat["UNKNOWN"].total_in_categories == 1
    empty = silver.where("1 = 0")
    assert articles_gold(empty) is empty


def test_premium_all_null_group_is_null_not_error(spark):
    from strata.operators import premium
    df = spark.createDataFrame([("e", "A", None, None)],
                               "edu string, job string, sal double, yrs double")
    r = premium(df, "edu", "sal", "yrs", "job").collect()[0]
    assert r.avg_salary is None and r.premium_score is None and r.sample_size == 1


def test_empty_partition_values_map_to_default(spark):
    from strata.plans.retail import articles_silver, customers_gold
    arts = spark.createDataFrame([("a1", ""), ("a2", None), ("a3", "Shirt")],
                                 "article_id string, product_type_name string")
    cats = {r.article_id: r.product_category for r in articles_silver(arts, "2024-01-01").collect()}
    assert cats == {"a1": "UNKNOWN", "a2": "UNKNOWN", "a3": "Shirt"}
    cust = spark.createDataFrame([("c1", 30, "", "young_adult"), ("c2", 40, None, "middle_age")],
                                 "customer_id string, age int, club_member_status string, "
                                 "age_category string")
    rows = customers_gold(cust, "2024-01-01").collect()
    assert [(r.club_member_status, r.total_customers) for r in rows] == [("UNKNOWN", 2)]


def test_salary_job_command_line(tmpdir_path):
    import json
    import subprocess
    import sys
    p = _write(os.path.join(tmpdir_path, "salary.csv"), SALARY)
    root = os.path.join(tmpdir_path, "cli_lake")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "strata.plans.salary", "--csv", p, "--root", root,
                          "--as-of", "2024-06-15 12:00:00"], cwd=repo, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    ids = json.loads(out.stdout.strip().splitlines()[-1])
    assert ids["gold.industry_benchmarks"] == 1 and len(ids) == 10


def test_salary_aggregates_split_like_three_group_bys(spark, tmpdir_path):
    from strata.plans.salary import salary_aggregates
    p = _write(os.path.join(tmpdir_path, "s2.csv"), SALARY)
    silver = salary_silver(read_bronze_csv(spark, p), "2024-06-15 12:00:00")
    tables = salary_aggregates(silver, "2024-06-15 12:00:00")
    assert set(tables) == {"education_level", "job_title", "gender"}
    for key, df in tables.items():
        assert key in df.columns and not ({"education_level", "job_title", "gender"} - {key}
                                          ) & set(df.columns)
        plain = {r[0]: r[1] for r in silver.groupBy(key).count().collect()}
        assert {r[key]: r.record_count for r in df.collect()} == plain
        assert {r.stat_type for r in df.collect()} == {key}


def test_one_csv_file_is_read_in_several_partitions_and_bad_rows_are_counted(spark, tmpdir_path):
    from strata.sources import quarantine, read_bronze
    p = _write(os.path.join(tmpdir_path, "big.csv"),
               "id,name\n" + "".join(f"{i},{'x' * 40}\n" for i in range(20000)) + "1,a,too many\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(100_000))
    try:
        assert read_bronze_csv(spark, p).rdd.getNumPartitions() > 1
        df, bad_rows, bad = read_bronze(spark, p)
        assert df.columns == ["id", "name"] and df.select("id").where("id is null").count() == 0
        df, bad_rows, bad = read_bronze(spark, p)
        assert len(df.collect()) == 20000
        kept = os.path.join(tmpdir_path, "kept")
        assert quarantine(bad_rows, bad, p, kept) == 1
        assert [r.bad_record for r in spark.read.parquet(kept).collect()] == ["1,a,too many"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_salary_job_caches_nothing_and_evaluates_the_stats_once(spark, tmpdir_path):
    from strata.plans.salary import salary_aggregates
    p = _write(os.path.join(tmpdir_path, "s3.csv"), SALARY)
    spark.catalog.clearCache()
    run_salary(spark, p, os.path.join(tmpdir_path, "lake3"), as_of="2024-06-15 12:00:00")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
    for df in salary_aggregates(salary_silver(read_bronze_csv(spark, p))).values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" not in plan and "Expand" not in plan


def _multiline(spark, p, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_bronze_csv(spark, p, ["id", "desc", "n"], multiline=True)
        return [tuple(r) for r in df.collect()], spark.read.text(p).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_multiline_csv_in_splits_equals_one_task(spark, tmpdir_path):
    import random
    rng = random.Random(8)
    pool = ["plain", "a, b", 'said ""yes""', "two\nlines", "\n\n\nmany " * 30, "é ü\r\nwindows", "", 'x""\n""y', "1\n2,3\n4,5,6"]
    for name, end in (("unix.csv", "\n"), ("win.csv", "\r\n")):
        text = f"id,desc,n{end}" + "".join(f'{k},"{rng.choice(pool)}",{k * 2}{end}' for k in range(400))
        text += f'400,"last'.replace('"last', '"last\nrow"') + ",1"
        folder = os.path.join(tmpdir_path, name)
        os.makedirs(folder)
        for part in ("one", "two"):
            with open(os.path.join(folder, f"{part}.csv"), "w", encoding="utf-8", newline="") as fh:
                fh.write(text.replace("plain", part))
        want = sorted(tuple(r) for r in spark.read.option("header", True).option("escape", '"').option("multiLine", True)
                      .schema("id string, desc string, n string, _corrupt_record string").csv(folder)
                      .select("id", F.col("desc"), "n").collect())
        for size in (97, 1000, 1 << 20):
            got, tasks = _multiline(spark, folder, size)
            norm = lambda rows: sorted((i, (d or "").replace("\r\n", "\n"), n) for i, d, n, *_ in rows)
            assert norm(got) == norm(want) and len(got) == 802
            assert all(r[3] is None for r in got)
            assert size > 5000 or tasks > 5


def test_bad_rows_and_line_breaks_stay_out_of_silver(spark, tmpdir_path):
    header = ",".join(ARTICLE_COLUMNS)
    rows = [",".join([f"a{k}", "Shirt"] + ["x"] * 19 + ['"soft\ncotton, ""warm"""']) for k in range(3)]
    arts = _write(os.path.join(tmpdir_path, "arts.csv"), "\n".join([header, *rows, "bad," * 30]) + "\n")
    cust = _write(os.path.join(tmpdir_path, "cust.csv"), CUSTOMERS + "c9,1,ACTIVE,more\n")
    root = os.path.join(tmpdir_path, "lake")
    n = run_retail(spark, cust, arts, root, as_of="2024-06-15 12:00:00")
    assert n["silver.articles"] == 3 and n["silver.customers"] == 4
    silver = read_table(spark, f"{root}/silver/articles")
    assert {r.article_id for r in silver.collect()} == {"a0", "a1", "a2"}
    assert {r.detail_desc for r in silver.collect()} == {'soft\ncotton, "warm"'}
    for name in ("articles", "customers"):
        assert spark.read.parquet(f"{root}/quarantine/{name}").count() == 1
