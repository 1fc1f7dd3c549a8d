"""Column functions on the edge rows of the source rules."""

from pyspark.sql import functions as F

from strata.functions import (AGE_CATEGORY, AGE_GROUP, EXPERIENCE_LEVEL, SALARY_BUCKET,
                              bucketize, completeness, content_hash, education_level, gender,
                              job_title, legacy_double, legacy_int, rename_columns,
                              strip_to_number)


def _one(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_legacy_int_matches_pre_ansi_cast(spark):
    vals = [None, "x", "", "30.0", "30.9", " 30 ", "1e2", "-4.7", "NaN", "99999999999"]
    assert _one(spark, vals, legacy_int) == [None, None, None, 30, 30, 30, None, -4, None, None]


def test_legacy_double(spark):
    assert _one(spark, [" 5 ", "1e5", "abc", None], legacy_double) == [5.0, 100000.0, None, None]


def test_strip_to_number(spark):
    vals = ["$1,234.50", "-5", "1.2.3", "1e5", "", "49999.99"]
    assert _one(spark, vals, strip_to_number) == [1234.5, 5.0, None, 15.0, None, 49999.99]


def test_bucketize_edges_and_null(spark):
    got = _one(spark, [None, 17, 18, 34, 35, 49, 50, 64, 65],
               lambda c: bucketize(c, AGE_CATEGORY), "int")
    assert got == ["elder", "junior", "young_adult", "young_adult", "middle_age", "middle_age",
                   "senior", "senior", "elder"]
    assert _one(spark, [None, 1.99, 2.0, 4.99, 5.0, 9.99, 10.0],
                lambda c: bucketize(c, EXPERIENCE_LEVEL), "double") == \
        ["Expert", "Entry", "Mid", "Mid", "Senior", "Senior", "Expert"]
    assert _one(spark, [24, 25, 54, 55], lambda c: bucketize(c, AGE_GROUP), "int") == \
        ["18-24", "25-34", "45-54", "55+"]
    assert _one(spark, [49999.99, 50000.0, 149999.0, 150000.0],
                lambda c: bucketize(c, SALARY_BUCKET), "double") == \
        ["Under 50k", "50k-75k", "100k-150k", "Over 150k"]


def test_education_rules(spark):
    vals = ["bachelor's degree", "Doctorate", "PhD", " Diploma ", "", None,
            "Bachelor and Master", "high school", "Associate Degree"]
    assert _one(spark, vals, education_level) == [
        "Bachelor's", "PhD", "PhD", "Diploma", "", "UNKNOWN", "Bachelor's", "High School",
        "Associate"]


def test_gender_and_job_title(spark):
    assert _one(spark, ["m", "F", " m ", "Other", None], gender) == \
        ["Male", "Female", "m", "Other", None]
    assert _one(spark, [" data analyst ", None], job_title) == ["DATA ANALYST", "Unknown Position"]


def test_completeness_and_hash(spark):
    df = spark.createDataFrame([("1", None, "a"), ("2", "b", "c")], "k string, a string, b string")
    got = df.select(completeness(["k", "a", "b"]).alias("c"),
                    content_hash("k", "a").alias("h"),
                    content_hash("k", "a", sep="|", null_marker="~").alias("h2")).collect()
    assert [r.c for r in got] == [2 / 3.0, 1.0]
    assert got[0].h is None and got[1].h is not None
    assert got[0].h2 is not None
    # no separator: ("12","3") and ("1","23") collide; with one they do not
    pairs = spark.createDataFrame([("12", "3"), ("1", "23")], "a string, b string")
    plain = {r[0] for r in pairs.select(content_hash("a", "b")).collect()}
    sep = {r[0] for r in pairs.select(content_hash("a", "b", sep="|")).collect()}
    assert len(plain) == 1 and len(sep) == 2


def test_rename_columns(spark):
    df = spark.createDataFrame([(1, 2)], "Age int, Salary int")
    assert rename_columns(df, {"age": "age", "SALARY": "salary"}).columns == ["age", "salary"]
