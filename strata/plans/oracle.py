"""DuckDB oracle SQL for every registered query (same column names).

Written independently of the Spark code path: plain SQL over the test
tables. Spark's ``round(x, d)`` rounds the shortest decimal form of a double
half-up; :func:`_rnd` reproduces that in DuckDB through a decimal cast
(DuckDB's own ``round`` on doubles differs on ties such as 1.005).
"""

from __future__ import annotations


def _rnd(expr: str, digits: int = 2) -> str:
    return (f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,16)), {digits}) "
            f"AS DOUBLE)")


def _xmean(x: str, digits: int = 2) -> str:
    """Exact mean rounded HALF_UP (away from zero): integer arithmetic on the
    decimal(38,10) sum, matching a decimal mean rounded in Spark."""
    t = f"CAST(SUM(CAST({x} AS DECIMAL(38,10))) * 10000000000 AS HUGEINT)"
    div = f"(COUNT({x}) * CAST({10 ** (10 - digits)} AS HUGEINT))"
    units = f"(sign({t}) * ((2 * abs({t}) + {div}) // (2 * {div})))"
    return f"(CAST({units} AS DOUBLE) / {10 ** digits})"


def _xmedian(x: str, digits: int = 2) -> str:
    return f"CAST(ROUND(median(CAST({x} AS DECIMAL(38,10))), {digits}) AS DOUBLE)"


def _r9(expr: str) -> str:
    return _rnd(expr, 9)


def _case(x: str, edges, labels) -> str:
    parts = " ".join(f"WHEN {x} < {e} THEN '{l}'" for e, l in zip(edges, labels))
    return f"CASE {parts} ELSE '{labels[-1]}' END"


AGE_CAT = ((18, 35, 50, 65), ("junior", "young_adult", "middle_age", "senior", "elder"))
EXP_LVL = ((2, 5, 10), ("Entry", "Mid", "Senior", "Expert"))
AGE_GRP = ((25, 35, 45, 55), ("18-24", "25-34", "35-44", "45-54", "55+"))
SAL_BKT = ((50000, 75000, 100000, 150000),
           ("Under 50k", "50k-75k", "75k-100k", "100k-150k", "Over 150k"))

# ----------------------------------------------------------- stand-in chains
SILVER_CUSTOMERS = f"""
bronze_customers AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL
              ELSE CAST(trunc(o_totalprice / 5000) AS INTEGER) END AS age,
         NULLIF(o_orderstatus, 'P') AS club_member_status
  FROM orders),
silver_customers AS (
  SELECT customer_id, age, club_member_status,
         CAST(2024 AS INTEGER) AS year, CAST(6 AS INTEGER) AS month,
         sha256(customer_id || CAST(age AS VARCHAR)) AS customer_hash,
         {_case('age', *AGE_CAT)} AS age_category
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                   ORDER BY age ASC NULLS LAST, club_member_status ASC NULLS LAST) AS rn
        FROM bronze_customers)
  WHERE rn = 1 AND customer_id IS NOT NULL)"""

SILVER_ARTICLES = """
silver_articles AS (
  SELECT CAST(p_partkey AS VARCHAR) AS article_id,
         COALESCE(NULLIF(p_brand, 'Brand#1'), 'UNKNOWN') AS product_category,
         (7 + CASE WHEN p_brand <> 'Brand#1' THEN 1 ELSE 0 END
            + CASE WHEN p_type <> 'PROMO' THEN 1 ELSE 0 END) / CAST(22.0 AS DOUBLE)
           AS data_completeness_score,
         split_part(p_name, ' ', 1) AS colour_group_name,
         NULLIF(p_type, 'PROMO') AS perceived_colour_master_name,
         p_type AS index_name,
         split_part(p_name, ' ', 2) AS garment_group_name
  FROM part)"""

_EDU = ("CASE WHEN edu IS NULL THEN 'UNKNOWN' "
        "WHEN contains(upper(edu), 'BACHELOR') THEN 'Bachelor''s' "
        "WHEN contains(upper(edu), 'MASTER') THEN 'Master''s' "
        "WHEN contains(upper(edu), 'PHD') OR contains(upper(edu), 'DOCTORATE') THEN 'PhD' "
        "WHEN contains(upper(edu), 'HIGH SCHOOL') THEN 'High School' "
        "WHEN contains(upper(edu), 'ASSOCIATE') THEN 'Associate' ELSE trim(edu) END")

SILVER_SALARY = f"""
raw_salary AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN NULL
              ELSE CAST(trunc(20 + o_totalprice / 10000) AS INTEGER) END AS age,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN lower(o_orderstatus)
              ELSE o_orderstatus END AS g,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Doctorate'
              WHEN '2-HIGH' THEN 'master''s degree' WHEN '3-MEDIUM' THEN 'Bachelor of Science'
              WHEN '4-NOT SPECIFIED' THEN ' Diploma ' ELSE 'high school' END AS edu,
         'position ' || CAST(o_custkey AS VARCHAR) AS job,
         CAST(month(o_orderdate) - 1 AS DOUBLE) + day(o_orderdate) / CAST(32.0 AS DOUBLE)
           AS years_of_experience,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN NULL
              ELSE o_totalprice END AS salary
  FROM orders),
std_salary AS (
  SELECT age,
         CASE WHEN upper(g) = 'M' THEN 'Male' WHEN upper(g) = 'F' THEN 'Female'
              ELSE trim(g) END AS gender,
         {_EDU} AS education_level,
         CASE WHEN job IS NULL THEN 'Unknown Position' ELSE trim(upper(job)) END AS job_title,
         years_of_experience, salary
  FROM raw_salary),
silver_salary AS (
  SELECT age, gender, education_level, job_title, years_of_experience, salary,
         CAST(2024 AS INTEGER) AS year, CAST(6 AS INTEGER) AS month,
         {_case('years_of_experience', *EXP_LVL)} AS experience_level,
         {_case('age', *AGE_GRP)} AS age_group,
         {_case('salary', *SAL_BKT)} AS salary_bucket,
         sha256(CAST(age AS VARCHAR) || gender || education_level || job_title
                || CAST(years_of_experience AS VARCHAR)) AS data_hash
  FROM (SELECT *, row_number() OVER (
                   PARTITION BY age, gender, education_level, job_title, years_of_experience
                   ORDER BY salary ASC NULLS LAST) AS rn
        FROM std_salary)
  WHERE rn = 1 AND age IS NOT NULL AND salary IS NOT NULL)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# ------------------------------------------------------------------- queries
_SQL: dict[str, str] = {}

_SQL["bucketize"] = f"""
SELECT c_custkey,
       {_case('(c_acctbal / 100)', *AGE_CAT)} AS age_category,
       {_case('(c_nationkey / 2.0)', *EXP_LVL)} AS experience_level,
       {_case('(c_acctbal / 100)', *AGE_GRP)} AS age_group,
       {_case('(c_acctbal * 20)', *SAL_BKT)} AS salary_bucket
FROM customer"""

_SQL["standardize"] = """
SELECT p_partkey,
       CASE WHEN p_name IS NULL THEN 'NONE'
            WHEN contains(upper(p_name), 'RING') OR contains(upper(p_name), 'GEAR') THEN 'Round'
            WHEN contains(upper(p_name), 'BOLT') OR contains(upper(p_name), 'ROD') THEN 'Fastener'
            WHEN contains(upper(p_name), 'PLATE') THEN 'Flat'
            ELSE trim(p_name) END AS shape,
       """ + _EDU.replace("edu", "p_name") + """ AS education,
       CASE WHEN p_type IS NULL THEN 'Unknown Position' ELSE trim(upper(p_type)) END AS title
FROM part"""

_SQL["numeric_clean"] = """
SELECT c_custkey,
       TRY_CAST(regexp_replace(c_name, '[^0-9.]', '', 'g') AS DOUBLE) AS name_number,
       CAST(trunc(c_acctbal) AS INTEGER) AS balance_int,
       c_acctbal AS balance
FROM customer"""

_SQL["completeness"] = """
SELECT o_orderkey,
       (CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END
        + CASE WHEN o_orderpriority <> '5-LOW' THEN 1 ELSE 0 END
        + CASE WHEN o_totalprice IS NOT NULL THEN 1 ELSE 0 END) / CAST(3.0 AS DOUBLE)
         AS completeness
FROM orders"""

_SQL["content_hash"] = """
SELECT o_orderkey,
       sha256(CAST(o_orderkey AS VARCHAR) || NULLIF(o_orderstatus, 'P')
              || CAST(o_totalprice AS VARCHAR)) AS row_hash,
       sha256(CAST(o_orderkey AS VARCHAR) || '|' || COALESCE(NULLIF(o_orderstatus, 'P'), '<null>')
              || '|' || CAST(o_totalprice AS VARCHAR)) AS row_hash_sep
FROM orders"""

_SQL["dedup"] = """
SELECT event_id, user_id, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""

_SQL["profile"] = f"""
SELECT c_mktsegment, count(*) AS n,
       {_r9('avg(c_acctbal)')} AS avg_acctbal, min(c_acctbal) AS min_acctbal,
       max(c_acctbal) AS max_acctbal, {_r9('stddev_samp(c_acctbal)')} AS stddev_acctbal,
       {_r9('var_samp(c_acctbal)')} AS variance_acctbal,
       quantile_disc(c_acctbal, 0.25) AS q1_acctbal,
       quantile_disc(c_acctbal, 0.5) AS median_acctbal,
       quantile_disc(c_acctbal, 0.75) AS q3_acctbal,
       quantile_disc(c_acctbal, 0.75) - quantile_disc(c_acctbal, 0.25) AS iqr_acctbal
FROM customer GROUP BY c_mktsegment"""


def _gs(key: str, keys: list[str], src: str, v: str, s: str, vn: str, sn: str,
        count_name: str = "record_count") -> str:
    cols = ", ".join(k if k == key else f"NULL AS {k}" for k in keys)
    return (f"SELECT '{key}' AS stat_type, {cols}, {_xmean(v)} AS avg_{vn}, "
            f"{_xmean(s)} AS avg_{sn}, count(*) AS {count_name}, "
            f"{_rnd(f'min({v})')} AS min_{vn}, {_rnd(f'max({v})')} AS max_{vn} "
            f"FROM {src} GROUP BY {key}")


_LI_KEYS = ["l_returnflag", "l_linestatus", "l_suppkey"]
_SQL["group_stats"] = "\nUNION ALL\n".join(
    _gs(k, _LI_KEYS, "(SELECT * REPLACE (CAST(l_suppkey AS VARCHAR) AS l_suppkey) FROM lineitem)",
        "l_extendedprice", "l_quantity", "price", "quantity")
    for k in _LI_KEYS)

_SQL["category_breakdown"] = """
WITH c AS (SELECT *, CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 2500 THEN 'low'
                          WHEN c_acctbal < 5000 THEN 'mid' WHEN c_acctbal < 7500 THEN 'high'
                          ELSE 'top' END AS balance_band FROM customer),
     inner_counts AS (SELECT c_mktsegment, balance_band, count(c_custkey) AS cnt
                      FROM c GROUP BY 1, 2)
SELECT c_mktsegment, string_agg(balance_band, ',' ORDER BY balance_band) AS balance_bands,
       CAST(sum(cnt) AS BIGINT) AS total_in_bands
FROM inner_counts GROUP BY c_mktsegment"""

_SQL["diversity"] = f"""
WITH p AS (SELECT *, split_part(p_name, ' ', 1) AS first_word,
                  split_part(p_name, ' ', 2) AS second_word FROM part),
     g AS (SELECT p_brand, count(p_partkey) AS total_parts,
                  count(DISTINCT p_type) AS unique_types, count(DISTINCT p_size) AS unique_sizes,
                  count(DISTINCT first_word) AS unique_first_words,
                  avg(p_retailprice) AS avg_retailprice, min(p_retailprice) AS min_retailprice,
                  max(p_retailprice) AS max_retailprice,
                  string_agg(DISTINCT second_word, ',' ORDER BY second_word) AS second_words
           FROM p GROUP BY p_brand)
SELECT p_brand, total_parts, unique_types, unique_sizes, unique_first_words,
       {_r9('avg_retailprice')} AS avg_retailprice, min_retailprice, max_retailprice,
       second_words,
       {_rnd('(unique_types + unique_sizes + unique_first_words) / CAST(3 AS DOUBLE)')}
         AS diversity_score,
       {_rnd('unique_types * total_parts / CAST(100 AS DOUBLE)')} AS complexity_index
FROM g"""

_SUPP = f"""
WITH g AS (SELECT l_suppkey, count(*) AS n, {_xmean('l_extendedprice')} AS avg_price,
                  {_xmean('l_quantity')} AS avg_quantity,
                  {_rnd('min(l_extendedprice)')} AS min_price,
                  {_rnd('max(l_extendedprice)')} AS max_price,
                  count(DISTINCT l_returnflag) AS flag_variety,
                  {_rnd('stddev_samp(l_extendedprice)')} AS price_stddev
           FROM lineitem GROUP BY l_suppkey HAVING count(*) >= 3),
     r AS (SELECT *, CAST(dense_rank() OVER (ORDER BY avg_price DESC) AS INTEGER) AS price_rank,
                  max_price - min_price AS price_range FROM g)"""

_SQL["ranked_groups"] = _SUPP + "\nSELECT * FROM r"

_SQL["top_ranked"] = f"""
WITH g AS (SELECT l_suppkey, count(*) AS n, {_xmean('l_extendedprice')} AS avg_price
           FROM lineitem GROUP BY l_suppkey HAVING count(*) >= 3),
     r AS (SELECT *, CAST(dense_rank() OVER (ORDER BY avg_price DESC) AS INTEGER) AS price_rank
           FROM g)
SELECT * FROM r WHERE price_rank <= 10"""

_SQL["premium"] = f"""
WITH lvl AS (SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2),
     lists AS (SELECT l_returnflag,
                      string_agg(l_linestatus || ':' || CAST(n AS VARCHAR), ','
                                 ORDER BY n DESC, l_linestatus ASC) AS statuses
               FROM lvl GROUP BY 1),
     g AS (SELECT l_returnflag, count(*) AS n, {_xmean('l_extendedprice')} AS avg_price,
                  {_xmean('l_discount')} AS avg_discount,
                  {_rnd('max(l_extendedprice)')} AS max_price,
                  count(DISTINCT l_linestatus) AS unique_statuses
           FROM lineitem GROUP BY l_returnflag)
SELECT g.*, lists.statuses, {_rnd('(avg_price - 30000) / CAST(10000 AS DOUBLE)')} AS premium_score
FROM g JOIN lists USING (l_returnflag)"""

_SQL["gap_overview"] = f"""
SELECT l_returnflag, count(*) AS n, {_xmean('l_extendedprice')} AS avg_price,
       {_xmean('l_quantity')} AS avg_quantity,
       count(DISTINCT l_suppkey) AS unique_suppliers, count(DISTINCT l_partkey) AS unique_parts,
       {_xmedian('l_extendedprice')} AS median_price
FROM lineitem GROUP BY l_returnflag"""

_SQL["gap_pairs"] = f"""
SELECT l_returnflag, l_linestatus, count(*) AS n, {_xmean('l_extendedprice')} AS avg_price,
       {_xmean('l_quantity')} AS avg_quantity
FROM lineitem GROUP BY l_returnflag, l_linestatus"""

_SQL["benchmarks"] = f"""
SELECT count(*) AS total_records, {_xmean('l_extendedprice')} AS overall_avg_price,
       {_xmean('l_quantity')} AS overall_avg_quantity,
       {_rnd('stddev_samp(l_extendedprice)')} AS overall_price_stddev,
       count(DISTINCT l_suppkey) AS total_suppliers, count(DISTINCT l_partkey) AS total_parts,
       count(DISTINCT l_returnflag) AS return_flags,
       {_xmedian('l_extendedprice')} AS overall_median_price,
       {_rnd('count(*) / CAST(1000 AS DOUBLE) * 100')} AS data_quality_score,
       'lineitem_overall' AS benchmark_id
FROM lineitem"""

_SQL["cross_summary"] = f"""
WITH c AS (SELECT count(c_custkey) AS total_customers,
                  count(DISTINCT c_mktsegment) AS unique_segments,
                  avg(c_acctbal) AS avg_balance, 'customers' AS customer_metric_type
           FROM customer),
     p AS (SELECT count(p_partkey) AS total_parts, count(DISTINCT p_brand) AS unique_brands,
                  avg(p_retailprice) AS avg_retailprice, 'parts' AS part_metric_type
           FROM part)
SELECT total_customers, unique_segments, {_r9('avg_balance')} AS avg_balance,
       customer_metric_type, total_parts, unique_brands,
       {_r9('avg_retailprice')} AS avg_retailprice, part_metric_type,
       total_customers * total_parts AS potential_combinations,
       {_rnd(_r9('avg_retailprice') + ' * 100')} AS data_quality_index,
       'cross_1718452800' AS metric_id
FROM c, p"""

_SQL["distinct_partitions"] = """
SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders"""

_SQL["upsert_latest"] = """
WITH u AS (SELECT event_id, user_id, event_type, value,
                  CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS src FROM events)
SELECT event_id, user_id, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY value DESC NULLS LAST, src DESC,
                                            event_id ASC NULLS LAST) AS rn FROM u)
WHERE rn = 1"""

_SQL["merge_on_read"] = """
WITH u AS (SELECT event_id, user_id, event_type, value,
                  CASE WHEN ts < TIMESTAMP '2024-01-09' THEN 0
                       WHEN ts < TIMESTAMP '2024-01-16' THEN 1
                       WHEN ts < TIMESTAMP '2024-01-23' THEN 2 ELSE 3 END AS src FROM events)
SELECT event_id, user_id, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY value DESC NULLS LAST, src DESC,
                                            event_id ASC NULLS LAST) AS rn FROM u)
WHERE rn = 1"""

_SQL["global_upsert"] = """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END
         AS o_totalprice,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS version,
       CAST(2 AS BIGINT) AS _commit_id
FROM orders"""

_SQL["upsert_partitions"] = """
SELECT o_orderkey, CASE WHEN late THEN 'F' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
       CAST(year(o_orderdate) + CASE WHEN late THEN 1 ELSE 0 END AS INTEGER) AS year,
       CAST(month(o_orderdate) AS INTEGER) AS month, CASE WHEN late THEN 2 ELSE 1 END AS version
FROM (SELECT *, o_orderstatus = 'P' AND year(o_orderdate) = 1995 AS late FROM orders)"""

_SQL["table_checks"] = """
WITH t AS (SELECT count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS lines,
                  count(DISTINCT l_orderkey) AS orders, count(*) FILTER (l_shipdate IS NULL) AS undated,
                  count(*) FILTER (l_returnflag NOT IN ('A', 'N', 'R')) AS odd_flag,
                  count(*) FILTER (l_linestatus <> 'O') AS not_open,
                  count(*) FILTER (l_returnflag NOT IN ('N', 'R')) AS other_flag FROM lineitem)
SELECT 'rows' AS check_name, n AS n_rows, CAST(0 AS BIGINT) AS n_bad, n >= 1 AS passed FROM t
UNION ALL SELECT 'unique(l_orderkey, l_linenumber)', n, n - lines, n = lines FROM t
UNION ALL SELECT 'unique(l_orderkey)', n, n - orders, n = orders FROM t
UNION ALL SELECT 'not_null(l_shipdate)', n, undated, undated = 0 FROM t
UNION ALL SELECT 'domain(l_returnflag)', n, odd_flag, odd_flag = 0 FROM t
UNION ALL SELECT 'domain(l_linestatus)', n, not_open, not_open = 0 FROM t
UNION ALL SELECT 'domain(l_returnflag)', n, other_flag, other_flag <= n * 0.5 FROM t"""

_SQL["snapshot_roundtrip"] = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(1 AS BIGINT) AS _commit_id
FROM customer"""

_SQL["history"] = f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n_events,
       count(DISTINCT user_id) AS n_users, {_xmean('value')} AS avg_value
FROM events GROUP BY 1, 2"""

_SQL["retention"] = """
WITH seen AS (SELECT DISTINCT user_id, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7.0)
                AS INTEGER) AS week FROM events),
first AS (SELECT user_id, min(week) AS cohort FROM seen GROUP BY user_id)
SELECT cohort, week - cohort AS weeks_later, count(*) AS n_users
FROM seen JOIN first USING (user_id) GROUP BY 1, 2"""

def _exact_moments(x: str, name: str, digits: int) -> str:
    """Mean, sample variance and stddev of a value of at most four decimals, from
    whole-number sums."""
    q = f"CAST(ROUND({x} * 10000) AS HUGEINT)"
    n, s1, s2 = f"CAST(COUNT({x}) AS HUGEINT)", f"SUM({q})", f"SUM({q} * {q})"
    var = f"(CAST({n} * {s2} - {s1} * {s1} AS DOUBLE) / CAST({n} * ({n} - 1) AS DOUBLE) / 1e8)"
    mean = f"(CAST({s1} AS DOUBLE) / CAST({n} AS DOUBLE) / 1e4)"
    return ", ".join(f"ROUND({e}, {digits}) AS {k}_{name}"
                     for k, e in (("mean", mean), ("variance", var), ("stddev", f"sqrt({var})")))


_SQL["moments"] = f"""
SELECT l_returnflag, l_linestatus, {_exact_moments('l_extendedprice', 'price', 4)},
       {_exact_moments('l_discount', 'discount', 8)}
FROM lineitem GROUP BY l_returnflag, l_linestatus"""

_ROLLED = ("COUNT(DISTINCT l_suppkey) AS n_suppliers, COUNT(DISTINCT l_partkey) AS n_parts, "
           "COUNT(DISTINCT l_shipdate) AS n_days, COUNT(DISTINCT l_orderkey) AS n_orders")
_SQL["distinct_rollup"] = f"""
SELECT l_returnflag, l_linestatus, {_ROLLED} FROM lineitem GROUP BY ALL
UNION ALL SELECT l_returnflag, NULL AS l_linestatus, {_ROLLED} FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT NULL AS l_returnflag, NULL AS l_linestatus, {_ROLLED} FROM lineitem"""

_SQL["common_parts"] = """
SELECT l_suppkey, l_partkey, n, CAST(r AS INTEGER) AS rank FROM (
  SELECT l_suppkey, l_partkey, n, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS r
  FROM (SELECT l_suppkey, l_partkey, COUNT(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY ALL))
WHERE r <= 10"""

_SQL["profile_parts"] = """
SELECT event_type, COUNT(*) AS n, ROUND(AVG(CAST(value AS DECIMAL(18,4))), 6) AS avg_value, MIN(value) AS min_value,
       MAX(value) AS max_value, ROUND(stddev_samp(value), 6) AS stddev_value,
       true AS q1_value_fits, true AS median_value_fits, true AS q3_value_fits
FROM events GROUP BY event_type"""

_SQL["layout_curve"] = """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_extendedprice
FROM lineitem"""

_SQL["layout_rewrite"] = """
SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_quantity,
       CAST(2 AS BIGINT) AS _commit_id
FROM lineitem"""

_SQL["csv_multiline"] = """
SELECT doc_id, sha256(replace(text, chr(13), ' ')) AS text_sha256, lang, true AS fits FROM documents"""

_SQL["csv_scan"] = """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       CAST(NULL AS VARCHAR) AS _corrupt_record
FROM customer"""

_SQL["customers_silver"] = _with(SILVER_CUSTOMERS) + """
SELECT * REPLACE (CAST(age AS VARCHAR) AS age) FROM silver_customers"""

_SQL["customer_stats"] = _with(SILVER_CUSTOMERS, f"""
clean AS (SELECT * REPLACE (COALESCE(club_member_status, 'UNKNOWN') AS club_member_status)
          FROM silver_customers),
stats AS (SELECT club_member_status, count(customer_id) AS total_customers,
                 {_r9('avg(age)')} AS avg_age, min(age) AS min_age, max(age) AS max_age,
                 {_r9('stddev_samp(age)')} AS stddev_age, {_r9('var_samp(age)')} AS variance_age,
                 quantile_disc(age, 0.25) AS q1_age, quantile_disc(age, 0.5) AS median_age,
                 quantile_disc(age, 0.75) AS q3_age
          FROM clean GROUP BY club_member_status),
bd AS (SELECT club_member_status, string_agg(age_category, ',' ORDER BY age_category)
                AS age_categories, CAST(sum(cnt) AS BIGINT) AS total_in_categories
       FROM (SELECT club_member_status, age_category, count(customer_id) AS cnt
             FROM clean GROUP BY 1, 2) GROUP BY 1)""") + """
SELECT s.*, 'v2.0' AS metric_version, q3_age - q1_age AS iqr_age,
       bd.age_categories, bd.total_in_categories
FROM stats s LEFT JOIN bd USING (club_member_status)"""

_SQL["articles_silver"] = _with(SILVER_ARTICLES) + """
SELECT article_id, product_category, data_completeness_score, colour_group_name,
       garment_group_name FROM silver_articles"""

_SQL["article_stats"] = _with(SILVER_ARTICLES, """
g AS (SELECT product_category, count(article_id) AS total_articles,
             count(DISTINCT colour_group_name) AS unique_colours,
             count(DISTINCT perceived_colour_master_name) AS unique_perceived_colours,
             avg(data_completeness_score) AS avg_c, min(data_completeness_score) AS min_c,
             max(data_completeness_score) AS max_c,
             string_agg(DISTINCT garment_group_name, ',' ORDER BY garment_group_name)
               AS garment_groups,
             count(DISTINCT index_name) AS unique_indexes
      FROM silver_articles GROUP BY product_category)""") + f"""
SELECT product_category, total_articles, unique_colours, unique_perceived_colours,
       {_r9('avg_c')} AS avg_completeness_score, {_r9('min_c')} AS min_completeness_score,
       {_r9('max_c')} AS max_completeness_score, garment_groups, unique_indexes,
       {_rnd('(unique_colours + unique_perceived_colours + unique_indexes) / CAST(3 AS DOUBLE)')}
         AS diversity_score,
       {_rnd('unique_colours * total_articles / CAST(100 AS DOUBLE)')} AS complexity_index
FROM g"""

_SQL["cross_metrics"] = _with(SILVER_CUSTOMERS, SILVER_ARTICLES, """
c AS (SELECT count(customer_id) AS total_customers,
             count(DISTINCT club_member_status) AS unique_member_statuses,
             avg(age) AS overall_avg_age, 'customers' AS customer_metric_type
      FROM silver_customers),
a AS (SELECT count(article_id) AS total_articles,
             count(DISTINCT product_category) AS unique_categories,
             avg(data_completeness_score) AS overall_avg_completeness,
             'articles' AS article_metric_type
      FROM silver_articles)""") + f"""
SELECT total_customers, unique_member_statuses, {_r9('overall_avg_age')} AS overall_avg_age,
       customer_metric_type, total_articles, unique_categories,
       {_r9('overall_avg_completeness')} AS overall_avg_completeness, article_metric_type,
       total_customers * total_articles AS potential_combinations,
       {_rnd(_r9('overall_avg_completeness') + ' * 100')} AS data_quality_index,
       'cross_1718452800' AS metric_id
FROM c, a"""

_SQL["salary_silver"] = _with(SILVER_SALARY) + "\nSELECT * FROM silver_salary"

_SAL_KEYS = ["education_level", "job_title", "gender"]
_SQL["salary_group_stats"] = _with(SILVER_SALARY) + "\n" + "\nUNION ALL\n".join(
    _gs(k, _SAL_KEYS, "silver_salary", "salary", "years_of_experience", "salary", "experience")
    for k in _SAL_KEYS)

_SQL["experience_trends"] = _with(SILVER_SALARY) + f"""
SELECT experience_level, sample_size, avg_salary, avg_experience, min_salary, max_salary,
       salary_stddev, median_salary, q1_salary, q3_salary, unique_job_titles,
       max_salary - min_salary AS salary_range, q3_salary - q1_salary AS iqr_salary
FROM (SELECT experience_level, count(*) AS sample_size, {_xmean('salary')} AS avg_salary,
             {_xmean('years_of_experience')} AS avg_experience,
             {_rnd('min(salary)')} AS min_salary, {_rnd('max(salary)')} AS max_salary,
             {_rnd('stddev_samp(salary)')} AS salary_stddev,
             {_rnd('quantile_disc(salary, 0.5)')} AS median_salary,
             {_rnd('quantile_disc(salary, 0.25)')} AS q1_salary,
             {_rnd('quantile_disc(salary, 0.75)')} AS q3_salary,
             count(DISTINCT job_title) AS unique_job_titles
      FROM silver_salary GROUP BY experience_level)"""

_SQL["education_impact"] = _with(SILVER_SALARY, """
lvl AS (SELECT education_level, job_title, count(*) AS n FROM silver_salary GROUP BY 1, 2),
lists AS (SELECT education_level,
                 string_agg(job_title || ':' || CAST(n AS VARCHAR), ','
                            ORDER BY n DESC, job_title ASC) AS common_positions
          FROM lvl GROUP BY 1)""") + f"""
SELECT education_level, sample_size, avg_salary, avg_experience, max_salary, unique_positions,
       common_positions,
       {_rnd('(avg_salary - 65000) / CAST(10000 AS DOUBLE)')} AS premium_score
FROM (SELECT education_level, count(*) AS sample_size, {_xmean('salary')} AS avg_salary,
             {_xmean('years_of_experience')} AS avg_experience,
             {_rnd('max(salary)')} AS max_salary,
             count(DISTINCT job_title) AS unique_positions
      FROM silver_salary GROUP BY education_level) g JOIN lists USING (education_level)"""

_SQL["gender_pay_overview"] = _with(SILVER_SALARY) + f"""
SELECT gender, count(*) AS sample_size, {_xmean('salary')} AS avg_salary,
       {_xmean('years_of_experience')} AS avg_experience,
       count(DISTINCT job_title) AS unique_positions,
       count(DISTINCT education_level) AS education_levels,
       {_xmedian('salary')} AS median_salary
FROM silver_salary GROUP BY gender"""

_SQL["gender_pay_by_education"] = _with(SILVER_SALARY) + f"""
SELECT gender, education_level, count(*) AS sample_size, {_xmean('salary')} AS avg_salary,
       {_xmean('years_of_experience')} AS avg_experience
FROM silver_salary GROUP BY gender, education_level"""

_JOBS = _with(SILVER_SALARY, f"""
g AS (SELECT job_title, count(*) AS sample_size, {_xmean('salary')} AS avg_salary,
             {_xmean('years_of_experience')} AS avg_experience,
             {_rnd('min(salary)')} AS min_salary, {_rnd('max(salary)')} AS max_salary,
             count(DISTINCT education_level) AS education_variety,
             {_rnd('stddev_samp(salary)')} AS salary_stddev
      FROM silver_salary GROUP BY job_title HAVING count(*) >= 3),
r AS (SELECT *, CAST(dense_rank() OVER (ORDER BY avg_salary DESC) AS INTEGER) AS pay_rank,
             max_salary - min_salary AS salary_range FROM g)""")

_SQL["job_title_analysis"] = _JOBS + "\nSELECT * FROM r"

_SQL["top_paying_jobs"] = _JOBS + """
SELECT job_title, avg_salary, sample_size, pay_rank FROM r WHERE pay_rank <= 10"""

_SQL["industry_benchmarks"] = _with(SILVER_SALARY) + f"""
SELECT count(*) AS total_records, {_xmean('salary')} AS industry_avg_salary,
       {_xmean('years_of_experience')} AS industry_avg_experience,
       {_rnd('stddev_samp(salary)')} AS industry_salary_stddev,
       count(DISTINCT job_title) AS total_job_titles,
       count(DISTINCT education_level) AS total_education_levels,
       count(DISTINCT gender) AS gender_categories,
       {_xmedian('salary')} AS industry_median_salary,
       {_rnd('count(*) / CAST(1000 AS DOUBLE) * 100')} AS data_quality_score,
       'industry_overall' AS benchmark_id
FROM silver_salary"""

_SQL["stream_customers_silver"] = f"""
WITH bronze AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL
              ELSE CAST(trunc(o_totalprice / 5000) AS INTEGER) END AS age,
         NULLIF(o_orderstatus, 'P') AS club_member_status,
         CASE WHEN year(o_orderdate) < 1997 THEN 0 WHEN year(o_orderdate) < 1999 THEN 1
              ELSE 2 END AS batch
  FROM orders)
SELECT customer_id, CAST(age AS VARCHAR) AS age, club_member_status,
       CAST(2024 AS INTEGER) AS year, CAST(6 AS INTEGER) AS month,
       sha256(customer_id || CAST(age AS VARCHAR)) AS customer_hash,
       {_case('age', *AGE_CAT)} AS age_category
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                 ORDER BY batch DESC, age ASC NULLS LAST, club_member_status ASC NULLS LAST) AS rn
      FROM bronze)
WHERE rn = 1 AND customer_id IS NOT NULL"""

# The whole-job queries read back gold tables equal to the step queries.
_SQL["retail_run_customer_stats"] = _SQL["customer_stats"]
_SQL["salary_run_job_titles"] = _SQL["job_title_analysis"]
_SQL["retail_run_customers"] = _SQL["customers_silver"]
_SQL["retail_run_articles"] = _SQL["articles_silver"]
_SQL["retail_run_article_stats"] = _SQL["article_stats"]
_SQL["retail_run_cross_metrics"] = _SQL["cross_metrics"]
_SQL["salary_run_detail"] = _SQL["salary_silver"]
for _name, _key in (("education", "education_level"), ("job", "job_title"), ("gender", "gender")):
    _SQL[f"salary_{_name}_stats"] = _with(SILVER_SALARY) + "\n" + _gs(
        _key, [_key], "silver_salary", "salary", "years_of_experience", "salary", "experience")
_SQL["salary_run_experience_trends"] = _SQL["experience_trends"]
_SQL["salary_run_education_impact"] = _SQL["education_impact"]
_SQL["salary_run_gender_pay_overview"] = _SQL["gender_pay_overview"]
_SQL["salary_run_gender_pay_by_education"] = _SQL["gender_pay_by_education"]
_SQL["salary_run_benchmarks"] = _SQL["industry_benchmarks"]

# The same job's tables in the session catalog, and the SQL texts over them.
_SQL["catalog_salary_detail"] = _SQL["salary_silver"]
_SQL["catalog_tables"] = "\nUNION ALL\n".join(
    f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS n_rows FROM ({_SQL[same]})"
    for layer, name, same in (
        ("silver", "salary_detailed", "salary_silver"),
        ("silver", "salary_education_stats", "salary_education_stats"),
        ("silver", "salary_job_stats", "salary_job_stats"),
        ("silver", "salary_gender_stats", "salary_gender_stats"),
        ("gold", "salary_experience_trends", "experience_trends"),
        ("gold", "education_salary_impact", "education_impact"),
        ("gold", "gender_pay_overview", "gender_pay_overview"),
        ("gold", "gender_pay_by_education", "gender_pay_by_education"),
        ("gold", "job_title_salary_analysis", "job_title_analysis"),
        ("gold", "industry_benchmarks", "industry_benchmarks")))
_SQL["catalog_salary_sample"] = _with(SILVER_SALARY) + """
SELECT age, gender, education_level, job_title, years_of_experience, salary
FROM silver_salary ORDER BY 1, 2, 3, 4, 5, 6 LIMIT 10"""
_SQL["catalog_education_stats"] = _SQL["salary_education_stats"]
_SQL["catalog_education_view"] = f"""
SELECT education_level, avg_salary, sample_size, premium_score FROM ({_SQL['education_impact']})"""
_SQL["catalog_top_jobs"] = _SQL["top_paying_jobs"]
_SQL["catalog_benchmark_view"] = f"""
SELECT industry_avg_salary, industry_median_salary, total_job_titles, total_records
FROM ({_SQL['industry_benchmarks']})"""

# The retail job in the catalog, after two arrivals.
ARRIVED_CUSTOMERS = f"""
bronze_customers AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL
              ELSE CAST(trunc(o_totalprice / 5000) AS INTEGER) END AS age,
         NULLIF(o_orderstatus, 'P') AS club_member_status, year(o_orderdate) >= 1999 AS late
  FROM orders),
silver_customers AS (
  SELECT customer_id, age, club_member_status,
         CAST(2024 AS INTEGER) AS year, CAST(CASE WHEN late THEN 6 ELSE 5 END AS INTEGER) AS month,
         sha256(customer_id || CAST(age AS VARCHAR)) AS customer_hash,
         {_case('age', *AGE_CAT)} AS age_category
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                   ORDER BY late DESC, age ASC NULLS LAST, club_member_status ASC NULLS LAST) AS rn
        FROM bronze_customers)
  WHERE rn = 1 AND customer_id IS NOT NULL)"""
ARRIVED_ARTICLES = SILVER_ARTICLES.replace(
    "FROM part", "FROM (SELECT * REPLACE (CASE WHEN p_type = 'PROMO' THEN 'Promoted' ELSE p_brand END AS p_brand) FROM part)")


def _arrived(name: str) -> str:
    return _SQL[name].replace(SILVER_CUSTOMERS, ARRIVED_CUSTOMERS).replace(SILVER_ARTICLES, ARRIVED_ARTICLES)


_SQL["catalog_retail_customers"] = f"""
SELECT *, CASE month WHEN 5 THEN '2024-05-15 12:00:00' ELSE '2024-06-15 12:00:00' END AS update_timestamp,
       CASE month WHEN 5 THEN '2024-05-15' ELSE '2024-06-15' END AS etl_date
FROM ({_arrived('customers_silver')})"""
_SQL["catalog_retail_articles"] = f"""
SELECT *, CASE product_category WHEN 'Promoted' THEN '2024-06-15 12:00:00' ELSE '2024-05-15 12:00:00' END
            AS update_timestamp
FROM ({_arrived('articles_silver')})"""
for _name in ("customer_stats", "article_stats", "cross_metrics"):
    _SQL[f"catalog_retail_{_name}"] = _arrived(_name)

# The columns of the run's time, as text.
_AT = "'2024-06-15 12:00:00'"
for _columns, _names in (
        (f"{_AT} AS update_timestamp, '2024-06-15' AS etl_date",
         "customers_silver retail_run_customers stream_customers_silver salary_silver salary_run_detail "
         "catalog_salary_detail"),
        (f"{_AT} AS update_timestamp",
         "salary_education_stats salary_job_stats salary_gender_stats catalog_education_stats"),
        (f"{_AT} AS calculation_timestamp",
         "customer_stats retail_run_customer_stats article_stats retail_run_article_stats cross_metrics "
         "retail_run_cross_metrics cross_summary experience_trends salary_run_experience_trends education_impact "
         "salary_run_education_impact gender_pay_overview salary_run_gender_pay_overview gender_pay_by_education "
         "salary_run_gender_pay_by_education job_title_analysis salary_run_job_titles industry_benchmarks "
         "salary_run_benchmarks catalog_retail_customer_stats catalog_retail_article_stats "
         "catalog_retail_cross_metrics")):
    for _name in _names.split():
        _SQL[_name] = f"SELECT *, {_columns} FROM ({_SQL[_name]})"

ORACLE_SQL: dict[str, str] = dict(_SQL)
