"""Property test: upsert equals a plain-Python latest-wins model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.tables import upsert

ROW = st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 9))


def _model(base, changes):
    best = {}
    for src, rows in ((0, base), (1, changes)):
        for k, ts, v in rows:
            cand = (ts, src, -v)              # greatest ts, then change, then smallest v
            if k not in best or cand > best[k][0]:
                best[k] = (cand, (k, ts, v))
    return sorted(r for _, r in best.values())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(base=st.dictionaries(st.integers(0, 5), st.tuples(st.integers(0, 3), st.integers(0, 9)),
                            max_size=6),
       changes=st.lists(ROW, max_size=8))
def test_upsert_matches_model(spark, base, changes):
    # base is a keyed table: one row per key
    base = [(k, ts, v) for k, (ts, v) in base.items()]
    schema = "k int, ts int, v int"
    b = spark.createDataFrame(base, schema)
    c = spark.createDataFrame(changes, schema)
    got = sorted(tuple(r) for r in upsert(b, c, ["k"], "ts", tie_break=["v"]).collect())
    assert got == _model(base, changes)


VALUES = st.one_of(st.none(), st.integers(-20, 20).map(lambda x: x / 4))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", None]), VALUES),
                     min_size=1, max_size=40),
       p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]))
def test_exact_percentile_matches_builtin(spark, rows, p):
    from pyspark.sql import functions as F

    from strata.operators import exact_percentile
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.x for r in exact_percentile(df, ["k"], "v", p, out="x").collect()}
    exp = {r.k: r.y for r in df.groupBy("k").agg(F.percentile("v", p).alias("y")).collect()
           if r.y is not None}
    assert got == exp
