"""Partitioned exact median against brute force."""

import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelkit.operators.quantiles import partitioned_median


def brute(rows):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    return {g: statistics.median(vs) for g, vs in groups.items()}


vals = st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                          st.one_of(st.none(), st.sampled_from([1.0, 2.0, 2.0, 5.0]),
                                    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False))),
                min_size=1, max_size=80)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(vals)
def test_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median_value for r in partitioned_median(df, "v", ["g"]).collect()}
    exp = brute(rows)
    assert set(got) == set(exp)
    for k in exp:
        assert abs(got[k] - exp[k]) <= 1e-9 * max(1.0, abs(exp[k]))


def test_global_and_duplicates(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 5, 5, 5, 1, 9]], "v double")
    assert partitioned_median(df, "v").collect()[0].median_value == 5.0
    big = spark.range(0, 100001).select((F.col("id") * 0.37).alias("v"))
    assert abs(partitioned_median(big, "v").collect()[0].median_value - 50000 * 0.37) < 1e-9


def test_other_quantiles(spark):
    from parcelkit.operators.quantiles import partitioned_quantile
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0, 5.0]
    s = sorted(vals)

    def interp(p):
        pos = p * (len(s) - 1)
        lo, hi = int(pos // 1), -int(-pos // 1)
        return s[lo] + (pos - lo) * (s[hi] - s[lo])
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for p in (0.0, 0.25, 0.9, 1.0):
        assert abs(partitioned_quantile(df, "v", p=p).first().quantile_value - interp(p)) < 1e-12


def test_brackets_follow_ranks_not_values(spark):
    from parcelkit.operators.quantiles import group_quantiles
    df = spark.range(0, 200000).select((F.col("id") * 5.0).alias("v")).unionAll(
        spark.sql("SELECT 1e15 AS v UNION ALL SELECT 1e11"))
    q = group_quantiles(df, {"a": ("v", 0.5), "b": ("v", 0.01)})
    row = q.first()
    assert row.a == 0.5 * 200001 * 5.0 and abs(row.b - 0.01 * 200001 * 5.0) < 1e-6
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_modes(spark):
    from parcelkit.operators.quantiles import group_modes
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (2.0, 4.0), (1.0, 4.0), (None, 5.0)], "x double, y double")
    assert tuple(group_modes(df, ["x", "y"]).first()) == (1.0, 4.0)
