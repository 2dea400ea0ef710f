"""Comparison and advice (J3, J5, J6) against a direct Python model of the
stated semantics, over random run times including zeros and ties."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from numprof.functions import fixed
from numprof.operators.jobs import analyze_flat, results_long


def sql_round(x: float, digits: int) -> float:
    """Half-up on the shortest decimal form, as Spark's round does."""
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def model(rdd: int, df: int, records: int):
    speedup = sql_round(rdd / df, 2) if df > 0 else 0.0
    faster = fixed.DATAFRAME_NAME if df < rdd else fixed.RDD_NAME
    big = max(rdd, df)
    pct = sql_round(abs(rdd - df) / big * 100, 1) if big else None
    advice = []
    if df < rdd:
        advice.append(f"{fixed.DATAFRAME_ADVICE[0]}{sql_round((rdd - df) / rdd * 100, 1)}{fixed.DATAFRAME_ADVICE[1]}")
    elif df > 0:
        advice.append(f"{fixed.RDD_ADVICE[0]}{sql_round((df - rdd) / df * 100, 1)}{fixed.RDD_ADVICE[1]}")
    if records > fixed.LARGE_RECORDS:
        advice += list(fixed.LARGE_ADVICE)
    return speedup, faster, pct, advice


times = st.one_of(st.integers(0, 5), st.integers(0, 10**7))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(times, times, st.integers(99990, 100010)), min_size=1, max_size=25))
def test_analysis_matches_model(spark, jobs):
    rows = [(str(i), r, d, n) for i, (r, d, n) in enumerate(jobs)]
    rdd = spark.createDataFrame([(j, r, n) for j, r, _, n in rows],
                                "job_id string, processing_time_ms long, record_count long")
    df = spark.createDataFrame([(j, d) for j, _, d, _ in rows], "job_id string, processing_time_ms long")
    got = {r["job_id"]: r for r in analyze_flat(results_long(rdd=rdd, df=df)).collect()}
    for j, r, d, n in rows:
        g = got[j]
        speedup, faster, pct, advice = model(r, d, n)
        assert (g["speedup"], g["faster_method"], g["performance_improvement_pct"]) == (speedup, faster, pct), (r, d)
        assert g["recommendations"] == advice, (r, d, n)
