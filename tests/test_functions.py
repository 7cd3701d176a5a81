import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart.functions import columns as c
from salesmart.functions import quantiles, ranking


def doubles(spark, values):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")


PROBS = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.9, "f": 1.0}


NAN, INF = float("nan"), float("inf")
COLUMNS = [
    [5.0], [1, 2], [3, 3, 3, 3], [1, 1, 1, 1, 9], list(range(1000)), [None, 2, None, 8], [7] * 500 + list(range(500)), [-INF, -INF, 0.5, 3, INF],
    [-0.0, 0.0, 0.0, -0.0, 1.0], [-INF] * 40 + [k / 7 for k in range(200)] + [INF] * 30, [2.5] * 300 + [k * 0.1 for k in range(90)] + [9.75] * 300, [NAN, 1, 2, NAN, 3],
]


def ordered(values):
    """Values in Spark's order: NaN behind all others, nulls left out."""
    return sorted((v for v in values if v is not None), key=lambda v: (v != v, v))


def interpolated(values, p):
    s = ordered(values)
    at = p * (len(s) - 1)
    low, part = int(at), at - int(at)
    return s[low] if not part or s[low] == s[low + 1] else s[low] * (1 - part) + s[low + 1] * part


@pytest.mark.parametrize("accuracy, fits", [(quantiles.ACCURACY, quantiles.FITS), (20, 8), (8, 1)])
@pytest.mark.parametrize("values", COLUMNS)
def test_quantiles_equal_linear_interpolation(spark, values, accuracy, fits):
    got = quantiles.exact_quantiles(doubles(spark, values), "x", PROBS, accuracy, fits).first()
    for name, p in PROBS.items():
        want = interpolated(values, p)
        assert got[name] == want or (got[name] != got[name] and want != want), (name, got[name], want)
        if all(v is None or abs(v) < INF for v in values):
            assert got[name] == pytest.approx(float(np.quantile([v for v in values if v is not None], p)), rel=1e-12)


@pytest.mark.parametrize("accuracy, fits, least", [(20_000, 50_000, 1), (100, 500, 2), (20, 10, 3)])
def test_rounds_are_repeated_until_the_rest_fits(spark, accuracy, fits, least):
    values = (np.arange(60_000) * 7919) % 60_013
    df = spark.range(60_000).select(((F.col("id") * 7919) % 60_013).cast("double").alias("x"))
    target = quantiles.Target("x", 30_000, inside=60_000)
    rounds = quantiles.select_ranks(df, [target], quantiles._sketch(df, [target], accuracy), accuracy, fits)
    assert target.value == np.sort(values)[30_000] and rounds >= least


@pytest.mark.parametrize("bracket", [(-5.0, -1.0), (100.0, 100.0), (59_990.0, 1e9), (-1.0, 1e9)])
def test_a_bracket_that_misses_is_left(spark, bracket):
    df = spark.range(60_000).select(F.col("id").cast("double").alias("x"))
    target = quantiles.Target("x", 1234, inside=60_000)
    quantiles.select_ranks(df, [target], [bracket], 100, 50)
    assert target.value == 1234.0


def test_several_columns_at_once_and_nothing(spark):
    df = spark.createDataFrame([(float(k), float(k % 3), None) for k in range(100)], "a double, b double, c double")
    got = quantiles.with_quantiles(df, [("m", "a", 0.5), ("t", "b", 0.9), ("n", "c", 0.5)]).select("m", "t", "n").distinct().collect()
    assert [tuple(r) for r in got] == [(49.5, 2.0, None)]
    assert quantiles.exact_quantiles(df.limit(0), "a", {"q": 0.5}).first()["q"] is None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 10)), min_size=1, max_size=60))
def test_global_rank_equals_sorted_position(spark, pairs):
    rows = [(i, float(v)) for i, (v, _) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "id long, v double")
    want = {i: n + 1 for n, (i, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    for buckets in (None, 4):  # direct and bucketed form
        got = {r["id"]: r["rank"] for r in ranking.global_rank(df, "v", "id", buckets=buckets).collect()}
        assert got == want


def test_rank_with_a_third_of_the_rows_on_one_value(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") / 100.0).alias("v"))
    direct = {r["id"]: r["rank"] for r in ranking.global_rank(df, "v", "id").collect()}
    bucketed = {r["id"]: r["rank"] for r in ranking.global_rank(df, "v", "id", buckets=20).collect()}
    assert bucketed == direct and sorted(direct.values()) == list(range(1, 3001))


@pytest.mark.parametrize("values", [[], [None, None], [5.0, None, 3.0, 4.0], [float("nan"), None, 1.0, float("nan"), 1.0, float("inf")], [2.0] * 40, [None] * 20 + [1.0] * 20])
@pytest.mark.parametrize("buckets", [2, 9])
def test_rank_of_nulls_nans_and_ties(spark, values, buckets):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    want = {i: n + 1 for n, (i, _) in enumerate(sorted(enumerate(values), key=lambda r: (r[1] is None, r[1] == r[1], -(r[1] or 0) if r[1] == r[1] else 0, r[0])))}
    assert {r["id"]: r["rank"] for r in ranking.global_rank(df, "v", "id", buckets=buckets).collect()} == want


def test_rank_keeps_a_null_key(spark):
    df = spark.createDataFrame([(2, None), (None, None), (1, None), (3, 1.0)], "id long, v double")
    assert {r["id"]: r["rank"] for r in ranking.global_rank(df, "v", "id").collect()} == {3: 1, None: 2, 1: 3, 2: 4}


def test_exact_sum_does_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    values = [round(rng.uniform(-1e6, 1e6), 4) for _ in range(5000)]
    df = doubles(spark, [*values, None])
    sums = {df.repartition(n).agg(c.exact_sum("x").alias("s")).first()["s"] for n in (1, 3, 8)}
    assert len(sums) == 1
    assert sums.pop() == pytest.approx(sum(round(v * 10000) for v in values) / 10000, rel=1e-15)


def test_exact_sum_beyond_long_range_and_on_no_rows(spark):
    big = spark.range(2000).select(F.lit(9e13).alias("x"))
    assert big.agg(c.exact_sum("x").alias("s")).first()["s"] == pytest.approx(1.8e17)
    assert doubles(spark, [None]).agg(c.exact_sum("x").alias("s")).first()["s"] is None
    assert doubles(spark, [None]).agg(c.exact_avg("x").alias("s")).first()["s"] is None


def test_ratios_with_zero_and_null_denominators(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 4.0), (None, 4.0)], "a double, b double")
    got = [tuple(r) for r in df.select(c.safe_percent("a", "b"), c.safe_ratio("a", "b"), c.trend_percent("a", "b")).collect()]
    assert got == [(0.0, 0.0, None), (0.0, 0.0, None), (25.0, 0.25, -75.0), (None, None, None)]


def test_hours_parts_and_ids(spark):
    df = spark.createDataFrame([("07:59:00",), ("23:00:59",), ("24:00:00",), ("x",), (None,), ("11:30",)], "t string")
    assert [r[0] for r in df.select(c.hour_of("t")).collect()] == [7, 23, None, None, None, None]
    hours = spark.createDataFrame([(h,) for h in (6, 7, 10, 11, 14, 15, 17, 18, 21, 22, None)], "h int")
    assert [r[0] for r in hours.select(c.day_part("h")).collect()] == [
        "Late / Off-Peak", "Morning", "Morning", "Lunch Peak", "Lunch Peak", "Afternoon", "Afternoon", "Dinner Peak", "Dinner Peak", "Late / Off-Peak", "Late / Off-Peak"]
    ids = spark.createDataFrame([("77.0",), ("",), (" ",), (None,), ("abc",), ("12",)], "i string")
    assert [r[0] for r in ids.select(c.optional_id("i")).collect()] == ["77", "", "", "", "", "12"]
