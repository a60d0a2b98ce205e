import random
import statistics

import pytest
from pyspark.sql import functions as F

from millrace.operators import stats


def frame(spark, values, parts=3):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").repartition(parts)


def linear(values, p):
    s = sorted(v for v in values if v is not None)
    spot = (len(s) - 1) * p
    lo = int(spot)
    hi = min(lo + 1, len(s) - 1)
    return s[lo] + (spot - lo) * (s[hi] - s[lo])


@pytest.mark.parametrize("values", [[1.0, 2.0, 3.0, 4.0, None], [5.0], [1.0, 2.0, 4.0]])
def test_small_quantiles(spark, values):
    got = stats.quantiles(frame(spark, values), ["v"], [0.25, 0.5])["v"]
    assert got == pytest.approx([linear(values, 0.25), linear(values, 0.5)])


def test_all_null_has_no_quantile(spark):
    assert stats.quantiles(frame(spark, [None, None]), ["v"], [0.5])["v"] == [None]


@pytest.mark.parametrize("shape", ["uniform", "hot", "constant", "two"])
def test_narrowing_is_exact(spark, shape):
    rng = random.Random(3)
    values = {
        "uniform": [rng.uniform(-5, 5) for _ in range(3000)],
        "hot": [7.0 if rng.random() < 0.34 else round(rng.gauss(7, 1), 2) for _ in range(3000)],
        "constant": [2.5] * 500,
        "two": [0.0] * 700 + [1.0] * 701,
    }[shape] + [None] * 20
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = stats.quantiles(frame(spark, values), ["v"], probs, list_rows=3)["v"]
    assert got == pytest.approx([linear(values, p) for p in probs], abs=1e-12)


def test_fences_of_constant_column_remove_nothing(spark):
    assert stats.tukey_fences(frame(spark, [5.0] * 4), ["v"], 2.0) == {"v": (5.0, 5.0)}


def test_mode_tie_and_null(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (2, None), (1, None), (None, None)], "n int, t string")
    assert stats.modes(df, ["n", "t"]) == {"n": 1, "t": "a"}


def test_mode_of_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "n int")
    assert stats.modes(df, ["n"]) == {"n": None}


@pytest.mark.parametrize("rows_per_bucket", [1_000_000, 50])
def test_group_medians_with_hot_group(spark, rows_per_bucket):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.6 else rng.choice("abc"), float(rng.randint(0, 300))) for _ in range(1500)]
    rows += [("a", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["median"] for r in stats.group_medians(df, "g", "v", rows_per_bucket=rows_per_bucket).collect()}
    groups = {}
    for g, v in rows:
        if g is not None and v is not None:
            groups.setdefault(g, []).append(v)
    assert got == {g: statistics.median(v) for g, v in groups.items()}


def test_running_totals_do_not_depend_on_ranges(spark):
    rows = [(g, float(i), i % 4) for g in ("x", "y") for i in range(200)]
    df = spark.createDataFrame(rows, "g string, o double, m int")
    one = {(r["g"], r["o"]): (r["m_before"], r["m_total"]) for r in stats.running_totals(df, "o", ["m"], ["g"]).collect()}
    many = {
        (r["g"], r["o"]): (r["m_before"], r["m_total"])
        for r in stats.running_totals(df, "o", ["m"], ["g"], rows_per_bucket=20).collect()
    }
    assert one == many
    assert one[("x", 5.0)] == (0 + 1 + 2 + 3 + 0, 300)


def test_modes_share_one_scan(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("a"), (F.col("id") % 2).alias("b"))
    assert stats.modes(df, ["a", "b"]) == {"a": 0, "b": 0}


@pytest.mark.parametrize("list_rows", [100, 1])
def test_nan_counts_as_missing(spark, list_rows):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0, float("nan"), float("nan"), None])
    assert stats.quantiles(df, ["v"], [0.5, 1.0], list_rows=list_rows)["v"] == [2.5, 4.0]
    grouped = stats.group_medians(df.withColumn("g", F.lit("a")), "g", "v")
    assert grouped.first()["median"] == 2.5


@pytest.mark.parametrize("list_rows", [100, 1])
def test_infinities_are_values(spark, list_rows):
    values = [float("inf")] * 6 + [float("-inf")] + [1.0, 2.0, 3.0]
    got = stats.quantiles(frame(spark, values), ["v"], [0.0, 1 / 9, 0.75, 1.0], list_rows=list_rows)["v"]
    assert got == [float("-inf"), 1.0, float("inf"), float("inf")]
