import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.functions import dates, numbers, text


def values(spark, rows, kind, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")
    return [r[1] for r in df.select("i", expr(F.col("c")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "raw,want",
    [("semi-remolque", "Semi-Remolque"), ("\t a b\n", "A B"), ("o'neil", "O'Neil"), (None, None), ("  FURGÓN ", "Furgón"), ("3com x", "3Com X")],
)
def test_strip_title(spark, raw, want):
    assert values(spark, [raw], "string", text.strip_title) == [want]


def test_to_number(spark):
    raw = [" 12 ", "1e3", "1,5", "12kg", "nan", "12d", "1f", "-.5", "", None, "0x10"]
    assert values(spark, raw, "string", numbers.to_number) == [12.0, 1000.0, None, None, None, None, None, -0.5, None, None, None]


def test_money(spark):
    raw = ["$1274906.0", "~13941.0", "1797068.0 aprox", "5 aproximado", "abc", None]
    assert values(spark, raw, "string", numbers.money) == [1274906.0, 13941.0, 1797068.0, 5.0, None, None]


def test_dates_do_not_depend_on_row_order(spark):
    raw = ["01/02/2023", "2023-01-12", "05-03-2023", None, "nan", "NaT", "", "31/02/2023", "1/2/2023"]
    want = [dt.date(2023, 2, 1), dt.date(2023, 1, 12), None, None, None, None, None, None, dt.date(2023, 2, 1)]
    assert values(spark, raw, "string", dates.parse_date) == want
    assert values(spark, raw[::-1], "string", dates.parse_date) == want[::-1]


def test_clip_keeps_null_and_limits(spark):
    assert values(spark, [None, -2, 5, 99], "int", lambda c: numbers.clip(c, 0, 60)) == [None, 0, 5, 60]


def test_days_between(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 3), dt.date(2023, 1, 1)), (dt.date(2023, 1, 3), None)], "a date, b date")
    assert [r[0] for r in df.select(dates.days_between(F.col("a"), F.col("b"))).collect()] == [0, None]


def test_weekday_is_monday_based(spark):
    assert values(spark, ["2023-01-01"], "string", lambda c: dates.calendar_parts(c)["weekday"]) == [6.0]


def test_outside_counts_null(spark):
    assert values(spark, [None, 1.0, 3.0], "double", lambda c: numbers.outside(c, 0, 2)) == [True, False, True]


def test_ratio_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(numbers.ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.5]


def test_edge_space_nulls(spark):
    raw = [" a", "a", None]
    assert values(spark, raw, "string", text.has_edge_space) == [True, False, False]
    assert values(spark, raw, "string", lambda c: text.has_edge_space(c, nulls=True)) == [True, False, True]


def test_mojibake(spark):
    raw = ["FurgÃ³n", "Furgón", "plain", None, "日本"]
    assert values(spark, raw, "string", text.repair_mojibake) == ["Furgón", "Furgón", "plain", None, "日本"]


def test_latin1_and_prefix(spark):
    assert values(spark, ["a→ñ"], "string", text.latin1_safe) == ["a?ñ"]
    assert values(spark, ["03_Ridge_x", "plain"], "string", text.drop_number_prefix) == ["Ridge_x", "plain"]
