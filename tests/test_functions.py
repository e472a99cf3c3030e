import calendar
from datetime import date, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from txlab import schemas as S
from txlab.functions import calendar as cal
from txlab.functions import columns as C
from txlab.functions import draws as D
from txlab.operators import joins as J
from txlab.operators import rows as R


def values(df):
    return [tuple(row) for row in df.collect()]


def test_month_functions_agree_with_pythons_calendar(spark):
    days = [date(1995, 1, 1) + timedelta(days=13 * i) for i in range(1000)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = values(
        df.select("d", cal.month_start("d"), cal.month_end("d"), cal.last_friday("d"), cal.month_number("d"))
    )
    for d, first, last, friday, number in got:
        end = d.replace(day=calendar.monthrange(d.year, d.month)[1])
        expected = end
        while expected.weekday() != calendar.FRIDAY:
            expected -= timedelta(days=1)
        assert (first, last, friday, number) == (d.replace(day=1), end, expected, d.month)


def test_last_fridays_of_2024(spark):
    df = spark.createDataFrame([("2024-02-10",), ("2024-03-01",), ("2024-05-31",)], "s string")
    got = [str(r[0]) for r in df.select(cal.last_friday(cal.parse_date("s"))).collect()]
    assert got == ["2024-02-23", "2024-03-29", "2024-05-31"]


def test_month_frames(spark):
    df = spark.sql("SELECT date'2024-02-02' AS d").select(F.explode(cal.month_frames("d", 3)).alias("f"))
    got = [(str(r.f["start"]), str(r.f["end"])) for r in df.collect()]
    assert got == [
        ("2024-02-02", "2024-02-29"),
        ("2024-03-01", "2024-03-31"),
        ("2024-04-01", "2024-04-30"),
    ]


def test_days_between_includes_both_ends(spark):
    df = spark.sql("SELECT date'2024-02-27' AS a, date'2024-03-01' AS b")
    assert len(df.select(cal.days_between("a", "b")).first()[0]) == 4


def test_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "v double")
    assert values(df.select(C.half_even("v"))) == [(0.0,), (2.0,), (2.0,)]


def test_flow_type(spark):
    df = spark.createDataFrame(
        [
            ("Transfers", "Transfer from Savings to Current"),
            ("Transfers", "Transfer from Current to Savings"),
            ("Interest", "any"),
            ("Groceries", None),
        ],
        "category string, description string",
    )
    got = [r.tx_type for r in R.classify_flow(df).collect()]
    assert got == ["income", "spending", "income", "spending"]


def test_adjusted_amount(spark):
    df = spark.createDataFrame([(2.0, 1.5), (2.01, 1.5), (None, 1.5)], "a double, f double")
    got = [r[0] for r in df.select(C.adjusted_amount("a", "f")).collect()]
    assert got[0] == 6.0 and got[1] == pytest.approx(3.015) and got[2] is None


def test_value_filters_differ_at_the_bound(spark):
    df = spark.createDataFrame([(0.99,), (1.0,), (1.01,)], "v double")
    assert [r.v for r in R.where_gt(df, "v", 1).collect()] == [1.01]
    assert [r.v for r in R.where_gt(df, "v", 1, or_equal=True).collect()] == [1.0, 1.01]


def test_missing_values_in_inequality(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert [r.v for r in R.where_ne(df, "v", "a").collect()] == ["b"]
    assert [r.v for r in R.where_ne(df, "v", "a", keep_missing=True).collect()] == ["b", None]


def test_synonyms(spark):
    df = spark.createDataFrame([("Dining out",), ("Travel",), ("Housing",), (None,)], "category string")
    got = [r.category for r in R.normalise(df, "category").collect()]
    assert got == ["Dining Out", "Holiday", "Housing", None]


def test_spent_text(spark):
    df = spark.sql("SELECT 1234567.0D AS v")
    assert df.select(C.spent_text("v")).first()[0] == "Spent: £1,234,567 "


def test_case_when_rules_read_old_values(spark):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    swapped = R.case_when(df, {"a": F.col("b"), "b": F.col("a")})
    assert values(swapped) == [("y", "x")]


def test_lookup(spark):
    df = spark.createDataFrame([("Transfers",), ("Housing",)], "category string")
    caps = J.lookup(df, "category", S.MONTHLY_CAPS, "cap")
    assert values(caps) == [("Transfers", 8), ("Housing", 1)]
    unknown = spark.createDataFrame([("Nothing",)], "category string")
    with pytest.raises(PySparkException, match="no cap for Nothing"):
        J.lookup(unknown, "category", S.MONTHLY_CAPS, "cap").collect()
    assert values(J.lookup(unknown, "category", S.MONTHLY_CAPS, "cap", strict=False)) == [("Nothing", None)]


def test_mapping_drops_unmapped_categories(spark):
    df = spark.createDataFrame([("Holiday",), ("Groceries",), ("Charity",)], "category string")
    got = values(J.map_categories(df, S.FRAUD_CATEGORIES))
    assert got == [("Holiday", "Romance"), ("Charity", "Impersonation")]


def test_draws_stay_in_bounds_and_repeat(spark):
    df = spark.range(20000).withColumn("id", F.col("id").cast("string"))
    drawn = df.select(
        "id",
        D.uniform("id", salt="a").alias("u"),
        D.draw_int(1, 6, "id", salt="b").alias("i"),
        D.draw_choice(S.BANKS, "id", salt="c").alias("bank"),
        D.draw_truncated_normal(F.lit(50.0), F.lit(2000.0), F.lit(100.0), "id", salt="d").alias("x"),
        D.draw_date(F.lit("2024-02-02").cast("date"), F.lit("2024-02-29").cast("date"), "id", salt="e").alias("day"),
    )
    stats = drawn.agg(
        F.min("u"), F.max("u"), F.avg("u"), F.min("i"), F.max("i"), F.count_distinct("bank"),
        F.count("x"), F.min("x"), F.max("x"), F.min("day"), F.max("day"),
    ).first()
    assert 0 <= stats[0] and stats[1] < 1 and abs(stats[2] - 0.5) < 0.01
    assert (stats[3], stats[4], stats[5], stats[6]) == (1, 6, 5, 20000)
    assert 50 < stats[7] and stats[8] < 2000
    assert (str(stats[9]), str(stats[10])) == ("2024-02-02", "2024-02-29")
    assert drawn.exceptAll(drawn.repartition(13)).count() == 0


def test_fixed_tables():
    assert len(S.MONTHLY_CAPS) == 22 and sum(S.MONTHLY_CAPS.values()) == 86
    assert len(S.FRAUD_CATEGORIES) == 6
