import datetime as dt
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from tallyline.plans import weekly
from tallyline.operators.metrics import (
    compare_periods,
    missing_in_series,
    period_around,
    period_by_week,
    ratio_of_sums,
    share_of_total,
)


def test_shares_within_groups_sum_to_the_whole(spark):
    rows = [("x", "a", 1), ("x", "b", 3), ("y", "a", 5), (None, "a", 2), (None, "b", 2), ("z", "a", 0)]
    df = spark.createDataFrame(rows, "g string, k string, v int")
    got = {(r.g, r.k): r.pct for r in share_of_total(df, {"v": "pct"}, ["g"]).collect()}
    assert got == {
        ("x", "a"): Decimal("25.00"),
        ("x", "b"): Decimal("75.00"),
        ("y", "a"): Decimal("100.00"),
        (None, "a"): Decimal("50.00"),
        (None, "b"): Decimal("50.00"),
        ("z", "a"): None,
    }


def test_share_of_grand_total(spark):
    df = spark.range(1, 5).withColumnRenamed("id", "v")
    got = share_of_total(df, {"v": "pct"}, digits=0).collect()
    assert sorted(r.pct for r in got) == [10, 20, 30, 40]


def test_ratio_of_sums_is_not_a_mean_of_ratios(spark):
    df = spark.createDataFrame([("a", 10, 1), ("a", 10, 9)], "k string, s int, t int")
    assert ratio_of_sums(df, ["k"], "s", "t", "r").first().r == Decimal("2.00")


def test_periods_without_baseline_or_follow_up(spark):
    rows = [("a", "before", 8), ("a", "after", 6), ("a", None, 99), ("b", "after", 5), ("c", "before", 4)]
    df = spark.createDataFrame(rows, "g string, p string, v int")
    got = {
        (r.g, r.period): (r.v, r.v_index, r.v_share)
        for r in compare_periods(df, F.col("p"), "v", ["g"]).collect()
    }
    hundred = Decimal("100.00")
    assert got == {
        ("a", "before"): (8, hundred, Decimal("57.14")),
        ("a", "after"): (6, Decimal("75.00"), Decimal("42.86")),
        ("b", "after"): (5, None, hundred),
        ("c", "before"): (4, hundred, hundred),
    }


def test_period_edges(spark):
    change = dt.date(2020, 6, 15)
    days = [dt.date(2020, 5, 17), dt.date(2020, 5, 18), dt.date(2020, 6, 14), change, dt.date(2020, 7, 12)]
    days.append(dt.date(2020, 7, 13))
    df = spark.createDataFrame([(d,) for d in days], "d date").coalesce(1)
    got = [r.p for r in df.select(period_around(F.col("d"), change, 4).alias("p")).collect()]
    assert got == [None, "before", "before", "after", "after", None]
    weeks = spark.range(20, 30).coalesce(1).select(period_by_week(F.col("id"), 25, 4).alias("p")).collect()
    assert [r.p for r in weeks] == [None] + ["before"] * 4 + ["after"] * 4 + [None]


def test_missing_in_series(spark):
    df = spark.createDataFrame([(1,), (3,), (3,), (None,), (7,)], "w int")
    assert sorted(r.w for r in missing_in_series(df, "w", 1, 5).collect()) == [2, 4, 5]


def test_hot_group_share(spark):
    """A third of all groups in one partition value."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 101).cast("string")).alias("g"),
        (F.col("id") % 11).alias("v"),
    )
    totals = defaultdict(int)
    for i in range(30_000):
        totals["hot" if i % 3 == 0 else str(i % 101)] += i % 11
    got = share_of_total(df, {"v": "pct"}, ["g"], digits=6).where("v = 10").dropDuplicates(["g"]).collect()
    for r in got:
        assert abs(float(r.pct) - 1000 / totals[r.g]) < 1e-5


def test_every_line_is_in_a_year(spark):
    base = "/root/testdata/sf0.001"
    years = weekly.transactions_per_year(spark, base).collect()
    assert sum(r.transactions for r in years) == spark.read.parquet(f"{base}/lineitem.parquet").count()


def test_weeks_of_several_years_fall_on_mondays(spark):
    assert [r.day_of_week for r in weekly.distinct_weekdays(spark, "/root/testdata/sf0.001").collect()] == [1]
