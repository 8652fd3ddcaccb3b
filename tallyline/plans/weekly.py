"""Weekly sales: cleaning, shares and before/after comparisons."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import dow_sunday_zero, parse_date_text, ratio, year_month
from tallyline.operators.cleaning import band_by_pattern, null_sentinels
from tallyline.operators.metrics import (
    compare_periods,
    missing_in_series,
    period_around,
    period_by_week,
    ratio_of_sums,
    share_of_total,
)
from tallyline.plans import frames

# What the digit and the letter of a segment code stand for.
AGE_BANDS = {"%1": "Young Adults", "%2": "Middle Aged", "%3": "Retirees", "%4": "Retirees"}
DEMOGRAPHICS = {"C%": "Couples", "F%": "Families"}
UNKNOWN = "Unknown"

CHANGE_DATE = dt.date(1998, 6, 15)
# Two changes whose windows do not meet.
CHANGE_DATES = (dt.date(1996, 3, 11), CHANGE_DATE)
CHANGE_WEEK, WINDOW_WEEKS = 25, 4


def weekly_sales(
    spark: SparkSession, base: str, *dimensions: str, spans: Sequence[frames.Span] | None = None
) -> DataFrame:
    """Cleaned weekly sales at the grain of the week and the asked dimensions.

    The date text is parsed, and a segment of ``'null'`` becomes NULL before it is banded, so that it is
    unknown in all three of segment, age band and demographic. Exploding a one-item array makes the
    parsed date a value of its own, once per weekly row: left as an expression it would be copied into
    every later filter and pushed with it below the weekly totals, to be parsed for each line.
    """
    sales = frames.weekly_sales_raw(spark, base, dimensions, spans).withColumn(
        "week_date", F.explode(F.array(parse_date_text(F.col("week_date"))))
    )
    week = F.col("week_date")
    sales = sales.withColumns(
        {
            "week_number": F.weekofyear(week).cast("bigint"),
            "month_number": F.month(week).cast("bigint"),
            "year_number": F.year(week).cast("bigint"),
        }
    )
    if "segment" in dimensions:
        segment = F.col("segment")
        sales = null_sentinels(sales, {"segment": ["null", ""]}).withColumns(
            {
                "age_band": band_by_pattern(segment, AGE_BANDS, UNKNOWN),
                "demographic": band_by_pattern(segment, DEMOGRAPHICS, UNKNOWN),
                "segment": F.coalesce(segment, F.lit(UNKNOWN)),
            }
        )
    return sales


def weekly_sales_clean(spark: SparkSession, base: str) -> DataFrame:
    return weekly_sales(spark, base, *frames.WEEKLY_DIMENSIONS).withColumn(
        "avg_transaction", ratio(F.col("sales"), F.col("transactions"), 2)
    )


def weekday_per_week(spark: SparkSession, base: str) -> DataFrame:
    return (
        weekly_sales(spark, base)
        .select("week_number", dow_sunday_zero(F.col("week_date")).cast("bigint").alias("day_of_week"))
        .distinct()
        .orderBy("week_number")
    )


def distinct_weekdays(spark: SparkSession, base: str) -> DataFrame:
    return (
        weekly_sales(spark, base)
        .select(dow_sunday_zero(F.col("week_date")).cast("bigint").alias("day_of_week"))
        .distinct()
    )


def missing_weeks(spark: SparkSession, base: str) -> DataFrame:
    """The weeks of the year without any event."""
    weeks = frames.read_table(spark, base, "events").select(F.weekofyear("ts").cast("bigint").alias("week_number"))
    return missing_in_series(weeks, "week_number", 1, 52).orderBy("week_number")


def transactions_per_year(spark: SparkSession, base: str) -> DataFrame:
    return (
        weekly_sales(spark, base)
        .groupBy("year_number")
        .agg(F.sum("transactions").alias("transactions"))
        .orderBy("year_number")
    )


def transactions_per_region_month(spark: SparkSession, base: str) -> DataFrame:
    return (
        weekly_sales(spark, base, "region")
        .groupBy(year_month(F.col("week_date")).alias("month"), "region")
        .agg(F.sum("transactions").alias("transactions"), F.sum("sales").alias("sales"))
        .orderBy("month", "region")
    )


def transactions_per_platform(spark: SparkSession, base: str) -> DataFrame:
    return (
        weekly_sales(spark, base, "platform")
        .groupBy("platform")
        .agg(F.sum("transactions").alias("transactions"))
        .orderBy("platform")
    )


def _shares(sales: DataFrame, period: Column, period_name: str, group: str) -> DataFrame:
    totals = sales.groupBy(period.alias(period_name), group).agg(
        F.sum("transactions").alias("transactions"), F.sum("sales").alias("sales")
    )
    shares = {"transactions": "transactions_pct", "sales": "sales_pct"}
    return (
        share_of_total(totals, shares, [period_name])
        .select(period_name, group, *shares.values())
        .orderBy(period_name, group)
    )


def platform_share_by_month(spark: SparkSession, base: str) -> DataFrame:
    return _shares(weekly_sales(spark, base, "platform"), year_month(F.col("week_date")), "month", "platform")


def demographic_share_by_year(spark: SparkSession, base: str) -> DataFrame:
    return _shares(weekly_sales(spark, base, "segment"), F.col("year_number"), "year_number", "demographic")


def retail_share_by_two_groupings(spark: SparkSession, base: str, platform: str = "Store") -> DataFrame:
    """Shares of the year's transactions of one platform, by demographic and by age band, in one list."""
    sales = (
        weekly_sales(spark, base, "platform", "segment")
        .where(F.col("platform") == platform)
        .groupBy("year_number", "demographic", "age_band")
        .agg(F.sum("transactions").alias("transactions"))
    )

    def shares(group: str) -> DataFrame:
        totals = sales.groupBy("year_number", group).agg(F.sum("transactions").alias("transactions"))
        return share_of_total(totals, {"transactions": "transactions_pct"}, ["year_number"]).select(
            "year_number", F.col(group).alias("group_name"), "transactions_pct"
        )

    return (
        shares("demographic").unionByName(shares("age_band")).distinct().orderBy("year_number", "group_name")
    )


def avg_ticket_by_platform_year(spark: SparkSession, base: str) -> DataFrame:
    return ratio_of_sums(
        weekly_sales(spark, base, "platform"),
        ["year_number", "platform"],
        "sales",
        "transactions",
        "avg_transaction",
    ).orderBy("year_number", "platform")


def _before_after(spark: SparkSession, base: str, weeks: int) -> DataFrame:
    window = dt.timedelta(weeks=weeks)
    sales = weekly_sales(spark, base, spans=[(CHANGE_DATE - window, CHANGE_DATE + window)])
    period = period_around(F.col("week_date"), CHANGE_DATE, weeks)
    return compare_periods(sales, period, "sales").orderBy(F.desc("period"))


def before_after_4w(spark: SparkSession, base: str) -> DataFrame:
    return _before_after(spark, base, 4)


def before_after_12w(spark: SparkSession, base: str) -> DataFrame:
    return _before_after(spark, base, 12)


def before_after_two_changes(spark: SparkSession, base: str) -> DataFrame:
    """The same comparison around two dates, four weeks either way; both spans reach the scan as one filter."""
    window = dt.timedelta(weeks=4)
    date = F.col("week_date")
    sales = weekly_sales(spark, base, spans=[(c - window, c + window) for c in CHANGE_DATES])
    periods = [period_around(date, change, 4) for change in CHANGE_DATES]
    change = F.coalesce(*[F.when(p.isNotNull(), F.lit(c)) for p, c in zip(periods, CHANGE_DATES)])
    compared = compare_periods(sales.withColumn("change_date", change), F.coalesce(*periods), "sales", ["change_date"])
    return compared.orderBy("change_date", F.desc("period"))


def _before_after_by_year(spark: SparkSession, base: str, *by: str) -> DataFrame:
    period = period_by_week(F.col("week_number"), CHANGE_WEEK, WINDOW_WEEKS)
    return compare_periods(weekly_sales(spark, base, *by), period, "sales", ["year_number", *by])


def before_after_by_year(spark: SparkSession, base: str) -> DataFrame:
    return _before_after_by_year(spark, base).orderBy("year_number", F.desc("period"))


def before_after_by_year_region(spark: SparkSession, base: str) -> DataFrame:
    return _before_after_by_year(spark, base, "region").orderBy(
        "year_number", F.desc("period"), F.desc("region")
    )


QUERIES = {
    f.__name__: f
    for f in (
        weekly_sales_clean,
        weekday_per_week,
        distinct_weekdays,
        missing_weeks,
        transactions_per_year,
        transactions_per_region_month,
        transactions_per_platform,
        platform_share_by_month,
        demographic_share_by_year,
        retail_share_by_two_groupings,
        avg_ticket_by_platform_year,
        before_after_4w,
        before_after_12w,
        before_after_two_changes,
        before_after_by_year,
        before_after_by_year_region,
    )
}
