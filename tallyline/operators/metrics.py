"""Shares, ratios, baseline comparisons and gaps, over already aggregated frames where possible."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import percent, ratio
from tallyline.operators.joins import keep_if_not_in


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"_k_{k}"])
    return left.join(renamed, condition, "left").drop(*[f"_k_{k}" for k in keys])


def share_of_total(
    df: DataFrame, shares: Mapping[str, str], within: Sequence[str] = (), digits: int = 2
) -> DataFrame:
    """Add percent shares of a total: ``shares`` maps a value column to the name of its share.

    ``df`` holds one row per group. The total is that of the rows agreeing on ``within``, joined back as
    an aggregate (no window ever holds all groups); without ``within`` it is a one-value subquery.
    """
    if not within:
        return df.withColumns(
            {out: percent(F.col(value), df.agg(F.sum(value)).scalar(), digits) for value, out in shares.items()}
        )
    totals = df.groupBy(*within).agg(*[F.sum(value).alias(f"_t_{value}") for value in shares])
    joined = _join_null_safe(df, totals, within)
    return joined.withColumns(
        {out: percent(F.col(value), F.col(f"_t_{value}"), digits) for value, out in shares.items()}
    ).drop(*[f"_t_{value}" for value in shares])


def ratio_of_sums(
    df: DataFrame, keys: Sequence[str], numerator: str, denominator: str, out: str, digits: int = 2
) -> DataFrame:
    """Per group, the ratio of two sums (not the mean of row ratios)."""
    sums = df.groupBy(*keys).agg(F.sum(numerator).alias("_num"), F.sum(denominator).alias("_den"))
    return sums.withColumn(out, ratio(F.col("_num"), F.col("_den"), digits)).drop("_num", "_den")


def compare_periods(
    df: DataFrame, period: Column, value: str, by: Sequence[str] = (), digits: int = 2
) -> DataFrame:
    """Total ``value`` per group and period ('before' or 'after'), with index and share.

    Adds ``<value>_index``, the percent of the group's own 'before' total (NULL without one), and
    ``<value>_share``, the percent of its total over both periods. Rows whose ``period`` is NULL are
    outside the comparison. Both periods of a group come out of one aggregate, so the baseline and the
    total are at hand in the row and nothing is joined back.
    """
    name = F.col("_period")
    totals = (
        df.withColumn("_period", period)
        .where(name.isNotNull())
        .groupBy(*by)
        .agg(
            F.sum(F.when(name == "before", F.col(value))).alias("_before"),
            F.sum(F.when(name == "after", F.col(value))).alias("_after"),
        )
    )
    both = F.coalesce("_before", F.lit(0)) + F.coalesce("_after", F.lit(0))
    rows = F.array(
        *[F.struct(F.lit(p).alias("period"), F.col(f"_{p}").alias(value)) for p in ("before", "after")]
    )
    return (
        totals.select(*by, "_before", both.alias("_both"), F.inline(rows))
        .where(F.col(value).isNotNull())
        .select(
            *by,
            "period",
            value,
            percent(F.col(value), F.col("_before"), digits).alias(f"{value}_index"),
            percent(F.col(value), F.col("_both"), digits).alias(f"{value}_share"),
        )
    )


def period_around(date: Column, change: dt.date, weeks: int) -> Column:
    """'before' for the ``weeks`` weeks before ``change``, 'after' for the same span from it on, else NULL."""
    # The middle of a day lies half a day from the change at least, so the distance alone bounds both sides.
    days = F.date_diff(date, F.lit(change))
    return F.when(F.abs(2 * days + 1) < 14 * weeks, F.when(days < 0, "before").otherwise("after"))


def period_by_week(week: Column, change_week: int, weeks: int) -> Column:
    """The same split on week numbers, so that one rule serves several years."""
    return F.when(week.between(change_week - weeks, change_week - 1), "before").when(
        week.between(change_week, change_week + weeks - 1), "after"
    )


def missing_in_series(df: DataFrame, column: str, first: int, last: int) -> DataFrame:
    """The whole numbers from ``first`` to ``last`` that do not occur in ``column``."""
    series = df.sparkSession.range(first, last + 1).select(F.col("id").alias(column))
    return keep_if_not_in(series, column, df.select(F.col(column).cast("bigint").alias(column)))
