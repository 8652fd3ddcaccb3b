"""Deterministic first, last and top-N rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each group.

    ``order`` must be total within a group, up to rows that are equal in every column. Spark cuts each
    map task's groups to ``n`` rows before the shuffle, so a hot group sends at most ``n`` rows per task.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where(F.col("_position") <= n).drop("_position")


def last_before(
    df: DataFrame, keys: Sequence[str], event: Column, anchor: Column, ties: Sequence[Column]
) -> DataFrame:
    """The latest row of each group strictly before ``anchor``, ``ties`` deciding equal events."""
    return first_per_group(df.where(event < anchor), keys, [event.desc(), *ties])


def first_from(
    df: DataFrame, keys: Sequence[str], event: Column, anchor: Column, ties: Sequence[Column]
) -> DataFrame:
    """The earliest row of each group at or after ``anchor``, ``ties`` deciding equal events."""
    return first_per_group(df.where(event >= anchor), keys, [event.asc(), *ties])


def top_n(df: DataFrame, measure: str, ties: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows with the largest ``measure``; ``ties`` must make the order total."""
    return df.orderBy(F.desc(measure), *[F.asc(c) for c in ties]).limit(n)
