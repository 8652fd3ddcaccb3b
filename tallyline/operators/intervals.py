"""Attribution of points in time to intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def _micros(column: Column) -> Column:
    """Microseconds since 1970 of a date or a time, without a time zone."""
    day = F.unix_date(F.to_date(column)).cast("bigint")
    whole = F.hour(column).cast("bigint") * 3600 + F.minute(column) * 60
    return day * DAY_MICROS + whole * 1_000_000 + (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint")


def _cut(intervals: DataFrame, start: str, end: str, least_seconds: int) -> DataFrame:
    """Intervals cut into blocks (``_block``) of 2 ** ``_level`` microseconds.

    The level follows from the interval's own length, so each is cut into 17 blocks at most, which are little more
    than what it covers. Levels are even numbers, so at most 32 occur.
    """
    least = (max(0, least_seconds * 1_000_000).bit_length() + 1) // 2 * 2 if least_seconds else 0
    measured = intervals.withColumns({"_first": _micros(F.col(start)), "_last": _micros(F.col(end))})
    measured = measured.where("_first <= _last")
    level = F.length(F.bin(F.col("_last") - F.col("_first") + 1)) - 3
    leveled = measured.withColumn("_level", F.greatest(level - F.pmod(level, F.lit(2)), F.lit(least)))
    blocks = F.expr("sequence(shiftright(_first, _level), shiftright(_last, _level))")
    return leveled.withColumn("_block", F.explode(blocks)).drop("_first", "_last")


def _candidates(times: DataFrame, cut: DataFrame) -> DataFrame:
    """Pairs of ``times`` (``_at``) and ``cut`` intervals of which a block holds the time."""
    levels = cut.agg(F.array_sort(F.collect_set("_level"))).scalar()
    placed = times.select("_at", _micros(F.col("_at")).alias("_micros"), F.explode(levels).alias("_level"))
    placed = placed.select("_at", "_level", F.expr("shiftright(_micros, _level)").alias("_block"))
    return placed.join(cut, ["_level", "_block"]).drop("_level", "_block")


def attribute_interval(
    points: DataFrame, at: str, intervals: DataFrame, start: str, end: str, least_seconds: int = 0
) -> DataFrame:
    """Left join of points to the intervals with ``start <= at <= end``.

    A point in several intervals gives several rows, one in none gives one row with NULLs. Intervals are cut into
    blocks whose width follows from their own length, and each different time is joined to the blocks that hold it,
    one per width in use; the exact bounds are kept in the condition. However many intervals crowd a stretch, and
    however long or open-ended some are, the candidates stay near the matches, nothing is measured on the points,
    and it is a hash or sort-merge join at any size, never a nested loop. ``least_seconds`` is the smallest width of
    a block, about. ``points`` is read twice: one that is costly to compute is better written first.
    """
    times = points.where(points[at].isNotNull()).select(points[at].alias("_at")).distinct()
    pairs = _candidates(times, _cut(intervals, start, end, least_seconds))
    matches = pairs.where((F.col("_at") >= F.col(start)) & (F.col("_at") <= F.col(end)))
    return points.join(matches, points[at] == matches["_at"], "left").drop("_at")
