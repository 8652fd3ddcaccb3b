"""Exact percentiles and conditional summaries."""

from __future__ import annotations

import math
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions import mean

# A level splits its values into at most 2**19 parts, which is all a single task ever ranks.
DIGIT_BITS = 19


def _digits_bits(digits: int) -> int:
    return math.ceil(digits * math.log2(10))


def _sort_key(col: Column, data_type: T.DataType) -> tuple[Column, int, Column | None]:
    """Whole numbers that sort as ``col`` does: a main one, its bits with the sign, and a minor one.

    The minor number is the fraction of a decimal too wide for one 64-bit number, else None.
    """
    if isinstance(data_type, T.IntegralType):
        bits = {"tinyint": 8, "smallint": 16, "int": 32}.get(data_type.simpleString(), 64)
        return col.cast("bigint"), bits, None
    if isinstance(data_type, T.DecimalType):
        precision, scale = data_type.precision, data_type.scale
        unit = F.lit(Decimal(10) ** scale)
        if precision <= 18:
            return (col * unit).cast("bigint"), _digits_bits(precision) + 1, None
        if precision - scale <= 18 and _digits_bits(scale) <= DIGIT_BITS:
            whole = F.floor(col).cast("bigint")
            return whole, _digits_bits(precision - scale) + 1, ((col - F.floor(col)) * unit).cast("bigint")
    raise TypeError(
        f"cast the {data_type.simpleString()} column to an integer, to decimal(18,s) or narrower, or to a "
        "decimal of at most 18 digits before and 5 after the point"
    )


def _from_key(main: Column, minor: Column, data_type: T.DataType, split: bool) -> Column:
    if not isinstance(data_type, T.DecimalType):
        return main.cast(data_type)
    shrink = F.lit(Decimal(1).scaleb(-data_type.scale))
    if split:
        return (main.cast("decimal(19,0)") + minor.cast("decimal(6,0)") * shrink).cast(data_type)
    return (main.cast("decimal(19,0)") * shrink).cast(data_type)


def exact_percentiles(df: DataFrame, value: str, percentiles: Mapping[str, str]) -> DataFrame:
    """One row of exact discrete percentiles: the smallest value whose rank reaches ``p * n``.

    ``percentiles`` maps an output column to ``p`` written as a decimal text such as ``'0.25'``. NULLs
    are ignored; with no values every output is NULL.

    The values are counted from the smallest one on, which is read first together with the largest, and narrowed
    19 bits at a time: only as many bits as the range of the data has. Each level counts the next bits of the values
    that share the bits found so far, adds the counts up in order and keeps, per percentile, the part holding
    its rank. A task therefore ranks at most 2**19 counts, however many values there are and however they
    cluster, and the last level leaves one value. Counting is partial before its shuffle, so only counts
    travel, and only the found prefixes, one row per percentile, are broadcast. No level holds all
    distinct values in one place, as the built-in ``percentile_disc`` does.

    ``df`` is read once for the range and once per level, its one column only: three times for a range of less than
    2**38, such as amounts of up to two thousand million in cents. Materialise it first if it is costly to compute.
    """
    data_type = df.schema[value].dataType
    main, bits, minor = _sort_key(F.col(value), data_type)
    keys = df.where(F.col(value).isNotNull()).select(
        main.alias("main"), (F.lit(0) if minor is None else minor).alias("minor")
    )
    low, high = keys.agg(F.min("main"), F.max("main")).first()
    base = low or 0
    if low is not None and (high - low).bit_length() < 63:
        bits = max(1, (high - low).bit_length())
        keys = keys.select((F.col("main") - F.lit(base)).alias("main"), "minor")
    else:
        base = 0
    levels = math.ceil(bits / DIGIT_BITS)
    shifts = [DIGIT_BITS * (levels - 1 - level) for level in range(levels)]
    # Per level, the bits already found and the bits to find.
    steps = [(F.shiftright("main", shift + DIGIT_BITS), F.shiftright("main", shift)) for shift in shifts]
    if minor is not None:
        steps.append((F.col("main"), F.col("minor")))

    in_order = Window.partitionBy("out").orderBy("part")
    wanted = F.array(
        *[
            F.struct(F.lit(out).alias("out"), F.lit(Decimal(p)).cast("decimal(18,10)").alias("p"))
            for out, p in percentiles.items()
        ]
    )
    counts = keys.groupBy(steps[0][1].alias("part")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("out")).cast("decimal(19,0)")
    rank = F.greatest(F.ceil(F.col("p") * total).cast("bigint"), F.lit(1))
    ranked = counts.select("part", "n", F.lit(0).alias("prefix"), F.inline(wanted)).withColumn("rank", rank)
    for level in range(len(steps)):
        if level > 0:
            prefix, part = steps[level]
            members = keys.select(prefix.alias("prefix"), part.alias("part")).join(F.broadcast(found), "prefix")
            ranked = members.groupBy("out", "rank", "prefix", "part").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(in_order)
        hit = ranked.withColumn("upto", upto).where(
            (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank"))
        )
        found = hit.select(
            "out", F.col("part").alias("prefix"), (F.col("rank") - F.col("upto") + F.col("n")).alias("rank")
        )

    split = minor is not None
    answer = _from_key(F.col("prefix" if split else "part") + F.lit(base), F.col("part"), data_type, split)
    return hit.agg(*[F.max(F.when(F.col("out") == out, answer)).alias(out) for out in percentiles])


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row frames with different columns side by side."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def count_where(condition: Column) -> Column:
    """Rows for which ``condition`` is true."""
    return F.count_if(condition)


def mean_where(value: Column, condition: Column, digits: int) -> Column:
    """Exact mean of ``value`` over the rows for which ``condition`` is true; NULL if there are none."""
    return mean(F.sum(F.when(condition, value)), F.count(F.when(condition, value)), digits)
