"""Conversion funnels over visits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import percent


# A visit's rows are dealt over so many slices when the purchase flag is spread over them.
SLICES = 16


def spread_flag(df: DataFrame, key: str, flag: str, within: Sequence[str], out: str) -> DataFrame:
    """``out``: whether ``flag`` is true in any row with the same ``key``; ``within`` tells a key's rows apart.

    Flags are combined per key and slice first, then per key, and joined back to the slices, so no task holds all
    rows of a key. A NULL key is a key of its own.
    """
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*within), F.lit(SLICES)))
    partial = sliced.groupBy(key, "_slice").agg(F.max(flag).alias("_flag"))
    whole = partial.groupBy(key).agg(F.max("_flag").alias(out), F.collect_set("_slice").alias("_slices"))
    spread = whole.select(F.col(key).alias("_key"), out, F.explode("_slices").alias("_of"))
    same = sliced[key].eqNullSafe(spread["_key"]) & (sliced["_slice"] == spread["_of"])
    return sliced.join(spread, same).drop("_slice", "_key", "_of")


def funnel(
    events: DataFrame, by: Sequence[str], visit: str, step: str, view: int, add: int, purchase: int, sliced: bool = False
) -> DataFrame:
    """Views, cart adds, abandoned adds and purchased adds per ``by``.

    An add counts as purchased when its visit has a purchase event anywhere, else as abandoned. Events
    are first combined per visit and ``by``, map-side too, so a hot visit has shrunk to one row per
    ``by`` value before the purchase flag is spread over it by a window, which reads ``events`` once. With
    ``sliced`` the flag is spread over slices of a visit instead, for a ``by`` of so many values that a task should
    not hold all of a visit; ``events`` is read twice then.
    """
    per_visit = (
        events.where(F.col(step).isin(view, add, purchase))
        .groupBy(visit, *by)
        .agg(
            F.count_if(F.col(step) == view).alias("n_views"),
            F.count_if(F.col(step) == add).alias("n_adds"),
            F.max(F.col(step) == purchase).alias("_bought_here"),
        )
    )
    if sliced:
        flagged = spread_flag(per_visit, visit, "_bought_here", by, "_bought")
    else:
        flagged = per_visit.withColumn("_bought", F.max("_bought_here").over(Window.partitionBy(visit)))
    return (
        flagged
        .groupBy(*by)
        .agg(
            F.sum("n_views").alias("n_views"),
            F.sum("n_adds").alias("n_adds"),
            F.sum(F.when(F.col("_bought"), F.lit(0)).otherwise(F.col("n_adds"))).alias("n_abandons"),
            F.sum(F.when(F.col("_bought"), F.col("n_adds")).otherwise(F.lit(0))).alias("n_purchases"),
        )
    )


def rates(df: DataFrame, ratios: Mapping[str, tuple[str, str]], digits: int = 2) -> DataFrame:
    """Add percent rates ``{name: (part, whole)}``; NULL where the whole is zero."""
    return df.withColumns({out: percent(F.col(p), F.col(w), digits) for out, (p, w) in ratios.items()})
