"""Spend, favourites and loyalty points per customer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.joins import enrich
from tallyline.operators.ranking import first_from, first_per_group, last_before, top_n
from tallyline.plans import frames

BONUS_KIND = "PROMO"


def _member_headers(spark: SparkSession, base: str) -> DataFrame:
    """The order headers of members, with their join date.

    Members are put on the headers and not on the purchases: the next step joins by order, so a hot
    customer's orders may be split over tasks here and are combined before they meet again.
    """
    headers, joined = frames.order_headers(spark, base), frames.members(spark, base)
    return headers.join(joined, headers["customer_id"] == joined["member_id"]).drop("member_id")


def _on_headers(spark: SparkSession, base: str, lines: DataFrame, of_members: bool) -> DataFrame:
    if not of_members:
        return enrich(lines, frames.order_headers(spark, base), "order_id", "order_key")
    headers = _member_headers(spark, base)
    return lines.join(headers, lines["order_id"] == headers["order_key"]).drop("order_key")


def _per_order(spark: SparkSession, base: str, *totals: Column, of_members: bool = False) -> DataFrame:
    """Line totals per order, on their order header. Lines are combined before the join needs them."""
    lines = frames.purchase_lines(spark, base, priced=True).groupBy("order_id").agg(*totals)
    return _on_headers(spark, base, lines, of_members)


def _one_line_per_order(
    spark: SparkSession, base: str, last: bool = False, of_members: bool = False
) -> DataFrame:
    """The first (or last) line of each order, on its order header."""
    direction = F.desc if last else F.asc
    lines = first_per_group(
        frames.purchase_lines(spark, base).select("order_id", "line_number", "product_id"),
        ["order_id"],
        [direction("line_number"), direction("product_id")],
    )
    return _on_headers(spark, base, lines, of_members)


def spend_per_customer(spark: SparkSession, base: str) -> DataFrame:
    return (
        _per_order(spark, base, F.sum("amount").alias("amount"))
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("total_spend"))
        .orderBy("customer_id")
    )


def visit_days_per_customer(spark: SparkSession, base: str) -> DataFrame:
    bought = frames.purchase_lines(spark, base).select("order_id").distinct()
    return (
        enrich(bought, frames.order_headers(spark, base), "order_id", "order_key")
        .groupBy("customer_id")
        .agg(F.countDistinct("order_date").alias("visit_days"))
        .orderBy(F.desc("visit_days"), "customer_id")
    )


def first_item_per_customer(spark: SparkSession, base: str) -> DataFrame:
    return first_per_group(
        _one_line_per_order(spark, base),
        ["customer_id"],
        [F.asc("order_date"), F.asc("order_id")],
    ).select("customer_id", "product_id", "order_date")


def most_purchased_item(spark: SparkSession, base: str, n: int = 1) -> DataFrame:
    counts = (
        frames.purchase_lines(spark, base).groupBy("product_id").agg(F.count("product_id").alias("n_purchases"))
    )
    return top_n(counts, "n_purchases", ["product_id"], n)


def favourite_item_per_customer(spark: SparkSession, base: str) -> DataFrame:
    lines = frames.purchase_lines(spark, base).select("order_id", "product_id")
    counts = (
        enrich(lines, frames.order_headers(spark, base), "order_id", "order_key")
        .groupBy("customer_id", "product_id")
        .agg(F.count("*").alias("n_purchases"))
    )
    return first_per_group(counts, ["customer_id"], [F.desc("n_purchases"), F.asc("product_id")])


def first_item_after_joining(spark: SparkSession, base: str) -> DataFrame:
    purchases = _one_line_per_order(spark, base, of_members=True)
    return first_from(
        purchases, ["customer_id"], F.col("order_date"), F.col("join_date"), [F.asc("order_id")]
    ).select("customer_id", "product_id", "order_date")


def last_item_before_joining(spark: SparkSession, base: str) -> DataFrame:
    purchases = _one_line_per_order(spark, base, last=True, of_members=True)
    return last_before(
        purchases, ["customer_id"], F.col("order_date"), F.col("join_date"), [F.desc("order_id")]
    ).select("customer_id", "product_id", "order_date")


def premember_items_and_spend(spark: SparkSession, base: str) -> DataFrame:
    """Only lines of orders before joining are kept, and they are summed per product before pricing."""
    lines = frames.purchase_lines(spark, base).select("order_id", "product_id", "qty")
    per_item = (
        _on_headers(spark, base, lines, of_members=True)
        .where(F.datediff("order_date", "join_date") < 0)
        .groupBy("customer_id", "product_id")
        .agg(F.sum("qty").alias("qty"))
    )
    priced = enrich(per_item, frames.prices(spark, base), "product_id", "price_product")
    return priced.groupBy("customer_id").agg(
        F.count("product_id").alias("n_items"), F.sum(F.col("qty") * F.col("price")).alias("amount_spent")
    )


def loyalty_points_by_item_weight(
    spark: SparkSession, base: str, points_per_unit: int = 10, members_only: bool = False
) -> DataFrame:
    """Points per customer, the bonus kind counting double."""
    weight = F.when(F.col("kind") == BONUS_KIND, 2).otherwise(1)
    purchases = _per_order(
        spark, base, F.sum(F.col("amount") * weight).alias("weighted"), of_members=members_only
    )
    if members_only:
        purchases = purchases.where(F.datediff("order_date", "join_date") >= 0)
    return (
        purchases.groupBy("customer_id")
        .agg((F.sum("weighted") * points_per_unit).alias("points"))
        .orderBy(F.desc("points"), "customer_id")
    )


def loyalty_points_with_join_bonus(
    spark: SparkSession,
    base: str,
    points_per_unit: int = 10,
    bonus_days: int = 7,
    cutoff: dt.date = dt.date(1999, 1, 1),
) -> DataFrame:
    """Points of members for purchases from joining until ``cutoff``.

    Everything counts double in the first ``bonus_days`` days, the join date included; afterwards only
    the bonus kind does.
    """
    weight = F.when(F.col("kind") == BONUS_KIND, 2).otherwise(1)
    purchases = _per_order(
        spark,
        base,
        F.sum("amount").alias("amount"),
        F.sum(F.col("amount") * weight).alias("weighted"),
        of_members=True,
    ).where(F.col("order_date") < F.lit(cutoff))
    days = F.datediff("order_date", "join_date")
    earned = F.when(days < bonus_days, F.col("amount") * 2).otherwise(F.col("weighted"))
    return (
        purchases.where(days >= 0)
        .groupBy("customer_id")
        .agg((F.sum(earned) * points_per_unit).alias("points"))
        .orderBy("customer_id")
    )


QUERIES = {
    f.__name__: f
    for f in (
        spend_per_customer,
        visit_days_per_customer,
        first_item_per_customer,
        most_purchased_item,
        favourite_item_per_customer,
        first_item_after_joining,
        last_item_before_joining,
        premember_items_and_spend,
        loyalty_points_by_item_weight,
        loyalty_points_with_join_bonus,
    )
}
