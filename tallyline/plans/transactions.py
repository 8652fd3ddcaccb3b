"""Product revenue by month and the distribution of revenue over transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import mean, percent
from tallyline.operators.distribution import count_where, exact_percentiles, mean_where, one_row
from tallyline.operators.joins import enrich
from tallyline.plans import frames
from tallyline.sources import materialise, parts_of

REVENUE_PERCENTILES = {"revenue_p25": "0.25", "revenue_p50": "0.5", "revenue_p75": "0.75"}


def _hundredth(amount: Column) -> Column:
    return (amount * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(24,4)")


def monthly_product_revenue(spark: SparkSession, base: str) -> DataFrame:
    """Quantity, revenue and discount per month and product.

    Price belongs to the product, so quantities are summed first and priced after: the join sees one row
    per month and product.
    """
    first_of_month = F.trunc(F.to_date("txn_time"), "month")
    sold = (
        frames.basket_lines(spark, base)
        .groupBy(first_of_month.alias("first"), "prod_id")
        .agg(F.sum("qty").alias("qty"), F.sum(F.col("qty") * F.col("discount_pct")).alias("qty_pct"))
    )
    month = F.concat(
        F.year("first").cast("string"), F.lit("-"), F.lpad(F.month("first").cast("string"), 2, "0")
    )
    priced = enrich(sold, frames.prices(spark, base), "prod_id", "price_product")
    return priced.select(
        month.alias("month"),
        "prod_id",
        "qty",
        (F.col("qty") * F.col("price")).cast("decimal(20,2)").alias("revenue"),
        _hundredth(F.col("qty_pct") * F.col("price")).alias("discount"),
    ).orderBy(F.desc("month"), "prod_id")


def unique_transactions(spark: SparkSession, base: str) -> DataFrame:
    return (
        frames.basket_lines(spark, base).select("txn_id").distinct().agg(F.count("*").alias("n_transactions"))
    )


def _basket_sizes(spark: SparkSession, base: str) -> DataFrame:
    """Distinct products per transaction. A hot transaction is first combined to one row per product."""
    pairs = frames.basket_lines(spark, base).select("txn_id", "prod_id").distinct()
    return pairs.groupBy("txn_id").agg(F.count("*").alias("n_products"))


def _size_summary() -> list[Column]:
    return [
        F.count("*").alias("n_transactions"),
        mean(F.sum("n_products"), F.count("n_products"), 4).alias("avg_products"),
    ]


def avg_products_per_transaction(spark: SparkSession, base: str) -> DataFrame:
    return _basket_sizes(spark, base).agg(*_size_summary())


def baskets(spark: SparkSession, base: str, with_member: bool) -> DataFrame:
    """One row per transaction: n_products, revenue after discount, discount, and the member flag.

    Lines are combined per transaction and product before they are priced, and per transaction before the
    member flag is looked up. Both times they are dealt into parts whose number grows with the table.
    """
    pct = F.col("discount_pct")
    parts = parts_of(spark, base, "lineitem")
    per_product = (
        frames.basket_lines(spark, base)
        .select("txn_id", "prod_id", "qty", "discount_pct")
        .repartition(parts, "txn_id", "prod_id")
        .groupBy("txn_id", "prod_id")
        .agg(
            F.sum(F.col("qty") * (100 - pct)).alias("kept_pct"),
            F.sum(F.col("qty") * pct).alias("cut_pct"),
        )
    )
    priced = enrich(per_product, frames.prices(spark, base), "prod_id", "price_product")
    per_txn = priced.repartition(parts, "txn_id").groupBy("txn_id").agg(
        F.count("*").alias("n_products"),
        F.sum(_hundredth(F.col("kept_pct") * F.col("price"))).cast("decimal(20,4)").alias("revenue"),
        F.sum(_hundredth(F.col("cut_pct") * F.col("price"))).cast("decimal(20,4)").alias("discount"),
    )
    if not with_member:
        return per_txn
    member = F.col("member")
    return enrich(per_txn, frames.member_flags(spark, base), "txn_id", "member_txn").withColumn(
        "is_member", F.when(member == "t", 1).when(member == "f", 0)
    )


def _summary(spark: SparkSession, base: str, with_member: bool, *extra: Column) -> DataFrame:
    """Percentiles and one-pass aggregates over baskets that are computed once and read several times."""
    table = materialise(baskets(spark, base, with_member), "baskets")
    return one_row(
        table.agg(*_size_summary(), *extra), exact_percentiles(table, "revenue", REVENUE_PERCENTILES)
    )


def _mean_discount() -> Column:
    return mean(F.sum("discount"), F.count("discount"), 2).alias("avg_discount")


def _member_share() -> Column:
    return percent(count_where(F.col("is_member") == 1), F.count("*")).alias("member_pct")


def revenue_percentiles(spark: SparkSession, base: str) -> DataFrame:
    return _summary(spark, base, False)


def avg_discount_per_transaction(spark: SparkSession, base: str) -> DataFrame:
    return _summary(spark, base, False, _mean_discount())


def member_transaction_share(spark: SparkSession, base: str) -> DataFrame:
    return _summary(spark, base, True, _mean_discount(), _member_share())


def member_vs_nonmember_revenue(spark: SparkSession, base: str) -> DataFrame:
    revenue, member = F.col("revenue"), F.col("is_member")
    return _summary(
        spark,
        base,
        True,
        _mean_discount(),
        _member_share(),
        mean_where(revenue, member == 1, 2).alias("avg_member_revenue"),
        mean_where(revenue, member == 0, 2).alias("avg_nonmember_revenue"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        monthly_product_revenue,
        unique_transactions,
        avg_products_per_transaction,
        revenue_percentiles,
        avg_discount_per_transaction,
        member_transaction_share,
        member_vs_nonmember_revenue,
    )
}
