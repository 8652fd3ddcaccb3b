"""Orders, runners and deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import (
    concat_nulls_as_empty,
    list_length,
    mean,
    minutes_between,
    percent,
    ratio,
)
from tallyline.operators.joins import enrich
from tallyline.operators.ranking import top_n
from tallyline.plans import frames
from tallyline.sources import append_rows, literal_table, replace_table, scratch_path, stored


def _delivered() -> Column:
    return F.col("cancellation").isNull()


# --- cleaning --------------------------------------------------------------------------------


def clean_null_sentinels(spark: SparkSession, base: str) -> DataFrame:
    return frames.sentinel_free_deliveries(spark, base).select(
        F.col("delivery_order").alias("order_id"), "pickup_time", "distance", "duration", "cancellation"
    )


def clean_null_sentinels_in_lists(spark: SparkSession, base: str) -> DataFrame:
    return frames.order_lines(spark, base)


def clean_distance_numeric(spark: SparkSession, base: str) -> DataFrame:
    return frames.deliveries(spark, base).select(F.col("delivery_order").alias("order_id"), "distance")


def clean_duration_numeric(spark: SparkSession, base: str) -> DataFrame:
    return frames.deliveries(spark, base).select(F.col("delivery_order").alias("order_id"), "duration")


# --- frames shared by the metrics ------------------------------------------------------------


def _order_sizes(spark: SparkSession, base: str, **counts: Column) -> DataFrame:
    """Number of lines per order, and of those meeting each named condition, on its delivery.

    Lines are counted before the join, so that an order of any size reaches it as one row.
    """
    sizes = frames.order_lines(spark, base).groupBy("order_id").agg(
        F.count("*").alias("n_lines"), *[F.count_if(condition).alias(name) for name, condition in counts.items()]
    )
    return enrich(sizes, frames.deliveries(spark, base), "order_id", "delivery_order")


def _pickup_minutes(df: DataFrame) -> DataFrame:
    return df.withColumn("minutes", minutes_between(F.col("order_time"), F.col("pickup_time")))


# --- order metrics ---------------------------------------------------------------------------


def ordered_item_count(spark: SparkSession, base: str) -> DataFrame:
    return frames.order_lines(spark, base).agg(F.count("product_id").alias("n_items"))


def unique_order_configs(spark: SparkSession, base: str) -> DataFrame:
    different = frames.order_lines(spark, base).select("product_id", "removed", "added").distinct()
    named = enrich(different, frames.items(spark, base), "product_id", "item_product")
    config = concat_nulls_as_empty(F.col("item"), F.col("removed"), F.col("added"), sep="|")
    return named.select(config.alias("config")).agg(F.countDistinct("config").alias("n_configs"))


def successful_per_runner(spark: SparkSession, base: str) -> DataFrame:
    return (
        _order_sizes(spark, base)
        .where(_delivered())
        .groupBy("runner_id")
        .agg(F.sum("n_lines").alias("n_lines"), F.count("order_id").alias("n_orders"))
        .orderBy("runner_id")
    )


def delivered_per_item_type(spark: SparkSession, base: str) -> DataFrame:
    lines = enrich(frames.order_lines(spark, base), frames.deliveries(spark, base), "order_id", "delivery_order")
    per_product = lines.where(_delivered()).groupBy("product_id").agg(F.count("*").alias("n"))
    return (
        enrich(per_product, frames.items(spark, base), "product_id", "item_product")
        .groupBy("item")
        .agg(F.sum("n").alias("n_delivered"))
        .orderBy("item")
    )


def item_mix_per_customer(spark: SparkSession, base: str) -> DataFrame:
    """Lines are counted per customer and product before the product is named."""
    lines = frames.order_lines(spark, base).select("order_id", "product_id")
    headers = frames.order_headers(spark, base).select("order_key", "customer_id")
    per_product = (
        enrich(lines, headers, "order_id", "order_key")
        .groupBy("customer_id", "product_id")
        .agg(F.count("*").alias("n"))
    )
    return (
        enrich(per_product, frames.items(spark, base), "product_id", "item_product")
        .groupBy("customer_id", "item")
        .agg(F.sum("n").alias("n_items"))
        .orderBy("customer_id", "item")
    )


def max_items_in_order(spark: SparkSession, base: str) -> DataFrame:
    sizes = _order_sizes(spark, base).where(_delivered()).select("order_id", "n_lines")
    return top_n(sizes, "n_lines", ["order_id"], 1)


def changed_vs_unchanged(spark: SparkSession, base: str) -> DataFrame:
    n_changes = list_length(F.col("removed")) + list_length(F.col("added"))
    orders = _order_sizes(spark, base, n_changed=n_changes > 0, n_unchanged=n_changes == 0)
    counts = F.array(
        F.struct(F.lit("1").alias("changed"), F.col("n_changed").alias("n_items")),
        F.struct(F.lit("0").alias("changed"), F.col("n_unchanged").alias("n_items")),
    )
    return (
        orders.where(_delivered())
        .select("customer_id", F.inline(counts))
        .where(F.col("n_items") > 0)
        .groupBy("customer_id", "changed")
        .agg(F.sum("n_items").alias("n_items"))
        .orderBy(F.desc("n_items"), "customer_id", "changed")
    )


def both_removed_and_added(spark: SparkSession, base: str) -> DataFrame:
    both = (list_length(F.col("removed")) > 0) & (list_length(F.col("added")) > 0)
    return (
        _order_sizes(spark, base, n_both=both)
        .where(_delivered())
        .agg(F.coalesce(F.sum("n_both"), F.lit(0)).alias("n_items"))
    )


def volume_by_hour(spark: SparkSession, base: str) -> DataFrame:
    return (
        _order_sizes(spark, base)
        .groupBy(F.hour("order_time").cast("bigint").alias("order_hour"))
        .agg(F.sum("n_lines").alias("n_items"))
        .orderBy("order_hour")
    )


def volume_by_weekday(spark: SparkSession, base: str) -> DataFrame:
    return (
        _order_sizes(spark, base)
        .groupBy(F.date_format(F.to_date("order_time"), "EEEE").alias("weekday"))
        .agg(F.sum("n_lines").alias("n_items"))
        .orderBy(F.desc("weekday"))
    )


# --- runner metrics --------------------------------------------------------------------------


def pickup_minutes_per_order(spark: SparkSession, base: str) -> DataFrame:
    """One row per delivered order: the lines of an order agree, so its number alone stands for them."""
    orders = frames.order_lines(spark, base).select("order_id").distinct()
    joined = enrich(orders, frames.deliveries(spark, base), "order_id", "delivery_order")
    return _pickup_minutes(joined.where(_delivered())).select("order_id", "minutes").orderBy("order_id")


def prep_time_correlation(spark: SparkSession, base: str) -> DataFrame:
    timed = _pickup_minutes(_order_sizes(spark, base).where(_delivered()))
    return timed.agg(
        F.round(F.corr(F.col("minutes").cast("double"), F.col("n_lines").cast("double")), 6).alias("correlation")
    )


def mean_distance_per_order(spark: SparkSession, base: str) -> DataFrame:
    """Mean distance over the lines of each delivered order, an order's lines being one counted row."""
    measured = F.when(F.col("distance").isNotNull(), F.col("n_lines"))
    return (
        _order_sizes(spark, base)
        .where(_delivered())
        .groupBy("order_id", "customer_id")
        .agg(mean(F.sum(F.col("distance") * F.col("n_lines")), F.sum(measured), 2).alias("mean_distance"))
    )


def delivery_time_spread(spark: SparkSession, base: str) -> DataFrame:
    timed = _pickup_minutes(_order_sizes(spark, base).where(_delivered()))
    return timed.agg((F.max("minutes") - F.min("minutes")).alias("spread_minutes"))


def speed_per_delivery(spark: SparkSession, base: str) -> DataFrame:
    speed = ratio(F.col("distance"), F.col("duration"), 4)
    return (
        _order_sizes(spark, base)
        .where(_delivered())
        .select("order_time", "order_id", "runner_id", speed.alias("speed"))
        .distinct()
        .orderBy("order_id")
    )


def cancellation_rate_per_runner(spark: SparkSession, base: str) -> DataFrame:
    per_runner = frames.deliveries(spark, base).groupBy("runner_id").agg(
        F.count("*").alias("n_orders"), F.count("cancellation").alias("n_cancelled")
    )
    return per_runner.select(
        "runner_id",
        "n_orders",
        percent(F.col("n_cancelled"), F.col("n_orders")).alias("cancelled_pct"),
        percent(F.col("n_orders") - F.col("n_cancelled"), F.col("n_orders")).alias("success_pct"),
    ).orderBy(F.desc("cancelled_pct"), "runner_id")


# --- pricing and ratings ---------------------------------------------------------------------


def fixed_price_revenue(spark: SparkSession, base: str) -> DataFrame:
    per_product = frames.order_lines(spark, base).groupBy("product_id").agg(F.count("*").alias("n"))
    priced = enrich(per_product, frames.items(spark, base), "product_id", "item_product")
    return priced.agg(F.sum(frames.item_price(F.col("item")) * F.col("n")).alias("revenue"))


def _rating(order_id: Column) -> Column:
    return (order_id * 7) % 5 + 1


def ratings_preview(spark: SparkSession, base: str) -> DataFrame:
    """A rating of 1 to 5 per order, decided by the order number so that a rerun agrees."""
    return _order_sizes(spark, base).select(
        "order_id", "customer_id", "runner_id", _rating(F.col("order_id")).alias("rating")
    )


def ratings_build(spark: SparkSession, base: str) -> DataFrame:
    """The ratings as a table: replaced by an empty one, then filled from the query."""
    ratings = ratings_preview(spark, base)
    path = scratch_path(spark, "ratings")
    replace_table(literal_table(spark, [], ratings.schema), path)
    return append_rows(ratings, path)


def _stored_ratings(spark: SparkSession, base: str) -> DataFrame:
    """The ratings table, built once as long as the orders and their lines stay the same."""
    inputs = [f"{base}/{name}.parquet" for name in ("orders", "lineitem")]
    return stored(spark, "ratings_table", inputs, lambda: ratings_build(spark, base))


def delivery_report(spark: SparkSession, base: str) -> DataFrame:
    """One wide row per delivered order, with the rating that the ratings table has for it."""
    per_product = frames.order_lines(spark, base).groupBy("order_id", "product_id").agg(F.count("*").alias("n"))
    sizes = per_product.groupBy("order_id").agg(
        F.sum("n").alias("n_lines"), F.count("product_id").alias("n_products")
    )
    report = sizes.join(
        frames.deliveries(spark, base).where(F.col("pickup_time").isNotNull()),
        F.col("order_id") == F.col("delivery_order"),
    )
    ratings = _stored_ratings(spark, base).select(F.col("order_id").alias("rated_order"), "rating")
    rated = enrich(_pickup_minutes(report), ratings, "order_id", "rated_order")
    return rated.select(
        "order_id",
        "customer_id",
        "runner_id",
        "rating",
        "order_time",
        "pickup_time",
        F.col("minutes").alias("minutes_to_pickup"),
        "duration",
        ratio(F.col("distance"), F.col("duration"), 2).alias("speed"),
        "n_lines",
        "n_products",
    ).orderBy("order_id")


def net_revenue_after_payout(spark: SparkSession, base: str) -> DataFrame:
    """Revenue of delivered orders less 0.30 per unit of distance, per order and then in total."""
    lines = enrich(
        frames.order_lines(spark, base).select("order_id", "product_id"),
        frames.items(spark, base),
        "product_id",
        "item_product",
    )
    sales = lines.groupBy("order_id").agg(F.sum(frames.item_price(F.col("item"))).alias("order_sales"))
    orders = enrich(sales, frames.deliveries(spark, base), "order_id", "delivery_order").where(_delivered())
    payout = F.col("distance") * F.lit("0.30").cast("decimal(3,2)")
    return orders.agg(F.sum(F.col("order_sales") - payout).cast("decimal(20,2)").alias("net_revenue"))


QUERIES = {
    f.__name__: f
    for f in (
        clean_null_sentinels,
        clean_null_sentinels_in_lists,
        clean_distance_numeric,
        clean_duration_numeric,
        ordered_item_count,
        unique_order_configs,
        successful_per_runner,
        delivered_per_item_type,
        item_mix_per_customer,
        max_items_in_order,
        changed_vs_unchanged,
        both_removed_and_added,
        volume_by_hour,
        volume_by_weekday,
        pickup_minutes_per_order,
        prep_time_correlation,
        mean_distance_per_order,
        delivery_time_spread,
        speed_per_delivery,
        cancellation_rate_per_runner,
        fixed_price_revenue,
        ratings_preview,
        ratings_build,
        delivery_report,
        net_revenue_after_payout,
    )
}
