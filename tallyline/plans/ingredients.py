"""Recipes and the ingredient changes of order lines."""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators.joins import enrich
from tallyline.operators.lists import (
    explode_list,
    joined_text,
    name_list,
    named_elements,
    net_list,
    signed_tally,
    zip_lists,
)
from tallyline.plans import frames
from tallyline.sources import append_literal_rows, parts_of

NEW_ITEM = (-1, "house special")
NEW_RECIPE_ITEM = "HOUSE SPECIAL"


def _with_item(spark: SparkSession, base: str, lines: DataFrame) -> DataFrame:
    return enrich(lines, frames.items(spark, base), "product_id", "item_product")


def _with_recipe(spark: SparkSession, base: str, lines: DataFrame) -> DataFrame:
    recipes = frames.recipes(spark, base)
    return lines.join(recipes, lines["item"] == recipes["recipe_item"], "left").drop("recipe_item")


def ingredients_per_item(spark: SparkSession, base: str) -> DataFrame:
    """The ingredient names of each item's recipe, in order of name."""
    parts = explode_list(frames.recipes(spark, base), "recipe", "part_id")
    named = named_elements(parts, "part_id", frames.ingredients(spark), "ingredient_id")
    entry = F.struct(F.col("ingredient"), F.col("ingredient").alias("value"))
    return named.groupBy(F.col("recipe_item").alias("item")).agg(joined_text(entry).alias("ingredients"))


def _element_frequency(spark: SparkSession, base: str, column: str) -> DataFrame:
    """Lines are counted per distinct list first; only the distinct lists are exploded."""
    lists = (
        frames.order_lines(spark, base)
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
    )
    return (
        explode_list(lists, column, "ingredient_id")
        .groupBy("ingredient_id")
        .agg(F.sum("n").alias("n_times"))
        .orderBy(F.desc("n_times"), "ingredient_id")
    )


def added_frequency(spark: SparkSession, base: str) -> DataFrame:
    return _element_frequency(spark, base, "added")


def removed_frequency(spark: SparkSession, base: str) -> DataFrame:
    return _element_frequency(spark, base, "removed")


def paired_changes(spark: SparkSession, base: str) -> DataFrame:
    """How often the n-th removal and the n-th addition of a line are a given pair of ingredients."""
    lists = frames.order_lines(spark, base).groupBy("removed", "added").agg(F.count("*").alias("n"))
    pairs = zip_lists(lists, "removed", "added", "removed_id", "added_id")
    pairs = pairs.groupBy("removed_id", "added_id").agg(F.sum("n").alias("n_lines"))
    names = frames.ingredients(spark)
    for role in ("removed", "added"):
        role_names = names.withColumnRenamed("ingredient", f"{role}_ingredient")
        pairs = named_elements(pairs, f"{role}_id", role_names, "ingredient_id")
    return pairs.select("removed_ingredient", "added_ingredient", "n_lines")


def distinct_changes(spark: SparkSession, base: str) -> DataFrame:
    """The different combinations of item, removals and additions that were ordered."""
    different = frames.order_lines(spark, base).select("product_id", "removed", "added").distinct()
    named = _with_item(spark, base, different).select("item", "removed", "added")
    return named.dropDuplicates(["item", "removed", "added"])


def order_item_label(spark: SparkSession, base: str) -> DataFrame:
    """``item - Exclude a, b - Extra c`` for every order line."""
    names = frames.ingredients(spark)
    lines = _with_item(spark, base, frames.order_lines(spark, base))
    lines = name_list(lines, "removed", names, "ingredient_id", "ingredient", "without")
    lines = name_list(lines, "added", names, "ingredient_id", "ingredient", "extra")

    def clause(word: str, column: str) -> Column:
        return F.when(F.col(column).isNotNull(), F.concat(F.lit(f" - {word} "), F.col(column))).otherwise("")

    label = F.concat(F.col("item"), clause("Exclude", "without"), clause("Extra", "extra"))
    headers = frames.deliveries(spark, base).select("delivery_order", "customer_id", "order_time")
    return enrich(
        lines.select("order_id", label.alias("label")), headers, "order_id", "delivery_order"
    ).select("order_id", "customer_id", "order_time", "label")


def order_ingredient_list(spark: SparkSession, base: str) -> DataFrame:
    """Per order and item, ``item: 2xa, b``: the net ingredients of its lines in order of name."""
    same, parts = ["order_id", "product_id", "removed", "added"], parts_of(spark, base, "lineitem")
    lines = frames.order_lines(spark, base).select(*same)
    alike = lines.repartition(parts, *same).groupBy(*same).agg(F.count("*").alias("n"))
    lists = net_list(
        _with_item(spark, base, alike),
        ["order_id", "item"],
        "removed",
        "added",
        frames.recipes(spark, base).withColumnRenamed("recipe_item", "item"),
        "item",
        "recipe",
        frames.ingredients(spark),
        "ingredient_id",
        "ingredient",
        "ingredients",
        weight="n",
        parts=parts,
    )
    text = F.concat(F.col("item"), F.lit(": "), F.col("ingredients"))
    return lists.select("order_id", "item", text.alias("ingredient_list"))


def ingredient_usage_total(spark: SparkSession, base: str) -> DataFrame:
    """Net use of each ingredient over delivered orders, most used first.

    Equal lines are counted before they are named or exploded.
    """
    lines = enrich(frames.order_lines(spark, base), frames.deliveries(spark, base), "order_id", "delivery_order")
    alike = (
        lines.where(F.col("cancellation").isNull())
        .groupBy("product_id", "removed", "added")
        .agg(F.count("*").alias("n"))
    )
    alike = _with_item(spark, base, alike).groupBy("item", "removed", "added").agg(F.sum("n").alias("n"))
    tally = signed_tally(
        _with_recipe(spark, base, alike), [], "element", "recipe", "removed", "added", weight="n"
    )
    named = named_elements(tally, "element", frames.ingredients(spark), "ingredient_id")
    return named.select("ingredient", F.col("net").alias("n_used")).orderBy(F.desc("n_used"), "ingredient")


def revenue_with_extras(
    spark: SparkSession,
    base: str,
    extra_price: int = 1,
    special_prices: Mapping[str, int] = MappingProxyType({"Feta": 2}),
) -> DataFrame:
    """Ordered revenue at fixed item prices plus a surcharge per added ingredient, special ones dearer."""
    per_product = frames.order_lines(spark, base).groupBy("product_id", "added").agg(F.count("*").alias("n"))
    alike = _with_item(spark, base, per_product).groupBy("item", "added").agg(F.sum("n").alias("n"))
    extras = named_elements(
        explode_list(alike, "added", "element"), "element", frames.ingredients(spark), "ingredient_id"
    )
    known = F.coalesce(F.col("ingredient"), F.lit("-"))
    surcharge = F.when(known == "-", 0)
    for special, price in special_prices.items():
        surcharge = surcharge.when(known == special, price)
    surcharge = surcharge.otherwise(extra_price)
    per_item = alike.groupBy("item").agg(
        F.sum(frames.item_price(F.col("item")) * F.col("n")).alias("item_total")
    )
    extra_per_item = (
        extras.groupBy("item")
        .agg(F.sum(surcharge * F.col("n")).alias("extra_total"))
        .withColumnRenamed("item", "extra_item")
    )
    totals = per_item.join(extra_per_item, F.col("item") == F.col("extra_item"), "left")
    return totals.agg(
        F.sum(F.col("item_total") + F.coalesce(F.col("extra_total"), F.lit(0))).alias("revenue")
    )


def append_new_item(spark: SparkSession, base: str) -> DataFrame:
    products = frames.read_table(spark, base, "part").select("p_partkey", "p_name")
    return append_literal_rows(products, [NEW_ITEM])


def append_all_ingredients_recipe(spark: SparkSession, base: str) -> DataFrame:
    """The recipes plus one that holds every ingredient id in order."""
    everything = frames.ingredients(spark).agg(
        joined_text(F.struct("ingredient_id", F.col("ingredient_id").cast("string").alias("value"))).alias("recipe")
    )
    added = everything.select(F.lit(NEW_RECIPE_ITEM).alias("recipe_item"), "recipe")
    return frames.recipes(spark, base).unionByName(added)


QUERIES = {
    f.__name__: f
    for f in (
        ingredients_per_item,
        added_frequency,
        removed_frequency,
        paired_changes,
        distinct_changes,
        order_item_label,
        order_ingredient_list,
        ingredient_usage_total,
        revenue_with_extras,
        append_new_item,
        append_all_ingredients_recipe,
    )
}
