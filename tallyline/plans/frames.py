"""The business tables the plans run on, derived from the star schema and the event log.

Each function builds only the joins its caller asks for, always as left joins from the fact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import day_of, money, parse_time_text
from tallyline.operators.cleaning import null_sentinels, overwrite_where, strip_units
from tallyline.operators.joins import enrich
from tallyline.sources import literal_table, read_table

# The ingredient dimension.
INGREDIENTS = [
    (1, "Basil"),
    (2, "Walnut"),
    (3, "Olive"),
    (4, "Feta"),
    (5, "Chickpea"),
    (6, "Aubergine"),
    (7, "Rice"),
    (8, "Sumac"),
    (9, "Lentil"),
    (10, "Cress"),
    (11, "Tahini"),
    (12, "Paprika"),
]

# The page dimension; pages without a category are not products.
PAGES = [
    (1, "Landing", None, None),
    (2, "Catalogue", None, None),
    (3, "Desk Lamp", "Lighting", 1),
    (4, "Floor Lamp", "Lighting", 2),
    (5, "Lantern", "Lighting", 3),
    (6, "Armchair", "Seating", 4),
    (7, "Bench", "Seating", 5),
    (8, "Stool", "Seating", 6),
    (9, "Bookcase", "Storage", 7),
    (10, "Drawer Unit", "Storage", 8),
    (11, "Shelf", "Storage", 9),
    (12, "Basket Review", None, None),
    (13, "Thank You", None, None),
]

# Event codes of the click stream and the log's word for each.
VIEW, ADD, PURCHASE, IMPRESSION, CLICK = 1, 2, 3, 4, 5
EVENT_TYPES = [
    (VIEW, "Page View"),
    (ADD, "Cart Add"),
    (PURCHASE, "Purchase"),
    (IMPRESSION, "Ad Impression"),
    (CLICK, "Ad Click"),
]
EVENT_WORDS = {"view": VIEW, "signup": ADD, "purchase": PURCHASE, "error": IMPRESSION, "click": CLICK}

# The campaigns; the first ends inside a day and the last is open-ended.
CAMPAIGNS = [
    (1, "New Year Lights", dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 9, 12)),
    (2, "Sit Down Sale", dt.datetime(2024, 1, 12), dt.datetime(2024, 1, 16, 23, 59, 59)),
    (3, "Tidy Home", dt.datetime(2024, 1, 24, 6, 30), dt.datetime(9999, 12, 31)),
]

CLICK_ANCHOR = dt.date(2024, 1, 1)
UNIT_WORDS = {"distance": ["km"], "duration": ["minutes", "mins", "minute"]}


# --- purchases and members -------------------------------------------------------------------


def purchase_lines(spark: SparkSession, base: str, priced: bool = False) -> DataFrame:
    """Order lines: order_id, line_number, product_id, qty; with ``priced`` also price, kind, amount."""
    lines = read_table(spark, base, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("qty"),
    )
    if not priced:
        return lines
    menu = read_table(spark, base, "part").select(
        "p_partkey", money(F.col("p_retailprice")).alias("price"), F.col("p_type").alias("kind")
    )
    return enrich(lines, menu, "product_id", "p_partkey").withColumn(
        "amount", (F.col("qty") * F.col("price")).cast("decimal(18,2)")
    )


def order_headers(spark: SparkSession, base: str) -> DataFrame:
    """order_key, customer_id, order_date."""
    return read_table(spark, base, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_custkey").alias("customer_id"),
        day_of(F.col("o_orderdate")).alias("order_date"),
    )


def members(spark: SparkSession, base: str) -> DataFrame:
    """Customers in the loyalty programme: member_id, join_date."""
    key = F.col("c_custkey")
    return (
        read_table(spark, base, "customer")
        .where(key % 3 != 0)
        .select(
            key.alias("member_id"),
            F.date_add(F.lit(dt.date(1997, 1, 1)), (key % 730).cast("int")).alias("join_date"),
        )
    )


# --- deliveries ------------------------------------------------------------------------------


def _order_time() -> Column:
    minute = (F.col("o_orderkey") * 37) % 1440
    return F.col("o_orderdate") + F.make_dt_interval(mins=minute.cast("int"))


def dirty_deliveries(spark: SparkSession, base: str) -> DataFrame:
    """One row per order with its delivery noted as text, units and missing-value words included."""
    key = F.col("o_orderkey")
    form = key % 4
    tenths = key % 250 + 10
    distance = (tenths / 10).cast("decimal(10,1)").cast("string")
    minutes = (key % 31 + 10).cast("string")
    wait = F.make_dt_interval(mins=((key * 13) % 50 + 10).cast("int"), secs=(key % 60).cast("decimal(18,6)"))
    pickup = (_order_time() + wait).cast("string")
    return read_table(spark, base, "orders").select(
        key.alias("delivery_order"),
        F.col("o_custkey").alias("customer_id"),
        _order_time().alias("order_time"),
        (F.col("o_custkey") % 10).alias("runner_id"),
        F.when(form == 3, "null").otherwise(pickup).alias("pickup_time"),
        F.when(form == 0, F.concat(distance, F.lit("km")))
        .when(form == 1, F.concat(distance, F.lit(" km")))
        .when(form == 2, distance)
        .otherwise("null")
        .alias("distance"),
        F.when(form == 0, F.concat(minutes, F.lit(" minutes")))
        .when(form == 1, F.concat(minutes, F.lit("mins")))
        .when(form == 2, F.concat(minutes, F.lit(" minute")))
        .otherwise("null")
        .alias("duration"),
        F.when(form == 0, "").when(form == 1, "null").when(form == 3, "Cancelled").alias("cancellation"),
    )


def sentinel_free_deliveries(spark: SparkSession, base: str) -> DataFrame:
    """Missing-value words as NULL: both of them in three columns, only ``'null'`` in the duration."""
    words = dict.fromkeys(("pickup_time", "distance", "cancellation"), ("", "null"))
    cleaned = null_sentinels(dirty_deliveries(spark, base), words)
    return overwrite_where(cleaned, "duration", F.col("duration") == "null", F.lit(None))


def deliveries(spark: SparkSession, base: str) -> DataFrame:
    """Cleaned deliveries: typed pickup_time, distance and duration, NULL cancellation when delivered."""
    cleaned = sentinel_free_deliveries(spark, base)
    for column, units in UNIT_WORDS.items():
        cleaned = strip_units(cleaned, column, units, "decimal(10,1)")
    return cleaned.withColumn("pickup_time", parse_time_text(F.col("pickup_time")))


def dirty_order_lines(spark: SparkSession, base: str) -> DataFrame:
    """Order lines with ingredient changes kept as lists in text, missing-value words included."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")

    def ids(*values: Column) -> Column:
        return F.concat_ws(", ", *[(v % 12 + 1).cast("string") for v in values])

    removed = (
        F.when(part % 5 == 0, "")
        .when(part % 5 == 1, "null")
        .when(part % 5 == 3, ids(part))
        .when(part % 5 == 4, ids(part, part + 5))
    )
    added = (
        F.when(supp % 6 == 0, "")
        .when(supp % 6 == 2, "null")
        .when(supp % 6 == 3, ids(supp))
        .when(supp % 6 == 4, ids(supp, supp + 4))
        .when(supp % 6 == 5, ids(supp, supp + 4, supp + 7))
    )
    return read_table(spark, base, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        part.alias("product_id"),
        removed.alias("removed"),
        added.alias("added"),
    )


def order_lines(spark: SparkSession, base: str) -> DataFrame:
    """Cleaned order lines: order_id, line_number, product_id, removed, added."""
    return null_sentinels(
        dirty_order_lines(spark, base), {"removed": ["", "null"], "added": ["", "null"]}
    )


def items(spark: SparkSession, base: str) -> DataFrame:
    """Item name per product: item_product, item."""
    return read_table(spark, base, "part").select(
        F.col("p_partkey").alias("item_product"), F.col("p_type").alias("item")
    )


def item_price(item: Column) -> Column:
    return F.when(item == "PROMO", 12).otherwise(10)


def ingredients(spark: SparkSession) -> DataFrame:
    return literal_table(spark, INGREDIENTS, "ingredient_id int, ingredient string")


def recipes(spark: SparkSession, base: str) -> DataFrame:
    """recipe_item and its ingredient ids as a list in text; one row per item name."""
    item = F.col("p_type")
    used = F.filter(
        F.sequence(F.lit(1), F.lit(12)), lambda i: (F.ascii(item) * i + F.char_length(item)) % 3 != 0
    )
    return (
        read_table(spark, base, "part")
        .select(item)
        .distinct()
        .select(item.alias("recipe_item"), F.array_join(used, ", ").alias("recipe"))
    )


# --- weekly sales ----------------------------------------------------------------------------


Span = tuple[dt.date, dt.date]


WEEKLY_DIMENSIONS = ("platform", "region", "segment", "customer_type")


def weekly_sales_raw(
    spark: SparkSession,
    base: str,
    dimensions: Iterable[str] = WEEKLY_DIMENSIONS,
    spans: Sequence[Span] | None = None,
) -> DataFrame:
    """Sales per week (as day/month/year text) and the asked dimensions: transactions and sales.

    Only the joins behind the asked dimensions are planned. The customer side is put on the orders
    first, so lines are shuffled once, by order. ``spans`` narrows the sales to some whole weeks, for a question
    about these weeks alone; being plain date ranges, they reach the scan.
    """
    wanted = [d for d in WEEKLY_DIMENSIONS if d in set(dimensions)]
    day = F.col("l_shipdate")
    in_span = F.lit(spans is None)
    for first, past in spans or ():
        in_span = in_span | (
            (day >= F.lit(first).cast("timestamp_ntz")) & (day < F.lit(past).cast("timestamp_ntz"))
        )
    monday = F.date_sub(F.to_date(day), F.weekday(F.to_date(day)))
    lines = (
        read_table(spark, base, "lineitem")
        .where(in_span)
        .select(
            "l_orderkey",
            monday.alias("monday"),
            F.when(F.col("l_linestatus") == "O", "Online").otherwise("Store").alias("platform"),
            money(F.col("l_extendedprice")).alias("amount"),
        )
    )
    if set(wanted) - {"platform"}:
        lines = enrich(lines, _order_customers(spark, base, wanted), "l_orderkey", "o_orderkey")
    week_text = F.concat_ws("/", F.dayofmonth("monday"), F.month("monday"), F.date_format("monday", "yy"))
    return (
        lines.groupBy("monday", *wanted)
        .agg(F.count("*").alias("transactions"), F.sum("amount").cast("decimal(20,2)").alias("sales"))
        .select(week_text.alias("week_date"), *wanted, "transactions", "sales")
    )


def _order_customers(spark: SparkSession, base: str, wanted: list[str]) -> DataFrame:
    key = F.col("o_custkey")
    form = key % 9
    segment = F.when(form == 0, "null").otherwise(
        F.concat(F.when(form <= 4, "C").otherwise("F"), ((form - 1) % 4 + 1).cast("string"))
    )
    customer_type = F.when(key % 3 == 0, "Guest").when(key % 3 == 1, "New").otherwise("Existing")
    orders = read_table(spark, base, "orders").select(
        "o_orderkey", "o_custkey", segment.alias("segment"), customer_type.alias("customer_type")
    )
    if "region" in wanted:
        nations = enrich(
            read_table(spark, base, "nation").select("n_nationkey", "n_regionkey"),
            read_table(spark, base, "region").select("r_regionkey", F.col("r_name").alias("region")),
            "n_regionkey",
            "r_regionkey",
        ).select("n_nationkey", "region")
        customers = enrich(
            read_table(spark, base, "customer").select("c_custkey", "c_nationkey"),
            nations,
            "c_nationkey",
            "n_nationkey",
        ).select("c_custkey", "region")
        orders = enrich(orders, customers, "o_custkey", "c_custkey")
    return orders.select("o_orderkey", *[d for d in wanted if d != "platform"])


# --- click stream ----------------------------------------------------------------------------


def clicks(spark: SparkSession, base: str) -> DataFrame:
    """Events as visits: visit_id, cookie_id, user_id, page_id, event_type, event_time.

    A visit is a user's day and a cookie a user's week.
    """
    user, ts = F.col("user_id"), F.col("ts")
    code = F.lit(None).cast("int")
    for word, number in EVENT_WORDS.items():
        code = F.when(F.col("event_type") == word, number).otherwise(code)
    week = F.floor(F.datediff(day_of(ts), F.lit(CLICK_ANCHOR)) / 7)
    return read_table(spark, base, "events").select(
        F.concat_ws("-", user, F.to_date(ts)).alias("visit_id"),
        F.concat_ws("-w", user, week).alias("cookie_id"),
        user,
        (F.regexp_extract("props", r"(\d+)", 1).try_cast("int") % 13 + 1).alias("page_id"),
        code.alias("event_type"),
        ts.alias("event_time"),
    )


def users(spark: SparkSession, base: str) -> DataFrame:
    """The distinct pairs of user_id and cookie_id."""
    return clicks(spark, base).select("user_id", "cookie_id").distinct()


def pages(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PAGES, "page_key int, page_name string, category string, page_product int")


def event_types(spark: SparkSession) -> DataFrame:
    return literal_table(spark, EVENT_TYPES, "type_key int, event_name string")


def campaigns(spark: SparkSession) -> DataFrame:
    return literal_table(
        spark, CAMPAIGNS, "campaign_id int, campaign_name string, starts timestamp_ntz, ends timestamp_ntz"
    )


# --- transactions ----------------------------------------------------------------------------


def basket_lines(spark: SparkSession, base: str) -> DataFrame:
    """txn_id, prod_id, qty, discount_pct, txn_time."""
    percent_off = (F.col("l_discount").cast("decimal(4,2)") * 100).cast("int")
    return read_table(spark, base, "lineitem").select(
        F.col("l_orderkey").alias("txn_id"),
        F.col("l_partkey").alias("prod_id"),
        F.col("l_quantity").cast("int").alias("qty"),
        percent_off.alias("discount_pct"),
        F.col("l_shipdate").alias("txn_time"),
    )


def prices(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "part").select(
        F.col("p_partkey").alias("price_product"), money(F.col("p_retailprice")).alias("price")
    )


def member_flags(spark: SparkSession, base: str) -> DataFrame:
    """Per transaction, the member flag as text: member_txn, member ('t' or 'f')."""
    return read_table(spark, base, "orders").select(
        F.col("o_orderkey").alias("member_txn"),
        F.when(F.col("o_custkey") % 3 != 0, "t").otherwise("f").alias("member"),
    )
