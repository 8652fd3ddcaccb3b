"""Visits, funnels and campaigns over the click stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import ratio, year_month
from tallyline.operators.funnel import funnel, rates
from tallyline.operators.intervals import attribute_interval
from tallyline.operators.joins import enrich, flag_if_in, keep_if_in, keep_if_not_in
from tallyline.operators.metrics import share_of_total
from tallyline.operators.ranking import top_n
from tallyline.plans import frames
from tallyline.plans.frames import ADD, CLICK, CLICK_ANCHOR, IMPRESSION, PURCHASE, VIEW
from tallyline.sources import materialise, stored

CHECKOUT_PAGE = 12
NO_CAMPAIGN = "No Campaign"


def _named(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """Page and event names for whichever of page_id and event_type the frame has."""
    if "page_id" in counts.columns:
        counts = enrich(counts, frames.pages(spark), "page_id", "page_key")
    if "event_type" in counts.columns:
        counts = enrich(counts, frames.event_types(spark), "event_type", "type_key")
    return counts


# --- digital metrics -------------------------------------------------------------------------


def signups_per_week(spark: SparkSession, base: str) -> DataFrame:
    """Sign-up events per seven-day week counted from an anchor date, the first week being 1."""
    days = F.datediff(F.to_date("ts"), F.lit(CLICK_ANCHOR))
    week = (F.floor(days / 7) + 1).cast("bigint")
    return (
        frames.read_table(spark, base, "events")
        .where(F.col("event_type") == "signup")
        .groupBy(week.alias("week"))
        .agg(F.count("*").alias("n_signups"))
        .orderBy("week")
    )


def distinct_users(spark: SparkSession, base: str) -> DataFrame:
    return frames.users(spark, base).agg(F.countDistinct("user_id").alias("n_users"))


def avg_cookies_per_user(spark: SparkSession, base: str) -> DataFrame:
    return (
        frames.users(spark, base)
        .agg(F.countDistinct("cookie_id").alias("cookies"), F.countDistinct("user_id").alias("users"))
        .select(ratio(F.col("cookies"), F.col("users"), 2).alias("avg_cookies"))
    )


def visits_per_month(spark: SparkSession, base: str) -> DataFrame:
    first_of_month = F.trunc(F.to_date("event_time"), "month")
    return (
        frames.clicks(spark, base)
        .groupBy(first_of_month.alias("first"))
        .agg(F.countDistinct("visit_id").alias("n_visits"))
        .select(year_month(F.col("first")).alias("month"), "n_visits")
        .orderBy("month")
    )


def events_per_type(spark: SparkSession, base: str) -> DataFrame:
    counts = frames.clicks(spark, base).groupBy("event_type").agg(F.count("visit_id").alias("n_events"))
    return _named(spark, counts).select("event_name", "n_events").orderBy(F.desc("n_events"), "event_name")


def purchase_visit_share(spark: SparkSession, base: str) -> DataFrame:
    """Visits with and without a purchase, each as percent of all visits."""
    visits = frames.clicks(spark, base).groupBy("visit_id").agg(
        F.max(F.col("event_type") == PURCHASE).alias("bought")
    )
    label = F.when(F.col("bought"), "purchase").otherwise("no purchase")
    counts = visits.groupBy(label.alias("flag_purchase")).agg(F.count("*").alias("n_visits"))
    return share_of_total(counts, {"n_visits": "visit_pct"})


def checkout_without_purchase(spark: SparkSession, base: str) -> DataFrame:
    """Of the visits that reach the checkout page, the shares with and without a purchase."""
    events = frames.clicks(spark, base)
    reached = events.where(F.col("page_id") == CHECKOUT_PAGE).select("visit_id").distinct()
    bought = events.where(F.col("event_type") == PURCHASE).select("visit_id")
    flagged = flag_if_in(reached, "visit_id", bought, "flag_purchase")
    counts = flagged.groupBy("flag_purchase").agg(F.count("*").alias("n_visits"))
    return share_of_total(counts, {"n_visits": "visit_pct"}).drop("n_visits")


def top_pages_by_views(spark: SparkSession, base: str, n: int = 3) -> DataFrame:
    views = frames.clicks(spark, base).where(F.col("event_type") == VIEW)
    counts = views.groupBy("page_id").agg(F.count("*").alias("n_views"))
    return top_n(_named(spark, counts).select("page_name", "n_views"), "n_views", ["page_name"], n)


def _views_and_adds(spark: SparkSession, base: str, group: str) -> DataFrame:
    events = frames.clicks(spark, base).where(F.col("event_type").isin(VIEW, ADD))
    counts = _named(spark, events.groupBy("page_id", "event_type").agg(F.count("*").alias("n")))
    return (
        counts.where(F.col("category").isNotNull())
        .groupBy(group, "event_name")
        .agg(F.sum("n").alias("n_events"))
        .orderBy(F.desc("n_events"), group, "event_name")
    )


def views_and_adds_by_page(spark: SparkSession, base: str) -> DataFrame:
    return _views_and_adds(spark, base, "page_name")


def views_and_adds_by_category(spark: SparkSession, base: str) -> DataFrame:
    return _views_and_adds(spark, base, "category")


def top_products_by_purchase(spark: SparkSession, base: str, n: int = 3) -> DataFrame:
    """Cart adds inside visits that have a purchase, per product page."""
    events = frames.clicks(spark, base)
    adds = (
        events.where(F.col("event_type") == ADD).groupBy("visit_id", "page_id").agg(F.count("*").alias("n"))
    )
    bought = keep_if_in(adds, "visit_id", events.where(F.col("event_type") == PURCHASE))
    counts = bought.groupBy("page_id").agg(F.sum("n").alias("n_purchases"))
    products = _named(spark, counts).where(~F.col("page_name").isin(*_other_pages()))
    return top_n(products.select("page_name", "n_purchases"), "n_purchases", ["page_name"], n)


def categories_not_in(spark: SparkSession, base: str) -> DataFrame:
    """Categories of the pages seen that are not among those of some of the pages, as NOT IN decides.

    Pages of no category make a member NULL, with which nothing is kept; among no members nothing is, not even NULL.
    """
    seen = enrich(frames.clicks(spark, base).select("page_id").distinct(), frames.pages(spark), "page_id", "page_key")
    among = {
        "product pages": F.col("page_id").between(3, 6),
        "all first pages": F.col("page_id") <= 6,
        "no pages": F.col("page_id") > 13,
    }
    probes = seen.select("category").distinct()
    kept = [
        keep_if_not_in(probes, "category", seen.where(pages), null_aware=True).select(F.lit(name).alias("members"), "category")
        for name, pages in among.items()
    ]
    return kept[0].union(kept[1]).union(kept[2])


def _other_pages() -> list[str]:
    return [name for _, name, category, _ in frames.PAGES if category is None]


# --- funnels ---------------------------------------------------------------------------------


def _funnel(spark: SparkSession, base: str, group: str) -> DataFrame:
    """The funnel per page, named and rolled up to ``group`` when it is already small."""
    per_page = funnel(
        frames.clicks(spark, base), ["page_id"], "visit_id", "event_type", VIEW, ADD, PURCHASE
    )
    steps = ("n_views", "n_adds", "n_abandons", "n_purchases")
    named = _named(spark, per_page).where(F.col("category").isNotNull())
    return named.groupBy(group).agg(*[F.sum(step).alias(step) for step in steps])


def product_funnel(spark: SparkSession, base: str) -> DataFrame:
    return _funnel(spark, base, "page_name").orderBy("page_name")


def category_funnel(spark: SparkSession, base: str) -> DataFrame:
    return _funnel(spark, base, "category").orderBy("category")


def product_funnel_by_views(spark: SparkSession, base: str) -> DataFrame:
    return _funnel(spark, base, "page_name").orderBy(F.desc("n_views"), "page_name")


def _stored_funnel(spark: SparkSession, base: str) -> DataFrame:
    """The product funnel as a table that all its readers share as long as the events stay the same."""
    events = f"{base}/events.parquet"
    return stored(spark, "product_funnel", [events], lambda: _funnel(spark, base, "page_name"))


def funnel_table(spark: SparkSession, base: str) -> DataFrame:
    """The product funnel, computed once and read back as a table."""
    return _stored_funnel(spark, base)


def funnel_ranked(spark: SparkSession, base: str) -> DataFrame:
    return _stored_funnel(spark, base).orderBy(F.desc("n_views"), "page_name")


def _rate(spark: SparkSession, base: str, out: str, part: str, whole: str) -> DataFrame:
    table = rates(_stored_funnel(spark, base), {out: (part, whole)})
    return table.select("page_name", out).orderBy(F.desc(out), "page_name")


def abandon_rate(spark: SparkSession, base: str) -> DataFrame:
    return _rate(spark, base, "abandon_rate", "n_abandons", "n_adds")


def view_to_purchase_rate(spark: SparkSession, base: str) -> DataFrame:
    return _rate(spark, base, "purchase_to_view_rate", "n_purchases", "n_views")


def view_to_add_rate(spark: SparkSession, base: str) -> DataFrame:
    return _rate(spark, base, "add_to_view_rate", "n_adds", "n_views")


def add_to_purchase_rate(spark: SparkSession, base: str) -> DataFrame:
    return _rate(spark, base, "purchase_to_add_rate", "n_purchases", "n_adds")


# --- campaigns -------------------------------------------------------------------------------

COUNTERS = {
    "n_views": VIEW,
    "n_cart_adds": ADD,
    "flag_purchase": PURCHASE,
    "n_impressions": IMPRESSION,
    "n_clicks": CLICK,
}


def _with_campaign(spark: SparkSession, base: str, visits: DataFrame) -> DataFrame:
    """Match each visit to the campaigns running at its start.

    The visits are written first: their span and the matches are read from that table, the events once.
    """
    written = materialise(visits, "visits")
    attributed = attribute_interval(written, "visit_start", frames.campaigns(spark), "starts", "ends")
    return attributed.withColumn(
        "campaign_name", F.coalesce("campaign_name", F.lit(NO_CAMPAIGN))
    ).select("user_id", "visit_id", "visit_start", *COUNTERS, "campaign_name")


def _counter(name: str, count: Column) -> Column:
    return F.least(count, F.lit(1)) if name == "flag_purchase" else count


def visit_campaign_report(spark: SparkSession, base: str) -> DataFrame:
    """One row per visit and campaign, its counters taken from counts per visit and event type.

    Counts per type come first and are spread into columns after; a type without events counts 0.
    """
    per_type = frames.clicks(spark, base).groupBy("visit_id", "event_type").agg(
        F.max("user_id").alias("user_id"), F.min("event_time").alias("first_time"), F.count("*").alias("n")
    )
    counters = [
        _counter(name, F.coalesce(F.max(F.when(F.col("event_type") == code, F.col("n"))), F.lit(0))).alias(name)
        for name, code in COUNTERS.items()
    ]
    visits = per_type.groupBy("visit_id").agg(
        F.max("user_id").alias("user_id"), F.min("first_time").alias("visit_start"), *counters
    )
    return _with_campaign(spark, base, visits)


def visit_campaign_report_compact(spark: SparkSession, base: str) -> DataFrame:
    """The same report from one conditional aggregate."""
    visits = frames.clicks(spark, base).groupBy("visit_id").agg(
        F.max("user_id").alias("user_id"),
        F.min("event_time").alias("visit_start"),
        *[
            _counter(name, F.count_if(F.col("event_type") == code)).alias(name)
            for name, code in COUNTERS.items()
        ],
    )
    return _with_campaign(spark, base, visits)


QUERIES = {
    f.__name__: f
    for f in (
        signups_per_week,
        distinct_users,
        avg_cookies_per_user,
        visits_per_month,
        events_per_type,
        purchase_visit_share,
        checkout_without_purchase,
        top_pages_by_views,
        views_and_adds_by_page,
        views_and_adds_by_category,
        top_products_by_purchase,
        categories_not_in,
        product_funnel,
        category_funnel,
        product_funnel_by_views,
        funnel_table,
        funnel_ranked,
        abandon_rate,
        view_to_purchase_rate,
        view_to_add_rate,
        add_to_purchase_rate,
        visit_campaign_report,
        visit_campaign_report_compact,
    )
}
