"""The sequence of results that are asked for in an order, over several range partitions."""

import pytest

from tallyline.plans.registry import QUERIES

BASE = "/root/testdata/sf0.001"

# Columns that decide the order, - for descending. Rows that agree on all of them may stand in any order.
ORDERS = {
    "signups_per_week": ["week"],
    "visits_per_month": ["month"],
    "events_per_type": ["-n_events", "event_name"],
    "views_and_adds_by_page": ["-n_events", "page_name", "event_name"],
    "views_and_adds_by_category": ["-n_events", "category", "event_name"],
    "top_pages_by_views": ["-n_views", "page_name"],
    "top_products_by_purchase": ["-n_purchases", "page_name"],
    "product_funnel": ["page_name"],
    "category_funnel": ["category"],
    "product_funnel_by_views": ["-n_views", "page_name"],
    "funnel_ranked": ["-n_views", "page_name"],
    "abandon_rate": ["-abandon_rate", "page_name"],
    "view_to_purchase_rate": ["-purchase_to_view_rate", "page_name"],
    "view_to_add_rate": ["-add_to_view_rate", "page_name"],
    "add_to_purchase_rate": ["-purchase_to_add_rate", "page_name"],
    "missing_weeks": ["week_number"],
    "transactions_per_year": ["year_number"],
    "transactions_per_region_month": ["month", "region"],
    "avg_ticket_by_platform_year": ["year_number", "platform"],
    "retail_share_by_two_groupings": ["year_number", "group_name"],
    "before_after_4w": ["-period"],
    "before_after_12w": ["-period"],
    "before_after_two_changes": ["change_date", "-period"],
    "before_after_by_year": ["year_number", "-period"],
    "before_after_by_year_region": ["year_number", "-period", "-region"],
    "weekday_per_week": ["week_number"],
}


@pytest.fixture(scope="module")
def uncoalesced(spark):
    """Small partitions stay apart, so a sequence comes out of several tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(uncoalesced, name):
    rows = QUERIES[name](uncoalesced, BASE).collect()
    expected = list(rows)
    for key in reversed(ORDERS[name]):
        column, descending = key.lstrip("-"), key.startswith("-")
        # NULL comes first in ascending order and last in descending order.
        expected.sort(key=lambda r: (r[column] is not None, r[column] or type(r[column])()), reverse=descending)
    columns = [key.lstrip("-") for key in ORDERS[name]]
    assert [[r[c] for c in columns] for r in rows] == [[r[c] for c in columns] for r in expected]
    assert rows
