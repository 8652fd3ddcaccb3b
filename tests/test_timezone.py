"""Results do not depend on the session's time zone, also where its clocks jump at midnight."""

import pytest

from tallyline.plans.registry import QUERIES

BASE = "/root/testdata/sf0.001"
NAMES = [
    "clean_null_sentinels",
    "delivery_report",
    "volume_by_hour",
    "volume_by_weekday",
    "weekly_sales_clean",
    "platform_share_by_month",
    "visits_per_month",
    "visit_campaign_report",
    "monthly_product_revenue",
    "tuple_dump_load",
]


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_in_another_zone(spark, name):
    here = QUERIES[name](spark, BASE).collect()
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        there = QUERIES[name](spark, BASE).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(map(str, here)) == sorted(map(str, there))
