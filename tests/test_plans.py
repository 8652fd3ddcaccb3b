"""What the physical plans must and must not hold, with every table taken for too large to broadcast."""

import re

import pytest

from tallyline.plans import clickstream, delivery, ingredients, loyalty, transactions, weekly
from tallyline.plans.registry import PLANS
from tallyline.sources import tables

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plan_of(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield lambda plan: plan(spark, BASE)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_plan_needs_one_task_for_everything(plan_of, name):
    plan = plan_of(PLANS[name])
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    assert not re.search(r"EvalPython|InPandas|InArrow|ExistingRDD", plan)
    for window in re.findall(r"Window(?:GroupLimit)? \[.*", plan):
        assert not re.search(r"\], \[\], ", window), window
    for single in re.findall(r"Exchange SinglePartition.*\n.*", plan):
        assert "Aggregate" in single, single


def test_season_reaches_the_scan(plan_of):
    plan = plan_of(weekly.before_after_4w)
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(l_shipdate,1998-05-18", plan)
    assert re.search(r"l_shipdate\S* < 1998-07-13", plan)
    assert plan.count("FileScan") == 1


def test_two_seasons_reach_the_scan_as_one_filter(spark, plan_of):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(weekly.before_after_two_changes)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: .*", plan).group()
    assert plan.count("FileScan") == 1 and "Or(" in pushed
    for day in ("1996-02-12", "1998-05-18"):
        assert f"GreaterThanOrEqual(l_shipdate,{day}" in pushed, pushed


def test_event_type_reaches_the_scan(plan_of):
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,signup)]" in plan_of(
        clickstream.signups_per_week
    )


@pytest.mark.parametrize(
    "plan, columns",
    [
        (transactions.unique_transactions, "l_orderkey:bigint"),
        (loyalty.most_purchased_item, "l_partkey:bigint"),
        (clickstream.distinct_users, "user_id:bigint"),
        (weekly.distinct_weekdays, "l_shipdate:timestamp_ntz"),
        (delivery.ordered_item_count, "l_partkey:bigint"),
    ],
)
def test_scans_read_only_what_is_used(plan_of, plan, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan_of(plan))
    # distinct_users also reads the time stamp, which the cookie of a user is made of.
    assert columns in schemas[0] and len(schemas[0].split(",")) <= 2


def test_first_rows_are_cut_before_the_shuffle(plan_of):
    plan = plan_of(loyalty.first_item_per_customer)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_lines_are_combined_per_order_before_the_order_join(plan_of):
    plan = plan_of(delivery.volume_by_hour)
    join = plan.index("SortMergeJoin")
    assert plan.index("partial_count(1)", join) > join
    assert plan.count("Exchange hashpartitioning(order_id") == 1


def test_funnel_reads_the_events_once(plan_of):
    assert plan_of(clickstream.product_funnel).count("FileScan") == 1


def test_shares_reuse_the_exchange_of_their_totals(plan_of):
    plan = plan_of(weekly.platform_share_by_month)
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_percentiles_broadcast_only_the_found_prefixes(plan_of):
    plan = plan_of(transactions.revenue_percentiles)
    assert "percentile" not in plan.lower()
    for exchange in re.findall(r"BroadcastExchange.*\n.*", plan):
        assert "rank" in exchange, exchange


@pytest.mark.parametrize(
    "plan",
    [
        ingredients.order_item_label,
        ingredients.order_ingredient_list,
        ingredients.ingredients_per_item,
        ingredients.paired_changes,
        ingredients.ingredient_usage_total,
        ingredients.revenue_with_extras,
    ],
)
def test_building_a_list_query_starts_no_job(spark, plan):
    group = f"build-{plan.__name__}"
    spark.sparkContext.setJobGroup(group, group)
    plan(spark, BASE)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)


@pytest.mark.parametrize(
    "plan, dealt", [(ingredients.order_ingredient_list, 2), (lambda s, b: transactions.baskets(s, b, True), 2)]
)
def test_groups_are_dealt_into_parts_by_the_size_of_the_table(spark, plan, dealt, monkeypatch):
    """Not by a partition count of the session, whose tasks would grow with the table."""
    monkeypatch.setattr(tables, "PART_BYTES", 1000)
    parts = tables.parts_of(spark, BASE, "lineitem")
    assert parts > 50
    text = plan(spark, BASE)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(rf"hashpartitioning\([^)]*, {parts}\), REPARTITION_BY_NUM", text)) == dealt, text
    # The elements of lists are not dealt out once more per key.
    assert not re.search(r"hashpartitioning\(order_id[^)]*_element", text)


def test_parts_follow_the_size_of_the_files(spark, tmp_path, monkeypatch):
    spark.range(50_000).write.parquet(str(tmp_path / "t.parquet"))
    size = sum(f.stat().st_size for f in (tmp_path / "t.parquet").iterdir() if not f.name.startswith("."))
    assert tables.parts_of(spark, str(tmp_path), "t") == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(tables, "PART_BYTES", size // 40)
    assert tables.parts_of(spark, str(tmp_path), "t") >= 40
