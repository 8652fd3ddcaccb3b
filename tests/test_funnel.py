import random
from collections import Counter
from decimal import Decimal

import pytest

from tallyline.operators.funnel import funnel, rates, spread_flag
from tallyline.plans import clickstream, weekly

BASE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sliced", [False, True])
def test_funnel_matches_brute_force_with_a_hot_visit(spark, sliced):
    rng = random.Random(3)
    events = [
        ("hot" if rng.random() < 0.35 else f"v{rng.randrange(60)}", rng.randrange(5), rng.choice([1, 2, 2, 3, 4]))
        for _ in range(900)
    ]
    events = [(v, p, t) for v, p, t in events if not (t == 3 and v != "hot" and int(v[1:]) % 2)]
    buyers = {v for v, _, t in events if t == 3}
    want = {}
    for v, p, t in events:
        if t in (1, 2, 3):
            c = want.setdefault(p, Counter())
            c["views"] += t == 1
            c["adds"] += t == 2
            c["abandons"] += t == 2 and v not in buyers
            c["purchases"] += t == 2 and v in buyers
    df = spark.createDataFrame(events, "visit string, page int, step int")
    got = funnel(df, ["page"], "visit", "step", 1, 2, 3, sliced).collect()
    assert {r.page: (r.n_views, r.n_adds, r.n_abandons, r.n_purchases) for r in got} == {
        p: (c["views"], c["adds"], c["abandons"], c["purchases"]) for p, c in want.items()
    }


def test_a_flag_is_spread_over_a_hot_key_in_slices(spark):
    rows = [("hot", n, n == 77) for n in range(2000)] + [(None, n, False) for n in range(40)] + [("cold", 1, None)]
    df = spark.createDataFrame(rows, "visit string, page int, flag boolean")
    spread = spread_flag(df, "visit", "flag", ["page"], "any")
    assert sorted(((r.visit or "", r.page), r.any) for r in spread.collect()) == sorted(
        ((v or "", p), {"hot": True, None: False, "cold": None}[v]) for v, p, _ in rows
    )
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "hashpartitioning(coalesce(visit" in plan and "_slice" in plan


def test_rate_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", 1, 3), ("b", 0, 0)], "k string, part int, whole int")
    got = {r.k: r.pct for r in rates(df, {"pct": ("part", "whole")}).collect()}
    assert got == {"a": Decimal("33.33"), "b": None}


def test_abandoned_and_purchased_adds_are_all_adds(spark):
    for plan in (clickstream.product_funnel, clickstream.category_funnel):
        assert plan(spark, BASE).where("n_abandons + n_purchases <> n_adds").count() == 0


def test_categories_add_up_to_products(spark):
    def sums(plan):
        return plan(spark, BASE).groupBy().sum("n_views", "n_adds", "n_abandons", "n_purchases").first()

    assert sums(clickstream.product_funnel) == sums(clickstream.category_funnel)


def test_both_visit_reports_agree(spark):
    one = clickstream.visit_campaign_report(spark, BASE)
    other = clickstream.visit_campaign_report_compact(spark, BASE)
    assert one.columns == other.columns
    assert one.exceptAll(other).count() == other.exceptAll(one).count() == 0


def test_shares_of_a_period_add_up(spark):
    for plan, key in ((weekly.platform_share_by_month, "month"), (weekly.demographic_share_by_year, "year_number")):
        for row in plan(spark, BASE).groupBy(key).sum("transactions_pct", "sales_pct").collect():
            assert all(abs(float(total) - 100) < 0.05 for total in row[1:])


def test_later_readers_of_the_funnel_do_not_read_the_events(spark):
    base = "/root/testdata/sf0.001"
    first = clickstream.funnel_table(spark, base).collect()
    later = [clickstream.funnel_ranked(spark, base), clickstream.abandon_rate(spark, base)]
    assert sorted(later[0].collect()) == sorted(first)
    for frame in later:
        assert "events.parquet" not in "".join(frame.inputFiles())


def test_rates_follow_the_events_file(spark, tmp_path):
    """The stored funnel is kept while the file stays, and built anew when it is rewritten."""
    base = str(tmp_path)
    events = spark.read.parquet(f"{BASE}/events.parquet")
    events.write.parquet(f"{base}/events.parquet")
    first = clickstream.funnel_table(spark, base)
    before = {r.page_name: r.n_views for r in first.collect()}
    assert clickstream.funnel_table(spark, base).inputFiles() == first.inputFiles()
    events.where("event_id % 2 = 0").write.mode("overwrite").parquet(f"{base}/events.parquet")
    after = {r.page_name: r.n_views for r in clickstream.funnel_table(spark, base).collect()}
    assert after == {r.page_name: r.n_views for r in clickstream.product_funnel(spark, base).collect()}
    assert sum(after.values()) < sum(before.values())
