import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyline.operators.distribution import count_where, exact_percentiles, mean_where, one_row
from tallyline.plans import transactions

PS = {"p0": "0", "p10": "0.1", "p25": "0.25", "p50": "0.5", "p70": "0.7", "p100": "1"}


def brute_force(values):
    ordered = sorted(v for v in values if v is not None)
    if not ordered:
        return dict.fromkeys(PS)
    return {
        out: ordered[max(math.ceil(Fraction(p) * len(ordered)), 1) - 1] for out, p in PS.items()
    }


def check(spark, values, type_name):
    df = spark.createDataFrame([(v,) for v in values], f"v {type_name}").repartition(5)
    assert exact_percentiles(df, "v", PS).first().asDict() == brute_force(values)


def test_decimals_of_both_signs_with_nulls(spark):
    rng = random.Random(1)
    values = [Decimal(rng.randrange(-10**9, 10**9)) / 100 for _ in range(500)] + [None] * 40
    check(spark, values, "decimal(18,2)")


def test_a_third_of_the_values_equal(spark):
    rng = random.Random(2)
    check(spark, [7 if n % 3 == 0 else rng.randrange(10) for n in range(333)], "int")


def test_heavy_tail_and_tight_cluster(spark):
    cluster = [Decimal(5_000_000_000_000_000 + n) / 100 for n in range(300)]
    tail = [Decimal(10) ** n for n in range(15)]
    check(spark, cluster + tail, "decimal(18,2)")


def test_decimals_wider_than_a_long(spark):
    rng = random.Random(5)
    values = [Decimal(rng.randrange(-10**20, 10**20)) / 10**4 for _ in range(200)]
    values += [Decimal("-0.0001"), Decimal("0.0001"), Decimal("7.1234"), Decimal("7.1235")] * 9
    check(spark, values, "decimal(20,4)")
    check(spark, [Decimal("7.1234"), Decimal("7.1235"), Decimal("7.0000")] * 40, "decimal(23,5)")


def test_extreme_longs(spark):
    check(spark, [-(2**63), -(2**63) + 1, -1, 0, 1, 2**63 - 1, 2**63 - 2], "bigint")


def test_ten_values_and_seven_tenths(spark):
    """0.7 * 10 is above 7 in binary floating point; the rank must be 7 all the same."""
    check(spark, list(range(1, 11)), "int")


def test_single_value_and_none(spark):
    check(spark, [4], "smallint")
    check(spark, [None, None], "int")


@pytest.mark.parametrize("type_name", ["double", "decimal(38,2)", "decimal(20,8)"])
def test_types_without_a_whole_sort_key_are_refused(spark, type_name):
    with pytest.raises(TypeError):
        exact_percentiles(spark.range(1).select(F.col("id").cast(type_name).alias("v")), "v", PS)


def test_equals_the_builtin_on_order_totals(spark):
    totals = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select(
        F.col("o_totalprice").cast("decimal(18,2)").alias("v")
    )
    quartiles = {"a": "0.25", "b": "0.5", "c": "0.75"}
    builtin = totals.agg(
        *[
            F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY v)").cast("decimal(18,2)").alias(out)
            for out, p in quartiles.items()
        ]
    )
    assert exact_percentiles(totals, "v", quartiles).first() == builtin.first()


def test_three_reads_for_the_range_of_the_data(spark):
    """One job for the smallest and largest value, and a plan that scans once per level."""
    totals = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        F.col("o_totalprice").cast("decimal(18,2)").alias("v")
    )
    plan = exact_percentiles(totals, "v", PS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2


def test_ranges_that_need_one_level_or_more(spark):
    check(spark, [10**15 + n for n in (5, 3, 3, 9)], "bigint")
    check(spark, [-(2**50), 2**50, 7, 7, 8], "bigint")


def test_conditional_summary(spark):
    df = spark.createDataFrame([(1, Decimal("10.00")), (1, Decimal("5.00")), (0, None)], "m int, v decimal(9,2)")
    row = df.agg(
        count_where(F.col("m") == 1).alias("n"),
        mean_where(F.col("v"), F.col("m") == 1, 2).alias("yes"),
        mean_where(F.col("v"), F.col("m") == 0, 2).alias("no"),
    ).first()
    assert (row.n, row.yes, row.no) == (2, Decimal("7.50"), None)


def test_one_row_side_by_side(spark):
    a = spark.createDataFrame([(1, None)], "x int, y string")
    b = spark.createDataFrame([("z",)], "w string")
    assert one_row(a, b).first().asDict() == {"x": 1, "y": None, "w": "z"}


def test_percentiles_rise_and_members_split_the_baskets(spark):
    row = transactions.member_vs_nonmember_revenue(spark, "/root/testdata/sf0.001").first()
    assert row.revenue_p25 <= row.revenue_p50 <= row.revenue_p75
    members = float(row.member_pct) / 100
    mean = members * float(row.avg_member_revenue) + (1 - members) * float(row.avg_nonmember_revenue)
    total = transactions.baskets(spark, "/root/testdata/sf0.001", False).agg(F.avg("revenue")).first()[0]
    assert abs(mean / float(total) - 1) < 1e-3
