import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallyline.functions import (
    concat_nulls_as_empty,
    dow_sunday_zero,
    list_ids,
    list_length,
    minutes_between,
    parse_date_text,
    ratio,
    year_month,
)
from tallyline.operators.cleaning import band_by_pattern, null_sentinels, overwrite_where, retype, strip_units
from tallyline.plans import frames


def column(df, name):
    return [row[name] for row in df.collect()]


def test_sentinels_are_exact_and_per_column(spark):
    df = spark.createDataFrame(
        [("", ""), ("null", "null"), (None, None), ("NULL", " "), ("4", "7")], "a string, b string"
    ).coalesce(1)
    cleaned = null_sentinels(df, {"a": ["", "null"], "b": ["null"]})
    assert column(cleaned, "a") == [None, None, None, "NULL", "4"]
    assert column(cleaned, "b") == ["", None, None, " ", "7"]


def test_units_in_every_spelling(spark):
    texts = ["20km", "23.4 km", "10", " 7 km ", "km", "", None, "12 miles", "-3km", "1.2.3km"]
    df = spark.createDataFrame([(t,) for t in texts], "d string").coalesce(1)
    got = column(strip_units(df, "d", ["km"], "decimal(10,1)"), "d")
    numbers = ["20.0", "23.4", "10.0", "7.0", None, None, None, None, "-3.0", None]
    assert got == [None if n is None else Decimal(n) for n in numbers]

    texts = ["32 minutes", "25mins", "15 minute", "10minutes", "40"]
    df = spark.createDataFrame([(t,) for t in texts], "d string").coalesce(1)
    got = column(strip_units(df, "d", ["minutes", "mins", "minute"], "decimal(10,1)"), "d")
    assert got == [Decimal(n) for n in ("32.0", "25.0", "15.0", "10.0", "40.0")]


def test_date_text(spark):
    texts = ["31/8/20", "01/09/18", "4/3/96", "1/1/69", "1/1/70", "29/2/96", "29/2/97", "31/13/20", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = column(df.select(parse_date_text(F.col("t")).alias("d")), "d")
    assert got == [
        dt.date(2020, 8, 31),
        dt.date(2018, 9, 1),
        dt.date(1996, 3, 4),
        dt.date(2069, 1, 1),
        dt.date(1970, 1, 1),
        dt.date(1996, 2, 29),
        None,
        None,
        None,
        None,
    ]


def test_bands(spark):
    df = spark.createDataFrame([("C1",), ("F3",), ("F4",), ("X9",), (None,)], "s string").coalesce(1)
    bands = {"%1": "one", "%3": "late", "%4": "late"}
    got = column(df.select(band_by_pattern(F.col("s"), bands, "other").alias("b")), "b")
    assert got == ["one", "late", "late", "other", "other"]


def test_overwrite_leaves_null_conditions_alone(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string").coalesce(1)
    assert column(overwrite_where(df, "v", F.col("k") > 2, F.lit("z")), "v") == ["a", "b", "z"]


def test_retype_gives_null_for_bad_values(spark):
    df = spark.createDataFrame([("1.25",), ("x",)], "v string").coalesce(1)
    assert column(retype(df, {"v": "decimal(10,1)"}), "v") == [Decimal("1.3"), None]


def test_list_functions(spark):
    df = spark.createDataFrame([("1, 5",), ("7",), ("",), (None,), ("2,,x, 10",)], "l string").coalesce(1)
    assert column(df.select(list_ids(F.col("l")).alias("i")), "i") == [
        [1, 5],
        [7],
        [None],
        None,
        [2, None, None, 10],
    ]
    assert column(df.select(list_length(F.col("l")).alias("n")), "n") == [2, 1, 0, 0, 2]


def test_ratio_rounds_half_up_last_and_survives_zero(spark):
    df = spark.createDataFrame([(1, 8), (285, 1000), (5, 0), (None, 3)], "a int, b int").coalesce(1)
    assert column(df.select(ratio(F.col("a"), F.col("b"), 2).alias("r")), "r") == [
        Decimal("0.13"),
        Decimal("0.29"),
        None,
        None,
    ]
    assert column(df.select(ratio(F.col("a"), F.col("b"), 1, 100).alias("r")), "r")[:2] == [
        Decimal("12.5"),
        Decimal("28.5"),
    ]


def test_minutes_cross_midnight(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2020, 1, 2, 23, 51, 23), dt.datetime(2020, 1, 3, 0, 12, 37))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    row = df.select(
        minutes_between(F.col("a"), F.col("b")).alias("up"), minutes_between(F.col("b"), F.col("a")).alias("down")
    ).first()
    assert (row.up, row.down) == (Decimal("21.23"), Decimal("-21.23"))


def test_small_date_and_text_functions(spark):
    df = spark.createDataFrame([(dt.date(1998, 6, 14), "a", None)], "d date, x string, y string")
    row = df.select(
        dow_sunday_zero(F.col("d")).alias("dow"),
        year_month(F.col("d")).alias("ym"),
        concat_nulls_as_empty(F.col("x"), F.col("y"), F.col("x"), sep="|").alias("c"),
    ).first()
    assert (row.dow, row.ym, row.c) == (0, "1998-06", "a||a")


def test_cleaning_brings_back_the_rendered_numbers(spark):
    base = "/root/testdata/sf0.001"
    key = F.col("delivery_order")
    wrong = frames.deliveries(spark, base).where(
        F.when(
            key % 4 == 3,
            F.col("distance").isNotNull()
            | F.col("duration").isNotNull()
            | F.col("pickup_time").isNotNull()
            | (F.col("cancellation") != "Cancelled"),
        ).otherwise(
            (F.col("distance") * 10 != key % 250 + 10)
            | (F.col("duration") != key % 31 + 10)
            | F.col("pickup_time").isNull()
            | F.col("cancellation").isNotNull()
        )
    )
    assert wrong.count() == 0
