import datetime as dt

from pyspark.sql import functions as F

from tallyline.functions import parse_time_text

SPELLINGS = {
    "2020-01-01 18:15:34": dt.datetime(2020, 1, 1, 18, 15, 34),
    "2020/1/1 18:15": dt.datetime(2020, 1, 1, 18, 15),
    "2020.01.01T8.5.3": dt.datetime(2020, 1, 1, 8, 5, 3),
    "20200101 181534": dt.datetime(2020, 1, 1, 18, 15, 34),
    "20200101181534": dt.datetime(2020, 1, 1, 18, 15, 34),
    " 2020-01-31 ": dt.datetime(2020, 1, 31),
    "2020-01-01, 18:15:34.25": dt.datetime(2020, 1, 1, 18, 15, 34, 250_000),
    "2020-01-01 18:15:34,1234567": dt.datetime(2020, 1, 1, 18, 15, 34, 123_456),
    "2020-02-29T23:59:59Z": dt.datetime(2020, 2, 29, 23, 59, 59),
    "2021-02-29 00:00:00": None,
    "2020-13-01 00:00:00": None,
    "2020-01-01 24:10:00": None,
    "2020-01-01 18:61:00": None,
    "01-02-2020 10:00": None,
    "2020-01": None,
    "soon": None,
    "": None,
    None: None,
}


def test_spellings_of_a_time(spark):
    df = spark.createDataFrame([(s,) for s in SPELLINGS], "s string")
    got = {r.s: r.t for r in df.select("s", parse_time_text(F.col("s")).alias("t")).collect()}
    assert got == SPELLINGS
