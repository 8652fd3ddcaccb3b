import datetime as dt
import random

from pyspark.sql import functions as F

from tallyline.operators.intervals import _candidates, _cut, attribute_interval

START = dt.datetime(2024, 1, 1)


def hours(n):
    return START + dt.timedelta(hours=n)


def attribute(spark, points, intervals, seconds=86_400):
    p = spark.createDataFrame(points, "id int, at timestamp_ntz")
    i = spark.createDataFrame(intervals, "name string, s timestamp_ntz, e timestamp_ntz")
    return sorted((r.id, r.name or "") for r in attribute_interval(p, "at", i, "s", "e", seconds).collect())


def brute_force(points, intervals):
    out = []
    for pid, at in points:
        names = [name for name, s, e in intervals if s <= at <= e]
        out += [(pid, name) for name in names] or [(pid, "")]
    return sorted(out)


def test_edges_inside_a_day_are_exact_and_inclusive(spark):
    intervals = [("a", hours(10), hours(36)), ("b", hours(36), hours(36)), ("c", hours(50), hours(49))]
    points = [(1, hours(9)), (2, hours(10)), (3, hours(36)), (4, hours(37)), (5, hours(49))]
    assert attribute(spark, points, intervals) == [(1, ""), (2, "a"), (3, "a"), (3, "b"), (4, ""), (5, "")]


def test_open_ends_and_overlaps_match_a_nested_loop(spark):
    rng = random.Random(11)
    intervals = [("open", hours(300), dt.datetime(9999, 12, 31)), ("old", dt.datetime(1900, 1, 1), hours(40))]
    for i in range(25):
        s = rng.randrange(800)
        intervals.append((f"i{i}", hours(s), hours(s + rng.randrange(120))))
    # A third of the points lie on one day.
    points = [(n, hours(240 + rng.random() * 24 if n % 3 == 0 else rng.random() * 900)) for n in range(400)]
    for seconds in (86_400, 3_000, 10_000_000):
        assert attribute(spark, points, intervals, seconds) == brute_force(points, intervals)


def test_no_intervals_keeps_every_point(spark):
    assert attribute(spark, [(1, hours(1)), (2, hours(2))], []) == [(1, ""), (2, "")]


def test_no_points(spark):
    assert attribute(spark, [], [("a", hours(0), hours(9)), ("open", hours(0), dt.datetime(9999, 12, 31))], 60) == []
    nowhere = [(1, None)]
    assert attribute(spark, nowhere, [("open", hours(0), dt.datetime(9999, 12, 31))], 60) == [(1, "")]


def test_a_point_without_a_time_is_kept(spark):
    assert attribute(spark, [(1, None), (2, hours(3))], [("a", hours(0), hours(9))]) == [(1, ""), (2, "a")]


def test_candidates_stay_near_the_matches_in_a_crowded_day(spark):
    """100,000 intervals of one to three seconds in a day, with one that is open and one that lasts all day."""
    begin = F.timestamp_add("MICROSECOND", F.col("id") * 863_999, F.lit(START).cast("timestamp_ntz"))
    short = spark.range(100_000).select(begin.alias("s"), F.timestamp_add("SECOND", F.col("id") % 3 + 1, begin).alias("e"))
    long = spark.createDataFrame([(START, hours(24)), (START, dt.datetime(9999, 12, 31))], "s timestamp_ntz, e timestamp_ntz")
    intervals = short.union(long).withColumn("name", F.monotonically_increasing_id())
    at = F.timestamp_add("MILLISECOND", F.col("id") * 4_319, F.lit(START).cast("timestamp_ntz"))
    points = spark.range(20_000).select("id", at.alias("at"))
    times = points.select(F.col("at").alias("_at"))
    found = _candidates(times, _cut(intervals, "s", "e", 0)).count()
    matches = attribute_interval(points, "at", intervals, "s", "e").where("name IS NOT NULL").count()
    assert 80_000 < matches <= found < 2 * matches
    # Blocks are an eighth of an interval or a little less: at most 17 for each.
    assert _cut(intervals, "s", "e", 0).count() <= 17 * 100_002


def test_repeated_points_and_microseconds(spark):
    tick = dt.timedelta(microseconds=1)
    intervals = [("a", hours(1), hours(2)), ("b", hours(2) + tick, hours(3))]
    points = [(n, t) for n in (1, 2) for t in (hours(2), hours(2) + tick, hours(3) + tick, dt.datetime(1899, 1, 1))]
    assert attribute(spark, points, intervals, 0) == brute_force(points, intervals)
