import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyline.operators.lists import explode_list, name_list, named_elements, net_list, signed_tally, zip_lists

NAMES = [(1, "pear"), (2, "apple"), (3, "fig"), (10, "date"), (11, "lime")]


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame(NAMES, "id int, label string")


def test_explode_skips_null_and_empty_lists(spark):
    df = spark.createDataFrame([(1, "1, 5"), (2, None), (3, ""), (4, "7,7, x")], "k int, l string")
    assert sorted(map(tuple, explode_list(df, "l", "i").collect())) == [(1, 1), (1, 5), (4, 7), (4, 7)]


def test_lockstep_pads_the_shorter_list(spark):
    df = spark.createDataFrame([(1, "1, 2, 3", "9"), (2, None, "4"), (3, None, None)], "k int, a string, b string")
    got = {tuple(r) for r in zip_lists(df, "a", "b", "x", "y").collect()}
    assert got == {(1, 1, 9), (1, 2, None), (1, 3, None), (2, None, 4)}


def test_two_roles_of_one_dimension(spark, names):
    pairs = spark.createDataFrame([(1, 10), (2, None), (99, 3)], "x bigint, y bigint")
    for role in ("x", "y"):
        pairs = named_elements(pairs, role, names.withColumnRenamed("label", f"{role}_label"), "id")
    got = {(r.x_label, r.y_label) for r in pairs.collect()}
    assert got == {("pear", "date"), ("apple", None), (None, "fig")}


def test_names_keep_list_order(spark, names):
    df = spark.createDataFrame([(1, "10, 1"), (2, None), (3, "3"), (4, "77"), (5, "2, 77, 1")], "k int, l string")
    got = {r.k: r.out for r in name_list(df, "l", names, "id", "label", "out").collect()}
    assert got == {1: "date, pear", 2: None, 3: "fig", 4: None, 5: "apple, pear"}


def _random_lines(n, hot_share):
    rng = random.Random(7)

    def ids():
        picked = rng.choices([1, 2, 3, 10, 11, 99], k=rng.randrange(4))
        return ", ".join(map(str, picked)) or None

    return [
        (0 if rng.random() < hot_share else rng.randrange(20), rng.choice("AB"), ids(), ids()) for _ in range(n)
    ]


BASES = {"A": "1, 2, 10", "B": "3, 3"}


def _brute_force(lines):
    tallies = {}
    for order, item, removed, added in lines:
        tally = tallies.setdefault((order, item), Counter())
        tally.update(map(int, BASES[item].split(", ")))
        tally.update(int(i) for i in (added or "").split(", ") if i)
        tally.subtract(int(i) for i in (removed or "").split(", ") if i)
    return tallies


@pytest.fixture(scope="module")
def lines(spark):
    rows = _random_lines(600, 0.4)
    return rows, spark.createDataFrame(rows, "o int, item string, removed string, added string")


@pytest.fixture(scope="module")
def bases(spark):
    return spark.createDataFrame(list(BASES.items()), "item string, base string")


def test_tally_matches_brute_force(lines, bases):
    rows, df = lines
    got = signed_tally(df.join(bases, "item"), ["o", "item"], "e", "base", "removed", "added").collect()
    want = _brute_force(rows)
    assert {(r.o, r.item, r.e): r.net for r in got} == {
        (o, item, e): n for (o, item), tally in want.items() for e, n in tally.items()
    }


def test_tally_of_counted_lines_equals_tally_of_lines(lines, bases):
    _, df = lines
    keys = ["item", "removed", "added"]
    alike = df.groupBy(*keys).agg(F.count("*").alias("n")).join(bases, "item")
    one_by_one = signed_tally(df.join(bases, "item"), [], "e", "base", "removed", "added")
    counted = signed_tally(alike, [], "e", "base", "removed", "added", weight="n")
    assert {tuple(r) for r in one_by_one.collect()} == {tuple(r) for r in counted.collect()}


def test_net_list_matches_brute_force(lines, bases, names):
    rows, df = lines
    got = net_list(
        df, ["o", "item"], "removed", "added", bases, "item", "base", names, "id", "label", "text"
    ).collect()
    want = {}
    for key, tally in _brute_force(rows).items():
        shown = [(label, tally[i]) for i, label in sorted(NAMES, key=lambda p: p[1]) if tally[i] > 0]
        if shown:
            want[key] = ", ".join(label if n == 1 else f"{n}x{label}" for label, n in shown)
    assert {(r.o, r.item): r.text for r in got} == want


def test_net_list_in_parts_gives_the_same_rows(lines, bases, names):
    _, df = lines
    twice = bases.unionByName(bases).unionByName(bases.sparkSession.createDataFrame([("A", "11")], bases.schema))
    odd = df.unionByName(df.limit(9).withColumn("item", F.lit(None).cast("string"))).unionByName(
        df.limit(5).withColumn("item", F.lit("C"))
    )
    for base in (bases, twice):
        whole, dealt = (
            net_list(
                odd, ["o", "item"], "removed", "added", base, "item", "base", names, "id", "label", "text", parts=parts
            )
            for parts in (None, 7)
        )
        assert sorted(map(str, dealt.collect())) == sorted(map(str, whole.collect()))


def test_repeated_ids_and_names_that_are_null(spark, bases):
    odd = spark.createDataFrame([(1, "a"), (1, "a2"), (2, "b"), (10, None)], "id int, label string")
    df = spark.createDataFrame([("A", None, "2"), ("A", "10", None)], "item string, removed string, added string")
    got = net_list(df, ["item"], "removed", "added", bases, "item", "base", odd, "id", "label", "text").collect()
    assert [r.text for r in got] == ["2xa, 2xa2, 3xb"]
    named = spark.createDataFrame([(1, "1, 2"), (2, "10")], "k int, l string")
    got = {r.k: r.out for r in name_list(named, "l", odd, "id", "label", "out").collect()}
    assert got == {1: "a, a2, b", 2: None}


def test_a_dimension_of_two_thousand_names(spark, bases):
    many = spark.createDataFrame([(i, f"n{i:04}") for i in range(2000)], "id int, label string")
    df = spark.createDataFrame([("A", "10", "1999, 7, 7")], "item string, removed string, added string")
    got = net_list(df, ["item"], "removed", "added", bases, "item", "base", many, "id", "label", "text").first()
    assert got.text == "n0001, n0002, 2xn0007, n1999"
    assert name_list(df, "added", many, "id", "label", "out").first().out == "n1999, n0007, n0007"


def test_rows_without_a_list_do_not_share_a_join_key(spark, names):
    df = spark.createDataFrame([(k, None) for k in range(100)], "k int, l string")
    plan = name_list(df, "l", names, "id", "label", "out")
    assert plan.where("out IS NULL").count() == 100
    assert "xxhash64" in plan._jdf.queryExecution().optimizedPlan().toString()
