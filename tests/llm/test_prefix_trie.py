"""Nodes against a trie of plain dictionaries."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import prefix_trie
from tallyline.llm.queries import op12_prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute_force(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    nodes, ends = {}, {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(turns.get(c - c % 100, [])[:h] + mine[h:])
        ends.setdefault(whole, []).append(c)
        for d in range(len(whole) + 1):
            nodes.setdefault(whole[:d], []).append(c)
    children, leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for node in sorted(nodes, key=len, reverse=True):
        leaves[node] += children[node] == 0
        if node:
            saved[node] += (len(nodes[node]) - 1) * len(node[-1][1])
            up = node[:-1]
            children[up] += 1
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    out = []
    for node, members in nodes.items():
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        parent = min(nodes[node[:-1]]) if node else None
        out.append((min(members), len(node), parent, len(members), children[node], leaves[node], saved[node], digest))
    return sorted(out, key=str)


def nodes_of(df, **options):
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.prefix_trie(df, **options).collect()), key=str)


def few_texts(n, longest, seed):
    """Conversations over few different turns, so that prefixes are shared at every depth."""
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rnd.randint(1, longest)):
            rows.append((c, turn, rnd.choice(["user", "assistant"]), rnd.choice(["", "a", "bb", "ü🙂"])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("stretch", "batch"), [(512, 10_000), (2, 10_000), (3, 7), (512, 1)])
def test_nodes(spark, stretch, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        rows = few_texts(300, 9, 5)
        # Copies of one conversation, and one that ends where others go on.
        rows += [(c, t, "user", "bb") for c in range(1000, 1060) for t in range(c % 7)]
        assert nodes_of(spark.createDataFrame(rows, SCHEMA), stretch=stretch) == brute_force(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nulls_repeats_missing_first_conversations_and_more_columns(spark):
    rows = [(None, 1, "user", "x"), (205, None, None, None), (205, 1, "user", None), (205, 1, "user", None)]
    rows += [(301, 0, "user", "only turn"), (302, 0, "user", "only turn"), (300, 2, None, "a"), (300, None, "b", "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    more = df.select("*", F.lit(1).alias("id"), F.lit("p").alias("p1"), F.lit(2).alias("depth"), F.lit(3).alias("n"))
    assert nodes_of(more) == brute_force(rows)


def test_only_turnless_conversations(spark):
    short = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 5][:3]
    rows = [(c, 0, "user", "x") for c in short]
    assert nodes_of(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows)
    assert len(brute_force(rows)) == 1


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_long_conversation_and_a_very_long_text(spark):
    rows = [(7, t, "user", str(t % 3)) for t in range(1500)] + [(8, t, "user", str(t % 3)) for t in range(1400)]
    rows += [(9, 0, "user", "y" * 2_000_000)]
    assert nodes_of(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows)


def test_extents_by_range_minima():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 5, 100)
    minima = prefix_trie.Minima(values)
    row, depth = rng.integers(3, 97, 500), rng.integers(1, 6, 500)
    left, right = minima.left(row, depth, 3), minima.right(row, depth, 97)
    for r, d, low, high in zip(row, depth, left, right):
        a = b = r
        while a - 1 >= 3 and values[a] >= d:
            a -= 1
        while b + 1 < 97 and values[b + 1] >= d:
            b += 1
        assert (low, high) == (a, b)
    first = rng.integers(0, 100, 300)
    last = np.minimum(99, first + rng.integers(0, 60, 300))
    assert minima.least(first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last)]


def test_query(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    got = sorted((tuple(r[c] for c in COLUMNS) for r in op12_prefix_trie(spark, sf_dir).collect()), key=str)
    assert got == brute_force([tuple(r) for r in table.collect()])
