"""Mined negatives against all inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import hard_negatives
from tallyline.llm.queries import op13_hard_negatives

SCHEMA = "vec_id bigint, label int, vector array<bigint>, anchor boolean"
COLUMNS = "anchor_id positive_id rank negative_id positive_score negative_score".split()


def brute_force(rows, positives=5, negatives=5):
    """``rows``: (id, label, whole numbers, anchor)."""
    kept = {}
    for i, label, vector, anchor in rows:
        if i is not None and label is not None and vector is not None and None not in vector:
            kept[i] = min(kept.get(i, (label, vector, anchor)), (label, vector, anchor))
    out = []
    for a, (label, vector, anchor) in kept.items():
        if not anchor:
            continue
        scored = [
            (-sum(x * y for x, y in zip(v, vector)), i, own == label)
            for i, (own, v, _) in kept.items()
            if len(v) == len(vector)
        ]
        scored.sort()
        near = [(-s, i) for s, i, same in scored if same and i != a][:positives]
        for score, p in near:
            inside = [(-s, i) for s, i, same in scored if not same and 80 * score <= -100 * s <= 100 * score]
            out += [(a, p, k, i, score, s) for k, (s, i) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r[c] for c in COLUMNS) for r in hard_negatives.hard_negatives(df, **options).collect())


def clustered(n, dim, rng, spread):
    middle = rng.integers(-200, 200, (12, dim))
    return [
        (i, int(rng.integers(4)), (middle[rng.integers(12)] + rng.integers(-spread, spread + 1, dim)).tolist(), i % 9 == 0)
        for i in range(n)
    ]


@pytest.mark.parametrize(("block", "cells", "spread"), [(2048, 1024, 60), (16, 7, 60), (2048, 5, 0), (64, 1, 400)])
def test_pairs(spark, monkeypatch, block, cells, spread):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    rows = clustered(400, 6, np.random.default_rng(spread + block), spread)
    assert mined(spark.createDataFrame(rows, SCHEMA), most_cells=cells) == brute_force(rows) != []


def test_small_sample_and_few_wanted(spark):
    rows = clustered(200, 3, np.random.default_rng(8), 90)
    got = mined(spark.createDataFrame(rows, SCHEMA), sample=4, positives=2, negatives=1)
    assert got == brute_force(rows, 2, 1)


def test_nulls_ties_repeats_lengths_and_more_columns(spark):
    rows = [(0, 1, [3, 4], True), (None, 1, [3, 4], True), (1, None, [3, 4], True), (2, 1, None, True)]
    rows += [(3, 1, [3, None], True), (4, 1, [], True), (5, 2, [], False), (6, 1, [1, 1, 1], True), (7, 2, [1, 1, 1], False)]
    rows += [(i, i % 2, [3, 4], False) for i in range(10, 40)] + [(i, 2, [0, 0], True) for i in (50, 51)]
    rows += [(60, 1, [3, 4], None), (60, 1, [3, 4], None), (60, 2, [3, 4], None), (70, 3, [-3, -4], True)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "score": F.lit(1), "cell": F.lit(2)})
    expected = brute_force([(i, n, v, bool(a)) for i, n, v, a in rows])
    assert mined(df) == expected
    # The one vector of length three is no candidate of those of length two, nor in the sample's cells.
    assert mined(df, sample=2) == expected


def test_copies_keep_the_smallest_keys(spark):
    rows = [(i, 0, [5, 5], i == 0) for i in range(3000)] + [(i, 1, [5, 5], False) for i in range(3000, 6000)]
    got = mined(spark.createDataFrame(rows, SCHEMA))
    assert got == [(0, p, k, 2999 + k, 50, 50) for p in range(1, 6) for k in range(1, 6)]


def test_empty_table_and_no_anchors(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(1, 1, [1], False), (2, 2, [1], False)], SCHEMA)) == []


def test_large_whole_numbers(spark):
    big = 3_000_000_000
    rows = [(0, 0, [big, 1], True), (1, 0, [big, 1], False), (2, 1, [big, 0], False), (3, 1, [big, 2], False)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute_force(rows) != []


def test_tree_covers_and_separates():
    rng = np.random.default_rng(4)
    points = hard_negatives.augmented(rng.integers(-50, 50, (300, 4)), 120.0)
    assert np.allclose((points**2).sum(1), 1)
    tree = hard_negatives.CoverTree(points, np.arange(300))
    below = {}
    for node in reversed(range(len(tree.center))):
        parts = tree.children[node]
        below[node] = tree.members[node] if parts is None else np.concatenate([below[c] for c in parts])
        angles = np.arccos(np.clip(points[below[node]] @ points[tree.center[node]], -1, 1))
        assert angles.max() <= tree.radius[node] + 1e-7
        if parts is not None:
            cosines = tree.centers[parts] @ tree.centers[parts].T
            np.fill_diagonal(cosines, -1)
            assert cosines.max() <= math.cos(hard_negatives.SHRINK * tree.radius[node]) + 1e-9
            assert (tree.radii[parts] <= hard_negatives.SHRINK * tree.radius[node] + 1e-7).all()
    assert sorted(below[0].tolist()) == list(range(300))


def test_query(spark, sf_dir):
    rows = []
    for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect():
        i, vector, label = r["vec_id"], r["embedding"], r["label"]
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        moved = (label + 1) % 10 if i % 7 == 0 else label
        rows.append((i, moved, [math.floor(256 * x) for x in vector], i % 100 == 0))
    got = sorted(tuple(r[c] for c in COLUMNS) for r in op13_hard_negatives(spark, sf_dir).collect())
    assert got == brute_force(rows)
