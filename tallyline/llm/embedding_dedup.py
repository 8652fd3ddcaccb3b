"""Embedding near-duplicates by an inverted multi-index.

Two codebooks, one for each half of a vector, make a grid of cells. A vector lies in the cell of its two
nearest centroids, and a link partner may lie in a cell near by. Cells are visited in the order of their
distance from the vector, by a multi-sequence traversal of the two halves' sorted distances, up to the limit
that reaches the target recall; the vectors found are verified by exact cosine.

The distance of a vector from a cell is how far it must move to get there: per half, the largest distance to
a plane between the cell's centroid and another one. The limit is measured when the codebooks are fitted.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.components import connected_components
from tallyline.llm.linking import forest
from tallyline.sources.sinks import materialise

THRESHOLD = 0.98
TARGET_RECALL = 0.999
# The codebooks are fitted on at most so many vectors; every vector is indexed.
SAMPLE = 20_000
MOST_CENTROIDS = 256
# Vectors of a cell compared in one task with as many that visit it; a cell with more is cut into blocks.
BLOCK = 1024


@dataclass
class Index:
    """Codebooks of the two halves and the limit of the traversal, for vectors of one length."""

    halves: tuple[np.ndarray, np.ndarray]
    limit: float

    def distances(self, vectors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per half: distance of each vector from each centroid's region, and the nearest centroid."""
        cut = vectors.shape[1] // 2
        far, nearest = [], []
        for part, centroids in zip((vectors[:, :cut], vectors[:, cut:]), self.halves):
            square = (part**2).sum(1)[:, None] - 2 * part @ centroids.T + (centroids**2).sum(1)
            apart = np.sqrt(((centroids[:, None] - centroids[None]) ** 2).sum(2))
            np.fill_diagonal(apart, np.inf)
            out = np.zeros_like(square)
            for other in range(len(centroids)):
                np.maximum(out, (square - square[:, [other]]) / (2 * np.maximum(apart[:, other], 1e-12)), out=out)
            far.append(out**2)
            nearest.append(square.argmin(1))
        return far, nearest


def nearest_cells(first: np.ndarray, second: np.ndarray, limit: float) -> Iterator[tuple[int, int]]:
    """Cells in ascending order of ``first[i] + second[j]``, up to ``limit``."""
    order1, order2 = first.argsort(kind="stable"), second.argsort(kind="stable")
    near1, near2 = first[order1].tolist(), second[order2].tolist()
    heap = [(near1[0] + near2[0], 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > limit:
            return
        yield int(order1[i]), int(order2[j])
        if j + 1 < len(near2):
            heapq.heappush(heap, (near1[i] + near2[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(near1):
            heapq.heappush(heap, (near1[i + 1] + near2[0], i + 1, 0))


def _centroids(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    points = np.unique(points, axis=0)
    centroids = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(12):
        nearest = ((centroids**2).sum(1) - 2 * points @ centroids.T).argmin(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centroids))
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    return np.unique(centroids, axis=0)


def fit(sample: np.ndarray, centroids: int, threshold: float, recall: float) -> Index:
    """Codebooks from unit vectors, and the limit by which ``recall`` of partners at ``threshold`` are reached.

    The limit is a quantile over partners made for the sample: each vector turned by the largest angle that
    still links, in a random direction.
    """
    rng = np.random.default_rng(7)
    cut = sample.shape[1] // 2
    index = Index((_centroids(sample[:, :cut], centroids, rng), _centroids(sample[:, cut:], centroids, rng)), 0.0)
    turn = rng.normal(size=sample.shape)
    turn -= (turn * sample).sum(1, keepdims=True) * sample
    turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-12)
    partner = threshold * sample + np.sqrt(1 - threshold**2) * turn
    (far1, far2), _ = index.distances(sample)
    _, (cell1, cell2) = index.distances(partner)
    row = np.arange(len(sample))
    index.limit = float(np.quantile(far1[row, cell1] + far2[row, cell2], recall)) + 1e-12
    return index


def _unit(column: pa.Array) -> np.ndarray:
    lists = column.to_numpy(zero_copy_only=False)
    vectors = np.stack(lists).astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _placed(index: dict[int, Index]):
    """Rows (class, label, vector) to one row for the own cell and one for each visited cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                dims = pc.list_value_length(batch.column("vector")).to_numpy()
                for dim in np.unique(dims).tolist():
                    part = batch.filter(pa.array(dims == dim))
                    rows, cells, own = [], [], []
                    if dim in index:
                        known = index[dim]
                        (far1, far2), (cell1, cell2) = known.distances(_unit(part.column("vector")))
                        width = len(known.halves[1])
                        for r in range(part.num_rows):
                            home = int(cell1[r]) * width + int(cell2[r])
                            visits = [i * width + j for i, j in nearest_cells(far1[r], far2[r], known.limit)]
                            rows += [r] * (len(visits) + 1)
                            cells += [home, *visits]
                            own += [True] + [False] * len(visits)
                    else:  # a length that the sample does not hold has one cell for all
                        rows = [r for r in range(part.num_rows) for _ in range(2)]
                        cells, own = [0] * len(rows), [True, False] * part.num_rows
                    out = part.take(pa.array(rows, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [*out.columns, pa.array(cells, pa.int32()), pa.array([dim] * len(rows), pa.int32()), pa.array(own)],
                        names=[*out.schema.names, "cell", "dim", "own"],
                    )

    return run


def _compare(threshold: float):
    """One task's rows to (class, links found, a class it is connected with)."""

    def run(table: pa.Table) -> pa.Table:
        own = table.column("own").to_numpy(zero_copy_only=False).astype(bool)
        classes = table.column("class").to_numpy()
        copies = table.column("copies").to_numpy()
        if own.all() or not own.any():
            return pa.table({"class": classes[:0], "links": copies[:0], "root": classes[:0]})
        vectors = _unit(table.column("vector").combine_chunks())
        base, query = np.flatnonzero(own), np.flatnonzero(~own)
        hit = vectors[query] @ vectors[base].T >= threshold
        hit &= classes[query][:, None] != classes[base][None]
        links = hit @ copies[base]
        q, b = np.nonzero(hit)
        names, place = np.unique(classes, return_inverse=True)
        root = names[forest(place[query[q]], place[base[b]], len(names))]
        connected = np.flatnonzero(root != names)
        some = links > 0
        return pa.table(
            {
                "class": np.concatenate([classes[query][some], names[connected]]),
                "links": np.concatenate([links[some], np.zeros(len(connected), np.int64)]),
                "root": np.concatenate([classes[query][some], root[connected]]),
            }
        )

    return run


def link_embeddings(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    recall: float = TARGET_RECALL,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per row of ``df``: ``key``, ``n_links``, ``component_id`` and ``kept``.

    Rows link if their labels are equal and not null and the cosine of their vectors is ``threshold`` or more.
    A vector that is null, zero or holds a null or non-finite component, and vectors of different lengths, link
    with nothing. ``component_id`` is the smallest key reachable by links; a repeated row counts as another
    vector. An empty table gives an empty frame; other columns are not read.

    Equal vectors are one class, compared once. Of larger groups only counts and one link per vector and task
    are sent on, never the pairs.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("vector", lambda x: x != 0)
    rows = df.select(F.col(key).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    rows = rows.withColumn("valid", F.coalesce(F.col("label").isNotNull() & finite & nonzero, F.lit(False)))
    classes = rows.where("valid").groupBy("label", "vector").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    # A class without any key has no name to be linked by.
    classes = materialise(
        classes.where("least IS NOT NULL").select(F.col("least").alias("class"), "copies", "label", "vector"), "classes"
    )
    n = classes.count()
    order = F.xxhash64("class")
    drawn = classes.select("vector").orderBy(order).limit(sample).toArrow().column("vector")
    index: dict[int, Index] = {}
    if n:
        dims = pc.list_value_length(drawn).to_numpy()
        centroids = int(min(MOST_CENTROIDS, max(8, (n / 16) ** 0.5)))
        for dim in np.unique(dims[dims > 1]).tolist():
            index[dim] = fit(_unit(drawn.filter(pa.array(dims == dim)).combine_chunks()), centroids, threshold, recall)
    kind = classes.schema["vector"].dataType.simpleString()
    label_kind = classes.schema["label"].dataType.simpleString()
    placed = classes.mapInArrow(
        _placed(index),
        f"class bigint, copies bigint, label {label_kind}, vector {kind}, cell int, dim int, own boolean",
    )
    placed = materialise(placed, "cells")
    place = ["label", "dim", "cell"]
    sizes = placed.groupBy(*place).agg(F.count_if("own").alias("n_own"), F.count_if(~F.col("own")).alias("n_visits"))
    blocks = sizes.where("n_own > 0 AND n_visits > 0").select(
        *place, F.ceil(F.col("n_own") / BLOCK).alias("own_blocks"), F.ceil(F.col("n_visits") / BLOCK).alias("visit_blocks")
    )
    spread = placed.join(blocks, place)
    salt = F.xxhash64("class")
    own_block = F.when(F.col("own"), F.array(F.pmod(salt, "own_blocks"))).otherwise(
        F.sequence(F.lit(0), F.col("own_blocks") - 1)
    )
    visit_block = F.when(F.col("own"), F.sequence(F.lit(0), F.col("visit_blocks") - 1)).otherwise(
        F.array(F.pmod(salt, "visit_blocks"))
    )
    spread = spread.withColumn("own_block", F.explode(own_block)).withColumn("visit_block", F.explode(visit_block))
    compared = spread.groupBy(*place, "own_block", "visit_block").applyInArrow(
        _compare(threshold), "class bigint, links bigint, root bigint"
    )
    compared = materialise(compared, "compared")
    links = compared.groupBy("class").agg(F.sum("links").alias("links"))
    components = connected_components(compared.select(F.col("class").alias("a"), F.col("root").alias("b")))
    named = (
        classes.join(links, "class", "left")
        .join(components, F.col("class") == F.col("node"), "left")
        .select(
            "label",
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "class").alias("component_id"),
        )
    )
    joined = rows.alias("r").join(
        named.alias("n"), F.col("r.valid") & (F.col("r.label") == F.col("n.label")) & (F.col("r.vector") == F.col("n.vector")), "left"
    )
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
