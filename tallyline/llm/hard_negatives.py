"""Hard negatives by cover trees over norm-augmented candidates.

One more component brings all candidates to the same length, so that they lie on a sphere and the inner product with
an anchor falls with the angle between them. A node of a cover tree is a candidate with the largest angle to any
below it, its covering radius; from these follow the highest and the lowest inner product in its subtree. The best
nodes are opened first, nodes outside all of an anchor's score windows are skipped, and leaves are verified in whole
numbers.

The top of the tree is fitted on a bounded sample: its nodes are cells, every candidate lies in the cell of the
nearest one, and the radius of a cell covers all its candidates. An anchor visits the cells that its windows allow.
The levels below are built where a block of a cell's candidates is searched, one tree for each label.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.sources.sinks import materialise

# The cells are fitted on at most so many candidates; every candidate is indexed. The driver and the tasks hold
# one vector per cell.
SAMPLE = 20_000
MOST_CELLS = 1024
# Candidates searched in one task with as many anchors; a cell or its visits with more are cut into blocks.
BLOCK = 2048
# Share of a node's radius that its children cover.
SHRINK = 0.7
LEAF = 16
# Angles are floating-point numbers; bounds are widened by this share of the largest possible inner product.
SLACK = 1e-7
LONG = (-(1 << 63), (1 << 63) - 1)

WINDOWS = "array<struct<positive: bigint, score: bigint, low: bigint, high: bigint>>"
FOUND = "anchor bigint, positive bigint, positive_score bigint, id bigint, score bigint"
PLACE = ["dim", "cell"]
UNIT = [*PLACE, "own_block", "visit_block"]


def augmented(vectors: np.ndarray, length: float) -> np.ndarray:
    """``vectors`` with the component that brings each to ``length``, divided by it."""
    vectors = vectors.astype(np.float64)
    rest = np.sqrt(np.maximum(length**2 - (vectors**2).sum(1), 0))
    return np.column_stack([vectors, rest]) / length


def largest_norm(vectors: np.ndarray) -> float:
    return max(1.0, float(np.sqrt((vectors.astype(np.float64) ** 2).sum(1).max(initial=0))))


def bounds(cosines: np.ndarray, radii: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest inner product within ``radii`` of nodes at these cosines from an anchor."""
    angle = np.arccos(np.clip(cosines, -1, 1))
    low = np.cos(np.minimum(angle + radii, np.pi)) - SLACK
    high = np.cos(np.maximum(angle - radii, 0)) + SLACK
    return low * scale, high * scale


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, each query with each vector."""
    q, v = queries.astype(np.float64), vectors.astype(np.float64)
    if np.abs(v).max(initial=0) * np.abs(q).sum(1).max(initial=0) < 2**53:
        return (q @ v.T).astype(np.int64)
    return np.clip(queries.astype(object) @ vectors.astype(object).T, *LONG).astype(np.int64)


class CoverTree:
    """Cover tree of some of the rows of ``points``, which lie on the unit sphere.

    Node ``i`` has the point ``center[i]``, the covering radius ``radius[i]`` (an angle), and either ``children[i]``,
    which are further apart than the radius they cover, or ``members[i]``.
    """

    def __init__(self, points: np.ndarray, rows: np.ndarray):
        self.center: list[int] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray | None] = []
        self.members: list[np.ndarray | None] = []
        self.points = points
        open_nodes = [self._add(rows[0], rows)]
        while open_nodes:
            node = open_nodes.pop()
            rows = self.members[node]
            if len(rows) <= LEAF or self.radius[node] < 1e-6:
                continue
            nearest = points[rows] @ points[self.center[node]]
            chosen, own = [self.center[node]], np.zeros(len(rows), np.int64)
            cover = np.cos(SHRINK * self.radius[node])
            while nearest[far := int(nearest.argmin())] < cover:
                cosines = points[rows] @ points[rows[far]]
                own[cosines > nearest] = len(chosen)
                own[far] = len(chosen)
                nearest = np.maximum(nearest, cosines)
                nearest[far] = 1.0
                chosen.append(int(rows[far]))
            if len(np.unique(own)) < 2:
                continue
            parts = [self._add(c, rows[own == k]) for k, c in enumerate(chosen) if (own == k).any()]
            self.children[node], self.members[node] = np.array(parts), None
            open_nodes += parts
        self.centers, self.radii = points[self.center], np.array(self.radius)

    def _add(self, center: int, rows: np.ndarray) -> int:
        self.center.append(int(center))
        cosine = float((self.points[rows] @ self.points[center]).min())
        self.radius.append(float(np.arccos(np.clip(cosine, -1, 1))))
        self.children.append(None)
        self.members.append(rows)
        return len(self.center) - 1


class Candidates:
    """Cover trees of a block of candidates, by label."""

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, ids: list[list[int]]):
        self.vectors, self.ids = vectors, ids
        self.length = largest_norm(vectors)
        self.points = augmented(vectors, self.length)
        order = labels.argsort(kind="stable")
        names, starts = np.unique(labels[order], return_index=True)
        self.rows = dict(zip(names.tolist(), np.split(order, starts[1:])))
        self.trees: dict[int, CoverTree] = {}

    def tree(self, label: int) -> CoverTree:
        if label not in self.trees:
            self.trees[label] = CoverTree(self.points, self.rows[label])
        return self.trees[label]

    def search(
        self, queries: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: int, labels: np.ndarray, same: bool
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Candidates in the score windows of the anchors: number of the anchor, of its window, row and score.

        All that can be among an anchor's first ``wanted`` of a window are returned, and some more. ``low`` and
        ``high`` have a row per anchor and a column per window. Candidates have the anchor's label, or with
        ``same`` unset all have others. The node of the best bound is opened for all anchors that it may serve at
        once; what these have found by then closes later ones.
        """
        size = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
        toward = np.column_stack([queries / np.maximum(size, 1e-300)[:, None], np.zeros(len(queries))])
        need = low.astype(np.float64)
        top = np.full((*low.shape, wanted), -np.inf)
        hits: list[tuple[np.ndarray, ...]] = []
        heap: list[tuple] = []
        pushed = 0

        def allowed(who: np.ndarray, worst: np.ndarray, best: np.ndarray) -> np.ndarray:
            return ((best[..., None] >= need[who]) & (worst[..., None] <= high[who])).any(axis=-1)

        def push(name: int, nodes: np.ndarray, who: np.ndarray) -> None:
            nonlocal pushed
            tree = self.tree(name)
            scale = (size[who] * self.length)[:, None]
            worst, best = bounds(toward[who] @ tree.centers[nodes].T, tree.radii[nodes], scale)
            for k, node in enumerate(nodes.tolist()):
                mine = allowed(who, worst[:, k], best[:, k])
                if mine.any():
                    pushed += 1
                    entry = (name, node, who[mine], worst[mine, k], best[mine, k])
                    heapq.heappush(heap, (-best[mine, k].max(), pushed, entry))

        for name in self.rows:
            who = np.flatnonzero((labels == name) == same)
            if len(who):
                push(name, np.zeros(1, np.int64), who)
        while heap:
            name, node, who, worst, best = heapq.heappop(heap)[2]
            who = who[allowed(who, worst, best)]
            if not len(who):
                continue
            tree = self.tree(name)
            if tree.children[node] is not None:
                push(name, tree.children[node], who)
                continue
            rows = tree.members[node]
            scores = products(queries[who], self.vectors[rows])
            each = scores[:, None, :]
            inside = (each >= low[who][..., None]) & (each <= high[who][..., None]) & (each >= need[who][..., None])
            found = inside.any(axis=(1, 2))
            who, inside, scores = who[found], inside[found], scores[found]
            if len(who):
                a, w, r = np.nonzero(inside)
                hits.append((who[a], w, rows[r], scores[a, r]))
                more = np.concatenate([top[who], np.where(inside, scores[:, None, :], -np.inf)], axis=-1)
                top[who] = -np.partition(-more, wanted - 1, axis=-1)[..., :wanted]
                need[who] = np.maximum(need[who], top[who].min(axis=-1))
        none = np.zeros(0, np.int64)
        a, w, r, score = (np.concatenate([none, *(h[k] for h in hits)]) for k in range(4))
        kept = score >= need[a, w]
        return a[kept], w[kept], r[kept], score[kept]


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    rows = column.to_pylist()
    return np.array(rows, np.int64).reshape(len(rows), dim)


def _placed(index: dict[int, tuple[np.ndarray, float]]):
    """Adds to candidates the cell of the nearest center and the cosine of the angle between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = pc.list_value_length(batch.column("vector")).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                cell, cosine = np.zeros(part.num_rows, np.int32), np.full(part.num_rows, -1.0)
                if dim in index:
                    centers, length = index[dim]
                    cosines = augmented(_matrix(part.column("vector"), dim), length) @ centers.T
                    cell = cosines.argmax(1).astype(np.int32)
                    cosine = cosines.max(1)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([dim] * part.num_rows, pa.int32()), pa.array(cell), pa.array(cosine)],
                    names=[*part.schema.names, "dim", "cell", "cosine"],
                )

    return run


def _visits(index: dict[int, tuple[np.ndarray, float]], cells: dict[int, tuple[np.ndarray, np.ndarray]], best: bool):
    """Anchors with windows to one row for each cell that the windows allow.

    With ``best`` only the most promising one is visited; without it all, but for that one where ``others`` is set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, dims, places = [], [], []
            for r, (vector, windows) in enumerate(zip(batch.column("vector").to_pylist(), batch.column("windows").to_pylist())):
                dim = len(vector)
                if dim not in index:
                    # All candidates of a length that the sample does not hold are in one cell.
                    allowed = np.zeros(int(best or not batch.column("others")[r].as_py()), np.int64)
                else:
                    centers, length = index[dim]
                    numbers, radii = cells[dim]
                    query = np.array(vector, np.float64)
                    size = float(np.sqrt((query**2).sum()))
                    toward = np.append(query, 0.0) / max(size, 1e-300)
                    low, high = bounds(centers[numbers] @ toward, radii, size * length)
                    first = int(high.argmax())
                    if best:
                        allowed = numbers[first : first + 1]
                    else:
                        inside = np.zeros(len(numbers), bool)
                        for window in windows:
                            inside |= (high >= window["low"]) & (low <= window["high"])
                        if batch.column("others")[r].as_py():
                            inside[first] = False
                        allowed = numbers[inside]
                rows += [r] * len(allowed)
                dims += [dim] * len(allowed)
                places += allowed.tolist()
            out = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(dims, pa.int32()), pa.array(places, pa.int32())],
                names=[*out.schema.names, "dim", "cell"],
            )

    return run


def _searched(wanted: int, same: bool):
    """A block of candidates and the anchors that visit it to what they find in each of their windows."""

    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if candidates.num_rows and anchors.num_rows:
            dim = candidates.column("dim")[0].as_py()
            ids = candidates.column("ids").to_pylist()
            block = Candidates(_matrix(candidates.column("vector"), dim), candidates.column("label").to_numpy(), ids)
            own, windows = anchors.column("id").to_pylist(), anchors.column("windows").to_pylist()
            # Anchors with fewer windows than others have some that nothing is in.
            low = np.full((len(own), max(map(len, windows))), LONG[1])
            high = np.full(low.shape, LONG[0])
            for i, mine in enumerate(windows):
                low[i, : len(mine)] = [w["low"] for w in mine]
                high[i, : len(mine)] = [w["high"] for w in mine]
            # The anchor itself may be among the rows of its label.
            found = block.search(
                _matrix(anchors.column("vector"), dim), low, high, wanted + same, anchors.column("label").to_numpy(), same
            )
            each: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
            for a, w, r, score in zip(*(f.tolist() for f in found)):
                each[a, w] += [(-score, i) for i in ids[r] if i != own[a] or not same]
            for (a, w), best in each.items():
                window = windows[a][w]
                rows += [(own[a], window["positive"], window["score"], i, -score) for score, i in sorted(best)[:wanted]]
        return pa.table({n.split()[0]: pa.array([r[k] for r in rows], pa.int64()) for k, n in enumerate(FOUND.split(", "))})

    return run


class Index:
    """All candidates in the cells of a cover tree's top, whose centers come from a sample."""

    def __init__(self, classes: DataFrame, sample: int, most_cells: int):
        n = classes.count()
        drawn = classes.select("vector").orderBy(F.xxhash64("class")).limit(sample).toArrow().column("vector")
        dims = pc.list_value_length(drawn).to_numpy()
        norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        known = np.unique(dims[dims > 0]).tolist()
        norms = classes.groupBy(F.size("vector").alias("dim")).agg(F.max(norm).alias("norm"))
        longest = {r["dim"]: max(1.0, r["norm"] ** 0.5) for r in norms.where(F.col("dim").isin(known)).collect()}
        self.centers: dict[int, tuple[np.ndarray, float]] = {}
        for dim in known:
            length = longest[dim] * (1 + 1e-12)
            points = augmented(_matrix(drawn.filter(pa.array(dims == dim)), dim), length)
            self.centers[dim] = (self._spread_out(points, int(min(most_cells, max(1, n**0.5 / 8)))), length)
        placed = classes.mapInArrow(
            _placed(self.centers),
            "class bigint, label bigint, vector array<bigint>, ids array<bigint>, dim int, cell int, cosine double",
        )
        self.candidates = materialise(placed, "candidates")
        radii = self.candidates.groupBy(*PLACE).agg(F.min("cosine").alias("cosine")).where(F.col("dim").isin(known))
        self.cells: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        rows = radii.collect()
        for dim in known:
            mine = [r for r in rows if r["dim"] == dim]
            cosines = np.clip([r["cosine"] for r in mine], -1, 1)
            self.cells[dim] = (np.array([r["cell"] for r in mine]), np.arccos(cosines))

    @staticmethod
    def _spread_out(points: np.ndarray, k: int) -> np.ndarray:
        """Up to ``k`` points, each the one furthest from those before it."""
        chosen, nearest = [0], points @ points[0]
        while len(chosen) < k and nearest[far := int(nearest.argmin())] < 1 - 1e-12:
            chosen.append(far)
            nearest = np.maximum(nearest, points @ points[far])
        return points[chosen]

    def search(self, anchors: DataFrame, best: bool, wanted: int, same: bool) -> DataFrame:
        """What ``anchors`` (``id``, ``label``, ``vector``, ``windows``, ``others``) find: ``FOUND``."""
        schema = f"id bigint, label bigint, vector array<bigint>, windows {WINDOWS}, others boolean, dim int, cell int"
        visits = materialise(anchors.mapInArrow(_visits(self.centers, self.cells, best), schema), "visits")
        n_own = self.candidates.groupBy(*PLACE).agg(F.count("*").alias("n_own"))
        n_visits = visits.groupBy(*PLACE).agg(F.count("*").alias("n_visits"))
        blocks = n_own.join(n_visits, PLACE).select(
            *PLACE, *[F.ceil(F.col(f"n_{c}") / BLOCK).alias(f"{c}_blocks") for c in ("own", "visits")]
        )
        blocks = materialise(blocks, "blocks")

        def every(count: str):
            return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))

        own = self.candidates.join(blocks, PLACE).select(
            "label", "vector", "ids", *PLACE, F.pmod(F.xxhash64("class"), "own_blocks").alias("own_block"), "visits_blocks"
        )
        own = own.select("*", every("visits_blocks").alias("visit_block")).drop("visits_blocks")
        visiting = visits.join(blocks, PLACE).select(
            "id", "label", "vector", "windows", *PLACE, F.pmod(F.xxhash64("id"), "visits_blocks").alias("visit_block"), "own_blocks"
        )
        visiting = visiting.select("*", every("own_blocks").alias("own_block")).drop("own_blocks")
        return own.groupBy(*UNIT).cogroup(visiting.groupBy(*UNIT)).applyInArrow(_searched(wanted, same), FOUND)


def _first(found: DataFrame, by: list[str], wanted: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def hard_negatives(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "vector",
    label: str = "label",
    anchor: str = "anchor",
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
    sample: int = SAMPLE,
    most_cells: int = MOST_CELLS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    ``vector`` holds whole numbers. Rows for which ``anchor`` is true are anchors. An anchor's positives are the first
    ``positives`` other rows of its label by descending inner product and ascending key. For each, the first
    ``negatives`` rows of other labels are returned whose inner product is between ``least`` and ``most`` hundredths
    of the positive's; positives of a negative inner product have none. Inner products beyond the range of a long
    are cut to it.

    Rows whose key, label or vector is null, or whose vector holds a null, take no part. Vectors of different
    lengths never meet. Of several rows with one key the one with the smallest label and vector counts. An empty
    table gives an empty frame; other columns are not read.

    Equal vectors of one label are one candidate, with the few smallest keys that could be returned.
    """
    whole = F.forall("vector", lambda x: x.isNotNull())
    rows = df.select(
        F.col(key).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<bigint>").alias("vector"),
        F.coalesce(F.col(anchor), F.lit(False)).alias("anchor"),
    )
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & whole)
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "vector", "anchor")).alias("r")).select("id", "r.*")
    rows = materialise(rows, "rows")
    place = F.row_number().over(Window.partitionBy("label", "vector").orderBy("id"))
    few = rows.select("id", "label", "vector", place.alias("place")).where(F.col("place") <= max(positives + 1, negatives))
    classes = few.groupBy("label", "vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = materialise(classes.select(F.col("ids")[0].alias("class"), "label", "vector", "ids"), "classes")
    index = Index(classes, sample, most_cells)

    def window(positive, score, low, high):
        cast = [c.cast("bigint").alias(n) for c, n in zip((positive, score, low, high), ("positive", "score", "low", "high"))]
        return F.struct(*cast)

    anchors = rows.where("anchor").select("id", "label", "vector")
    null, lowest, highest = F.lit(None), F.lit(LONG[0]), F.lit(LONG[1])
    all_scores = F.array(window(null, null, lowest, highest)).cast(WINDOWS)
    first = anchors.select("*", all_scores.alias("windows"), F.lit(True).alias("others"))
    near = materialise(index.search(first, True, positives, same=True).select("anchor", "id", "score"), "near")
    reached = near.groupBy("anchor").agg(F.min("score").alias("score"), F.count("*").alias("n"))
    reached = reached.select("anchor", F.when(F.col("n") >= positives, F.col("score")).alias("reached"))
    bounded = F.array(window(null, null, F.coalesce("reached", lowest), highest)).cast(WINDOWS)
    rest = first.join(reached, F.col("id") == F.col("anchor"), "left").select("id", "label", "vector", bounded.alias("windows"), "others")
    far = index.search(rest, False, positives, same=True).select("anchor", "id", "score")
    found = materialise(_first(near.union(far), ["anchor"], positives), "positives")

    low = F.expr(f"({least} * cast(score AS decimal(20,0)) + 99) div 100")
    high = F.expr(f"({most} * cast(score AS decimal(20,0))) div 100")
    windows = found.where("score >= 0").groupBy("anchor").agg(
        F.collect_list(window(F.col("id"), F.col("score"), low, high)).cast(WINDOWS).alias("windows")
    )
    second = anchors.join(windows, F.col("id") == F.col("anchor")).select(
        "id", "label", "vector", "windows", F.lit(False).alias("others")
    )
    ranked = _first(index.search(second, False, negatives, same=False), ["anchor", "positive"], negatives)
    return ranked.select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
