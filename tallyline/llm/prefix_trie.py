"""Trie of the prefixes that conversations share, from sorted rows and range minima.

Conversations are sorted by the digests of their prefixes, so the members of a prefix lie side by side. Of each
two neighbours the number of common turns is known (LCP), and a sparse table over these numbers answers the
smallest one in any stretch. From a row and a depth the first and the last member are found by two binary
searches that need nothing of each other, and counts and sums of a node follow from running sums at the two ends.

No task holds all rows. Each takes a block of the sorted ones, and parts of a node that lie in several blocks are
added up by its digest. A conversation is cut into stretches of ``STRETCH`` turns, which start at the node where the
one before ends, and its turns are numbered in pieces, so one that holds a third of all turns is no hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyline.sources.sinks import materialise

# Turns of a row. Conversations beyond are finished one stretch after the other, from the deepest on.
STRETCH = 512
# A conversation begins with up to this number of turns, less one, of the first one of its hundred.
HEADS = 6
FAMILY = 100
# Rows that the children of one node are dealt over when they look up their parent.
SALTS = 64
# Ids that are joined into one row before a node's ids are hashed.
IDS_PER_ROW = 4096

NODE = ["depth", "p1", "p2"]
PARTS = (
    "depth bigint, p1 bigint, p2 bigint, q1 bigint, q2 bigint, conv_id bigint, n bigint, chars bigint, "
    "different bigint, leaves bigint, last bigint"
)
EDGES = (
    "task int, at_end boolean, level bigint, s1 bigint, s2 bigint, p1s array<bigint>, p2s array<bigint>, "
    "lens array<bigint>, goes_on boolean, below_chars bigint, below_leaves bigint"
)
EDGE_NAMES = ["level", "s1", "s2", "p1s", "p2s", "lens", "goes_on", "below_chars", "below_leaves"]


def _running(partition: list[str], order: list[Column]) -> Window:
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def _before(partition: list[str], order: str) -> Window:
    return Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def rebuilt_turns(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations (``id``, ``piece``, ``pos`` from 1, digests ``h1`` and ``h2``, ``len``),
    and all conversations (``id``).

    Turns are numbered in pieces of a range partitioning: counts per piece first, places within a piece after.
    """
    speaker, said = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    order = [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2")]
    turns = df.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("id"),
        F.col(turn).alias("turn"),
        F.xxhash64(F.lit(1), speaker, said).alias("h1"),
        F.xxhash64(F.lit(2), speaker, said).alias("h2"),
        F.char_length(said).cast("bigint").alias("len"),
        # Tells equal rows apart, so that they may lie in several ranges.
        F.monotonically_increasing_id().alias("row"),
    )
    turns = turns.repartitionByRange("id", *order, "row").drop("row").withColumn("piece", F.spark_partition_id())
    turns = materialise(turns, "turns")
    pieces = turns.groupBy("id", "piece").agg(F.count("*").alias("n"))
    pieces = materialise(
        pieces.withColumn("before", F.coalesce(F.sum("n").over(_before(["id"], "piece")), F.lit(0))), "pieces"
    )
    convs = pieces.groupBy("id").agg(F.sum("n").alias("total"))
    convs = convs.withColumn("own", F.crc32(F.col("id").cast("string")) % HEADS)
    convs = convs.withColumn("base", F.col("id") - F.col("id") % FAMILY)
    first = convs.select(F.col("id").alias("base"), F.col("total").alias("base_total"))
    convs = convs.join(first, "base", "left").select(
        "id", "base", "own", F.least("own", F.coalesce("base_total", F.lit(0))).alias("head")
    )
    convs = materialise(convs, "conversations")
    placed = turns.join(pieces.join(convs.drop("base"), "id").drop("n"), ["id", "piece"])
    place = F.col("before") + F.row_number().over(Window.partitionBy("id", "piece").orderBy(*order))
    placed = materialise(placed.withColumn("pos", place).drop("before", "turn"), "placed")
    rest = placed.where("pos > own").select(
        "id", "piece", (F.col("pos") - F.col("own") + F.col("head")).alias("pos"), "h1", "h2", "len"
    )
    heads = placed.where(F.col("pos") < HEADS).select(F.col("id").alias("base"), "pos", "h1", "h2", "len")
    heads = convs.where("head > 0").join(heads, "base").where("pos <= head")
    heads = heads.select("id", F.lit(-1).alias("piece"), "pos", "h1", "h2", "len")
    return materialise(rest.unionByName(heads), "rebuilt"), convs.select("id")


def stretches(turns: DataFrame, stretch: int) -> DataFrame:
    """One row per conversation and stretch of ``stretch`` turns: the node it starts at (``s1``, ``s2``), the digests
    of the prefixes that end in it (``p1s``, ``p2s``), the code points of its turns (``lens``), those before it
    (``before``) and in the whole conversation (``total``), and whether the conversation goes on after it.

    The digest of a prefix is the sum of the digests of its turns with their places, which can be summed in pieces.
    """
    digests = [F.xxhash64("pos", h).cast("decimal(20,0)") for h in ("h1", "h2")]
    turns = turns.select("id", "piece", "pos", "len", digests[0].alias("d1"), digests[1].alias("d2"))
    names = ["d1", "d2", "len", "n"]
    sums = turns.groupBy("id", "piece").agg(
        *[F.sum(c).cast("decimal(38,0)" if c[0] == "d" else "bigint").alias(c) for c in names[:3]], F.count("*").alias("n")
    )
    earlier, whole = _before(["id"], "piece"), Window.partitionBy("id")
    sums = sums.select(
        "id",
        "piece",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in names[:3]],
        F.sum("len").over(whole).alias("total"),
        F.sum("n").over(whole).alias("n_turns"),
    )
    at = _running(["id", "piece"], [F.col("pos")])
    until = {c: F.col(f"{c}_before") + F.sum(c).over(at) for c in names[:3]}

    def digest(value: Column, pos: Column) -> Column:
        return F.when(pos == 0, F.lit(0)).otherwise(F.xxhash64(value.cast("decimal(38,0)"), pos))

    rows = turns.join(sums, ["id", "piece"]).select("*", *[until[c].alias(f"{c}_until") for c in names[:3]])
    rows = rows.select(
        "id",
        "total",
        "n_turns",
        F.floor((F.col("pos") - 1) / stretch).alias("level"),
        F.struct(
            "pos",
            *[digest(F.col(f"d{k}_until"), F.col("pos")).alias(f"p{k}") for k in (1, 2)],
            *[digest(F.col(f"d{k}_until") - F.col(f"d{k}"), F.col("pos") - 1).alias(f"s{k}") for k in (1, 2)],
            (F.col("len_until") - F.col("len")).alias("before"),
            "len",
        ).alias("turn"),
    )
    rows = rows.groupBy("id", "level").agg(
        F.array_sort(F.collect_list("turn")).alias("turns"), F.first("total").alias("total"), F.first("n_turns").alias("n_turns")
    )
    start = F.col("turns")[0]
    return rows.select(
        "id",
        "level",
        start["s1"].alias("s1"),
        start["s2"].alias("s2"),
        F.col("turns.p1").alias("p1s"),
        F.col("turns.p2").alias("p2s"),
        F.col("turns.len").alias("lens"),
        start["before"].alias("before"),
        "total",
        (F.col("n_turns") > (F.col("level") + 1) * stretch).alias("goes_on"),
        "n_turns",
    )


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column of lists."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy()
    return lists.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]


def common_turns(table: pa.Table) -> np.ndarray:
    """Number of first turns that each row has in common with the row before it, within its stretch."""
    (p1, offsets), (p2, _) = _flat(table.column("p1s")), _flat(table.column("p2s"))
    start = np.stack([table.column(c).to_numpy() for c in ("level", "s1", "s2")])
    together = np.append(False, (start[:, 1:] == start[:, :-1]).all(axis=0))
    lengths = np.diff(offsets)
    shorter = np.where(together, np.minimum(lengths, np.append(0, lengths[:-1])), 0)
    row = np.repeat(np.arange(len(shorter)), shorter)
    place = np.arange(shorter.sum()) - np.repeat(np.cumsum(shorter) - shorter, shorter)
    here, there = offsets[row] + place, offsets[row - 1] + place
    same = (p1[here] == p1[there]) & (p2[here] == p2[there])
    return np.bincount(row[same], minlength=len(shorter))


class Minima:
    """Sparse table: the smallest value in any stretch of an array."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        step = 1
        while 2 * step <= len(values):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Smallest value from ``first`` to ``last``, both included."""
        level = np.frexp(last - first + 1)[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level).tolist():
            mine = level == k
            values = self.levels[k]
            out[mine] = np.minimum(values[first[mine]], values[last[mine] - (1 << k) + 1])
        return out

    def right(self, row: np.ndarray, depth: np.ndarray, end: int) -> np.ndarray:
        """Last row before ``end`` up to which all values after ``row`` are at least ``depth``."""
        at = row.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            values, step = self.levels[k], 1 << k
            inside = at + step < end
            at += step * (inside & (values[np.where(inside, at + 1, 0)] >= depth))
        return at

    def left(self, row: np.ndarray, depth: np.ndarray, start: int) -> np.ndarray:
        """First row from ``start`` on after which all values up to ``row`` are at least ``depth``."""
        at = row.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            values, step = self.levels[k], 1 << k
            inside = at - step >= start
            at -= step * (inside & (values[np.where(inside, at - step + 1, 0)] >= depth))
        return at


def _nodes_of(table: pa.Table, first: int, end: int, stretch: int) -> list[np.ndarray]:
    """Parts of the nodes whose members are among the rows ``first`` to ``end`` of a sorted table.

    A row before and a row after these are neighbours only. A node is a prefix of the first of its members.
    """
    (p1, offsets), (p2, _), (lens, _) = (_flat(table.column(c)) for c in ("p1s", "p2s", "lens"))
    ids, level, s1, s2, before, total, below_chars, below_leaves = (
        table.column(c).to_numpy() for c in ("id", "level", "s1", "s2", "before", "total", "below_chars", "below_leaves")
    )
    goes_on = table.column("goes_on").to_numpy()
    lengths, common = np.diff(offsets), common_turns(table)
    minima, smallest = Minima(common), Minima(ids)
    running = np.append(0, np.cumsum(lens))

    # What a row adds to the nodes it is a member of: turns that no row before it has, and its end if no row goes on.
    owner = common < lengths
    own = running[offsets[1:]] - running[offsets[:-1] + common] + np.where(owner, below_chars, 0)
    childless = ~goes_on & (np.append(common[1:], 0) < lengths)
    leaves = np.append(0, np.cumsum(childless + np.where(owner, below_leaves, 0)))
    owned, totals = np.append(0, np.cumsum(own)), np.append(0, np.cumsum(total))

    known = common[first:end].copy()
    known[:1] = 0
    new = lengths[first:end] - known
    row = np.repeat(np.arange(first, end), new)
    depth = np.arange(new.sum()) - np.repeat(np.cumsum(new) - new, new) + np.repeat(known, new) + 1
    left, right = minima.left(row, depth, first), minima.right(row, depth, end)
    n = right - left + 1
    turn = offsets[row] + depth - 1
    chars = totals[right + 1] - totals[left] - n * (before[row] + running[turn] - running[offsets[row]])
    # Of the first member only the turns from this depth on are in the subtree.
    from_here = offsets[left] + np.maximum(depth - 1, common[left])
    rest = running[offsets[left + 1]] - running[from_here] + np.where(owner[left], below_chars[left], 0)
    different = owned[right + 1] - owned[left + 1] + rest
    parent = np.maximum(turn - 1, 0)
    return [
        level[row] * stretch + depth,
        p1[turn],
        p2[turn],
        np.where(depth == 1, s1[row], p1[parent]),
        np.where(depth == 1, s2[row], p2[parent]),
        smallest.least(left, right),
        n,
        chars,
        different,
        leaves[right + 1] - leaves[left],
        lens[turn],
    ]


def _parts(schema: pa.Schema, stretch: int):
    """Sorted rows to parts of nodes, and the first and the last row of the task."""

    def written(arrays: list[np.ndarray], edge: pa.Table | None = None, at_end: bool = False) -> pa.RecordBatch:
        columns = [pa.array(a) for a in arrays] or [pa.nulls(1, pa.int64()) for _ in range(11)]
        n = len(columns[0])
        if edge is None:
            columns += [pa.nulls(n, schema.field(i).type) for i in range(11, len(schema))]
        else:
            columns += [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([at_end])]
            columns += [edge.column(c).combine_chunks() for c in EDGE_NAMES]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, block = None, None
        tables = (pa.Table.from_batches([b]) for b in batches if b.num_rows)
        for following in tables:
            if block is None:
                yield written([], following.slice(0, 1))
            else:
                rows = [t for t in (before, block, following.slice(0, 1)) if t is not None]
                first = 0 if before is None else 1
                yield written(_nodes_of(pa.concat_tables(rows), first, first + block.num_rows, stretch))
                before = block.slice(block.num_rows - 1)
            block = following
        if block is not None:
            rows = [t for t in (before, block) if t is not None]
            first = 0 if before is None else 1
            yield written(_nodes_of(pa.concat_tables(rows), first, first + block.num_rows, stretch))
            yield written([], block.slice(block.num_rows - 1), True)

    return run


def _corrections(stretch: int):
    """Last row of a task and first row of the next one to what both have counted of the nodes they share."""

    def corrected(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for pair in batch.to_pylist():
            a, b = pair["a"], pair["b"]
            if (a["level"], a["s1"], a["s2"]) != (b["level"], b["s1"], b["s2"]):
                continue
            shared = 0
            for x, y in zip(zip(a["p1s"], a["p2s"]), zip(b["p1s"], b["p2s"])):
                if x != y:
                    break
                shared += 1
            different = leaves = 0
            if shared == len(b["p1s"]):
                different, leaves = -b["below_chars"], -b["below_leaves"]
            if shared == len(a["p1s"]) and not a["goes_on"]:
                leaves -= 1
            for depth in range(shared, 0, -1):
                different -= b["lens"][depth - 1]
                q = (b["s1"], b["s2"]) if depth == 1 else (b["p1s"][depth - 2], b["p2s"][depth - 2])
                node = (a["level"] * stretch + depth, b["p1s"][depth - 1], b["p2s"][depth - 1], *q)
                out.append((*node, None, 0, 0, different, leaves, b["lens"][depth - 1]))
        names = [f.split()[0] for f in PARTS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(11)], names=names)

    return lambda batches: map(corrected, batches)


def level_nodes(rows: DataFrame, stretch: int) -> DataFrame:
    """The nodes of one level of ``stretches`` (with ``below_chars`` and ``below_leaves``), parts added up."""
    schema = f"{PARTS}, {EDGES}"
    order = ["level", "s1", "s2", "p1s", "p2s", "goes_on", "id"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    found = materialise(ranged.mapInArrow(_parts(to_arrow_schema(StructType.fromDDL(schema)), stretch), schema), "parts")
    # Two rows per task.
    edge = F.struct(*EDGE_NAMES)
    edges = found.where("task IS NOT NULL").select("task", "at_end", edge.alias("a"))
    following = F.lead("a").over(Window.orderBy("task", "at_end"))
    pairs = edges.withColumn("b", following).where("at_end AND b IS NOT NULL").select("a", "b")
    parts = found.where("task IS NULL").select(*[f.split()[0] for f in PARTS.split(", ")])
    parts = parts.union(pairs.mapInArrow(_corrections(stretch), PARTS))
    sums = [F.sum(c).alias(c) for c in ("n", "chars", "different", "leaves")]
    added = parts.groupBy(*NODE, "q1", "q2").agg(F.min("conv_id").alias("conv_id"), F.max("last").alias("last"), *sums)
    return materialise(added, "nodes")


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and id to rows of up to ``IDS_PER_ROW`` ids of one node."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        node = np.stack([table.column(c).to_numpy() for c in NODE])
        ids = table.column("id").to_numpy()
        cut = np.append(True, (node[:, 1:] != node[:, :-1]).any(axis=0))[: len(ids)]
        starts = np.flatnonzero(cut)
        starts = np.concatenate([np.arange(a, b, IDS_PER_ROW) for a, b in zip(starts, np.append(starts[1:], len(ids)))] or [starts])
        ends = np.append(starts[1:], len(ids))[: len(starts)]
        joined = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts.tolist(), ends.tolist())]
        columns = [pa.array(n[starts]) for n in node] + [pa.array(ids[starts]), pa.array(joined, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=[*NODE, "first_id", "ids"])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and first id to one digest per node. Only the digest's state is kept."""
    node, state = None, None
    for batch in batches:
        done: list[tuple] = []
        rows = zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")))
        for *key, ids in rows:
            if key == node:
                state.update(b",")
            else:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            state.update(ids.encode())
        yield _digests(done)
    if node is not None:
        yield _digests([(*node, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
    return pa.RecordBatch.from_arrays([*columns, pa.array([r[3] for r in rows], pa.string())], names=[*NODE, "ends_sha256"])


def ends_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node (``depth``, ``p1``, ``p2``, ``id``), ascending and joined by commas."""
    ranged = ends.repartitionByRange(*NODE, "id").sortWithinPartitions(*NODE, "id")
    joined = ranged.mapInArrow(_join_ids, "depth bigint, p1 bigint, p2 bigint, first_id bigint, ids string")
    dealt = joined.repartition(*NODE).sortWithinPartitions(*NODE, "first_id")
    return dealt.mapInArrow(_hash_ids, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")


def prefix_trie(
    df: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    stretch: int = STRETCH,
) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations, the textless root included.

    Each conversation ``c`` gets the first ``crc32(c) % 6`` turns of ``c - c % 100`` before its own turns, less as
    many of these. One row per different sequence of first turns: ``conv_id`` (the smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Turns are ordered by ``turn``, null first; turns with the same number have a fixed order that follows from
    their contents, and repeated rows are turns of their own. A null role or text is empty, rows without a
    conversation have no part, and other columns are not read. Texts of any length are read for their digest and
    length only. An empty table has no members and gives no node, not even the root.
    """
    turns, convs = rebuilt_turns(df, conv_id, turn, role, text)
    rows = materialise(stretches(turns, stretch), "stretches")
    levels = (rows.agg(F.max("level")).first()[0] or 0) + 1
    nothing = F.lit(0).cast("bigint")
    parts: list[DataFrame] = []
    for level in range(levels - 1, -1, -1):
        mine = rows.where(F.col("level") == level)
        if parts:
            # What hangs below the last node of a full stretch.
            below = parts[-1].where(F.col("depth") == (level + 1) * stretch + 1).groupBy("q1", "q2")
            below = below.agg(F.sum("different").alias("below_chars"), F.sum("leaves").alias("below_leaves"))
            end = [F.element_at("p1s", -1) == F.col("q1"), F.element_at("p2s", -1) == F.col("q2")]
            mine = mine.join(below, end, "left").drop("q1", "q2")
            mine = mine.fillna(0, ["below_chars", "below_leaves"])
        else:
            mine = mine.select("*", nothing.alias("below_chars"), nothing.alias("below_leaves"))
        parts.append(level_nodes(mine, stretch))
    nodes = parts[0]
    for part in parts[1:]:
        nodes = nodes.unionByName(part)

    tops = nodes.where("depth = 1").agg(
        F.coalesce(F.sum("chars") - F.sum("different"), nothing).alias("saved"),
        F.coalesce(F.sum("leaves"), F.lit(1)).cast("bigint").alias("leaves"),
    )
    members = convs.agg(F.min("id").alias("conv_id"), F.count("*").alias("n")).where("n > 0")
    # One row each.
    root = members.join(F.broadcast(tops)).select(
        nothing.alias("depth"), nothing.alias("p1"), nothing.alias("p2"),
        F.lit(None).cast("bigint").alias("q1"), F.lit(None).cast("bigint").alias("q2"),
        "conv_id", "n", "saved", "leaves",
    )
    others = nodes.select(*NODE, "q1", "q2", "conv_id", "n", (F.col("chars") - F.col("different")).alias("saved"), "leaves")
    nodes = materialise(root.unionByName(others), "trie")

    # Children look their parent up by its digest and a salt, so those of one node are dealt over several tasks.
    salt = F.pmod(F.xxhash64("p1"), F.lit(SALTS))
    kin = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), "q1", "q2", salt.alias("salt"))
    kin = materialise(kin.agg(F.count("*").alias("children")), "kin")
    named = nodes.select(NODE[0], F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    parents = kin.join(named, ["depth", "q1", "q2"]).drop("children").withColumn("depth", F.col("depth") + 1)
    counts = kin.groupBy("depth", F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.sum("children").alias("n_children"))
    last = [F.element_at(c, -1).alias(c[:2]) for c in ("p1s", "p2s")]
    ends = rows.where(~F.col("goes_on")).select(F.col("n_turns").alias("depth"), *last, "id")
    turnless = convs.join(ends.select("id"), "id", "left_anti").select(*[nothing.alias(c) for c in NODE], "id")
    digests = ends_digests(ends.unionByName(turnless))
    return (
        nodes.withColumn("salt", salt)
        .join(parents, ["depth", "q1", "q2", "salt"], "left")
        .join(counts, NODE, "left")
        .join(digests, NODE, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            F.col("n").alias("n_convs"),
            F.coalesce("n_children", nothing).alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
