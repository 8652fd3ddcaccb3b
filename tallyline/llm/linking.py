"""Groups of linked items that share buckets, without listing the pairs of a bucket as rows.

Candidates are items that share a bucket. What is asked for is which items are connected by verified links,
so two items that are connected already need no comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.components import connected_components
from tallyline.sources.sinks import discard, materialise

# Items of a bucket that one task compares; a bucket with more is cut into blocks, and tasks take two of them.
BLOCK = 512

# Links among the items of one unit: columns by name and the class of each item, to positions (i, j).
Links = tuple[np.ndarray, np.ndarray]
Compare = Callable[[dict[str, np.ndarray], np.ndarray], Links]
# The same, where it needs to know of pairs whether they are linked: it yields their two sides and is sent the answers.
Asking = Generator[tuple[list, list], np.ndarray, Links]
Decide = Callable[[list, list], np.ndarray]
# The same, to the positions of the items that are worth a further look.
Pick = Callable[[dict[str, np.ndarray], np.ndarray], np.ndarray]


def shared_buckets(members: DataFrame) -> DataFrame:
    """The rows of ``members`` (``bucket``, ``id`` once per bucket, any more) whose bucket has at least two rows,
    and their number ``n``. What the buckets are counted by is two numbers wide, whatever else the rows hold, and
    is hashed, once per bucket, so that the rows need no sort."""
    several = materialise(members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    return members.join(several.hint("shuffle_hash"), "bucket")


def forest(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component, for nodes 0..n-1 and links left-right."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        new = new[root]
        if np.array_equal(new, root):
            return root
        root = new
    return root


def _answered(asking: list[Asking], decide: Decide) -> list[Links]:
    """What each of ``asking`` returns. The pairs that they ask for next are decided together."""
    found: list[Links] = [None] * len(asking)
    answers: dict[int, np.ndarray | None] = dict.fromkeys(range(len(asking)))
    while answers:
        asked = {}
        for k, answer in answers.items():
            try:
                asked[k] = asking[k].send(answer)
            except StopIteration as end:
                found[k] = end.value
        left, right = ([x for pairs in asked.values() for x in pairs[side]] for side in (0, 1))
        ends = np.cumsum([len(pairs[0]) for pairs in asked.values()])
        answers = dict(zip(asked, np.split(decide(left, right), ends[:-1]))) if asked else {}
    return found


def _by_unit(table: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray, list[tuple[int, int]]]:
    """One group's columns, sorted into units, the rows they come from, and where units of several classes are."""
    unit = np.stack([table.column(c).to_numpy() for c in ("bucket", "i", "j")])
    order = np.lexsort(unit)
    unit = unit[:, order]
    edges = np.flatnonzero(np.any(unit[:, 1:] != unit[:, :-1], axis=0)) + 1
    columns = {c: table.column(c).to_numpy(zero_copy_only=False)[order] for c in table.column_names}
    classes, places = columns["class"], []
    for start, end in zip(np.append(0, edges), np.append(edges, len(order))):
        if end - start > 1 and (classes[start:end] != classes[start]).any():
            places.append((start, end))
    return columns, order, places


def _units(compare: Callable, decide: Decide | None = None):
    """One group's rows, sorted into units, to links: each item with the smallest one it is connected with."""

    def run(table: pa.Table) -> pa.Table:
        columns, _, places = _by_unit(table)
        left, right = [], []
        found = [compare({c: v[start:end] for c, v in columns.items()}, columns["class"][start:end]) for start, end in places]
        for (start, end), (a, b) in zip(places, _answered(found, decide) if decide else found):
            # The links of a unit may be many times its items; one per item says as much.
            root = forest(a, b, end - start)
            moved = np.flatnonzero(root != np.arange(end - start))
            left.append(moved + start)
            right.append(root[moved] + start)
        none = np.zeros(0, np.int64)
        ids = np.unique(columns["id"])
        place = np.searchsorted(ids, columns["id"])
        root = forest(place[np.concatenate([none, *left])], place[np.concatenate([none, *right])], len(ids))
        moved = root != np.arange(len(ids))
        return pa.table({"a": ids[moved], "b": ids[root[moved]]})

    return run


def _picks(pick: Pick, names: list[str]):
    """One group's rows, sorted into units, to the columns ``names`` of those that ``pick`` takes in them."""

    def run(table: pa.Table) -> pa.Table:
        columns, order, places = _by_unit(table)
        taken = [np.zeros(0, np.int64)]
        for start, end in places:
            taken.append(start + pick({c: v[start:end] for c, v in columns.items()}, columns["class"][start:end]))
        return table.select(names).take(pa.array(order[np.concatenate(taken)]))

    return run


def laid_out(members: DataFrame) -> DataFrame:
    """``members`` (``bucket``, ``id``, ``class``) of the buckets that hold several classes, with what they are
    dealt by: whether a row is of its bucket's largest class (``largest``), and the numbers of blocks of that
    class and of the rest (``m1``, ``m2``)."""
    sizes = members.groupBy("bucket", "class").agg(F.count("*").alias("k"))
    top = sizes.groupBy("bucket").agg(F.max(F.struct("k", "class")).alias("top"), F.sum("k").alias("all"))
    top = top.where("all > top.k").select(
        "bucket",
        F.col("top.class").alias("first"),
        F.ceil(F.col("top.k") / BLOCK).alias("m1"),
        F.ceil((F.col("all") - F.col("top.k")) / BLOCK).alias("m2"),
    )
    joined = members.join(materialise(top, "layout"), "bucket")
    return joined.withColumn("largest", F.col("class") == F.col("first")).drop("first")


def dealt(members: DataFrame, rows_per_task: int) -> DataFrame:
    """The rows of ``laid_out`` copied to the units (``bucket``, ``i``, ``j``) that compare them, with their ``task``.

    A bucket of one block of its largest class and one of the rest is one unit and is not copied. In others, items
    of the largest class meet the rest only, so they are copied once per block of the rest, and a stray item in a
    large group of copies costs one comparison with each of them. Tasks follow from the rows as copied, so their
    size is bounded whatever the size of a bucket. ``members`` is read several times.
    """
    whole = F.greatest("m1", "m2") == 1
    own = F.pmod(F.xxhash64("id"), F.when(F.col("largest"), F.col("m1")).otherwise(F.col("m2")))
    copies = F.when(whole, 1).when(F.col("largest"), F.col("m2")).otherwise(F.col("m1") + F.col("m2"))
    rows = members.agg(F.sum(copies)).first()[0] or 0

    def blocks(m: str, unit: Callable) -> Column:
        return F.transform(F.sequence(F.lit(0).cast("bigint"), F.col(m) - 1), unit)

    def unit(i: Column, j: Column) -> Column:
        return F.struct(i.alias("i"), j.alias("j"))

    # Units of the rest with the largest class have a negative ``i``.
    cut = members.where(~whole).withColumn("own", own)
    units = F.when(F.col("largest"), blocks("m2", lambda k: unit(-1 - k, F.col("own")))).otherwise(
        F.concat(
            blocks("m1", lambda k: unit(-1 - F.col("own"), k)),
            blocks("m2", lambda k: unit(F.least("own", k), F.greatest("own", k))),
        )
    )
    zero = F.lit(0).cast("bigint")
    alone = members.where(whole).select("*", zero.alias("i"), zero.alias("j"))
    spread = alone.union(cut.select("*", F.inline(units)).drop("own"))
    return spread.withColumn("task", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(rows // rows_per_task + 1)))


def links_in_buckets(
    members: DataFrame,
    compare: Compare | Callable[..., Asking],
    rows_per_task: int,
    decide: Decide | None = None,
    beside: Sequence[DataFrame] = (),
) -> DataFrame:
    """Links (``a``, ``b``) that connect what ``compare`` links within the buckets of ``members``.

    ``members`` is ``laid_out``; items of one class are connected already. What ``compare`` reads is there or in the
    tables ``beside``, one row per ``id``, which are joined to the rows once these are dealt. Per task at most one
    link for each item is returned. With ``decide``, ``compare`` asks for pairs, and those of all units of a task
    are decided at once.
    """
    rows = dealt(members, rows_per_task)
    for table in beside:
        rows = rows.join(table, "id")
    return rows.groupBy("task").applyInArrow(_units(compare, decide), "a bigint, b bigint")


def picked_in_buckets(members: DataFrame, pick: Pick, rows_per_task: int) -> DataFrame:
    """The rows of ``members`` (``laid_out``, and what ``pick`` reads) that ``pick`` takes in any of their units."""
    grouped = dealt(members, rows_per_task).groupBy("task")
    return grouped.applyInArrow(_picks(pick, members.columns), members.schema).dropDuplicates(["bucket", "id"])


def by_leaders(members: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Verified links of each bucket's leader, and what they leave open.

    ``members`` is ``shared_buckets`` of rows (``bucket``, ``id``). Each bucket's leader is compared with its
    other items, about one comparison per item, which connects most of a group of copies. Items in many large
    buckets are in the middle of their group and lead. Returned are links of each item with the smallest one that the
    verified ones connect it with, and the ``members`` (with ``class``) of buckets whose items, less the leader, are
    not all connected.
    """
    central = members.groupBy("id").agg(F.sum("n").alias("central"))
    ranked = materialise(members.join(central, "id").select("bucket", "id", "n", "central"), "ranked")
    rank = F.struct(-F.col("central"), F.xxhash64("id"), F.col("id").alias("leader"))
    leaders = ranked.groupBy("bucket").agg(F.min(rank)["leader"].alias("leader"))
    led = materialise(ranked.join(leaders, "bucket").where("id != leader").select("bucket", "id", "n", "leader"), "led")
    pairs = led.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()
    discard(ranked)
    links = materialise(verify(pairs).select("a", "b"), "links")
    groups = materialise(connected_components(links), "groups")
    classed = led.join(groups, F.col("id") == F.col("node"), "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("class")
    )
    open_ = materialise(laid_out(classed), "open")
    discard(led, links)
    return groups.select(F.col("node").alias("a"), F.col("component").alias("b")), open_
