"""Near-duplicate documents by ProbMinHash over weighted word shingles.

Each distinct shingle of a text is a Poisson process whose rate is its weight. Its arrivals
fall on random registers and each register keeps the shingle that arrived first; a process ends when its next
arrival comes after every register's first. Two texts agree in a register with their probability Jaccard
similarity. Bands of registers give candidates, which are verified by the exact similarity.

A shingle's weight is one plus the logarithm of its occurrences, so a phrase repeated all through a text does not
outweigh the rest of it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.components import connected_components
from tallyline.llm.linking import by_leaders, links_in_buckets, shared_buckets
from tallyline.llm.textmap import slices
from tallyline.sources.sinks import materialise

SHINGLE = 5
THRESHOLD = 0.8
# At similarity 0.8 all bands miss a pair in 3 of a million cases.
BANDS, ROWS = 32, 5
WORD = re.compile(r"\w+")
CACHED_WORDS = 300_000
ROWS_PER_TASK = 4096

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the SplitMix64 finisher, fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingles(texts: list[str | None], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts: number of the text, hash, occurrences; ordered by text and hash.

    Words are lower-cased runs of word characters; a text of fewer words than a shingle has one, its words.
    """
    words = [WORD.findall((t or "").lower()) for t in texts]
    flat = np.fromiter((hashes[w] for ws in words for w in ws), np.uint64, sum(map(len, words)))
    counts = np.array([len(ws) for ws in words])
    starts = np.cumsum(counts) - counts
    n = np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0)
    text = np.repeat(np.arange(len(texts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
    end = np.repeat(starts + counts, n)
    value = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        inside = at + k < end
        word = flat[np.minimum(at + k, len(flat) - 1)] if len(flat) else flat
        value = _mix(value * _ODD + np.where(inside, word, np.uint64(k)))
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    return text[first], value[first], np.diff(np.append(first, len(text)))


def signatures(text: np.ndarray, value: np.ndarray, weight: np.ndarray, n_texts: int) -> np.ndarray:
    """ProbMinHash registers of each text, one row per text: the shingle that arrives first at each."""
    m = BANDS * ROWS
    first = np.full((n_texts, m), np.inf)
    winner = np.zeros((n_texts, m), np.uint64)
    weight = 1 + np.log(weight)
    time = np.zeros(len(text))
    state = value.copy()
    number = np.zeros(1, np.uint64)
    while len(text):
        number += _ODD
        drawn = _mix(state + number)
        uniform = ((drawn >> np.uint64(12)) + np.float64(0.5)) / np.float64(1 << 52)
        time = time - np.log(uniform) / weight
        slot = text * m + (_mix(drawn ^ _ODD) % np.uint64(m)).astype(np.int64)
        flat, owner = first.reshape(-1), winner.reshape(-1)
        np.minimum.at(flat, slot, time)
        won = flat[slot] == time
        owner[slot[won]] = value[won]
        # An arrival after the last of the text's registers was first reached can change nothing any more.
        going = time < first.max(axis=1)[text]
        text, value, weight, time, state = text[going], value[going], weight[going], time[going], state[going]
    return winner


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for part in slices(batches, "text"):
        text, value, count = shingles(part.column("text").to_pylist(), hashes)
        some = np.unique(text)
        sketch = signatures(text, value, count, part.num_rows)
        band = sketch.reshape(-1, BANDS, ROWS)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), band.shape[:2]).copy()
        for r in range(ROWS):
            key = _mix(key * _ODD + band[:, :, r])
        # Texts with the same shingles, each as often, are one class from the start.
        whole = np.zeros((2, part.num_rows), np.uint64)
        pair = _mix(value) + _mix(count.astype(np.uint64) * _ODD + value)
        np.add.at(whole[0], text, _mix(pair))
        np.add.at(whole[1], text, _mix(pair ^ _ODD))
        ids = part.column("id").take(pa.array(some))
        bands = pa.FixedSizeListArray.from_arrays(pa.array(key[some].reshape(-1).view(np.int64)), BANDS)
        yield pa.RecordBatch.from_arrays(
            [ids, *(pa.array(w[some].view(np.int64)) for w in whole), bands.cast(pa.list_(pa.int64()))],
            names=["id", "whole1", "whole2", "bands"],
        )


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for part in slices(batches, "text"):
        text, value, count = shingles(part.column("text").to_pylist(), hashes)
        ends = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (value.view(np.int64), count.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([part.column("id"), *lists], names=["id", "value", "count"])


def probability_jaccard(value_a, count_a, value_b, count_b) -> float:
    """Sum over the common elements of ``1 / sum_j max(a_j / a_i, b_j / b_i)``.

    What an element adds depends on its ratio of weights alone, so elements of one ratio are taken together.
    """
    values, place = np.unique(np.concatenate([value_a, value_b]), return_inverse=True)
    a, b = np.zeros(len(values)), np.zeros(len(values))
    a[place[: len(value_a)]] = 1 + np.log(count_a)
    b[place[len(value_a) :]] = 1 + np.log(count_b)
    with np.errstate(divide="ignore"):
        ratio = b / a
    common = (a > 0) & (b > 0)
    total = 0.0
    for r in np.unique(ratio[common]):
        above = ratio >= r
        total += a[common & (ratio == r)].sum() / (a[~above].sum() + b[above].sum() / r)
    return float(total)


def _similar(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("value_a", "count_a", "value_b", "count_b")]
            linked = [i for i, side in enumerate(zip(*sides)) if probability_jaccard(*side) >= threshold]
            yield batch.select(["a", "b"]).take(pa.array(linked, pa.int64()))

    return run


def _compared(threshold: float):
    """Links among the items of a bucket that are not connected yet.

    Items outside the largest class are compared with all of other classes. An upper bound of the similarity,
    the sum over common shingles of the smaller share of weight, is computed for all at once; pairs that reach
    the threshold by it are computed exactly. A pair whose earlier bands share a bucket is left to that one.
    """

    def run(columns: dict[str, np.ndarray], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names, counts = np.unique(classes, return_counts=True)
        values, weights = columns["value"], [1 + np.log(c) for c in columns["count"]]
        sizes = np.array([len(v) for v in values])
        starts = np.cumsum(sizes) - sizes
        known, flat = np.unique(np.concatenate(values), return_inverse=True)
        shares = np.concatenate([w / w.sum() for w in weights])
        bands = np.stack(columns["bands"])
        before = int(np.flatnonzero((bands == columns["bucket"][0]).all(axis=0))[0])
        left, right = [], []
        mine = np.zeros(len(known))
        done = np.zeros(len(classes), bool)
        for i in np.flatnonzero(classes != names[counts.argmax()]):
            own = flat[starts[i] : starts[i] + sizes[i]]
            mine[own] = shares[starts[i] : starts[i] + sizes[i]]
            bound = np.add.reduceat(np.minimum(mine[flat], shares), starts)
            mine[own] = 0
            done[i] = True
            open_ = (bound >= threshold - 1e-9) & (classes != classes[i]) & ~done
            open_ &= ~(bands[:, :before] == bands[i, :before]).any(axis=1)
            for j in np.flatnonzero(open_):
                if probability_jaccard(values[i], columns["count"][i], values[j], columns["count"][j]) >= threshold:
                    left.append(i)
                    right.append(j)
        return np.array(left, np.int64), np.array(right, np.int64)

    return run


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``key``, ``class_id`` (the smallest key of the group) and ``kept`` for every row of ``df``.

    Texts link if the probability Jaccard similarity of their shingles, weighted by occurrences, is
    ``threshold`` or more; a group is what links connect. Texts without words link with nothing, nor do rows
    without a key, whose class is null and which are kept. Rows with the same key share a class, and one of
    them is kept. An empty table gives an empty frame; other columns are not read.
    """
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    sketched = rows.mapInArrow(_sketched, "id bigint, whole1 bigint, whole2 bigint, bands array<bigint>")
    sketched = materialise(sketched, "sketches")
    same = ["whole1", "whole2"]
    classes = materialise(sketched.groupBy(*same).agg(F.min("id").alias("first")), "classes")
    firsts = sketched.join(classes, same).where("id = first").select("id", "bands")
    members = firsts.select("id", F.explode("bands").alias("bucket"))
    members = materialise(shared_buckets(members), "shared")
    wanted = materialise(members.select("id").distinct(), "wanted")
    texts = rows.join(wanted, "id").dropDuplicates(["id"])
    known = materialise(texts.mapInArrow(_shingled, "id bigint, value array<bigint>, count array<int>"), "shingles")

    def verify(pairs: DataFrame) -> DataFrame:
        def side(name: str) -> DataFrame:
            return known.select(
                F.col("id").alias(name), F.col("value").alias(f"value_{name}"), F.col("count").alias(f"count_{name}")
            )

        return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_similar(threshold), "a bigint, b bigint")

    links, left = by_leaders(members, verify)
    more = links_in_buckets(left, _compared(threshold), ROWS_PER_TASK, beside=(known, firsts))
    more = materialise(more, "more")
    groups = connected_components(links.union(more))
    named = sketched.join(classes, ["whole1", "whole2"]).join(groups, F.col("first") == F.col("node"), "left")
    named = named.groupBy(F.col("id").alias("__id")).agg(F.min(F.coalesce("component", "first")).alias("__class"))
    found = df.select(F.col(key)).join(named, F.col(key) == F.col("__id"), "left")
    return found.select(
        F.col(key),
        F.coalesce("__class", F.col(key).cast("bigint")).alias("class_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("class_id"), F.lit(True)))
