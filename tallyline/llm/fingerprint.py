"""Threshold-scaled sketches of texts in built-in expressions, and the text that follows a text.

A sketch keeps every shingle hash below a fixed fraction of the hash space. Unlike a sketch of fixed size it
grows with the text, so the sketch of two texts put together is the union of theirs, and a short text's share
in a long one is estimated as well as the share of equals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
# One hash in FRACTION is kept.
FRACTION = 4
# Hashes have 48 bits, written as 12 hexadecimal digits.
BITS = 48

# Rows with neighbouring ids that are put in order together; the number of cuts is bounded as well.
IDS_PER_RANGE = 4_000
MOST_RANGES = 50_000


def _word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _sketch(hashes: Column) -> Column:
    """Kept shingle hashes of a list of word hashes, ascending. Fewer words than a shingle make one shingle."""
    last = F.greatest(F.size(hashes) - SHINGLE, F.lit(0))
    shingles = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(hashes, i + k) for k in range(SHINGLE)]), 64 - BITS),
    )
    kept = F.filter(shingles, lambda h: h < (1 << BITS) // FRACTION)
    # A text of a few words may have no hash below the threshold: its smallest one stands for it.
    sketch = F.when(F.size(kept) > 0, F.array_sort(F.array_distinct(kept))).otherwise(F.array(F.array_min(shingles)))
    return F.when(F.size(hashes) > 0, sketch).otherwise(F.array().cast("array<bigint>"))


def with_sketch(df: DataFrame, text: str = "text", sketch: str = "sketch") -> DataFrame:
    """``df`` with the sketch of each text in a column ``sketch`` (array of bigint).

    Words are lower-cased runs without white space. Null, empty and blank texts have an empty sketch; equal
    texts have equal sketches; an existing column named ``sketch`` is replaced.
    """
    hashed = df.select("*", _word_hashes(F.col(text)).alias("__hashes"))
    others = [c for c in df.columns if c.lower() != sketch.lower()]
    return hashed.select(*others, _sketch(F.col("__hashes")).alias(sketch))


def containment(left: Column, right: Column) -> Column:
    """Estimated share of the smaller text's shingles that the other has; two empty sketches are alike."""
    least = F.least(F.size(left), F.size(right))
    both = F.size(F.array_intersect(left, right))
    alike = F.when((F.size(left) == 0) & (F.size(right) == 0), F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(least > 0, both.cast("double") / least).otherwise(alike)


def resemblance(left: Column, right: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets; two empty sketches are alike."""
    both = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - both
    return F.when(either > 0, both.cast("double") / either).otherwise(F.lit(1.0))


def written(sketch: Column) -> Column:
    """A sketch as text: its hashes in ascending order, 12 hexadecimal digits each."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), BITS // 4, "0"))), "")


def _cuts_below(cuts: list[int], value: Column) -> Column:
    """Number of ``cuts`` (ascending) below ``value``, 0 for null, by bisection."""
    if not cuts:
        return F.lit(0)
    places = F.lit(cuts).cast("array<bigint>")
    middle = lambda s: F.shiftright(s["low"] + s["high"], 1)
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(len(cuts).bit_length())),
        F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high")),
        lambda s, _: F.when(s["low"] >= s["high"], s)
        .when(
            F.get(places, middle(s)) < value,
            F.struct((middle(s) + 1).alias("low"), s["high"].alias("high")),
        )
        .otherwise(F.struct(s["low"].alias("low"), middle(s).alias("high"))),
        lambda s: s["low"],
    )
    return F.when(value.isNull(), 0).otherwise(found)


def with_next(
    df: DataFrame,
    key: str,
    columns: dict[str, str],
    derive: Callable[[DataFrame], DataFrame] = lambda placed: placed,
) -> DataFrame:
    """``df`` with values of the row that follows by ``key``, the first row following the last.

    ``columns`` maps columns to the names their next values get; existing columns of these names are replaced.
    Null keys come first and equal keys are ordered by the carried values. The ids are cut into ranges of
    about ``IDS_PER_RANGE`` rows at approximate quantiles; the rows of the first id of each range are copied
    into the range before it, so each range knows all its followers and rows are moved once. ``derive`` adds
    columns after the rows have been moved, so that these need not be moved as well.
    """
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in columns.values()}]
    ids = df.select(F.col(key).cast("bigint").alias("id"))
    ranges = min(MOST_RANGES, max(1, -(-ids.count() // IDS_PER_RANGE)))
    shares = [i / ranges for i in range(1, ranges)]
    found = ids.select(F.percentile_approx("id", shares, 10 * ranges)).first()[0] if shares else []
    cuts = sorted(set(found or []))

    # One row per range that has rows: its first id and the range before it. There are at most MOST_RANGES.
    firsts = ids.groupBy(_cuts_below(cuts, F.col("id")).alias("range")).agg(
        F.min("id").alias("id"), F.count_if(F.col("id").isNull()).alias("nulls")
    )
    rows = [(r["range"], None if r["nulls"] else r["id"]) for r in firsts.sort("range").collect()]
    guests = df.sparkSession.createDataFrame(
        [(first, rows[i - 1][0]) for i, (_, first) in enumerate(rows)], "__first bigint, __before int"
    )

    own = F.struct(_cuts_below(cuts, F.col(key).cast("bigint")).alias("range"), F.lit(0).alias("guest"))
    copied = F.struct(F.col("__before").alias("range"), F.lit(1).alias("guest"))
    placed = df.join(F.broadcast(guests), F.col(key).eqNullSafe(F.col("__first")), "left").select(
        *kept,
        F.inline(F.array_compact(F.array(own, F.when(F.col("__before").isNotNull(), copied)))).alias(
            "__range", "__guest"
        ),
    )
    placed = derive(placed.repartition("__range"))
    order = Window.partitionBy("__range").orderBy(
        "__guest", F.col(key).asc_nulls_first(), *[F.col(c) for c in columns]
    )
    following = F.lead(F.struct(*[F.col(c) for c in columns])).over(order)
    kept = [c for c in placed.columns if c not in ("__range", "__guest")]
    return (
        placed.select("*", following.alias("__next"))
        .where("__guest = 0")
        .select(*kept, *[F.col(f"__next.{c}").alias(name) for c, name in columns.items()])
    )


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last quarter of code points replaced by as many from the start of ``following``."""
    part = F.floor(F.char_length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - part), F.substring(following, F.lit(1), part))
