"""Mixing sources to target weights: complete epochs, then a weighted sample up to each source's budget.

Within a source documents are ordered by Efraimidis-Spirakis keys, ``-ln(u) / weight`` for a hash ``u`` of
the document, which is the order of weighted sampling without replacement. The documents before the point
where the running sum of sizes reaches the budget are taken once more than the complete epochs give.

No task orders a source. Keys are cut into equal shares of their range; the sums per share, of which a
source has at most ``SHARES``, show in which one the budget ends, that share is cut again, and only the
documents in the last share are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.sources.sinks import materialise

WORD = r"[^\x20\x09-\x0D]+"
# Weights of the sources in code point order, repeating; the share of all sizes the mix takes; most epochs.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2

SHARES = 1024
LEVELS = 2


def size_of(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(key: Column) -> Column:
    """A number in (0, 1) that depends on ``key`` alone: 52 bits of its MD5 digest."""
    digits = F.substring(F.md5(F.concat(key.cast("string"), F.lit(":mix"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame) -> DataFrame:
    """Target words of each source from its ``source_size``: shares by weight, none above ``MOST_EPOCHS`` sizes.

    Where a share would exceed that, the excess goes to the others by weight. With the sources in the order of
    cap to weight, those before some point end at their cap and all others get one level times their weight.
    One row per source, and windows over all of them.
    """
    cycle = F.array(*map(F.lit, WEIGHTS))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sizes.select(
        "source",
        "source_size",
        F.element_at(cycle, ((place - 1) % len(WEIGHTS) + 1).cast("int")).cast("bigint").alias("weight"),
        (F.col("source_size") * MOST_EPOCHS).alias("cap"),
    )
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    whole = F.sum("source_size").over(everything) * SHARE
    level = (whole - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    leveled = weighed.select("*", level.alias("level"), F.row_number().over(order).alias("place"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("place", "level"))
    final = F.min(fits).over(everything)["level"]
    return leveled.select(
        "source",
        "source_size",
        F.least(
            F.col("cap").cast("double"), F.coalesce(final * F.col("weight"), F.col("cap").cast("double"))
        ).alias("target"),
    )


def _share(level: int) -> Column:
    """Share of the key at ``level``; keys are exponential, so ``1 - exp(-key)`` spreads them."""
    spread = F.least(1 - F.exp(-F.col("key")), F.lit(1 - 1e-12))
    return F.floor(spread * SHARES**level).cast("bigint") % SHARES


def _same_source(left: str, right: str) -> Column:
    return F.col(f"{left}.source").eqNullSafe(F.col(f"{right}.source"))


def plan_sources(docs: DataFrame) -> DataFrame:
    """Per source its size, target and what is taken: ``epochs`` of all, ``upto`` (once more up to this key),
    and ``fill``, the key of one document further on whose size comes nearest to what is left.

    ``docs`` has ``source``, ``size`` and ``key`` and is read several times.
    """
    sources = materialise(targets(docs.groupBy("source").agg(F.sum("size").alias("source_size"))), "sources")
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("bigint")
    left = sources.select(
        "*", epochs.alias("epochs"), (F.col("target") - epochs * F.col("source_size")).alias("budget")
    )
    # ``open`` holds what remains of the budget and the shares in which it ends so far.
    opened = left.select("source", F.col("budget").alias("open"))
    at: list[str] = []
    for level in range(1, LEVELS + 1):
        inside = docs.alias("d").join(opened.alias("o"), _same_source("d", "o"))
        for i, name in enumerate(at, 1):
            inside = inside.where(_share(i) == F.col(name))
        sums = inside.groupBy("d.source", "open", *at, _share(level).alias(f"at{level}")).agg(
            F.sum("size").alias("size")
        )
        running = Window.partitionBy("source").orderBy(f"at{level}")
        sums = sums.withColumn("until", F.sum("size").over(running))
        ends = sums.where(F.col("until") > F.col("open"))
        first = ends.withColumn("n", F.row_number().over(running)).where("n = 1")
        at.append(f"at{level}")
        opened = materialise(
            first.select("source", (F.col("open") - F.col("until") + F.col("size")).alias("open"), *at), "share"
        )
    inside = docs.alias("d").join(opened.alias("o"), _same_source("d", "o"))
    for i, name in enumerate(at, 1):
        inside = inside.where(_share(i) == F.col(name))
    by_key = Window.partitionBy("d.source").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    until = inside.select("d.source", "key", "size", "open", F.sum("size").over(by_key).alias("until"))
    # The first key beyond the budget; a source without one is taken whole, which its budget never allows
    # unless all that is left has no words.
    stops = until.where(F.col("until") > F.col("open")).groupBy("source").agg(F.min("key").alias("stop"))
    stopped = left.alias("l").join(stops.alias("s"), _same_source("l", "s"), "left")
    stopped = materialise(stopped.select("l.*", "stop"), "stop")
    rest = docs.alias("d").join(stopped.alias("s"), _same_source("d", "s"))
    below = F.col("stop").isNull() | (F.col("key") < F.col("stop"))
    got = rest.groupBy("d.source").agg(F.coalesce(F.sum(F.when(below, F.col("size"))), F.lit(0)).alias("got"))
    short = stopped.alias("s").join(got.alias("g"), _same_source("s", "g"))
    short = materialise(short.select("s.*", (F.col("budget") - F.col("got")).alias("short")), "short")
    beyond = docs.alias("d").join(short.alias("s"), _same_source("d", "s")).where(F.col("key") >= F.col("stop"))
    miss = F.abs(F.col("short") - F.col("size"))
    fills = (
        beyond.where(miss < F.col("short"))
        .groupBy("d.source")
        .agg(F.min(F.struct(miss.alias("miss"), "key"))["key"].alias("fill"))
    )
    planned = short.alias("s").join(fills.alias("f"), _same_source("s", "f"), "left")
    return planned.select(
        "s.source", "source_size", "target", "epochs", F.col("stop").alias("upto"), "fill"
    )


def mix(
    df: DataFrame, key: str = "doc_id", size: str = "size", source: str = "source", quality: str | None = None
) -> DataFrame:
    """``df`` with ``source_size``, ``target`` and ``times``, how often the mix takes the document.

    ``size`` names the column of words per document (null: 0) and ``quality`` one of positive weights (null or
    absent: 1). Null sources form a source of their own. Rows with the same ``key`` are taken alike, as are
    rows without a key that have the same size; reruns agree. An empty table gives an empty mix; documents
    without words are taken like others and add nothing. Existing columns with the three names are replaced.

    Only keys, sizes and sources are written and ordered; what else ``df`` holds is read once, at the end.
    """
    added = ("source_size", "target", "times")
    words = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    weight = F.coalesce(F.col(quality), F.lit(1.0)) if quality else F.lit(1.0)
    identity = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("size "), words))
    order = -F.ln(uniform(identity)) / weight
    light = materialise(df.select(F.col(source).alias("source"), words.alias("size"), order.alias("key")), "sizes")
    plan = materialise(plan_sources(light), "plan")
    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    kept = [c for c in df.columns if c.lower() not in added]
    last = F.col("__upto").isNull() | (F.col("__order") < F.col("__upto"))
    once_more = (last | F.col("__order").eqNullSafe(F.col("__fill"))) & (F.col("__epochs") < MOST_EPOCHS)
    return (
        df.select(*kept, order.alias("__order"))
        .join(plan, F.col(source).eqNullSafe(F.col("__source")))
        .select(
            *kept,
            F.col("__source_size").alias("source_size"),
            F.col("__target").alias("target"),
            (F.col("__epochs") + once_more.cast("bigint")).alias("times"),
        )
    )


ORACLE = rf"""
WITH quality AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5(d.doc_id::VARCHAR || ':mix'), 1, 13))::BIGINT + 0.5) / 4503599627370496.0)
      / CASE q.quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END AS key
  FROM documents d LEFT JOIN quality q ON d.doc_id = q.doc_id),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight
  FROM sized GROUP BY source),
leveled AS (
  SELECT *, 2 * source_size AS cap, row_number() OVER o AS place,
    ((SELECT sum(source_size) FROM sources)::DOUBLE * 1.5
      - coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM sources WINDOW o AS (ORDER BY 2 * source_size::DOUBLE / weight, source NULLS LAST)),
final AS (SELECT arg_min(level, place) AS level FROM leveled WHERE level * weight <= cap),
budgets AS (
  SELECT source, source_size, least(cap::DOUBLE, f.level * weight) AS target,
    CASE WHEN source_size = 0 THEN 0
      ELSE floor(least(cap::DOUBLE, f.level * weight) / source_size)::BIGINT END AS epochs
  FROM leveled, final f),
ordered AS (
  SELECT s.*, b.source_size, b.target, b.epochs, b.target - b.epochs * b.source_size AS budget,
    sum(size) OVER (PARTITION BY s.source ORDER BY key) AS until
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source),
short AS (
  SELECT source, budget - coalesce(sum(size) FILTER (WHERE until <= budget), 0)::DOUBLE AS short
  FROM ordered GROUP BY source, budget),
fills AS (
  SELECT o.source, arg_min(o.key, (abs(s.short - o.size), o.key)) AS fill
  FROM ordered o JOIN short s ON o.source IS NOT DISTINCT FROM s.source
  WHERE o.until > o.budget AND abs(s.short - o.size) < s.short GROUP BY o.source)
SELECT o.doc_id, o.size, o.source_size, o.target,
  (o.size * (o.epochs + CASE WHEN o.epochs < 2 AND (o.until <= o.budget OR o.key = f.fill) THEN 1 ELSE 0 END))::BIGINT
    AS taken
FROM ordered o LEFT JOIN fills f ON o.source IS NOT DISTINCT FROM f.source
"""
