"""Lists kept in strings: exploding, pairing, naming and tallying their items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import list_ids


def explode_list(df: DataFrame, column: str, out: str, sep: str = ",") -> DataFrame:
    """One row per id in the list; rows without ids vanish. The list column is dropped."""
    exploded = df.withColumn(out, F.explode(list_ids(F.col(column), sep)))
    return exploded.where(F.col(out).isNotNull()).drop(column)


def zip_lists(df: DataFrame, first: str, second: str, out_first: str, out_second: str) -> DataFrame:
    """Explode two lists in lockstep, padding the shorter with NULL. Both list columns are dropped."""
    empty = F.array().cast("array<bigint>")
    pairs = F.arrays_zip(
        F.coalesce(list_ids(F.col(first)), empty).alias(out_first),
        F.coalesce(list_ids(F.col(second)), empty).alias(out_second),
    )
    others = [c for c in df.columns if c not in (first, second)]
    return df.select(*others, F.inline(pairs).alias(out_first, out_second))


def signed_tally(
    df: DataFrame,
    keys: Sequence[str],
    element: str,
    base: str,
    removed: str,
    added: str,
    weight: str | None = None,
) -> DataFrame:
    """Net count per key and list element: +1 in ``base``, -1 in ``removed``, +1 in ``added``.

    The three lists of a row are unfolded together, so the input is read and shuffled once. ``weight``
    names a column that counts how many equal lines a row stands for. The sums are combined before the
    shuffle, so a hot key sends one row per element and task.
    """
    lists = F.array(
        *[
            F.struct(list_ids(F.col(column)).alias("ids"), F.lit(sign).cast("bigint").alias("sign"))
            for column, sign in ((base, 1), (removed, -1), (added, 1))
        ]
    )
    n = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    signed = df.select(*keys, n.alias("_n"), F.inline(lists).alias("_ids", "_sign"))
    return (
        explode_ids(signed, "_ids", element)
        .groupBy(*keys, element)
        .agg(F.sum(F.col("_sign") * F.col("_n")).alias("net"))
    )


def net_list(
    df: DataFrame,
    keys: Sequence[str],
    removed: str,
    added: str,
    bases: DataFrame,
    base_key: str,
    base: str,
    names: DataFrame,
    name_key: str,
    name: str,
    out: str,
    weight: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Per key, the net elements of its rows as ``'2xa, b'`` text in order of name.

    Each row brings the list ``base`` that ``bases`` holds for its ``base_key`` (one of ``keys``), less
    its ``removed`` and plus its ``added`` elements; counts of zero or less, elements without a name and keys
    with nothing left are left out. An id that ``names`` repeats shows under each of its names. ``weight``
    names a column that counts how many equal rows a row stands for. With ``parts`` the rows are dealt by their
    keys once, into so many parts in which all else is done, and unfolded lists are never shuffled.
    """
    n = F.sum(weight) if weight else F.count("*")
    bases = bases.select(F.col(base_key).alias("_base_key"), F.col(base).alias("_base"))
    if parts is None:
        alike = df.groupBy(*keys, removed, added).agg(n.alias("_lines"))
        lines = alike.join(bases, alike[base_key] == F.col("_base_key"), "left")
    else:
        based = df.join(bases, df[base_key] == F.col("_base_key"), "left").repartition(parts, *keys)
        lines = based.groupBy(*keys, "_base", removed, added).agg(n.alias("_lines"))
    tally = signed_tally(lines, keys, "_element", "_base", removed, added, weight="_lines").where("net > 0")
    keyed = names.select(F.col(name_key).cast("bigint").alias("_id"), F.col(name).alias("_name"))
    named = tally.join(keyed.where("_name IS NOT NULL"), F.col("_element") == F.col("_id"))
    entry = F.struct(F.col("_name"), _with_count(F.col("net"), F.col("_name")).alias("value"))
    return named.groupBy(*keys).agg(joined_text(entry).alias(out))


def _with_count(net: Column, name: Column) -> Column:
    return F.when(net > 1, F.concat(net.cast("string"), F.lit("x"), name)).otherwise(name)


def explode_ids(df: DataFrame, ids: str, out: str) -> DataFrame:
    return df.withColumn(out, F.explode(ids)).where(F.col(out).isNotNull()).drop(ids)


def name_list(df: DataFrame, column: str, names: DataFrame, key: str, name: str, out: str) -> DataFrame:
    """Replace the ids of a list by their names, in list order, as ``'a, b'`` text; NULL for no names.

    Each distinct list is named once by a join and joined back. Rows without a list match nothing; they are
    dealt out by their other columns, so they do not meet in one task. An id that ``names`` repeats shows all
    its names in order.
    """
    keyed = names.select(F.col(key).cast("bigint").alias("_key"), F.col(name).alias("_name"))
    lists = df.select(F.col(column).alias("_list")).where(F.col("_list").isNotNull()).distinct()
    items = lists.select("_list", F.posexplode(list_ids(F.col("_list"))).alias("_at", "_id"))
    named = items.join(keyed.where("_name IS NOT NULL"), items["_id"] == keyed["_key"])
    texts = named.groupBy("_list").agg(
        joined_text(F.struct(F.col("_at"), F.col("_name").alias("value"))).alias(out)
    )
    # No list holds the character U+0000.
    nowhere = F.concat(F.lit("\0"), F.xxhash64(*df.columns).cast("string"))
    keyed_rows = df.withColumn("_of", F.coalesce(F.col(column), nowhere))
    return keyed_rows.join(texts, F.col("_of") == F.col("_list"), "left").drop("_of", "_list")


def joined_text(entry: Column, sep: str = ", ") -> Column:
    """Aggregate ``struct(<sort keys>, value)`` into the values' text, ordered by the struct."""
    ordered = F.sort_array(F.collect_list(entry))
    return F.array_join(F.transform(ordered, lambda e: e["value"]), sep)


def named_elements(df: DataFrame, element: str, names: DataFrame, key: str) -> DataFrame:
    """Left join of exploded list elements to their dimension, the key cast once before the join."""
    keyed = names.withColumn(key, F.col(key).cast("bigint"))
    return df.join(keyed, df[element] == keyed[key], "left").drop(keyed[key])
