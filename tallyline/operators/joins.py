"""Dimension lookups and membership tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich(fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Left join from a fact to a dimension whose key is unique.

    No hint is given: a dimension that Spark measures as small is broadcast, a large one is joined by
    sort-merge, where a hot fact key is split by adaptive skew handling.
    """
    return fact.join(dimension, fact[fact_key] == dimension[dimension_key], "left").drop(
        dimension[dimension_key]
    )


def flag_if_in(df: DataFrame, key: str, members: DataFrame, out: str) -> DataFrame:
    """Add ``out`` = 1 where ``key`` is among the non-null keys of ``members``, else 0."""
    keys = members.where(F.col(key).isNotNull()).select(F.col(key).alias("_member")).distinct()
    joined = df.join(keys, df[key] == keys["_member"], "left")
    return joined.withColumn(out, F.col("_member").isNotNull().cast("int")).drop("_member")


def keep_if_in(df: DataFrame, key: str, members: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among the keys of ``members``."""
    return df.join(members.select(key).distinct(), key, "left_semi")


def keep_if_not_in(df: DataFrame, key: str, members: DataFrame, null_aware: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not among the keys of ``members``; a NULL key is dropped.

    NULL member keys are ignored. With ``null_aware`` they count as NOT IN counts them: with one among the members
    no row is kept, and a NULL key is kept where there are no members at all. Either way this is a plain anti-join
    that shuffles at any size; what decides about NULLs is two counts in a one-value subquery.
    """
    keys = members.where(F.col(key).isNotNull()).select(key).distinct()
    if null_aware:
        no_null = members.agg(F.count_if(F.col(key).isNull()) == 0).scalar()
        no_member = members.agg(F.count("*") == 0).scalar()
        return df.where(no_null & (F.col(key).isNotNull() | no_member)).join(keys, key, "left_anti")
    return df.where(F.col(key).isNotNull()).join(keys, key, "left_anti")
