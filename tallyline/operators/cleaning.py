"""Column cleaning as pure transforms: what an in-place UPDATE or ALTER does, without the mutation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import null_if_sentinel, strip_unit


def overwrite_where(df: DataFrame, column: str, condition: Column, value: Column) -> DataFrame:
    """Set ``column`` to ``value`` where ``condition`` holds; a NULL condition leaves the row alone."""
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def retype(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns to new types; a value that does not cast becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(type_name) for name, type_name in types.items()})


def null_sentinels(df: DataFrame, tokens: Mapping[str, Sequence[str]]) -> DataFrame:
    """Turn the texts that stand for "missing" into NULL, with the tokens given per column."""
    return df.withColumns({name: null_if_sentinel(F.col(name), words) for name, words in tokens.items()})


def strip_units(df: DataFrame, column: str, units: Sequence[str], type_name: str) -> DataFrame:
    """Rewrite a "number with unit" text column as a number of ``type_name``."""
    return df.withColumn(column, strip_unit(F.col(column), units, type_name))


def band_by_pattern(col: Column, bands: Mapping[str, str], default: str) -> Column:
    """Label text by the first LIKE pattern it matches; ``default`` for no match and for NULL."""
    label = F.lit(default)
    for pattern, name in reversed(bands.items()):
        label = F.when(col.like(pattern), F.lit(name)).otherwise(label)
    return label
