"""Text expressions: null sentinels, unit suffixes and lists kept in strings."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if_sentinel(col: Column, tokens: Sequence[str]) -> Column:
    """NULL where the text is exactly one of ``tokens``, else the text unchanged."""
    return F.when(~col.isin(*tokens), col)


def strip_unit(col: Column, units: Sequence[str], type_name: str) -> Column:
    """The number in texts such as ``'12 km'`` or ``'15mins'``; NULL if anything else is in the text."""
    longest_first = "|".join(re.escape(u) for u in sorted(units, key=len, reverse=True))
    number = F.regexp_extract(col, rf"^\s*(-?\d+(?:\.\d+)?)\s*(?:{longest_first})?\s*$", 1)
    return number.try_cast(type_name)


def concat_nulls_as_empty(*cols: Column, sep: str = "") -> Column:
    """Concatenation in which a NULL part counts as the empty text and keeps its separator."""
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])


def list_ids(col: Column, sep: str = ",", type_name: str = "bigint") -> Column:
    """Array of the ids in a list kept as text; NULL stays NULL, an item that is no id becomes NULL.

    The cast ignores blanks around an item. Casting the whole array keeps this in generated code, where a
    per-item lambda is interpreted and several times slower.
    """
    return F.split(col, re.escape(sep)).try_cast(f"array<{type_name}>")


def list_length(col: Column, sep: str = ",") -> Column:
    """Number of ids in a list kept as text; 0 for NULL."""
    return F.coalesce(F.size(F.array_compact(list_ids(col, sep))), F.lit(0))
