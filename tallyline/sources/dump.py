"""Loader for text dumps: statements that hold parenthesised tuples of literals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What ends a statement. A text that holds it is cut there, and both parts are rejected.
SEPARATOR = ";\n"

# A quoted literal with doubled inner quotes, which may go on over lines, or a bare number or NULL. All repetitions
# are possessive: a field can be read in one way only, and a long one takes no stack.
_QUOTED = r"'[^']*+(?:''[^']*+)*+'"
_FIELD = rf"(?:{_QUOTED}|[^',()\s]++)"
_TUPLE = rf"\(\s*{_FIELD}(?:\s*,\s*{_FIELD})*+\s*\)"
# What is closed but no tuple of literals, and what is never closed, which goes to the end of its line.
_CLOSED = rf"\((?:{_QUOTED}|[^'()\n]|\([^'()\n]*+\))*+\)"
_OPEN = r"\([^\n]*+"
# A tuple begins a line, or follows the word VALUES or another tuple's comma.
_START = r"(?:(?dm:^)|(?<=(?i:values))|(?<=\)[ \t]{0,16},))[ \t]*+"
_PIECE = rf"{_START}(?:{_TUPLE}|{_CLOSED}|{_OPEN})[ \t]*+[,;]?"
_WHOLE_PIECE = rf"^[ \t]*+{_TUPLE}[ \t]*+[,;]?$"

_BODY = r"(?s)^\s*\((.*)\)\s*[,;]?\s*$"


def _literal(field: Column) -> Column:
    quoted = field.startswith("'")
    text = F.replace(F.substring(field, F.lit(2), F.char_length(field) - 2), F.lit("''"), F.lit("'"))
    return F.when(quoted, text).when(F.upper(field) != "NULL", field)


def parse_tuple_dump(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Find the tuples in dump text (column ``value``: statements or lines) and split them into a typed table and
    the rejected ones.

    Tuples stand at the start of a line, after the word VALUES or after the comma that ends another one, so several
    may share a line, and quoted texts may hold line breaks; other text is skipped. A tuple is rejected when it is
    malformed, has the wrong number of fields, or holds a value that does not cast to its column's type: each one
    found is in exactly one of the results. After a quote or parenthesis that is never closed, reading goes on with
    the next line. Returns ``(rows, rejects)`` where rejects has ``value``, the tuple's text, and ``reason``. Each
    row of ``lines`` is parsed on its own, so any split between statements gives the same rows.
    """
    names = schema.fieldNames()
    piece = F.col("piece")
    body = F.regexp_extract(piece, _BODY, 1)
    parsed = F.struct(
        piece.rlike(_WHOLE_PIECE).alias("well_formed"),
        F.transform(F.regexp_extract_all(body, F.lit(rf"({_FIELD})"), 1), _literal).alias("literals"),
    )
    pieces = lines.select(F.explode(F.regexp_extract_all("value", F.lit(_PIECE), 0)).alias("piece"))
    # Exploding a one-item array keeps the regular expressions below the filters on their results;
    # a plain projection would be copied into every such filter and evaluated many times per tuple.
    tuples = pieces.select(piece.alias("value"), F.explode(F.array(parsed)).alias("parsed"))
    literals = [F.get("parsed.literals", F.lit(i)) for i in range(len(names))]
    values = [literal.try_cast(field.dataType) for literal, field in zip(literals, schema.fields)]
    bad = [literal.isNotNull() & value.isNull() for literal, value in zip(literals, values)]
    complete = F.size("parsed.literals") == len(names)
    accepted = F.col("parsed.well_formed") & complete
    for column_is_bad in bad:
        accepted = accepted & ~column_is_bad
    bad_columns = F.concat_ws(", ", *[F.when(is_bad, name) for is_bad, name in zip(bad, names)])
    reason = (
        F.when(~F.col("parsed.well_formed"), "malformed tuple")
        .when(~complete, "wrong number of fields")
        .otherwise(F.concat(F.lit("bad value for "), bad_columns))
    )
    return (
        tuples.where(accepted).select(*[value.alias(name) for value, name in zip(values, names)]),
        tuples.where(~accepted).select("value", reason.alias("reason")),
    )


def load_tuple_dump(
    spark: SparkSession, path: str, schema: T.StructType, separator: str = SEPARATOR
) -> tuple[DataFrame, DataFrame]:
    """``parse_tuple_dump`` over the text file or folder at ``path``.

    A row is what lies between two ``separator`` texts, so files are split between statements. Where one statement
    holds more than a task should, a separator between its tuples, such as a comma with a line break, cuts it finer;
    no tuple may hold the separator in a quoted text.
    """
    return parse_tuple_dump(spark.read.option("lineSep", separator).text(path), schema)
