"""Secret scans in built-in expressions: fixed patterns, and windows of high entropy in longer strings.

Windows slide over each candidate string by one character at a time. The counts of the window's characters
and the sum of ``c * log2(c)`` over them are carried along and changed by the one character that leaves and
the one that enters, so a string costs one step per character. Each character class has its own threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the three base kinds and the least length that counts.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

KINDS = ("assign", "access", "hex", "entropy")

# Strings in which windows are looked at, and the class a string belongs to.
WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
HEX_CLASS = r"^[0-9A-Fa-f]+$"
# Bits per character from which a window is flagged; 20 random letters have about 3.5 (hex) and 4.1 (base64).
HEX_BITS = 3.0
BASE64_BITS = 3.7
# Strings that are no secrets however mixed they look: words and paths without digits, plain numbers,
# identifiers in groups, and keys that call themselves examples.
ALLOWED = (
    r"^[A-Za-z/+_=-]+$",
    r"^[0-9/+_=-]+$",
    r"^[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$",
    r"(?i)example|xxxxxx|placeholder",
)

SPANS = "array<struct<start:int,end:int>>"


def _positions(text: Column, pattern: str) -> Column:
    """Start and end (exclusive), in code points, of the leftmost non-overlapping matches of ``pattern``."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    steps = F.zip_with(
        gaps, found, lambda g, f: F.struct(F.char_length(g).alias("gap"), F.char_length(f).alias("found"))
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(state: Column, s: Column) -> Column:
        begin = state["at"] + s["gap"]
        end = begin + s["found"]
        return F.struct(
            end.alias("at"),
            F.array_append(state["spans"], F.struct(begin.alias("start"), end.alias("end"))).alias("spans"),
        )

    none = F.array().cast(SPANS)
    return F.when(text.rlike(pattern), F.aggregate(steps, start, step, lambda s: s["spans"])).otherwise(none)


def _flagged(candidate: Column, bits: Column) -> Column:
    """Maximal stretches of ``candidate`` covered by windows of at least ``bits`` bits per character."""
    codes = F.transform(F.split(candidate, ""), F.ascii)
    log_sum = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)])
    most = (F.lit(math.log2(WINDOW)) - bits) * WINDOW
    start = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(-1).alias("from"),
        F.lit(-1).alias("to"),
        F.array().cast(SPANS).alias("spans"),
    )

    def step(state: Column, i: Column) -> Column:
        entering = F.get(codes, i)
        leaving = F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(F.lit(-1))
        gained = F.get(state["counts"], entering)
        lost = F.coalesce(F.get(state["counts"], leaving), F.lit(0))
        change = F.when(entering == leaving, F.lit(0.0)).otherwise(
            F.get(log_sum, gained + 1)
            - F.get(log_sum, gained)
            + F.when(leaving >= 0, F.get(log_sum, lost - 1) - F.get(log_sum, lost)).otherwise(F.lit(0.0))
        )
        counts = F.transform(
            state["counts"],
            lambda c, k: c + F.when(k == entering, 1).otherwise(0) - F.when(k == leaving, 1).otherwise(0),
        )
        total = state["sum"] + change
        # A hair of room for the rounding of the carried sum.
        hit = (i >= WINDOW - 1) & (total <= most + 1e-9)
        begins = hit & (i - WINDOW + 1 > state["to"])
        closed = F.array_append(
            state["spans"], F.struct(state["from"].alias("start"), state["to"].alias("end"))
        )
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            F.when(begins, i - WINDOW + 1).otherwise(state["from"]).alias("from"),
            F.when(hit, i + 1).otherwise(state["to"]).alias("to"),
            F.when(begins & (state["from"] >= 0), closed).otherwise(state["spans"]).alias("spans"),
        )

    def finish(state: Column) -> Column:
        last = F.struct(state["from"].alias("start"), state["to"].alias("end"))
        return F.when(state["from"] >= 0, F.array_append(state["spans"], last)).otherwise(state["spans"])

    return F.aggregate(F.sequence(F.lit(0), F.char_length(candidate) - 1), start, step, finish)


def _kind(spans: Column, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            F.lit(kind).alias("kind"),
            s["end"].alias("end"),
        ),
    )


def find_secrets(df: DataFrame, text: str = "text", secrets: str = "secrets") -> DataFrame:
    """``df`` with the spans found in each text in a column ``secrets``.

    The column is an array of (kind, start, end) in code points, end exclusive, by start and then by kind in
    the order of ``KINDS``. Spans of high entropy are added where no base span lies. Null and empty texts
    have none; repeated rows are scanned alike; an existing column named ``secrets`` is replaced.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    # Each select reads what the one before has computed once.
    first = df.drop(secrets).select(
        "*",
        F.when(content.rlike(ASSIGN), F.regexp_extract_all(content, F.lit(ASSIGN), 2)).alias("__values"),
        _positions(content, ASSIGN).alias("__assign"),
        _positions(content, ACCESS).alias("__access"),
        _positions(content, HEX).alias("__hex"),
        F.regexp_extract_all(content, F.lit(CANDIDATE), 0).alias("__candidates"),
        _positions(content, CANDIDATE).alias("__places"),
    )
    base = F.concat(
        _kind(
            F.filter(
                F.col("__assign"), lambda s, i: F.char_length(F.get("__values", i)) >= ASSIGN_LEAST
            ),
            "assign",
        ),
        _kind(F.col("__access"), "access"),
        _kind(F.col("__hex"), "hex"),
    )

    def judged(candidate: Column, place: Column) -> Column:
        allowed = F.lit(False)
        for pattern in ALLOWED:
            allowed = allowed | candidate.rlike(pattern)
        bits = F.when(candidate.rlike(HEX_CLASS), HEX_BITS).otherwise(BASE64_BITS)
        moved = F.transform(
            _flagged(candidate, bits),
            lambda s: F.struct(
                (s["start"] + place["start"]).alias("start"), (s["end"] + place["start"]).alias("end")
            ),
        )
        return F.when(allowed, F.array().cast(SPANS)).otherwise(moved)

    second = first.select(
        *[c for c in first.columns if not c.startswith("__")],
        base.alias("__base"),
        F.flatten(F.zip_with("__candidates", "__places", judged)).alias("__windows"),
    )
    free = F.filter(
        F.col("__windows"),
        lambda w: ~F.exists(F.col("__base"), lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])),
    )
    ordered = F.array_sort(F.concat(F.col("__base"), _kind(free, "entropy")))
    return second.select(
        *[c for c in second.columns if not c.startswith("__")],
        F.transform(
            ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        ).alias(secrets),
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
