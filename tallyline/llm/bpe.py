"""Byte-level BPE: encode whole texts to token ids and decode ids back to text.

A word is held as two contiguous arrays, its parts and the merge ranks of adjacent parts. Merging scans
the ranks for the minimum, deletes the boundary found and refreshes the two ranks beside it. That scan is
quadratic in the word's length, so words past ``SHORT`` bytes keep the same ranks in a heap instead; both
merge the leftmost pair of the lowest rank first and give the same ids.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.textmap import with_text_columns
from tallyline.llm.word_split import split_words, tokenizers_class

SHORT = 64
# Distinct words whose ids a worker keeps; past it the store starts anew.
CACHED_WORDS = 500_000
# Bytes of these words and their ids, about; past them it starts anew as well.
CACHED_BYTES = 64 << 20
ENTRY_BYTES = 200
# Words merged side by side.
AT_ONCE = 8192
NONE = 1 << 60


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable Latin-1 bytes stand for themselves,
    the others, in order, for the letters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(other)) for b in range(256)]


class Vocabulary(dict):
    """Tokens and merges of a vocabulary file; as a mapping, from a word to its ids as little-endian bytes."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"]
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        self.first = np.array([ids[letter] for letter in letters], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        self.rank = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        keys = np.array([a << 32 | b for a, b in self.rank], np.int64)
        order = keys.argsort()
        self.pair_keys, self.pair_ranks = keys[order], np.fromiter(self.rank.values(), np.int64)[order]
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.special_ids = {name: np.array([i], "<u4").tobytes() for name, i in self.special.items()}
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in ids.items()}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        names = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.kept_bytes = 0

    def learn(self, words: set[str]) -> None:
        """Store the ids of ``words``, all at once: words of the same number of bytes are merged side by side."""
        if len(self) + len(words) > CACHED_WORDS or self.kept_bytes > CACHED_BYTES:
            self.clear()
            self.kept_bytes = 0
        by_length: dict[int, list[tuple[str, bytes]]] = defaultdict(list)
        for word in words - self.keys():
            raw = word.encode()
            by_length[len(raw)].append((word, raw))
            self.kept_bytes += ENTRY_BYTES + 5 * len(raw)
        for length, group in by_length.items():
            for start in range(0, len(group), AT_ONCE):
                chunk = group[start : start + AT_ONCE]
                parts = self.first[np.frombuffer(b"".join(raw for _, raw in chunk), np.uint8)]
                parts = parts.reshape(len(chunk), length)
                if length <= SHORT:
                    found = self.merge_short(parts)
                else:
                    found = [np.array(self.merge_long(row), "<u4").tobytes() for row in parts.tolist()]
                self.update(zip((word for word, _ in chunk), found))

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def merge_short(self, parts: np.ndarray) -> list[bytes]:
        """Ids of each row, as bytes. A row is one word's parts; ``ranks`` holds the merge rank of each two neighbours.

        Each pass merges one pair in every row, so the rows keep a common length; a row without a pair left
        is done and leaves.
        """
        done = [b""] * len(parts)
        row = np.arange(len(parts))
        ranks = self.rank_of(parts[:, :-1], parts[:, 1:])
        while len(row):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(row), np.int64)
            best = ranks[np.arange(len(row)), at] if ranks.shape[1] else np.full(len(row), NONE)
            open_rows = best < NONE
            ids, size = parts[~open_rows].astype("<u4").tobytes(), 4 * parts.shape[1]
            for i, r in enumerate(row[~open_rows].tolist()):
                done[r] = ids[i * size : (i + 1) * size]
            row, at, best = row[open_rows], at[open_rows], best[open_rows]
            parts, ranks = parts[open_rows], ranks[open_rows]
            if not len(row):
                break
            each, width = np.arange(len(row)), parts.shape[1]
            parts[each, at] = self.merged[best]
            column = np.arange(width - 1)
            parts = np.take_along_axis(parts, column + (column > at[:, None]), axis=1)
            column = column[:-1]
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), axis=1)
            for left in (at - 1, at):
                near = (left >= 0) & (left < width - 2)
                e, k = each[near], left[near]
                ranks[e, k] = self.rank_of(parts[e, k], parts[e, k + 1])
        return done

    def merge_long(self, parts: list[int]) -> list[int]:
        rank, merged, n = self.rank, self.merged, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j == n or rank.get((parts[i], parts[j])) != r:
                continue
            parts[i], parts[j], after[i] = int(merged[r]), -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n and (r := rank.get((parts[left], parts[right]))) is not None:
                    heapq.heappush(heap, (r, left))
        return [p for p in parts if p >= 0]

    def pieces(self, text: str) -> list[str]:
        """The words of a text, and the special tokens' strings in it, in order."""
        if not any(name in text for name in self.special):
            return split_words(text, tokenizers_class)
        return [
            word
            for piece in self.split.split(text)
            for word in ((piece,) if piece in self.special else split_words(piece, tokenizers_class))
        ]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        pieces = [self.pieces(text) for text in texts]
        self.learn(set().union(*pieces) - self.special.keys())
        self.update(self.special_ids)
        return [b"".join(map(self.__getitem__, words)) for words in pieces]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(
    df: DataFrame,
    vocabulary: str,
    text: str = "text",
    ids: str = "ids",
    raw: str | None = None,
    decoded: str | None = None,
) -> DataFrame:
    """``df`` with the token ids of its texts in a column ``ids`` (array of int).

    With ``raw``, a column of that name gets the ids as little-endian unsigned 32-bit integers (binary), and with
    ``decoded`` one gets the text that they stand for, decoded in the same task. The strings of special tokens inside
    a text become their ids. A null text counts as empty and gets an empty list; a text of any length is encoded
    whole. Repeated rows are encoded alike, an empty table gives an empty one, and existing columns of these names are
    replaced. ``vocabulary`` is the path of the vocabulary file, which every executor must be able to open.
    """
    schema = f"`{ids}` array<int>"
    schema += f", `{raw}` binary" if raw else ""
    schema += f", `{decoded}` string" if decoded else ""

    def make():
        vocab = load(vocabulary)

        def encode_all(texts):
            encoded = vocab.encode(t or "" for t in texts)
            ends = np.cumsum([0, *(len(e) // 4 for e in encoded)], dtype=np.int32)
            flat = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
            columns = [pa.ListArray.from_arrays(ends, pa.array(flat)).cast(pa.list_(pa.int32()))]
            if raw:
                columns.append(pa.array(encoded, pa.binary()))
            if decoded:
                columns.append(pa.array([vocab.decode(np.frombuffer(e, "<u4")) for e in encoded], pa.string()))
            return columns

        return encode_all

    return with_text_columns(df, text, schema, make)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of its token ids in a column ``text``.

    Bytes that are no UTF-8 become U+FFFD; null ids give an empty text; an id outside the vocabulary is an
    error. An empty table gives an empty one. An existing column named ``text`` is replaced.
    """

    @F.pandas_udf("string")
    def decoded(column: pd.Series) -> pd.Series:
        vocab = load(vocabulary)
        return column.map(lambda x: "" if x is None else vocab.decode(np.asarray(x)))

    return df.withColumn(text, decoded(ids))
