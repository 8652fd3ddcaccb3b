"""Byte-level BPE by a file of ranks, merged with a segment tree.

The leaves of a word's tree are its byte positions. A leaf holds the rank of the pair that starts there, packed with
the position, so that the smallest value at the root is the leftmost pair of the lowest rank. A merge joins a part
with its live neighbour on the right and changes three leaves: the joined part's, that of the neighbour it took in,
and that of the live neighbour on the left. Each change is carried up to the root, one step per level.

Short words of one length are merged side by side, in one array of trees; longer ones have a tree of their own.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.textmap import with_text_columns
from tallyline.llm.word_split import split_words, tiktoken_class

# Bytes of the longest word that is merged side by side with others.
SHORT = 64
# Words merged side by side.
AT_ONCE = 4096
# Bytes of the words whose ids a worker keeps, about; past it the store starts anew.
CACHED_BYTES = 64 << 20
ENTRY_BYTES = 200
NONE = 1 << 60


class Ranks(dict):
    """Tokens by rank; as a mapping, from a word to its ids as little-endian bytes."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes_of = {rank: token for token, rank in self.rank.items()}
        self.first = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        found = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        keys = np.fromiter(found.keys(), np.int64, len(found))
        order = keys.argsort()
        self.pair_keys, self.pair_ranks = keys[order], np.fromiter(found.values(), np.int64, len(found))[order]
        self.kept_bytes = 0

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NONE)

    def merge_side_by_side(self, parts: np.ndarray) -> list[bytes]:
        """Ids of each row of ``parts``, the ids of a word's bytes; one tree per row."""
        n, length = parts.shape
        size = 1 << length.bit_length()
        tree = np.full((n, 2 * size), NONE * 2, np.int64)
        place = np.arange(length - 1)
        ranks = self.rank_of(parts[:, :-1], parts[:, 1:])
        tree[:, size : size + length - 1] = np.where(ranks < NONE, ranks * size + place, NONE * 2)
        width = size // 2
        while width:
            tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])
            width //= 2
        parts = parts.copy()
        after = np.tile(np.arange(1, length + 2), (n, 1))
        before = np.tile(np.arange(-1, length), (n, 1))
        row = np.arange(n)
        while len(row := row[tree[row, 1] < NONE]):
            rank, at = np.divmod(tree[row, 1], size)
            gone = after[row, at]
            following = after[row, gone]
            parts[row, at], parts[row, gone] = rank, -1
            after[row, at], before[row, following] = following, at
            leaf = np.full((3, len(row)), NONE * 2)
            some = following < length
            joined = self.rank_of(rank[some], parts[row[some], following[some]])
            leaf[0, some] = np.where(joined < NONE, joined * size + at[some], NONE * 2)
            left = before[row, at]
            some = left >= 0
            joined = self.rank_of(parts[row[some], left[some]], rank[some])
            leaf[2, some] = np.where(joined < NONE, joined * size + left[some], NONE * 2)
            # A word's first part has no left neighbour; its own leaf is written once more instead.
            leaf[2, ~some] = leaf[0, ~some]
            node = size + np.stack([at, gone, np.where(some, left, at)])
            tree[row, node] = leaf
            while node[0, 0] > 1:
                node >>= 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
        live = parts >= 0
        flat, ends = parts[live].astype("<u4").tobytes(), 4 * np.cumsum(live.sum(1))
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def merge_alone(self, word: bytes) -> bytes:
        """Ids of one word of any length."""
        rank_of, bytes_of, length = self.rank.get, self.bytes_of, len(word)
        size = 1 << length.bit_length()
        parts = self.first[np.frombuffer(word, np.uint8)].tolist()
        tree = [NONE] * (2 * size)

        def pair(left: int, right: int) -> int:
            rank = rank_of(bytes_of[parts[left]] + bytes_of[parts[right]])
            return NONE if rank is None else rank * size + left

        for i in range(length - 1):
            tree[size + i] = pair(i, i + 1)
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def change(leaf: int, value: int) -> None:
            node = size + leaf
            tree[node] = value
            while node > 1:
                node >>= 1
                least = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == least:
                    return
                tree[node] = least

        after, before = list(range(1, length + 2)), list(range(-1, length))
        while tree[1] < NONE:
            rank, at = divmod(tree[1], size)
            gone = after[at]
            following = after[gone]
            parts[at], parts[gone] = rank, -1
            after[at], before[following] = following, at
            change(gone, NONE)
            change(at, pair(at, following) if following < length else NONE)
            if before[at] >= 0:
                change(before[at], pair(before[at], at))
        return np.array([p for p in parts if p >= 0], "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Store the ids of ``words``. A word that is a token needs no merge."""
        by_length: dict[int, list[tuple[str, bytes]]] = defaultdict(list)
        for word in words - self.keys():
            raw = word.encode()
            rank = self.rank.get(raw)
            if rank is not None:
                self[word] = rank.to_bytes(4, "little")
            elif len(raw) > SHORT:
                self[word] = self.merge_alone(raw)
            else:
                by_length[len(raw)].append((word, raw))
            self.kept_bytes += ENTRY_BYTES + 5 * len(raw)
        for length, group in by_length.items():
            for start in range(0, len(group), AT_ONCE):
                chunk = group[start : start + AT_ONCE]
                raw = np.frombuffer(b"".join(raw for _, raw in chunk), np.uint8)
                merged = self.merge_side_by_side(self.first[raw].reshape(len(chunk), length))
                self.update(zip((word for word, _ in chunk), merged))

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text, as little-endian bytes."""
        if self.kept_bytes > CACHED_BYTES:
            self.clear()
            self.kept_bytes = 0
        words = [split_words(text, tiktoken_class) for text in texts]
        self.learn(set().union(*words))
        return [b"".join(map(self.__getitem__, ws)) for ws in words]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def load(path: str) -> Ranks:
    return Ranks(path)


def id_lists(encoded: list[bytes]) -> pa.Array:
    """Lists of ids from their little-endian bytes."""
    ends = np.cumsum([0, *(len(e) // 4 for e in encoded)], dtype=np.int32)
    flat = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(flat)).cast(pa.list_(pa.int32()))


def encode(df: DataFrame, ranks: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with the token ids of its texts in a column ``ids`` (array of int).

    ``ranks`` is the path of a file of tokens and their ranks, which every executor must be able to open. Strings of
    special tokens are ordinary text. With ``decoded``, a column of that name gets the bytes that the ids stand for,
    decoded in the same task. A null text counts as empty and gets an empty list; a text of any length is encoded
    whole; repeated rows are encoded alike; an empty table gives an empty one. Existing columns of these names are
    replaced.
    """
    schema = f"`{ids}` array<int>" + (f", `{decoded}` binary" if decoded else "")

    def make():
        vocabulary = load(ranks)

        def encode_all(texts):
            encoded = vocabulary.encode(t or "" for t in texts)
            columns = [id_lists(encoded)]
            if decoded:
                columns.append(pa.array([vocabulary.decode(np.frombuffer(e, "<u4")) for e in encoded], pa.binary()))
            return columns

        return encode_all

    return with_text_columns(df, text, schema, make)


def decode(df: DataFrame, ranks: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its token ids stand for in a column ``decoded``.

    Null ids give no bytes, an id outside the vocabulary is an error, and an existing column of the name is replaced.
    """

    @F.pandas_udf("binary")
    def all_bytes(column):
        vocabulary = load(ranks)
        return column.map(lambda x: b"" if x is None else vocabulary.decode(np.asarray(x)))

    return df.withColumn(decoded, all_bytes(ids))
