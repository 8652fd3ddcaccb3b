"""Words of byte-level BPE as a tokenizer library splits them, whatever Unicode version it knows.

Libraries differ in which code points are letters and numbers. Each library is asked for its own classes once per
process; a code point that this module's expressions would class differently is split as one of the library's class.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from functools import lru_cache

import regex
import tiktoken
from tokenizers import Regex, pre_tokenizers

# Fixed value: the pattern that splits text into words before the merges of byte-level vocabularies.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# The same for texts of ASCII and Latin letters only, which the standard library splits faster.
LATIN = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ƿ"
LATIN_TEXT = re.compile(rf"[\t\n\r -~{LATIN}\xa1-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7]*")
LATIN_WORD = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{LATIN}]+| ?[0-9]+| ?[^\s{LATIN}0-9]+|\s+(?!\S)|\s+")

# One code point of each class, the last for what is neither.
CLASSES = {r"\p{L}": "a", r"\p{N}": "1", r"\s": "\t"}
OTHER = "!"


def tiktoken_class(pattern: str, text: str) -> set[str]:
    """Characters of ``text`` that tiktoken's expressions count as ``pattern``. What a pattern does not match is
    dropped in encoding, so the bytes of the matches come back."""
    own_bytes = {bytes([b]): b for b in range(256)}
    encoding = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=own_bytes, special_tokens={})
    return set(bytes(encoding.encode_ordinary(text)).decode())


def tokenizers_class(pattern: str, text: str) -> set[str]:
    """Characters of ``text`` that the expressions of the tokenizers library count as ``pattern``."""
    split = pre_tokenizers.Split(Regex(f"(?:{pattern})+"), "removed", invert=True)
    return set().union(*(piece for piece, _ in split.pre_tokenize_str(text)))


@lru_cache(maxsize=4)
def stand_ins(class_of: Callable[[str, str], set[str]]) -> tuple[re.Pattern | None, dict[int, str]]:
    """Code points that the library classes differently, as a pattern, and one of its class for each."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    theirs = {c: stand_in for pattern, stand_in in CLASSES.items() for c in class_of(pattern, every)}
    mine = {c: stand_in for pattern, stand_in in CLASSES.items() for c in regex.findall(pattern, every)}
    differ = {c: theirs.get(c, OTHER) for c in theirs.keys() | mine.keys() if theirs.get(c) != mine.get(c)}
    if not differ:
        return None, {}
    return re.compile("[" + "".join(map(re.escape, sorted(differ))) + "]"), {ord(c): s for c, s in differ.items()}


def split_words(text: str, class_of: Callable[[str, str], set[str]]) -> list[str]:
    """The words of ``text`` in order; joined they are the text."""
    if LATIN_TEXT.fullmatch(text):
        return LATIN_WORD.findall(text)
    odd, table = stand_ins(class_of)
    if odd is None or not odd.search(text):
        return WORD.findall(text)
    return [text[m.start() : m.end()] for m in WORD.finditer(text.translate(table))]
