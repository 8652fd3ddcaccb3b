"""Encoding and decoding against the tokenizers library."""

import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyline.llm import bpe
from tallyline.llm.queries import op1_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = [
    "",
    " ",
    "x<|endoftext|>y <|endoftext|><|endoftext|>",
    "<|endoftext|",
    "It's we'll 'S don'T  two  spaces \n\n tabs\t\r\n end ",
    "a" * 5000,
    " " * 3000,
    "ab" * 200,
    "漢字かな🙂é́ ²½Ⅷ٣\x00\x1c\x85 　﻿",
]


def texts():
    rnd = random.Random(3)
    letters = "ab Z09 \n\t\x0b\x1c\x1d\x85\xa0 ​é́漢²½Ⅷ🙂'sd!?<|>"
    return ODD + ["".join(rnd.choices(letters, k=rnd.randint(0, 50))) for _ in range(2000)]


def test_ids_and_texts_are_the_librarys():
    vocabulary = bpe.Vocabulary(PATH)
    for text, ids in zip(texts(), vocabulary.encode(texts())):
        ids = np.frombuffer(ids, "<u4")
        assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
        assert vocabulary.decode(ids) == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


def test_all_planes():
    """Code points of every plane, assigned or not, beside letters, numbers and marks."""
    rnd = random.Random(5)
    pool = [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]
    texts = ["".join(rnd.choice([chr(rnd.choice(pool)), "a", "1", "'m", " ", "!"]) for _ in range(12)) for _ in range(6000)]
    for text, ids in zip(texts, bpe.Vocabulary(PATH).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_short_and_long_merging_agree():
    vocabulary = bpe.Vocabulary(PATH)
    for word in ("thereafter", "aaaaaaaaaaaaaaaaaaaaaaa", "ééééé", " internationalisation", "xyxyxyxyxyx"):
        parts = vocabulary.first[np.frombuffer(word.encode(), np.uint8)]
        short = vocabulary.merge_short(parts[None])[0]
        assert np.frombuffer(short, "<u4").tolist() == vocabulary.merge_long(parts.tolist())


def test_a_full_store_of_words_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 5)
    vocabulary = bpe.Vocabulary(PATH)
    for _ in range(2):
        for text in ("one two three four five six seven", "eight nine <|endoftext|> ten"):
            ids = np.frombuffer(vocabulary.encode([text])[0], "<u4").tolist()
            assert ids == LIBRARY.encode(text, add_special_tokens=False).ids


def test_partial_characters_decode_to_replacements():
    ids = LIBRARY.encode("漢", add_special_tokens=False).ids
    for part in (ids[:1], ids[1:], ids[::-1]):
        assert bpe.load(PATH).decode(np.array(part)) == LIBRARY.decode(part, skip_special_tokens=False)


def test_rows_columns_and_nulls(documents):
    df = documents(None, "", "same text", "same text", *ODD).withColumn("ids", F.lit(7)).withColumn("x", F.lit(1))
    rows = bpe.decode(bpe.encode(df, PATH), PATH).orderBy("doc_id").collect()
    assert [r["decoded"] for r in rows] == ["", "", "same text", "same text", *ODD]
    assert rows[0]["ids"] == [] and rows[2]["ids"] == rows[3]["ids"]
    assert bpe.encode(df, PATH).columns.count("ids") == 1


def test_empty_table(documents):
    assert bpe.decode(bpe.encode(documents().limit(0), PATH), PATH).count() == 0


def test_query_against_the_library(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op1_bpe(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for row in docs:
        ids = LIBRARY.encode(row["text"] or "", add_special_tokens=False).ids
        expected = (
            len(ids),
            hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest(),
        )
        r = got[row["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected


def test_unknown_id_is_an_error(spark):
    with pytest.raises(Exception, match="50300"):
        bpe.decode(spark.createDataFrame([([50300],)], "ids array<int>"), PATH).collect()
