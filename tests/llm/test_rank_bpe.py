"""Encoding and decoding by ranks against the tiktoken library."""

import base64
import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyline.llm import rank_bpe, word_split
from tallyline.llm.queries import op11_rank_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = [
    "",
    " ",
    "x<|endoftext|>y <|endoftext|>",
    "It's we'll 'S don'T  two  spaces \n\n tabs\t\r\n end ",
    "a" * 3001,
    " " * 3000 + "x",
    "ab" * 200,
    "漢字かな🙂é́ ²½Ⅷ٣\x00\x1c\x85 　﻿",
    "\U0001dff2'm \U00018f06 \U000323b0\U00011de0",
]


def ids_of(vocabulary, texts):
    return [np.frombuffer(e, "<u4").tolist() for e in vocabulary.encode(texts)]


def test_ids_and_bytes_are_the_librarys(library):
    rnd = random.Random(3)
    letters = "ab Z09 \n\t\x0b\x1c\x1d\x85\xa0 ​é́漢²½Ⅷ🙂'sd!?<|>"
    texts = ODD + ["".join(rnd.choices(letters, k=rnd.randint(0, 90))) for _ in range(2000)]
    vocabulary = rank_bpe.Ranks(PATH)
    for text, ids in zip(texts, ids_of(vocabulary, texts)):
        assert ids == library.encode_ordinary(text)
        assert vocabulary.decode(np.array(ids, np.int64)) == text.encode()


def test_all_planes(library):
    """Code points of every plane, assigned or not, beside letters, numbers and marks."""
    rnd = random.Random(5)
    vocabulary = rank_bpe.Ranks(PATH)
    pool = [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]
    texts = ["".join(rnd.choice([chr(rnd.choice(pool)), "a", "1", "'m", " ", "!"]) for _ in range(12)) for _ in range(6000)]
    assert ids_of(vocabulary, texts) == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("class_of", [word_split.tiktoken_class, word_split.tokenizers_class])
def test_words_join_to_the_text(class_of):
    for text in ODD:
        assert "".join(word_split.split_words(text, class_of)) == text


def test_both_trees_agree():
    vocabulary = rank_bpe.Ranks(PATH)
    rnd = random.Random(1)
    for length in (1, 2, 3, 4, 7, 8, 9, 16, 33, 64):
        words = ["".join(rnd.choices("abeinrst", k=length)).encode() for _ in range(50)] + [b"a" * length]
        rows = np.stack([vocabulary.first[np.frombuffer(w, np.uint8)] for w in words])
        assert vocabulary.merge_side_by_side(rows) == [vocabulary.merge_alone(w) for w in words]


def test_a_full_store_of_words_starts_anew(monkeypatch, library):
    monkeypatch.setattr(rank_bpe, "CACHED_BYTES", 500)
    vocabulary = rank_bpe.Ranks(PATH)
    for text in ("one two three four five", "sixxy seventhly eightfolds", "one two ninely") * 2:
        assert ids_of(vocabulary, [text]) == [library.encode_ordinary(text)]
    assert len(vocabulary) < 8


def test_rows_columns_nulls_and_long_texts(documents, library):
    long = "thereafter Wörter 12 \n" * 30_000
    df = documents(None, "", "same text", "same text", long, *ODD).withColumn("ids", F.lit(7)).withColumn("x", F.lit(1))
    encoded = rank_bpe.encode(df, PATH, decoded="back")
    rows = rank_bpe.decode(encoded, PATH).orderBy("doc_id").collect()
    expected = ["", "", "same text", "same text", long, *ODD]
    assert [bytes(r["decoded"]).decode() for r in rows] == [bytes(r["back"]).decode() for r in rows] == expected
    assert [r["ids"] for r in rows] == [library.encode_ordinary(t) for t in expected]
    assert encoded.columns.count("ids") == 1


def test_empty_table(documents):
    assert rank_bpe.decode(rank_bpe.encode(documents().limit(0), PATH), PATH).count() == 0


def test_unknown_id_is_an_error(spark):
    with pytest.raises(Exception, match="50300"):
        rank_bpe.decode(spark.createDataFrame([([50300],)], "ids array<int>"), PATH).collect()


def test_query_against_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in op11_rank_bpe(spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for row in docs:
        ids = library.encode_ordinary(row["text"] or "")
        expected = (
            len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((row["text"] or "").encode()).hexdigest(),
        )
        r = got[row["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected
