"""Counts against the tokenizers library, and what the cache saves."""

import random
import uuid

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyline.llm import token_counts
from tallyline.llm.queries import op7_token_counts
from tallyline.sources.sinks import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture
def cache(spark):
    return scratch_path(spark, "counts")


def test_counts_are_the_librarys():
    rnd = random.Random(5)
    letters = "ab ZΣς09 \n\t\x0b\x1c\x85\xa0 éÉ́İ漢²½🙂'sSD!?"
    texts = ["", "It's DON'T we'LL", "a<|startoftext|>b<|endoftext|> <|ENDOFTEXT|>", "ΟΔΟΣ ΣΑΣ", "x" * 4000]
    texts += ["".join(rnd.choices(letters, k=rnd.randint(0, 60))) for _ in range(2000)]
    assert token_counts.WordCounts(PATH).count(texts) == [library(t) for t in texts]


def test_texts_of_one_digest_have_one_count():
    rnd = random.Random(6)
    for _ in range(500):
        words = ["".join(rnd.choices("aB'<|>é", k=rnd.randint(1, 5))) for _ in range(6)]
        spaced = "".join(w + rnd.choice([" ", "\n", "\t\r\n ", "  "]) for w in words)
        assert library(spaced) == library(" ".join(words))


def test_rows_copies_and_nulls(documents, cache):
    df = documents(None, "", " \n", "one two", "one \n two", "one two").withColumn("n_tokens", F.lit("old"))
    rows = token_counts.count_tokens(df, PATH, cache).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in rows] == [0, 0, 0, 2, 2, 2]
    assert rows[0]["text"] is None and rows[4]["text"] == "one \n two"


def test_only_new_texts_are_encoded(spark, documents, cache):
    token_counts.count_tokens(documents("one", "two two"), PATH, cache).collect()
    first = spark.read.parquet(cache)
    assert first.count() == 2
    wrong = first.withColumn("n_tokens", F.col("n_tokens") + 100)
    again = scratch_path(spark, "counts")
    wrong.write.parquet(again)
    rows = token_counts.count_tokens(documents("one", "three"), PATH, again).orderBy("doc_id").collect()
    assert [r["n_tokens"] for r in rows] == [101, 1]
    assert spark.read.parquet(again).count() == 3


def test_counts_of_another_vocabulary_are_not_used(spark, documents, cache):
    token_counts.count_tokens(documents("one"), PATH, cache).collect()
    other = scratch_path(spark, "counts")
    spark.read.parquet(cache).withColumn("version", F.lit(uuid.uuid4().hex)).withColumn(
        "n_tokens", F.lit(9).cast("bigint")
    ).write.parquet(other)
    assert token_counts.count_tokens(documents("one"), PATH, other).first()["n_tokens"] == 1


def test_empty_table(documents, cache):
    assert token_counts.count_tokens(documents().limit(0), PATH, cache).count() == 0


def test_query_against_the_library(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op7_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = library(texts[r["doc_id"]])
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 2048)
        assert r["n_bytes"] == len((texts[r["doc_id"]] or "").encode())
