"""Sketches, and the text that follows."""

import hashlib
import re

from pyspark.sql import functions as F

from tallyline.llm import fingerprint
from tallyline.llm.queries import op6_fingerprint


def test_equal_texts_and_short_texts(documents):
    long = " ".join(f"w{i}" for i in range(400))
    df = documents(None, "", "  \n", "one", "ONE", "one two", long, long).withColumn("sketch", F.lit(1))
    s = [r["sketch"] for r in fingerprint.with_sketch(df).orderBy("doc_id").collect()]
    assert s[0] == s[1] == s[2] == [] and len(s[3]) == 1 and s[3] == s[4] != s[5] and s[6] == s[7]
    assert s[6] == sorted(set(s[6])) and max(s[6]) < 2**48 // fingerprint.FRACTION
    assert 60 < len(s[6]) < 140


def test_sketch_of_a_part_lies_in_that_of_the_whole(documents):
    words = [f"w{i}" for i in range(2000)]
    df = documents(" ".join(words), " ".join(words[:300]), "other words altogether here and now")
    a, b, c = [r["sketch"] for r in fingerprint.with_sketch(df).orderBy("doc_id").collect()]
    assert set(b) < set(a)
    row = fingerprint.with_sketch(df).agg(F.collect_list("sketch").alias("s")).select(
        fingerprint.containment(F.col("s")[0], F.col("s")[1]), fingerprint.resemblance(F.col("s")[0], F.col("s")[1]),
        fingerprint.containment(F.col("s")[0], F.col("s")[2]), fingerprint.containment(F.array(), F.array()),
    ).first()
    assert row[0] == 1.0 and abs(row[1] - 0.15) < 0.05 and row[2] == 0.0 and row[3] == 1.0


def test_next_row_over_many_ranges(documents, monkeypatch):
    monkeypatch.setattr(fingerprint, "IDS_PER_RANGE", 3)
    keys = [k * k % 101 * 7 for k in range(60)]
    df = documents((None, "null"), *[(k, f"t{k}") for k in keys])
    rows = fingerprint.with_next(df.select("doc_id", "text"), "doc_id", {"text": "next"}).collect()
    order = sorted(((k, t) for k, t in [(None, "null"), *[(k, f"t{k}") for k in keys]]), key=lambda r: (r[0] is not None, r))
    # Rows of one id have equal texts here, so any of their orders gives the same bag.
    expected = sorted((t, order[(i + 1) % len(order)][1]) for i, (_, t) in enumerate(order))
    assert sorted((r["text"], r["next"]) for r in rows) == expected


def test_one_row_follows_itself_and_no_rows_give_none(documents):
    df = documents("only").select("doc_id", "text")
    assert fingerprint.with_next(df, "doc_id", {"text": "next"}).first()["next"] == "only"
    assert fingerprint.with_next(df.limit(0), "doc_id", {"text": "next"}).count() == 0


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    plan = op6_fingerprint(spark, sf_dir)
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())
    got = {r["doc_id"]: r for r in plan.collect()}
    texts = [r["text"] or "" for r in docs]
    for i, row in enumerate(docs):
        text, following = texts[i], texts[(i + 1) % len(texts)]
        part = len(text) // 4
        edited = text[: len(text) - part] + following[:part]
        r = got[row["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    long = [r for r in got.values() if r["n_chars"] > 2000]
    assert min(r["near_edited"] for r in long) > 0.5 > max(r["near_next"] for r in long)
