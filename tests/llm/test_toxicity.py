"""The models, the curve and the scores."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import toxicity
from tallyline.llm.queries import op3_toxicity

ORDINARY = ["the", "river", "runs", "past", "a", "quiet", "mill", "and", "old", "trees"]
BAD = ["grobnaka", "grobnily", "grobnosse", "grobnet"]


def corpus(n, rng):
    rows = []
    for i in range(n):
        words = list(rng.choice(ORDINARY, 40))
        toxic = int(i % 4 == 0)
        if toxic:
            words[3::10] = rng.choice(BAD[:3], 4)
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = corpus(200, np.random.default_rng(1))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    return toxicity.train(df.drop("toxic"), df.select("doc_id", "toxic"))


def test_estimates_of_a_context_sum_to_one():
    groups = {g for w in ("idea", "ideal", "idle", "tide", "side") for g in toxicity.letter_groups(w)}
    shared = toxicity._shared(groups)
    contexts = {}
    for group, p in shared.items():
        contexts[group[:-1]] = contexts.get(group[:-1], 0) + p
    # What is missing is the share of letters that never follow the context.
    assert all(0 < p <= 1 + 1e-9 for p in contexts.values())
    assert all(0 < p < 1 for p in shared.values())


def test_rare_forms_are_judged_by_their_parts(model):
    assert model.word("grobnet") > 1 and abs(model.word("river")) < 0.5


def test_scores_rows_and_nulls(documents, model):
    df = documents(None, "", "123", "the quiet river", "you grobnet", "you grobnet").withColumn("score", F.lit("x"))
    rows = toxicity.score(df, model).orderBy("doc_id").collect()
    scores = [r["score"] for r in rows]
    assert scores[0] == scores[1] == scores[2] and max(scores[:4]) < 0.5 < scores[4] == scores[5] <= 1
    long = toxicity.score(documents("the quiet river " * 20000), model).first()["score"]
    assert 0 <= long < 0.5
    assert toxicity.score(documents().limit(0), model).count() == 0


def test_training_without_labels_or_with_odd_ones(spark, documents):
    df = documents("one two", "three", None)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert len({r["score"] for r in toxicity.score(df, toxicity.train(df, none)).collect()}) == 1
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0), (77, 1)], "doc_id bigint, toxic int")
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(df, toxicity.train(df, odd)).collect())


def test_curve():
    x = np.concatenate([np.full(50, -1.0), np.full(50, 2.0)])
    slope, intercept = toxicity.fit_curve(x, (x > 0).astype(float))
    assert -slope + intercept < 0 < 2 * slope + intercept
    assert toxicity.fit_curve(np.ones(3), np.zeros(3)) == (10.0, math.log(0.5 / 3.5))


def test_query_learns_nothing_from_held_out_labels(spark, sf_dir):
    rows = op3_toxicity(spark, sf_dir).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = labels.withColumn(
        "toxic", F.when(toxicity.fold("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    again = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, turned)).collect()
    assert {r["doc_id"]: r["score"] for r in again} == pytest.approx({r["doc_id"]: r["score"] for r in rows})


def test_held_out_documents_are_told_apart(spark):
    base = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    held = [r for r in op3_toxicity(spark, base).collect() if r["held_out"] and r["doc_id"] in labels]
    found = [r["predicted"] for r in held if labels[r["doc_id"]] == 1]
    wrong = [r["predicted"] for r in held if labels[r["doc_id"]] == 0]
    # A third of the toxic documents there carry no word that occurs in another one.
    assert sum(found) > 0.5 * len(found) and sum(wrong) < 0.02 * len(wrong)


def test_tables_give_the_shared_estimate(spark):
    words = ("idea", "ideal", "idle", "tide", "side", "über", "ideas")
    groups = sorted({g for w in words for g in toxicity.letter_groups(w)})
    table = toxicity.shared_estimates(spark.createDataFrame([(g,) for g in groups], "gram string"))
    assert {r["gram"]: r["p"] for r in table.collect()} == pytest.approx(toxicity._shared(set(groups)))


def test_a_group_counted_once_among_millions_counts(spark):
    rows = [(g, 3_000_000, 0) for g in toxicity.letter_groups("river")]
    rows += [(g, 0, 1) for g in toxicity.letter_groups("grobnak")]
    model = toxicity.estimate(spark.createDataFrame(rows, "gram string, n0 bigint, n1 bigint"))
    assert model.groups.count() == len(rows)
    assert model.word("grobnak") > 1


def test_words_not_sent_are_joined(documents, model, monkeypatch):
    df = documents("the quiet river grobnet", "you grobnet grobnet", "you grobnet grobnet", "old trees")
    whole = [r["score"] for r in toxicity.score(df, model).orderBy("doc_id").collect()]
    monkeypatch.setattr(toxicity, "SENT_WORDS", 1)
    assert [r["score"] for r in toxicity.score(df, model).orderBy("doc_id").collect()] == pytest.approx(whole)


def test_words_that_are_not_sent_are_shuffled_once(documents, model, monkeypatch):
    """Each row counts its own; scores are the same whether words are sent or joined."""
    docs = documents("the quiet river the the mill", "you grobnet grobnet", "you grobnet grobnet", None)
    sent = [r["score"] for r in toxicity.score(docs, model).orderBy("doc_id").collect()]
    plans = {}

    def spy(df, name, write=toxicity.materialise):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(toxicity, "SENT_WORDS", 1)
    monkeypatch.setattr(toxicity, "materialise", spy)
    joined = [r["score"] for r in toxicity.score(docs, model).orderBy("doc_id").collect()]
    assert joined == pytest.approx(sent) and len(sent) == 4
    assert "Exchange hashpartitioning(digest" in plans["text-ratios"]
    assert not any("word" in line for line in plans["text-ratios"].splitlines() if "hashpartitioning(digest" in line)
