"""Toxicity from two class-conditional Kneser-Ney models.

Words are scored letter by letter. Each class has its own discounted counts of ``ORDER`` letters; what it has
not seen falls back to lower orders that both classes share and that count in how many contexts letters occur,
so a rare form is judged by the parts it has in common with frequent ones. A text's log-likelihoods under the
toxic and the ordinary model are normalised by its number of words and compared, and a logistic curve fitted
on labelled documents that the models have not seen turns the difference into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.textmap import slices
from tallyline.sources.sinks import discard, materialise

ORDER = 5
WORD = re.compile(r"[^\W\d_]+")
FOLDS = 5
# Of the training folds this one fits the curve and the others the models.
CURVE_FOLD = 4
# Labelled documents the curve is fitted on, about; all others of the training folds count in the models.
CURVE_DOCUMENTS = 20_000
# Log-likelihood ratio up to which a word says nothing; beyond, it counts by the rest. Ordinary words lie within,
# and the small differences of many of them would hide a few words that matter.
EVEN = 2.5
TASK_GROUPS = 500_000
# Words that are scored in one task, with the ratios of their letter groups.
WORDS_PER_TASK = 100_000
# Most frequent words, whose scores are sent to the tasks; all others are joined.
SENT_WORDS = 100_000


def fold(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS, F.lit(1)).cast("int")


def letter_groups(word: str) -> list[str]:
    padded = " " * (ORDER - 1) + word + " "
    return [padded[i : i + ORDER] for i in range(len(word) + 1)]


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with a class (0 or 1) to counts of letter groups per class."""

    def batch() -> pa.RecordBatch:
        groups = list(ordinary.keys() | toxic.keys())
        columns = [groups, [ordinary[g] for g in groups], [toxic[g] for g in groups]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "n0", "n1"])

    ordinary, toxic = Counter(), Counter()
    for part in slices(batches, "text"):
        words = (Counter(), Counter())
        for text, label in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
            words[label].update(words_of(text))
        for counted, groups in zip(words, (ordinary, toxic)):
            for word, n in counted.items():
                for group in letter_groups(word):
                    groups[group] += n
        if len(ordinary) + len(toxic) > TASK_GROUPS:
            yield batch()
            ordinary, toxic = Counter(), Counter()
    yield batch()


def _shared(groups: set[str]) -> dict[str, float]:
    """Kneser-Ney estimate of the last letter of each group of ``ORDER`` from its shorter endings.

    The count of an ending is the number of distinct letters before it.
    """
    levels: list[Counter] = []
    longer: set[str] = groups
    for _ in range(ORDER - 1):
        counted = Counter(g[1:] for g in longer)
        levels.append(counted)
        longer = set(counted)
    letters = levels[-1]
    total = sum(letters.values())
    estimate = {letter: n / total for letter, n in letters.items()}
    for counted in reversed(levels[:-1]):
        discount = _discount(counted.values())
        sums, kinds = Counter(), Counter()
        for group, n in counted.items():
            sums[group[:-1]] += n
            kinds[group[:-1]] += 1
        estimate = {
            group: (max(n - discount, 0) + discount * kinds[group[:-1]] * estimate[group[1:]]) / sums[group[:-1]]
            for group, n in counted.items()
        }
    return estimate


def _discount(counts) -> float:
    seen = Counter(n for n in counts if n <= 2)
    return min(0.95, max(0.1, seen[1] / (seen[1] + 2 * seen[2]))) if seen[1] else 0.75


def _discount_of(counts: DataFrame, *columns: str) -> list[float]:
    wanted = [F.sum((F.col(c) == n).cast("bigint")) for c in columns for n in (1, 2)]
    seen = [n or 0 for n in counts.agg(*wanted).first()]
    return [
        min(0.95, max(0.1, one / (one + 2 * two))) if one else 0.75 for one, two in zip(seen[::2], seen[1::2])
    ]


def _ending(gram: str) -> Column:
    return F.expr(f"substring({gram}, 2)")


def _context(gram: str) -> Column:
    return F.expr(f"left({gram}, char_length({gram}) - 1)")


def shared_estimates(grams: DataFrame) -> DataFrame:
    """``_shared`` of the letter groups in ``grams`` as a table (``gram`` of ``ORDER`` - 1 letters, ``p``)."""
    levels, longer = [], grams
    for _ in range(ORDER - 1):
        longer = materialise(longer.groupBy(_ending("gram").alias("gram")).agg(F.count("*").alias("n")), "endings")
        levels.append(longer)
    total = levels[-1].agg(F.sum("n")).first()[0] or 1
    lower = levels[-1].select("gram", (F.col("n") / total).alias("p"))
    for counted in reversed(levels[:-1]):
        discount = _discount_of(counted, "n")[0]
        counted = counted.withColumn("context", _context("gram")).withColumn("ending", _ending("gram"))
        sums = counted.groupBy("context").agg(F.sum("n").alias("sum"), F.count("*").alias("kinds"))
        rest = discount * F.col("kinds") * F.col("p")
        p = (F.greatest(F.col("n") - discount, F.lit(0.0)) + rest) / F.col("sum")
        joined = counted.join(sums, "context").join(lower.withColumnRenamed("gram", "ending"), "ending")
        shorter, lower = lower, materialise(joined.select("gram", p.alias("p")), "shared")
        discard(shorter)
    discard(*levels)
    return lower


@dataclass
class Model:
    """Log-likelihood ratios (toxic to ordinary) of letter groups, and of unseen letters after a context.

    Both are tables (``gram``, ``ratio``) that grow with what was counted.
    """

    groups: DataFrame
    contexts: DataFrame
    slope: float = 10.0
    intercept: float = 0.0

    def words(self, words: DataFrame) -> DataFrame:
        """``word`` and ``ratio`` of different words: their log-likelihood ratio, what lies within ``EVEN`` taken off."""
        tasks = words.count() // WORDS_PER_TASK + 1
        dealt = words.select("word", F.pmod(F.xxhash64("word"), F.lit(tasks)).alias("task"))
        # Each task asks once for a letter group, however many of its words have it, so what all words begin with is
        # asked for by the tasks and not by the words.
        asked = dealt.repartition("task").mapInArrow(_asked, "task bigint, gram string")
        asked = asked.withColumn("context", _context("gram"))
        contexts = self.contexts.select(F.col("gram").alias("context"), F.col("ratio").alias("other"))
        found = asked.join(self.groups, "gram", "left").join(contexts, "context", "left")
        found = found.select("task", "gram", F.coalesce("ratio", "other", F.lit(0.0)).alias("ratio"))
        sums = dealt.groupBy("task").cogroup(found.groupBy("task")).applyInArrow(_sums, "word string, sum double")
        ratio = F.signum("sum") * F.greatest(F.abs("sum") - EVEN, F.lit(0.0))
        return sums.select("word", ratio.alias("ratio"))

    def word(self, word: str) -> float:
        spark = self.groups.sparkSession
        return self.words(spark.createDataFrame([(word,)], "word string")).first()["ratio"]

    def score(self, ratio: Column) -> Column:
        x = F.greatest(F.lit(-500.0), F.least(F.lit(500.0), self.slope * ratio + self.intercept))
        return 1 / (1 + F.exp(-x))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their tasks to the letter groups that each task needs, now and then one twice."""

    def batch() -> pa.RecordBatch:
        columns = [pa.array([t for t, _ in asked], pa.int64()), pa.array([g for _, g in asked], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["task", "gram"])

    asked: set[tuple[int, str]] = set()
    for part in batches:
        for piece in slices(iter([part]), "word"):
            for word, task in zip(piece.column("word").to_pylist(), piece.column("task").to_pylist()):
                asked.update((task, group) for group in letter_groups(word))
            if len(asked) > TASK_GROUPS:
                yield batch()
                asked = set()
    yield batch()


def _sums(words: pa.Table, groups: pa.Table) -> pa.Table:
    """Words of a task and the ratios it has asked for to the sum of each word."""
    ratio = dict(zip(groups.column("gram").to_pylist(), groups.column("ratio").to_pylist()))
    names = words.column("word")
    sums = [sum(ratio[group] for group in letter_groups(word)) for word in names.to_pylist()]
    return pa.table({"word": names, "sum": pa.array(sums, pa.float64())})


def estimate(grams: DataFrame) -> Model:
    """The two models from all counts (``gram``, ``n0`` ordinary, ``n1`` toxic)."""
    lowest = shared_estimates(grams)
    shared = lowest.select(F.col("gram").alias("ending"), "p")
    discounts = _discount_of(grams, "n0", "n1")
    grams = grams.withColumn("context", _context("gram")).withColumn("ending", _ending("gram"))
    each = [F.sum(f"n{k}").alias(f"sum{k}") for k in (0, 1)]
    each += [F.sum((F.col(f"n{k}") > 0).cast("bigint")).alias(f"kinds{k}") for k in (0, 1)]
    sums = materialise(grams.groupBy("context").agg(*each), "contexts")
    n, total, kinds = ([F.col(f"{c}{k}") for k in (0, 1)] for c in ("n", "sum", "kinds"))
    rest = [F.when(total[k] > 0, F.log(discounts[k] * kinds[k] / total[k])).otherwise(0.0) for k in (0, 1)]
    contexts = sums.select(F.col("context").alias("gram"), (rest[1] - rest[0]).alias("ratio"))
    logs = []
    for k in (0, 1):
        own = F.greatest(n[k] - discounts[k], F.lit(0.0)) + discounts[k] * kinds[k] * F.col("p")
        logs.append(F.when(total[k] > 0, F.log(own / total[k])).otherwise(F.log("p")))
    joined = grams.join(sums, "context").join(shared, "ending")
    groups = materialise(joined.select("gram", (logs[1] - logs[0]).alias("ratio")), "ratios")
    model = Model(groups, materialise(contexts, "context-ratios"))
    discard(sums, lowest)
    return model


def fit_curve(ratios: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the logistic curve; without both classes a set slope and the smoothed odds."""
    positive = int(toxic.sum())
    if positive in (0, len(toxic)):
        return 10.0, math.log((positive + 0.5) / (len(toxic) - positive + 0.5))
    center, scale = ratios.mean(), ratios.std() or 1.0
    x = np.column_stack([(ratios - center) / scale, np.ones(len(ratios))])
    w, ridge = np.zeros(2), np.diag([1e-2, 1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (toxic - p) - ridge @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1] - w[0] * center / scale)


def train(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The model learned from the rows of ``df`` that have a label in ``labels`` and lie in no held-out fold.

    A key with several labels counts as toxic if one of them says so; null labels and keys are left out.
    Without any labelled row all scores come out alike.
    """
    known = labels.where(F.col(label).isNotNull() & (fold(key) != 0)).groupBy(F.col(key).alias("key"))
    known = known.agg((F.max(label) == 1).cast("int").alias("toxic"))
    rows = df.where(fold(key) != 0).select(F.col(key).alias("key"), F.col(text).alias("text"))
    labelled = rows.join(known.hint("merge"), "key").select("text", "toxic", fold("key").alias("fold"), F.xxhash64("key").alias("h"))
    # Labels have no bound on their size, so they are joined by a shuffle at any size. Both fits read what is
    # written of it.
    labelled = materialise(labelled, "labelled")
    counted = labelled.where(F.col("fold") != CURVE_FOLD).select("text", "toxic")
    grams = counted.mapInArrow(_count, "gram string, n0 bigint, n1 bigint").groupBy("gram")
    grams = materialise(grams.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "grams")
    model = estimate(grams)
    curve = labelled.where(F.col("fold") == CURVE_FOLD)
    share = min(1.0, CURVE_DOCUMENTS / max(1, curve.count()))
    drawn = curve.where(F.pmod("h", F.lit(1_000_000)) < share * 1_000_000).select("text", "toxic")
    drawn = drawn.withColumn("digest", _digest("text"))
    ratios = text_ratios(drawn, model, "text")
    seen = drawn.select("digest", "toxic").join(ratios, "digest", "left")
    seen = seen.select(F.coalesce("ratio", F.lit(0.0)).alias("ratio"), "toxic").toArrow()
    if seen.num_rows:
        model.slope, model.intercept = fit_curve(
            seen.column("ratio").to_numpy(), seen.column("toxic").to_numpy().astype(np.float64)
        )
    discard(labelled, grams, ratios)
    return model


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.col(text)))


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to their words and how often they occur."""

    def batch() -> pa.RecordBatch:
        columns = [pa.array(counted.keys(), pa.string()), pa.array(counted.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    counted = Counter()
    for part in slices(batches, "text"):
        for text in part.column("text").to_pylist():
            counted.update(words_of(text))
        if len(counted) > TASK_GROUPS:
            yield batch()
            counted = Counter()
    yield batch()


def text_ratios(df: DataFrame, model: Model, text: str) -> DataFrame:
    """``digest`` and ``ratio`` of the different texts that have words: the difference of the log-likelihoods per word.

    Rows of one text add alike to its sum and to its number of words.
    """
    texts = df.select(F.col(text).alias("text"))
    words = texts.mapInArrow(_distinct_words, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    words = materialise(words, "words")
    scored = materialise(model.words(words), "word-ratios")
    frequent = words.orderBy(F.desc("n"), "word").limit(SENT_WORDS)
    chosen = materialise(scored.join(frequent.hint("merge"), "word").select("word", "ratio"), "sent-words")
    sent = chosen.toArrow()
    discard(words, chosen)
    sent = df.sparkSession.sparkContext.broadcast(dict(zip(*(sent.column(c).to_pylist() for c in ("word", "ratio")))))

    counts = pa.map_(pa.string(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for part in slices(batches, "text"):
            found = [words_of(t) for t in part.column("text").to_pylist()]
            columns = [
                part.column("digest"),
                pa.array(map(len, found), pa.int64()),
                pa.array([sum(known[w] for w in ws if w in known) for ws in found], pa.float64()),
                pa.array([[*Counter(w for w in ws if w not in known).items()] for ws in found], counts),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "n", "part", "others"])

    read = df.select(_digest(text).alias("digest"), F.col(text).alias("text"))
    parts = read.mapInArrow(run, "digest binary, n bigint, part double, others map<string, bigint>")
    parts = materialise(parts.where("n > 0"), "parts")
    # What a row has of words that were sent, and what its other words add, are summed per text. A row has counted its
    # other words itself, so they are shuffled once, to their ratios.
    others = parts.select("digest", F.explode("others").alias("word", "k"))
    others = others.join(scored, "word").select("digest", F.lit(0).cast("bigint").alias("n"), (F.col("k") * F.col("ratio")).alias("part"))
    each = parts.select("digest", "n", "part").union(others)
    ratios = materialise(each.groupBy("digest").agg((F.sum("part") / F.sum("n")).alias("ratio")), "text-ratios")
    discard(parts, scored)
    return ratios


def score(df: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """``df`` with the toxicity of each text, 0 to 1, in a column ``to``.

    Null and empty texts and texts without letters get the score of an even comparison; repeated rows score
    alike; an existing column named ``to`` is replaced.
    """
    ratios = text_ratios(df, model, text).withColumnRenamed("digest", "__digest")
    ratios = ratios.withColumnRenamed("ratio", "__ratio")
    joined = df.drop(to).withColumn("__of", _digest(text))
    joined = joined.join(ratios.hint("merge"), F.col("__of") == F.col("__digest"), "left")
    scored = model.score(F.coalesce("__ratio", F.lit(0.0)))
    return joined.withColumn(to, scored).drop("__of", "__digest", "__ratio")
