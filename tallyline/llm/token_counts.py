"""Token counts behind a cache: a text is encoded only if no earlier run has counted it.

A text is known by the digest of its normalised content and a count by that digest with the digest of the
vocabulary file. Normalising joins runs of blanks, tabs and line breaks into one blank, which this kind of
vocabulary never sees, so texts that differ in nothing else share one count.
"""

from __future__ import annotations

import hashlib
import os
import re
import unicodedata
from functools import lru_cache

import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.textmap import with_text_columns

# Fixed value: the pattern by which the vocabulary's words are found in lower-case text.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# The same for texts of ASCII and Latin letters only, which the standard library splits faster.
LATIN = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ƿ"
LATIN_TEXT = re.compile(rf"[\t\n\r -~{LATIN}\xa1-\xb1\xb4\xb6-\xb8\xbb\xbf\xd7\xf7]*")
LATIN_WORD = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LATIN}]+|[0-9]|[^\s{LATIN}0-9]+")

CACHED_WORDS = 500_000

CACHE_SCHEMA = "digest string, version string, n_tokens bigint"


class WordCounts(dict):
    """Number of tokens of each word, as the tokenizers library gives it."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        names = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(names, key=len, reverse=True))))

    def words(self, text: str) -> list[str]:
        # The library lowers letter by letter, so a capital sigma has one lower form wherever it stands.
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return (LATIN_WORD if LATIN_TEXT.fullmatch(lowered) else WORD).findall(lowered)

    def count(self, texts: list[str]) -> list[int]:
        parts = [self.special.split(text) for text in texts]
        words = [[word for piece in pieces for word in self.words(piece)] for pieces in parts]
        distinct = set().union(*words)
        if len(self) + len(distinct) > CACHED_WORDS:
            self.clear()
        new = list(distinct - self.keys())
        encoded = self.library.encode_batch_fast(new, add_special_tokens=False)
        self.update(zip(new, map(len, encoded)))
        return [sum(map(self.__getitem__, w)) + len(p) - 1 for w, p in zip(words, parts)]


@lru_cache(maxsize=2)
def counter(path: str) -> WordCounts:
    return WordCounts(path)


def content_digest(text: str | Column) -> Column:
    """SHA-256 of the normalised content; a null text counts as empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.sha2(F.trim(F.regexp_replace(F.coalesce(column, F.lit("")), r"[ \t\r\n]+", " ")), 256)


def vocabulary_version(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored counts of one vocabulary, one row per digest; none where the table is not there yet.

    A run that was repeated may have stored a count twice: equal digests have equal counts.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache) if there else spark.createDataFrame([], CACHE_SCHEMA)
    stored = stored.where(F.col("version") == version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def fill_cache(df: DataFrame, vocabulary: str, cache: str, text: str = "text") -> None:
    """Count the distinct texts of ``df`` that the table at ``cache`` lacks and append them to it."""
    version = vocabulary_version(vocabulary)
    texts = df.select(content_digest(text).alias("digest"), F.coalesce(text, F.lit("")).alias("text"))
    # Copies are dropped before and after the exchange, so a text that fills a third of all rows is one row
    # per task, and the join with the stored digests needs no exchange of the texts of its own.
    distinct = texts.dropDuplicates(["digest"])
    misses = distinct.join(read_cache(df.sparkSession, cache, version), "digest", "left_anti")

    def make():
        counts = counter(vocabulary)
        return lambda values: [counts.count(values)]

    counted = with_text_columns(misses, "text", "n_tokens bigint", make)
    counted.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)


def count_tokens(
    df: DataFrame, vocabulary: str, cache: str, text: str = "text", count: str = "n_tokens"
) -> DataFrame:
    """``df`` with the number of tokens of each text in a column ``count`` (bigint).

    ``cache`` is the path of the table of counts, which is made or extended when this is called. Counts are
    those of the tokenizers library without added special tokens; special strings inside a text count as one
    token each. Null and empty texts have 0 tokens; copies share one count; a column named ``count`` is
    replaced.
    """
    fill_cache(df, vocabulary, cache, text)
    stored = read_cache(df.sparkSession, cache, vocabulary_version(vocabulary))
    stored = stored.select(F.col("digest").alias("__digest"), F.col("n_tokens").alias("__count"))
    keyed = df.drop(count).withColumn("__digest", content_digest(text))
    return keyed.join(stored, "__digest").withColumnRenamed("__count", count).drop("__digest")
