"""Table maintenance: replace, append, and results written once to be read several times."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.sources.tables import literal_table


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or one in the warehouse where it is unset.

    The warehouse is the place that a session already shares for its own tables, so nothing is ever written
    to a folder that only one machine sees.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/") if configured else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared"


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as the whole content of ``path`` and return a frame reading it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_rows(df: DataFrame, path: str) -> DataFrame:
    """Add the rows of ``df`` to the table at ``path`` and return a frame reading all of it."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_literal_rows(df: DataFrame, rows: Sequence[Sequence]) -> DataFrame:
    """``df`` plus rows written in the program, in the column order of ``df``."""
    return df.unionByName(literal_table(df.sparkSession, rows, df.schema))


def _session_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tallyline/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call returns."""
    return f"{_session_dir(spark)}/{name}-{uuid.uuid4().hex}"


def table_exists(spark: SparkSession, table: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the tables that this session has written to the shared folder; frames that read them end."""
    _delete(spark, _session_dir(spark))


# Where each session has written a named result of input files in a given state.
_STORED: dict[tuple[str, str, str], str] = {}


def files_state(spark: SparkSession, *paths: str) -> str:
    """A text that changes when a file in ``paths`` is written, replaced, added or removed.

    It digests the names, lengths and times of change of the files, whose contents are not read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    # Sums in decimals, as the order in which files are listed must not matter.
    digests = [F.sum(F.xxhash64(F.lit(seed), "path", "modificationTime", "length").cast("decimal(20,0)")) for seed in (1, 2)]
    return "/".join(str(value) for value in files.agg(F.count("*"), *digests).first())


def stored(spark: SparkSession, name: str, inputs: Sequence[str], build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` as a table that a session writes once for each state of the files in ``inputs``.

    All later readers share it until one of the files changes; then it is built anew under another path, and frames
    that read the earlier one stay as they are.
    """
    key = (spark.sparkContext.applicationId, name, f"{sorted(inputs)} {files_state(spark, *inputs)}")
    if key not in _STORED or not table_exists(spark, _STORED[key]):
        path = scratch_path(spark, name)
        table = replace_table(build(), path)
        _STORED[key] = path
        return table
    return spark.read.parquet(_STORED[key])


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` has written, once what was made of them is written itself."""
    for table in tables:
        path = getattr(table, "_scratch_path", None)
        if path:
            _delete(table.sparkSession, path)


# What a query has shuffled can go once its result is written (public setting of Spark 4.1; unknown ones are ignored).
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once into the shared folder and return a frame reading the written table.

    Later readers start from the files, so a lost executor costs a re-read and not a recomputation,
    and each reader prunes columns for itself. Its shuffle files are deleted with the end of the write.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        table = replace_table(df.select("*"), path)
    finally:
        spark.conf.set(CLEANUP, before)
    table._scratch_path = path
    return table
