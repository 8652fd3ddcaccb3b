"""Typed table readers and small literal dimensions."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Scan ``<base_dir>/<name>.parquet`` with its declared schema, so no footer is read to infer one."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{base_dir}/{name}.parquet")


# Bytes of a table's files that one task should have to group.
PART_BYTES = 2 << 20


def parts_of(spark: SparkSession, base_dir: str, name: str) -> int:
    """Into how many parts rows derived from a table are dealt so that a task's share does not grow with the table.

    Adaptive execution joins partitions until they hold 64 MB as they are shuffled; equal texts and near numbers
    shrink so much there that the groups of one such partition take gigabytes. The file sizes are looked up, no job runs.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base_dir}/{name}.parquet")
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(spark.sparkContext.defaultParallelism, math.ceil(size / PART_BYTES))


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType | str) -> DataFrame:
    """Typed table from rows written in the program.

    Built from an Arrow table, which Spark keeps as a local relation of known size: joins to it
    are broadcast on measured size, without a hint and without a Python-backed scan.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow_schema = to_arrow_schema(schema)
    arrays = [pa.array(list(values), type=field.type) for values, field in zip(columns, arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow_schema), schema=schema)
