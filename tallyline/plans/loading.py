"""Loading a text dump of tuples, over a dump file rendered from the orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.sources import load_tuple_dump, read_table, scratch_path

ORDER_DUMP = T.StructType(
    [
        T.StructField("order_id", T.IntegerType()),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("placed_on", T.DateType()),
        T.StructField("total", T.DecimalType(12, 2)),
        T.StructField("priority", T.StringType()),
    ]
)


def rendered_dump(spark: SparkSession, base: str) -> DataFrame:
    """Every order as a dump tuple, about a thousand to a statement.

    Some follow the word VALUES on its line, some hold a line break in their text or a NULL total, and some are
    broken in one of three ways.
    """
    key = F.col("o_orderkey")

    def quoted(col: Column) -> Column:
        return F.concat(F.lit("'"), F.replace(col, F.lit("'"), F.lit("''")), F.lit("'"))

    placed = F.when(key % 50 == 7, "not a date").otherwise(F.to_date("o_orderdate").cast("string"))
    total = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    priority = F.concat(F.col("o_orderpriority"), F.when(key % 10 == 3, ", it's\ndue").otherwise(""))
    fields = F.concat_ws(
        ", ",
        quoted(key.cast("string")),
        F.when(key % 3 == 0, F.col("o_custkey").cast("string")).otherwise(
            quoted(F.col("o_custkey").cast("string"))
        ),
        F.when(key % 50 != 9, quoted(placed)),
        F.when(key % 20 == 0, "null").otherwise(quoted(total)),
        quoted(priority),
    )
    closing = F.when(key % 50 == 11, "").when(key % 1000 == 0, ");").otherwise("),")
    opening = F.when(key % 7 == 2, "INSERT INTO orders VALUES").otherwise("")
    return read_table(spark, base, "orders").select(F.concat(opening, F.lit("  ("), fields, closing).alias("value"))


def dump_file(spark: SparkSession, base: str) -> str:
    """A new folder with the rendered dump as text files."""
    path = scratch_path(spark, "orders-dump")
    rendered_dump(spark, base).write.text(path)
    return path


def tuple_dump_load(spark: SparkSession, base: str) -> DataFrame:
    rows, _ = load_tuple_dump(spark, dump_file(spark, base), ORDER_DUMP)
    return rows


def tuple_dump_rejects(spark: SparkSession, base: str) -> DataFrame:
    _, rejects = load_tuple_dump(spark, dump_file(spark, base), ORDER_DUMP)
    return rejects


QUERIES = {f.__name__: f for f in (tuple_dump_load, tuple_dump_rejects)}
