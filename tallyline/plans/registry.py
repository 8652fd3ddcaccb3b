"""All named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.plans import clickstream, delivery, ingredients, loading, loyalty, transactions, weekly

Query = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Query] = {
    **loyalty.QUERIES,
    **delivery.QUERIES,
    **ingredients.QUERIES,
    **loading.QUERIES,
    **weekly.QUERIES,
    **clickstream.QUERIES,
    **transactions.QUERIES,
}


def presented(plan: Query) -> Query:
    """The plan with decimals shown as doubles and integers as bigints, as a comparison needs them.

    Only the output is cast: sums, ratios and rounding have been done on decimals.
    """

    def run(spark: SparkSession, base: str) -> DataFrame:
        df = plan(spark, base)

        def shown(field: T.StructField):
            if isinstance(field.dataType, T.DecimalType):
                return F.col(field.name).cast("double").alias(field.name)
            if isinstance(field.dataType, T.IntegralType):
                return F.col(field.name).cast("bigint").alias(field.name)
            return F.col(field.name)

        return df.select(*[shown(f) for f in df.schema.fields])

    run.__name__, run.__doc__ = plan.__name__, plan.__doc__
    return run


QUERIES: dict[str, Query] = {name: presented(plan) for name, plan in PLANS.items()}
