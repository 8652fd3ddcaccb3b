"""Every named query against its SQL when one order, product, customer and visit hold a third of the rows.

Broadcasting is off and the limits for a skewed partition are tiny, so that joins shuffle and are split.
"""

import duckdb
import pytest

from compare import TABLES, assert_matches, connect
from tallyline.plans.registry import QUERIES

SOURCE = "/root/testdata/sf0.001"

HOT = {
    "lineitem": """
        SELECT * REPLACE (CASE WHEN (l_suppkey + l_linenumber) % 3 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey,
                          CASE WHEN (l_suppkey + l_orderkey) % 3 = 0 THEN 9 ELSE l_partkey END AS l_partkey)
        FROM source""",
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 1 THEN 1 ELSE o_custkey END AS o_custkey) FROM source",
    "events": """
        SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id,
                          CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-09 11:00:00' + to_seconds(event_id * 7)
                               ELSE ts END AS ts)
        FROM source""",
}

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.files.maxPartitionBytes": "20k",
    "spark.sql.files.openCostInBytes": "1",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("hot"))
    for name in TABLES:
        con = duckdb.connect()
        con.execute(f"CREATE VIEW source AS SELECT * FROM '{SOURCE}/{name}.parquet'")
        con.execute(
            f"COPY ({HOT.get(name, 'SELECT * FROM source')}) "
            f"TO '{base}/{name}.parquet' (ROW_GROUP_SIZE 2048)"
        )
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield base, connect(base)
    for key in SETTINGS:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle_under_skew(spark, hot, name):
    base, con = hot
    assert_matches(spark, con, base, name)


def test_a_hot_join_is_split(spark, hot):
    result = QUERIES["favourite_item_per_customer"](spark, hot[0])
    result.collect()
    assert "SortMergeJoin(skew=true)" in result._jdf.queryExecution().executedPlan().toString()
