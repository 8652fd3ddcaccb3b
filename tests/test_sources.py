import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from tallyline.sources import (
    append_literal_rows,
    append_rows,
    discard,
    literal_table,
    load_tuple_dump,
    materialise,
    replace_table,
    scratch_path,
)
from tallyline.sources import sinks

PLAN = (
    T.StructType()
    .add("plan_id", T.IntegerType())
    .add("plan_name", T.StringType())
    .add("price", T.DecimalType(5, 2))
    .add("since", T.DateType())
)

DUMP = """\
CREATE TABLE plans (
  plan_id INTEGER
);

INSERT INTO plans
  (plan_id, plan_name, price, since)
VALUES
  ('0', 'free (trial), 7 days', '0', '2020-01-01'),
  (1, 'it''s monthly' ,9.90, '2020-02-29'),
\t('2','', null,NULL),
  ('3', 'null', '199', '9999-12-31')
  ;
  ('4', 'too late', '1', '2021-02-29'),
  ('5', 'too dear', '1234567.00', '2021-02-01'),
  ('x', 'both', 'y', '2021-02-01'),
  ('6', 'short', '1'),
  ('7', 'long', '1', '2021-02-01', '8'),
  ('8', 'unclosed', '1', '2021-02-01',
  ('9', 'stray quote'', '1', '2021-02-01'),
  ('10', 'last', '10.5', '2021-12-31');
"""


def test_dump_rows_and_rejects(spark, tmp_path):
    path = tmp_path / "plans.sql"
    path.write_text(DUMP)
    rows, rejects = load_tuple_dump(spark, str(path), PLAN)
    assert rows.schema.simpleString() == PLAN.simpleString()
    got = sorted(map(tuple, rows.collect()))
    # The header line with the column names is in parentheses too and is reported, not loaded.
    assert got == [
        (0, "free (trial), 7 days", Decimal("0.00"), dt.date(2020, 1, 1)),
        (1, "it's monthly", Decimal("9.90"), dt.date(2020, 2, 29)),
        (2, "", None, None),
        (3, "null", Decimal("199.00"), dt.date(9999, 12, 31)),
        (10, "last", Decimal("10.50"), dt.date(2021, 12, 31)),
    ]
    reasons = {r.value.strip()[:6]: r.reason for r in rejects.collect()}
    assert reasons == {
        "(plan_": "bad value for plan_id, price, since",
        "('4', ": "bad value for since",
        "('5', ": "bad value for price",
        "('x', ": "bad value for plan_id, price",
        "('6', ": "wrong number of fields",
        "('7', ": "wrong number of fields",
        "('8', ": "malformed tuple",
        "('9', ": "malformed tuple",
    }


def test_every_tuple_is_either_loaded_or_rejected(spark, tmp_path):
    path = tmp_path / "plans.sql"
    path.write_text(DUMP)
    rows, rejects = load_tuple_dump(spark, str(path), PLAN)
    candidates = sum(line.strip().startswith("(") for line in DUMP.splitlines())
    assert rows.count() + rejects.count() == candidates


SHAPES = """\
INSERT INTO plans VALUES (3, 'x', 1, NULL);
insert into plans values(4, 'a; b', 2, '2021-01-01'), (5, 'two
lines, (6, ''not a tuple'')', 3, NULL),
(7, now(), 4, NULL), (8, 'after a call', 5, NULL)  ,  (9 'no comma', 6, NULL), (10, 'w', 7, NULL);
-- it's a remark (with parentheses)
CREATE TABLE other (k INTEGER, v VARCHAR(20));
(11, 'its quote is open, 8, NULL),
(12, 'found again', 9, NULL),
(13, '', 10, NULL)"""


def test_tuples_anywhere_in_a_statement(spark, tmp_path):
    path = tmp_path / "plans.sql"
    path.write_text(SHAPES)
    rows, rejects = load_tuple_dump(spark, str(path), PLAN)
    assert {r.plan_id: r.plan_name for r in rows.collect()} == {
        3: "x", 4: "a; b", 5: "two\nlines, (6, 'not a tuple')", 8: "after a call", 10: "w", 12: "found again", 13: "",
    }
    assert sorted((r.value.strip(" ,"), r.reason) for r in rejects.collect()) == [
        ("(11, 'its quote is open, 8, NULL)", "malformed tuple"),
        ("(7, now(), 4, NULL)", "malformed tuple"),
        ("(9 'no comma', 6, NULL)", "malformed tuple"),
    ]


def test_a_finer_separator_and_long_texts(spark, tmp_path):
    path = tmp_path / "plans.sql"
    long = "it''s " * 200_000
    path.write_text("INSERT INTO plans VALUES\n" + ",\n".join(f"({i}, '{long}', {i}, NULL)" for i in range(5)) + ";\n")
    for separator in (";\n", ",\n"):
        rows, rejects = load_tuple_dump(spark, str(path), PLAN, separator)
        assert sorted((r.plan_id, len(r.plan_name)) for r in rows.collect()) == [(i, 1_000_000) for i in range(5)]
        assert rejects.count() == 0


def test_a_dump_without_tuples(spark, tmp_path):
    path = tmp_path / "plans.sql"
    path.write_text("CREATE TABLE t (k INTEGER);\n")
    rows, rejects = load_tuple_dump(spark, str(path), PLAN)
    assert rows.count() == rejects.count() == 0


def test_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert replace_table(first, path).count() == 2
    assert sorted(r.k for r in append_rows(first.limit(1), path).collect()) == [1, 1, 2]
    empty = literal_table(spark, [], first.schema)
    assert replace_table(empty, path).count() == 0
    assert replace_table(first, path).schema.simpleString() == "struct<k:int,v:string>"


def test_append_literal_rows_keeps_types(spark):
    base = spark.createDataFrame([(1, Decimal("2.50"))], "k bigint, p decimal(5,2)")
    both = append_literal_rows(base, [(2, None), (3, Decimal("1.25"))])
    assert both.dtypes == base.dtypes
    assert sorted(r.k for r in both.collect()) == [1, 2, 3]


def test_literal_tables_are_local(spark):
    table = literal_table(spark, [(1, dt.datetime(2024, 1, 1))], "k int, t timestamp_ntz")
    assert "LocalTableScan" in table._jdf.queryExecution().executedPlan().toString()
    assert table.first().t == dt.datetime(2024, 1, 1)
    assert literal_table(spark, [(n,) for n in range(1001)], "k int").count() == 1001


class _Context:
    applicationId = "app"

    def __init__(self, master, checkpoint_dir=None):
        self.master, self.checkpoint_dir = master, checkpoint_dir

    def getCheckpointDir(self):
        return self.checkpoint_dir

    def setCheckpointDir(self, path):
        self.checkpoint_dir = path


class _Session:
    """Stands in for sessions with other settings than the one the tests share."""

    def __init__(self, master, configured=None):
        self.sparkContext = _Context(master)
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}


def test_materialised_table_is_read_from_the_shared_folder(spark):
    table = materialise(spark.range(5), "five")
    assert table.count() == 5
    assert all(sinks.shared_dir(spark) in name for name in table.inputFiles())
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_replaced_table_can_be_discarded(spark):
    five, six = materialise(spark.range(5), "five"), materialise(spark.range(6), "six")
    path = spark._jvm.org.apache.hadoop.fs.Path(five.inputFiles()[0])
    discard(five, spark.range(2))
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    assert six.count() == 6


def test_the_folder_named_by_the_session_wins():
    session = _Session("yarn", "hdfs://shared/points/")
    assert scratch_path(session, "t").startswith("hdfs://shared/points/tallyline/app/t-")


def test_without_one_the_warehouse_is_shared():
    session = _Session("yarn")
    session.conf["spark.sql.warehouse.dir"] = "hdfs://house/"
    assert sinks.shared_dir(session) == "hdfs://house/shared"


def test_a_session_can_drop_what_it_wrote(spark):
    other = materialise(spark.range(3), "three")
    assert other.count() == 3
    path = other.inputFiles()[0]
    sinks.drop_scratch(spark)
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)
