from __future__ import annotations

import datetime
import glob
import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import assert_same_rows, plan_of, rows
from tablewright.functions.quality import NULLS_AND_ZEROS
from tablewright.operators import quality
from tablewright.session import shared_folder
from tablewright.sinks import datasets as sinks
from tablewright.sources import datasets as sources
from tablewright.sources import generators


@pytest.fixture
def awkward(spark):
    """What a delimited file may lose: nulls, empty text, blanks, quotes, breaks, microseconds."""
    return spark.createDataFrame(
        [
            (1, None, "plain", datetime.datetime(2020, 1, 2, 3, 4, 5, 123456)),
            (2, 0.1, "", datetime.datetime(2020, 1, 2)),
            (3, -0.0, '  say "hi", twice\\ ', None),
            (4, float("inf"), "line\nbreak\r\nand\ttab", datetime.datetime(1999, 12, 31, 23, 59)),
            (None, 1e-300, None, None),
            (6, 3.0, '"', datetime.datetime(2020, 6, 1, 0, 0, 0, 1)),
            (7, 3.0, "\\", None),
            (8, 3.0, '\\"', None),
        ],
        "i int, d double, s string, t timestamp_ntz",
    ).withColumn("z", F.col("t").cast("timestamp"))


@pytest.mark.parametrize("sep", [",", "\t", ";"])
@pytest.mark.parametrize("compression", [None, "gzip"])
@pytest.mark.parametrize("header", [False, True])
def test_delimited_round_trip(spark, awkward, sep, compression, header):
    path = sinks.save_dataset(
        awkward, shared_folder(spark, "csv"), sep=sep, compression=compression, header=header,
        multi_line=True,
    )
    back = sources.read_dataset(
        spark, path, "csv", awkward.schema, sep=sep, header=header, multi_line=True
    )
    assert_same_rows(back, awkward)


@pytest.mark.parametrize("compression", [None, "snappy", "zstd"])
def test_parquet_round_trip(spark, awkward, compression):
    path = sinks.save_dataset(
        awkward, shared_folder(spark, "parquet"), "parquet", compression=compression
    )
    assert_same_rows(sources.read_dataset(spark, path, "parquet", awkward.schema), awkward)
    assert_same_rows(sources.read_dataset(spark, path, "parquet"), awkward)


def test_an_existing_path_is_an_error_unless_overwritten(spark):
    path = sinks.save_dataset(spark.range(3).toDF("id"), shared_folder(spark, "exists"))
    with pytest.raises(AnalysisException):
        sinks.save_dataset(spark.range(5).toDF("id"), path)
    assert sources.read_dataset(spark, path, schema="id long").count() == 3
    sinks.save_dataset(spark.range(5).toDF("id"), path, overwrite=True)
    assert sources.read_dataset(spark, path, schema="id long").count() == 5


def test_bounded_files(spark):
    path = sinks.save_dataset(
        spark.range(0, 1000, numPartitions=1), shared_folder(spark, "parts"), "parquet",
        max_records_per_file=300,
    )
    assert len(glob.glob(f"{path}/part-*")) == 4


def test_a_line_that_does_not_fit_the_schema_is_an_error(spark):
    path = sinks.save_dataset(
        spark.createDataFrame([("1",), ("x",)], "v string"), shared_folder(spark, "misfit")
    )
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_dataset(spark, path, schema="v int").collect()


def test_read_dataset_arguments(spark):
    with pytest.raises(ValueError, match="schema"):
        sources.read_dataset(spark, "/nowhere")
    with pytest.raises(ValueError, match="fmt"):
        sources.read_dataset(spark, "/nowhere", "xml")
    with pytest.raises(ValueError, match="fmt"):
        sinks.save_dataset(spark.range(1), "/nowhere", "xml")


def test_avro_is_left_to_its_package(spark):
    with pytest.raises(Exception, match="(?i)avro"):
        sinks.save_dataset(spark.range(1), shared_folder(spark, "avro"), "avro")


def test_a_declared_schema_prunes_the_scan(spark, folder):
    df = sources.read_dataset(spark, f"{folder}/lineitem.parquet", "parquet", "l_tax double")
    assert "ReadSchema: struct<l_tax:double>" in plan_of(df)


def test_table_round_trip(spark):
    name = "t_" + uuid.uuid4().hex
    path = shared_folder(spark, "table")
    df = spark.range(10).selectExpr("id", "id * 2 AS twice")
    sinks.save_as_table_or_view(df, name, "default", path=path)
    assert_same_rows(sources.read_table(spark, name, "default"), df)
    with pytest.raises(ValueError, match="exists"):
        sinks.save_as_table_or_view(df, name, "default", path=path)
    sinks.save_as_table_or_view(
        df.limit(3), name, "default", drop_if_exists=True, path=shared_folder(spark, "table")
    )
    assert sources.read_table(spark, name, "default").count() == 3
    sinks.drop_table_or_view(spark, name, "default")
    assert not spark.catalog.tableExists(name)


def test_view_round_trip(spark):
    name = "v_" + uuid.uuid4().hex
    df = spark.range(4)
    sinks.save_as_table_or_view(df, name, is_view=True)
    assert sources.read_table(spark, name).count() == 4
    with pytest.raises(ValueError, match="exists"):
        sinks.save_as_table_or_view(df, name, is_view=True)
    sinks.save_as_table_or_view(df.limit(1), name, is_view=True, drop_if_exists=True)
    assert sources.read_table(spark, name).count() == 1
    with pytest.raises(ValueError):
        sinks.save_as_table_or_view(df, name, schema="default", is_view=True)
    sinks.drop_table_or_view(spark, name)
    assert not spark.catalog.tableExists(name)


def test_a_stored_view_makes_way_for_a_table(spark):
    base, name = "b_" + uuid.uuid4().hex, "w_" + uuid.uuid4().hex
    sinks.save_as_table_or_view(spark.range(2), base, path=shared_folder(spark, "base"))
    spark.sql(f"CREATE VIEW {name} AS SELECT * FROM {base}")
    sinks.save_as_table_or_view(
        spark.range(5), name, drop_if_exists=True, path=shared_folder(spark, "table")
    )
    assert sources.read_table(spark, name).count() == 5
    for item in (name, base):
        sinks.drop_table_or_view(spark, item)


def test_write_rejects(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 0.0), (3, None)], "id int, v double")
    bad = quality.split_bad_rows(df, NULLS_AND_ZEROS)[1]
    path = sinks.write_rejects(bad, shared_folder(spark, "rejects"))
    back = sources.read_dataset(spark, path, schema=df.schema)
    assert sorted(rows(back)) == [(2, 0.0), (3, None)]
    unused = shared_folder(spark, "unused")
    assert sinks.write_rejects(bad, unused, enabled=False) is None
    assert not glob.glob(unused)


def test_sequence_source(spark):
    assert rows(generators.sequence_source(spark, 3)) == [("Thing", 1), ("Thing", 2), ("Thing", 3)]
    assert generators.sequence_source(spark).count() == 10
    empty = generators.sequence_source(spark, 0)
    assert empty.count() == 0
    assert empty.dtypes == [("Thing", "string"), ("Number", "bigint")]
    for wrong in (-1, 1.5):
        with pytest.raises(ValueError):
            generators.sequence_source(spark, wrong)


def test_random_source_has_the_asked_shape(spark):
    df = generators.random_source(spark, 1000, 2, 1, 3)
    assert df.count() == 1000
    assert df.dtypes == [
        ("DoubleCol1", "double"), ("DoubleCol2", "double"), ("IntCol1", "int"),
        ("StringCol1", "string"), ("StringCol2", "string"), ("StringCol3", "string"),
    ]
    assert generators.random_source(spark).columns == ["DoubleCol1", "IntCol1", "StringCol1"]


def test_random_source_does_not_depend_on_the_partitions(spark):
    from tablewright.functions.random_cells import random_double, random_int, random_string

    whole = generators.random_source(spark, 2000, seed=3)
    for parts in (1, 8):
        again = spark.range(0, 2000, numPartitions=parts).select(
            random_double(3, F.col("id"), "DoubleCol1"),
            random_int(3, F.col("id"), "IntCol1"),
            random_string(3, F.col("id"), "StringCol1"),
        )
        assert_same_rows(whole, again)


def test_random_source_values(spark):
    df = generators.random_source(spark, 20_000, 2, 1, 1, seed=11)
    stats = df.selectExpr(
        "min(DoubleCol1) lo", "max(DoubleCol1) hi", "avg(DoubleCol1) mean",
        "corr(DoubleCol1, DoubleCol2) corr", "avg(CAST(IntCol1 AS double)) int_mean",
        "min(IntCol1) int_lo", "max(IntCol1) int_hi",
        "count(DISTINCT DoubleCol1) n", "min(length(StringCol1)) l1", "max(length(StringCol1)) l2",
        "count_if(StringCol1 RLIKE '^[!-~]{5}$') printable",
        "count(DISTINCT substring(StringCol1, 5, 1)) letters",
    ).first()
    assert 0 <= stats.lo < 0.001 and 0.999 < stats.hi < 1
    assert abs(stats["mean"] - 0.5) < 0.01 and abs(stats["corr"]) < 0.03
    assert abs(stats.int_mean) < 3e7
    assert stats.int_lo < -2.1e9 and stats.int_hi > 2.1e9
    assert stats.n > 19_990
    assert (stats.l1, stats.l2, stats.printable, stats.letters) == (5, 5, 20_000, 94)


def test_random_source_seeds_differ(spark):
    left = generators.random_source(spark, 100, seed=1)
    right = generators.random_source(spark, 100, seed=2)
    assert left.intersect(right).count() == 0


@pytest.mark.parametrize(
    "arguments", [(0,), (10, 0, 0, 0), (10, -1), (1.5,), (10, 1, 1, 1, "seed")]
)
def test_random_source_arguments(spark, arguments):
    with pytest.raises(ValueError):
        generators.random_source(spark, *arguments)


def test_external_tables_are_read_in_parts(spark):
    with pytest.raises(TypeError):
        sources.read_external_table(spark, "jdbc:none:", "t", "id")
    with pytest.raises(ValueError, match="num_partitions"):
        sources.read_external_table(spark, "jdbc:none:", "t", "id", (0, 9), 0)


def test_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first != second
    if base:
        assert first.startswith(base)


class _Cluster:
    """Just enough of a session to ask for its settings."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folders_lie_where_the_session_says():
    folder = shared_folder(_Cluster(**{"spark.sql.warehouse.dir": "hdfs://name/wh"}), "x")
    assert folder.startswith("hdfs://name/wh/tablewright/x-")
    folder = shared_folder(_Cluster(**{"spark.checkpoint.dir": "hdfs://name/dir/"}), "x")
    assert folder.startswith("hdfs://name/dir/tablewright/x-")


CONTROLS = [chr(i) for i in range(32)] + ["\x7f", "\x85", "\u2028"]


@pytest.mark.parametrize("columns", [1, 2])
@pytest.mark.parametrize("sep", [",", "\t"])
def test_any_text_comes_back_escaped(spark, columns, sep):
    texts = [None, "", " ", "\\", "\\n", "\\e\n", '"', "a\nb", "a\r\nb", '",\t"', *CONTROLS, *[f"x{c}y{c}" for c in CONTROLS]]
    names = ["s", "t"][:columns]
    data = spark.createDataFrame([(t,) * columns for t in texts], ", ".join(f"{n} string" for n in names))
    path = sinks.save_dataset(data, shared_folder(spark, "escaped"), sep=sep, escape=True)
    assert_same_rows(sources.read_dataset(spark, path, schema=data.schema, sep=sep, escape=True), data)


@pytest.mark.parametrize("text", ["a\nb", "a\rb", "\u0001", "a\u0000"])
def test_a_text_that_would_be_lost_is_not_written(spark, text):
    data = spark.createDataFrame([(text,)], "s string")
    with pytest.raises(Exception, match="line break or a null mark"):
        sinks.save_dataset(data, shared_folder(spark, "refused"))


def test_a_table_may_be_replaced_by_its_own_rows(spark):
    name = "own_" + uuid.uuid4().hex
    sinks.save_as_table_or_view(spark.range(5), name)
    rows_left = sources.read_table(spark, name).where("id > 2")
    sinks.save_as_table_or_view(rows_left, name, drop_if_exists=True)
    assert rows(sources.read_table(spark, name).orderBy("id")) == [(3,), (4,)]
    sinks.drop_table_or_view(spark, name)


def test_a_failing_write_keeps_the_old_table(spark):
    name = "kept_" + uuid.uuid4().hex
    sinks.save_as_table_or_view(spark.range(5), name)
    failing = spark.range(3).select(F.when(F.col("id") > 1, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        sinks.save_as_table_or_view(failing, name, drop_if_exists=True)
    assert sources.read_table(spark, name).count() == 5
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name + "_")]
    sinks.drop_table_or_view(spark, name)


@pytest.mark.parametrize("kind", ["TABLE", "VIEW"])
def test_a_failed_swap_leaves_the_old_one(spark, monkeypatch, kind):
    name = f"swapped_{kind.lower()}"
    spark.sql("CREATE TABLE IF NOT EXISTS swap_source AS SELECT 1 AS a")
    spark.sql(f"CREATE {kind} {name} AS SELECT a FROM swap_source")
    run = type(spark).sql

    def failing(self, query, *args, **kwargs):
        if query.endswith(f"RENAME TO `{name}`") and query.startswith("ALTER TABLE") and not failed:
            failed.append(query)
            raise RuntimeError("the catalog is away")
        return run(self, query, *args, **kwargs)

    failed = []
    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError, match="away"):
        sinks.save_as_table_or_view(spark.range(3), name, drop_if_exists=True)
    assert failed and [r.a for r in spark.table(name).collect()] == [1]
    sinks.save_as_table_or_view(spark.range(3), name, drop_if_exists=True)
    assert spark.table(name).count() == 3
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
