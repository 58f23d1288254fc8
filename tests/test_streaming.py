"""Operators without state take a streaming table as it is."""

from __future__ import annotations

import pytest

from helpers import assert_same_rows
from tablewright.models import ClassWeights, ClusterModel, LinearModel, LogisticModel
from tablewright.operators import columns, encoding, quality, scoring
from tablewright.session import shared_folder
from tablewright.sources.datasets import read_dataset
from tablewright.streaming.sinks import save_stream

STEPS = {
    "filter": lambda df: columns.column_filter(df, ["l_tax", "l_orderkey"]),
    "power": lambda df: columns.power_features(df, ["l_linenumber"], "Pow3"),
    "date": lambda df: columns.format_date_column(df, "l_shipdate"),
    "nulls": quality.drop_null_rows,
    "zeros": quality.drop_null_nan_zero_rows,
    "linear": lambda df: scoring.predict_linear(df, LinearModel(("l_tax",), (2.0,), 1.0)),
    "class": lambda df: scoring.predict_class(
        df, LogisticModel(("l_tax",), (ClassWeights("hi", (50.0,), -2.0),), "lo")
    ),
    "clusters": lambda df: scoring.score_clusters(
        df, ClusterModel(("l_quantity",), ((10.0,), (40.0,)))
    ),
    "one_hot": lambda df: encoding.one_hot_encode(df, "l_returnflag", ["A", "N", "R"], "N"),
}


@pytest.fixture
def lines(spark, folder):
    return spark.read.parquet(f"{folder}/lineitem.parquet")


@pytest.fixture
def stream(spark, lines):
    path = shared_folder(spark, "stream-input")
    lines.repartition(2).write.parquet(path)
    return spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stateless_operators_agree_with_batch(spark, lines, stream):
    for step in STEPS.values():
        path = shared_folder(spark, "stream-output")
        query = save_stream(step(stream), path, shared_folder(spark, "checkpoint"))
        assert query.awaitTermination(120)
        assert query.exception() is None
        expected = step(lines)
        assert_same_rows(read_dataset(spark, path, "parquet", expected.schema), expected)


def test_a_stream_goes_on_where_it_ended(spark):
    source, path = shared_folder(spark, "source"), shared_folder(spark, "sink")
    checkpoint = shared_folder(spark, "checkpoint")

    def run() -> int:
        stream = spark.readStream.schema("id long").parquet(source)
        kept = quality.drop_null_nan_zero_rows(stream)
        save_stream(kept, path, checkpoint, "csv").awaitTermination(120)
        return read_dataset(spark, path, schema="id long").count()

    spark.range(10).write.parquet(source)
    assert run() == 9
    assert run() == 9
    spark.range(10, 30).write.mode("append").parquet(source)
    assert run() == 29
