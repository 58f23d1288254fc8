from __future__ import annotations

import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from helpers import plan_of, rows, shuffles_in
from tablewright.operators import aggregates


@pytest.fixture
def groups(spark):
    return spark.createDataFrame(
        [
            ("a", 2.0, 3),
            ("a", None, 5),
            ("a", -4.0, 7),
            ("b", None, 1),
            (None, 6.0, 2),
            ("z", 0.0, 9),
            (None, 0.5, None),
        ],
        "k string, v double, w int",
    )


def test_count_by_group(groups):
    counted = aggregates.count_by_group(groups, "k")
    assert counted.columns == ["k", "GroupCount"]
    assert dict(rows(counted)) == {"a": 3, "b": 1, None: 2, "z": 1}
    assert dict(counted.dtypes) == {"k": "string", "GroupCount": "bigint"}
    assert aggregates.count_by_group(groups, "w").schema["w"].dataType.simpleString() == "int"


def test_product_by_group(groups):
    products = aggregates.product_by_group(groups, "k", ["w", "v"])
    assert products.columns == ["GroupKey", "w_PRODUCT", "v_PRODUCT"]
    assert {row[0]: row[1:] for row in rows(products)} == {
        "a": (105.0, -8.0),
        "b": (1.0, None),
        None: (2.0, 3.0),
        "z": (9.0, 0.0),
    }


def test_product_by_group_spells_out_number_keys(spark):
    df = spark.createDataFrame([(7, 2.0), (7, 3.0), (None, 1.5), (-1, 4.0)], "k long, v double")
    products = aggregates.product_by_group(df, "k", ["v"])
    assert products.schema["GroupKey"].dataType.simpleString() == "string"
    assert dict(rows(products)) == {"7": 6.0, None: 1.5, "-1": 4.0}
    by_double = aggregates.product_by_group(df.selectExpr("k + 0.5D AS k", "v"), "k", ["v"])
    assert dict(rows(by_double)) == {"7.5": 6.0, None: 1.5, "-0.5": 4.0}


def test_product_by_group_arguments(groups):
    with pytest.raises(ValueError, match="two purposes"):
        aggregates.product_by_group(groups, "w", ["w"])
    with pytest.raises(ValueError, match="not numeric"):
        aggregates.product_by_group(groups, "w", ["k"])


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    """A third of all rows under one key leave each task as one row."""
    df = spark.range(0, 30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 5).cast("string")))
        .alias("k"),
        F.lit(1.0).alias("v"),
    )
    counted = aggregates.count_by_group(df, "k")
    assert dict(rows(counted))["hot"] == 10_000
    assert dict(rows(aggregates.product_by_group(df, "k", ["v"])))["hot"] == 1.0
    for result in (counted, aggregates.product_by_group(df, "k", ["v"])):
        assert shuffles_in(result) == 1
        assert plan_of(result).count("HashAggregate") == 2


def test_count_pairs(spark):
    df = spark.createDataFrame(
        [(1, "yes"), (1, "yes"), (0, "no"), (None, "no"), (1, None)], "o int, p string"
    )
    counted = aggregates.count_pairs(df, "o", "p")
    assert [f.dataType.simpleString() for f in counted.schema] == ["string", "string", "bigint"]
    assert set(rows(counted)) == {
        ("1", "yes", 2), ("0", "no", 1), (None, "no", 1), ("1", None, 1),
    }


def test_regression_metrics_agree_with_the_evaluator(spark):
    df = spark.range(500).select(
        (F.sin("id") * 10 + F.col("id") / 50).alias("p"), (F.cos("id") * 3 + 1).alias("y")
    )
    got = aggregates.regression_metrics(df, "p", "y").first().asDict()
    names = {
        "explainedVariance": "var", "meanAbsoluteError": "mae", "meanSquaredError": "mse",
        "rootMeanSquaredError": "rmse", "r2": "r2",
    }
    assert list(got) == list(names)
    for name, metric in names.items():
        evaluator = RegressionEvaluator(predictionCol="p", labelCol="y", metricName=metric)
        assert got[name] == pytest.approx(evaluator.evaluate(df), rel=1e-11)


def test_regression_metrics_leave_out_null_pairs(spark):
    schema = "p double, y double"
    whole = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], schema)
    holed = spark.createDataFrame([(1.0, 2.0), (9.0, None), (None, 7.0), (3.0, 3.0)], schema)
    assert rows(aggregates.regression_metrics(holed, "p", "y")) == rows(
        aggregates.regression_metrics(whole, "p", "y")
    )


def test_regression_metrics_edges(spark):
    schema = "p double, y double"
    constant = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], schema)
    metrics = aggregates.regression_metrics(constant, "p", "y").first()
    assert (metrics.meanSquaredError, metrics.r2) == (1.0, None)
    one = aggregates.regression_metrics(constant.limit(1), "p", "y").first()
    assert (one.explainedVariance, one.meanAbsoluteError, one.r2) == (1.0, 1.0, None)
    empty = aggregates.regression_metrics(constant.where("false"), "p", "y")
    assert rows(empty) == [(None,) * 5]


def test_regression_metrics_keep_digits_with_a_large_mean(spark):
    df = spark.range(1000).select(
        (F.lit(1e6) + F.col("id") % 7).alias("p"), (F.lit(1e6) + F.col("id") % 5).alias("y")
    )
    got = aggregates.regression_metrics(df, "p", "y").first()
    values = [(i % 7, i % 5) for i in range(1000)]
    mse = sum((p - y) ** 2 for p, y in values) / 1000
    mean = sum(y for _, y in values) / 1000
    variance = sum((y - mean) ** 2 for _, y in values) / 1000
    assert got.r2 == pytest.approx(1 - mse / variance, rel=1e-9)
    assert math.isclose(got.meanSquaredError, mse)


def test_table_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "`a.b` int, s string")
    assert rows(aggregates.table_profile(df)) == [
        ("a.b", "int", 3, 1), ("s", "string", 3, 2),
    ]
    assert [r[2:] for r in rows(aggregates.table_profile(df.where("false")))] == [(0, 0), (0, 0)]


def test_row_count(spark):
    assert rows(aggregates.row_count(spark.range(12))) == [(12,)]
