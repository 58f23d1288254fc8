from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from tablewright.functions import arithmetic
from tablewright.models import (
    ClassWeights,
    ClusterModel,
    Encoding,
    LinearModel,
    LogisticModel,
    MixedLinearModel,
    model_equation,
    weights_table,
)
from tablewright.operators import scoring

NAN, INF = float("nan"), float("inf")
PLAY = LogisticModel(
    ("temperature", "humidity"), (ClassWeights("yes", (2.0, 3.0), 4.0),), "no", "play"
)


@pytest.fixture
def as_arrays(monkeypatch):
    """Make every model take the way meant for many features."""
    monkeypatch.setattr(arithmetic, "MOST_PLAIN_TERMS", 0)


@pytest.fixture(params=["plain", "arrays"])
def either_way(request):
    if request.param == "arrays":
        request.getfixturevalue("as_arrays")


@pytest.fixture
def points(spark):
    return spark.createDataFrame(
        [(1, 0.0, 0), (2, 3.0, 4), (3, None, 1), (4, -1.5, None), (5, 6.0, 8)],
        "id int, x double, y int",
    )


def test_predict_linear(points, either_way):
    model = LinearModel(("x", "y"), (2.0, -1.0), 0.5)
    scored = scoring.predict_linear(points, model)
    assert scored.columns == ["id", "x", "y", "prediction"]
    assert {r[0]: r[3] for r in rows(scored)} == {1: 0.5, 2: 2.5, 3: None, 4: None, 5: 4.5}


def test_linear_model_needs_a_coefficient_per_feature():
    with pytest.raises(ValueError, match="1 coefficients for 2 features"):
        LinearModel(("x", "y"), (2.0,))


def test_missing_model_columns_are_named(points):
    with pytest.raises(ValueError, match="'p', 'q'"):
        scoring.predict_linear(points, LinearModel(("p", "x", "q"), (1.0, 1.0, 1.0)))


def test_a_taken_output_name_is_an_error(points):
    with pytest.raises(ValueError, match="already"):
        scoring.predict_linear(points, LinearModel(("x",), (1.0,)), prediction="y")


def test_wide_linear_model(spark):
    width = 500
    names = tuple(f"f{i}" for i in range(width))
    df = spark.range(5).select(
        "id", *[(F.col("id") * i).cast("double").alias(name) for i, name in enumerate(names)]
    )
    model = LinearModel(names, tuple(0.5 for _ in names), 1.0)
    total = sum(range(width)) * 0.5
    assert [r[-1] for r in rows(scoring.predict_linear(df, model))] == [
        1.0 + total * k for k in range(5)
    ]


def test_equation_and_weights(spark):
    model = LinearModel(("a", "b"), (2.0, -0.5), 1.5, "goal")
    assert model_equation(model) == "goal = 1.5 + 2.0 * a + -0.5 * b"
    table = weights_table(spark, model)
    assert table.columns == ["Predictors", "Weights"]
    assert rows(table) == [("Intercept", 1.5), ("a", 2.0), ("b", -0.5)]


@pytest.mark.parametrize(
    "x, label",
    [(-5.0, "no"), (-1e-9, "no"), (0.0, "yes"), (1e-9, "yes"), (1000.0, "yes"), (-1000.0, "no"),
     (INF, "yes"), (-INF, "no"), (NAN, "yes"), (None, None)],
)
def test_two_classes_by_margin(spark, either_way, x, label):
    df = spark.createDataFrame([(x,)], "x double")
    model = LogisticModel(("x",), (ClassWeights("yes", (1.0,)),), "no")
    assert scoring.predict_class(df, model).first()["PRED"] == label


def probabilities(margins: list[float], labels: list[str], base: str) -> str:
    """The rule with plain probabilities; first of equals, the base only when strictly ahead."""
    weights = [math.exp(m) for m in margins]
    total = 1 + sum(weights)
    shares = [w / total for w in weights]
    if all(1 / total > share for share in shares):
        return base
    return labels[shares.index(max(shares))]


def test_many_classes_against_probabilities(spark, either_way):
    random = np.random.default_rng(3)
    labels = ["a", "b", "c", "d"]
    weights = random.normal(size=(4, 3)).round(2)
    starts = random.normal(size=4).round(2)
    model = LogisticModel(
        ("x", "y", "z"),
        tuple(
            ClassWeights(label, tuple(float(v) for v in row), float(start))
            for label, row, start in zip(labels, weights, starts)
        ),
        "base",
    )
    data = random.normal(size=(300, 3)).round(3)
    df = spark.createDataFrame([tuple(map(float, row)) for row in data], ["x", "y", "z"])
    for row in scoring.predict_class(df, model).collect():
        margins = [float(s + w @ np.array(row[:3])) for w, s in zip(weights, starts)]
        assert row["PRED"] == probabilities(margins, labels, "base")


def test_equal_margins_go_to_the_class_listed_first(spark, either_way):
    model = LogisticModel(
        ("x",), (ClassWeights("b", (1.0,)), ClassWeights("a", (1.0,)), ClassWeights("c", (0.0,))),
        "base",
    )
    df = spark.createDataFrame([(1.0,), (-1.0,), (0.0,)], "x double")
    assert [r[1] for r in rows(scoring.predict_class(df, model))] == ["b", "c", "b"]


def test_predict_class_keeps_the_input_columns(spark):
    df = spark.createDataFrame(
        [(70, 80, "yes", "k")], ["temperature", "humidity", "play", "a.b"]
    )
    scored = scoring.predict_class(df, PLAY)
    assert scored.columns == ["temperature", "humidity", "play", "a.b", "PRED"]


def test_confusion_matrix(spark):
    df = spark.createDataFrame(
        [(70, 96, "yes"), (-70, 1, "no"), (70, 1, "no"), (70, 2, "no"), (None, 2, "no"),
         (70, 2, None)],
        "temperature long, humidity long, play string",
    )
    matrix = scoring.confusion_matrix(df, PLAY)
    assert matrix.columns == ["Observed", "Predicted", "N"]
    assert set(rows(matrix)) == {
        ("yes", "yes", 1), ("no", "no", 1), ("no", "yes", 2), ("no", None, 1), (None, "yes", 1),
    }
    assert sum(r[2] for r in rows(matrix)) == df.count()


def test_confusion_matrix_without_the_observed_column(spark):
    df = spark.createDataFrame([(70, 96)], "temperature long, humidity long")
    with pytest.raises(ValueError, match="play"):
        scoring.confusion_matrix(df, PLAY)


def test_bad_logistic_models():
    with pytest.raises(ValueError):
        LogisticModel(("x",), (), "base")
    with pytest.raises(ValueError):
        LogisticModel(("x",), (ClassWeights("a", (1.0, 2.0)),), "base")
    with pytest.raises(ValueError):
        LogisticModel(("x",), (ClassWeights("a", (1.0,)),), "a")


def test_score_clusters(points, either_way):
    model = ClusterModel(("x", "y"), ((0.0, 0.0), (6.0, 8.0), (3.0, 4.0)))
    scored = scoring.score_clusters(points, model)
    assert scored.columns[3:] == [
        "distance_Cluster_0", "distance_Cluster_1", "distance_Cluster_2", "cluster",
    ]
    got = {r[0]: r[3:] for r in rows(scored)}
    assert got[1] == (0.0, 10.0, 5.0, "Cluster_0")
    assert got[2] == (5.0, 5.0, 0.0, "Cluster_2")
    assert got[5] == (10.0, 0.0, 5.0, "Cluster_1")
    assert got[3] == got[4] == (None, None, None, None)


def test_a_row_between_two_centres_goes_to_the_first(spark, either_way):
    df = spark.createDataFrame([(1.0,), (NAN,)], "x double")
    model = ClusterModel(("x",), ((2.0,), (0.0,)), ("right", "left"))
    assert [r[-1] for r in rows(scoring.score_clusters(df, model))] == ["right", "right"]


def test_one_centre(spark, either_way):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    scored = scoring.score_clusters(df, ClusterModel(("x",), ((2.0,),)))
    assert rows(scored) == [(1.0, 1.0, "Cluster_0"), (None, None, None)]


def test_label_is_the_argmin_with_many_centres(spark):
    random = np.random.default_rng(5)
    centers = random.normal(size=(40, 12))
    data = random.normal(size=(60, 12))
    names = [f"f{i}" for i in range(12)]
    df = spark.createDataFrame([tuple(map(float, row)) for row in data], names)
    model = ClusterModel(tuple(names), tuple(tuple(map(float, c)) for c in centers))
    for row, point in zip(scoring.score_clusters(df, model).collect(), data):
        gaps = np.sqrt(((centers - point) ** 2).sum(axis=1))
        assert row["cluster"] == f"Cluster_{gaps.argmin()}"
        assert np.allclose([row[f"distance_Cluster_{i}"] for i in range(40)], gaps, rtol=1e-12)


@pytest.fixture
def odd_points(spark):
    random = np.random.default_rng(5)
    values = [[float(x) for x in row] for row in random.normal(size=(60, 6)) * 10.0 ** random.integers(-12, 12, (60, 6))]
    values += [None, [], [1.0], [1.0, 2.0, None, 4.0, 5.0, 6.0], [NAN, 1.0, 2.0, 3.0, 4.0, 5.0], [INF] * 6, [-INF] + [0.0] * 5, values[0]]
    return spark.createDataFrame(list(enumerate(values)), "id int, point array<double>").repartition(3)


def in_order(start, terms):
    for term in terms:
        start += term
    return start


@pytest.mark.parametrize("of_batch", [1, 40, 1 << 20])
def test_blocks_add_in_the_order_of_folds(odd_points, monkeypatch, of_batch):
    monkeypatch.setattr(arithmetic, "NUMBERS_OF_BATCH", of_batch)
    monkeypatch.setattr(arithmetic, "NUMBERS_AT_ONCE", 20)
    random = np.random.default_rng(6)
    centers = [tuple(map(float, row)) for row in random.normal(size=(9, 6)) * 1e3]
    starts = [float(x) for x in random.normal(size=9)]
    for row in rows(odd_points.select(
        "point",
        arithmetic.array_distances(F.col("point"), centers),
        arithmetic.array_weighted_sums(F.col("point"), centers, starts),
    )):
        point, gaps, sums = row
        if point is None or len(point) != 6 or None in point:
            assert gaps is None and sums is None
            continue
        expected = [math.sqrt(in_order(0.0, [(v - c) * (v - c) for v, c in zip(point, center)])) for center in centers]
        totals = [in_order(s, [c * v for v, c in zip(point, center)]) for s, center in zip(starts, centers)]
        for found, wanted in ((gaps, expected), (sums, totals)):
            assert [repr(x) for x in found] == [repr(x) for x in wanted]


def test_blocks_of_no_rows(odd_points):
    model = ClusterModel(("point",), ((0.0,) * 6, (1.0,) * 6), vector=True)
    assert rows(scoring.score_clusters(odd_points.where("id < 0"), model)) == []


def test_a_thousand_centres_are_scored_once_per_row(odd_points):
    """One Python step, which gets nothing but the points."""
    centers = tuple(tuple(float(i + j) for j in range(6)) for i in range(1000))
    scored = scoring.score_clusters(odd_points, ClusterModel(("point",), centers, vector=True)).select("id", "cluster")
    plan = plan_of(scored)
    assert plan.count("ArrowEvalPython [") == 1
    found = {r[0]: r[1] for r in rows(scored)}
    points = {r[0]: r[1] for r in rows(odd_points)}
    for i in range(60):
        gaps = [in_order(0.0, [(v - c) * (v - c) for v, c in zip(points[i], center)]) for center in centers]
        assert found[i] == f"Cluster_{int(np.argmin(np.sqrt(gaps)))}"
    assert [found[i] for i in range(60, 64)] == [None] * 4


def test_cluster_centers_table(spark):
    table = ClusterModel(("x", "y"), ((1.0, 2.0), (3.0, 4.0))).centers_table(spark)
    assert table.columns == ["ClusterName", "x", "y"]
    assert rows(table) == [("Cluster_0", 1.0, 2.0), ("Cluster_1", 3.0, 4.0)]


def test_mixed_model(spark):
    model = MixedLinearModel(
        ("x",), (2.0,), (Encoding("c", ("a", "b", "z"), "a"),), ((10.0, 20.0),), 1.0, "y"
    )
    df = spark.createDataFrame(
        [(1.0, "a"), (1.0, "b"), (2.0, "z"), (1.0, "new"), (1.0, None), (None, "a")],
        "x double, c string",
    )
    scored = scoring.predict_linear(df, model)
    assert [r[2] for r in rows(scored)] == [3.0, 13.0, 25.0, None, None, None]
    assert model_equation(model) == "y = 1.0 + 2.0 * x + 10.0 * c_b + 20.0 * c_z"
    assert rows(weights_table(spark, model))[2:] == [("c_b", 10.0), ("c_z", 20.0)]


def test_evaluate_regression_takes_any_numeric_type(spark):
    df = spark.createDataFrame([(1, 2), (2, 4), (3, None), (None, 8)], "x long, y int")
    metrics = scoring.evaluate_regression(df, LinearModel(("x",), (2.0,), 0.0, "y"))
    assert metrics.first().meanSquaredError == 0.0
    with pytest.raises(ValueError, match="size"):
        scoring.evaluate_regression(df, LinearModel(("x",), (2.0,), 0.0, "size"))
    with pytest.raises(ValueError, match="dependent"):
        scoring.evaluate_regression(df, LinearModel(("x",), (2.0,)))
