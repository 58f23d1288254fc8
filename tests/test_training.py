from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows
from tablewright.models import LinearModel
from tablewright.operators import absorbed, encoding, moments, scoring, training
from tablewright.plans import workflows

NAN = float("nan")


@pytest.fixture
def manufactured(spark):
    return spark.createDataFrame(
        [(float(i), float(i), 2.0 * i + 5.0) for i in range(50)],
        "columnA double, columnB double, columnC double",
    )


@pytest.fixture(params=["one block", "many blocks"])
def either_way(request, monkeypatch):
    if request.param == "many blocks":
        monkeypatch.setattr(moments, "BLOCK", 2)


def lasso(x: np.ndarray, y: np.ndarray, penalty: float, intercept: bool):
    """Coordinate descent on 1/(2n) |y - xw|^2 + penalty |w|, as an independent answer."""
    mean_x, mean_y = (x.mean(0), y.mean()) if intercept else (np.zeros(x.shape[1]), 0.0)
    x, y = x - mean_x, y - mean_y
    gram, corr = x.T @ x / len(y), x.T @ y / len(y)
    w = np.zeros(x.shape[1])
    for _ in range(5000):
        for j in range(len(w)):
            rest = corr[j] - gram[j] @ w + gram[j, j] * w[j]
            w[j] = np.sign(rest) * max(abs(rest) - penalty, 0.0) / gram[j, j]
    return w, mean_y - mean_x @ w


@pytest.mark.parametrize(
    "penalty, intercept", [(0.01, False), (0.3, True), (0.0, True), (50.0, True)]
)
def test_lasso_against_coordinate_descent(spark, either_way, penalty, intercept):
    random = np.random.default_rng(1)
    x = random.normal(size=(200, 3)) * [1.0, 5.0, 0.2] + [0.5, 20.0, -3.0]
    y = x @ [1.5, -0.4, 3.0] + random.normal(size=200) + 2.0
    df = spark.createDataFrame(
        [tuple(map(float, [*a, b])) for a, b in zip(x, y)], ["a", "b", "c", "y"]
    )
    model = training.fit_linear_regression(df, "y", ["a", "b", "c"], penalty, intercept)
    weights, start = lasso(x, y, penalty, intercept)
    assert model.coefficients == pytest.approx(weights, abs=2e-5)
    assert model.intercept == pytest.approx(start, abs=1e-4)


def test_manufactured_regression(manufactured, either_way):
    """The two features are the same, so only the sum of their weights is determined."""
    lasso_model = training.fit_linear_regression(manufactured, "columnC", ["columnA", "columnB"])
    assert lasso_model.intercept == 0.0
    assert sum(lasso_model.coefficients) == pytest.approx(2 * 1.0758, abs=1e-3)
    plain = training.fit_linear_regression(
        manufactured, "columnC", ["columnA", "columnB"], penalty=0, fit_intercept=True
    )
    assert sum(plain.coefficients) == pytest.approx(2.0, abs=1e-6)
    assert plain.intercept == pytest.approx(5.0, abs=1e-5)
    assert (plain.features, plain.target) == (("columnA", "columnB"), "columnC")


def test_train_then_evaluate(manufactured):
    model, metrics = workflows.train_then_evaluate(
        manufactured, "columnC", ["columnA"], penalty=0, fit_intercept=True
    )
    assert model.coefficients == pytest.approx((2.0,))
    assert metrics.count() == 1
    assert metrics.columns == [
        "explainedVariance", "meanAbsoluteError", "meanSquaredError", "rootMeanSquaredError", "r2",
    ]
    assert metrics.first().r2 == pytest.approx(1.0)


def test_features_of_very_different_size(spark):
    """Moments keep their digits next to a feature a billion times larger."""
    df = spark.range(2000).select(
        (F.col("id") * 1e6 + 1e12).alias("big"),
        ((F.col("id") * 37 % 101) * 1e-4).alias("small"),
    ).withColumn("y", F.col("small") * 3000 + (F.col("big") - 1e12) * 1e-8 + 7)
    model = training.fit_linear_regression(df, "y", ["big", "small"], 0, True)
    assert model.coefficients == pytest.approx((1e-8, 3000.0), rel=1e-6)


def test_constant_feature_and_constant_target(spark, either_way):
    df = spark.range(20).select(
        F.lit(4.0).alias("c"), F.col("id").cast("double").alias("x"), F.lit(3.0).alias("y"),
        (F.col("id") * 2 + 1).alias("z"),
    )
    model = training.fit_linear_regression(df, "z", ["c", "x"], 0, True)
    errors = scoring.predict_linear(df, model).selectExpr("max(abs(prediction - z))")
    assert errors.first()[0] < 1e-6
    flat = training.fit_linear_regression(df, "y", ["x"], 0, True)
    assert flat.coefficients == pytest.approx((0.0,)) and flat.intercept == pytest.approx(3.0)


@pytest.mark.parametrize("hole", [(None, 1.0), (NAN, 1.0), (1.0, None)])
def test_rows_with_holes(spark, either_way, hole):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0), hole], "x double, y double")
    with pytest.raises(ValueError, match="null or NaN"):
        training.fit_linear_regression(df, "y", ["x"], 0, True)
    model = training.fit_linear_regression(df, "y", ["x"], 0, True, invalid_rows="skip")
    assert (*model.coefficients, model.intercept) == pytest.approx((2.0, 1.0))


def test_infinite_values_are_an_error(spark, either_way):
    df = spark.createDataFrame([(1.0, 3.0), (float("inf"), 5.0), (3.0, 7.0)], "x double, y double")
    with pytest.raises(ValueError, match="infinite"):
        training.fit_linear_regression(df, "y", ["x"], 0, True)


def test_fit_arguments(manufactured, spark):
    with pytest.raises(ValueError, match="two purposes"):
        training.fit_linear_regression(manufactured, "columnA", ["columnA"])
    with pytest.raises(ValueError, match="penalty"):
        training.fit_linear_regression(manufactured, "columnA", ["columnB"], penalty=-1)
    with pytest.raises(ValueError, match="no rows"):
        training.fit_linear_regression(manufactured.where("false"), "columnA", ["columnB"])
    with pytest.raises(ValueError, match="not numeric"):
        training.fit_linear_regression(
            manufactured.selectExpr("columnA", "'x' AS t"), "columnA", ["t"]
        )


@pytest.fixture
def mixed(spark):
    random = np.random.default_rng(2)
    effect = {"red": 0.0, "blue": 4.0, "green": -1.0}
    data = []
    for i in range(300):
        color = ["red", "blue", "green"][i % 3]
        size = ["s", "l"][i // 3 % 2]
        x = float(random.normal())
        y = 1.0 + 2.0 * x + effect[color] + (0.5 if size == "s" else 0.0)
        data.append((color, x, size, y + float(random.normal()) * 0.1))
    return spark.createDataFrame(data, "color string, x double, size string, y double")


def test_mixed_regression_against_least_squares(mixed, either_way):
    model = training.fit_mixed_regression(mixed, "y", ["color", "x", "size"])
    assert model.features == ("x",)
    assert [(e.column, e.categories, e.base) for e in model.encodings] == [
        ("color", ("blue", "green", "red"), "blue"), ("size", ("l", "s"), "l"),
    ]
    data = mixed.collect()
    design = np.array(
        [[1, r.x, r.color == "green", r.color == "red", r.size == "s"] for r in data], dtype=float
    )
    expected = np.linalg.lstsq(design, np.array([r.y for r in data]), rcond=None)[0]
    assert [name for name, _ in model.weights()] == [
        "Intercept", "x", "color_green", "color_red", "size_s",
    ]
    assert [w for _, w in model.weights()] == pytest.approx(expected, abs=1e-6)

    statistics = training.fit_statistics(mixed, model)
    assert statistics.columns == ["Statistic", "Value"]
    values = dict(rows(statistics))
    errors = design @ expected - np.array([r.y for r in data])
    assert values["meanSquaredError"] == pytest.approx(float((errors**2).mean()), rel=1e-6)
    assert len(values) == 5 and values["r2"] > 0.99


def test_mixed_regression_without_text_is_plain_regression(mixed):
    left = training.fit_mixed_regression(mixed, "y", ["x"])
    right = training.fit_linear_regression(mixed, "y", ["x"], 0, True)
    assert left.coefficients == pytest.approx(right.coefficients)
    assert left.intercept == pytest.approx(right.intercept)


def test_mixed_regression_on_text_alone(mixed):
    model = training.fit_mixed_regression(mixed, "y", ["color"])
    means = {r[0]: r[1] for r in rows(mixed.groupBy("color").avg("y"))}
    scored = scoring.predict_linear(mixed.select("color", "y"), model)
    for row in scored.distinct().collect():
        assert row.prediction == pytest.approx(means[row.color], abs=1e-6)


def test_one_category_leaves_nothing_to_fit(mixed):
    with pytest.raises(ValueError, match="nothing to fit"):
        training.fit_mixed_regression(mixed.where("color = 'red'"), "y", ["color"])


def test_one_hot_encode(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), (None,)], "v string")
    encoded = encoding.one_hot_encode(df, "v", ["c", "a", "b"], base="a")
    assert encoded.columns == ["v", "v_c", "v_b"]
    assert rows(encoded) == [
        ("a", 0.0, 0.0), ("b", 0.0, 1.0), ("c", 1.0, 0.0), ("d", None, None), (None, None, None),
    ]
    no_base = encoding.one_hot_encode(df, "v", ["a", "b"])
    assert no_base.columns == ["v", "v_a", "v_b"]
    outside = encoding.one_hot_encode(df, "v", ["a", "b"], base="d")
    assert rows(outside)[3] == ("d", 0.0, 0.0)
    with pytest.raises(ValueError, match="twice"):
        encoding.one_hot_encode(df, "v", ["a", "a"])


def test_learned_categories_are_bounded(spark):
    df = spark.range(50).selectExpr("cast(id AS string) a", "'x' AS b", "nullif('z', 'z') AS n")
    with pytest.raises(ValueError, match="more than 20"):
        encoding.learn_encodings(df, ["a", "b"], most_categories=20)
    learned = encoding.learn_encodings(df, ["b", "a", "n"], most_categories=51)
    assert [len(item.categories) for item in learned] == [1, 50, 0]
    assert learned[1].categories == tuple(sorted(str(i) for i in range(50)))


def test_kmeans_finds_separate_groups(spark):
    df = spark.range(600).select(
        ((F.col("id") % 3) * 100 + F.sin("id")).alias("x"),
        ((F.col("id") % 3) * -50 + F.cos("id")).alias("y"),
    )
    model = training.fit_kmeans(df, ["x", "y"], k=3, seed=4)
    assert model.labels == ("Cluster_0", "Cluster_1", "Cluster_2")
    scored = scoring.score_clusters(df, model)
    means = scored.groupBy("cluster").agg(F.avg("x"), F.avg("y")).orderBy("cluster").collect()
    for mean, center in zip(means, model.centers):
        assert (mean[1], mean[2]) == pytest.approx(center, abs=1e-9)
    assert {r[1] for r in rows(scored.groupBy("cluster").count())} == {200}


def test_separate_groups_are_found_whatever_the_partitions_and_the_seed(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        (F.col("l_quantity") + 1000 * F.col("l_linenumber")).alias("place"), "l_discount"
    )
    fits = [
        training.fit_kmeans(lines.repartition(parts), ["place", "l_discount"], k=7, seed=seed)
        for parts, seed in ((1, 7), (8, 7), (40, 7), (8, 1), (8, 2), (8, 3))
    ]
    for fit in fits[1:]:
        assert np.allclose(fit.centers, fits[0].centers, atol=1e-9)


def test_fewer_points_than_clusters(spark):
    df = spark.range(20).select((F.col("id") % 2).cast("double").alias("x"))
    assert training.fit_kmeans(df, ["x"], k=5).centers == ((0.0,), (1.0,))


INVALID = [([1e200, 1.0], "too large"), ([None, 1.0], "null"), ([NAN, 1.0], "null"), ([float("inf"), 1.0], "infinite"), ([], "no rows")]


@pytest.mark.parametrize("values, message", INVALID)
@pytest.mark.parametrize("k", [1, 2])
def test_clustering_has_one_error_contract(spark, values, message, k):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    with pytest.raises(ValueError, match=message):
        training.fit_kmeans(df, ["x"], k=k)


@pytest.mark.parametrize("values, message", INVALID)
@pytest.mark.parametrize("width", [1, 5, 6, 200])
def test_regression_has_one_error_contract(spark, values, message, width):
    names = [f"x{i}" for i in range(width)]
    df = spark.createDataFrame([(v,) for v in values], "y double").select(
        "y", *[(F.rand(i) + i).alias(n) for i, n in enumerate(names)]
    )
    with pytest.raises(ValueError, match=message):
        training.fit_linear_regression(df, "y", names, 0, True)


def test_an_unfinished_fit_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(training, "MOST_ITERATIONS", 1)
    df = spark.range(50).select(*[F.rand(i).alias(f"x{i}") for i in range(7)])
    with pytest.raises(ValueError, match="converged"):
        training.fit_linear_regression(df, "x0", [f"x{i}" for i in range(1, 7)], 0.001, True)


def test_many_categories(spark):
    df = spark.range(6000).select(
        (F.col("id") % 1500).cast("string").alias("g"), (F.col("id") % 7).cast("double").alias("x")
    ).withColumn("y", 2 * F.col("x") + F.col("g").cast("double"))
    model = training.fit_mixed_regression(df, "y", ["g", "x"])
    assert model.coefficients == pytest.approx((2.0,), abs=1e-6)
    assert model.category_coefficients[0] == pytest.approx([float(c) for c in model.encodings[0].encoded()], abs=1e-5)


def test_many_features_against_least_squares(spark, monkeypatch):
    random = np.random.default_rng(3)
    x = random.normal(size=(600, 70)) @ np.diag(np.exp(random.normal(size=70))) + random.normal(size=70) * 100
    y = x @ random.normal(size=70) + random.normal(size=600)
    names = [f"x{i}" for i in range(70)]
    df = spark.createDataFrame([tuple(map(float, [*a, b])) for a, b in zip(x, y)], [*names, "y"]).repartition(7)
    design = np.column_stack([np.ones(600), x])
    expected = np.linalg.lstsq(design, y, rcond=None)[0]
    for block in (256, 32):
        monkeypatch.setattr(moments, "BLOCK", block)
        model = training.fit_linear_regression(df, "y", names, 0, True)
        assert [model.intercept, *model.coefficients] == pytest.approx(expected, rel=1e-6, abs=1e-8)
    found = moments.column_moments(df)
    assert found.second == pytest.approx(np.cov(np.column_stack([x, y]).T) * 599, rel=1e-9, abs=1e-6)
    assert (found.n, found.missing) == (600, 0) and found.means == pytest.approx([*x.mean(0), y.mean()])


def three_texts(seed, n, sizes, numbers=2):
    random = np.random.default_rng(seed)
    codes = [random.integers(0, s, n) for s in sizes]
    x = random.normal(size=(n, numbers)) * 3 + 50
    effects = [random.normal(size=s) * 5 for s in sizes]
    y = 7 + x @ np.arange(1.0, numbers + 1) + sum(e[c] for e, c in zip(effects, codes)) + random.normal(size=n)
    rows = [(*[f"c{v:04d}" for v in row], *map(float, a), float(b)) for *row, a, b in zip(*codes, x, y)]
    return rows, [f"t{i}" for i in range(len(sizes))], [f"x{i}" for i in range(numbers)]


@pytest.mark.parametrize("intercept", [True, False])
@pytest.mark.parametrize("few", [200, 0])
@pytest.mark.parametrize("sizes", [(7,), (5, 9), (30, 2, 11), (1, 6), (40, 40)])
def test_texts_against_least_squares(spark, monkeypatch, sizes, few, intercept):
    """Eliminated and solved at once, or by conjugate gradients."""
    monkeypatch.setattr(absorbed, "FEW_UNKNOWNS", few)
    rows, texts, numbers = three_texts(len(sizes), 900, sizes)
    df = spark.createDataFrame(rows, [*texts, *numbers, "y"])
    model = training.fit_mixed_regression(df, "y", [*texts, *numbers], fit_intercept=intercept)
    table = {n: [r[i] for r in rows] for i, n in enumerate([*texts, *numbers, "y"])}
    columns = [np.array(table[n]) for n in numbers]
    for t in texts:
        columns += [np.array([v == c for v in table[t]], float) for c in sorted(set(table[t]))[1:]]
    design = np.column_stack([*([np.ones(900)] if intercept else []), *columns])
    expected = np.linalg.lstsq(design, np.array(table["y"]), rcond=None)[0]
    weights = [w for _, w in model.weights()]
    assert weights[0 if intercept else 1 :] == pytest.approx(expected, abs=1e-7)
    assert intercept or weights[0] == 0.0


def test_texts_that_tell_one_another(spark, monkeypatch):
    """A city tells its country: weights are open, predictions are not."""
    rows = [(f"k{i % 4}", f"c{i % 12:02d}", float(i % 5), float(i % 12 + (i % 5) * 2 + (i % 3) * 0.1)) for i in range(600)]
    df = spark.createDataFrame(rows, "country string, city string, x double, y double")
    alone = training.fit_mixed_regression(df, "y", ["city", "x"])
    expected = [r.prediction for r in scoring.predict_linear(df, alone).orderBy("city", "x").collect()]
    for few in (200, 0):
        monkeypatch.setattr(absorbed, "FEW_UNKNOWNS", few)
        both = training.fit_mixed_regression(df, "y", ["country", "city", "x"])
        got = [r.prediction for r in scoring.predict_linear(df, both).orderBy("city", "x").collect()]
        assert got == pytest.approx(expected, abs=1e-8)


def test_too_many_categories_are_never_collected(spark, monkeypatch):
    df = spark.range(300).selectExpr("cast(id AS string) AS t", "cast(id % 30 AS string) AS u", "cast(id AS double) AS y")
    with pytest.raises(ValueError, match="more than 100 categories"):
        training.fit_mixed_regression(df, "y", ["t"], most_categories=100)
    monkeypatch.setattr(absorbed, "MOST_PAIRS", 100)
    with pytest.raises(ValueError, match="more than 100 pairs"):
        training.fit_mixed_regression(df, "y", ["t", "u"])


def test_rows_without_a_category(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("b", 2.0, 2.0), (None, 3.0, 5.0), ("b", None, 1.0), ("a", 2.0, 3.0)], "t string, x double, y double")
    with pytest.raises(ValueError, match="2 rows have a null"):
        training.fit_mixed_regression(df, "y", ["t", "x"])
    model = training.fit_mixed_regression(df, "y", ["t", "x"], invalid_rows="skip")
    assert [w for _, w in model.weights()] == pytest.approx([-1.0, 2.0, -1.0])


def test_penalised_texts_go_on_as_before(mixed):
    model = training.fit_mixed_regression(mixed, "y", ["color", "x"], penalty=0.2)
    plain = training.fit_mixed_regression(mixed, "y", ["color", "x"])
    assert 0 < model.coefficients[0] < plain.coefficients[0]


def test_kmeans_invariants(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    features = ["l_quantity", "l_extendedprice"]
    low_high = lines.selectExpr(
        *[f"{bound}({name})" for name in features for bound in ("min", "max")]
    ).first()
    previous = float("inf")
    for iterations in (1, 3, 20):
        model = training.fit_kmeans(lines, features, max_iter=iterations, seed=1)
        assert len(model.centers) == 5
        assert list(model.centers) == sorted(model.centers)
        for center in model.centers:
            assert low_high[0] <= center[0] <= low_high[1]
            assert low_high[2] <= center[1] <= low_high[3]
        distances = [F.col(f"distance_Cluster_{i}") for i in range(5)]
        cost = (
            scoring.score_clusters(lines, model)
            .agg(F.sum(F.pow(F.least(*distances), 2)))
            .first()[0]
        )
        assert cost <= previous * (1 + 1e-9)
        previous = cost


def test_equal_points_are_fitted_once_with_their_number(spark, monkeypatch):
    """Weights pull centres as the rows themselves do."""
    df = spark.range(4000).select(((F.col("id") % 7) * (F.col("id") % 2) + (F.col("id") % 2) * 500).cast("double").alias("x"))
    weighted = training.fit_kmeans(df, ["x"], k=2, seed=1)
    means = [r[1] for r in df.groupBy((F.col("x") > 250).alias("far")).avg("x").orderBy("far").collect()]
    assert [c[0] for c in weighted.centers] == pytest.approx(means, abs=1e-9)
    whole = training.fit_kmeans(df.select((F.col("x") + F.rand(1) * 1e-9).alias("x")), ["x"], k=2, seed=1)
    assert np.allclose(weighted.centers, whole.centers, atol=1e-6)


def test_points_in_an_array_column(spark):
    parts = spark.range(300).select(
        ((F.col("id") % 3) * 100 + F.sin("id")).alias("a"), ((F.col("id") % 3) * -50 + F.cos("id")).alias("b")
    )
    arrays = parts.select("a", F.array("a", "b").alias("p"))
    for k in (1, 3):
        by_columns, whole = training.fit_kmeans(parts, ["a", "b"], k=k, seed=4), training.fit_kmeans(arrays, ["p"], k=k, seed=4)
        assert whole.vector and np.allclose(by_columns.centers, whole.centers, atol=1e-9)
        left = scoring.score_clusters(parts.select("a", "b"), by_columns).drop("b").orderBy("a").collect()
        right = scoring.score_clusters(arrays, whole).drop("p").orderBy("a").collect()
        for x, y in zip(left, right):
            assert x[-1] == y[-1] and list(x[:-1]) == pytest.approx(list(y[:-1]))
    assert whole.centers_table(spark).columns == ["ClusterName", "p"]
    assert [r.p for r in whole.centers_table(spark).collect()] == [list(c) for c in whole.centers]
    odd = spark.createDataFrame([([1.0],), ([1.0, None],), (None,), ([],)], "p array<double>")
    assert {r.cluster for r in scoring.score_clusters(odd, whole).collect()} == {None}


@pytest.mark.parametrize("values, message", [
    ([None, [1.0]], "null"), ([[1.0, NAN], [1.0, 2.0]], "null"), ([[1.0, None], [1.0, 2.0]], "null"), ([[], [1.0]], "null"),
    ([[float("inf")], [1.0]], "infinite"), ([[1e200], [1.0]], "too large"), ([[1.0], [1.0, 2.0]], "from 1 to 2"), ([], "no rows"),
])
def test_array_points_have_the_same_contract(spark, values, message):
    df = spark.createDataFrame([(v,) for v in values], "p array<double>")
    for k in (1, 2):
        with pytest.raises(ValueError, match=message):
            training.fit_kmeans(df, ["p"], k=k)
    if message == "null":
        [sound] = [v for v in values if v and None not in v and v[-1] == v[-1]]
        assert training.fit_kmeans(df, ["p"], k=2, invalid_rows="skip").centers == (tuple(sound),)


def test_one_cluster_is_the_mean(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 6.0), (None, 1.0)], "x int, y double")
    assert training.fit_kmeans(df, ["x", "y"], k=1, invalid_rows="skip").centers == ((2.0, 4.0),)
    with pytest.raises(ValueError, match="1 rows have a null"):
        training.fit_kmeans(df, ["x", "y"], k=1)
    with pytest.raises(ValueError, match="1 rows have a null"):
        training.fit_kmeans(df, ["x", "y"], k=2)
    with pytest.raises(ValueError):
        training.fit_kmeans(df, ["x"], k=0)
    with pytest.raises(ValueError, match="no rows"):
        training.fit_kmeans(df.where("false"), ["x"], k=1)


def test_models_are_plain_values():
    model = LinearModel(("x",), (1.0,))
    assert model == LinearModel(("x",), (1.0,)) and hash(model)


def test_parts_of_counted_points_do_not_add_up_in_one_task(spark, monkeypatch):
    """A task that takes over several parts of an aggregate holds the memory of each."""
    plans, persisted = [], training.persisted
    monkeypatch.setattr(training, "persisted", lambda points: plans.append(plan_of(points)) or persisted(points))
    df = spark.range(4000).select((F.col("id") % 2 * 500 + F.col("id") % 7).cast("double").alias("x"))
    training.fit_kmeans(df, ["x"], k=2, seed=1)
    [plan] = plans
    assert "Coalesce" not in plan and len([line for line in plan.splitlines() if "Exchange " in line]) == 2
