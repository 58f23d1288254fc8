"""Fit regressions and clusters with Spark's own ML estimators; models come back as numbers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.checks import (
    CATEGORICAL,
    NUMERIC,
    check_bounds,
    check_choice,
    check_integer,
    columns_of_class,
    require_columns,
    require_disjoint,
    require_selection,
    spelling,
)
from tablewright.functions.names import as_double, quoted
from tablewright.functions.quality import any_of
from tablewright.models import ClusterModel, Encoding, LinearModel, MixedLinearModel
from tablewright.operators.absorbed import category_moments, solve_with_categories
from tablewright.operators.encoding import MOST_CATEGORIES
from tablewright.operators.hints import persisted
from tablewright.operators.moments import LARGEST, Moments, column_moments
from tablewright.operators.scoring import evaluate_regression

# Defaults of the estimators the operators stand for.
LASSO_PENALTY = 0.01
CLUSTERS = 5
ITERATIONS = 20

INVALID_ROWS = ("error", "skip")

# One precision for every width; a fit that has not reached it is an error.
TOLERANCE = 1e-10
MOST_ITERATIONS = 1000
POINTS_OF_A_TASK = 20_000


def _numbers(
    df: DataFrame, features: Sequence[str], target: str | None, invalid_rows: str
) -> DataFrame:
    """Features as doubles ``x0..`` and the target as ``label``; nothing else is read.

    With "skip", rows with a null or NaN are left out; with "error" they are still there.
    """
    check_choice("invalid_rows", invalid_rows, INVALID_ROWS)
    columns = [as_double(name).alias(f"x{i}") for i, name in enumerate(features)]
    if target is not None:
        columns.append(as_double(target).alias("label"))
    numbers = df.select(*columns)
    return numbers.na.drop("any") if invalid_rows == "skip" else numbers


def _check_rows(rows: DataFrame, purpose: str) -> tuple[int, int]:
    """One pass before a fit that reads its rows several times: there are rows, all of them finite and not too
    large to be squared. Their number comes back, and about how many different ones there are."""
    missing, infinite, large = [], [], []
    for name, kind in rows.dtypes:
        value = quoted(name)
        if kind == "array<double>":
            holes = F.exists(value, lambda x: x.isNull() | F.isnan(x))
            missing.append(value.isNull() | (F.size(value) == 0) | F.coalesce(holes, F.lit(False)))
            infinite.append(F.exists(value, lambda x: F.abs(x) == float("inf")))
            large.append(F.exists(value, lambda x: F.abs(x) > LARGEST))
            continue
        missing.append(value.isNull())
        if kind == "double":
            missing.append(F.isnan(value))
            infinite.append(F.abs(value) == float("inf"))
            large.append(F.abs(value) > LARGEST)
    found = rows.agg(
        F.count("*").alias("n"),
        F.count_if(any_of(missing)).alias("missing"),
        F.count_if(any_of(infinite) if infinite else F.lit(False)).alias("infinite"),
        F.count_if(any_of(large) if large else F.lit(False)).alias("large"),
        F.approx_count_distinct(F.xxhash64(*[quoted(name) for name in rows.columns])).alias("different"),
    ).first()
    Moments(found["n"], found["missing"], found["infinite"], found["large"], np.zeros(0), np.zeros(0)).check(purpose)
    return found["n"], found["different"]


def _vectors(numbers: DataFrame, *beside: str) -> DataFrame:
    """``features`` as a vector, and of the columns ``beside`` those that there are."""
    beside = [name for name in numbers.columns if name in beside]
    names = [name for name in numbers.columns if name not in beside]
    return VectorAssembler(inputCols=names, outputCol="features").transform(numbers).select("features", *beside)


def _estimator(penalty: float, fit_intercept: bool) -> LinearRegression:
    return LinearRegression(
        featuresCol="features",
        labelCol="label",
        elasticNetParam=1.0,
        regParam=float(penalty),
        fitIntercept=fit_intercept,
        standardization=False,
        tol=TOLERANCE,
        maxIter=MOST_ITERATIONS,
    )


def _solved(estimator: LinearRegression, vectors: DataFrame) -> tuple[list[float], float]:
    fitted = estimator.fit(vectors)
    if fitted.hasSummary and fitted.summary.totalIterations >= MOST_ITERATIONS:
        raise ValueError(f"the fit has not converged after {MOST_ITERATIONS} iterations")
    return [float(weight) for weight in fitted.coefficients], float(fitted.intercept)


def _plain_weights(second: np.ndarray) -> np.ndarray:
    """Least squares from co-moments, the target's last; of equally good solutions the smallest in scaled weights."""
    scale = np.sqrt(np.diag(second))
    safe = np.where(scale > 0, scale, 1.0)
    scaled = second / np.outer(safe, safe)
    found = np.linalg.lstsq(scaled[:-1, :-1], scaled[:-1, -1], rcond=len(second) * np.finfo(float).eps)[0]
    return np.where(scale[:-1] > 0, found * safe[-1] / safe[:-1], 0.0)


def _lasso_weights(second: np.ndarray, penalty: float) -> np.ndarray:
    """The same with the penalty on the weights as they are: rounds of coordinate descent, and, now and then, the
    weights that have not gone to zero solved at once. What then meets all conditions of the minimum is it."""
    scale = np.sqrt(np.diag(second))
    if scale[-1] == 0:
        return np.zeros(len(second) - 1)
    safe = np.where(scale > 0, scale, 1.0)
    scaled = second / np.outer(safe, safe)
    matrix, right = scaled[:-1, :-1], scaled[:-1, -1]
    price = penalty / (safe[:-1] * safe[-1])
    found = np.zeros(len(right))
    live = np.flatnonzero(scale[:-1] > 0)
    for iteration in range(1, MOST_ITERATIONS + 1):
        most = 0.0
        for j in live:
            rest = right[j] - matrix[j] @ found + found[j]
            new = np.sign(rest) * max(abs(rest) - price[j], 0.0)
            most, found[j] = max(most, abs(new - found[j])), new
        if most <= TOLERANCE:
            return found * safe[-1] / safe[:-1]
        if iteration >= 4 and iteration & (iteration - 1) == 0:
            on = np.flatnonzero(found)
            at_once = np.zeros(len(found))
            at_once[on] = np.linalg.lstsq(matrix[np.ix_(on, on)], (right - price * np.sign(found))[on], rcond=None)[0]
            left = right - matrix @ at_once
            if (np.sign(at_once[on]) == np.sign(found[on])).all() and (
                np.abs(left - price * np.sign(at_once)) <= np.where(at_once == 0, price, 0.0) + TOLERANCE
            ).all():
                return at_once * safe[-1] / safe[:-1]
    raise ValueError(f"the fit has not converged after {MOST_ITERATIONS} iterations")


def _fit_least_squares(
    numbers: DataFrame, penalty: float, fit_intercept: bool
) -> tuple[list[float], float]:
    """Minimise 1/(2n) sum(error^2) + penalty * sum(|weight|), on the columns as they are.

    Least squares sees a table only through its means and co-moments, which come from one scan at
    every width, with the checks of the rows. What is left to solve is as large as the model.
    """
    check_bounds("penalty", penalty, low=0.0)
    moments = column_moments(numbers)
    moments.check("fit")
    means, second = moments.means, moments.second / moments.n
    if not fit_intercept:
        second = second + np.outer(means, means)
    found = _plain_weights(second) if penalty == 0 else _lasso_weights(second, penalty)
    weights = [float(weight) for weight in found]
    intercept = float(means[-1] - np.dot(weights, means[:-1])) if fit_intercept else 0.0
    return weights, intercept


def fit_linear_regression(
    df: DataFrame,
    target: str,
    features: Sequence[str],
    penalty: float = LASSO_PENALTY,
    fit_intercept: bool = False,
    invalid_rows: str = "error",
) -> LinearModel:
    """Lasso regression; ``penalty=0, fit_intercept=True`` is ordinary least squares."""
    require_selection(features)
    require_disjoint([target], features)
    require_columns(df, [target, *features], NUMERIC)
    numbers = _numbers(df, features, target, invalid_rows)
    weights, intercept = _fit_least_squares(numbers, penalty, fit_intercept)
    return LinearModel(tuple(features), tuple(weights), intercept, target)


def fit_mixed_regression(
    df: DataFrame,
    target: str,
    features: Sequence[str],
    penalty: float = 0.0,
    fit_intercept: bool = True,
    invalid_rows: str = "error",
    most_categories: int | None = None,
) -> MixedLinearModel:
    """Regression on continuous and text columns: text is one-hot encoded against its first
    category, continuous features come first.

    Without a penalty two scans suffice, one for the numbers' moments and one for counts and means per category;
    no row is ever as wide as the categories. More than ``most_categories`` in all, MOST_CATEGORIES unless
    told otherwise, are an error before any is collected."""
    require_selection(features)
    require_disjoint([target], features)
    require_columns(df, [target], NUMERIC)
    require_columns(df, features)
    spelled = spelling(df)
    texts = {spelled(name) for name in columns_of_class(df, CATEGORICAL)}
    categorical = [name for name in features if spelled(name) in texts]
    continuous = [name for name in features if spelled(name) not in texts]
    require_columns(df, continuous, NUMERIC)

    check_choice("invalid_rows", invalid_rows, INVALID_ROWS)
    check_bounds("penalty", penalty, low=0.0)
    if most_categories is not None:
        check_integer("most_categories", most_categories, low=1)
    numbers = [f"x{i}" for i in range(len(continuous))] + ["label"]
    texts = [f"t{i}" for i in range(len(categorical))]
    rows = df.select(
        *[as_double(name).alias(f"x{i}") for i, name in enumerate(continuous)],
        as_double(target).alias("label"),
        *[quoted(name).alias(text) for name, text in zip(categorical, texts)],
    )
    if invalid_rows == "skip":
        rows = rows.na.drop("any")
    if not categorical:
        weights, intercept = _fit_least_squares(rows, penalty, fit_intercept)
        return MixedLinearModel(tuple(continuous), tuple(weights), (), (), intercept, target)
    holes = any_of([F.col(text).isNull() for text in texts])
    moments = column_moments(rows, numbers, missing=holes)
    moments.check("fit")
    found = category_moments(rows, texts, numbers, most_categories or MOST_CATEGORIES)
    encodings = [Encoding(name, tuple(values), values[0]) for name, values in zip(categorical, found.names)]
    if not any(encoding.encoded() for encoding in encodings):
        if not continuous:
            raise ValueError(f"the features {list(features)} leave nothing to fit")
        weights, intercept = _fit_least_squares(rows.select(numbers), penalty, fit_intercept)
        split = [() for _ in encodings]
    elif penalty == 0:
        weights, levels, intercept = solve_with_categories(moments, found, fit_intercept)
        split = [tuple(map(float, level)) for level in levels]
    else:
        vectors = _sparse_vectors(rows, numbers[:-1], encodings)
        every, intercept = _solved(_estimator(penalty, fit_intercept), vectors)
        weights, split, rest = every[: len(continuous)], [], every[len(continuous) :]
        for encoding in encodings:
            width = len(encoding.encoded())
            split.append(tuple(rest[:width]))
            rest = rest[width:]
    return MixedLinearModel(
        tuple(continuous), tuple(map(float, weights)), tuple(encodings), tuple(split), float(intercept), target
    )


def _sparse_vectors(rows: DataFrame, numbers: Sequence[str], encodings: Sequence[Encoding]) -> DataFrame:
    """``features`` and ``label``: the numbers, then the indicators of the texts t0, t1, ... A row holds one entry
    per text, however many categories there are. The base category comes last in its index, which the
    encoder leaves out."""
    parts = list(numbers)
    for i, encoding in enumerate(encodings):
        if encoding.encoded():
            labels = [*encoding.encoded(), encoding.base]
            indexer = StringIndexerModel.from_labels(labels, inputCol=f"t{i}", outputCol=f"i{i}", handleInvalid="error")
            indexed = indexer.transform(rows)
            encoder = OneHotEncoder(inputCol=f"i{i}", outputCol=f"o{i}", dropLast=True)
            rows = encoder.fit(indexed).transform(indexed)
            parts.append(f"o{i}")
    return VectorAssembler(inputCols=parts, outputCol="features").transform(rows).select("features", "label")


def fit_statistics(df: DataFrame, model: LinearModel | MixedLinearModel) -> DataFrame:
    """``Statistic`` and ``Value``: the regression metrics of the model on a table, as rows."""
    metrics = evaluate_regression(df, model)
    rows = [
        F.struct(F.lit(name).alias("Statistic"), F.col(name).alias("Value"))
        for name in metrics.columns
    ]
    return metrics.select(F.inline(F.array(*rows)))


def _points(df: DataFrame, features: Sequence[str], invalid_rows: str) -> tuple[DataFrame, bool]:
    """The features as doubles, or the one array column of whole points as ``x0``."""
    [kind] = df.select(quoted(features[0])).dtypes if len(features) == 1 else [("", "")]
    if not kind[1].startswith("array<"):
        require_columns(df, features, NUMERIC)
        return _numbers(df, features, None, invalid_rows), False
    check_choice("invalid_rows", invalid_rows, INVALID_ROWS)
    points = df.select(quoted(features[0]).cast("array<double>").alias("x0"))
    if invalid_rows == "skip":
        points = points.where((F.size("x0") > 0) & ~F.exists("x0", lambda x: x.isNull() | F.isnan(x)))
    return points, True


def fit_kmeans(
    df: DataFrame,
    features: Sequence[str],
    k: int = CLUSTERS,
    max_iter: int = ITERATIONS,
    seed: int = 0,
    invalid_rows: str = "error",
) -> ClusterModel:
    """k-means from a seeded k-means|| start. Centres are sorted, so that their names do not
    depend on the order in which they were found. One cluster is the mean, a single aggregate. Fewer
    distinct points than ``k`` give as many clusters as there are points.

    One feature may be an array column of whole points, all of one width; an empty one counts as null. Where at most
    half of the rows are different, equal points are counted first and fitted once, with their number as weight.
    """
    require_selection(features)
    require_columns(df, features)
    check_integer("k", k, low=1)
    check_integer("max_iter", max_iter, low=1)
    numbers, vector = _points(df, features, invalid_rows)
    n, different = _check_rows(numbers, "cluster")
    if vector:
        widths = numbers.agg(F.min(F.size("x0")).alias("low"), F.max(F.size("x0")).alias("high")).first()
        if widths.low != widths.high:
            raise ValueError(f"the points have from {widths.low} to {widths.high} elements")
    if k == 1:
        places = [F.get("x0", F.lit(i)) for i in range(widths.low)] if vector else [F.col(c) for c in numbers.columns]
        means = numbers.agg(*[F.avg(place).alias(f"x{i}") for i, place in enumerate(places)]).first()
        return ClusterModel(tuple(features), (tuple(means),), vector=vector)
    estimator = KMeans(featuresCol="features", k=k, maxIter=max_iter, seed=seed)
    if different <= 2 and len(only := numbers.distinct().limit(2).collect()) == 1:
        return ClusterModel(tuple(features), (tuple(only[0].x0) if vector else tuple(only[0]),), vector=vector)
    if 2 * different <= n:
        numbers = numbers.groupBy(*numbers.columns).agg(F.count("*").cast("double").alias("weight"))
        # Few points need few tasks: a fit runs some thirty jobs over them. They are dealt anew, as a task that takes over
        # several parts of the counts holds the memory of each; sorted, they lie the same way in every run.
        by = [name for name in numbers.columns if name != "weight"]
        numbers = numbers.repartition(max(1, different // POINTS_OF_A_TASK), *by).sortWithinPartitions(*by)
        estimator = estimator.setWeightCol("weight")
    made = array_to_vector("x0").alias("features")
    points = numbers.select(made, *[c for c in numbers.columns if c == "weight"]) if vector else _vectors(numbers, "weight")
    # Only the vectors are kept meanwhile, not the source's rows.
    with persisted(points) as points:
        fitted = estimator.fit(points)
    centers = sorted({tuple(float(value) for value in center) for center in fitted.clusterCenters()})
    return ClusterModel(tuple(features), tuple(centers), vector=vector)
