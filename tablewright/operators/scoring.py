"""Score a table with a model, and evaluate the scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.checks import free_names, require_new_columns
from tablewright.functions import arithmetic
from tablewright.functions.names import as_double, quoted
from tablewright.models import (
    ClusterModel,
    LinearModel,
    LogisticModel,
    MixedLinearModel,
    require_model_columns,
)
from tablewright.operators import aggregates

PREDICTION = "prediction"
PREDICTED_CLASS = "PRED"
CLUSTER = "cluster"


def predict_linear(
    df: DataFrame, model: LinearModel | MixedLinearModel, prediction: str = PREDICTION
) -> DataFrame:
    """All columns, then the predicted value; null where a feature is null."""
    require_model_columns(df, model)
    require_new_columns(df, [prediction])
    return df.select("*", model.to_column().alias(prediction))


def predict_class(
    df: DataFrame, model: LogisticModel, prediction: str = PREDICTED_CLASS
) -> DataFrame:
    """All columns, then the predicted class; null where a feature is null.

    exp is monotonic, so the largest margin is the largest probability, and nothing can overflow.
    The base class, with margin 0, wins only when every other margin is below 0; on equal margins
    the class listed first wins.
    """
    require_model_columns(df, model)
    require_new_columns(df, [prediction])
    values = [as_double(name) for name in model.features]
    labels = [item.label for item in model.classes]
    passed = [quoted(name) for name in df.columns]
    top, point, all_margins = free_names(df, ["top", "point", "margins"])
    # Margins and the largest of them get projections of their own, so that each is computed
    # once per row however many classes refer to it.
    if len(values) * len(labels) <= arithmetic.MOST_PLAIN_TERMS:
        names = free_names(df, [f"margin_{i}" for i in range(len(labels))])
        margins = [F.col(name) for name in names]
        scored = df.select(
            *passed, *[margin.alias(name) for name, margin in zip(names, model.margins())]
        ).select("*", _greatest(margins).alias(top))
        winner = _first_match(F.col(top), margins, labels)
    else:
        scored = (
            df.select(*passed, F.array(*values).alias(point))
            .select(
                *passed,
                arithmetic.array_weighted_sums(
                    F.col(point),
                    [item.coefficients for item in model.classes],
                    [item.intercept for item in model.classes],
                ).alias(all_margins),
            )
            .select(*passed, all_margins, F.array_max(all_margins).alias(top))
        )
        winner = _label_at(F.array_position(all_margins, F.col(top)), labels)
    # A null feature makes every margin null, and the largest one with them.
    chosen = F.when(F.col(top) < 0.0, F.lit(model.base)).otherwise(winner)
    return scored.select(*passed, chosen.alias(prediction))


def _greatest(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.greatest(*columns)


def _least(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.least(*columns)


def _first_match(wanted: Column, columns: list[Column], labels: Sequence[str]) -> Column:
    """The label of the first column that equals ``wanted``; null when it is null."""
    choice = F.when(columns[0] == wanted, F.lit(labels[0]))
    for column, label in zip(columns[1:], labels[1:]):
        choice = choice.when(column == wanted, F.lit(label))
    return choice


def _label_at(position: Column, labels: Sequence[str]) -> Column:
    """The label at a position counted from 1; null when that is null."""
    return F.get(F.array(*[F.lit(label) for label in labels]), position.cast("int") - 1)


def score_clusters(df: DataFrame, model: ClusterModel, cluster: str = CLUSTER) -> DataFrame:
    """All columns, then ``distance_<label>`` to every centre and the label of the nearest.

    Of centres at the same distance the first one wins. A null feature gives nulls, and so do a point of another
    width than the centres and one with a null in it.
    """
    require_model_columns(df, model)
    names = [f"distance_{label}" for label in model.labels]
    require_new_columns(df, [*names, cluster])
    passed = [quoted(name) for name in df.columns]
    nearest_gap, point, gaps = free_names(df, ["nearest", "point", "distances"])
    if not model.vector and len(model.features) * len(names) <= arithmetic.MOST_PLAIN_TERMS:
        distances = [quoted(name) for name in names]
        scored = df.select(
            *passed, *[gap.alias(name) for name, gap in zip(names, model.distances())]
        ).select("*", _least(distances).alias(nearest_gap))
        label = _first_match(F.col(nearest_gap), distances, model.labels)
        return scored.select(*passed, *distances, label.alias(cluster))
    whole = F.when(F.size(F.col(point)) == len(model.centers[0]), F.col(point))
    scored = df.select(*passed, model.point().alias(point)).select(
        *passed, arithmetic.array_distances(whole, model.centers).alias(gaps)
    )
    nearest = F.array_position(gaps, F.array_min(gaps))
    return scored.select(
        *passed,
        *[F.get(gaps, F.lit(i)).alias(name) for i, name in enumerate(names)],
        _label_at(nearest, model.labels).alias(cluster),
    )


def confusion_matrix(df: DataFrame, model: LogisticModel) -> DataFrame:
    """Score, then count every (Observed, Predicted) pair that occurs."""
    require_model_columns(df, model, with_target=True)
    # Only the model's own columns travel on: the scan reads nothing else.
    used = list(dict.fromkeys([*model.required_columns(), model.target]))
    narrow = df.select(*[quoted(name) for name in used])
    [predicted] = free_names(narrow, ["predicted"])
    return aggregates.count_pairs(predict_class(narrow, model, predicted), model.target, predicted)


def evaluate_regression(df: DataFrame, model: LinearModel | MixedLinearModel) -> DataFrame:
    """Score, then the one-row table of ``regression_metrics``."""
    require_model_columns(df, model, with_target=True)
    used = list(dict.fromkeys([*model.required_columns(), model.target]))
    narrow = df.select(*[quoted(name) for name in used])
    [predicted] = free_names(narrow, ["predicted"])
    return aggregates.regression_metrics(predict_linear(narrow, model, predicted), predicted, model.target)
