"""Fitted models as plain numbers that render to columns.

A model carries no data and no session, so it can be kept, compared or sent anywhere; scoring a
table with it is a projection that Catalyst plans like any other.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.checks import require_columns
from tablewright.functions.arithmetic import distance, weighted_sum
from tablewright.functions.lookup import looked_up
from tablewright.functions.names import as_double, quoted

INTERCEPT = "Intercept"


def small_table(spark: SparkSession, rows: Sequence[Sequence], columns: Sequence[str]) -> DataFrame:
    """A table of model-sized rows of texts, numbers and arrays of numbers, planned as one literal."""
    kinds = T.StructType([T.StructField(f"c{i}", _kind(value)) for i, value in enumerate(rows[0])])
    named = [{f"c{i}": value for i, value in enumerate(row)} for row in rows]
    read = F.from_json(F.lit(json.dumps(named)), T.ArrayType(kinds), {"allowNonNumericNumbers": "true"})
    return spark.range(1, numPartitions=1).select(F.inline(read)).toDF(*columns)


def _kind(value) -> T.DataType:
    if isinstance(value, str):
        return T.StringType()
    return T.ArrayType(T.DoubleType()) if isinstance(value, (list, tuple)) else T.DoubleType()


@dataclass(frozen=True)
class LinearModel:
    """y = intercept + a1*x1 + ... + an*xn."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float = 0.0
    target: str = ""

    def __post_init__(self) -> None:
        if len(self.features) != len(self.coefficients):
            raise ValueError(
                f"{len(self.coefficients)} coefficients for {len(self.features)} features"
            )

    def required_columns(self) -> list[str]:
        return list(self.features)

    def to_column(self) -> Column:
        values = [as_double(name) for name in self.features]
        return weighted_sum(values, self.coefficients, self.intercept)

    def equation(self) -> str:
        terms = [f"{weight} * {name}" for name, weight in zip(self.features, self.coefficients)]
        return f"{self.target or 'y'} = " + " + ".join([str(self.intercept), *terms])

    def weights(self) -> list[tuple[str, float]]:
        return [(INTERCEPT, self.intercept), *zip(self.features, self.coefficients)]


@dataclass(frozen=True)
class ClassWeights:
    """The linear margin of one class against the base class."""

    label: str
    coefficients: tuple[float, ...]
    intercept: float = 0.0


@dataclass(frozen=True)
class LogisticModel:
    """Multinomial logistic scoring: weight exp(margin) per class, weight 1 for the base class.

    ``scoring.predict_class`` picks the heaviest class by its margin.
    """

    features: tuple[str, ...]
    classes: tuple[ClassWeights, ...]
    base: str
    target: str = ""

    def __post_init__(self) -> None:
        if not self.classes:
            raise ValueError("a logistic model needs a class besides its base class")
        labels = [item.label for item in self.classes] + [self.base]
        if len(set(labels)) != len(labels):
            raise ValueError(f"a class is listed twice in {labels}")
        for item in self.classes:
            if len(item.coefficients) != len(self.features):
                raise ValueError(
                    f"{len(item.coefficients)} coefficients of class {item.label!r} "
                    f"for {len(self.features)} features"
                )

    def required_columns(self) -> list[str]:
        return list(self.features)

    def margins(self) -> list[Column]:
        """The margin of every class but the base, in order."""
        values = [as_double(name) for name in self.features]
        return [weighted_sum(values, item.coefficients, item.intercept) for item in self.classes]


@dataclass(frozen=True)
class ClusterModel:
    """Cluster centres; a row belongs to the nearest one. With ``vector`` the one feature is an array column that
    holds whole points."""

    features: tuple[str, ...]
    centers: tuple[tuple[float, ...], ...]
    labels: tuple[str, ...] = field(default=())
    vector: bool = False

    def __post_init__(self) -> None:
        if not self.centers:
            raise ValueError("a cluster model needs at least one centre")
        if self.vector and len(self.features) != 1:
            raise ValueError("points are in one column")
        width = len(self.centers[0]) if self.vector else len(self.features)
        if any(len(center) != width for center in self.centers):
            raise ValueError("every centre needs one value per feature")
        if not self.labels:
            names = tuple(f"Cluster_{i}" for i in range(len(self.centers)))
            object.__setattr__(self, "labels", names)
        if len(self.labels) != len(self.centers):
            raise ValueError(f"{len(self.labels)} labels for {len(self.centers)} centres")

    def required_columns(self) -> list[str]:
        return list(self.features)

    def point(self) -> Column:
        """The row's point as an array."""
        if self.vector:
            return quoted(self.features[0]).cast("array<double>")
        return F.array(*[as_double(name) for name in self.features])

    def distances(self) -> list[Column]:
        """The distance to every centre, in order."""
        values = [as_double(name) for name in self.features]
        return [distance(values, center) for center in self.centers]

    def centers_table(self, spark: SparkSession) -> DataFrame:
        """``ClusterName`` and one column per feature (an array for whole points), a row per centre."""
        rows = [(label, *([center] if self.vector else center)) for label, center in zip(self.labels, self.centers)]
        return small_table(spark, rows, ["ClusterName", *self.features])


@dataclass(frozen=True)
class Encoding:
    """One-hot encoding of a text column; the base category is all zeros."""

    column: str
    categories: tuple[str, ...]
    base: str | None = None

    def __post_init__(self) -> None:
        if len(set(self.categories)) != len(self.categories):
            raise ValueError(f"a category of {self.column!r} is listed twice")

    def encoded(self) -> list[str]:
        """The categories that get an indicator, in order."""
        return [value for value in self.categories if value != self.base]

    def known(self) -> list[str]:
        base = [] if self.base is None or self.base in self.categories else [self.base]
        return [*self.categories, *base]

    def names(self) -> list[str]:
        return [f"{self.column}_{value}" for value in self.encoded()]


@dataclass(frozen=True)
class MixedLinearModel:
    """Linear model over continuous columns and one-hot encoded text columns, in that order."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    encodings: tuple[Encoding, ...]
    category_coefficients: tuple[tuple[float, ...], ...]
    intercept: float = 0.0
    target: str = ""

    def __post_init__(self) -> None:
        if len(self.features) != len(self.coefficients):
            raise ValueError(
                f"{len(self.coefficients)} coefficients for {len(self.features)} features"
            )
        if len(self.encodings) != len(self.category_coefficients):
            raise ValueError("every encoding needs its coefficients")
        for encoding, weights in zip(self.encodings, self.category_coefficients):
            if len(encoding.encoded()) != len(weights):
                raise ValueError(f"every category of {encoding.column!r} needs one coefficient")

    def required_columns(self) -> list[str]:
        return [*self.features, *[encoding.column for encoding in self.encodings]]

    def to_column(self) -> Column:
        """A category adds its own coefficient, looked up in a table of literals, and the base adds 0,
        instead of a product per indicator. An unseen or null category gives null."""
        total = weighted_sum([as_double(name) for name in self.features], self.coefficients,
                             self.intercept)
        for encoding, weights in zip(self.encodings, self.category_coefficients):
            effects = dict(zip(encoding.encoded(), map(float, weights)))
            if encoding.base is not None:
                effects[encoding.base] = 0.0
            total = total + looked_up(quoted(encoding.column), effects)
        return total

    def weights(self) -> list[tuple[str, float]]:
        rows = [(INTERCEPT, self.intercept), *zip(self.features, self.coefficients)]
        for encoding, weights in zip(self.encodings, self.category_coefficients):
            rows += zip(encoding.names(), weights)
        return rows

    def equation(self) -> str:
        terms = [f"{weight} * {name}" for name, weight in self.weights()[1:]]
        return f"{self.target or 'y'} = " + " + ".join([str(self.intercept), *terms])


def weights_table(spark: SparkSession, model: LinearModel | MixedLinearModel) -> DataFrame:
    """``Predictors`` and ``Weights``, the intercept first."""
    return small_table(spark, model.weights(), ["Predictors", "Weights"])


def model_equation(model: LinearModel | MixedLinearModel) -> str:
    """``y = b + a1 * x1 + ...``"""
    return model.equation()


def require_model_columns(df: DataFrame, model, *, with_target: bool = False) -> None:
    """Name every column the model needs and the table lacks. Types are matched leniently."""
    names = model.required_columns()
    if with_target:
        if not model.target:
            raise ValueError("the model names no dependent column")
        names = [*names, model.target]
    require_columns(df, names, purpose="evaluating the model")
