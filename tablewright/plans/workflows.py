"""Short chains of operators that users run as one step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tablewright.models import LinearModel, MixedLinearModel
from tablewright.operators.quality import drop_null_nan_zero_rows
from tablewright.operators.scoring import evaluate_regression
from tablewright.operators.training import fit_linear_regression


def clean_score_evaluate(df: DataFrame, model: LinearModel | MixedLinearModel) -> DataFrame:
    """Drop rows with nulls, NaNs or zeros, score the rest, and measure the error: one scan."""
    return evaluate_regression(drop_null_nan_zero_rows(df), model)


def train_then_evaluate(
    df: DataFrame,
    target: str,
    features: Sequence[str],
    penalty: float = 0.01,
    fit_intercept: bool = False,
) -> tuple[LinearModel, DataFrame]:
    """Fit a regression, then its metrics on the same table."""
    model = fit_linear_regression(df, target, features, penalty, fit_intercept)
    return model, evaluate_regression(df, model)
