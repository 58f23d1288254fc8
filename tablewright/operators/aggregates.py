"""Grouped counts and products, confusion matrix, regression metrics, table profile.

Every aggregate here combines on the map side first, so a key that holds a third of all rows
reaches the shuffle as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.checks import NUMERIC, require_columns, require_disjoint, require_selection
from tablewright.functions.names import as_double, quoted

OBSERVED, PREDICTED, COUNT = "Observed", "Predicted", "N"


def row_count(df: DataFrame) -> DataFrame:
    """One row, ``row_count``."""
    return df.agg(F.count("*").alias("row_count"))


def count_by_group(df: DataFrame, group_column: str) -> DataFrame:
    """``<group>`` in its own type and ``GroupCount``; null is a group like any other."""
    require_columns(df, [group_column])
    return df.groupBy(quoted(group_column)).agg(F.count("*").alias("GroupCount"))


def product_by_group(df: DataFrame, group_column: str, columns: Sequence[str]) -> DataFrame:
    """``GroupKey`` as text, then ``<col>_PRODUCT`` per column; nulls are skipped and a group
    of nothing but nulls has a null product."""
    require_selection(columns)
    require_disjoint([group_column], columns)
    require_columns(df, [group_column])
    require_columns(df, columns, NUMERIC)
    key, as_text = quoted(group_column), quoted(group_column).cast("string")
    products = [F.product(as_double(name)).alias(f"{name}_PRODUCT") for name in columns]
    names = [quoted(f"{name}_PRODUCT") for name in columns]
    if isinstance(df.schema[group_column].dataType, T.IntegralType):
        # One text per number: hash and shuffle the number, spell it out once per group.
        return df.groupBy(key).agg(*products).select(as_text.alias("GroupKey"), *names)
    return df.groupBy(as_text.alias("GroupKey")).agg(*products)


def count_pairs(df: DataFrame, observed: str, predicted: str) -> DataFrame:
    """``Observed``, ``Predicted`` and ``N`` for every pair of labels that occurs."""
    require_columns(df, [observed, predicted])
    return df.groupBy(
        quoted(observed).cast("string").alias(OBSERVED),
        quoted(predicted).cast("string").alias(PREDICTED),
    ).agg(F.count("*").alias(COUNT))


def regression_metrics(df: DataFrame, prediction_column: str, label_column: str) -> DataFrame:
    """One row with ``explainedVariance, meanAbsoluteError, meanSquaredError,
    rootMeanSquaredError, r2``, in a single pass.

    A row with a null prediction or label counts for none of them. A constant label has no
    variance to explain, so its r2 is null.
    """
    require_columns(df, [prediction_column, label_column], NUMERIC)
    p, y = F.col("p"), F.col("y")
    moments = (
        df.select(as_double(prediction_column).alias("p"), as_double(label_column).alias("y"))
        .where(p.isNotNull() & y.isNotNull())
        .agg(
            F.var_pop(p).alias("var_p"),
            F.var_pop(y).alias("var_y"),
            F.avg(p - y).alias("bias"),
            F.avg(F.abs(p - y)).alias("mae"),
            F.avg((p - y) * (p - y)).alias("mse"),
        )
    )
    return moments.select(
        (F.col("var_p") + F.col("bias") * F.col("bias")).alias("explainedVariance"),
        F.col("mae").alias("meanAbsoluteError"),
        F.col("mse").alias("meanSquaredError"),
        F.sqrt("mse").alias("rootMeanSquaredError"),
        (F.lit(1.0) - F.try_divide("mse", "var_y")).alias("r2"),
    )


def table_profile(df: DataFrame) -> DataFrame:
    """A row per column: name, data type, rows and nulls, from one scan."""
    names = df.columns
    counts = df.agg(
        F.count("*").alias("n"), *[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)]
    )
    rows = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col("n").alias("n_rows"),
            (F.col("n") - F.col(f"c{i}")).alias("n_nulls"),
        )
        for i, field in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*rows)))
