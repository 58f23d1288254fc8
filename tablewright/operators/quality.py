"""Rows with nulls, NaNs or zeros: keep, separate, report; and occurrences of a number."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.checks import check_bounds, require_columns
from tablewright.functions.names import quoted
from tablewright.functions.numbers import number_in_text
from tablewright.functions.quality import NULLS, NULLS_AND_ZEROS, REASONS, bad_row


def split_bad_rows(
    df: DataFrame, mode: str = NULLS, is_bad: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows); together they are the input.

    Both are plain filters, so writing the two reads the input twice with the filter pushed to
    the scan. When the input itself is expensive to compute, wrap it in ``hints.persisted``.
    """
    bad = bad_row(df, mode, is_bad)
    return df.where(~bad), df.where(bad)


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop every row with a null in any column. NaN is a value and stays."""
    return split_bad_rows(df, NULLS)[0]


def drop_null_nan_zero_rows(df: DataFrame) -> DataFrame:
    """Drop every row with a null, NaN or zero in any column."""
    return split_bad_rows(df, NULLS_AND_ZEROS)[0]


def bad_data_report(
    df: DataFrame,
    mode: str = NULLS,
    is_bad: Column | None = None,
    reason: str | None = None,
) -> DataFrame:
    """One row: rows in, rows kept, rows removed, the share removed, and why. One scan."""
    bad = bad_row(df, mode, is_bad)
    if reason is None:
        reason = REASONS[mode] if is_bad is None else "by a custom rule"
    counts = df.agg(F.count("*").alias("input_rows"), F.count_if(bad).alias("removed_rows"))
    percent = F.try_divide(F.lit(100.0) * F.col("removed_rows"), F.col("input_rows"))
    return counts.select(
        "input_rows",
        (F.col("input_rows") - F.col("removed_rows")).alias("output_rows"),
        "removed_rows",
        percent.alias("removed_pct"),
        F.lit(reason).alias("reason"),
    )


def count_value_occurrences(df: DataFrame, column: str, x: float = 1.0) -> DataFrame:
    """One row: how often ``column``, read as a double, equals ``x``.

    Text that is no number never matches, and NaN equals nothing, itself included.
    """
    if not (isinstance(x, float) and math.isnan(x)):
        check_bounds("x", x)
    require_columns(df, [column])
    value = quoted(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        number = number_in_text(value)
    else:
        number = value.try_cast("double")
    matches = F.lit(False) if math.isnan(x) else number == F.lit(float(x))
    return df.agg(F.count_if(matches).alias("occurrences"))
