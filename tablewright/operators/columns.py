"""Projections and derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.checks import (
    DATETIME,
    NUMERIC,
    check_integer,
    free_names,
    require_columns,
    require_new_columns,
    require_selection,
)
from tablewright.functions.dates import DEFAULT_PATTERN, formatted_date
from tablewright.functions.names import quoted
from tablewright.functions.powers import power_name, product_power, sql_power
from tablewright.operators.aggregates import row_count
from tablewright.operators.hints import spread


def column_filter(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the chosen columns, in the order of selection."""
    require_selection(columns)
    require_columns(df, columns)
    return df.select(*[quoted(name) for name in columns])


def column_filter_advanced(
    df: DataFrame,
    columns: Sequence[str],
    repartition: bool = False,
    num_partitions: int | None = None,
) -> tuple[DataFrame, dict]:
    """Keep at least two chosen columns; optionally spread the rows over more partitions.

    The number of partitions is the user's, but never below the default parallelism. Columns are
    dropped before the shuffle, not after it. The side result holds the kept columns and the row
    count as a one-row table: counting the input reads no column, and unlike a counter attached
    to a running query it is exact when a lost executor makes a stage run twice.
    """
    require_selection(columns, least=2)
    kept = column_filter(df, columns)
    if repartition:
        kept = spread(kept, num_partitions)
    return kept, {"columns": list(columns), "row_count": row_count(df)}


def power_features(df: DataFrame, columns: Sequence[str], kind: str = "Pow2") -> DataFrame:
    """All columns, then ``<col>_Pow2`` = x*x or ``<col>_Pow3`` = x*x*x as doubles."""
    require_selection(columns)
    require_columns(df, columns, NUMERIC)
    require_new_columns(df, [power_name(name, kind) for name in columns])
    return df.select("*", *[product_power(name, kind) for name in columns])


def power_features_with_info(
    df: DataFrame, columns: Sequence[str], kind: str = "Pow2"
) -> tuple[DataFrame, dict]:
    """The same, with the kind and the row count (a one-row table) as side result."""
    return power_features(df, columns, kind), {"transformation": kind, "row_count": row_count(df)}


def power_features_table(df: DataFrame, columns: Sequence[str], kind: str = "Pow2") -> DataFrame:
    """The table form: SQL ``POWER(col, n)``, always double. Save it with
    ``sinks.save_as_table_or_view``."""
    require_selection(columns)
    require_columns(df, columns, NUMERIC)
    require_new_columns(df, [power_name(name, kind) for name in columns])
    return df.select("*", *[sql_power(name, kind) for name in columns])


def format_date_column(df: DataFrame, column: str, pattern: str = DEFAULT_PATTERN) -> DataFrame:
    """All columns, then ``<col>_formatted``: the same instant as text in ``pattern``."""
    require_columns(df, [column], DATETIME)
    require_new_columns(df, [f"{column}_formatted"])
    return df.select("*", formatted_date(column, pattern))


def column_values(df: DataFrame, column: str, n: int, distinct: bool = True) -> DataFrame:
    """The first ``n`` values of one column in sorted order, each once unless told otherwise."""
    check_integer("n", n, low=1)
    require_columns(df, [column])
    values = df.select(quoted(column))
    if distinct:
        return values.distinct().orderBy(quoted(column)).limit(n)
    return _first_rows(values, n)


def pair_sample(df: DataFrame, x: str, y: str, n: int) -> DataFrame:
    """Columns ``x`` and ``y`` of the first ``n`` rows in (x, y) order."""
    check_integer("n", n, low=1)
    require_selection([x, y], least=2)
    require_columns(df, [x, y])
    return _first_rows(df.select(quoted(x), quoted(y)), n)


def _first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows by all columns, for any n. Each part is sorted where it lies and only its first n rows go
    on, to as many groups as there are shuffle partitions; of each group again n rows reach the task that merges them."""
    [place] = free_names(df, ["place"])
    groups = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_all = [quoted(name) for name in df.columns]
    # The id counts rows within a part from 0; its upper bits are the part's number.
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    thinned = df.sortWithinPartitions(*by_all).withColumn(place, in_part).where(quoted(place) < n).select(*by_all)
    return thinned.repartition(groups).orderBy(*by_all).limit(n)
