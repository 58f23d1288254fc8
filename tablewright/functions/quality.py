"""What makes a value bad, decided per column type.

* any type: null;
* float and double: also NaN and zero;
* integers and decimals: also zero;
* strings: also text that reads as the number zero or as NaN; other text is fine;
* dates, booleans and the rest: null only.

Every predicate is true or false, never null, so ``~bad`` keeps exactly the other rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.checks import check_choice
from tablewright.functions.names import quoted
from tablewright.functions.numbers import number_in_text

NULLS = "nulls"
NULLS_AND_ZEROS = "nulls_and_zeros"

# The reason text shown for each mode.
REASONS = {NULLS: "due to nulls", NULLS_AND_ZEROS: "due to nulls and zeros"}


def null_value(field: T.StructField) -> Column:
    return quoted(field.name).isNull()


def null_nan_or_zero_value(field: T.StructField) -> Column:
    value, kind = quoted(field.name), field.dataType
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return value.isNull() | F.isnan(value) | (value == F.lit(0.0))
    if isinstance(kind, T.NumericType):
        return value.isNull() | (value == F.lit(0))
    if isinstance(kind, T.StringType):
        # Text that is no number gives null; without the coalesce good rows would vanish with it.
        reads_as_bad = number_in_text(value).isin(0.0, float("nan"))
        return value.isNull() | F.coalesce(reads_as_bad, F.lit(False))
    return value.isNull()


def bad_row(df: DataFrame, mode: str = NULLS, is_bad: Column | None = None) -> Column:
    """True for a row with at least one bad value.

    ``is_bad`` replaces the rule of ``mode`` by a caller's own predicate; a null answer counts
    as not bad, so that good and bad rows together are always the input.
    """
    if is_bad is not None:
        return F.coalesce(is_bad, F.lit(False))
    check_choice("mode", mode, REASONS)
    rule = null_value if mode == NULLS else null_nan_or_zero_value
    # Text last: a row that is bad for another reason needs no look at its text.
    fields = sorted(df.schema, key=lambda field: isinstance(field.dataType, T.StringType))
    return any_of([rule(field) for field in fields])


def any_of(conditions: Sequence[Column]) -> Column:
    """True when one of the conditions is; halved rather than chained, so that a table with
    thousands of columns does not nest thousands deep."""
    if not conditions:
        return F.lit(False)
    if len(conditions) == 1:
        return conditions[0]
    middle = len(conditions) // 2
    return any_of(conditions[:middle]) | any_of(conditions[middle:])
