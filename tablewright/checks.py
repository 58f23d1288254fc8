"""Argument checks that run before a plan is built: columns, column classes, bounds, choices."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ALL = "all"
NUMERIC = "numeric"
CATEGORICAL = "categorical"
DATETIME = "datetime"

_CLASS_TYPES = {
    ALL: (T.DataType,),
    NUMERIC: (T.NumericType,),
    CATEGORICAL: (T.StringType,),
    DATETIME: (T.DateType, T.TimestampType, T.TimestampNTZType),
}


def columns_of_class(df: DataFrame, column_class: str) -> list[str]:
    """Names of the columns a selector of this class offers, in table order."""
    check_choice("column class", column_class, _CLASS_TYPES)
    kinds = _CLASS_TYPES[column_class]
    return [field.name for field in df.schema if isinstance(field.dataType, kinds)]


def spelling(df: DataFrame) -> Callable[[str], str]:
    """How the session tells names apart: as they are, or whatever their case."""
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    return str if sensitive else str.lower


def free_names(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Names for columns that come and go within an operator: like ``names``, but none of the table's."""
    spelled = spelling(df)
    taken, found = {spelled(name) for name in df.columns}, []
    for name in names:
        while spelled(name) in taken:
            name = "_" + name
        taken.add(spelled(name))
        found.append(name)
    return found


def require_columns(
    df: DataFrame, names: Sequence[str], column_class: str = ALL, purpose: str = ""
) -> None:
    """Raise ``ValueError`` naming every column that is missing or of another class."""
    reason = f" needed for {purpose}" if purpose else ""
    spelled = spelling(df)
    present = {spelled(name) for name in df.columns}
    missing = [name for name in names if spelled(name) not in present]
    if missing:
        raise ValueError(f"the input is missing the columns {missing}{reason}")
    offered = {spelled(name) for name in columns_of_class(df, column_class)}
    unfit = [name for name in names if spelled(name) not in offered]
    if unfit:
        raise ValueError(f"the columns {unfit}{reason} are not {column_class}")


def require_selection(names: Sequence[str], least: int = 1) -> None:
    """A selection of columns: at least ``least`` of them, none twice."""
    if isinstance(names, str):
        raise ValueError("columns must be a list of names, not one string")
    if len(set(names)) != len(names):
        raise ValueError(f"a column is selected twice in {list(names)}")
    if len(names) < least:
        raise ValueError(f"at least {least} columns must be selected, got {list(names)}")


def require_new_columns(df: DataFrame, names: Sequence[str]) -> None:
    """Derived columns: none may share its name with an input column or with another one."""
    spelled = spelling(df)
    seen = {spelled(name) for name in df.columns}
    taken = []
    for name in names:
        if spelled(name) in seen:
            taken.append(name)
        seen.add(spelled(name))
    if taken:
        raise ValueError(f"the columns {taken} already exist")


def require_disjoint(first: Sequence[str], second: Sequence[str]) -> None:
    """Selectors of one group must pick different columns."""
    shared = sorted(set(first) & set(second))
    if shared:
        raise ValueError(f"the columns {shared} are selected for two purposes")


def check_choice(name: str, value: object, allowed: Iterable[object]) -> None:
    choices = list(allowed)
    if value not in choices:
        raise ValueError(f"{name} must be one of {choices}, got {value!r}")


def check_bounds(
    name: str, value: float, low: float | None = None, high: float | None = None
) -> None:
    """Raise when ``value`` is no number or lies outside the bounds, which belong to it."""
    if isinstance(value, bool) or not isinstance(value, (int, float)) or value != value:
        raise ValueError(f"{name} must be a number, got {value!r}")
    if low is not None and value < low:
        raise ValueError(f"{name} = {value} is below its bound {low}")
    if high is not None and value > high:
        raise ValueError(f"{name} = {value} is above its bound {high}")


def check_integer(name: str, value: int, low: int | None = None, high: int | None = None) -> None:
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{name} must be an integer, got {value!r}")
    check_bounds(name, value, low, high)

