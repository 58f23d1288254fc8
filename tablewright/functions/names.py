"""Column references that are safe for any column name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column called exactly ``name``, also when it holds dots, blanks or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_double(name: str) -> Column:
    """The numeric column ``name`` as a double."""
    return quoted(name).cast("double")
