"""One-hot encoding, with given or learned categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.checks import (
    CATEGORICAL,
    check_integer,
    free_names,
    require_columns,
    require_new_columns,
    require_selection,
)
from tablewright.functions.names import quoted
from tablewright.models import Encoding

MOST_CATEGORIES = 100_000


def one_hot_encode(
    df: DataFrame, column: str, categories: Sequence[str], base: str | None = None
) -> DataFrame:
    """All columns, then ``<col>_<category>`` = 1.0 or 0.0 per category except the base, which is
    all zeros. A null or unlisted value has null indicators."""
    return apply_encodings(df, [Encoding(column, tuple(categories), base)])


def apply_encodings(df: DataFrame, encodings: Sequence[Encoding]) -> DataFrame:
    require_columns(df, [encoding.column for encoding in encodings])
    require_new_columns(df, [name for encoding in encodings for name in encoding.names()])
    passed = [quoted(name) for name in df.columns]
    # Whether a value is listed at all is worked out once per row, not once per indicator.
    flags = free_names(df, [f"known_{i}" for i in range(len(encodings))])
    known = [
        quoted(encoding.column).isin(encoding.known()).alias(flag)
        for flag, encoding in zip(flags, encodings)
    ]
    indicators = [
        F.when(quoted(flag), (quoted(encoding.column) == F.lit(value)).cast("double"))
        .alias(name)
        for flag, encoding in zip(flags, encodings)
        for value, name in zip(encoding.encoded(), encoding.names())
    ]
    return df.select(*passed, *known).select(*passed, *indicators)


def learn_encodings(
    df: DataFrame, columns: Sequence[str], most_categories: int = MOST_CATEGORIES
) -> list[Encoding]:
    """The categories of each text column in sorted order, the first as base; one scan for all.

    What comes back to the driver is as large as the model: more than ``most_categories`` in total
    are an error.
    """
    check_integer("most_categories", most_categories, low=1)
    require_selection(columns)
    require_columns(df, columns, CATEGORICAL)
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("place"), quoted(name).alias("category"))
            for i, name in enumerate(columns)
        ]
    )
    different = df.select(F.inline(pairs)).where(F.col("category").isNotNull()).distinct()
    found = different.limit(most_categories + 1).collect()
    if len(found) > most_categories:
        raise ValueError(f"more than {most_categories} categories in the columns {list(columns)}")
    encodings = []
    for i, name in enumerate(columns):
        values = tuple(sorted(row.category for row in found if row.place == i))
        encodings.append(Encoding(name, values, values[0] if values else None))
    return encodings
