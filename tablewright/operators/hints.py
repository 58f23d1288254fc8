"""Physical hints a user may give: more partitions, or keeping an input that is read twice."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tablewright.checks import check_integer


def spread(df: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Deal the rows out evenly over ``num_partitions``, never fewer than the default parallelism.
    Rows are dealt by position, not by key, so no value can make one part large. Nothing runs:
    the parts that the input has are not counted."""
    if num_partitions is not None:
        check_integer("num_partitions", num_partitions, low=1)
    default = df.sparkSession.conf.get("spark.default.parallelism", None)
    if default is None:
        default = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(num_partitions or 1, int(default)))


@contextmanager
def persisted(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """Keep ``df`` while several results are taken from it, then let it go.

    Worth it for an input that is expensive to compute; a plain scan with a pushed filter is
    cheaper to read twice. Lost blocks are computed again from the input.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
