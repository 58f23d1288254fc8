"""Generated datasets. Rows come from ``range``, so no row passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.checks import check_integer
from tablewright.functions.random_cells import random_double, random_int, random_string


def sequence_source(spark: SparkSession, n: int = 10) -> DataFrame:
    """``n`` rows: ``Thing`` = "Thing", ``Number`` = 1..n."""
    check_integer("n", n, low=0)
    return spark.range(1, n + 1).select(
        F.lit("Thing").alias("Thing"), F.col("id").alias("Number")
    )


def random_source(
    spark: SparkSession,
    n_rows: int = 1000,
    n_double: int = 1,
    n_int: int = 1,
    n_string: int = 1,
    seed: int = 0,
) -> DataFrame:
    """Exactly ``n_rows`` rows with ``DoubleCol1..``, ``IntCol1..`` and ``StringCol1..``."""
    check_integer("n_rows", n_rows, low=1)
    for name, count in (("n_double", n_double), ("n_int", n_int), ("n_string", n_string)):
        check_integer(name, count, low=0)
    check_integer("seed", seed)
    if n_double + n_int + n_string == 0:
        raise ValueError("at least one column must be generated")
    row_id = F.col("id")
    cells = (
        [random_double(seed, row_id, f"DoubleCol{i}") for i in range(1, n_double + 1)]
        + [random_int(seed, row_id, f"IntCol{i}") for i in range(1, n_int + 1)]
        + [random_string(seed, row_id, f"StringCol{i}") for i in range(1, n_string + 1)]
    )
    return spark.range(n_rows).select(*cells)
