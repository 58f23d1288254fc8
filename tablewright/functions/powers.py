"""Square and cube of a numeric column, always in double precision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.checks import check_choice
from tablewright.functions.names import as_double

# The two kinds and the exponent of each; the kind is also the column suffix.
EXPONENTS = {"Pow2": 2, "Pow3": 3}


def power_name(column: str, kind: str) -> str:
    return f"{column}_{kind}"


def product_power(column: str, kind: str) -> Column:
    """``x*x`` or ``x*x*x``. Cast first: an int product would overflow under ANSI rules."""
    check_choice("kind", kind, EXPONENTS)
    factors = [as_double(column)] * EXPONENTS[kind]
    return reduce(lambda left, right: left * right, factors).alias(power_name(column, kind))


def sql_power(column: str, kind: str) -> Column:
    """The same through the SQL ``POWER`` function, as the table form of the operator does."""
    check_choice("kind", kind, EXPONENTS)
    return F.pow(as_double(column), F.lit(EXPONENTS[kind])).alias(power_name(column, kind))
