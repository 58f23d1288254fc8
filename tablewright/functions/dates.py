"""Date patterns that mean the same in Spark and in the classic Java date formatter.

Some letters are refused by one of the two, others are accepted by both with another meaning
(day of week in month, fraction against milliseconds). Only repeats that print the same text
in both are allowed; everything else is an error before a plan is built.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.names import quoted

DEFAULT_PATTERN = "MM/dd/yyyy"

# Allowed repeats of each pattern letter.
ALLOWED_REPEATS = {
    "G": (1, 2, 3),
    "y": (1, 2, 3, 4, 5, 6),
    "M": (1, 2, 3, 4),
    "L": (1, 2, 3, 4),
    "D": (1, 2, 3),
    "d": (1, 2),
    "E": (1, 2, 3, 4),
    "a": (1,),
    "H": (1, 2),
    "k": (1, 2),
    "K": (1, 2),
    "h": (1, 2),
    "m": (1, 2),
    "s": (1, 2),
    "S": (3,),
    "z": (1, 2, 3, 4),
    "Z": (1, 2, 3),
    "X": (1, 2, 3),
}

# Unquoted marks with a meaning of their own in one of the two languages only.
RESERVED_MARKS = "[]{}#"

_QUOTED_TEXT = re.compile(r"'[^']*'")
_LETTER_RUN = re.compile(r"([A-Za-z])\1*")


def check_date_pattern(pattern: str) -> str:
    """Return ``pattern`` or raise ``ValueError`` when it is empty or not portable."""
    if not pattern:
        raise ValueError("the date pattern is empty")
    bare = _QUOTED_TEXT.sub(" ", pattern)
    if "'" in bare:
        raise ValueError(f"unbalanced quote in date pattern {pattern!r}")
    for mark in RESERVED_MARKS:
        if mark in bare:
            raise ValueError(f"{mark!r} must be quoted in date pattern {pattern!r}")
    for run in _LETTER_RUN.finditer(bare):
        letter, repeats = run.group(1), len(run.group(0))
        if repeats not in ALLOWED_REPEATS.get(letter, ()):
            raise ValueError(f"{run.group(0)!r} is not allowed in date pattern {pattern!r}")
    return pattern


def formatted_date(column: str, pattern: str = DEFAULT_PATTERN) -> Column:
    """``column`` as text in ``pattern``, named ``<column>_formatted``."""
    check_date_pattern(pattern)
    return F.date_format(quoted(column), pattern).alias(f"{column}_formatted")
