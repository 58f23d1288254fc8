"""Numbers written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything the cast to double accepts, and little else. A failed parse costs an
# exception inside the cast, a hundred times the price of this test, so words are kept away from it.
# Blanks and control characters around a number are ignored by the cast.
NUMBER_PATTERN = (
    r"^[\x00-\x20\x7f]*"
    r"[+-]?"
    r"(?:[nN][aA][nN]"
    r"|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?"
    r"|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[dDfF]?"
    r"|0[xX][0-9a-fA-F]*\.?[0-9a-fA-F]*[pP][+-]?[0-9]+[dDfF]?)"
    r"[\x00-\x20\x7f]*$"
)

# A number starts with a digit, a sign, a point or a blank, all of them at or below
# "9", or with the first letter of Infinity or NaN, or with a delete character.
LAST_DIGIT = 57
OTHER_STARTS = (73, 78, 105, 110, 127)


def number_in_text(text: Column) -> Column:
    """``text`` as a double, null when it is no number."""
    first = F.ascii(text)
    may_be_number = (first <= LAST_DIGIT) | first.isin(*OTHER_STARTS)
    return F.when(may_be_number & text.rlike(NUMBER_PATTERN), text.try_cast("double"))
