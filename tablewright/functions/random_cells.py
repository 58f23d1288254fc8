"""Random cells as pure functions of (seed, row id, column name).

No generator state: a row has the same content however the rows are split over tasks, and a
task that is run again after an executor is lost writes the same rows again. One md5 digest
per cell feeds all of it and stays in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Printable characters run from '!' (33) over 94 code points.
FIRST_PRINTABLE = 33
PRINTABLE_COUNT = 94
STRING_LENGTH = 5


def _digest(seed: int, row_id: Column, name: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string"), F.lit(f":{name}")))


def _hex_number(digest: Column, first: int, digits: int) -> Column:
    return F.conv(F.substring(digest, first, digits), 16, 10).cast("bigint")


def random_double(seed: int, row_id: Column, name: str) -> Column:
    """Uniform in [0, 1): 32 bits of the digest over 2^32."""
    return (_hex_number(_digest(seed, row_id, name), 1, 8) / F.lit(2.0**32)).alias(name)


def random_int(seed: int, row_id: Column, name: str) -> Column:
    """Uniform over the whole range of a 32-bit integer."""
    shifted = _hex_number(_digest(seed, row_id, name), 1, 8) - F.lit(2**31)
    return shifted.cast("int").alias(name)


def random_string(seed: int, row_id: Column, name: str) -> Column:
    """Five printable characters, each from its own six hex digits of the digest."""
    digest = _digest(seed, row_id, name)
    letters = [
        F.chr(_hex_number(digest, 1 + 6 * i, 6) % PRINTABLE_COUNT + FIRST_PRINTABLE)
        for i in range(STRING_LENGTH)
    ]
    return F.concat(*letters).alias(name)
