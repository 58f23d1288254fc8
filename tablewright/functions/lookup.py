"""Numbers by text, for a handful of texts or for many thousands."""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to so many texts a chain of comparisons is as fast as a table.
FEW_TEXTS = 8


def looked_up(text: Column, numbers: Mapping[str, float]) -> Column:
    """The number of a text, null where there is none.

    Spark searches a map from its beginning. Here the texts are dealt by their CRC-32 into as many maps as there are
    texts, so that a lookup is one step into an array and a search among one or two. The array is a
    literal once the plan is optimised.
    """
    if any(not math.isfinite(number) for number in numbers.values()):
        raise ValueError("only finite numbers can be looked up")
    if not numbers:
        return F.lit(None).cast("double")
    if len(numbers) <= FEW_TEXTS:
        [(first, number), *rest] = numbers.items()
        found = F.when(text == F.lit(first), F.lit(float(number)))
        for value, number in rest:
            found = found.when(text == F.lit(value), F.lit(float(number)))
        return found
    buckets: list[dict[str, float]] = [{} for _ in numbers]
    for value, number in numbers.items():
        buckets[zlib.crc32(value.encode("utf-8")) % len(buckets)][value] = float(number)
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,double>>")
    bucket = F.crc32(text.cast("string").cast("binary")) % F.lit(len(buckets))
    return F.get(table, bucket.cast("int"))[text.cast("string")]
