"""Weighted sums and distances as columns, for a handful of features or for thousands.

A short sum is plain arithmetic, which whole-stage code generation turns into a few machine
instructions. A long one would nest too deep for the compiler, so it becomes an array fold with
a flat plan. Where a point has many sums or distances, blocks of points against all of them are
worked out in numpy over Arrow batches. All three add in the same order and give the same doubles.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# How many terms one projection may spell out before it turns to arrays.
MOST_PLAIN_TERMS = 200
# Doubles worked on at a time (they fit a core's cache) and handed back in one Arrow batch.
NUMBERS_AT_ONCE = 1 << 15
NUMBERS_OF_BATCH = 1 << 20


def literals(rows: Sequence[Sequence[float]]) -> Column:
    """An array of arrays, one literal once the plan is optimised."""
    text = json.dumps([[float(number) for number in row] for row in rows])
    return F.from_json(F.lit(text), "array<array<double>>", {"allowNonNumericNumbers": "true"})


def weighted_sum(values: Sequence[Column], weights: Sequence[float], start: float) -> Column:
    """``start + w1*v1 + w2*v2 + ...``, null when a value is null."""
    if len(values) != len(weights):
        raise ValueError(f"{len(weights)} coefficients for {len(values)} features")
    if len(values) > MOST_PLAIN_TERMS:
        rows = array_weighted_sums(F.array(*values), [weights], [start])
        return F.get(rows, F.lit(0))
    total = F.lit(float(start))
    for value, weight in zip(values, weights):
        total = total + F.lit(float(weight)) * value
    return total


def array_weighted_sums(
    point: Column, weights: Sequence[Sequence[float]], starts: Sequence[float]
) -> Column:
    """Weighted sums of one point, held as an array, for every row of ``weights``, as an array."""
    if len(weights) > 1:
        return block_weighted_sums(point, weights, starts)

    def to_sum(row: Column, start: Column) -> Column:
        products = F.zip_with(point, row, lambda value, weight: weight * value)
        return F.aggregate(products, start, lambda total, product: total + product)

    return F.zip_with(literals(weights), F.get(literals([starts]), F.lit(0)), to_sum)


def in_blocks(
    point: Column, rows: Sequence[Sequence[float]], block: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> Column:
    """An array with a number for every one of ``rows``, by ``block(points, features x rows)``.

    Null for a point that is null, has a null in it, or is of another width. Only the points go to
    Python; what a task holds is bounded by ``NUMBERS_OF_BATCH`` whatever the number of rows.
    """
    table = np.array(rows, np.float64).T.copy()
    at_once, of_batch = (max(1, most // len(rows)) for most in (NUMBERS_AT_ONCE, NUMBERS_OF_BATCH))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        width, count = table.shape
        for batch in batches:
            # A batch of no points is handed back as one, too.
            for first in range(0, max(1, len(batch)), of_batch):
                points = batch.slice(first, of_batch)
                sound = pc.fill_null(pc.equal(pc.list_value_length(points), width), False)
                flat = points.filter(sound).flatten()
                sound = sound.to_numpy(zero_copy_only=False).copy()
                values = flat.to_numpy(zero_copy_only=False).reshape(sound.sum(), width)
                if flat.null_count:
                    whole = flat.is_valid().to_numpy(zero_copy_only=False).reshape(values.shape).all(1)
                    sound[sound] = whole
                    values = values[whole]
                out = np.empty((len(values), count))
                with np.errstate(all="ignore"):
                    for start in range(0, len(values), at_once):
                        out[start : start + at_once] = block(values[start : start + at_once], table)
                ends = np.append(0, np.cumsum(np.where(sound, count, 0))).astype(np.int32)
                yield pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()), mask=pa.array(~sound))

    return F.arrow_udf(run, "array<double>")(point)


def block_weighted_sums(
    point: Column, weights: Sequence[Sequence[float]], starts: Sequence[float]
) -> Column:
    """``array_weighted_sums`` in numpy; null, not an array of nulls, where a value is null."""
    first = np.array(starts, np.float64)

    def sums(points: np.ndarray, table: np.ndarray) -> np.ndarray:
        total = np.repeat(first[None, :], len(points), 0)
        product = np.empty_like(total)
        for place, row in enumerate(table):
            np.multiply(row, points[:, place, None], out=product)
            total += product
        return total

    return in_blocks(point, weights, sums)


def distance(values: Sequence[Column], center: Sequence[float]) -> Column:
    """Euclidean distance from the point ``values`` to ``center``, null when a value is null."""
    total = F.lit(0.0)
    for value, place in zip(values, center):
        gap = value - F.lit(float(place))
        total = total + gap * gap
    return F.sqrt(total)


def array_distances(point: Column, centers: Sequence[Sequence[float]]) -> Column:
    """The distances of one point, held as an array, to every centre, as an array.

    Null where a value is null or the point is of another width.
    """

    def distances(points: np.ndarray, table: np.ndarray) -> np.ndarray:
        total = np.zeros((len(points), table.shape[1]))
        gap = np.empty_like(total)
        for place, row in enumerate(table):
            np.subtract(points[:, place, None], row, out=gap)
            gap *= gap
            total += gap
        return np.sqrt(total)

    return in_blocks(point, centers, distances)
