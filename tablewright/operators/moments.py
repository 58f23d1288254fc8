"""Means and co-moments of the columns of a table in one scan, whatever their number.

Each task adds up blocks of the co-moment matrix over its Arrow batches; blocks of the same columns
are merged by tasks of their own, and the driver gets one row per block. Parts are merged by their
means, so a large mean costs no digits. The same pass counts what may not be fitted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.names import quoted

# Columns of one block: 512 kB of doubles.
BLOCK = 256
# Tasks that merge the parts of a block before one does, where the parts are more than a few kB.
MERGERS, FEW_COLUMNS = 8, 32
# Squares of larger numbers, added up, may leave the range of doubles.
LARGEST = 1e150

FIELDS = "i int, j int, part int, n long, missing long, infinite long, large long, means_i binary, means_j binary, second binary"
COUNTS = ("n", "missing", "infinite", "large")


@dataclass
class Moments:
    """``n`` sound rows, their means and the sums of products of deviations from them."""

    n: int
    missing: int
    infinite: int
    large: int
    means: np.ndarray
    second: np.ndarray

    def check(self, purpose: str) -> None:
        """The one contract of all fits: there are rows, and all of them are sound."""
        if self.n + self.missing + self.infinite + self.large == 0:
            raise ValueError(f"there are no rows to {purpose}")
        if self.missing:
            raise ValueError(f"{self.missing} rows have a null or NaN in the columns to {purpose}")
        if self.infinite:
            raise ValueError(f"{self.infinite} rows have an infinite value in the columns to {purpose}")
        if self.large or not np.isfinite(self.second).all():
            raise ValueError(f"the columns to {purpose} hold too large values")


@dataclass
class _Part:
    n: int
    means_i: np.ndarray
    means_j: np.ndarray
    second: np.ndarray

    def add(self, other: _Part) -> None:
        total = self.n + other.n
        if not other.n:
            return
        gap_i, gap_j = other.means_i - self.means_i, other.means_j - self.means_j
        self.second += other.second + np.outer(gap_i, gap_j) * (self.n * other.n / total)
        self.means_i = self.means_i + gap_i * (other.n / total)
        self.means_j = self.means_j + gap_j * (other.n / total)
        self.n = total


def _row(i: int, j: int, part: int, counts: dict[str, int], block: _Part) -> pa.RecordBatch:
    values = [i, j, part, *[counts[c] for c in COUNTS], block.means_i.tobytes(), block.means_j.tobytes(), block.second.tobytes()]
    kinds = [pa.int32()] * 3 + [pa.int64()] * 4 + [pa.binary()] * 3
    names = [f.split()[0] for f in FIELDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)


def _partial(width: int, block: int, mergers: int):
    edges = [(a, min(a + block, width)) for a in range(0, width, block)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = dict.fromkeys(COUNTS, 0)
        parts = {
            (i, j): _Part(0, np.zeros(b - a), np.zeros(d - c), np.zeros((b - a, d - c)))
            for i, (a, b) in enumerate(edges) for j, (c, d) in enumerate(edges) if i <= j
        }
        for batch in batches:
            if not batch.num_rows:
                continue
            # A null reads as NaN. The last column tells of nulls in columns without numbers.
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]).astype(np.float64, copy=False)
            missing = np.isnan(x).any(1) | batch.column(width).to_numpy(zero_copy_only=False).astype(bool)
            infinite = np.isinf(x).any(1) & ~missing
            large = (np.abs(x) > LARGEST).any(1) & ~missing & ~infinite
            sound = ~(missing | infinite | large)
            for name, found in (("n", sound), ("missing", missing), ("infinite", infinite), ("large", large)):
                counts[name] += int(found.sum())
            x = x if sound.all() else x[sound]
            if len(x):
                means = x.mean(0)
                x = x - means
                for (i, j), part in parts.items():
                    (a, b), (c, d) = edges[i], edges[j]
                    part.add(_Part(len(x), means[a:b], means[c:d], x[:, a:b].T @ x[:, c:d]))
        if any(counts.values()):
            task = TaskContext.get().partitionId()
            for (i, j), part in parts.items():
                yield _row(i, j, task % mergers, counts, part)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and part: one row for each."""
    key, counts, block = None, {}, None
    for batch in batches:
        for row in batch.to_pylist():
            means_i, means_j = np.frombuffer(row["means_i"]), np.frombuffer(row["means_j"])
            second = np.frombuffer(row["second"]).reshape(len(means_i), len(means_j)).copy()
            other = _Part(row["n"], means_i, means_j, second)
            if key != (row["i"], row["j"], row["part"]):
                if block is not None:
                    yield _row(*key, counts, block)
                key, counts, block = (row["i"], row["j"], row["part"]), {c: row[c] for c in COUNTS}, other
            else:
                counts = {c: counts[c] + row[c] for c in COUNTS}
                block.add(other) if block.n else (block := other)
    if block is not None:
        yield _row(*key, counts, block)


def column_moments(df: DataFrame, numbers: Sequence[str] | None = None, missing: Column | None = None) -> Moments:
    """Moments of the columns ``numbers``, which are doubles (all of them unless told otherwise). ``missing`` marks rows
    that may not be fitted for other reasons."""
    names = list(df.columns if numbers is None else numbers)
    flag = (F.lit(False) if missing is None else missing).alias("missing")
    return _collected(df.select(*[quoted(name) for name in names], flag), len(names), BLOCK)


def _collected(rows: DataFrame, width: int, block: int) -> Moments:
    blocks = -(-width // block) * (-(-width // block) + 1) // 2
    mergers = 1 if width <= FEW_COLUMNS else MERGERS
    parts = rows.mapInArrow(_partial(width, block, mergers), FIELDS)
    keys = ["i", "j", "part"]
    parts = parts.repartition(min(blocks, MERGERS) * mergers, *keys).sortWithinPartitions(*keys).mapInArrow(_merged, FIELDS)
    if blocks > 1:
        parts = parts.withColumn("part", F.lit(0)).repartition(blocks, "i", "j").sortWithinPartitions("i", "j").mapInArrow(_merged, FIELDS)
    counts, merged = dict.fromkeys(COUNTS, 0), {}
    for row in parts.collect():
        means_i, means_j = np.frombuffer(row.means_i), np.frombuffer(row.means_j)
        other = _Part(row.n, means_i, means_j, np.frombuffer(row.second).reshape(len(means_i), len(means_j)).copy())
        if (row.i, row.j) == (0, 0):
            counts = {c: counts[c] + row[c] for c in COUNTS}
        if (row.i, row.j) in merged and merged[row.i, row.j].n:
            merged[row.i, row.j].add(other)
        else:
            merged[row.i, row.j] = other
    means, second = np.zeros(width), np.zeros((width, width))
    for (i, j), part in merged.items():
        a, c = i * block, j * block
        means[a : a + len(part.means_i)] = part.means_i
        second[a : a + len(part.means_i), c : c + len(part.means_j)] = part.second
        second[c : c + len(part.means_j), a : a + len(part.means_i)] = part.second.T
    return Moments(counts["n"], counts["missing"], counts["infinite"], counts["large"], means, second)
