"""Least squares with text columns, from counts and means per category.

The categories of the widest text column are eliminated from the normal equations block by block (a Schur
complement), which leaves as many unknowns as there are numbers and other categories. Those of other text
columns meet in a sparse matrix of counts of pairs of categories, solved by conjugate gradients.
One Spark aggregate makes it all; nothing is as wide as the categories but vectors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.hints import persisted
from tablewright.operators.moments import Moments

# Most pairs of categories that occur together: they come to the driver, like the categories.
MOST_PAIRS = 5_000_000
# Up to so many unknowns are solved at once, more by conjugate gradients.
FEW_UNKNOWNS = 200
PRECISION = 1e-13
MOST_STEPS = 20_000
# Share of a column's own variation below which what others leave of it is rounding.
NOTHING = 1e-11


@dataclass
class Categories:
    """Per text column its categories in sorted order with counts and means; per two columns the pairs' counts."""

    names: list[list[str]]
    counts: list[np.ndarray]
    means: list[np.ndarray]
    pairs: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]


def category_moments(rows: DataFrame, texts: Sequence[str], numbers: Sequence[str], most_categories: int) -> Categories:
    """Counts and means by one aggregate over all text columns and all two of them."""
    n = len(texts)
    sets = [(i,) for i in range(n)] + list(combinations(range(n), 2))
    sums = [F.count("*").alias("n"), *[F.avg(name).alias(f"m{k}") for k, name in enumerate(numbers)]]
    if n == 1:
        made = rows.groupBy(*texts).agg(*sums, F.lit(0).alias("kind"))
    else:
        grouped = rows.groupingSets([[F.col(texts[i]) for i in s] for s in sets], *texts)
        made = grouped.agg(*sums, F.grouping_id().alias("kind"))
    kinds = {s: sum(1 << (n - 1 - i) for i in range(n) if i not in s) for s in sets}
    singles = [kinds[s] for s in sets if len(s) == 1]
    with persisted(made) as made:
        size = made.agg(F.count_if(F.col("kind").isin(singles)).alias("singles"), F.count("*").alias("all")).first()
        if size.singles > most_categories:
            raise ValueError(f"more than {most_categories} categories in the text columns")
        if size["all"] - size.singles > MOST_PAIRS:
            raise ValueError(f"more than {MOST_PAIRS} pairs of categories in the text columns")
        found = made.toArrow()
    kind = found["kind"].to_numpy()
    counts, means = found["n"].to_numpy().astype(np.float64), np.column_stack([found[f"m{k}"].to_numpy() for k in range(len(numbers))])
    out = Categories([], [], [], {})
    places = []
    for i in range(n):
        at = np.flatnonzero(kind == kinds[(i,)])
        labels = found[texts[i]].take(at).to_pylist()
        order = sorted(range(len(labels)), key=labels.__getitem__)
        out.names.append([labels[k] for k in order])
        out.counts.append(counts[at[order]])
        out.means.append(means[at[order]])
        places.append({label: k for k, label in enumerate(out.names[-1])})
    for i, j in combinations(range(n), 2):
        at = np.flatnonzero(kind == kinds[i, j])
        first, second = (
            np.array([places[c][v] for v in found[texts[c]].take(at).to_pylist()], np.int64) for c in (i, j)
        )
        out.pairs[i, j] = first, second, counts[at]
    return out


def _swapped(pairs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first, second, n = pairs
    return second, first, n


def _added(places: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the values by place."""
    return np.bincount(places, values, size).astype(np.float64)


class _Reduced:
    """The normal equations of numbers and categories after the categories of one column are eliminated.

    Unknowns: the numbers' weights, then those of the other columns' categories without their bases.
    """

    def __init__(self, moments: Moments, cats: Categories, absorbed: int, others: list[int], fit_intercept: bool) -> None:
        p = len(moments.means) - 1
        # With an intercept the origin may lie anywhere, and the means cost no digits.
        shift = moments.means if fit_intercept else np.zeros(p + 1)
        gap = moments.means - shift
        whole = moments.second + moments.n * np.outer(gap, gap)
        start = 0 if fit_intercept else 1  # without one, the base category has no weight to eliminate
        self.p, self.offsets = p, {}
        size = p
        for c in others:
            self.offsets[c] = size - 1
            size += len(cats.names[c]) - 1
        self.size, self.numbers = size, whole[:p, :p]
        self.cross = np.zeros((p, size - p))
        self.diagonal, right = np.concatenate([np.diag(whole)[:p], np.zeros(size - p)]), np.zeros(size)
        right[:p] = whole[:p, p]
        for c in others:
            own = slice(self.offsets[c] + 1, self.offsets[c] + len(cats.names[c]))
            near = (cats.means[c][1:] - shift) * cats.counts[c][1:, None]
            self.cross[:, own.start - p : own.stop - p] = near[:, :p].T
            self.diagonal[own], right[own] = cats.counts[c][1:], near[:, p]
        self.pairs = [self._placed(cats, a, b) for a, b in combinations(others, 2)]

        self.counts = cats.counts[absorbed][start:]
        sums = (cats.means[absorbed][start:] - shift) * self.counts[:, None]
        self.sums, self.sums_y = sums[:, :p], sums[:, p]
        groups, unknowns, weights = [], [], []
        for c in others:
            rows, cols, n = cats.pairs[absorbed, c] if absorbed < c else _swapped(cats.pairs[c, absorbed])
            free = (rows >= start) & (cols > 0)
            groups.append(rows[free] - start)
            unknowns.append(cols[free] + self.offsets[c])
            weights.append(n[free])
        none = np.zeros(0)
        self.group, self.unknown = (np.concatenate([none, *x]).astype(np.int64) for x in (groups, unknowns))
        self.weight = np.concatenate([none, *weights])
        self.right = right - self.gathered(self.sums_y / self.counts)
        # What the eliminated categories leave of each unknown's own variation.
        squares = (self.sums**2 / self.counts[:, None]).sum(0)
        taken = _added(self.unknown, self.weight**2 / self.counts[self.group], self.size)
        taken[:p] += squares
        left = self.diagonal - taken
        self.alive = left > NOTHING * np.maximum(self.diagonal, 1e-300)
        self.left = np.where(self.alive, left, 1.0)

    def _placed(self, cats: Categories, a: int, b: int):
        rows, cols, n = cats.pairs[a, b]
        free = (rows > 0) & (cols > 0)
        return rows[free] + self.offsets[a], cols[free] + self.offsets[b], n[free]

    def spread(self, u: np.ndarray) -> np.ndarray:
        """Sums over the rows of each eliminated category."""
        return self.sums @ u[: self.p] + _added(self.group, self.weight * u[self.unknown], len(self.counts))

    def gathered(self, per_group: np.ndarray) -> np.ndarray:
        out = _added(self.unknown, self.weight * per_group[self.group], self.size)
        out[: self.p] += self.sums.T @ per_group
        return out

    def times(self, u: np.ndarray) -> np.ndarray:
        p, out = self.p, self.diagonal * u
        out[:p] = self.numbers @ u[:p] + self.cross @ u[p:]
        out[p:] += self.cross.T @ u[:p]
        for rows, cols, n in self.pairs:
            out += _added(rows, n * u[cols], self.size) + _added(cols, n * u[rows], self.size)
        return out - self.gathered(self.spread(u) / self.counts)

    def solve(self) -> np.ndarray:
        scale = np.where(self.alive, 1.0 / np.sqrt(self.left), 0.0)
        right = self.right * scale
        if self.size <= FEW_UNKNOWNS:
            columns = [scale * self.times(scale * unit) for unit in np.eye(self.size)]
            matrix = np.array(columns).reshape(self.size, self.size)
            return scale * np.linalg.lstsq(matrix, right, rcond=NOTHING)[0]
        found = np.zeros(self.size)
        rest = right.copy()
        step, now = rest.copy(), float(rest @ rest)
        least = PRECISION**2 * now
        for _ in range(MOST_STEPS):
            if now <= least:
                return scale * found
            moved = scale * self.times(scale * step)
            along = float(step @ moved)
            if along <= 0:  # a direction that the table does not determine, reached by rounding
                return scale * found
            found += now / along * step
            rest -= now / along * moved
            before, now = now, float(rest @ rest)
            step = rest + now / before * step
        raise ValueError(f"the fit has not converged after {MOST_STEPS} steps")

    def levels(self, u: np.ndarray) -> np.ndarray:
        """The eliminated categories' own levels."""
        return (self.sums_y - self.spread(u)) / self.counts


def solve_with_categories(
    moments: Moments, cats: Categories, fit_intercept: bool
) -> tuple[np.ndarray, list[np.ndarray], float]:
    """Weights of the numbers, of each text column's categories after its first, and the intercept.

    ``moments`` are those of the numbers and, last, the target. Where the table leaves weights open (a text column that
    tells another), the solution is one of those with the least error.
    """
    p = len(moments.means) - 1
    wide = [c for c in range(len(cats.names)) if len(cats.names[c]) > 1]
    absorbed = max(wide, key=lambda c: len(cats.names[c]))
    others = [c for c in wide if c != absorbed]
    reduced = _Reduced(moments, cats, absorbed, others, fit_intercept)
    u = reduced.solve()
    levels = reduced.levels(u)
    base = levels[0] if fit_intercept else 0.0
    weights = [np.zeros(0) for _ in cats.names]
    weights[absorbed] = levels[1:] - base if fit_intercept else levels
    for c in others:
        weights[c] = u[reduced.offsets[c] + 1 : reduced.offsets[c] + len(cats.names[c])]
    intercept = float(base + moments.means[p] - moments.means[:p] @ u[:p]) if fit_intercept else 0.0
    return u[:p], weights, intercept
