"""Links and components of vectors against all pairs in double precision."""

from __future__ import annotations

import numpy as np
import pytest

from tablewright.llm import near_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, n long, key string, id long, component_id long"


def plain_links(rows, threshold=0.9):
    out, n = [], len(rows)
    vectors = [None] * n
    for i, (vec_id, v) in enumerate(rows):
        if vec_id is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            x = x / np.abs(x).max()
            vectors[i] = x / np.sqrt(x @ x)
    root, links = list(range(n)), [0] * n

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            a, b = vectors[i], vectors[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    for i, (vec_id, _) in enumerate(rows):
        of = [rows[j][0] for j in range(n) if find(j) == find(i)]
        least = None if vec_id is None else min(of)
        out.append((vec_id, links[i], least, vec_id is not None and vec_id == least))
    return sorted(out, key=str)


def links_of(spark, rows, threshold=0.9):
    table = spark.createDataFrame([(i, v, 0, 5, "k", 3, 4) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in near_vectors.link_vectors(table, threshold).collect()), key=str)


def clouds(seed, sizes, dim, noise):
    random = np.random.default_rng(seed)
    return [list(map(float, c + noise * random.normal(size=dim))) for n in sizes for c in [random.normal(size=dim)] for _ in range(n)]


@pytest.mark.parametrize("dim, noise", [(2, 0.2), (16, 0.3), (64, 0.33), (64, 0.05)])
def test_links_of_clouds(spark, dim, noise):
    vectors = clouds(dim, [40, 30, 5, 1, 1, 1], dim, noise)
    order = np.random.default_rng(1).permutation(len(vectors))
    rows = [(int(i) * 3, vectors[i]) for i in order]
    assert links_of(spark, rows) == plain_links(rows)


def test_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "LEAST_BLOCK", 10)
    monkeypatch.setattr(near_vectors, "MOST_BLOCK", 20)
    rows = list(enumerate(clouds(3, [60, 20, 20, 3], 8, 0.25)))
    assert links_of(spark, rows) == plain_links(rows)


def test_odd_vectors(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [float("inf"), 1.0]),
        (7, [1e200, 1e200]), (8, [1e-200, 1e-200]), (9, [5e-324, 5e-324]), (10, [1.0, 1.0, 0.0]), (11, [1.0, 1.1]), (None, [1.0, 1.0]),
        (12, [-0.0, 1.0]), (13, [0.0, 2.0]), (14, [-1.0, -1.0]), (15, [3.0]), (16, [4.0]), (17, [-4.0]),
        (7, [1.0, -1.0]), (7, [1e200, 1e200]), (2, [1.0, -1.01]), (-3, [0.0, 1.0]),
    ]
    assert links_of(spark, rows) == plain_links(rows)


def test_equal_vectors_count_as_rows(spark):
    v, near = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [(i, v) for i in range(100, 160)] + [(7, near), (8, near), (9, [-1.0, 0.0, 0.0])]
    assert links_of(spark, rows) == plain_links(rows)


@pytest.mark.parametrize("threshold", [0.6, 0.999])
def test_other_thresholds(spark, threshold):
    rows = list(enumerate(clouds(9, [20, 20], 8, 0.3))) + [(100, [1.0] * 8), (101, [2.0] * 8)]
    assert links_of(spark, rows, threshold) == plain_links(rows, threshold)


def test_empty_table_and_bad_threshold(spark):
    assert links_of(spark, []) == []
    with pytest.raises(ValueError):
        links_of(spark, [], 0.0)


def test_bounds_hold():
    random = np.random.default_rng(2)
    for dim in (1, 3, 64, 1500):
        _, units = near_vectors.unit(random.normal(size=(200, dim)) * np.exp(random.normal(size=(200, dim))))
        codes, scale, missed, length = near_vectors.quantised(units)
        about = near_vectors.integer_products(codes, codes).astype(np.float64) * scale[:, None] * scale[None, :]
        bound = length[:, None] * missed[None, :] + missed[:, None] + near_vectors.SLACK
        assert (np.abs(about - units @ units.T) <= bound).all()
        assert (near_vectors.integer_products(codes, codes) == codes.astype(np.int64) @ codes.astype(np.int64).T).all()


def test_given_table(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = sorted((tuple(r) for r in near_vectors.link_vectors(table).collect()), key=str)
    assert got == plain_links(rows)
