"""Leaves, proofs and roots against a plain version of the contract."""

from __future__ import annotations

import hashlib
import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from tablewright.llm import merkle_manifest
from tablewright.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, root long, `group` string, tree long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """The root, and each node's proof as (before, after) by level."""
    proofs, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for proof, place in zip(proofs, places, strict=True):
            run, i = runs[place // 3], place % 3
            proof.append(("".join(run[:i]), "".join(run[i + 1 :])))
        places = [p // 3 for p in places]
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], proofs


def plain_manifest(rows, tamper=True):
    """rows: (doc_id, source, lang, n_chars, text)."""

    def claimed(row):
        gone = tamper and row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
        return leaf((*row[:4], row[4].replace("\n", ""))) if gone else leaf(row)

    def order(value):
        return (value is not None, value if value is not None else 0)

    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((order(row[0]), leaf(row), claimed(row), row[0]))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(by_source[s], key=lambda x: x[:3]) for s in sources}
    tops = {s: climb([x[1] for x in trees[s]]) for s in sources}
    if not sources:
        return []
    root, upper = climb([tops[s][0] for s in sources])
    out = []
    for s, high in zip(sources, upper, strict=True):
        for (_, own, other, doc_id), low in zip(trees[s], tops[s][1], strict=True):
            node = other
            for before, after in [*low, *high]:
                node = sha(before + node + after)
            out.append((doc_id, own, tops[s][0], root, "".join(b + a for b, a in [*low, *high]), node, node == root))
    return sorted(out, key=str)


def manifest_of(spark, rows, **how):
    table = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return sorted((tuple(r) for r in merkle_manifest.build_manifest(table, claimed={"text": text}, **how).collect()), key=str)


def table_of(counts):
    """So many rows of each source, some of them with line breaks."""
    ids = itertools.count(1)
    return [(i, s, "en" if i % 3 else None, i, f"line {i}\n{s}" if i % 2 else f"text {i}") for s, n in counts.items() for i in itertools.islice(ids, n)]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_trees_of_many_sizes(spark, levels):
    rows = table_of({None: 5, "": 1, "a": 9, "b": 10, "ba": 27, "Z": 28, "é": 100, "日": 2, "z": 244, "\U0001f600": 4})
    assert manifest_of(spark, rows, height=levels) == plain_manifest(rows)


def test_one_source_one_row(spark):
    rows = [(1, "s", None, None, None)]
    [row] = manifest_of(spark, rows)
    assert [row] == plain_manifest(rows) and row[1] == row[2] == row[3] and row[4] == ""


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None), (None, "s", "en", 0, "\n"), (1, "s", "", 0, ""), (1, "s", "", 0, ""), (1, "s", "", 0, "\n\n"), (-4, "s", "x", 1, "-"),
        (2, "s", "en", 3, "é\né" * 100_000), *[(7, "s", None, 1, "the same row\n")] * 30, *[(8 + i, "t", None, 1, "other\r\n") for i in range(4)],
    ]
    assert manifest_of(spark, rows, height=1) == plain_manifest(rows)


def test_empty_table(spark):
    assert manifest_of(spark, []) == []


def test_without_claims_every_row_proves_itself(spark):
    rows = table_of({"a": 20, "b": 3})
    table = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in merkle_manifest.build_manifest(table).collect()), key=str)
    assert got == plain_manifest(rows, tamper=False) and all(r[-1] for r in got)


def test_query_on_the_given_table(spark, folder):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = sorted(((i, a, b, c, sha(p), f, v) for i, a, b, c, p, f, v in plain_manifest(rows)), key=str)
    assert sorted((tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, folder).collect()), key=str) == want
