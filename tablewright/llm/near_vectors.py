"""Near-duplicate vectors by cosine: products of int8 tiles, with error bounds that leave little to compute again.

A unit vector u is kept as s * q, q of int8, and the length of what that misses, e = |u - s q|, in double precision. For two
vectors |u.v - s q.t r| <= |s q| e' + e, so a product of codes settles all pairs but those within the bound of
the threshold; these are computed again from the vectors themselves. Products of codes are sums of integers
below 2**24 and so exact in the float32 matrix products that do the work.

Equal vectors are one before pairs are looked at. The rest are dealt into blocks; a task gets two of them, block against
block, and multiplies tile by tile. Tiles hold vectors near one pivot, and two tiles whose caps lie too far apart
are passed over. A task returns no pairs: per vector, its number of links and the smallest vector of its
component in these two blocks, so a group of near copies leaves a row per member and task.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import consecutive, kept, shuffle_partitions

THRESHOLD = 0.9
# Vectors of a block, the least number worth a task and the most that one may hold twice.
LEAST_BLOCK, MOST_BLOCK = 2048, 16_384
BLOCK_BYTES = 32_000_000
# Most tasks that pairs of blocks are dealt to, times the session's shuffle partitions.
PAIRS_OF_TASKS = 8
TILE = 1024
# Pivots that order a block into tiles: they only decide which tiles can be passed over.
PIVOTS = 32
# Products of so many int8 codes stay below 2**24.
EXACT_WIDTH = 1024
# What rounding in double precision may add to a bound.
SLACK = 1e-9
SINGLE_SLACK = 1e-4
# The same for an angle: near 0 the arc cosine loses half of the digits.
ANGLE_SLACK = 1e-6

CODED = "id long, n long, dim int, vector binary, codes binary, scale double, missed double, length double"


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have a direction, and all rows at unit length (those without: zeros)."""
    with np.errstate(all="ignore"):
        good = np.isfinite(vectors).all(1)
        largest = np.where(good, np.abs(vectors).max(1, initial=0.0), 0.0)
        good &= largest > 0
        # By the largest component first: squares of huge or tiny numbers leave the range of doubles.
        scaled = np.where(good[:, None], vectors, 0.0) / np.where(good, largest, 1.0)[:, None]
    lengths = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
    return good, scaled / np.where(good, lengths, 1.0)[:, None]


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """codes (int8), scale, missed and length of each unit vector."""
    scale = np.abs(units).max(1) / 127.0
    codes = np.rint(units / scale[:, None])
    kept_part = codes * scale[:, None]
    missed = np.sqrt(((units - kept_part) ** 2).sum(1))
    return codes.astype(np.int8), scale, missed, np.sqrt((kept_part**2).sum(1))


def directions(batches):
    """Rows with the key of their unit vector, null where there is none, and the vector itself."""
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            keys, vectors = [None] * part.num_rows, [None] * part.num_rows
            dims = pc.fill_null(pc.list_value_length(part.column(1)), 0).to_numpy()
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)  # a null component is a NaN here
            starts = np.cumsum(dims) - dims
            for dim in np.unique(dims[dims > 0]):
                at = np.flatnonzero(dims == dim)
                good, units = unit(flat[starts[at][:, None] + np.arange(dim)].astype(np.float64))
                for i, row in zip(at[good], units[good] + 0.0, strict=True):  # + 0.0: no negative zero
                    vectors[i] = row.astype("<f8").tobytes()
                    keys[i] = hashlib.sha256(vectors[i]).digest()[:16]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())], ["vec_id", "key", "vector"]
            )


def coded(batches):
    """Distinct vectors with their codes."""
    for batch in batches:
        for start in range(0, batch.num_rows, 2000):
            part = batch.slice(start, 2000)
            raw = part.column(2).to_pylist()
            dims = np.array([len(r) // 8 for r in raw])
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                units = np.frombuffer(b"".join(raw[i] for i in at), "<f8").reshape(len(at), dim)
                codes, scale, missed, length = quantised(units)
                rows = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(np.full(len(at), dim), pa.int32()), rows.column(2),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale), pa.array(missed), pa.array(length)],
                    ["id", "n", "dim", "vector", "codes", "scale", "missed", "length"],
                )


class Tile:
    """Vectors near one pivot; the cap around their mean holds them all."""

    def __init__(self, ids, n, units, codes, scale, missed, length):
        self.ids, self.n, self.units, self.scale, self.missed, self.length = ids, n, units, scale, missed, length
        self.codes = codes
        mean = units.sum(0)
        size = np.sqrt((mean**2).sum())
        self.center = mean / size if size > 0 else units[0]
        self.radius = float(np.arccos(np.clip(units @ self.center, -1, 1)).max()) + ANGLE_SLACK


def tiles(rows: dict[str, np.ndarray]) -> list[Tile]:
    """A block's vectors, those of one pivot together, cut into tiles. Pivots are the block's first vectors."""
    order = np.argsort(rows["ids"], kind="stable")
    units = rows["units"][order]
    nearest = (units @ units[:PIVOTS].T).argmax(1)
    order = order[np.argsort(nearest, kind="stable")]
    return [Tile(**{k: v[order[i : i + TILE]] for k, v in rows.items()}) for i in range(0, len(order), TILE)]


def integer_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows."""
    total = None
    for start in range(0, a.shape[1], EXACT_WIDTH):
        part = a[:, start : start + EXACT_WIDTH].astype(np.float32) @ b[:, start : start + EXACT_WIDTH].astype(np.float32).T
        total = part if total is None else total.astype(np.float64) + part
    return total


def links_between(a: Tile, b: Tile, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of all pairs of at least the threshold."""
    none = np.zeros(0, np.int64)
    if float(a.center @ b.center) < math.cos(min(math.pi, a.radius + b.radius + math.acos(threshold) + ANGLE_SLACK)):
        return none, none
    products = integer_products(a.codes, b.codes)
    # The largest bound of the tiles first, in single precision and with room for its rounding.
    largest = a.length.max() * b.missed.max() + a.missed.max()
    least = ((threshold - largest - SINGLE_SLACK) / a.scale).astype(np.float32)
    x, y = np.nonzero(products * b.scale.astype(np.float32)[None, :] >= least[:, None])
    if not len(x):
        return none, none
    about = products[x, y].astype(np.float64) * a.scale[x] * b.scale[y]
    # Each pair has two bounds, with the roles swapped.
    bound = np.minimum(a.length[x] * b.missed[y] + a.missed[x], a.missed[x] * b.length[y] + b.missed[y]) + SLACK
    possible = about + bound >= threshold
    x, y, about, bound = x[possible], y[possible], about[possible], bound[possible]
    linked = about - bound >= threshold
    unsure = np.flatnonzero(~linked)
    for start in range(0, len(unsure), 100_000):
        at = unsure[start : start + 100_000]
        linked[at] = np.einsum("ij,ij->i", a.units[x[at]], b.units[y[at]]) >= threshold
    return x[linked], y[linked]


class Forest:
    """Components of numbered vectors, joined pair by pair."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        root = self.parent[x]
        while True:
            above = self.parent[root]
            if (above == root).all():
                return root
            root = above

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        """Each vector with one partner first: what that joins need not be looked at pair by pair."""
        one_x, one_y = np.unique(x, return_index=True)[1], np.unique(y, return_index=True)[1]
        for at in (one_x, one_y, slice(None)):
            pairs = np.stack([self.roots(x[at]), self.roots(y[at])], 1)
            for p, q in np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0):
                p, q = self.root(p), self.root(q)
                self.parent[max(p, q)] = min(p, q)

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x


def linked_blocks(left: list[Tile], right: list[Tile] | None, threshold: float) -> pa.RecordBatch | None:
    """id, root, links of the vectors of two blocks (right None: of one with itself) that have links there."""
    both = left + (right or [])
    starts = np.cumsum([0] + [len(t.ids) for t in both])
    ids = np.concatenate([t.ids for t in both])
    weights = np.concatenate([t.n for t in both])
    links = np.zeros(len(ids), np.int64)
    # Numbers in order of ids: a component's smallest number is its smallest id.
    rank = np.empty(len(ids), np.int64)
    rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    forest = Forest(len(ids))
    for i, a in enumerate(left):
        for j in range(len(left), len(both)) if right is not None else range(i, len(left)):
            x, y = links_between(a, both[j], threshold)
            if i == j:
                upper = x < y
                x, y = x[upper], y[upper]
            if not len(x):
                continue
            x, y = x + starts[i], y + starts[j]
            links += np.bincount(x, weights[y], len(ids)).astype(np.int64)
            links += np.bincount(y, weights[x], len(ids)).astype(np.int64)
            forest.join(rank[x], rank[y])
    found = np.flatnonzero(links)
    if not len(found):
        return None
    by_rank = np.sort(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[found]), pa.array(by_rank[forest.roots(rank[found])]), pa.array(links[found])], ["id", "root", "links"]
    )


def make_blocks(batches):
    """Rows sorted by width and block: all vectors of a block in one row of binaries."""

    def made(key, rows):
        numbers = {k: np.array([r[k] for r in rows], t).tobytes()
                   for k, t in (("id", "<i8"), ("n", "<i8"), ("scale", "<f8"), ("missed", "<f8"), ("length", "<f8"))}
        joined = {k: b"".join(r[k] for r in rows) for k in ("vector", "codes")}
        values = {"dim": key[0], "block": key[1], **numbers, **joined}
        kinds = {"dim": pa.int32(), "block": pa.int32()}
        return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(k, pa.binary())) for k, v in values.items()], names=list(values))

    rows = (row for batch in batches for row in batch.to_pylist())
    for key, own in itertools.groupby(rows, lambda r: (r["dim"], r["block"])):
        yield made(key, list(own))


BLOCK = "dim int, block int, id binary, n binary, scale binary, missed binary, length binary, vector binary, codes binary"


def block_tiles(row: dict) -> list[Tile]:
    dim = row["dim"]
    rows = {k: np.frombuffer(row[c], t) for k, c, t in (
        ("ids", "id", "<i8"), ("n", "n", "<i8"), ("scale", "scale", "<f8"), ("missed", "missed", "<f8"), ("length", "length", "<f8"),
    )}
    rows["units"] = np.frombuffer(row["vector"], "<f8").reshape(-1, dim)
    rows["codes"] = np.frombuffer(row["codes"], np.int8).reshape(-1, dim)
    return tiles(rows)


def make_linker(threshold: float):
    def run(batches):
        """Rows sorted by pair of blocks: one row is a block with itself, two are block against block."""
        waiting = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = None
                if row["low"] == row["high"]:
                    found = linked_blocks(block_tiles(row), None, threshold)
                elif waiting is None or any(waiting[k] != row[k] for k in ("dim", "low", "high")):
                    waiting = row  # its partner comes next, if there is one of its width
                else:
                    found = linked_blocks(block_tiles(waiting), block_tiles(row), threshold)
                    waiting = None
                if found is not None:
                    yield found

    return run


def smallest_reached(edges: DataFrame) -> DataFrame:
    """id, root: the smallest id that links lead to, from rows (id, root) that are links themselves.

    Labels fall along links, then to their label's label; a round at least halves the depth of what is left. Rows are
    added up by id before they meet, and a frequent label is looked up among the distinct labels only.
    """
    links = edges.select("id", "root").where("id <> root").distinct()
    both = kept(links.unionByName(links.select(F.col("root").alias("id"), F.col("id").alias("root"))).toDF("id", "other"))
    labels = kept(both.groupBy("id").agg(F.min("other").alias("least")).select("id", F.least("id", "least").alias("root")))
    while True:
        seen = both.join(labels.select(F.col("id").alias("other"), "root"), "other").groupBy("id").agg(F.min("root").alias("near"))
        lower = labels.join(seen, "id").select("id", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        heads = labels.join(labels.select("root").distinct().withColumnRenamed("root", "id"), "id", "left_semi")
        moved = kept(
            lower.join(heads.select(F.col("id").alias("root"), F.col("root").alias("next")), "root", "left")
            .select("id", F.least("root", F.coalesce("next", "root")).alias("root"), "old")
        )
        labels = moved.select("id", "root")
        if moved.where("root < old").isEmpty():
            return labels


def link_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, *, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """One row per row: id_col, n_links, component_id, kept.

    Rows whose vectors have a cosine of at least ``threshold`` (between 0 and 1) in double precision link. A vector that is null, empty,
    of length zero, or holds a null, NaN or infinite component links with nothing, and vectors of different widths never link.
    ``n_links`` counts the other rows linked directly, rows of equal vector among them; ``component_id`` is the smallest id that links
    lead to, itself included, and ``kept`` holds for rows that have that id: of rows that repeat an id, all. Rows of null id link
    with nothing, have no component and are not kept. An empty table gives no rows. Other columns are ignored.
    """
    if not 0 < threshold < 1:
        raise ValueError(f"a threshold between 0 and 1 is needed, not {threshold}")
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("embedding")
    )
    known = kept(rows.where("vec_id is not null").mapInArrow(directions, "vec_id long, key binary, vector binary"))
    classes = known.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("n"), F.min("vector").alias("vector")
    )
    # Numbers in order of ids stand for the classes: one id may have several vectors.
    numbered = consecutive(classes, "id", "key")
    shape = numbered.agg(F.count("*").alias("n"), F.max(F.length("vector")).alias("bytes")).first()
    tasks = shuffle_partitions(spark)
    most = max(1, min(MOST_BLOCK, BLOCK_BYTES // (shape.bytes or 1)))
    size = min(most, max(LEAST_BLOCK, math.ceil(shape.n / math.sqrt(2 * tasks))))
    n_blocks = max(1, math.ceil(shape.n / size))

    in_block = (
        numbered.select(F.col("number").alias("id"), "n", "vector").mapInArrow(coded, CODED)
        .withColumn("block", F.pmod(F.xxhash64("vector"), F.lit(n_blocks)).cast("int"))
    )
    by_block = in_block.repartition(min(n_blocks, tasks), "block").sortWithinPartitions("dim", "block")
    blocks = kept(by_block.mapInArrow(make_blocks, BLOCK))
    pairs = (
        blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).drop("other")
    )
    by = ["low", "high", "dim"]
    n_tasks = min(n_blocks * (n_blocks + 1) // 2, PAIRS_OF_TASKS * tasks)
    found = kept(
        pairs.repartition(n_tasks, *by).sortWithinPartitions(*by, "block")
        .mapInArrow(make_linker(threshold), "id long, root long, links long")
    )
    links = found.groupBy(F.col("id").alias("number")).agg(F.sum("links").alias("links"))
    reached = smallest_reached(found)
    heads = numbered.select(F.col("number").alias("root"), F.col("id").alias("component_id"))
    roots = reached.join(heads.join(reached.select("root").distinct(), "root", "left_semi"), "root")
    of_class = (
        numbered.select("key", "id", "n", "number").join(links, "number", "left")
        .join(roots.select(F.col("id").alias("number"), "component_id"), "number", "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    )
    linked = known.where("key is not null").select("vec_id", "key").join(of_class, "key").select("vec_id", "n_links", "component_id")
    alone = known.where("key is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    nameless = rows.where("vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    whole = linked.unionByName(alone).unionByName(nameless)
    return whole.select(
        F.col("vec_id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
