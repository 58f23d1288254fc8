"""A Merkle manifest of a table: one root for all rows, and for every row the proof that leads from it to the root.

Rows are leaves. A group's leaves, ordered by id, are hashed in runs of three consecutive nodes until one is left, the
subroot; the groups' subroots, ordered by group, likewise give the root.

Aligned chunks of leaves are the partitions. A chunk knows its own levels; the levels above come from a butterfly
exchange: in round r the three chunks that agree in all base-three digits but digit r swap the roots of their
subtrees, and each of them hashes the parent. Every chunk thus follows its own path upwards, with the siblings
that it meets as its proof, and after the last round all of them hold the root: no pass leads down again. Chunks
beyond a group's last are filled up with empty ones, so that each has partners in every round; they number fewer than
twice the real ones and carry a hash only. Groups run the same exchange among each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import consecutive, kept, shuffle_partitions

FANOUT = 3
# Levels within a chunk, so 729 leaves: what a task holds at a time.
CHUNK_LEVELS = 6
# Leaves that leave a task at once.
BATCH_LEAVES = 2000


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf_of(values: Sequence[Column]) -> Column:
    """The leaf's digest in binary, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def digest(texts: str) -> str:
    return hashlib.sha256(texts.encode("ascii")).hexdigest()


def level_up(nodes: list[str]) -> list[str]:
    return [digest("".join(nodes[i : i + FANOUT])) for i in range(0, len(nodes), FANOUT)]


def chunk_levels(leaves: list[str], alone: bool, height: int) -> list[list[str]]:
    """The nodes of a chunk by level. One of several chunks of a group has all its levels, even of single nodes."""
    levels = [leaves]
    while len(levels[-1]) > 1 if alone else len(levels) <= height:
        levels.append(level_up(levels[-1]))
    return levels


def beside(nodes: list[str]) -> list[tuple[str, str]]:
    """For each node, its siblings before and after it, joined."""
    out = []
    for start in range(0, len(nodes), FANOUT):
        run = nodes[start : start + FANOUT]
        out += [("".join(run[:i]), "".join(run[i + 1 :])) for i in range(len(run))]
    return out


def beside_in_proof(proof: str, place: int, n: int) -> list[tuple[str, str]]:
    """The same for the path of node ``place`` of ``n``, cut from its proof."""
    out, at, size = [], 0, hashlib.sha256().digest_size * 2
    while n > 1:
        first = place - place % FANOUT
        before, after = place - first, min(FANOUT, n - first) - 1 - (place - first)
        middle, end = at + before * size, at + (before + after) * size
        out.append((proof[at:middle], proof[middle:end]))
        place, n, at = place // FANOUT, -(-n // FANOUT), end
    return out


CHUNK = "tree long, slot long, n_chunks long, ids array<long>, leaves binary, claimed binary, hash string"
DIGEST = 32


def pack_chunks(batches, height: int):
    """Rows sorted by tree, chunk and place become one row per chunk, with the root of its own levels."""
    now, ids, leaves, claimed = None, [], [], []

    def packed():
        tree, slot, n_chunks = now
        root = chunk_levels([x.hex() for x in leaves], n_chunks == 1, height)[-1][0]
        other = b"".join(claimed) if claimed != leaves else None
        values = [tree], [slot], [n_chunks], [ids], [b"".join(leaves)], [other], [root]
        kinds = pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.string()
        arrays = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in CHUNK.split(", ")])

    for batch in batches:
        for tree, slot, n_chunks, id_, leaf, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != (tree, slot, n_chunks):
                if now is not None:
                    yield packed()
                now, ids, leaves, claimed = (tree, slot, n_chunks), [], [], []
            ids.append(id_)
            leaves.append(leaf)
            claimed.append(other)
    if now is not None:
        yield packed()


def butterfly(nodes: DataFrame) -> DataFrame:
    """``tree``, ``slot``, ``n`` (slots of the tree) and ``hash`` become tree, slot, n, top and proof.

    A round is one shuffle in which three partners meet. Trees of fewer rounds wait as they are.
    """
    most = nodes.agg(F.max("n")).first()[0] or 1
    rounds = 0
    while FANOUT**rounds < most:
        rounds += 1
    if not rounds:
        return nodes.select("tree", "slot", "n", F.col("hash").alias("top"), F.lit("").alias("proof"))
    width = F.lit(1).cast("long")
    for r in range(rounds):
        width = F.when(F.col("n") > FANOUT**r, F.lit(FANOUT ** (r + 1)).cast("long")).otherwise(width)
    # The empty slots of a tree: below its width, which is less than three times its real slots.
    copies = F.array(*[F.col("slot") + i * F.col("n") for i in range(FANOUT)])
    state = (
        nodes.withColumn("width", width)
        .withColumn("at", F.explode(F.filter(copies, lambda x: x < F.col("width"))))
        .select("tree", F.col("at").alias("slot"), "n", "width",
                F.when(F.col("at") == F.col("slot"), F.col("hash")).alias("hash"), F.lit("").alias("proof"))
    )
    for r in range(rounds):
        step = FANOUT**r
        swaps = F.col("width") > step
        meeting = [
            F.col("tree"),
            F.when(swaps, F.expr(f"slot div {step * FANOUT}")).otherwise(F.col("slot")).alias("above"),
            F.when(swaps, F.col("slot") % step).otherwise(F.lit(-1)).alias("below"),
        ]
        met = state.groupBy(*meeting).agg(
            F.sort_array(F.collect_list(F.struct("slot", "hash", "proof", "n", "width"))).alias("met"),
        )
        # Nulls, the hashes of empty subtrees, are passed over.
        parent = F.sha2(F.array_join(F.transform("met", lambda m: m["hash"]), ""), 256)
        known = F.exists("met", lambda m: m["hash"].isNotNull())

        def others(m: Column) -> Column:
            rest = F.filter(F.col("met"), lambda o: o["slot"] != m["slot"])
            return F.concat(m["proof"], F.array_join(F.transform(rest, lambda o: o["hash"]), ""))

        def after(m: Column) -> Column:
            joined = F.col("met")[0]["width"] > step
            return F.struct(
                m["slot"].alias("slot"), m["n"].alias("n"), m["width"].alias("width"),
                F.when(joined, F.when(F.col("known"), F.col("parent"))).otherwise(m["hash"]).alias("hash"),
                F.when(joined, others(m)).otherwise(m["proof"]).alias("proof"),
            )

        state = met.withColumn("parent", parent).withColumn("known", known)
        state = state.select("tree", F.inline(F.transform("met", after)))
    return state.where("slot < n").select("tree", "slot", "n", F.col("hash").alias("top"), "proof")


def proven(batches, height: int):
    """Per chunk with its proof in the group and the group's in the table: one row per leaf."""
    out: list[list] = [[] for _ in range(7)]

    def made():
        kinds = pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_()
        arrays = [pa.array(v, k) for v, k in zip(out, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "leaf", "subroot", "root", "proof", "folded_root", "verified"])

    for batch in batches:
        for row in batch.to_pylist():
            raw, other = row["leaves"], row["claimed"] or row["leaves"]
            leaves = [raw[i : i + DIGEST].hex() for i in range(0, len(raw), DIGEST)]
            levels = chunk_levels(leaves, row["n_chunks"] == 1, height)
            near = [beside(nodes) for nodes in levels[:-1]]
            far = beside_in_proof(row["proof"], row["slot"], row["n_chunks"])
            far += beside_in_proof(row["table_proof"], row["tree"], row["n_trees"])
            upper = row["proof"] + row["table_proof"]
            for i, (id_, leaf) in enumerate(zip(row["ids"], leaves, strict=True)):
                path, place = [], i
                for sides in near:
                    path.append(sides[place])
                    place //= FANOUT
                node = other[i * DIGEST : (i + 1) * DIGEST].hex()
                for before, after in path:
                    node = digest(before + node + after)
                for before, after in far:
                    node = digest(before + node + after)
                proof = "".join([b + a for b, a in path]) + upper
                values = id_, leaf, row["subroot"], row["root"], proof, node, node == row["root"]
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            if len(out[0]) >= BATCH_LEAVES:
                yield made()
                out = [[] for _ in range(7)]
    if out[0]:
        yield made()


def build_manifest(
    table: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    *,
    id_col: str = "doc_id",
    group_col: str = "source",
    claimed: Mapping[str, Column] | None = None,
    height: int = CHUNK_LEVELS,
) -> DataFrame:
    """One row per row of ``table``: id_col, leaf, subroot, root, proof, folded_root, verified.

    ``proof`` holds the hex digests of the siblings, level by level up to the root, left to right.
    ``claimed`` puts other values in place of fields, as a copy to be checked might hold them; ``folded_root`` is what
    their leaf and the proof lead to, and ``verified`` tells whether that is the root. Without it the rows prove themselves.

    Rows of equal id are leaves of their own, ordered by their digests; a null id comes first in its group and a null
    group first of all. A null field is ``-``, an empty text ``0:``. An empty table has no rows and no root. Texts of any
    length are hashed whole, once per version, where they lie; from there on a row is two digests. Other columns are ignored.
    """
    values = {name: F.col(f"`{name}`") for name in fields}
    leaf = leaf_of(list(values.values()))
    other = leaf_of([(claimed or {}).get(name, value) for name, value in values.items()])
    leaves = table.select(
        F.col(f"`{group_col}`").cast("string").alias("group"), F.col(f"`{id_col}`").cast("long").alias("id"),
        leaf.alias("leaf"), other.alias("claimed"),
    )
    numbered = consecutive(leaves, "group", "id", "leaf", "claimed")

    # A group's rows lie in a run per partition; what runs need to know is joined per partition, so no group is in one task.
    runs = numbered.groupBy("part", "group").agg(F.min("number").alias("start"), F.count("*").alias("n"))
    runs = kept(runs)
    groups = consecutive(runs.groupBy("group").agg(F.min("start").alias("first"), F.sum("n").alias("n")), "first")
    groups = groups.select("group", "first", "n", F.col("number").alias("tree"))
    of_run = runs.select("part", "group").alias("r").join(groups.alias("g"), F.expr("r.group <=> g.group")).selectExpr(
        "r.part", "r.group", "g.first", "g.tree", f"ceil(g.n / {FANOUT**height}) as n_chunks"
    )
    placed = numbered.alias("l").join(of_run.alias("r"), F.expr("l.part = r.part and l.group <=> r.group")).selectExpr(
        "r.tree", f"(l.number - r.first) div {FANOUT**height} as slot", "r.n_chunks", "l.id", "l.leaf", "l.claimed", "l.number"
    )
    chunks = kept(
        placed.repartition(shuffle_partitions(table.sparkSession), "tree", "slot")
        .sortWithinPartitions("tree", "slot", "number").drop("number")
        .mapInArrow(lambda batches: pack_chunks(batches, height), CHUNK)
    )

    in_group = kept(butterfly(chunks.select("tree", "slot", F.col("n_chunks").alias("n"), "hash")))
    n_trees = groups.count()
    subroots = in_group.where("slot = 0").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("slot"), F.lit(n_trees).cast("long").alias("n"), F.col("top").alias("hash")
    )
    in_table = butterfly(subroots).select(
        F.col("slot").alias("tree"), F.col("top").alias("root"), F.col("proof").alias("table_proof"), F.col("n").alias("n_trees")
    )
    upper = in_group.select("tree", "slot", F.col("top").alias("subroot"), "proof").join(in_table, "tree")
    whole = chunks.drop("hash").join(upper, ["tree", "slot"])
    made = whole.mapInArrow(
        lambda batches: proven(batches, height),
        "id long, leaf string, subroot string, root string, proof string, folded_root string, verified boolean",
    )
    return made.withColumnRenamed("id", id_col)
