"""Prefix trie of conversations: every distinct beginning is a node, with what its subtree holds.

A turn is known by 16 bytes of a SHA-256 of role and text, a node by 16 bytes of a chained one; texts are read
once and not shuffled. Equal conversations are one sequence before any trie is built.

A shard is what begins with one prefix: the first turn, or, where too much begins with that, as many as it takes.
Its subtree belongs to it alone. A task numbers the turns of its shards densely and packs a double array:
child = BASE[node] + turn, valid if CHECK[child] = node. Walking the sequences through it gives the nodes, and one
sweep from the deepest level up their subtrees' sums. The nodes above the shards are few; their sums come from the
shards' roots by aggregates over all shards, however many rows share them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import kept, shuffle_partitions

# A prefix is a shard if its sequences have no more turns than this, or are no more than FEW_SEQUENCES.
MOST_TURNS = 500
FEW_SEQUENCES = 16
# Turns from which on a task packs the shards that it has gathered.
TURNS_AT_ONCE = 100_000
KEY_BYTES = 16
# Conversation ids in one piece of the text that is hashed for the ends of a node.
PIECE_IDS = 20_000
WINDOW = 4096
NO_END = hashlib.sha256(b"").hexdigest()


def own_turns(turns: DataFrame) -> DataFrame:
    """conv, turns (digest and bytes, in order). Null role and text are empty."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role), F.lit(":"), role, text)
    rows = turns.select(
        F.col("`conv_id`").cast("long").alias("conv"), F.col("`turn`").alias("turn"),
        F.unhex(F.substring(F.sha2(told, 256), 1, 2 * KEY_BYTES)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    ).where("conv is not null")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "bytes")))
    return rows.groupBy("conv").agg(F.transform(ordered, lambda t: F.struct(t["digest"], t["bytes"])).alias("turns"))


def rebuilt(own: DataFrame, block: int, most_heads: int) -> DataFrame:
    """The first h turns of the block's first conversation, then the conversation's own after its first h."""
    heads = own.select(F.col("conv").alias("base"), F.slice("turns", 1, most_heads).alias("head"))
    base = F.col("conv") - F.col("conv") % block
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % (most_heads + 1)).cast("int")
    shared = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    joined = own.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
    return joined.select("conv", F.concat(shared, F.expr("slice(turns, h + 1, size(turns))")).alias("turns"))


def chain(batches):
    """Adds to each turn the key of the node that it leads to, and to each conversation the key of its last node."""
    for batch in batches:
        turns = batch.column(1)
        offsets = turns.offsets.to_pylist()
        first = offsets[0]
        flat = turns.flatten()
        digests = flat.field(0).to_pylist()
        keys, last = [], []
        for start, end in zip(offsets, offsets[1:], strict=False):
            key = b""
            for digest in digests[start - first : end - first]:
                key = hashlib.sha256(key + digest).digest()[:KEY_BYTES]
                keys.append(key)
            last.append(key)
        parts = pa.StructArray.from_arrays(
            [flat.field(0), pa.array(keys, pa.binary()), flat.field(1)], ["digest", "key", "bytes"]
        )
        zero = pa.array([o - first for o in offsets], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(last, pa.binary()), pa.ListArray.from_arrays(zero, parts)], ["conv", "key", "turns"]
        )


def pieces(batches):
    """Sorted (key, conv) rows: per key, runs of ids spelled out."""
    key, ids = None, []

    def made():
        kinds = pa.binary(), pa.int64(), pa.int64(), pa.string()
        row = key, ids[0], len(ids), ",".join(map(str, ids))
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], ["key", "first", "n", "ids"])

    for batch in batches:
        for k, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (k != key or len(ids) >= PIECE_IDS):
                yield made()
                ids = []
            key = k
            ids.append(conv)
    if ids:
        yield made()


def joined_pieces(batches):
    """Sorted pieces: per key, number and smallest of the ids, and the digest of all of them."""
    out: list[list] = [[], [], [], []]
    key, first, n, sha = None, None, 0, None

    def made():
        kinds = pa.binary(), pa.int64(), pa.int64(), pa.string()
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["key", "first", "n", "ends"])

    def close():
        for column, value in zip(out, (key, first, n, sha.hexdigest()), strict=True):
            column.append(value)

    for batch in batches:
        for k, one, more, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if sha is not None and k == key:
                sha.update(b",")
                n += more
            else:
                if sha is not None:
                    close()
                key, first, n, sha = k, one, more, hashlib.sha256()
            sha.update(ids.encode("ascii"))
        if len(out[0]) > 10_000:
            yield made()
            out = [[], [], [], []]
    if sha is not None:
        close()
        yield made()


def sequences(convs: DataFrame) -> DataFrame:
    """key, turns, n, first, ends of each distinct sequence: its copies are counted and their ids hashed as a stream."""
    n = shuffle_partitions(convs.sparkSession)
    spelled = (
        convs.select("key", "conv").repartitionByRange(n, "key", "conv").sortWithinPartitions("key", "conv")
        .mapInArrow(pieces, "key binary, first long, n long, ids string")
    )
    groups = (
        spelled.repartition(n, "key").sortWithinPartitions("key", "first")
        .mapInArrow(joined_pieces, "key binary, first long, n long, ends string")
    )
    return groups.join(convs.select(F.col("conv").alias("first"), "turns"), "first")


def full(options: DataFrame) -> DataFrame:
    """The prefixes (of rows key, size, depth, prefix) that too much begins with for one shard."""
    begun = options.groupBy("prefix").agg(F.count("*").alias("n"), F.sum("size").alias("turns"))
    return begun.where((F.col("n") > FEW_SEQUENCES) & (F.col("turns") > MOST_TURNS)).select("prefix")


def with_cuts(seqs: DataFrame) -> DataFrame:
    """Adds ``cut``, the depth of the shard that the sequence lies in; null if it ends above the shards.

    Prefixes of 1, 2, 4, 8, ... turns are tried for all sequences, and then every depth between the last full one and the next.
    Sequences with a common prefix see the same counts and so choose the same depth.
    """
    sized = seqs.select("key", F.size("turns").alias("size"), F.transform("turns", lambda t: t["key"]).alias("keys"))

    def tried(table: DataFrame, depths: str) -> DataFrame:
        exploded = table.select("key", "size", "keys", F.explode(F.expr(depths)).alias("depth"))
        return exploded.select("key", "size", "depth", F.expr("keys[depth - 1] as prefix"))

    doubled = tried(sized.where("size > 0"), "filter(transform(sequence(0, 30), i -> shiftleft(1, i)), d -> d <= size)")
    last = kept(doubled.join(full(doubled), "prefix", "left_semi").groupBy("key").agg(F.max("depth").alias("last")))
    deep = sized.join(last.where("last > 1"), "key")
    between = tried(deep.where("last < size"), "sequence(last + 1, least(2 * last, size))")
    # What a longer sequence has passed on its way to a full prefix is full for a shorter one, too.
    passed = deep.select(F.explode(F.expr("slice(keys, 1, last)")).alias("prefix")).distinct()
    near = between.join(full(between).unionByName(passed), "prefix", "left_anti").groupBy("key").agg(F.min("depth").alias("near"))
    cut = F.expr("case when size(turns) > 0 and last is null then 1 when last = 1 and size(turns) > 1 then 2 else near end")
    return seqs.join(last, "key", "left").join(near, "key", "left").withColumn("cut", cut).drop("last", "near")


class DoubleArray:
    """BASE and CHECK over dense turn ids. Node 0 is the start; a free place has CHECK -1."""

    def __init__(self) -> None:
        self.base = np.zeros(WINDOW, np.int64)
        self.check = np.full(WINDOW, -1, np.int64)
        self.check[0] = 0
        self.low = 1  # no place below it is free
        self.wide = 1  # where families look for places

    def grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def free_places(self, n: int) -> np.ndarray:
        """The first n free places."""
        end = self.low + max(n, WINDOW)
        while True:
            self.grow(end)
            found = np.flatnonzero(self.check[self.low : end] < 0)
            if len(found) >= n:
                return self.low + found[:n]
            end += max(n, WINDOW)

    def family_place(self, steps: np.ndarray) -> int:
        """The first place seen from which a child at each of the (ascending, 0 first) steps finds its place free."""
        start = max(self.low, self.wide)
        while True:
            self.grow(start + WINDOW + int(steps[-1]))
            taken = self.check[start : start + WINDOW] >= 0
            if taken.mean() > 0.95:
                self.wide = start + WINDOW
            for step in steps[1:]:
                taken = taken | (self.check[start + step : start + step + WINDOW] >= 0)
            if not taken.all():
                return start + int(taken.argmin())
            start += WINDOW

    def add_level(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """Children of one level: distinct (parent, code), sorted by both."""
        cut = np.flatnonzero(np.diff(parents, prepend=-1, append=-1))
        sizes = np.diff(cut)
        for start, end in zip(cut[:-1][sizes > 1], cut[1:][sizes > 1], strict=True):
            own = codes[start:end]
            self.base[parents[start]] = self.family_place(own - own[0]) - own[0]
            self.check[self.base[parents[start]] + own] = parents[start]
        only = cut[:-1][sizes == 1]
        places = self.free_places(len(only))
        self.base[parents[only]] = places - codes[only]
        self.check[places] = parents[only]
        if len(only):
            self.low = int(places[-1]) + 1

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        children = self.base[nodes] + codes
        if not (self.check[children] == nodes).all():
            raise ValueError("a sequence leaves the trie")
        return children


def pack(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, alphabet: int) -> DoubleArray:
    """The double array of the sequences codes[start : start + size], level by level."""
    array = DoubleArray()
    nodes = np.zeros(len(starts), np.int64)
    for level in range(int(sizes.max(initial=0))):
        on = np.flatnonzero(sizes > level)
        pairs = np.unique(nodes[on] * alphabet + codes[starts[on] + level])
        array.add_level(pairs // alphabet, pairs % alphabet)
        nodes[on] = array.step(nodes[on], codes[starts[on] + level])
    return array


NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, parent binary, above array<struct<key:binary,bytes:long>>"
)
ABOVE = pa.list_(pa.struct([("key", pa.binary()), ("bytes", pa.int64())]))


def shard_nodes(rows: list[dict]) -> pa.RecordBatch:
    """All nodes of whole shards."""
    shards = {}
    for row in rows:
        shards.setdefault(row["shard"], len(shards))
    digests = np.array([t["digest"] for r in rows for t in r["turns"]], f"S{KEY_BYTES}")
    widths = np.array([t["bytes"] for r in rows for t in r["turns"]], np.int64)
    dense = np.unique(digests, return_inverse=True)[1] + len(shards)
    sizes = np.array([len(r["turns"]) for r in rows], np.int64)
    starts = np.cumsum(sizes) - sizes
    dense[starts] = [shards[r["shard"]] for r in rows]  # the first turn of a shard is its prefix
    alphabet = int(dense.max()) + 1
    array = pack(dense, starts, sizes, alphabet)

    counts = np.array([r["n"] for r in rows], np.int64)
    firsts = np.array([r["first"] for r in rows], np.int64)
    cuts = np.array([r["cut"] for r in rows], np.int64)
    size = len(array.check)
    n, depth, width, end = (np.zeros(size, np.int64) for _ in range(4))
    first = np.full(size, np.iinfo(np.int64).max)
    end[:] = -1
    nodes, levels = np.zeros(len(rows), np.int64), []
    for level in range(int(sizes.max())):
        on = np.flatnonzero(sizes > level)
        at = array.step(nodes[on], dense[starts[on] + level])
        nodes[on] = at
        np.add.at(n, at, counts[on])
        np.minimum.at(first, at, firsts[on])
        depth[at], width[at] = cuts[on] + level, widths[starts[on] + level]
        levels.append(np.unique(at))
    end[nodes] = np.arange(len(rows))
    children = np.bincount(array.check[array.check >= 0], minlength=size)
    leaves = (children == 0).astype(np.int64)
    saved = (n - 1) * width
    for at in reversed(levels[1:]):
        np.add.at(leaves, array.check[at], leaves[at])
        np.add.at(saved, array.check[at], saved[at])

    order = np.concatenate(levels)
    roots = len(levels[0])
    at_root = {int(x): i for i, x in enumerate(nodes_of_roots(array, rows, dense, starts))}
    parent = [first[array.check[x]] for x in order[roots:]]
    rooted = [rows[at_root[int(x)]] for x in order[:roots]]
    none = [None] * (len(order) - roots)
    columns = [
        pa.array(first[order]), pa.array(depth[order]), pa.array([None] * roots + [int(p) for p in parent], pa.int64()),
        pa.array(n[order]), pa.array(children[order]), pa.array(leaves[order]), pa.array(saved[order]),
        pa.array([rows[e]["ends"] if e >= 0 else NO_END for e in end[order]], pa.string()),
        pa.array([r["above"][-1]["key"] if r["above"] else b"" for r in rooted] + none, pa.binary()),
        pa.array([r["above"] for r in rooted] + none, ABOVE),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in NODE.split(", ")])


def nodes_of_roots(array: DoubleArray, rows: list[dict], dense: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The node of each row's shard."""
    return array.step(np.zeros(len(rows), np.int64), dense[starts])


def tries(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard: whole shards are gathered and packed."""
    rows, turns, shard = [], 0, None
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            for row in batch.slice(start, 1000).to_pylist():
                if row["shard"] != shard and turns >= TURNS_AT_ONCE:
                    yield shard_nodes(rows)
                    rows, turns = [], 0
                shard = row["shard"]
                rows.append(row)
                turns += len(row["turns"])
    if rows:
        yield shard_nodes(rows)


def upper_nodes(seqs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The nodes above the shards and the start: key, parent, first, n_convs and the rest of a node."""
    step = F.struct(F.lit(b"").alias("key"), F.lit(0).cast("long").alias("bytes"))
    brought = nodes.where("parent is not null").select(
        F.col("above").alias("path"), "n_convs", "conv_id", "n_leaves", "saved_tokens"
    ).unionByName(
        seqs.where("cut is null").select(
            F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["bytes"].alias("bytes"))).alias("path"),
            F.col("n").alias("n_convs"), F.col("first").alias("conv_id"),
            F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        )
    )
    # What comes in by one path is added up before it is handed to the path's nodes.
    brought = brought.groupBy("path").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
    )
    walked = brought.withColumn("path", F.concat(F.array(step), F.col("path")))
    handed = walked.select("*", F.posexplode("path").alias("depth", "node")).select(
        F.col("node.key").alias("key"), "depth", F.col("node.bytes").alias("bytes"),
        F.transform(F.slice("path", F.lit(1), F.col("depth")), lambda s: s["key"]).alias("ancestors"),
        "n_convs", "conv_id", "n_leaves", "saved_tokens",
    )
    upper = kept(
        handed.groupBy("key").agg(
            F.min("depth").cast("long").alias("depth"), F.min("bytes").alias("bytes"), F.min("ancestors").alias("ancestors"),
            F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"),
        ).withColumn("parent", F.when(F.col("depth") > 0, F.element_at("ancestors", -1)))
    )
    own = upper.select(
        F.explode(F.concat("ancestors", F.array("key"))).alias("key"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("own")
    ).groupBy("key").agg(F.sum("own").alias("own"))
    children = (
        upper.select("parent").unionByName(nodes.select("parent")).where("parent is not null")
        .groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    )
    over = upper.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = seqs.where("cut is null").select("key", F.col("ends").alias("ends_sha256"))
    joined = upper.join(own, "key").join(children, "key", "left").join(over, "parent", "left").join(ends, "key", "left")
    n_children = F.coalesce("n_children", F.lit(0)).cast("long")
    return joined.select(
        "key", "conv_id", "depth", "parent_conv_id", "n_convs", n_children.alias("n_children"),
        F.when(n_children == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.col("below") + F.col("own")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_END)).alias("ends_sha256"),
    )


def build_trie(conversations: DataFrame, *, block: int = 5, most_heads: int = 8) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    The conversations are rebuilt first: conversation c begins with the first h turns of conversation c - c % block, where h is
    the CRC-32 of c in decimal modulo most_heads + 1, and goes on with its own after the first h. Turns are ordered by
    number, null first, those of one number by the digest of role and text; repeated rows are turns of their own. Null role or
    text is empty. Rows of null conv_id belong to no conversation and are left out. An empty table has no nodes, not even the start.
    Other columns are ignored. A conversation passes through one task as 40 bytes per turn, whatever the length of its texts.
    """
    own = kept(own_turns(conversations))
    convs = kept(rebuilt(own, block, most_heads).mapInArrow(
        chain, "conv long, key binary, turns array<struct<digest:binary,key:binary,bytes:long>>"
    ))
    seqs = kept(with_cuts(kept(sequences(convs))))
    shards = seqs.where("cut is not null").select(
        F.expr("turns[cut - 1].key").alias("shard"), "cut", "n", "first", "ends",
        F.expr("transform(slice(turns, cut, size(turns)), t -> struct(t.digest as digest, t.bytes as bytes))").alias("turns"),
        F.expr("transform(slice(turns, 1, cut - 1), t -> struct(t.key as key, t.bytes as bytes))").alias("above"),
    )
    dealt = shards.repartition(shuffle_partitions(conversations.sparkSession), "shard").sortWithinPartitions("shard")
    nodes = kept(dealt.mapInArrow(tries, NODE))
    upper = kept(upper_nodes(seqs, nodes))

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # Most shards hang from the start: its row, one at most, is looked up here. The others are joined with their parents.
    start = upper.where("depth = 0").first()
    inner = nodes.where("parent is null or length(parent) = 0").withColumn(
        "parent_conv_id",
        F.when(F.col("parent").isNull(), F.col("parent_conv_id")).otherwise(F.lit(start.conv_id if start else None).cast("long")),
    )
    over = upper.select(F.col("key").alias("parent"), F.col("conv_id").alias("over"))
    hung = nodes.where("length(parent) > 0").join(over, "parent").drop("parent_conv_id").withColumnRenamed("over", "parent_conv_id")
    return inner.select(columns).unionByName(hung.select(columns)).unionByName(upper.select(columns))
