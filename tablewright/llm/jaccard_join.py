"""N-gram Jaccard join by PartEnum signatures.

Sets of word shingles fall into bands of sizes; a set is signed in its own band and in the next, so that two
sets similar enough to link share a band. In a band, two linked sets differ in at most k shingles. The domain of
shingle hashes is cut into more than k parts, and a set has one signature per part: what it holds there.
Two linked sets agree in all parts but k, so that:

* they share a signature (more than k parts), and
* of the signatures of either, in any order common to all, the first k + 1 hold a shared one.

The order used is by rising number of sets that share a signature. Signatures that no other set has come
first, and a set with more than k of those has no partner at all. This settles most sets, and all that
merely share a frequent passage, before any pair exists.

Pairs are made in three steps, checked exactly after each. First every set is paired with the nearest of the first sets of
its signatures, so that a large group of near copies costs a few pairs per member. The sets that then share a signature with one
of another component, and may link with it by sizes and sketches, are dealt again with sketches as wide as their sizes
need to tell sets apart: first each with the nearest one of another component, then with all that
these sketches leave possible. Families of sets that are alike but not enough are thus told apart where they
lie, without a row per pair, and no link between components is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import free_name, id_and_text, kept, map_texts, shuffle_partitions

SHINGLE = 5
# Parts beyond the k + 1 that the method needs, as a share: so many frequent signatures a set can do without.
SPARE = 0.25
# Signatures that a bucket holds on average: 5 of their bytes are enough to tell them apart in it.
BUCKET_SIGNATURES = 2_000_000
SIGNATURE_BYTES = 5
# Limits of a task's memory: sets known to be signed, and signatures dealt at once.
SEEN = 500_000
DEALT_AT_ONCE = 1_000_000
EMPTY_PART = np.uint64(0x5851F42D4C957F2D)

# Odd multipliers for the places of a shingle, and the finaliser of a 64-bit hash.
PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX[0]
    x = (x ^ (x >> np.uint64(33))) * MIX[1]
    return x ^ (x >> np.uint64(33))


def shingles(text: str) -> np.ndarray:
    """Sorted hashes of the distinct shingles: five words, or all words of a shorter text."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in found], np.uint64)
    size = min(SHINGLE, len(found))
    total = np.full(len(found) - size + 1, size, np.uint64)
    for place in range(size):
        total += hashes[place : len(hashes) - size + 1 + place] * PLACES[place]
    return np.unique(mixed(total))


def key_of(hashes: np.ndarray) -> int:
    """The set's number, 64 bits: equal sets have equal numbers."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


class Bands:
    """Bands of sizes [low, high] with high = 5/4 low, so that linked sets lie in one band or in neighbours."""

    def __init__(self):
        self.highs = [0]

    def of(self, size: int) -> int:
        while self.highs[-1] < size:
            self.highs.append((self.highs[-1] + 1) * 5 // 4)
        return int(np.searchsorted(self.highs, size))

    def differences(self, band: int) -> int:
        """Most shingles in which linked sets signed in the band differ: 5 I >= 4 U means 9 (U - I) <= sum of sizes."""
        while len(self.highs) <= band:
            self.highs.append((self.highs[-1] + 1) * 5 // 4)
        return 2 * self.highs[band] // 9

    def parts(self, band: int) -> int:
        least = self.differences(band) + 1
        return least + int(np.ceil(SPARE * least))


BANDS = Bands()


def signatures(hashes: np.ndarray, band: int) -> np.ndarray:
    """One per non-empty part; none where linked sets could not differ at all."""
    if BANDS.differences(band) == 0 or not len(hashes):
        return np.zeros(0, np.uint64)
    part = ((hashes >> np.uint64(32)) * np.uint64(BANDS.parts(band))) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    content = np.add.reduceat(mixed(hashes ^ MIX[0]), first)
    return mixed(content ^ (part[first] * PLACES[0] + np.uint64(band) * PLACES[1]))


def empty_signatures(hashes: np.ndarray, band: int, n: int) -> np.ndarray:
    """The signatures of the first n empty parts."""
    part = ((hashes >> np.uint64(32)) * np.uint64(BANDS.parts(band))) >> np.uint64(32)
    empty = np.setdiff1d(np.arange(BANDS.parts(band), dtype=np.uint64), part)[:n]
    return mixed(EMPTY_PART ^ (empty * PLACES[0] + np.uint64(band) * PLACES[1]))


# ---- dealing signatures to buckets: rows of many signatures each, as bytes -------------------------------


def even_buckets(spark: SparkSession, n: int) -> list[int]:
    """n numbers of which repartition(n, number) deals one to each partition."""
    found = {}
    start = 0
    while len(found) < n:
        for row in spark.range(start, start + 16 * n).select("id", F.expr(f"pmod(hash(cast(id as int)), {n}) p")).collect():
            found.setdefault(row.p, row.id)
        start += 16 * n
    return [found[p] for p in range(n)]


SKETCH_BITS = 512
PLAIN_ENTRY = np.dtype([("key", "<i8"), ("n", "<u2")])
WIDEST_SKETCH = 16_384


def candidate_entry(bits: int) -> np.dtype:
    return np.dtype([("key", "<i8"), ("root", "<i8"), ("size", "<u4"), ("sketch", "<u8", (bits // 64,)), ("n", "<u2")])


MOST_IN_ENTRY = 60_000
DEALT = "bucket int, entries binary, signs binary"


def deal(table: np.ndarray, groups: list[np.ndarray], numbers: list[int]) -> pa.RecordBatch:
    """Signatures of sets (groups[i] are those of the entry table[i]) by bucket.

    A row of a bucket holds entries (key, count, and more for candidates) and then the signatures of all entries
    without the high bits that make the bucket. The lowest bit of a signature is free for a mark.
    """
    flat = np.concatenate(groups) if groups else np.zeros(0, np.uint64)
    if not len(flat):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.binary()), pa.array([], pa.binary())], ["bucket", "entries", "signs"])
    owner = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    bucket = ((flat >> np.uint64(32)) * np.uint64(len(numbers))) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    flat, owner, bucket = flat[order], owner[order], bucket[order]
    starts = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])])
    place = np.arange(len(flat))
    since = place - np.maximum.accumulate(np.where(starts, place, 0))
    new = np.flatnonzero(since % MOST_IN_ENTRY == 0)
    entry = table[owner[new]]
    entry["n"] = np.diff(np.append(new, len(flat)))
    low = flat.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SIGNATURE_BYTES]
    where = bucket[new]
    cut = np.append(np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]])), len(new))
    ends = np.append(new, len(flat))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([numbers[int(where[i])] for i in cut[:-1]], pa.int32()),
            pa.array([entry[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)], pa.binary()),
            pa.array([low[ends[i] : ends[j]].tobytes() for i, j in zip(cut, cut[1:], strict=False)], pa.binary()),
        ],
        ["bucket", "entries", "signs"],
    )


def gathered(batches, numbers: list[int], kind: np.dtype):
    """What several keys of a partition share, sorted by signature and key: group, entry, signature, mark."""
    places = {number: place for place, number in enumerate(numbers)}
    signs, entries = [], []
    for batch in batches:
        for number, entry, low in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            entries.append(np.frombuffer(entry, kind))
            wide = np.zeros((len(low) // SIGNATURE_BYTES, 8), np.uint8)
            wide[:, :SIGNATURE_BYTES] = np.frombuffer(low, np.uint8).reshape(-1, SIGNATURE_BYTES)
            signs.append(wide.view("<u8").ravel() | np.uint64(places[number]) << np.uint64(8 * SIGNATURE_BYTES))
    sign = np.concatenate(signs) if signs else np.zeros(0, np.uint64)
    entry = np.concatenate(entries) if entries else np.zeros(0, kind)
    owner = np.repeat(np.arange(len(entry)), entry["n"])
    signs, entries = [], []
    mark, sign = (sign & np.uint64(1)).astype(np.uint8), sign >> np.uint64(1)
    order = np.argsort(sign)
    same = sign[order[1:]] == sign[order[:-1]]
    order = order[np.append(same, False) | np.insert(same, 0, False)] if len(order) else order
    key = entry["key"][owner]
    order = order[np.lexsort((key[order], sign[order]))]
    order = order[changes(sign[order]) | changes(key[order])]
    group = np.cumsum(changes(sign[order])) - 1
    order = order[np.bincount(group)[group] > 1] if len(group) else order
    group = np.cumsum(changes(sign[order])) - 1
    return group, entry[owner[order]] if kind.names == PLAIN_ENTRY.names else (entry, owner[order]), sign[order], mark[order]


def changes(x: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    return np.concatenate([[True], x[1:] != x[:-1]]) if len(x) else np.zeros(0, bool)


# ---- the steps ------------------------------------------------------------------------------------------


def make_facts():
    def facts(texts):
        keys, sizes, own, after = [], [], [], []
        for text in texts:
            found = shingles(text)
            band = BANDS.of(len(found))
            keys.append(key_of(found) if len(found) else None)
            sizes.append(len(found))
            own.append(len(signatures(found, band)))
            after.append(len(signatures(found, band + 1)))
        return keys, sizes, own, after

    return facts


def sets_of(texts: DataFrame) -> DataFrame:
    """id, key, n (shingles), own and after (signatures in its band and in the next) of each text."""
    return map_texts(texts, ["id"], "text", "key long, n long, own long, after long", make_facts)


def plain(keys: list[int]) -> np.ndarray:
    entry = np.zeros(len(keys), PLAIN_ENTRY)
    entry["key"] = keys
    return entry


def dealt_signatures(texts: DataFrame, numbers: list[int]) -> DataFrame:
    """Signatures of all sets by bucket, marked 1 in the next band; a task signs equal sets once."""

    def run(batches):
        seen: set[int] = set()
        keys, groups, total = [], [], 0
        for batch in batches:
            for text in batch.column(0):
                found = shingles(text.as_py() or "")
                if not len(found) or (key := key_of(found)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
                band = BANDS.of(len(found))
                signs = [signatures(found, band + side) & ~np.uint64(1) | np.uint64(side) for side in (0, 1)]
                keys.append(key)
                groups.append(np.concatenate(signs))
                total += len(groups[-1])
                if total > DEALT_AT_ONCE:
                    yield deal(plain(keys), groups, numbers)
                    keys, groups, total = [], [], 0
        if groups:
            yield deal(plain(keys), groups, numbers)

    return texts.select("text").mapInArrow(run, DEALT).repartition(len(numbers), "bucket")


SHARED = np.dtype([("key", "<i8"), ("sign", "<u8"), ("many", "<u4"), ("after", "u1")])
FACT = np.dtype([("key", "<i8"), ("id", "<i8"), ("n", "<i8"), ("own", "<i8"), ("after", "<i8")])
BY_KEY = "bucket int, shared binary, facts binary"


def deal_by_key(rows: np.ndarray, name: str, numbers: list[int]) -> pa.RecordBatch:
    """Rows that have a key, by bucket of the key."""
    bucket = ((mixed(rows["key"].astype(np.uint64)) >> np.uint64(32)) * np.uint64(len(numbers))) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    cut = np.append(np.flatnonzero(changes(bucket)), len(rows))
    blobs = pa.array([rows[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)], pa.binary())
    none = pa.nulls(len(blobs), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([numbers[int(bucket[i])] for i in cut[:-1]], pa.int32()), *((blobs, none) if name == "shared" else (none, blobs))],
        ["bucket", "shared", "facts"],
    )


def shared_signatures(dealt: DataFrame, numbers: list[int]) -> DataFrame:
    """By bucket of key: the signatures of a set that other sets have too, and how many have them."""

    def run(batches):
        group, entry, sign, mark = gathered(batches, numbers, PLAIN_ENTRY)
        if len(group):
            rows = np.zeros(len(group), SHARED)
            rows["key"], rows["sign"], rows["many"], rows["after"] = entry["key"], sign, np.bincount(group)[group], mark
            yield deal_by_key(rows, "shared", numbers)

    return dealt.mapInArrow(run, BY_KEY)


def facts_by_key(sets: DataFrame, numbers: list[int]) -> DataFrame:
    one = sets.where("n > 0").groupBy("key").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("own").alias("own"), F.first("after").alias("after")
    )

    def run(batches):
        for batch in batches:
            rows = np.zeros(batch.num_rows, FACT)
            for name, column in zip(FACT.names, batch.columns, strict=True):
                rows[name] = column.to_numpy(zero_copy_only=False)
            yield deal_by_key(rows, "facts", numbers)

    return one.select(*FACT.names).mapInArrow(run, BY_KEY)


def candidates(shared: DataFrame, sets: DataFrame, numbers: list[int]) -> DataFrame:
    """key, id, n, signs: the sets that may have partners, with the shared ones of their first k + 1 signatures.

    ``empty_own`` and ``empty_after`` say how many empty parts belong to those, which is rare: sets that fill k parts at most.
    """

    def run(batches):
        parts, facts = [], []
        for batch in batches:
            parts += [np.frombuffer(x, SHARED) for x in batch.column(1).to_pylist() if x]
            facts += [np.frombuffer(x, FACT) for x in batch.column(2).to_pylist() if x]
        if not facts:
            return
        rows = np.concatenate([*parts, np.zeros(0, SHARED)])
        fact = np.concatenate(facts)
        parts, facts = [], []
        rows = rows[np.lexsort((rows["sign"], rows["many"], rows["after"], rows["key"]))]
        fact = fact[np.argsort(fact["key"])]
        # a set's rows lie between its limits, those of its own band before the middle
        limits = np.searchsorted(rows["key"], fact["key"], "left"), np.searchsorted(rows["key"], fact["key"], "right")
        sides = np.append(0, np.cumsum(rows["after"], dtype=np.int64))
        middle = limits[1] - (sides[limits[1]] - sides[limits[0]])
        out = [[], [], [], [], [], []]
        for i, one in enumerate(fact):
            band, signs, empty = BANDS.of(int(one["n"])), [], []
            for side, (begin, end) in enumerate(((limits[0][i], middle[i]), (middle[i], limits[1][i]))):
                filled = int(one["after" if side else "own"])
                most = BANDS.differences(band + side) + 1
                places = most - (filled - (end - begin))
                if filled and places > 0:
                    signs.append(rows["sign"][begin : min(end, begin + places)])
                empty.append(max(0, most - filled) if filled else 0)
            if any(map(len, signs)) or any(empty):
                flat = np.concatenate([*signs, np.zeros(0, np.uint64)]).astype("<u8")
                values = (int(one["key"]), int(one["id"]), int(one["n"]), flat.tobytes(), *empty)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["key", "id", "n", "signs", "empty_own", "empty_after"]
        )

    return (
        shared.unionByName(facts_by_key(sets, numbers)).repartition(len(numbers), "bucket")
        .mapInArrow(run, "key long, id long, n long, signs binary, empty_own int, empty_after int")
    )


def sketch(hashes: np.ndarray, bits: int = SKETCH_BITS) -> bytes:
    """For each class of hashes, whether the set holds an odd number: two sets' sketches differ in no
    more bits than the sets differ in shingles."""
    odd = np.bincount((mixed(hashes ^ MIX[1]) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def candidate_sets(texts: DataFrame, found: DataFrame) -> DataFrame:
    """key, n, hashes, sketch and signs of the candidates, their empty parts' signatures included."""
    joined = texts.join(found.drop("n"), "id").select("text", "key", "signs", "empty_own", "empty_after")

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                out = [[], [], [], [], []]
                rows = batch.slice(start, 200)
                for text, key, signs, own, after in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                    hashes = shingles(text or "")
                    if not len(hashes) or key_of(hashes) != key:
                        continue  # another row of the same id
                    band = BANDS.of(len(hashes))
                    more = [empty_signatures(hashes, band + side, n) for side, n in enumerate((own, after)) if n]
                    all_signs = np.concatenate([np.frombuffer(signs, "<u8"), *more]).astype("<u8")
                    values = (key, len(hashes), hashes.astype("<u8").tobytes(), sketch(hashes), all_signs.tobytes())
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["key", "n", "hashes", "sketch", "signs"]
                )

    made = joined.mapInArrow(run, "key long, n long, hashes binary, sketch binary, signs binary")
    # The joins below meet the sets where they lie.
    return made.repartition(shuffle_partitions(texts.sparkSession), "key")


def may_link(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What sizes and sketches leave possible: they prove that a pair has no link, never that it has one."""
    low, high = np.minimum(x["size"], y["size"]).astype(np.int64), np.maximum(x["size"], y["size"]).astype(np.int64)
    return (5 * low >= 4 * high) & (9 * apart(x, y) <= low + high)


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x["sketch"] ^ y["sketch"]).sum(-1).astype(np.int64)


def unique_pairs(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    """a < b, each pair once."""
    first, second = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (a, b))
    pairs = np.unique(np.stack([np.minimum(first, second), np.maximum(first, second)], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])


def candidate_table(keys, roots, sizes, bits: int) -> np.ndarray:
    table = np.zeros(len(keys), candidate_entry(bits))
    table["key"], table["root"], table["size"] = (x.to_numpy(zero_copy_only=False) for x in (keys, roots, sizes))
    return table


def mixed_groups(signs) -> list[np.ndarray]:
    """Signatures of each row. They were cut to bucket and low bytes before, and are mixed so that their high bits are even again."""
    return [mixed(np.frombuffer(x, "<u8")) & ~np.uint64(1) for x in signs.to_pylist()]


def dealt_candidates(sets: DataFrame, numbers: list[int]) -> DataFrame:
    """The candidates' signatures by bucket, with sizes, components and narrow sketches."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                keys, roots, sizes, sketches, signs = batch.slice(start, 2000).columns
                table = candidate_table(keys, roots, sizes, SKETCH_BITS)
                table["sketch"] = np.frombuffer(b"".join(sketches.to_pylist()), "<u8").reshape(len(keys), -1)
                yield deal(table, mixed_groups(signs), numbers)

    return sets.select("key", "root", "n", "sketch", "signs").mapInArrow(run, DEALT).repartition(len(numbers), "bucket")


def by_bits(batch: pa.RecordBatch):
    """The rows of each width, which the first column tells, without it."""
    bits = batch.column(0).to_numpy(zero_copy_only=False)
    for width in np.unique(bits).tolist():
        yield width, batch.filter(pa.array(bits == width)).select(range(1, batch.num_columns))


def dealt_wide(sets: DataFrame, numbers: list[int]) -> DataFrame:
    """The same with sketches as wide as ``bits`` says, all widths in one shuffle."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                for bits, rows in by_bits(batch.slice(start, 2000)):
                    keys, roots, sizes, hashes, signs = rows.columns
                    table = candidate_table(keys, roots, sizes, bits)
                    made = b"".join(sketch(np.frombuffer(x, "<u8"), bits) for x in hashes.to_pylist())
                    table["sketch"] = np.frombuffer(made, "<u8").reshape(len(keys), -1)
                    dealt = deal(table, mixed_groups(signs), numbers)
                    width = pa.array(np.full(dealt.num_rows, bits, np.int32))
                    yield pa.RecordBatch.from_arrays([width, *dealt.columns], ["bits", *dealt.schema.names])

    rows = sets.select("bits", "key", "root", "n", "hashes", "signs")
    return rows.mapInArrow(run, f"bits int, {DEALT}").repartition(len(numbers), "bucket")


def width_of(size: Column) -> Column:
    """The bits that tell sets of about this size apart: nine times the shingles in which linked ones differ, and more."""
    power = F.ceil(F.log2(2 * size.cast("double")))
    return F.least(F.greatest(F.pow(F.lit(2.0), power), F.lit(float(SKETCH_BITS))), F.lit(float(WIDEST_SKETCH))).cast("int")


def groups_of(batches, numbers: list[int], bits: int, apart_only: bool):
    """The entries of each signature in a task: no set of sets twice, and, if asked for, only of several components."""
    group, (entry, owner), _, _ = gathered(batches, numbers, candidate_entry(bits))
    if not len(group):
        return
    first = np.flatnonzero(changes(group))
    end = np.append(first[1:], len(group))
    key, root = entry["key"][owner].astype(np.uint64), entry["root"][owner]
    whole = np.stack([np.add.reduceat(mixed(key), first), np.add.reduceat(mixed(key ^ MIX[0]), first)], 1)
    use = np.unique(whole, axis=0, return_index=True)[1]
    if apart_only:
        use = use[np.minimum.reduceat(root, first)[use] != np.maximum.reduceat(root, first)[use]]
    for i in use:
        yield entry[owner[first[i] : end[i]]]


def hub_pairs(members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each set with the first of a signature, and how far apart their sketches are."""
    good = members[1:][may_link(members[1:], members[0])]
    return np.full(len(good), members["key"][0]), good["key"], apart(good, members[0])


def nearest_hubs(dealt: DataFrame, numbers: list[int]) -> DataFrame:
    """For each set and bucket, the pair (a < b) with the nearest first set of a signature."""

    def run(batches):
        found, total = [], 0

        def nearest():
            hub, key, far = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((hub, far, key))
            order = order[changes(key[order])]
            return hub[order], key[order], far[order]

        for members in groups_of(batches, numbers, SKETCH_BITS, False):
            found.append(hub_pairs(members))
            total += len(found[-1][0])
            if total > 500_000:
                found = [nearest()]
                total = 0
        if found:
            hub, key, _ = nearest()
            yield unique_pairs([hub], [key])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def partners(members: np.ndarray):
    """Each set outside of the signature's largest component, with those of other components that it may link with."""
    roots, place, many = np.unique(members["root"], return_inverse=True, return_counts=True)
    for i in np.flatnonzero(place != many.argmax()):
        others = members[place != place[i]]
        others = others[may_link(others, members[i])]
        if len(others):
            yield members[i], others


def unsettled_keys(members: np.ndarray) -> np.ndarray:
    """The sets that may still link with one of another component."""
    found = [np.append(others["key"], one["key"]) for one, others in partners(members)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def nearest_pairs(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each set outside of the signature's largest component with the nearest one by sketch of another component."""
    pairs = [(one["key"], others["key"][apart(others, one).argmin()]) for one, others in partners(members)]
    return np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)


def all_pairs_between(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All that sets of different components leave possible."""
    members = members[np.argsort(members["root"], kind="stable")]
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    ends = np.searchsorted(members["root"], members["root"], "right")
    for i in range(len(members)):
        others = members[ends[i] :]
        if not len(others):
            break
        found = others["key"][may_link(others, members[i])]
        a.append(np.full(len(found), members["key"][i]))
        b.append(found)
    return np.concatenate(a), np.concatenate(b)


def pairs_within(dealt: DataFrame, numbers: list[int], choose) -> DataFrame:
    """The pairs (a < b) that ``choose`` takes from the sets of several components that share a signature at some width."""

    def run(batches):
        parts: dict[int, list[pa.RecordBatch]] = {}
        for batch in batches:
            for bits, rows in by_bits(batch):
                parts.setdefault(bits, []).append(rows)
        a, b, total = [], [], 0
        for bits in sorted(parts):
            for members in groups_of(parts.pop(bits), numbers, bits, True):
                first, second = choose(members)
                a.append(first)
                b.append(second)
                total += len(first)
                if total > 500_000:
                    yield unique_pairs(a, b)
                    a, b, total = [], [], 0
        if total:
            yield unique_pairs(a, b)

    return dealt.mapInArrow(run, "a long, b long")


def unsettled(dealt: DataFrame, numbers: list[int]) -> DataFrame:
    """``key`` of the sets that may still link with one of another component, as far as narrow sketches tell."""

    def run(batches):
        found, total = [], 0
        for members in groups_of(batches, numbers, SKETCH_BITS, True):
            found.append(unsettled_keys(members))
            total += len(found[-1])
            if total > 500_000:
                found = [np.unique(np.concatenate(found))]
                total = len(found[0])
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)), pa.int64())], ["key"])

    return dealt.mapInArrow(run, "key long").distinct()


def wide_pairs(sets: DataFrame, numbers: list[int], choose) -> DataFrame:
    """The pairs that ``choose`` takes from unsettled sets, by sketches of widths that their sizes need.

    Linked sets are of one width or of neighbouring ones: a set is dealt in its own and, if one linked with it may be, in the next.
    """
    widths = F.array_distinct(F.array(width_of(F.col("n")), width_of(F.floor(F.col("n") * 5 / 4))))
    wide = sets.withColumn("bits", F.explode(widths))
    return pairs_within(dealt_wide(wide, numbers), numbers, choose).distinct()


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a < b) whose sets have 5 I >= 4 U, exactly."""
    left = sets.select(F.col("key").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("key").alias("b"), F.col("hashes").alias("right"))

    def run(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = np.concatenate([p, q])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                good.append(5 * shared >= 4 * (len(p) + len(q) - shared))
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), ["a", "b"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """key, root: the smallest key that links lead to. Labels fall along links, and then to their label's label."""
    turned = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.select(F.inline(F.array(F.struct("a", "b"), turned)))  # one read, where a union would take two
    labels = kept(both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("b")).select("key", F.least("key", "b").alias("root")))
    while True:
        near = both.join(labels.select(F.col("key").alias("b"), "root"), "b").groupBy(F.col("a").alias("key")).agg(F.min("root").alias("near"))
        better = labels.join(near, "key").select("key", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        target = labels.select(F.col("key").alias("root"), F.col("root").alias("next"))
        moved = kept(better.join(target, "root", "left").select("key", F.least("root", "next").alias("root"), "old"))
        labels = moved.select("key", "root")
        if moved.where("root < old").isEmpty():
            return labels


def join_similar(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    ``component_id`` is the smallest id that links lead to; a text without words links with nothing and is
    its own. Equal sets are one class and link with each other. Components are exact; links within one are not
    counted, as most of them need not be looked at. Rows of equal id link like any others. Rows of null id link nothing and get a null component; other columns are ignored.

    Equal sets are told by 64-bit numbers of their shingles' 64-bit hashes.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs, id_col, text_col)
    named = texts.where("id is not null")
    sets = kept(sets_of(texts))
    total = sets.agg(F.sum(F.col("own") + F.col("after"))).first()[0] or 0
    numbers = even_buckets(spark, max(shuffle_partitions(spark), -(-total // BUCKET_SIGNATURES)))

    shared = shared_signatures(dealt_signatures(named, numbers), numbers)
    found = kept(candidates(shared, sets.where("id is not null"), numbers))
    with_sets = kept(candidate_sets(named, found))

    tested = kept(nearest_hubs(dealt_candidates(with_sets.withColumn("root", F.col("key")), numbers), numbers))
    edges = kept(linked(tested, with_sets))
    roots = components(edges)

    def rooted(table: DataFrame) -> DataFrame:
        return table.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))

    open_keys = unsettled(dealt_candidates(rooted(with_sets), numbers), numbers)
    still_open = kept(with_sets.drop("sketch").join(open_keys, "key"))
    # Near neighbours first: what they link need not be paired any more.
    for choose in (nearest_pairs, all_pairs_between):
        new = kept(wide_pairs(kept(rooted(still_open)), numbers, choose).join(tested, ["a", "b"], "left_anti"))
        more = kept(linked(new, with_sets))
        if not more.isEmpty():
            # No more parts than before: a round has tasks for each of them several times.
            edges = kept(edges.unionByName(more).coalesce(shuffle_partitions(spark)))
            roots = components(edges)
        tested = tested.unionByName(new)

    whole = sets.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    # Written first, so that what joins it below may be dealt out anew where one component is large.
    smallest = kept(
        whole.where("id is not null and key is not null").groupBy("root").agg(F.min("id").alias("component_id"))
    )
    return whole.join(smallest, "root", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("id")).when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the documents that have one of smaller id in their component.

    Rows of equal id count as one document, of which one row stays; rows of null id all stay.
    """
    copy, row = free_name(docs, "copy"), free_name(docs, "row")
    found = join_similar(docs, id_col=id_col, text_col=text_col)
    copies = found.where("component_id < doc_id").select(F.col("doc_id").alias(copy)).distinct()
    left = docs.join(copies, F.col(f"`{id_col}`").cast("long") == F.col(copy), "left_anti")
    nameless = F.when(F.col(f"`{id_col}`").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    return left.withColumn(row, nameless).dropDuplicates([id_col, row]).drop(row)
