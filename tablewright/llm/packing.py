"""Best-fit packing by large-item matching.

What a plan of sequences depends on is only how many pieces there are of each length, at most 2048
numbers whatever the corpus. The plan is made from those counts in runs of equal sequences; the pieces are
then dealt to its places by their rank among pieces of equal length, which Spark computes.
"""

from __future__ import annotations

import bisect
import functools
import json
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm.common import id_and_text, kept, map_texts, shuffle_partitions

CAPACITY = 2048
END_ID = 0
CACHED_WORDS = 1_000_000
RANK_BITS = 44

# Fixed values of the vocabulary's own format: how it splits text, and how it ends a word.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

# Characters for which lower case and composition are settled character by character.
PLAIN = re.compile("[\x21-\x7eÀ-ÿ]+")
BREAK = "\x01"


def byte_letters() -> dict[str, int]:
    """Byte-level vocabularies spell printable bytes as themselves and the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class WordTokenizer:
    """Ids of texts, the same as the library's for the vocabulary file, word by word from a cache.

    Words of plain letters missing from the cache are merged by rank, with byte 0 as the mark of a
    word's end; all others go to the library itself, and so do whole texts that hold a special token's name.
    """

    def __init__(self, file: str, cached: int = CACHED_WORDS):
        self.library = Tokenizer.from_file(file)
        with open(file, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        letters, self.ranks = byte_letters(), {b"\x00": 0}
        for token, number in vocabulary.items():
            ends = token.endswith(WORD_END)
            core = token.removesuffix(WORD_END)
            if core and all(c in letters for c in core) and b"\x00" not in (key := bytes(letters[c] for c in core)):
                self.ranks[key + b"\x00" * ends] = number + 1
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        for special in self.specials:
            self.ranks.pop(special.encode(), None)
        for byte in range(1, 256):
            self.ranks.setdefault(bytes([byte]), len(vocabulary) + 1 + byte)
        self.merge = tiktoken.Encoding(
            "words", pat_str=r"[^ ]+", mergeable_ranks=self.ranks, special_tokens={}
        ).encode_ordinary
        self.split = regex.compile(PIECES)
        self.break_id = self.merge(BREAK + "\x00")[0]
        self.cached = cached
        self.start()

    def start(self, room: int | None = None) -> None:
        self.places: dict[str, int] = {"": 0}
        room = room or self.cached
        self.ids = np.zeros(4 * room, np.uint32)
        self.starts = np.zeros(room + 2, np.int64)
        self.n = 1  # words known; word 0 is the empty one

    def learn(self, words: list[str]) -> None:
        """Add words to the cache: plain ones are split and merged all at once, with a break after each."""
        plain = [w for w in words if PLAIN.fullmatch(w)]
        if plain:
            marked = self.split.sub("\\g<0>\x00 ", f" {BREAK} ".join(plain).lower() + f" {BREAK}")
            found = np.array(self.merge(marked), np.int64)
            breaks = found == self.break_id
            self.store(plain, found[~breaks] - 1, np.diff(np.append(-1, np.flatnonzero(breaks))) - 1)
        for word in words:
            if word not in self.places:
                found = np.array(self.library.encode(word, add_special_tokens=False).ids, np.int64)
                self.store([word], found, np.array([len(found)]))

    def store(self, words: list[str], found: np.ndarray, lengths: np.ndarray) -> None:
        at, n = int(self.starts[self.n]), self.n
        if at + len(found) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids) // 2, len(found)), np.uint32)])
        self.ids[at : at + len(found)] = found
        self.n += len(words)
        self.starts[n + 1 : self.n + 1] = at + np.cumsum(lengths)
        self.places.update(zip(words, range(n, self.n), strict=True))

    def holds_special(self, text: str) -> bool:
        """Whether the library may read part of the text as a token of its own, in whatever case."""
        return "<" in text and any(special.lower() in text.lower() for special in self.specials)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text. The words of all texts are told apart by Arrow, and each different one is looked up once."""
        whole = {i: np.array(self.library.encode(t, add_special_tokens=False).ids, np.uint32)
                 for i, t in enumerate(texts) if self.holds_special(t)}
        column = pa.array(["" if i in whole else t for i, t in enumerate(texts)], pa.large_string())
        # Only these four divide words here; any other white space is the library's to drop.
        for space in "\n\t\r":
            column = pc.replace_substring(column, space, " ")
        split = pc.split_pattern(column, " ")
        words = split.flatten().dictionary_encode()
        numbers = self.numbers_of(words.dictionary.to_pylist())
        ids, starts = self.ids_of_words(numbers)
        used = words.indices.to_numpy()
        lengths = np.diff(starts)[used]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        flat = ids[np.arange(total) + np.repeat(starts[used] - (ends - lengths), lengths)]
        of_text = np.append(0, ends)[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return [whole.get(i, flat[of_text[i] : of_text[i + 1]]) for i in range(len(texts))]

    def numbers_of(self, words: list[str]) -> np.ndarray:
        """The places in the cache of different words; what it lacks is learned, and it begins anew where they don't fit."""
        get = self.places.get
        numbers = [get(w) for w in words]
        missing = [w for w, n in zip(words, numbers, strict=True) if n is None]
        if missing:
            if self.n + len(missing) > len(self.starts) - 2:
                self.start(max(self.cached, len(words)))
                missing = [w for w in words if w]
            self.learn(missing)
            get = self.places.get
            numbers = [get(w) for w in words]
        return np.array(numbers, np.int64)

    def ids_of_words(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after the other, and where each begins."""
        begin = self.starts[numbers]
        length = self.starts[numbers + 1] - begin
        starts = np.append(0, np.cumsum(length))
        return self.ids[np.arange(starts[-1]) + np.repeat(begin - starts[:-1], length)], starts


@functools.lru_cache(1)
def worker_tokenizer(file: str) -> WordTokenizer:
    """One per worker process: its words stay known from task to task."""
    return WordTokenizer(file)


def make_pieces(file: str, capacity: int, keep_ids: bool):
    tokenizer = worker_tokenizer(file)

    def pieces(texts):
        rows, numbers, starts, lengths, sums, ids = [], [], [], [], [], []
        for row, found in enumerate(tokenizer.encode_all(texts)):
            line = np.append(found, np.uint32(END_ID)).astype("<u4")
            for number, start in enumerate(range(0, len(line), capacity)):
                piece = line[start : start + capacity]
                rows.append(row)
                numbers.append(number)
                starts.append(start)
                lengths.append(len(piece))
                sums.append(zlib.crc32(piece.tobytes()))
                if keep_ids:
                    ids.append(piece.astype(np.int32))
        out = [rows, numbers, starts, lengths, sums]
        return out + [pa.array(ids, pa.list_(pa.int32()))] if keep_ids else out

    return pieces


def token_pieces(
    docs: DataFrame, tokenizer_file: str, *, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, keep_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): each text's ids and an end, cut at capacity.

    A null or empty text is one piece that holds the end only.
    """
    schema = "piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return map_texts(
        id_and_text(docs, id_col, text_col), ["id"], "text", schema, make_pieces, tokenizer_file, capacity, keep_ids,
        many=True,
    ).withColumnRenamed("id", "doc_id")


class Plan:
    """Places for all pieces: runs of equal sequences, kept as (length, count, first sequence, offset, step).

    A run's k-th piece of its length goes to sequence first + k // step, as the (k % step)-th of its kind there.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.sequences = capacity, 0
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: [(first sequence, how many)]
        self.sorted_gaps: list[int] = []
        left = {n: c for n, c in counts.items() if c}
        self.match_large(left)
        for length in sorted(left, reverse=True):
            self.fit(length, left[length])

    def put(self, length: int, first: int, n: int, each: int, gap: int) -> None:
        """``each`` pieces of a length into each of n sequences that have ``gap`` left."""
        self.runs.append((length, n * each, first, self.capacity - gap, each))
        self.free(gap - each * length, first, n)

    def free(self, gap: int, first: int, n: int) -> None:
        if gap and n:
            if not self.gaps.get(gap):
                bisect.insort(self.sorted_gaps, gap)
            self.gaps[gap].append((first, n))

    def match_large(self, left: dict[int, int]) -> None:
        """No sequence holds three pieces above a third: pair each, the longest first, with the longest that fits."""
        large = sorted(n for n in left if 3 * n > self.capacity)
        while large:
            longest = large[-1]
            at = bisect.bisect_right(large, self.capacity - longest) - 1
            partner = large[at] if at >= 0 else 0
            if partner == longest:
                n = left[longest] // 2
                if n == 0:
                    partner = 0
            if partner and partner != longest:
                n = min(left[longest], left[partner])
            if not partner:
                n = left[longest]
            first, self.sequences = self.sequences, self.sequences + n
            self.runs.append((longest, n, first, 0, 1))
            if partner:
                self.runs.append((partner, n, first, longest, 1))
            self.free(self.capacity - longest - partner, first, n)
            for length in (longest, partner):
                if length:
                    left[length] -= n
            for length in {longest, partner} - {0}:
                if left[length] == 0:
                    del left[length]
                    large.remove(length)

    def fit(self, length: int, n: int) -> None:
        """Best fit: into the smallest gap that takes the piece, again and again while it does."""
        while n:
            at = bisect.bisect_left(self.sorted_gaps, length)
            if at < len(self.sorted_gaps):
                gap = self.sorted_gaps[at]
                first, many = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.gaps[gap]
                    self.sorted_gaps.pop(at)
            else:
                gap, first, many = self.capacity, self.sequences, -(-n // (self.capacity // length))
                self.sequences += many
            each = gap // length
            full = min(many, n // each)
            if full:
                self.put(length, first, full, each, gap)
                n -= full * each
            if full < many:
                rest, some = first + full, min(n, each)
                if some:
                    self.put(length, rest, 1, some, gap)
                    n -= some
                    rest += 1
                self.free(gap, rest, first + many - rest)

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (length and first rank) and, for each, first sequence, offset, step and first rank."""
        ranks: dict[int, int] = defaultdict(int)
        keys, rows = [], []
        for length, n, first, offset, step in self.runs:
            keys.append(length << RANK_BITS | ranks[length])
            rows.append((first, offset, step, ranks[length]))
            ranks[length] += n
        order = np.argsort(np.array(keys, np.int64)) if keys else np.zeros(0, int)
        return np.array(keys, np.int64)[order], np.array(rows, np.int64).reshape(-1, 4)[order]


def ranked(pieces: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The pieces with ``rank`` among those of equal length, from 0; how many there are of each length.

    A length that many pieces share is split by a salt: ranks run inside (length, salt) and are moved
    by the counts of the salts before.
    """
    spark = pieces.sparkSession
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(4 * shuffle_partitions(spark))))
    groups = kept(salted.groupBy("length", "salt").agg(F.count("*").alias("n")))
    counts = {r.length: r.n for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    moved = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    numbered = salted.withColumn("place", F.row_number().over(inside) - 1).join(moved, ["length", "salt"])
    return numbered.withColumn("rank", F.col("place") + F.col("before")).drop("salt", "place", "before"), counts


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (doc_id, piece, length, ids_crc32 and any more) with sequence_id and offset."""
    numbered, counts = ranked(kept(pieces))
    keys, rows = Plan(counts, capacity).table()
    names = [*pieces.columns]

    def deal(batches):
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy(zero_copy_only=False).astype(np.int64)
            first, offset, step, start = rows[np.searchsorted(keys, length << RANK_BITS | rank, "right") - 1].T
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in names]
                + [pa.array(first + (rank - start) // step), pa.array(offset + (rank - start) % step * length)],
                names=[*names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return numbered.select(*names, F.col("rank").cast("long")).mapInArrow(deal, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_file: str, *, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pack all texts into few sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset. Repeated rows are
    packed as often as they occur; null ids stay null; other columns are ignored; an empty table packs to no row.
    """
    return place_pieces(
        token_pieces(docs, tokenizer_file, id_col=id_col, text_col=text_col, capacity=capacity, keep_ids=keep_ids), capacity
    )
