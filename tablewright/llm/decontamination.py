"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items.

The automaton's alphabet is words, so that it has one node per word of a window rather than one per
character, and it is scanned once per text. Word numbers map back to offsets of the original.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import free_name, id_and_text, kept, map_texts, rewrite_rows

WINDOW = 10

# Words of benchmark items that one automaton may hold: about 60 bytes a word and window place.
AUTOMATON_WORDS = 200_000
UNKNOWN = "\0"

# In UTF-8 every byte of a character beyond ASCII is 128 or more, so whole texts can be
# normalised as bytes: A-Z to a-z, all else of ASCII but letters and digits to spaces.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # the same words before lower-casing


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(NORMAL).split()


class Automaton:
    """Windows of all items; ``scan`` gives the words hit and the items found.

    Each word of the items is one letter of the automaton's alphabet, any other word is UNKNOWN. No
    window holds that, so a text falls into runs of known words, and only long enough ones are scanned.
    """

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.letters: dict[bytes, str] = {}
        windows: dict[str, set[str]] = {}
        for item, text in items:
            line = "".join([self.letters.setdefault(w, chr(len(self.letters) + 1)) for w in words(text)])
            for start in range(max(1, len(line) - window + 1) if line else 0):
                windows.setdefault(line[start : start + window], set()).add(item)
        self.tree = ahocorasick.Automaton()
        for sequence, found in windows.items():
            self.tree.add_word(sequence, (len(sequence), found))
        if windows:
            self.tree.make_automaton()
        self.shortest = min(map(len, windows), default=0)

    def scan(self, line: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Intervals [first, last] of word places, merged and ascending; ids of items that occur."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        if not self.shortest:
            return spans, found
        letter = self.letters.get
        at = 0
        for run in "".join([letter(w, UNKNOWN) for w in line]).split(UNKNOWN):
            if len(run) >= self.shortest:
                for end, (length, items) in self.tree.iter(run):
                    spans.append((at + end - length + 1, at + end))
                    found |= items
            at += len(run) + 1
        return merged(spans), found


def offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Places of words as code points of the original text, end exclusive."""
    if not spans:
        return []
    places = [m.span() for m in WORD.finditer(text)]
    return [(places[a][0], places[b][1]) for a, b in spans]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def make_report(items: list[tuple[str, str]], window: int):
    """Per text: number of words, ids found (sorted), spans as places of words and of code points, end exclusive."""
    automaton = Automaton(items, window)

    def report(texts):
        counts, found, spans = [], [], []
        for text in texts:
            line = words(text)
            hit, ids = automaton.scan(line)
            places = offsets(text, hit)
            counts.append(len(line))
            found.append(sorted(ids))
            spans.append([{"first": a, "last": b, "start": s, "end": e} for (a, b), (s, e) in zip(hit, places, strict=True)])
        return counts, found, spans

    return report


REPORT = "n_words long, item_ids array<string>, hits array<struct<first: long, last: long, start: long, end: long>>"


def make_filter(items: list[tuple[str, str]], window: int):
    automaton = Automaton(items, window)
    return lambda texts: ([not automaton.scan(words(t))[0] for t in texts], None)


def item_parts(
    benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text"
) -> tuple[int, Iterator[list[tuple[str, str]]]]:
    """How many parts of about AUTOMATON_WORDS words the items make, and the parts, one in the driver at a time.

    Items are dealt to parts by a hash. More than one part are read from a table in the shared folder. An item that is
    null has no words; a null id is spelled as empty text.
    """
    rows = benchmark.select(
        F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{text_col}`").alias("text")
    ).where("text is not null").distinct()
    total = rows.select(F.sum(F.regexp_count("text", F.lit(WORD.pattern)))).first()[0] or 0
    if total <= AUTOMATON_WORDS:
        return 1, iter([[(r.item, r.text) for r in rows.collect()]])
    # Half full on average, since a hash deals unevenly.
    count = -(-2 * total // AUTOMATON_WORDS)
    stored = kept(rows.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(count))))
    return count, ([(r.item, r.text) for r in stored.where(F.col("part") == n).collect()] for n in range(count))


def hits_of_parts(texts: DataFrame, parts: Iterator[list[tuple[str, str]]], window: int) -> DataFrame:
    """One row per different text (``key``, its digest) that any part hits: item_ids, and hits merged over the parts.

    Each part is a pass of its own, whose tasks hold that part only; what it finds lies in the shared folder.
    """
    passes = []
    for part in parts:
        found = map_texts(texts, ["key"], "text", REPORT, make_report, part, window)
        passes.append(kept(found.where(F.size("item_ids") > 0).drop("n_words").dropDuplicates(["key"])))
    every = reduce(DataFrame.unionByName, passes)
    of_text = every.groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
    )

    def joined(done, hit):
        last = F.element_at(done, -1)
        touches = (F.size(done) > 0) & (hit["first"] <= F.get(done, F.size(done) - 1)["last"] + 1)
        wider = F.struct(
            last["first"].alias("first"), F.greatest(last["last"], hit["last"]).alias("last"),
            last["start"].alias("start"), F.greatest(last["end"], hit["end"]).alias("end"),
        )
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(F.concat(done, F.array(hit)))

    kind = every.schema["hits"].dataType
    return of_text.withColumn("hits", F.aggregate("hits", F.array().cast(kind), joined))


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, item_ids (sorted), spans (start, end).

    A word is hit when it lies inside an occurrence of ``window`` consecutive words of an item, or of all
    of a shorter item. Null and empty texts have no words; long ones are scanned whole, in time in proportion. Repeated rows
    each get their row; a null id stays null; other columns are ignored. An empty benchmark hits nothing. Of overlapping or
    adjacent occurrences the span is one, so there are no ties. A benchmark above AUTOMATON_WORDS words takes a pass per part.
    """
    texts = id_and_text(docs, id_col, text_col)
    count, parts = item_parts(benchmark)
    if count == 1:
        found = map_texts(texts, ["id"], "text", REPORT, make_report, next(parts), window)
    else:
        keyed = texts.withColumn("key", F.sha2("text", 256))
        hits = hits_of_parts(keyed, parts, window)
        found = keyed.join(hits, "key", "left").select(
            "id", F.coalesce(F.regexp_count("text", F.lit(WORD.pattern)), F.lit(0)).cast("long").alias("n_words"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.coalesce("hits", F.array().cast(hits.schema["hits"].dataType)).alias("hits"),
        )
    return found.select(
        F.col("id").alias("doc_id"), "n_words",
        F.aggregate("hits", F.lit(0).cast("long"), lambda n, hit: n + hit["last"] - hit["first"] + 1).alias("n_hit"),
        "item_ids", F.transform("hits", lambda hit: F.struct(hit["start"].alias("start"), hit["end"].alias("end"))).alias("spans"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, in which no word is hit. Rows with null or empty text stay; an empty table stays empty."""
    count, parts = item_parts(benchmark)
    if count == 1:
        return rewrite_rows(docs, text_col, make_filter, next(parts), window)
    key = free_name(docs, "key")
    digest = F.sha2(F.col(f"`{text_col}`").cast("string"), 256)
    hits = hits_of_parts(docs.select(digest.alias("key"), F.col(f"`{text_col}`").alias("text")), parts, window)
    return docs.withColumn(key, digest).join(hits.select(F.col("key").alias(key)), key, "left_anti").select(*[f"`{c}`" for c in docs.columns])
