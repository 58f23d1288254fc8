from __future__ import annotations

import re

from pyspark.sql import types as T

from tablewright.llm import decontamination as dec

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("spans", T.StringType()),
])
ITEMS = [
    ("1", "One two three four five six seven eight nine ten eleven twelve"),
    ("2", "short ITEM é here"),
    ("10", "three four five six seven eight nine ten eleven twelve"),
    ("3", ""), ("4", None), (None, "nameless thing"), ("2", "short ITEM é here"),
]
TEXTS = [
    "Prefix: one, TWO three-four five six seven eight nine ten eleven twelve. End",
    "one two three four five six seven eight nine",
    "a short item É here", "a Short! item... é (here) short item é here", "", None, "x" * 50_000 + " short item é here",
    "nameless   thing", "short item É here",
]


def brute(text: str | None):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    line = pattern.findall(low(text))
    hit, found = set(), set()
    for item, body in ITEMS:
        need = pattern.findall(low(body))
        size = min(10, len(need))
        grams = {tuple(need[i : i + size]) for i in range(len(need) - size + 1)} if need else set()
        for i in range(len(line) - size + 1):
            if tuple(line[i : i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(item or "")
    return len(line), len(hit), sorted(found)


def test_counts_equal_brute_force(spark):
    docs = spark.createDataFrame([(i % 7, t, "clash") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], "x")], SCHEMA)
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    rows = dec.find_contamination(docs, bench).collect()
    assert sorted((r.n_words, r.n_hit, r.item_ids) for r in rows) == sorted(brute(t) for t in [*TEXTS, TEXTS[0]])
    assert [r.doc_id for r in rows].count(None) == 1


def test_offsets_are_those_of_the_original(spark):
    docs = spark.createDataFrame([(1, TEXTS[0], ""), (2, TEXTS[3], "")], SCHEMA)
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    rows = {r.doc_id: r for r in dec.find_contamination(docs, bench).collect()}
    assert [TEXTS[0][s.start : s.end] for s in rows[1].spans] == [TEXTS[0][8:-5]]
    # two occurrences side by side are one span
    assert [TEXTS[3][s.start : s.end] for s in rows[2].spans] == ["Short! item... é (here) short item é here"]


def test_items_in_several_automata_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t, "") for i, t in enumerate(TEXTS)], SCHEMA)
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    def rows():
        return sorted(dec.find_contamination(docs, bench).collect(), key=lambda r: r.doc_id)

    one, left = rows(), dec.remove_contaminated(docs, bench)
    clean = {r.doc_id for r in left.collect()}
    monkeypatch.setattr(dec, "AUTOMATON_WORDS", 5)
    count, parts = dec.item_parts(bench)
    assert count > 4
    assert len([x for part in parts for x in part]) == len({(i or "", t) for i, t in ITEMS if t is not None})
    assert rows() == one
    apart = dec.remove_contaminated(docs, bench)
    assert apart.schema == left.schema
    assert {r.doc_id for r in apart.collect()} == clean


def test_several_automata_and_no_documents(spark, monkeypatch):
    monkeypatch.setattr(dec, "AUTOMATON_WORDS", 5)
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = spark.createDataFrame([], "doc_id long, text string, key string, KEY_ string")
    assert dec.find_contamination(docs, bench).count() == 0
    clash = spark.createDataFrame([(1, "nameless thing", "k"), (2, None, "k"), (2, None, "k")], "doc_id long, text string, key string")
    assert [tuple(r) for r in dec.remove_contaminated(clash, bench).collect()] == [(2, None, "k")] * 2


def test_filter_keeps_clean_rows_and_all_columns(spark):
    docs = spark.createDataFrame([(i, t, "c") for i, t in enumerate(TEXTS)], SCHEMA)
    bench = spark.createDataFrame(ITEMS, "item_id string, text string")
    left = dec.remove_contaminated(docs, bench)
    assert left.schema == docs.schema
    assert {r.doc_id for r in left.collect()} == {i for i, t in enumerate(TEXTS) if not brute(t)[1]}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id string, text string")
    assert dec.find_contamination(docs, bench).count() == 0
    assert dec.find_contamination(spark.createDataFrame([(1, "a b", "")], SCHEMA), bench).first().n_hit == 0
