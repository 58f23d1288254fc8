"""The pipeline's rows against its stages done plainly, one document at a time."""

from __future__ import annotations

import zlib

import numpy as np
from test_operators import brute_components
from tokenizers import Tokenizer

import corpus_pipeline
from tablewright.llm import decontamination, line_quality, secret_scan
from tablewright.llm.queries import tokenizer_file


def test_rows_equal_plain_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()

    table = spark.read.parquet(f"{folder}/documents.parquet")
    docs = sorted((r.doc_id, r.text or "") for r in table.collect())
    field = line_quality.fit_line_field(table, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = line_quality.make_judge(field, line_quality.LEAST_SHARE)([t for _, t in docs])[-1]
    docs = [d for d, good in zip(docs, kept, strict=True) if good]
    docs = [docs[i] for i, _, root in brute_components([t for _, t in docs]) if i == root]

    def grams(line, size):
        return {tuple(line[i : i + size]) for i in range(len(line) - size + 1)}

    items = [decontamination.words(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    windows: dict[int, set] = {}
    for line in items:
        if line:
            windows.setdefault(min(10, len(line)), set()).update(grams(line, min(10, len(line))))
    docs = [d for d in docs if not any(grams(decontamination.words(d[1]), n) & w for n, w in windows.items())]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    words = secret_scan.ranked_words(left, tokenizer_file())
    texts = secret_scan.make_redactor(secret_scan.LEAST_COST, "[SECRET]", words)([t for _, t in docs])[1]

    library = Tokenizer.from_file(tokenizer_file())
    expected = set()
    for (doc_id, _), text in zip(docs, texts, strict=True):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            expected.add((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected and len(rows) == len(expected)


def test_stages_are_whole_and_keep_columns(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "jaccard_join", "decontamination", "secret_scan", "packing",
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, table, folder).columns == table.columns
        assert stage(spark, table.limit(0), folder).count() == 0
