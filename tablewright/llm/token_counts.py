"""Token counts by section: texts are encoded once, whole, and tokens are attributed by their offsets.

A section is a field of the row or a line of a field. The fields of a row, joined by line breaks, are the text
that is encoded. Tokens lie end to end, so a token's first and last byte say which sections it touches:
one that lies in several goes to the section that holds most of its bytes, and of equals to the first.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import SLICE_CHARS

SCHEMA = "doc_id long, field int, line int, start long, end long, n_tokens long, n_crossing long"


@functools.lru_cache(2)
def encoder(file: str, pattern: str):
    """One per worker process: the vocabulary and each token's length in bytes."""
    with open(file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, number in ranks.items():
        sizes[number] = len(token)
    return tiktoken.Encoding("counted", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


def attribute(sizes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section (``ends`` of sections in bytes), and how many of the tokens that touch it also touch others."""
    ends = np.asarray(ends)
    token_ends = np.cumsum(sizes)
    starts = token_ends - sizes
    first = np.searchsorted(ends, starts, "right")
    last = np.searchsorted(ends, token_ends - 1, "right")
    owner = first.copy()
    begins = np.append(0, ends[:-1])
    crossing = np.zeros(len(ends), np.int64)
    for i in np.flatnonzero(first != last):
        touched = np.arange(first[i], last[i] + 1)
        held = np.minimum(ends[touched], token_ends[i]) - np.maximum(begins[touched], starts[i])
        owner[i] = touched[held.argmax()]
        crossing[touched[held > 0]] += 1
    return np.bincount(owner, minlength=len(ends)), crossing


def make_counter(file: str, pattern: str, by_line: bool):
    encoding, token_sizes = encoder(file, pattern)

    def count(rows: list[tuple[str, ...]]):
        """Of rows of fields: the row's number, then the columns of its sections."""
        out: list[list[int]] = [[] for _ in range(7)]
        for row, parts in enumerate(rows):
            sections, at = [], 0  # (field, line, first code point, end, bytes); a section holds the break that ends it
            for field, part in enumerate(parts):
                for line, piece in enumerate(part.split("\n") if by_line else [part]):
                    sections.append((field, line, at, at + len(piece), len(piece.encode()) + 1))
                    at += len(piece) + 1
            sizes = token_sizes[np.array(encoding.encode_ordinary("\n".join(parts)), np.int64)]
            bounds = np.cumsum([s[4] for s in sections])
            bounds[-1] -= 1  # nothing follows the last
            none = np.zeros(len(sections), np.int64)
            counts, crossing = attribute(sizes, bounds) if len(sizes) else (none, none)
            for (field, line, start, end, _), n, more in zip(sections, counts, crossing, strict=True):
                for column, value in zip(out, (row, field, line, start, end, int(n), int(more)), strict=True):
                    column.append(value)
        return out

    return count


def parts_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose fields have about SLICE_CHARS characters together, at least one row each."""
    sizes = sum(pc.fill_null(pc.utf8_length(c), 0).to_numpy() for c in batch.columns[1:])
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > SLICE_CHARS:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def count_tokens(docs: DataFrame, vocabulary: str, pattern: str, *, id_col: str = "doc_id",
                 fields: tuple[str, ...] = ("text",), by_line: bool = True) -> DataFrame:
    """One row per section of each row: doc_id, field, line (from 0), start, end (code points of the joined fields), n_tokens and
    n_crossing, the tokens that touch the section and another one.

    The counts of a row's sections add up to the tokens of its whole text, which is encoded as it is, control characters and all,
    however long. A null field is empty; an empty field is one empty section without tokens. Repeated rows are counted each; null
    ids stay null; an empty table gives no rows; other columns are ignored.
    """
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"f{i}") for i, c in enumerate(fields)]
    table = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), *texts)
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches):
        count = make_counter(vocabulary, pattern, by_line)
        for batch in batches:
            for part in parts_of(batch):
                rows, *found = count(list(zip(*(c.to_pylist() for c in part.columns[1:]), strict=True)))
                columns = [part.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x[1], pa.int32() if x[0] < 2 else pa.int64()) for x in enumerate(found))]
                yield pa.RecordBatch.from_arrays(columns, names)

    field = F.element_at(F.array(*map(F.lit, fields)), F.col("field") + 1)
    return table.mapInArrow(run, SCHEMA).withColumn("field", field)
