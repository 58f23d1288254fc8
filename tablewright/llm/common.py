"""What the operators share: batches of texts in tasks, the checkpoint folder, normalised words."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Most code points that a task turns into Python strings at a time. A longer text is a slice of its own.
SLICE_CHARS = 4_000_000

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def checkpoint_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a folder below the warehouse, which is shared wherever tables are."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints").rstrip("/")


def ensure_checkpoints(spark: SparkSession) -> None:
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(checkpoint_folder(spark))


# The files of a run's shuffles go when the run is over, instead of when the driver next collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(table: DataFrame) -> DataFrame:
    """The table, written to the shared checkpoint folder and read from there: its lineage is cut, and the files of the
    shuffles that made it go at once."""
    spark = table.sparkSession
    ensure_checkpoints(spark)
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        return table.select("*").checkpoint()  # a table made while the setting holds
    finally:
        spark.conf.set(SHUFFLES_GO, before)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this library, whatever folder they run in: it is added to the job as an archive."""
    context = spark.sparkContext
    if getattr(context, "_tablewright_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = f"{context._temp_dir}/{package.name}.zip"  # the driver's own folder; Spark hands copies to executors
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    context._tablewright_shipped = True


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns in use, as ``id`` (long) and ``text``: no other name can clash."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )


def free_name(table: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever the case."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


ROW_BITS = 33  # monotonically_increasing_id: a row's place in its partition is below these bits


def consecutive(table: DataFrame, *order: str) -> DataFrame:
    """The table sorted, with ``part`` and ``number`` from 0 on; written to the shared folder.

    Equal rows may lie in several partitions. Only one count per partition comes to the driver.
    """
    tie = table.withColumn("tie", F.monotonically_increasing_id())
    by = [*order, "tie"]
    lies = kept(tie.repartitionByRange(shuffle_partitions(table.sparkSession), *by).sortWithinPartitions(*by).drop("tie"))
    spotted = lies.withColumn("spot", F.monotonically_increasing_id()).withColumn("part", F.shiftright("spot", ROW_BITS))
    counts = {r.part: r["count"] for r in spotted.groupBy("part").count().collect()}
    starts, total = [], 0
    for part in range(max(counts, default=-1) + 1):
        starts.append(total)
        total += counts.get(part, 0)
    first = F.get(F.array(*[F.lit(s).cast("long") for s in starts or [0]]), F.col("part").cast("int"))
    return spotted.withColumn("number", first + F.col("spot").bitwiseAND(F.lit((1 << ROW_BITS) - 1))).drop("spot")


SAMPLE_SLOTS = 1 << 30


def in_sample(n: int, total: int, *columns: Column | str) -> Column:
    """Whether a row is in a sample of about ``n`` of ``total`` rows, by a hash of the columns: the same rows on every
    run and on any cluster, found without sorting. All rows where there are no more than n."""
    slot = F.pmod(F.xxhash64(*columns, F.lit("sample")), F.lit(SAMPLE_SLOTS))
    return slot < F.lit(int(SAMPLE_SLOTS * min(1.0, n / total)) if total else 0)


def stretch(text: Column | str, size: int, *columns: Column | str) -> Column:
    """The text, or, of one above ``size`` code points, so many of them from a place that a hash of the columns chooses."""
    text = F.col(text) if isinstance(text, str) else text
    places = F.length(text) - size + 1
    start = F.when(places > 1, F.pmod(F.xxhash64(*columns, F.lit("stretch")), places) + 1).otherwise(1)
    return F.substring(text, start.cast("int"), F.lit(size))


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about SLICE_CHARS characters together, at least one row each."""
    sizes = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > SLICE_CHARS:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def map_texts(
    table: DataFrame, keep: list[str], text_col: str, schema: str, make: Callable, *args, many: bool = False
) -> DataFrame:
    """Run ``make(*args)``, built once per task, over slices of texts (null: empty).

    The built function takes a list of texts and returns one list per column of ``schema``; the columns
    ``keep`` of each row go in front. With ``many`` it returns first the row number that each
    result belongs to, and there may be any number of results for a text.
    """
    source = table.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("__text"))
    added = T._parse_datatype_string(schema)
    out = T.StructType([T.StructField(f.name, f.dataType) for f in source.schema.fields[:-1]] + added.fields)
    arrow = to_arrow_schema(out)
    n_keep = len(keep)

    def run(batches):
        function = make(*args)
        for batch in batches:
            for part in slices(batch, n_keep):
                texts = [t or "" for t in part.column(n_keep).to_pylist()]
                found = list(function(texts))
                kept_columns = part.columns[:n_keep]
                if many:
                    rows = pa.array(found.pop(0), pa.int64())
                    kept_columns = [c.take(rows) for c in kept_columns]
                columns = kept_columns + [
                    x if isinstance(x, pa.Array) else pa.array(x, f.type)
                    for x, f in zip(found, list(arrow)[n_keep:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )

    return source.mapInArrow(run, out)


def rewrite_rows(docs: DataFrame, text_col: str, make: Callable, *args) -> DataFrame:
    """All columns of ``docs``; ``make(*args)`` gives a function of a list of texts.

    It returns a list of booleans (rows to keep) and a list of new texts or None (texts stay).
    A null text is passed as empty and stays null unless the new text differs from empty.
    """
    arrow = to_arrow_schema(docs.schema)
    at = docs.columns.index(text_col)
    lengths = [i for i, f in enumerate(docs.schema) if f.name == "n_chars"]

    def run(batches):
        function = make(*args)
        for batch in batches:
            for part in slices(batch, at):
                texts = [t or "" for t in part.column(at).to_pylist()]
                keep, new = function(texts)
                columns = list(part.columns)
                if new is not None:
                    old = part.column(at).to_pylist()
                    columns[at] = pa.array([o if (o or "") == t else t for o, t in zip(old, new, strict=True)], arrow[at].type)
                    for i in lengths:
                        before = columns[i].to_pylist()
                        columns[i] = pa.array(
                            [b if x == y else len(y) for b, x, y in zip(before, texts, new, strict=True)], arrow[i].type
                        )
                whole = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)
                yield whole.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
