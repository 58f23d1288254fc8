"""Save a table as files, as a catalog table or as a view."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.checks import check_choice, check_integer, require_columns
from tablewright.sources.datasets import (
    DELIMITED,
    ESCAPED_NULL,
    FORMATS,
    NULL_MARK,
    escaped,
    table_name,
    with_texts,
)


def save_dataset(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    overwrite: bool = False,
    compression: str | None = None,
    sep: str = ",",
    header: bool = False,
    max_records_per_file: int | None = None,
    multi_line: bool = False,
    escape: bool = False,
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> str:
    """Write ``df`` below ``path`` and return the path.

    Every task writes its own files. A path that exists is an error unless ``overwrite`` is set.

    A delimited file holds a row per line. With ``escape`` any text can be written, and is read
    with ``escape``. Without, a text that would not come back is an error when it is written: one
    with a line break, unless the file is declared ``multi_line``, or one that reads as null.
    """
    check_choice("fmt", fmt, FORMATS)
    if partition_by:
        require_columns(df, partition_by)
    if fmt == "csv":
        df = with_texts(df, escaped if escape else lambda text: readable(text, multi_line))
    writer = df.write.format(fmt).mode("overwrite" if overwrite else "errorifexists")
    if fmt == "csv":
        writer = writer.options(**DELIMITED, sep=sep, header=header)
        if escape:
            writer = writer.options(nullValue=ESCAPED_NULL, quoteAll=True)
        elif len(df.columns) == 1:  # an empty line would be passed over
            writer = writer.option("nullValue", NULL_MARK)
    if compression is not None:
        writer = writer.option("compression", compression)
    if max_records_per_file is not None:
        check_integer("max_records_per_file", max_records_per_file, low=1)
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.options(**(options or {})).save(path)
    return path


def readable(text: Column, multi_line: bool) -> Column:
    """The text, or an error where it would be read as something else."""
    lost = (text == F.lit(NULL_MARK)) | text.contains("\u0000")
    if not multi_line:
        lost = lost | text.contains("\n") | text.contains("\r")
    reason = "a text with a line break or a null mark: write it with escape or multi_line"
    return F.when(lost, F.raise_error(F.lit(reason))).otherwise(text)


def write_rejects(bad_rows: DataFrame, path: str, enabled: bool = True, **how) -> str | None:
    """Save the removed rows, if the user wants them kept."""
    return save_dataset(bad_rows, path, **how) if enabled else None


def save_as_table_or_view(
    df: DataFrame,
    name: str,
    schema: str | None = None,
    is_view: bool = False,
    drop_if_exists: bool = False,
    path: str | None = None,
    fmt: str = "parquet",
) -> str:
    """Save ``df`` under a name and return it, quoted.

    A view lives as long as the session and stores nothing. A table is written by all tasks; with
    ``path`` its files lie there, else in the warehouse. A name in use is an error unless
    ``drop_if_exists`` is set: a view then replaces the view of that name, and a table, once it is
    written, whatever has its name, which stays if that fails. Nothing that depends on that is dropped with it. Give a new
    ``path`` to a new table: it may not lie where the old one does.
    """
    spark = df.sparkSession
    if is_view:
        if schema is not None:
            raise ValueError("a session view belongs to no schema")
        if path is not None:
            raise ValueError("a view stores no files")
    full_name = table_name(name, schema)
    if not drop_if_exists and spark.catalog.tableExists(full_name):
        raise ValueError(f"{full_name} exists")
    if is_view:
        df.createOrReplaceTempView(name)
        return full_name
    if not drop_if_exists:
        _write_table(df, full_name, path, fmt)
        return full_name
    # The new table is whole before the old one goes: it may be made of the old one, or fail.
    staged = table_name(f"{name}_{uuid.uuid4().hex}", schema)
    try:
        _write_table(df, staged, path, fmt)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    _swap(spark, staged, name, schema)
    return full_name


def _swap(spark: SparkSession, staged: str, name: str, schema: str | None) -> None:
    """Give ``staged`` the name. A table that has it is renamed aside first and goes last; if the second renaming
    fails, it gets its name back, and the staged table is dropped."""
    full_name = table_name(name, schema)
    aside = table_name(f"{name}_{uuid.uuid4().hex}", schema)
    if schema is None:
        spark.catalog.dropTempView(name)
    old = None
    if spark.catalog.tableExists(full_name):
        old = "VIEW" if spark.catalog.getTable(full_name).tableType == "VIEW" else "TABLE"
        spark.sql(f"ALTER {old} {full_name} RENAME TO {aside}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {full_name}")
    except Exception:
        if old is not None:
            spark.sql(f"ALTER {old} {aside} RENAME TO {full_name}")
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    if old is not None:
        spark.sql(f"DROP {old} IF EXISTS {aside}")


def _write_table(df: DataFrame, full_name: str, path: str | None, fmt: str) -> None:
    writer = df.write.format(fmt).mode("errorifexists")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(full_name)


def drop_table_or_view(spark: SparkSession, name: str, schema: str | None = None) -> None:
    """Drop the session view and the table or stored view of this name, where there are any."""
    if schema is None:
        spark.catalog.dropTempView(name)
    full_name = table_name(name, schema)
    try:
        spark.sql(f"DROP TABLE IF EXISTS {full_name}")
    except AnalysisException:
        spark.sql(f"DROP VIEW IF EXISTS {full_name}")
