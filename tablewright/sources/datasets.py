"""Datasets in files and tables, read with a declared schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.checks import check_choice, check_integer
from tablewright.functions.names import quoted

FORMATS = ("csv", "parquet", "avro")

# Both directions of the delimited format use these, so that text, nulls, empty strings and
# microseconds come back as they were written.
DELIMITED = {
    "quote": '"',
    "escape": '"',
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# In a file, nothing between two separators is null and "" is empty text. Spark takes both for null
# as long as its null mark is empty, so the reader gets a mark that no written text consists of:
# the writer refuses such a text, or escapes it.
NULL_MARK = "\u0001"

# What an escaped file has in place of characters that end a line or a value. The escape character
# comes first when writing and last when reading. A null has a mark of its own there.
ESCAPES = (("\\", "\\e"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\u0000", "\\0"), (NULL_MARK, "\\1"))
ESCAPED_NULL = "\\N"


def escaped(text: Column) -> Column:
    for character, spelled in ESCAPES:
        text = F.replace(text, F.lit(character), F.lit(spelled))
    return text


def unescaped(text: Column) -> Column:
    for character, spelled in reversed(ESCAPES):
        text = F.replace(text, F.lit(spelled), F.lit(character))
    return text


def with_texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """All columns, the text ones changed."""
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[change(quoted(c)).alias(c) if c in texts else quoted(c) for c in df.columns])


def read_dataset(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = False,
    multi_line: bool = False,
    escape: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A file dataset. Compression is told by the file extension.

    Delimited files need their schema: inferring it would read everything once more, and could
    change from run to run. A line that does not fit the schema is an error. ``escape`` reads what
    ``save_dataset`` wrote with it: every text comes back, and files can be split. Quoted line breaks
    of other writers need ``multi_line``; such files cannot be split. Avro needs Spark's avro package.
    """
    check_choice("fmt", fmt, FORMATS)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a delimited dataset needs a schema")
        reader = reader.options(
            **DELIMITED,
            sep=sep,
            header=header,
            multiLine=multi_line,
            nullValue=ESCAPED_NULL if escape else NULL_MARK,
            mode="FAILFAST",
        )
    rows = reader.options(**(options or {})).load(path)
    return with_texts(rows, unescaped) if fmt == "csv" and escape else rows


def read_table(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    """A table or view by name, within ``schema`` (database) if one is given."""
    return spark.table(table_name(table, schema))


def read_external_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    bounds: tuple[int, int],
    num_partitions: int,
    schema: str | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table of another database over JDBC.

    It is read in ``num_partitions`` parts by a numeric column and its bounds, never by one task
    alone. Rows outside the bounds are read too.
    """
    name = f"{schema}.{table}" if schema else table
    check_integer("num_partitions", num_partitions, low=1)
    return spark.read.jdbc(
        url,
        name,
        column=partition_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=num_partitions,
        properties=properties,
    )


def table_name(table: str, schema: str | None = None) -> str:
    """The quoted full name."""
    parts = [table] if schema is None else [schema, table]
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)
