"""The file sink for streaming tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tablewright.checks import check_choice
from tablewright.sinks.datasets import readable
from tablewright.sources.datasets import DELIMITED, FORMATS, with_texts


def save_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    interval: str | None = None,
) -> StreamingQuery:
    """Append a streaming table below ``path``, each row once, and return the running query.

    A restart with the same ``checkpoint`` folder goes on where the last run ended. Without
    ``interval`` the query takes what is there and stops.
    """
    check_choice("fmt", fmt, FORMATS)
    if fmt == "csv":
        df = with_texts(df, lambda text: readable(text, multi_line=False))
    writer = df.writeStream.format(fmt).outputMode("append")
    if fmt == "csv":
        writer = writer.options(**DELIMITED)
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start(path)
