"""Apply a fitted preprocessing run to a stream of new rows."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tabulon.plans.preprocess import Transform


def transform_stream(rows: DataFrame, fitted: Transform, path: str, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    """Write the transformed rows of a streaming frame to Parquet.

    The transform is stateless, so a restart from the checkpoint repeats no row and keeps no state.
    """
    writer = (fitted.apply(rows).writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
