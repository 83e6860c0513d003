"""Conversion as a stream: new sections are converted as they arrive, restarts go on where the log ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.convert import run_conversion
from ..sources.transport import Transport

SECTION_SCHEMA = "doc_id long, ord int, num string, heading string, content string"


def stream_conversion(spark: SparkSession, source: str, log: str, checkpoint: str, transport: Transport, model: str, document: str = "Legislative Document"):
    """Convert all Parquet sections under ``source`` and stop; a later call converts only what is new or failed before."""

    def batch(df: DataFrame, _: int) -> None:
        run_conversion(df, transport, model, log, document)

    stream = spark.readStream.schema(SECTION_SCHEMA).parquet(source)
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
