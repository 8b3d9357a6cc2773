"""Decks as they arrive: a file stream of presentations, each rendered by itself, without state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from leafwork import convert
from leafwork.runtime import released
from leafwork.sources import pptx


def files(spark: SparkSession, folder: str, at_a_time: int = 100) -> DataFrame:
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.pptx").option("maxFilesPerTrigger", at_a_time).load(folder)


def render_incoming(spark: SparkSession, folder: str, out: str, checkpoint: str, *, available_now: bool = True, at_a_time: int = 100) -> StreamingQuery:
    """Renders new decks to rows of (path, xml) appended below ``out``; each file once, also after a restart.

    What a batch writes on its way is deleted at its end, so a stream that never stops fills no disk.
    """

    def batch(df: DataFrame, number: int) -> None:
        with released():
            shapes = pptx.shapes(df.select("path", "content"))
            convert.deck_xml(shapes).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = files(spark, folder, at_a_time).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (query.trigger(availableNow=True) if available_now else query).start()
