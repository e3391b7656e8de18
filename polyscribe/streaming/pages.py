"""Incremental ingest: new page files of a folder become word rows as they arrive (an extra over batch reading)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from polyscribe.sources.hocr import parse_words

BINARY = "path string, modificationTime timestamp, length long, content binary"


def stream_words(spark: SparkSession, path: str, pattern: str = "*.html", files_a_trigger: int = 1000, strict: bool = False) -> DataFrame:
    """Word rows of page files, each file once."""
    files = spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_a_trigger).load(path)
    page = F.regexp_replace(F.regexp_replace(F.regexp_extract("path", r"([^/]+)$", 1), "^output-", ""), r"\.[^.]*$", "")
    return parse_words(files.select(page.alias("page_id"), F.decode("content", "UTF-8").alias("markup")), strict)


def ingest(words: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append a stream's word rows to a Parquet table, exactly once, and stop when no file is left."""
    return words.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()
