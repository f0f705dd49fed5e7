"""Resumable ingest: new files are taken once, whatever is run again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statloom.schema import SECTION


def page_stream(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """(filename, html, seen_at) of pages as they arrive under ``path``."""
    pages = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", per_trigger).load(path)
    return pages.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("filename"), F.col("value").alias("html"), F.current_timestamp().alias("seen_at"))


def record_stream(spark: SparkSession, path: str) -> DataFrame:
    """Section records as their JSON files arrive."""
    return spark.readStream.schema(SECTION).option("multiLine", True).json(path)


def ingest(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends what is there now and ends; the checkpoint remembers what was taken, so the next run takes only the rest."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def archive_once(spark: SparkSession, source: str, out: str, checkpoint: str) -> StreamingQuery:
    """Dated logs into compressed text, each once; a file that is still written to is left alone."""
    from statloom.functions.text import is_rotated_log

    logs = spark.readStream.format("text").option("recursiveFileLookup", True).load(source).select(F.input_file_name().alias("path"), "value").where(is_rotated_log(F.col("path")))
    day = F.regexp_extract("path", r"([0-9]{4}-?[0-9]{2}-?[0-9]{2})", 1)
    return logs.select(day.alias("day"), "value").writeStream.format("text").option("path", out).option("checkpointLocation", checkpoint).option("compression", "gzip").partitionBy("day").outputMode("append").trigger(availableNow=True).start()
