"""Sources: JSON records, manifests, cached pages, ledgers, logs, word lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.operators.corrections import SCHEMA as LEDGER
from statloom.operators.corrections import check_ledger
from statloom.schema import MANIFEST, SECTION


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def optional(spark: SparkSession, path: str, schema: T.StructType | str, read) -> DataFrame:
    """What ``read`` gives, or an empty frame if there is no such file."""
    return read(path) if exists(spark, path) else spark.createDataFrame([], schema)


def json_records(spark: SparkSession, path: str, keep_html: bool = False) -> DataFrame:
    """Section records, one JSON file each; a file that doesn't fit the schema is an error. The raw markup is left out unless asked for."""
    df = spark.read.schema(SECTION).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return df if keep_html else df.drop("bodyHtml")


def json_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("multiLine", True).option("mode", "FAILFAST").json(path)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Entries of a corrections ledger, checked; a missing file is an empty ledger."""

    def read(p: str) -> DataFrame:
        whole = spark.read.schema(f"version int, corrections array<struct<{LEDGER.replace(' ', ':').replace(',:', ',')}>>").option("multiLine", True).json(p)
        return check_ledger(whole.select(F.explode("corrections").alias("c")).select("c.*"))

    return optional(spark, path, LEDGER, read)


def cached_pages(spark: SparkSession, path: str, jobs: DataFrame | None = None) -> DataFrame:
    """(filename, html) of pages under ``path``; with jobs, one row per job, html null where the cache has no page (those are to be fetched)."""
    pages = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("filename"), F.col("value").alias("html"))
    pages = pages.withColumn("filename", F.url_decode(F.replace("filename", F.lit("+"), F.lit("%2B"))))
    return pages if jobs is None else jobs.join(pages, "filename", "left")


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """(word, length) of a list with one word per line."""
    return spark.read.text(path).where("value <> ''").select(F.col("value").alias("word"), F.length("value").alias("length"))


def log_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(domain, name, day, length) of archived logs <domain>/<name>.log-<day>; only names and sizes are read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).select("path", "length")
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    return df.select(F.element_at(parts, -2).alias("domain"), name.alias("name"), F.regexp_extract(name, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1).alias("day"), "length").where("day <> ''")


def log_summary(files: DataFrame) -> DataFrame:
    """Days, first and last day and bytes of each domain."""
    return files.groupBy("domain").agg(F.count_distinct("day").alias("days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("length").alias("bytes"))
