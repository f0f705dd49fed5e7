"""Sinks: canonical JSON, word lists, site maps, conditional and owned writes."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.identity import natural_key
from statloom.functions.text import escape_html
from statloom.operators.inventory import changed_rows
from statloom.runtime import materialize
from statloom.schema import DDL, SECTION_FIELDS


def canonical_columns(df: DataFrame, order: list[str] | None = None) -> list[str]:
    """Declared columns in their order, then all others as they come."""
    first = [c for c in (order or SECTION_FIELDS) if c in df.columns]
    return [*first, *(c for c in df.columns if c not in first)]


def canonical_json(df: DataFrame, order: list[str] | None = None) -> Column:
    """One compact JSON text per row, keys in canonical order, nulls written."""
    return F.to_json(F.struct(*canonical_columns(df, order)), {"ignoreNullFields": "false"})


def pretty_json(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """(key, json): indented JSON with a line end, byte for byte the same for the same record."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [json.dumps(json.loads(t), ensure_ascii=False, indent=2) + "\n" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], [key, "json"])

    return df.select(key, canonical_json(df, order).alias("json")).mapInArrow(run, f"`{key}` {kind}, json string")


def chapter_map(records: DataFrame) -> DataFrame:
    """(chapter, json) in natural order, empty fields left out."""
    notes = F.nullif(F.col("notes"), F.lit("")).alias("notes")
    annotations = F.when(F.size("annotations") > 0, F.col("annotations")).alias("annotations")
    return records.select("chapter", F.to_json(F.struct("title", "volume", notes, annotations)).alias("json")).orderBy(natural_key(F.col("chapter"), 6), "chapter")


def write_words(vocab: DataFrame, path: str) -> None:
    """One word per line in binary order, one file: a list that browsers load whole."""
    vocab.select("word").orderBy("word").coalesce(1).write.mode("overwrite").text(path)


def sitemap_line(site: str, path: Column) -> Column:
    return F.concat(F.lit("  <url><loc>"), escape_html(F.concat(F.lit(site.rstrip("/")), path)), F.lit("</loc></url>"))


def sitemap(site: str, pages: DataFrame, path: str = "path") -> DataFrame:
    """(path, line) of a site map in order of paths, addresses absolute and escaped."""
    return pages.select(path, sitemap_line(site, F.col(path)).alias("line")).orderBy(path)


MOST_ADDRESSES = 50_000  # of one map, by the standard of site maps
_XML = '<?xml version="1.0" encoding="UTF-8"?>\n<{0} xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n{1}\n</{0}>\n'


def sitemap_files(site: str, pages: DataFrame, path: str = "path", most: int = MOST_ADDRESSES) -> DataFrame:
    """(name, xml) of the maps of a site, each of ``most`` addresses at most, in order of paths, and of the index that names them.

    A site that fits into one map has just sitemap.xml; else that is the index, and the maps are sitemap-<range>-<n>.xml.
    """
    lines = pages.select(F.col(path).alias("path")).where("path is not null").distinct()
    n = lines.count()
    ranges = max(1, -(-n // most))

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own: list[str] = []
        k, task = 0, TaskContext.get().partitionId()

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"sitemap-{task}-{k}.xml"]), pa.array([_XML.format("urlset", "\n".join(own))])], ["name", "xml"])

        for b in batches:
            for line in b.column(0).to_pylist():
                own.append(line)
                if len(own) == most:
                    yield full()
                    own, k = [], k + 1
        if own:
            yield full()

    sorted_ = lines.repartitionByRange(ranges, "path").sortWithinPartitions("path")
    made = sorted_.select(sitemap_line(site, F.col("path")).alias("line")).mapInArrow(maps, "name string, xml string")
    if ranges == 1:
        return made.select(F.lit("sitemap.xml").alias("name"), "xml")
    made = materialize(made, "maps")
    names = made.agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit(f"  <sitemap><loc>{site.rstrip('/')}/"), "name", F.lit("</loc></sitemap>")))), "\n").alias("t"))  # one for 50,000 addresses
    head, foot = _XML.format("sitemapindex", "\0").split("\0")
    return made.unionByName(names.select(F.lit("sitemap.xml").alias("name"), F.concat(F.lit(head), "t", F.lit(foot)).alias("xml")))


def robots(site: str | None = None, barred: tuple[str, ...] = ("/search",)) -> str:
    lines = ["User-agent: *", *(f"Disallow: {p}" for p in barred)]
    return "\n".join(lines + (["", f"Sitemap: {site}/sitemap.xml"] if site else [])) + "\n"


def write_changed(new: DataFrame, path: str, key: str, dry_run: bool = False) -> DataFrame:
    """Writes rows that are new or differ from what is stored under ``path``; returns counts by state.

    Stored rows are partitioned by the hash of their key: only partitions with a change are written again.
    """
    spark = new.sparkSession
    from statloom.sources.readers import exists

    cols = [c for c in new.columns]
    parted = new.withColumn("part", F.pmod(F.xxhash64(key), F.lit(64)).cast("int"))
    digest = F.xxhash64(*cols)
    if not exists(spark, path):
        if not dry_run:
            parted.write.partitionBy("part").parquet(path)
        return new.groupBy(F.lit("created").alias("state")).agg(F.count(F.lit(1)).alias("n"))
    stored = spark.read.parquet(path)
    states = materialize(changed_rows(parted, stored, key, digest), "states")
    touched = parted.join(states.where("state <> 'unchanged'").select(key), key, "left_semi").select("part").distinct()
    kept = stored.join(new.select(key), key, "left_anti").join(touched, "part", "left_semi")
    again = materialize(kept.unionByName(parted.join(touched, "part", "left_semi").select(kept.columns)), "again")
    if not dry_run:
        again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    return states.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def migrate(spark: SparkSession, database: str = "default") -> list[str]:
    """Creates the side tables that don't exist yet; may be run any number of times."""
    for name, columns in DDL.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")
    return sorted(DDL)


def hierarchy_json(divisions: DataFrame, titles: DataFrame) -> DataFrame:
    """One row: divisions and titles in order as one JSON text; empty fields left out."""
    d = divisions.agg(F.sort_array(F.collect_list(F.struct("number", "name"))).alias("divisions"))
    t = titles.agg(F.transform(F.sort_array(F.collect_list(F.struct(natural_key(F.col("number"), 6).alias("k"), F.struct(*titles.columns).alias("t")))), lambda x: x["t"]).alias("titles"))
    return d.withColumn("one", F.lit(1)).join(t.withColumn("one", F.lit(1)), "one").select(F.to_json(F.struct("divisions", "titles")).alias("json"))


def write_pages(pages: DataFrame, root: str, owned: Sequence[str] = ()) -> DataFrame:
    """Writes each page (path, html) as ``path``/index.html under ``root``, a folder that all executors share; returns (path, bytes) of what was written.

    A path that ends in a file's name (one with a dot) is that file. owned: folders below ``root`` that a full build owns; what is in them goes first, and a
    part of a build names none. A page that is written again by a task's second try is the same file.
    """
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
    for folder in owned:
        store.delete_dir_contents(f"{base}/{folder.strip('/')}", missing_dir_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, top = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        for b in batches:
            sizes = []
            for path, html in zip(b.column("path").to_pylist(), b.column("html").to_pylist(), strict=True):
                parts = [p for p in path.split("/") if p]
                if ".." in parts:
                    raise ValueError(f"{path} leaves the folder")
                name = "/".join(parts) if parts and "." in parts[-1] else "/".join([*parts, "index.html"])
                own.create_dir(f"{top}/{name}".rpartition("/")[0], recursive=True)
                data = (html or "").encode("utf-8", "surrogatepass")
                with own.open_output_stream(f"{top}/{name}") as out:
                    out.write(data)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(sizes, pa.int64())], ["path", "bytes"])

    return materialize(pages.select("path", "html").where("path is not null").mapInArrow(run, "path string, bytes long"), "written")
