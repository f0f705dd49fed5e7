"""History of changing attributes: chains of versions, rebuilt only where something changed.

A chain holds the versions of one entity with the snapshots in which each held. Late or
corrected rows touch few entities: only these entities' raw rows are read again, all their
intervals are rebuilt, and their chains take the place of the old ones together.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.functions.norm import section_key, with_same_text
from statloom.runtime import materialize, scratch, slots


def content_hash(*values: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes; nulls differ from empty texts and values can't run into each other."""
    parts = [x for v in values for x in (v.isNull(), v)]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def current_rows(changes: DataFrame, entity: str, step: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The row that counts for an entity in each snapshot: the last in ``order``.

    Partial aggregation comes before the shuffle, so repeated rows of a hot entity don't pile up.
    """
    return changes.groupBy(entity, step).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("__v")).select(entity, step, *(F.col(f"__v.{v}").alias(v) for v in values))


def build_chains(changes: DataFrame, entity: str, step: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(entity, first_<step>, last_<step>, values): longest runs of consecutive equal versions.

    changes: any number of rows per entity and snapshot (``step``, a whole number); the last in
    ``order`` counts. Values are compared null-safely. A snapshot without the entity ends a run.
    """
    now = current_rows(changes, entity, step, order, values)
    by = Window.partitionBy(entity).orderBy(step)
    same = reduce(lambda a, b: a & b, [F.lag(step).over(by) == F.col(step) - 1, *(F.lag(v).over(by).eqNullSafe(F.col(v)) for v in values)])
    runs = now.withColumn("__new", F.when(same, 0).otherwise(1)).withColumn("__run", F.sum("__new").over(by))
    return runs.groupBy(entity, "__run").agg(F.min(step).alias(f"first_{step}"), F.max(step).alias(f"last_{step}"), *(F.first(v).alias(v) for v in values)).drop("__run")


def apply_late_changes(chains: DataFrame, changes: DataFrame, touched: DataFrame, entity: str, step: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Chains after late or corrected rows.

    chains: what was built without them. changes: all raw rows, the late ones included.
    touched: entities with late rows. Their chains are rebuilt from their raw rows alone; all
    others stay as they are. The result is one frame, so that one write replaces them together.
    An entity whose late rows are its first gets a new chain; no touched entity gives ``chains``.
    """
    touched = touched.select(entity).distinct()
    kept = chains.join(touched, entity, "left_anti")
    again = build_chains(changes.join(touched, entity, "left_semi"), entity, step, order, values)
    return kept.unionByName(again)


# --- a stored table of chains, of which only touched parts are written again ----------------------


class ChainStore:
    """Versions of a chain table under one folder; readers see the last committed one.

    Rows lie in ``buckets`` parts by the hash of their entity. A write puts the parts that it changes into a folder of its own name, and then commits a
    small file, named by the version's number, that says which folder holds each part. That file comes to its name whole and only if there is
    none yet: of two writers at once the second fails and what the first wrote stays; a writer that is lost before leaves the old version in
    place. No folder is ever written twice. The file system must refuse to rename onto a file that is there, as HDFS does; object stores don't.
    """

    def __init__(self, spark: SparkSession, path: str, entity: str, buckets: int = 64):
        self.spark, self.path, self.entity, self.buckets = spark, path.rstrip("/"), entity, buckets
        self._jvm = spark.sparkContext._jvm
        self._fs = self._p("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _p(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        return [f.getPath().getName() for f in self._fs.listStatus(self._p(folder))] if self._fs.exists(self._p(folder)) else []

    def _current(self) -> tuple[int, dict | None]:
        v = max((int(x) for x in self._names("_committed") if x.isdigit()), default=0)
        if not v:
            return 0, None
        stream = self._fs.open(self._p(f"_committed/{v}"))
        try:
            return v, json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def version(self) -> int:
        """Number of the current version, 0 if there is none."""
        return self._current()[0]

    def _rows(self, manifest: dict, parts: Sequence[int] | None = None) -> DataFrame:
        kept = [f"{self.path}/data/{folder}/part={k}" for k, folder in manifest["parts"].items() if parts is None or int(k) in parts]
        read = self.spark.read.schema(manifest["schema"])
        return read.parquet(*kept) if kept else self.spark.createDataFrame([], manifest["schema"])

    def read(self) -> DataFrame | None:
        m = self._current()[1]
        return self._rows(m) if m else None

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self.entity), F.lit(self.buckets)).cast("int")

    def _commit(self, version: int, manifest: dict) -> None:
        self._fs.mkdirs(self._p("_committed"))
        mark, own = self._p(f"_committed/{version}"), self._p(f"_pending-{version}-{uuid.uuid4().hex}")
        out = self._fs.create(own, False)
        out.write(bytearray(json.dumps(manifest, sort_keys=True), "utf-8"))
        out.close()
        try:
            if self._fs.getScheme() == "file":
                os.link(own.toUri().getPath(), mark.toUri().getPath())  # a rename would overwrite here
                done = True
            else:
                done = not self._fs.exists(mark) and self._fs.rename(own, mark)
        except FileExistsError:
            done = False
        finally:
            self._fs.delete(own, False)
        if not done:
            raise RuntimeError(f"version {version} was committed by another writer")

    def _write(self, seen: int, old: dict | None, rows: DataFrame, parts: Sequence[int]) -> int:
        """Commits ``rows`` as the whole of ``parts``, over the version ``seen``."""
        folder = uuid.uuid4().hex
        rows.withColumn("part", self._part()).repartition(F.col("part")).write.partitionBy("part").parquet(f"{self.path}/data/{folder}")
        kept = {k: f for k, f in (old["parts"] if old else {}).items() if int(k) not in parts}
        new = {x.removeprefix("part="): folder for x in self._names(f"data/{folder}") if x.startswith("part=")}
        self._commit(seen + 1, {"schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), "parts": kept | new})
        return seen + 1

    def replace(self, chains: DataFrame) -> int:
        """Makes ``chains`` the current version."""
        seen, old = self._current()
        return self._write(seen, None, chains, range(self.buckets))

    def apply_late(self, changes: DataFrame, touched: DataFrame, step: str, order: Sequence[str], values: Sequence[str]) -> int:
        """Rebuilds the touched entities' chains in the parts that hold them, from these entities' raw rows alone; all chains if there is no version yet.

        No touched entity makes no new version.
        """
        seen, old = self._current()
        if old is None:
            return self._write(0, None, build_chains(changes, self.entity, step, order, values), range(self.buckets))
        parts = sorted(r[0] for r in touched.where(F.col(self.entity).isNotNull()).select(self._part()).distinct().collect())  # at most ``buckets``
        if not parts:
            return seen
        return self._write(seen, old, apply_late_changes(self._rows(old, parts), changes, touched, self.entity, step, order, values), parts)


# --- snapshots of the code ---------------------------------------------------------------------


def delivered(snapshots: DataFrame, batches: DataFrame, texts: Sequence[str], others: Sequence[str] = ()) -> DataFrame:
    """Rows of complete batches: section_key, snapshot_no, loaded_at, row_id, next_at, h1, h2.

    Values go on as two 64-bit hashes, of texts in their equal-text form, so no text is shuffled. ``next_at``
    is when the following snapshot was taken. Rows without a usable section number name no section
    and give none.
    """
    good = batches.where("status = 'complete' and snapshot_no is not null").select(F.col("batch_id").alias("__batch"), F.col("snapshot_no").cast("long").alias("__no"), "taken_at")
    good = good.withColumn("__next", F.lead("taken_at").over(Window.orderBy("__no"))).drop("taken_at")  # one row per delivery, never many
    h1, h2 = content_hash(*(F.col(f"__v{i}") for i in range(len(texts) + len(others))))
    rows = snapshots.select("batch_id", section_key(F.col("sectionNumber")).alias("section_key"), "loaded_at", "row_id", *(F.col(c).alias(f"__v{i}") for i, c in enumerate((*texts, *others))))
    rows = with_same_text(rows, [f"__v{i}" for i in range(len(texts))])
    rows = rows.select("batch_id", "section_key", "loaded_at", "row_id", h1.alias("h1"), h2.alias("h2")).where("section_key is not null")
    return rows.join(good, rows["batch_id"] == good["__batch"]).select("section_key", F.col("__no").alias("snapshot_no"), "loaded_at", "row_id", F.col("__next").alias("next_at"), "h1", "h2")


def section_versions(snapshots: DataFrame, batches: DataFrame, deliveries: int = 1) -> DataFrame:
    """(section_key, first_snapshot, last_snapshot) of each version of title, bodyText, isRepealed.

    The chains are first built from the rows that came before the following snapshot was taken, and stored; rows that came later then go through
    the rebuild of the entities they touch, in one or more deliveries by snapshot. Within a batch the latest loaded_at counts, of equal ones the largest row_id.
    """
    spark = snapshots.sparkSession
    raw = materialize(delivered(snapshots, batches, ["title", "bodyText"], ["isRepealed"]), "changes")
    late = F.coalesce(F.col("loaded_at") >= F.col("next_at"), F.lit(False))
    turn = F.when(late, 1 + F.floor(F.col("snapshot_no") * deliveries / (1 + F.lit(batches.agg(F.max("snapshot_no")).first()[0] or 0)))).otherwise(0)
    how = ("snapshot_no", ["loaded_at", "row_id"], ["h1", "h2"])
    store = ChainStore(spark, scratch(spark, "chains"), "section_key", slots(spark, 8))
    store.replace(build_chains(raw.where(~late), "section_key", *how))
    for k in range(1, deliveries + 1):
        store.apply_late(raw.where(turn <= k), raw.where(turn == k), *how)
    return store.read().select("section_key", F.col("first_snapshot_no").alias("first_snapshot"), F.col("last_snapshot_no").alias("last_snapshot"))
