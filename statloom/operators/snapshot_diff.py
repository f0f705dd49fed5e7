"""What changed between full snapshots, by content-defined chunks of the key-sorted rows.

Rows of all snapshots are range-partitioned and sorted by key together. A chunk ends before
each key whose hash is divisible by ``span``: where it ends depends on the key alone, so rows added or
removed elsewhere shift no chunk. Chunks whose digests match in neighbouring snapshots are
discarded; only the rows of the others are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.operators.history_chains import current_rows, delivered
from statloom.runtime import materialize, slots


def with_chunks(rows: DataFrame, key: str, span: int = 32) -> DataFrame:
    """Adds ``chunk``: the last chunk-opening key at or before the row's in its range of keys.

    Rows of a range that come before its first opening key share the chunk named by the range's
    number. All snapshots share the ranges, so chunks of equal name hold the same range of keys.
    """
    sized = rows.withColumn("__opens", F.pmod(F.xxhash64(key), F.lit(span)) == 0)
    placed = sized.repartitionByRange(slots(rows.sparkSession), key).sortWithinPartitions(key)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        open_ = f"\x00{TaskContext.get().partitionId()}"
        for b in batches:
            out = []
            for k, o in zip(b.column(key).to_pylist(), b.column("__opens").to_pylist(), strict=True):
                if o:
                    open_ = k
                out.append(open_)
            cols = [c for c in b.schema.names if c != "__opens"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in cols), pa.array(out, pa.string())], [*cols, "chunk"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", chunk string"
    return placed.mapInArrow(name, schema)


def diff_snapshots(rows: DataFrame, key: str, step: str, digests: tuple[str, str], span: int = 32) -> DataFrame:
    """(key, step, change_kind): added, removed or changed against the snapshot before.

    rows: one row per key and snapshot (``step``, a whole number), with two 64-bit hashes of the content. The
    first snapshot is compared with nothing; a snapshot without rows counts as not delivered, and
    the one after it has no neighbour. Equal keys with equal hashes are unchanged. An empty table
    gives no row.
    """
    a, b = digests
    chunked = materialize(with_chunks(rows.select(key, step, a, b), key, span), "chunked")
    row = F.xxhash64(key, a, b)
    sums = chunked.groupBy("chunk", step).agg(F.count(F.lit(1)).alias("__n"), F.bit_xor(row).alias("__x"), F.bit_xor(F.xxhash64(F.lit(1), key, b, a)).alias("__y"))
    old = sums.select("chunk", (F.col(step) + 1).alias(step), F.col("__n").alias("__m"), F.col("__x").alias("__u"), F.col("__y").alias("__w"))
    steps = sums.groupBy(step).agg(F.lit(1).alias("__there"))
    both = steps.select(step).join(steps.select((F.col(step) + 1).alias(step)), step, "left_semi")  # snapshots with a neighbour before
    open_ = old.join(sums, ["chunk", step], "full").where(~(F.col("__n").eqNullSafe(F.col("__m")) & F.col("__x").eqNullSafe(F.col("__u")) & F.col("__y").eqNullSafe(F.col("__w")))).select("chunk", step)
    open_ = open_.join(both, step, "left_semi")
    new = chunked.join(open_, ["chunk", step], "left_semi").select(key, step, F.col(a).alias("__a"), F.col(b).alias("__b"))
    before = chunked.withColumn(step, F.col(step) + 1).join(open_, ["chunk", step], "left_semi").select(key, step, F.col(a).alias("__c"), F.col(b).alias("__d"))
    kind = F.when(F.col("__c").isNull(), "added").when(F.col("__a").isNull(), "removed").when((F.col("__a") != F.col("__c")) | (F.col("__b") != F.col("__d")), "changed")
    return new.join(before, [key, step], "full").select(key, step, kind.alias("change_kind")).where("change_kind is not null")


def section_changes(snapshots: DataFrame, batches: DataFrame) -> DataFrame:
    """(section_key, snapshot_no, change_kind) of bodyText and history between complete batches."""
    rows = delivered(snapshots, batches, ["bodyText", "history"])
    now = materialize(current_rows(rows, "section_key", "snapshot_no", ["loaded_at", "row_id"], ["h1", "h2"]), "snapshots")
    return diff_snapshots(now, "section_key", "snapshot_no", ("h1", "h2"))
