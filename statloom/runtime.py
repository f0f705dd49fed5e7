"""Session helpers: scratch tables in the shared folder, table loading."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only in local mode, where there is one machine, a folder of our own stands in for it; a cluster that names none is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not _one_machine(spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if "own" not in _made:
        own = tempfile.mkdtemp(prefix="statloom-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        _made["own"] = f"file://{own}"
    return _made["own"]


def _one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def _scratch_root(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _made:
        _made[app] = f"{shared_dir(spark).rstrip('/')}/statloom-{app}-{uuid.uuid4().hex[:8]}"
        jvm, path = spark.sparkContext._jvm, _made[app]
        conf = spark.sparkContext._jsc.hadoopConfiguration()

        def clean() -> None:
            try:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(conf).delete(p, True)
            except Exception:
                pass

        atexit.register(clean)
    return _made[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder, deleted with the scratch tables."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str = "t") -> DataFrame:
    """Write ``df`` as a compressed table in the shared folder and read it back.

    The lineage ends there, so a lost executor costs no recomputation of what came before,
    and later stages read only the columns they use.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete all scratch tables that this session has made so far; for use between jobs, when no result is read any more."""
    root = _made.pop(spark.sparkContext.applicationId, None)
    if root:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(df: DataFrame) -> None:
    """Delete the scratch table behind a frame that ``materialize`` returned."""
    spark = df.sparkSession
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for f in {os.path.dirname(x) for x in df.inputFiles()}:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        p.getFileSystem(conf).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def slots(spark: SparkSession, least: int = 1) -> int:
    """Shuffle partitions that the session asks for; the unit for explicit repartitioning."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
