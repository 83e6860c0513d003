"""Session helpers that the operators share: work folders, tables, sizes."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a document batch that a Python worker handles at once.
BATCH_BYTES = 2 << 20


def work_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only if none is named and all runs in one process (tests)."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="statuta-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *tables: DataFrame | str) -> None:
    """Delete intermediate tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for t in tables:
        roots = [t] if isinstance(t, str) else {f.rpartition("/")[0] for f in t.inputFiles()}
        for root in roots:
            path = jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(conf).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished phases."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def scan_tasks(df: DataFrame, rows_each: int, most: int = 100_000) -> int:
    """Partitions for ``df`` at ``rows_each`` rows, by a count that reads no column."""
    return max(1, min(most, -(-df.count() // rows_each)))


def row_key(*cols: Column) -> Column:
    """64-bit key of a row's columns; null columns are skipped."""
    return F.xxhash64(*cols)
