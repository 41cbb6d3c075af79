"""Session settings and the shared folder that cut lineage is written to."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "tabularium", cores: int | None = None) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    n = cores or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.

    Where it is unset a local session gets a temporary one; a cluster must
    name a folder that all its machines share.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        set_already = sc._jsc.sc().getCheckpointDir()
        if set_already.isDefined():
            return set_already.get()
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        named = tempfile.mkdtemp(prefix="tabularium-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", named)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(named)
    return named


def materialise(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Cut lineage: write to the shared folder as a table and read it back.

    A written table survives the loss of any executor, is columnar, and gives
    the planner true sizes for what follows. discard() deletes it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the JVM for a path: local or whatever the cluster shares."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def discard(table: DataFrame) -> None:
    """Delete a table that materialise() wrote, once nothing reads it any more."""
    path = getattr(table, "_written_to", None)
    if path:
        fs, p = file_system(table.sparkSession, path)
        fs.delete(p, True)
