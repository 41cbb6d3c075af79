"""Parquet tables of a data folder."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.session import file_system
from tabularium.sources.bitmaps import bitmap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table; only the columns used later are read (parquet column pruning)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


SMALL_FILE = 8 << 20


def spread(df: DataFrame) -> DataFrame:
    """df over as many partitions as there are cores, if it is a few small files.

    For work that costs far more than moving its rows; any other input is
    split by the reader and left as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    files = df.inputFiles()
    if len(files) >= cores:
        return df
    opened = [file_system(df.sparkSession, f) for f in files]
    return df.repartition(cores) if sum(fs.getFileStatus(p).getLen() for fs, p in opened) < SMALL_FILE * cores else df


def once_per_key(df: DataFrame, key: str, payload: list[str], latest: str | None = None, wide: bool = False) -> DataFrame:
    """One row per key of rows that were delivered again.

    Takes the row with the latest `latest`, ties by the greatest payload, so
    the result does not depend on order. Aggregates map-side before the
    shuffle, so a hot key reaches its reducer as one row per task. A null key
    is a key of its own; nulls in `latest` sort first.

    `wide` is for a payload that is costly to move, such as texts: repeated
    keys are counted on the key column alone, and only rows whose key may be
    among them (by a bitmap of bounded size) are aggregated and moved.
    """
    if not wide:
        return _aggregated(df, key, payload, latest)
    again = bitmap(df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(F.xxhash64(key).alias("h")))
    if again.empty:
        return df.select(key, *payload)
    sent = df.sparkSession.sparkContext.broadcast(again)

    def may_repeat(h: pa.Array) -> pa.Array:
        return pa.array(sent.value.has(h.to_numpy()))

    hit = F.arrow_udf(may_repeat, "boolean")(F.xxhash64(key))
    return df.where(~hit).select(key, *payload).unionByName(_aggregated(df.where(hit), key, payload, latest))


def _aggregated(df: DataFrame, key: str, payload: list[str], latest: str | None) -> DataFrame:
    row = F.struct(*([latest] if latest else []), *payload)
    return df.groupBy(key).agg(F.max(row).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in payload])
