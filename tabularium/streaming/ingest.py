"""Structured Streaming counterparts: the same transforms over files that keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabularium import schemas
from tabularium.operators.numbers import number_records


def stream_table(spark: SparkSession, folder: str, schema, files_per_trigger: int = 16) -> DataFrame:
    """A growing folder of parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def fresh_rows(stream: DataFrame, key: str, time: str, lateness: str = "60 days") -> DataFrame:
    """Rows counted once although they are delivered again: state is kept for `lateness` behind the latest time."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, by: str, window: str, lateness: str) -> DataFrame:
    """(start, by, n): rows per tumbling window; in append or update mode a row later than `lateness` is left out and old state is dropped."""
    w = F.window(time, window)
    return stream.withWatermark(time, lateness).groupBy(w.alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def number_stream(sections: DataFrame) -> DataFrame:
    """number_records is stateless, so it runs on a stream as it stands."""
    return number_records(sections)


def publish_batches(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch in a folder of its own, rewritten as a whole if it is replayed: every row lands exactly once."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def publish_updates(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """An aggregation in update mode: each micro-batch leaves the groups it changed; latest_updates() reads them."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Every group as the last micro-batch that changed it left it."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return last.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


SECTION_SCHEMA = schemas.SECTIONS + ", loaded_at timestamp"
