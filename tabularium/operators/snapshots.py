"""Changes between consecutive full snapshots of a table.

Method: the snapshots are kept range-partitioned and sorted by key: one folder
per snapshot and range, the ranges' bounds kept with them, so that a new
snapshot is settled and written once and the others are never touched again.
Two consecutive snapshots are compared range by range: a reader of its own
opens the two sorted files of a range and streams a two-pointer merge over
them, without a shuffle and without holding a range in memory.
"""

from __future__ import annotations

import os
import re
import uuid
from urllib.parse import unquote

import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tabularium.session import file_system, shared_dir

SAMPLED_KEYS = 10_000  # about as many keys, chosen by hash, set the ranges' bounds; every row is placed by them

# The snapshot calendar is read once and broadcast up to this many dates; beyond it a shuffled join is used.
CALENDAR_BROADCAST_ROWS = 20_000


def settle(df: DataFrame, key: str, snapshot: str, loaded: str, values: list[str]) -> DataFrame:
    """One row per (snapshot, key): the latest `loaded` holds.

    Rows delivered twice collapse; of corrected rows the latest wins, ties by
    the greatest values; a null `loaded` loses to any other. Rows without a
    snapshot or without a key belong to no snapshot and are left out.
    Aggregated map-side, so a key with a third of all rows shuffles one row
    per task and snapshot.
    """
    row = F.struct(loaded, *values)
    return (
        df.where(F.col(key).isNotNull() & F.col(snapshot).isNotNull())
        .groupBy(key, snapshot)
        .agg(F.max(row).alias("_r"))
        .select(key, snapshot, *[F.col(f"_r.{v}").alias(v) for v in values])
    )


def calendar(df: DataFrame, snapshot: str) -> DataFrame:
    """The distinct snapshot dates, numbered from 0, each with the next one (null for the last).

    The table is one row per snapshot date. Numbering needs one task; its
    input is already distinct.
    """
    w = Window.orderBy(snapshot)
    return (
        df.select(snapshot)
        .where(F.col(snapshot).isNotNull())
        .distinct()
        .select(snapshot, (F.row_number().over(w) - 1).cast("int").alias("_i"), F.lead(snapshot).over(w).alias("_next"))
    )


class Calendar:
    """calendar() computed once, for any number of joins: local rows if they are few, else the plan itself."""

    def __init__(self, df: DataFrame, snapshot: str):
        self.dates, self.snapshot = calendar(df, snapshot), snapshot
        rows = self.dates.limit(CALENDAR_BROADCAST_ROWS + 1).collect()
        self.small = len(rows) <= CALENDAR_BROADCAST_ROWS
        self.length = len(rows) if self.small else self.dates.count()
        if self.small:
            self.dates = df.sparkSession.createDataFrame(rows, self.dates.schema)

    def join(self, df: DataFrame, named: DataFrame | None = None, on: str | None = None, how: str = "inner") -> DataFrame:
        """df with the calendar, or with columns of it, joined on."""
        side = self.dates if named is None else named
        return df.join(F.broadcast(side) if self.small else side, on or self.snapshot, how)


def numeric_text(c: Column) -> Column:
    """A number kept as text, by its value: '048', '48 ' and 'No. 48' are 48; no digits or null is null."""
    digits = F.regexp_extract(c, r"(\d+)", 1)
    return F.when(digits != "", digits.cast("decimal(38,0)"))


def keep_snapshots(df: DataFrame, root: str, key: str, snapshot: str, loaded: str, compare: dict[str, Column], ranges: int | None = None) -> None:
    """Settle the snapshots of df and add them to those kept in `root`; a snapshot that is there already is replaced.

    Keys and compared values are kept as text. Bounds are set by the first
    call and stay; they only decide how even the ranges are.
    """
    spark = df.sparkSession
    src = df.select(F.col(key).cast("string").alias("_key"), F.col(snapshot).alias("_snap"), F.col(loaded).alias("_loaded"), *[c.cast("string").alias(f"_v{i}") for i, c in enumerate(compare.values())])
    settled = settle(src, "_key", "_snap", "_loaded", [f"_v{i}" for i in range(len(compare))])
    fs, at = file_system(spark, f"{root}/bounds")
    if not fs.exists(at):
        n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
        _bounds(src.select("_key"), n).coalesce(1).write.parquet(f"{root}/bounds")
    bounds = [r["_key"] for r in spark.read.schema("_key string").parquet(f"{root}/bounds").collect()]
    place = F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<string>"), lambda b: b <= F.col("_key"))) if bounds else F.lit(0)
    # the writer asks for the order of its folders first; any other order would be sorted again, and the keys' lost
    placed = settled.withColumn("_range", place).repartitionById(len(bounds) + 1, "_range").sortWithinPartitions("_snap", "_range", "_key")
    placed.write.partitionBy("_snap", "_range").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{root}/rows")


def _bounds(keys: DataFrame, ranges: int) -> DataFrame:
    """(_key): at most ranges - 1 keys that part the distinct keys about evenly; they are the same whatever the partitions."""
    known = keys.where("_key IS NOT NULL").distinct()
    every = max(1, known.count() // SAMPLED_KEYS)
    some = known.where(F.pmod(F.xxhash64("_key"), F.lit(every)) == 0)
    placed = some.withColumn("_n", F.row_number().over(Window.orderBy("_key")) - 1).withColumn("_of", F.count("*").over(Window.partitionBy()))
    part = lambda n: F.floor(n * ranges / F.col("_of"))
    return placed.where((F.col("_n") > 0) & (part(F.col("_n")) > part(F.col("_n") - 1))).select("_key")


class _Range(InputPartition):
    """One range: (older folder, newer folder, later date) of every two consecutive snapshots; a folder is None where a snapshot has no key in the range."""

    def __init__(self, pairs: list[tuple[str | None, str | None, str]]):
        super().__init__(len(pairs))
        self.pairs = pairs


def _opened(path: str):
    """(file system, path in it) for whatever the shared folder is."""
    return pyarrow.fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:/", path) else (pyarrow.fs.LocalFileSystem(), path)


def _rows(folder: str | None):
    """(key, values) of a range of a snapshot in order of the key; batch by batch."""
    if folder is None:
        return
    fs, path = _opened(folder)
    names = sorted(i.path for i in fs.get_file_info(pyarrow.fs.FileSelector(path)) if i.path.endswith(".parquet"))
    last = None
    for name in names:
        with fs.open_input_file(name) as f:
            for b in pyarrow.parquet.ParquetFile(f).iter_batches():
                keys = b.column(b.schema.get_field_index("_key")).to_pylist()
                values = [b.column(i).to_pylist() for i, c in enumerate(b.schema.names) if c.startswith("_v")]
                # Python's order of texts, by code points, is that of their UTF-8 bytes, by which Spark sorts
                if (last is not None and keys and keys[0] <= last) or any(x >= y for x, y in zip(keys, keys[1:])):
                    raise ValueError(f"a kept range is out of order: {name}")
                last = keys[-1] if keys else last
                yield from zip(keys, zip(*values) if values else [()] * len(keys))


class _Merge(DataSourceReader):
    def __init__(self, root: str):
        self.root = root

    def partitions(self):
        fs, path = _opened(f"{self.root}/rows")
        if fs.get_file_info(path).type == pyarrow.fs.FileType.NotFound:
            return [_Range([])]
        found: dict[str, dict[str, str]] = {}
        whole = f"{self.root}/rows"
        scheme = whole[: -len(path)] if whole.endswith(path) and whole != path else ""
        for s in fs.get_file_info(pyarrow.fs.FileSelector(path)):
            if s.type == pyarrow.fs.FileType.Directory and os.path.basename(s.path).startswith("_snap="):
                ranges = fs.get_file_info(pyarrow.fs.FileSelector(s.path))
                found[unquote(os.path.basename(s.path)[6:])] = {os.path.basename(r.path): scheme + r.path for r in ranges if os.path.basename(r.path).startswith("_range=")}
        days = sorted(found)
        ranges = sorted({r for f in found.values() for r in f})
        return [_Range([(found[a].get(r), found[b].get(r), b) for a, b in zip(days, days[1:])]) for r in ranges] or [_Range([])]

    def read(self, partition):
        for before, after, later in partition.pairs:
            old, new = _rows(before), _rows(after)
            a, b = next(old, None), next(new, None)
            while a is not None or b is not None:
                if b is None or (a is not None and a[0] < b[0]):
                    yield a[0], later, "removed"
                    a = next(old, None)
                elif a is None or b[0] < a[0]:
                    yield b[0], later, "added"
                    b = next(new, None)
                else:
                    if a[1] != b[1]:
                        yield a[0], later, "changed"
                    a, b = next(old, None), next(new, None)


class SnapshotMerge(DataSource):
    """Through kept_changes(): a partition per range, in which every two consecutive snapshots are compared by a two-pointer merge."""

    @classmethod
    def name(cls):
        return "snapshot_merge"

    def schema(self):
        return "k string, at string, change string"

    def reader(self, schema):
        return _Merge(self.options["root"])


def kept_changes(spark: SparkSession, root: str) -> DataFrame:
    """(k, at, change) between each two consecutive snapshots kept in `root`, which all machines see; keys and dates as text."""
    spark.dataSource.register(SnapshotMerge)
    return spark.read.format("snapshot_merge").option("root", root).load()


def snapshot_changes(df: DataFrame, key: str, snapshot: str, loaded: str, compare: dict[str, Column], root: str | None = None, ranges: int | None = None) -> DataFrame:
    """Typed changes (key, snapshot, change) between each two consecutive snapshots, of df and of those kept in `root` before.

    `compare` names the compared expressions over df's columns; null equals
    null, null against a value differs. `change` is added, removed or changed
    and `snapshot` is the later date. The first snapshot yields nothing; an
    empty table yields an empty result; extra columns are ignored. Without a
    root the snapshots are kept in a new folder of the shared one.
    """
    spark = df.sparkSession
    where = root or f"{shared_dir(spark).rstrip('/')}/snapshots-{uuid.uuid4().hex}"
    keep_snapshots(df, where, key, snapshot, loaded, compare, ranges)
    types = {f.name: f.dataType for f in df.schema}
    return kept_changes(spark, where).select(F.col("k").cast(types[key]).alias(key), F.col("at").cast(types[snapshot]).alias(snapshot), "change")
