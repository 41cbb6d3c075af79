"""Publication: complete versions behind a pointer, atomic files, one writer at a time.

A version is written to a folder of its own, read again and checked, and only
then named by `_CURRENT`, in one rename. What failed leaves the last version
in force. This replaces rollback journals: nothing published is ever edited.
Files go through Hadoop's file systems, so a root may be a local folder or a
store that a whole cluster shares.
"""

from __future__ import annotations

import contextlib
import json
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabularium.operators.relational import GateError
from tabularium.session import file_system

POINTER = "_CURRENT"
LOCK = ".publish.lock"


class RollbackError(GateError):
    """A failed version could not be removed; the lock stays until someone has looked."""


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def write_atomic(spark: SparkSession, path: str, text: str) -> None:
    """The file is the old one or the new one, never a part."""
    fs, target = file_system(spark, path)
    jvm = spark._jvm
    temporary = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    try:
        out = fs.create(temporary, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
            out.hsync()
        finally:
            out.close()
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(temporary), fs.makeQualified(target), how)
    finally:
        if fs.exists(temporary):
            fs.delete(temporary, False)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    source = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def canonical_json(value) -> str:
    """Sorted keys, two blanks, a final line end: equal values give equal bytes."""
    return json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n"


@contextlib.contextmanager
def writer_lock(spark: SparkSession, root: str, timeout: float = 30.0, retry: float = 0.05):
    """Exclusive among writers; a lock that stays, however old, fails closed after `timeout` seconds.

    It is released however the work ends, but for a RollbackError.
    """
    fs, path = file_system(spark, _join(root, LOCK))
    deadline = time.monotonic() + timeout
    while not fs.createNewFile(path):
        if time.monotonic() >= deadline:
            raise GateError("another writer holds the lock")
        time.sleep(retry)
    try:
        yield
    except RollbackError:
        raise
    except BaseException:
        fs.delete(path, False)
        raise
    else:
        fs.delete(path, False)


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the version in force."""
    named = read_text(spark, _join(root, POINTER))
    if named is None:
        return None
    if not re.fullmatch(r"v-[0-9a-f]{32}", named.strip()):
        raise GateError("invalid pointer")
    return _join(root, named.strip())


def publish(
    spark: SparkSession, root: str, tables: dict[str, DataFrame], verify: Callable[[dict[str, DataFrame]], DataFrame] | None = None, texts: dict[str, str] | None = None
) -> str:
    """Write the tables as one version, verify what was written, then put it in force; returns its folder.

    `verify` gets the tables as read back and returns (label, ok, detail);
    any label that is not ok raises GateError with the labels, the version is
    removed and the last one stays in force. If it cannot be removed either,
    RollbackError is raised and the lock stays.
    """
    fs, top = file_system(spark, root)
    fs.mkdirs(top)
    with writer_lock(spark, root):
        name = f"v-{uuid.uuid4().hex}"
        folder = _join(root, name)
        try:
            for t, df in tables.items():
                df.write.option("compression", "zstd").parquet(_join(folder, t))
            for t, text in (texts or {}).items():
                write_atomic(spark, _join(folder, t), text)
            if verify:
                again = {t: spark.read.parquet(_join(folder, t)) for t in tables}
                failed = [r["label"] for r in verify(again).where("NOT ok").collect()]
                if failed:
                    raise GateError(f"failed: {sorted(failed)}")
        except BaseException as why:
            _remove(spark, folder, why)
            raise
        write_atomic(spark, _join(root, POINTER), name + "\n")
        return folder


def _remove(spark: SparkSession, folder: str, why: BaseException) -> None:
    try:
        fs, p = file_system(spark, folder)
        gone = not fs.exists(p) or fs.delete(p, True)
    except Exception as e:
        raise RollbackError("a failed version could not be removed") from e
    if not gone:
        raise RollbackError("a failed version could not be removed") from why


def export_jsonl(df: DataFrame, path: str, by: str) -> None:
    """One folder of JSON Lines per value of `by`; its files, read in the order of their names, have the rows in order.

    Rows are range-partitioned, so a value with very many rows is written by
    several tasks, each a file of its own.
    """
    order = [by, *[c for c in ("row_id",) if c in df.columns]]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.partitionBy(by).option("ignoreNullFields", False).json(path)
