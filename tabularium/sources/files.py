"""Readers of manifests, JSON Lines trees, archives, folder listings and policy files."""

from __future__ import annotations

import json
import os
import re
import stat
from datetime import date
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium import schemas
from tabularium.functions.identifiers import has_control_bytes
from tabularium.functions.text import is_register_id
from tabularium.operators.relational import GateError


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array of records; anything that does not fit the schema fails the read."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_sections_tree(spark: SparkSession, root: str) -> DataFrame:
    """Rows of `<root>/<register_id>/sections.jsonl` with the folder's id as `folder_id` and, where a line is no row, `bad_line`.

    Blank lines are skipped. A folder whose name is no register id fails a
    gate only when its rows are used (filter on `folder_ok`).
    """
    raw = spark.read.text(f"{root}/*/sections.jsonl").select("value", F.col("_metadata.file_path").alias("_path")).where(F.trim("value") != "")
    folder = F.regexp_extract("_path", r"([^/]+)/sections\.jsonl$", 1)
    parsed = raw.select(folder.alias("folder_id"), "value", F.from_json("value", schemas.SECTIONS + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    fields = [f"r.{f.split()[0]}" for f in schemas.SECTIONS.split(", ")]
    return parsed.select("folder_id", is_register_id(F.col("folder_id")).alias("folder_ok"), F.col("r._bad").alias("bad_line"), *fields)


def read_archives(spark: SparkSession, glob: str) -> DataFrame:
    """(register_id, content, modified) of archive files named `<register_id>.epub`."""
    b = spark.read.format("binaryFile").load(glob)
    return b.select(F.regexp_extract("path", r"([^/]+)\.epub$", 1).alias("register_id"), "content", F.col("modificationTime").cast("date").alias("modified"))


def decode_envelope(df: DataFrame, content: str) -> DataFrame:
    """content as archive bytes: raw if it starts with P, else the strict base64 `bytes` of a JSON envelope; null if neither."""
    text = F.decode(F.col(content), "UTF-8")
    inner = F.try_to_binary(F.get_json_object(text, "$.bytes"), F.lit("base64"))
    return df.withColumn(content, F.when(F.substring(F.col(content), 1, 1) == F.lit(b"P"), F.col(content)).when(F.is_valid_utf8(F.col(content).cast("string")), inner))


def text_problems(spark: SparkSession, glob: str) -> DataFrame:
    """(path, problem) of files that are not strict UTF-8 or hold control characters."""
    b = spark.read.format("binaryFile").load(glob).select("path", F.col("content").cast("string").alias("t"))
    problem = F.when(~F.is_valid_utf8("t"), "not UTF-8").when(has_control_bytes(F.col("t")), "control characters")
    return b.select("path", problem.alias("problem")).where("problem IS NOT NULL")


def cached_unchanged(resolved: DataFrame, sidecars: DataFrame) -> DataFrame:
    """resolved with `cached`: an archive of the same version is there and valid (id, versionStart, valid in sidecars)."""
    s = sidecars.select(F.col("id").alias("_i"), F.col("versionStart").alias("_v"), F.col("valid").alias("_ok"))
    on = (F.col("id") == F.col("_i")) & (F.col("versionStart") == F.col("_v"))
    return resolved.join(s, on, "left").select(*resolved.columns, F.coalesce("_ok", F.lit(False)).alias("cached"))


def with_retrieved(archives: DataFrame, given: str | None = None, modified: str = "modified") -> DataFrame:
    """archives with `retrieved`: the date given, which must be a real one (YYYY-MM-DD), or else the file's."""
    if given is None:
        return archives.withColumn("retrieved", F.col(modified).cast("date"))
    return archives.withColumn("retrieved", F.lit(date.fromisoformat(given)))


def _entries(root: str, top: str):
    """(path, kind, bytes) of an entry and all below it; links are not followed."""
    first = os.path.join(root, top)
    walked = [(os.path.join(f, n)) for f, ds, fs in os.walk(first, followlinks=False) for n in sorted([*ds, *fs])] if not os.path.islink(first) else []
    for full in [first, *walked]:
        mode = os.lstat(full).st_mode
        kind = "symlink" if stat.S_ISLNK(mode) else "dir" if stat.S_ISDIR(mode) else "file" if stat.S_ISREG(mode) else "other"
        if kind == "dir" and getattr(os.path, "isjunction", lambda _: False)(full):
            kind = "junction"
        yield os.path.relpath(full, root), kind, os.lstat(full).st_size if kind == "file" else None


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, kind, bytes) of everything below a folder that all machines see: dir, file, symlink, junction or other; links are not followed.

    The driver lists the first level only; tasks walk what is below it.
    """
    top = sorted(os.listdir(root))
    if not top:
        return spark.createDataFrame([], "path string, kind string, bytes bigint")

    def walk(batches):
        for b in batches:
            rows = [r for t in b.column(0).to_pylist() for r in _entries(root, t)]
            path, kind, size = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(path, pa.string()), pa.array(kind, pa.string()), pa.array(size, pa.int64())], names=["path", "kind", "bytes"])

    return spark.createDataFrame([(t,) for t in top], "top string").mapInArrow(walk, "path string, kind string, bytes bigint")


def contained(root: str, *parts: str) -> str:
    """A path below root; raises if it would leave it or pass through a link."""
    base = Path(os.path.realpath(root))
    full = base.joinpath(*parts)
    if base not in full.parents or Path(os.path.realpath(full)) != full:
        raise GateError("path leaves its root")
    return str(full)


def strict_json(path: str) -> dict:
    """A JSON object in which no member occurs twice, at any depth."""

    def once(pairs):
        if len({k for k, _ in pairs}) != len(pairs):
            raise GateError("duplicate JSON member")
        return dict(pairs)

    with open(path, encoding="utf-8") as f:
        value = json.load(f, object_pairs_hook=once)
    if not isinstance(value, dict):
        raise GateError("not a JSON object")
    return value


def allowlist_problems(entries: list[dict]) -> list[str]:
    """What is wrong with the entries of an allowlist; empty if nothing is."""
    problems, seen = [], set()
    for i, e in enumerate(entries):
        if set(e) != {"kind", "sha256", "register_id", "reason"} or not all(isinstance(v, str) for v in e.values()):
            problems.append(f"entry {i}: fields")
            continue
        checks = {
            "kind": e["kind"] in ("email", "phone"),  # a tax file number is never approved
            "sha256": re.fullmatch(r"[0-9a-f]{64}", e["sha256"]),
            "register_id": re.fullmatch(r"[A-Z]\d{4}[A-Z]\d{5}", e["register_id"]),
            "reason": e["reason"].strip() and not re.search(r"@|\d{6,}|\d[\d \-]{7,}\d", e["reason"]),
        }
        problems += [f"entry {i}: {k}" for k, good in checks.items() if not good]
        key = (e["kind"], e["sha256"], e["register_id"])
        if key in seen:
            problems.append(f"entry {i}: repeated")
        seen.add(key)
    return problems


def read_allowlist(spark: SparkSession, path: str) -> DataFrame:
    """The allowlist as a table; raises GateError unless it is valid as a whole."""
    doc = strict_json(path)
    if set(doc) != {"schema_version", "entries"} or doc["schema_version"] != 1 or not isinstance(doc["entries"], list):
        raise GateError("invalid allowlist document")
    problems = allowlist_problems(doc["entries"])
    if problems:
        raise GateError(f"invalid allowlist: {problems[:5]}")
    return spark.createDataFrame([tuple(e[k] for k in ("kind", "sha256", "register_id", "reason")) for e in doc["entries"]], schemas.ALLOWLIST)
