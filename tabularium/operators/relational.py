"""Joins, deduplication and set comparison with the semantics the pipeline needs."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """A fail-closed gate did not hold; nothing may be published."""


def first_per_key(df: DataFrame, key: str, order: list) -> DataFrame:
    """The first row of every key in an explicit order (never an arbitrary one). A null key is a key."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n) of the keys that occur more than once; pre-aggregated map-side."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_empty(df: DataFrame, message: str, named: list[str] | None = None, show: int = 5) -> None:
    """Raise GateError unless the table is empty.

    The error names at most `show` rows by the columns `named` (identifiers
    of titles and rows, never texts) and by 16 digits of each row's SHA-256;
    no other content of a row gets into it.
    """
    columns = named or []
    digest = F.substring(F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns])), 256), 1, 16)
    rows = df.select(*columns, digest.alias("_digest")).limit(show).collect()
    if rows:
        raise GateError(f"{message}: {[tuple(r) for r in rows]}")


def require_some(df: DataFrame, message: str) -> None:
    """Raise GateError if the table is empty."""
    if not df.limit(1).count():
        raise GateError(message)


def require_found(keys: DataFrame, key: str, found: DataFrame, found_key: str, message: str) -> None:
    """Raise GateError, naming up to five keys, unless every key is found: an unresolved version or a failed history lets nothing be written."""
    k = keys.select(F.col(key).alias("key")).where(F.col(key).isNotNull()).distinct()
    require_empty(k.join(found.select(F.col(found_key).alias("key")).where(F.col(found_key).isNotNull()).distinct(), "key", "left_anti"), message, ["key"])


def last_value_first_place(df: DataFrame, key: str, place: str, payload: list[str]) -> DataFrame:
    """(key, place, payload...): every key at its first place with its last payload; ties by the greatest payload. One map-side aggregation."""
    row = F.struct(place, *payload)
    return df.groupBy(key).agg(F.min(place).alias("_first"), F.max(row).alias("_r")).select(key, F.col("_first").alias(place), *[F.col(f"_r.{c}").alias(c) for c in payload])


def matching_scans(scans: list[Column]) -> Column:
    """The numbers of the scans whose condition a row meets, ascending."""
    return F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(scans)]))


def first_scan(df: DataFrame, scans: list[Column]) -> DataFrame:
    """Rows that some scan matches, with `scan`, the first that does: a union of all scans, each row where it was seen first.

    One pass; df must be unique by its key.
    """
    return df.withColumn("scan", F.array_min(matching_scans(scans))).where(F.col("scan").isNotNull())


def scan_counts(df: DataFrame, scans: list[Column]) -> DataFrame:
    """(scan, matched, new) of every scan, scans without a match included; new rows are those that no earlier scan matched."""
    found = df.select(matching_scans(scans).alias("_m")).select(F.explode("_m").alias("scan"), F.array_min("_m").alias("_first"))
    got = found.groupBy("scan").agg(F.count("*").alias("matched"), F.count_if(F.col("scan") == F.col("_first")).alias("new"))
    every = df.sparkSession.range(len(scans)).select(F.col("id").cast("int").alias("scan"))
    return every.join(got, "scan", "left").na.fill(0, ["matched", "new"])


def latest_with(df: DataFrame, key: str, version: list[str], payload: list[str], usable: Column) -> DataFrame:
    """Per key: n_versions, and the payload of the latest version that is usable (nulls if none is).

    One map-side aggregation; a version tie goes to the greatest payload.
    """
    row = F.struct(*version, *payload)
    best = F.max(F.when(usable, row))
    out = df.groupBy(key).agg(F.count("*").alias("n_versions"), best.alias("_b"))
    return out.select(key, "n_versions", *[F.col(f"_b.{c}").alias(c) for c in [*version, *payload]])


def merge_patches(base: DataFrame, patches: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """base with the named columns overwritten where a patch has the key, nulls of the patch included.

    Rows without a patch stay as they are. Patches must be unique by key.
    """
    p = patches.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_p_{c}") for c in columns])
    joined = base.join(p, F.col(key) == F.col("_k"), "left")
    names = [*base.columns, *(c for c in columns if c not in base.columns)]
    old = lambda c: F.col(c) if c in base.columns else F.lit(None)
    return joined.select(*[F.when(F.col("_k").isNotNull(), F.col(f"_p_{c}")).otherwise(old(c)).alias(c) if c in columns else F.col(c) for c in names])


def lookup(base: DataFrame, key: str, other: DataFrame, other_key: str, columns: list[str], default: dict | None = None) -> DataFrame:
    """Left join of the named columns, with defaults for what is missing or null."""
    o = other.select(F.col(other_key).alias("_k"), *[F.col(c).alias(f"_o_{c}") for c in columns])
    d = default or {}
    joined = base.join(o, F.col(key) == F.col("_k"), "left")
    return joined.select(*base.columns, *[(F.coalesce(F.col(f"_o_{c}"), F.lit(d[c])) if c in d else F.col(f"_o_{c}")).alias(c) for c in columns])


def without(df: DataFrame, key: str, dropped: DataFrame, dropped_key: str) -> DataFrame:
    """Rows whose key is not among the dropped ones; null keys stay."""
    return df.join(dropped.select(F.col(dropped_key).alias("_d")).distinct(), F.col(key) == F.col("_d"), "left_anti")


def inventory_diff(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """(key, state): missing, extra or both, by full outer join of the distinct keys."""
    e = expected.select(F.col(key).alias("_e")).where(F.col(key).isNotNull()).distinct()
    p = present.select(F.col(key).alias("_p")).where(F.col(key).isNotNull()).distinct()
    state = F.when(F.col("_p").isNull(), "missing").when(F.col("_e").isNull(), "extra").otherwise("both")
    return e.join(p, F.col("_e") == F.col("_p"), "full_outer").select(F.coalesce("_e", "_p").alias(key), state.alias("state"))


SENT_NEEDLES = 20_000  # texts looked for in every line up to which they are sent to the tasks; beyond, they are joined
ANCHOR = 8


def _automaton(needles: list[str]):
    import ahocorasick

    a = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for n in needles:
        a.add_word(n)
    a.make_automaton()
    return a


def _texts_with(df: DataFrame, text: str, needles: DataFrame) -> DataFrame:
    """(_text): the distinct texts that contain a needle, by an equi-join on stretches of at most ANCHOR characters."""
    n = needles.select(F.col(needles.columns[0]).alias("_n")).withColumn("_w", F.least(F.char_length("_n"), F.lit(ANCHOR))).withColumn("_a", F.left("_n", F.col("_w")))
    texts = df.select(F.col(text).alias("_text")).where(F.col("_text").isNotNull()).distinct()

    def windows(w: int) -> Column:
        last = F.char_length("_text") - w + 1
        cut = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.struct(F.lit(w).alias("_w"), F.substring(F.col("_text"), i, F.lit(w)).alias("_a")))
        return F.when(last > 0, cut).otherwise(F.array().cast("array<struct<_w:int,_a:string>>"))

    pieces = [windows(w) for w in range(1, ANCHOR + 1)]
    at = texts.select("_text", F.inline(F.array_distinct(F.concat(*pieces))))
    return at.join(n, ["_w", "_a"]).where(F.contains("_text", "_n")).select("_text").distinct()


def _with_or_without(df: DataFrame, text: str, needles: DataFrame, keep: bool, sent: int) -> DataFrame:
    needles = needles.select(F.col(needles.columns[0]).alias("_n")).where("_n IS NOT NULL AND _n <> ''").distinct()
    few = [r["_n"] for r in needles.limit(sent + 1).collect()]
    if not few:
        return df.limit(0) if keep else df
    if len(few) <= sent:
        shared = df.sparkSession.sparkContext.broadcast(sorted(few))

        def hit(t: pa.Array) -> pa.Array:
            a = _automaton(shared.value)
            return pa.array([x is not None and next(a.iter(x), None) is not None for x in t.to_pylist()], pa.bool_())

        found = F.arrow_udf(hit, "boolean")(F.col(text))
        return df.where(found if keep else ~found)
    found = _texts_with(df, text, needles)
    return df.join(found, F.col(text) == F.col("_text"), "left_semi" if keep else "left_anti")


def lines_with(df: DataFrame, text: str, needles: DataFrame, sent: int = SENT_NEEDLES) -> DataFrame:
    """Rows whose text contains one of the needles (the first column of a table, of any size); empty and null needles are none."""
    return _with_or_without(df, text, needles, True, sent)


def lines_without(df: DataFrame, text: str, needles: DataFrame, sent: int = SENT_NEEDLES) -> DataFrame:
    """Rows whose text contains none of the needles. Null texts stay."""
    return _with_or_without(df, text, needles, False, sent)


def lookup_state(ok: Column, same_title: Column, found: Column, history_ok: Column, history_found: Column, same_version: Column, has_document: Column) -> Column:
    """What a check of the current version says: error, gone, unchanged, no-document or superseded; nulls count as false."""
    t = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(~t(ok), "error")
        .when(t(found) & ~t(same_title), "error")
        .when(~t(found) & (~t(history_ok) | ~t(history_found)), "error")
        .when(~t(found), "gone")
        .when(t(same_version), "unchanged")
        .when(~t(has_document), "no-document")
        .otherwise("superseded")
    )


def consecutive(snapshots: DataFrame, key: str, snapshot: str, columns: list[str]) -> DataFrame:
    """Every (key, snapshot) but those of the last one, with the columns of the next snapshot as next_<c>, and there, whether the key is in it.

    `snapshot` becomes the date of the next snapshot.
    """
    from tabularium.operators.snapshots import Calendar

    dates = Calendar(snapshots, snapshot)
    old = dates.join(snapshots).where(F.col("_next").isNotNull())
    new = snapshots.select(F.col(key).alias("_k"), F.col(snapshot).alias("_at"), *[F.col(c).alias(f"next_{c}") for c in columns])
    joined = old.join(new, (F.col(key) == F.col("_k")) & (F.col("_next") == F.col("_at")), "left")
    return joined.select(key, *columns, *[f"next_{c}" for c in columns], F.col("_k").isNotNull().alias("there"), F.col("_next").alias(snapshot))


def lookup_states(snapshots: DataFrame, known: DataFrame, key: str, known_key: str, snapshot: str, version: list[str], name: str, document: str) -> DataFrame:
    """(key, snapshot, state) of every key at every snapshot after one that has it, as lookup_state() has it.

    A lookup failed if the key is there without any version column; it found
    another title if the name differs (case and outer blanks aside); a key that
    is gone has a history if `known` lists it.
    """
    c = consecutive(snapshots, key, snapshot, [*version, name, document])
    k = known.select(F.col(known_key).alias("_known")).where(F.col(known_key).isNotNull()).distinct()
    c = c.join(k, F.col(key) == F.col("_known"), "left")
    there = F.col("there")
    failed = there
    same = F.lit(True)
    for v in version:
        failed = failed & F.col(f"next_{v}").isNull()
        same = same & F.col(v).eqNullSafe(F.col(f"next_{v}"))
    plain = lambda n: F.lower(F.trim(n))
    titled = plain(F.col(name)).eqNullSafe(plain(F.col(f"next_{name}")))
    state = lookup_state(~failed, titled, there, F.lit(True), F.col("_known").isNotNull(), same, F.col(f"next_{document}").isNotNull())
    return c.select(key, snapshot, state.alias("state"))


def document_statuses(listed: DataFrame, snapshots: DataFrame, key: str, snapshot: str, document: str, version: list[str], size: str) -> DataFrame:
    """(key, status, size) of every listed key in the last snapshot: error (not in it), no_epub (no document), cached (same document and version as in the one before) or ok."""
    from tabularium.operators.snapshots import Calendar

    dates = Calendar(snapshots, snapshot)
    placed = dates.join(snapshots)
    last = placed.where(F.col("_next").isNull()).select(F.col(key).alias("_k"), document, *version, size)
    ends = dates.dates.where(F.col("_next").isNull()).select((F.col("_i") - 1).alias("_i"))
    before = placed.join(ends, "_i", "left_semi").select(F.col(key).alias("_b"), *[F.col(c).alias(f"_o_{c}") for c in (document, *version)])
    j = listed.join(last, F.col(key) == F.col("_k"), "left").join(before, F.col(key) == F.col("_b"), "left")
    same = F.lit(True)
    for c in (document, *version):
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    status = F.when(F.col("_k").isNull(), "error").when(F.col(document).isNull(), "no_epub").when(F.col("_b").isNotNull() & same, "cached").otherwise("ok")
    return j.select(key, status.alias("status"), size)


def recoverable(snapshots: DataFrame, key: str, snapshot: str, document: str) -> DataFrame:
    """(key, snapshot, document) of the latest document of every key whose last row has none; an empty document is none."""
    got = F.coalesce(F.col(document), F.lit("")) != ""
    last = F.max(F.struct(snapshot, got.alias("has")))
    best = F.max(F.when(got, F.struct(snapshot, document)))
    out = snapshots.groupBy(key).agg(last.alias("_l"), best.alias("_b")).where(~F.col("_l.has") & F.col("_b").isNotNull())
    return out.select(key, F.col(f"_b.{snapshot}").alias(snapshot), F.col(f"_b.{document}").alias(document))
