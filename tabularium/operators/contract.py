"""Closed contracts: a table must hold exactly what its rules allow, or a row says why not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.text import iso_date, utc_timestamp
from tabularium.operators.relational import duplicate_keys

# The states of an observation and the fields each requires; the other conditional fields must be null.
CONDITIONAL = ["observed_compilation_number", "observed_compilation_date", "observed_register_document_id", "current_version_start", "error_category"]
REQUIRED = {
    "UNCHANGED": [],
    "SUPERSEDED": ["observed_compilation_number", "observed_compilation_date", "observed_register_document_id"],
    "CURRENT_NO_PUBLISHED_COMPILATION": ["current_version_start"],
    "NO_LONGER_IN_FORCE": [],
    "LOOKUP_FAILED": ["error_category"],
}
COLLECTIONS = ["Act", "LegislativeInstrument", "NotifiableInstrument"]
BASELINE = ["register_id", "name", "collection", "compilation_number", "compilation_date", "version_is_current", "current_version_start", "retrieved", "source_url", "register_page"]


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def non_empty(c: str) -> Column:
    return _true((F.trim(c) != "") & ~F.col(c).rlike(r"[\x00-\x1F\x7F]"))


def date_text(c: str) -> Column:
    return _true(iso_date(F.col(c)).isNotNull())


def https_url(c: str) -> Column:
    """An https address with a host, without credentials, blanks or backslashes, and with a valid port if any."""
    port = F.regexp_extract(c, r"(?i)\Ahttps://[^/?#]*?:(\d+)(?:[/?#]|\z)", 1)
    shape = F.col(c).rlike(r"(?i)\Ahttps://(\[[0-9a-f:.]+\]|[^\s/?#@\\:\[\]]+)(:\d*)?([/?#]\S*)?\z")
    return _true(shape & ((port == "") | (port.cast("int") <= 65535))) & non_empty(c)


def violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule) of every rule that a row breaks. One pass; a rule that is null is broken."""
    broken = F.array_compact(F.array(*[F.when(~_true(ok), F.lit(name)) for name, ok in rules.items()]))
    return df.select(F.col(key).alias(key), F.explode(broken).alias("rule"))


def baseline_violations(df: DataFrame) -> DataFrame:
    """(register_id, rule) where the rows are no valid baseline; repeated ids included."""
    rules = {
        "register_id": non_empty("register_id"),
        "name": non_empty("name"),
        "collection": F.col("collection").isin(COLLECTIONS),
        "compilation_number": non_empty("compilation_number"),
        "compilation_date": date_text("compilation_date"),
        "version_is_current": F.col("version_is_current").isNotNull(),
        "current_version_start": F.when(F.col("current_version_start").isNull(), _true(F.col("version_is_current"))).otherwise(date_text("current_version_start")),
        "retrieved": date_text("retrieved"),
        "source_url": https_url("source_url"),
        "register_page": https_url("register_page"),
    }
    again = duplicate_keys(df, ["register_id"]).select("register_id", F.lit("unique register_id").alias("rule"))
    return violations(df, "register_id", rules).unionByName(again)


# Fixed value: the source a baseline has to name.
SOURCE = "Federal Register of Legislation"


def header_violations(header: DataFrame, titles: DataFrame) -> DataFrame:
    """(rule): what a baseline's header (one row: corpus, retrieved, source, source_api, all text) and the number of its titles break."""
    rules = {
        "corpus": non_empty("corpus"),
        "retrieved": date_text("retrieved"),
        "source": _true(F.col("source") == SOURCE),
        "source_api": https_url("source_api"),
    }
    missing = [c for c in rules if c not in header.columns]
    broken = violations(header.withColumns({c: F.lit(None).cast("string") for c in missing}).withColumn("_h", F.lit("header")), "_h", rules).select("rule")
    counted = titles.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("titles").alias("rule"))
    one = header.agg(F.count("*").alias("n")).where("n <> 1").select(F.lit("one header").alias("rule"))
    return broken.unionByName(counted).unionByName(one)


def baseline(df: DataFrame) -> DataFrame:
    """The contract's columns only, in its order."""
    return df.select(*BASELINE).orderBy("register_id", "collection")


def observation_violations(observations: DataFrame, base: DataFrame, complete: bool, v2: bool = False) -> DataFrame:
    """(register_id, rule) where observations do not fit the baseline or their state."""
    b = base.select(F.col("register_id").alias("_r"), F.col("collection").alias("_c"))
    o = observations.join(b, F.col("register_id") == F.col("_r"), "left")
    rules = {
        "in scope": F.col("_r").isNotNull(),
        "collection": F.col("_r").isNull() | F.col("collection").eqNullSafe(F.col("_c")),
        "state": F.col("state").isin(list(REQUIRED)),
        "evidence_url": https_url("evidence_url"),
        "checked_at": _true(utc_timestamp(F.col("checked_at")).isNotNull()),
    }
    for f in CONDITIONAL:
        need = [s for s, fields in REQUIRED.items() if f in fields]
        good = date_text(f) if f.endswith(("_date", "_start")) else non_empty(f)
        rules[f] = F.when(F.col("state").isin(need), good).otherwise(F.col(f).isNull())
    if v2:
        rules["evidence_id"] = non_empty("evidence_id")
    out = violations(o, "register_id", rules)
    out = out.unionByName(duplicate_keys(observations, ["register_id"]).select("register_id", F.lit("unique register_id").alias("rule")))
    if v2:
        many = duplicate_keys(observations, ["evidence_id"]).join(observations, "evidence_id").select("register_id", F.lit("unique evidence_id").alias("rule"))
        out = out.unionByName(many)
    if complete:
        missing = base.join(observations, "register_id", "left_anti").select("register_id", F.lit("covered").alias("rule"))
        out = out.unionByName(missing)
    return out


def observation(observations: DataFrame, v2: bool = False) -> DataFrame:
    """The contract's columns; conditional fields only where the state has them."""
    kept = [F.when(F.col("state").isin([s for s, fields in REQUIRED.items() if f in fields]), F.col(f)).alias(f) for f in CONDITIONAL]
    return observations.select("register_id", "collection", "state", *kept, "evidence_url", "checked_at", *(["evidence_id"] if v2 else [])).orderBy("register_id", "collection")
