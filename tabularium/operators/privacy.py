"""Which rows and titles name private persons, and which contacts are not approved."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.functions import identifiers as I  # noqa: E741
from tabularium.functions.text import word_count


def person_rows(sections: DataFrame, least_names: int = 3, least_numbers: int = 3) -> DataFrame:
    """(register_id, row_id, names, numbers, words) of rows with enough distinct names and numbers.

    Rows without an eight-digit number are dropped before names are looked for.
    """
    t = F.col("text")
    rows = sections.where(t.rlike(I.REGISTRATION))
    counted = rows.select("register_id", "row_id", F.size(I.person_names(t)).alias("names"), F.size(I.registration_numbers(t)).alias("numbers"), word_count(t).alias("words"))
    return counted.where((F.col("names") >= least_names) & (F.col("numbers") >= least_numbers))


def title_rollup(hot: DataFrame, sections: DataFrame) -> DataFrame:
    """Per title: rows_total, rows_flagged, names_est and words; the flagged rows themselves are the rows of `hot`."""
    totals = sections.groupBy("register_id").agg(F.count("*").alias("rows_total"))
    per = hot.groupBy("register_id").agg(F.count("*").alias("rows_flagged"), F.sum("names").alias("names_est"), F.sum("words").alias("words"))
    return per.join(totals, "register_id").select("register_id", "rows_total", "rows_flagged", "names_est", "words")


def contact_fingerprints(df: DataFrame, keep: list[str], text: str) -> DataFrame:
    """(keep..., kind, sha256), one row per contact; values themselves are never selected."""
    found = df.select(*keep, F.explode(I.contact_values(F.col(text))).alias("_c"))
    return found.select(*keep, F.col("_c.kind").alias("kind"), I.fingerprint(F.col("_c.value")).alias("sha256"))


def unapproved(contacts: DataFrame, allowlist: DataFrame) -> DataFrame:
    """Contacts without an entry (kind, sha256, register_id); a tax file number can never be approved."""
    a = allowlist.select(F.col("kind").alias("_k"), F.col("sha256").alias("_s"), F.col("register_id").alias("_r"))
    on = (F.col("kind") == F.col("_k")) & (F.col("sha256") == F.col("_s")) & (F.col("register_id") == F.col("_r")) & (F.col("kind") != "tfn")
    return contacts.join(a, on, "left_anti")


def contact_report(contacts: DataFrame, allowlist: DataFrame) -> DataFrame:
    """(kind, found, unapproved, different, approved, titles) by kind; different and approved count distinct fingerprints."""
    a = allowlist.where("kind <> 'tfn'").select(F.col("kind").alias("_k"), F.col("sha256").alias("_s"), F.col("register_id").alias("_r")).distinct()
    per = contacts.groupBy("kind", "sha256", "register_id").agg(F.count("*").alias("n"))
    known = per.join(a, (F.col("kind") == F.col("_k")) & (F.col("sha256") == F.col("_s")) & (F.col("register_id") == F.col("_r")), "left")
    good = F.col("_k").isNotNull()
    return known.groupBy("kind").agg(
        F.sum("n").alias("found"),
        F.coalesce(F.sum(F.when(~good, F.col("n"))), F.lit(0)).alias("unapproved"),
        F.countDistinct("sha256").alias("different"),
        F.countDistinct(F.when(good, F.col("sha256"))).alias("approved"),
        F.countDistinct("register_id").alias("titles"),
    )


def contact_examples(contacts: DataFrame, allowlist: DataFrame, k: int = 5) -> DataFrame:
    """(kind, register_id, row_id, digest) of the first k unapproved contacts of every kind; digest has 16 digits of the fingerprint."""
    left = unapproved(contacts, allowlist).select("kind", "register_id", "row_id", F.substring("sha256", 1, 16).alias("digest")).distinct()
    w = Window.partitionBy("kind").orderBy("register_id", "row_id", "digest")
    return left.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n")
