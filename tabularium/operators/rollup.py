"""Counts of a corpus and of a subset of it, recomputed from rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.functions.text import half_even_to, word_count


def has_text(c: str):
    """Null and empty alike count as absent."""
    return F.coalesce(F.col(c), F.lit("")) != ""


def kind_or_default(kind: str = "kind", section: str = "section"):
    return F.when(has_text(kind), F.col(kind)).when(has_text(section), "section").otherwise("unnumbered")


def per_title(sections: DataFrame) -> DataFrame:
    return sections.groupBy("register_id").agg(
        F.count("*").alias("rows"), F.count_if(has_text("section")).alias("section_rows"), F.coalesce(F.sum(word_count(F.col("text"))), F.lit(0)).alias("words")
    )


def corpus_rollup(sections: DataFrame, by: str = "collection") -> DataFrame:
    """(by, titles, rows, section_rows, words) per group, and the grand total as group `*`.

    Two-phase: per (group, title) first, so a hot title is one row per task in
    the shuffle and distinct titles need no expansion.
    """
    group = F.coalesce(F.col(by), F.lit("unknown"))
    small = sections.groupBy(group.alias("g"), "register_id").agg(
        F.count("*").alias("rows"), F.count_if(has_text("section")).alias("section_rows"), F.sum(word_count(F.col("text"))).alias("words")
    )
    parts = small.groupBy("g").agg(F.countDistinct("register_id").alias("titles"), F.sum("rows").alias("rows"), F.sum("section_rows").alias("section_rows"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"))
    whole = small.agg(F.countDistinct("register_id").alias("titles"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("section_rows"), F.lit(0)).alias("section_rows"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"))
    return parts.unionByName(whole.withColumn("g", F.lit("*"))).withColumnRenamed("g", by)


def histograms(records: DataFrame, columns: list[str]) -> DataFrame:
    """(dimension, value, n): one pass over grouping sets, nulls as `unknown`."""
    named = records.select(*[F.coalesce(F.col(c), F.lit("unknown")).alias(c) for c in columns])
    grouped = named.groupingSets([[F.col(c)] for c in columns], *[F.col(c) for c in columns]).agg(F.grouping_id().alias("_g"), F.count("*").alias("n"))
    top = len(columns) - 1
    case = None
    value = None
    for i, c in enumerate(columns):
        mine = F.col("_g").bitwiseAND(1 << (top - i)) == 0
        case = F.when(mine, c) if case is None else case.when(mine, c)
        value = F.when(mine, F.col(c)) if value is None else value.when(mine, F.col(c))
    return grouped.select(case.alias("dimension"), value.alias("value"), "n")


def pii_summary(flagged: DataFrame) -> DataFrame:
    """(titles, names): names rounded to the nearest 50, halves to even."""
    return flagged.agg(F.count("*").alias("titles"), half_even_to(F.coalesce(F.sum("names_est"), F.lit(0)), 50).alias("names"))
