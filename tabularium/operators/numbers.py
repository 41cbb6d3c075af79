"""The index of provisions that carry a rate, an amount or a factor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.functions import text as X

_BASE = ["register_id", "act", "collection", "compilation_number", "compilation_date", "section", "heading", "register_page"]


def number_records(sections: DataFrame) -> DataFrame:
    """One record per table or sentence with an operative number.

    Columns: the section's own, row_id, topic, kind, amounts, years, content,
    content_ascii, heading_ascii and `part` (tables before sentences) and
    `pos` within the row, which make any later order total. Rows without a
    number are dropped before their text is split; tables and sentences of a
    row are one array and are scanned in one pass. A null text has none.
    """
    t = F.col("text")
    operative = X.has_money(t) | X.has_percentage(t) | (t.rlike(X.FACTOR) & X.has(t, X.RATE_PHRASE))
    base = [*_BASE, "row_id", "topic"]
    rows = sections.where(operative).select(*_BASE, "row_id", "text", X.haystack(F.col("act"), F.col("heading"), t).alias("_hay"))
    rows = rows.select(*_BASE, "row_id", "text", X.topic_of(F.col("_hay")).alias("topic"))

    numbered = lambda part, pieces: F.transform(pieces, lambda x, i: F.struct(F.lit(part).alias("part"), i.alias("pos"), x.alias("content")))
    pieces = rows.select(*base, F.inline(F.concat(numbered(0, X.table_blocks(t)), numbered(1, X.sentences(t)))))
    is_table = F.col("part") == 0
    # what is scanned: a table's lines as one
    pieces = pieces.select("*", F.when(is_table, F.replace("content", F.lit("\n"), F.lit(" "))).otherwise(F.col("content")).alias("_s"))
    s = F.col("_s")
    factor = s.rlike(X.FACTOR) & X.has(s, X.RATE_PHRASE)
    pieces = pieces.select("*", X.has_money(s).alias("_money"), X.has_percentage(s).alias("_percent"), (~is_table & factor).alias("_factor"))
    money, percent, factor = F.col("_money"), F.col("_percent"), F.col("_factor")
    phrase = X.has(s, X.RATE_PHRASE) | X.has(s, X.THRESHOLD_PHRASE) | X.has(s, X.INDEX_PHRASE)
    kept = pieces.where(F.when(is_table, (F.size(X.lines(F.col("content"))) >= 3) & (money | percent)).otherwise((money | percent | factor) & (percent | phrase)))
    kind = (
        F.when(is_table, "table")
        .when(X.has(s, X.INDEX_PHRASE), "indexation")
        .when(percent & X.is_ownership_test(s), "ownership test")
        .when(percent, "rate")
        .when(factor & ~money, "factor")
        .otherwise("threshold")
    )
    factors = F.when(factor, X.factor_values(s)).otherwise(F.array().cast("array<string>"))
    amounts = F.when(~is_table, F.array_sort(F.array_union(F.array_union(X.money_values(s), X.percentage_values(s)), factors)))
    return kept.select(
        *base, "part", "pos", kind.alias("kind"), amounts.alias("amounts"), X.years(s).alias("years"), "content", X.fold(F.col("content")).alias("content_ascii"), X.fold(F.col("heading")).alias("heading_ascii")
    )


ORDER = ["topic", "act", "_section", "kind", "row_id", "part", "pos"]


def number_index(sections: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """number_records in its published order, with rate_id R00001 and so on.

    Only the named columns of the records (all, if none are named) and those
    of the order are moved and written.
    """
    from tabularium.operators.sequence import number_globally

    keyed = number_records(sections).withColumn("_section", F.coalesce("section", F.lit("")))
    if columns is not None:
        keyed = keyed.select(*dict.fromkeys([*ORDER, *columns]))
    numbered = number_globally(keyed, ORDER, "_n").withColumn("rate_id", F.format_string("R%05d", F.col("_n")))
    return numbered.select("rate_id", *columns) if columns is not None else numbered.drop("_n", "_section")
