"""Order-dependent operators: ordinals, running counts, carry-forward, look-ahead, islands.

Order is always an explicit column. Windows partition by a document, whose rows
lie in one task; groups that may grow without bound (the rows of a title, a
global order) are numbered in two levels over ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.session import materialise


def ordinals(df: DataFrame, by: str | list[str], order: list, name: str = "ordinal") -> DataFrame:
    """Rows numbered from 1 within their group, nulls in the order first."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("bigint"))


def ordinals_in_ranges(df: DataFrame, by: str, order: list[str], name: str = "ordinal") -> DataFrame:
    """ordinals() for groups of any size: a group with a third of all rows is spread over many tasks.

    Rows are range-partitioned by group and order, placed within their range
    and written once; a group's place in a range plus its rows in the ranges
    before gives the ordinal. Ties are numbered as they fall. Null is a group.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = df.repartitionByRange(n, by, *order).sortWithinPartitions(by, *order).withColumn("_m", F.monotonically_increasing_id())
    placed = materialise(sorted_.withColumn("_p", F.shiftright("_m", 33).cast("int")).withColumn("_k", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_m"))
    runs = placed.groupBy(F.col(by).alias("_g"), F.col("_p").alias("_q")).agg(F.min("_k").alias("_first"), F.count("*").alias("_c"))
    # one row per group and range by now
    w = Window.partitionBy("_g").orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
    joined = placed.join(runs, F.col(by).eqNullSafe(F.col("_g")) & (F.col("_p") == F.col("_q")))
    return joined.select(*df.columns, (F.col("_k") - F.col("_first") + F.col("_before") + 1).cast("bigint").alias(name))


def row_ids(df: DataFrame, by: str, order: list[str], label: str, name: str = "row_id") -> DataFrame:
    """`id:%04d:label` with the row's ordinal; a null or empty label is `-`."""
    numbered = ordinals_in_ranges(df, by, order, "_n")
    tag = F.when(F.coalesce(F.col(label), F.lit("")) == "", "-").otherwise(F.col(label))
    return numbered.withColumn(name, F.format_string("%s:%04d:%s", F.col(by), F.col("_n"), tag)).drop("_n")


def running_count(df: DataFrame, by: str, order: list, marker: Column, name: str) -> DataFrame:
    """How many marked rows there are up to and with each row; a null marker is none."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(F.when(marker, 1).otherwise(0)).over(w).cast("bigint"))


def carry_forward(df: DataFrame, by: str | list[str], order: list, value: Column, name: str) -> DataFrame:
    """The last value that was not null, up to and with each row."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def look_ahead(df: DataFrame, by: str | list[str], order: list, value: Column, name: str, steps: int = 1) -> DataFrame:
    """The value `steps` rows later, null at the end."""
    return df.withColumn(name, F.lead(value, steps).over(Window.partitionBy(by).orderBy(*order)))


def islands(df: DataFrame, by: str, order: list, value: Column, name: str = "island") -> DataFrame:
    """Runs of equal value numbered from 1 within their group; null equals null."""
    w = Window.partitionBy(by).orderBy(*order)
    fresh = df.withColumn("_fresh", F.when(F.row_number().over(w) == 1, 1).when(value.eqNullSafe(F.lag(value).over(w)), 0).otherwise(1))
    return fresh.withColumn(name, F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint")).drop("_fresh")


def nth_of_total(df: DataFrame, by: str | list[str], order: list) -> DataFrame:
    """Adds `n` and `total`: each row's place in its group and the group's rows."""
    return ordinals(df, by, order, "n").withColumn("total", F.count("*").over(Window.partitionBy(by)))


def top_per_group(df: DataFrame, by: str, order: list, k: int) -> DataFrame:
    """The first k rows of each group, with `rank` and `remainder`, the rows left out.

    row_number() with a bound lets Spark cut groups map-side before the
    shuffle (window group limit); the totals are counted with partial sums.
    """
    w = Window.partitionBy(by).orderBy(*order)
    best = df.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
    totals = df.groupBy(by).agg(F.count("*").alias("_total"))
    joined = best.alias("x").join(totals.alias("t"), F.col(f"x.{by}").eqNullSafe(F.col(f"t.{by}")))
    return joined.select("x.*", F.greatest(F.col("_total") - k, F.lit(0)).alias("remainder"))


def number_globally(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """Rows numbered in one global order without a single-task window.

    Range-partitions and sorts by `order`, writes that once, and adds to each
    row's place in its partition the rows of the partitions before. Only one
    count per partition reaches the driver. Give enough columns for a total
    order; ties are numbered as they fall.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written first: choosing the ranges samples its input, which would otherwise be computed twice
    placed = materialise(df).repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    kept = materialise(placed.withColumn("_p", F.shiftright("_m", 33).cast("int")).withColumn("_k", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_m"))
    counts = sorted((r["_p"], r["c"]) for r in kept.groupBy("_p").agg(F.count("*").alias("c")).collect())
    offsets, total = [], start
    for p, c in counts:
        offsets.append((p, total))
        total += c
    table = spark.createDataFrame(offsets, "_p int, _o bigint")
    return kept.join(F.broadcast(table), "_p").withColumn(name, F.col("_k") + F.col("_o")).drop("_p", "_k", "_o")
