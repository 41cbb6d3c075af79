"""Validity periods of entity attributes from periodic snapshots.

Method: tree-reduction coalescing. Every (entity, snapshot) is a unit interval
[i, i+1) with its payload; in round r the runs of two neighbouring blocks of
2^r snapshots are joined, and the last run of the left block merges with the
first run of the right one if they touch and their payloads are equal. After
ceil(log2(snapshots)) rounds one block is left. All rounds group by (entity,
block), which the first exchange by entity already satisfies, so the whole
reduction shuffles once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.operators.snapshots import Calendar, settle

OPEN_END = "9999-12-31"


def _joined(left: Column, right: Column) -> Column:
    """Two sorted arrays of runs as one; touching runs of equal payload become one run."""
    last, first = F.element_at(left, -1), F.element_at(right, 1)
    touch = (last["e"] == first["s"]) & last["p"].eqNullSafe(first["p"])
    bridge = F.array(F.struct(last["s"].alias("s"), first["e"].alias("e"), last["p"].alias("p")))
    merged = F.concat(F.slice(left, 1, F.size(left) - 1), bridge, F.slice(right, 2, F.greatest(F.size(right) - 1, F.lit(0))))
    return F.when(left.isNull(), right).when(right.isNull(), left).when(touch, merged).otherwise(F.concat(left, right))


def coalesce_runs(units: DataFrame, entity: str, position: str, payload: Column, length: int) -> DataFrame:
    """Runs (entity, s, e, p) of equal payload over consecutive positions below `length`.

    One unit per (entity, position) is expected. The runs of an entity are an
    array of at most `length` elements.
    """
    p = payload.alias("p")
    state = units.repartition(entity).select(
        entity,
        F.col(position).alias("_b"),
        F.array(F.struct(F.col(position).alias("s"), (F.col(position) + 1).alias("e"), p)).alias("_runs"),
    )
    size = 1
    while size < max(1, length):
        state = (
            state.groupBy(entity, F.shiftright("_b", 1).alias("_b2"))
            .agg(
                F.first(F.when(F.col("_b") % 2 == 0, F.col("_runs")), ignorenulls=True).alias("_l"),
                F.first(F.when(F.col("_b") % 2 == 1, F.col("_runs")), ignorenulls=True).alias("_r"),
            )
            .select(entity, F.col("_b2").alias("_b"), _joined(F.col("_l"), F.col("_r")).alias("_runs"))
        )
        size *= 2
    return state.select(entity, F.inline("_runs"))


def attribute_history(df: DataFrame, key: str, snapshot: str, loaded: str, attributes: dict[str, Column]) -> DataFrame:
    """One row per unbroken run of snapshots in which the attributes stay the same.

    Columns: key, the attributes, valid_from (date of the first snapshot) and
    valid_to (date of the first snapshot after it in which the entity is absent
    or differs, 9999-12-31 if none), half open. A state that comes back starts
    a new row; null equals null; an empty table gives an empty result.
    """
    names = list(attributes)
    src = df.select(F.col(key).alias("_key"), F.col(snapshot).alias("_snap"), F.col(loaded).alias("_loaded"), *[c.alias(f"_v{i}") for i, c in enumerate(attributes.values())])
    values = [f"_v{i}" for i in range(len(names))]
    dates = Calendar(src, "_snap")
    units = dates.join(settle(src, "_key", "_snap", "_loaded", values))
    payload = F.struct(*values)
    runs = coalesce_runs(units, "_key", "_i", payload, dates.length)
    begin = with_dates(runs, dates, "s", "_from")
    both = with_dates(begin, dates, "e", "_to", how="left")
    return both.select(
        F.col("_key").alias(key),
        *[F.col(f"p.{v}").alias(n) for v, n in zip(values, names)],
        F.date_format("_from", "yyyy-MM-dd").alias("valid_from"),
        F.coalesce(F.date_format("_to", "yyyy-MM-dd"), F.lit(OPEN_END)).alias("valid_to"),
    )


def with_dates(runs: DataFrame, dates: Calendar, position: str, name: str, how: str = "inner") -> DataFrame:
    """Positions back to dates."""
    return dates.join(runs, dates.dates.select(F.col("_i").alias(position), F.col("_snap").alias(name)), position, how)
