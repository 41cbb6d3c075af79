"""Queries of problems 5 and 6 over `sources`, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.operators.history import attribute_history
from tabularium.operators.snapshots import numeric_text, snapshot_changes
from tabularium.sources.tables import table


def _sources(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sources")


def p5_changes(spark: SparkSession, d: str) -> DataFrame:
    """register_ids added, removed or changed between consecutive snapshots."""
    return snapshot_changes(
        _sources(spark, d),
        key="register_id",
        snapshot="retrieved",
        loaded="loaded_at",
        compare={"compilation_number": numeric_text(F.col("compilation_number")), "compilation_date": F.col("compilation_date")},
    )


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_changes(spark, d).select("register_id", F.date_format("retrieved", "yyyy-MM-dd").alias("retrieved"), "change")


def p6_history(spark: SparkSession, d: str) -> DataFrame:
    """Each title's states with the period in which each held."""
    return attribute_history(
        _sources(spark, d),
        key="register_id",
        snapshot="retrieved",
        loaded="loaded_at",
        attributes={
            "compilation_number": numeric_text(F.col("compilation_number")).cast("bigint"),
            "version_is_current": F.col("version_is_current"),
            "current_version_start": F.col("current_version_start"),
        },
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_history(spark, d).select("register_id", "valid_from", "valid_to")


QUERIES = {"p5_found": p5_found, "p5_changes": p5_changes, "p6_found": p6_found, "p6_history": p6_history}

_SETTLED = """
settled AS (
  SELECT register_id, retrieved,
         TRY_CAST(nullif(regexp_extract(compilation_number, '(\\d+)', 1), '') AS BIGINT) AS cn,
         compilation_date, version_is_current, current_version_start
  FROM sources WHERE register_id IS NOT NULL AND retrieved IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY register_id, retrieved ORDER BY loaded_at DESC NULLS LAST) = 1),
cal AS (SELECT retrieved, row_number() OVER (ORDER BY retrieved) AS i, lead(retrieved) OVER (ORDER BY retrieved) AS nxt
        FROM (SELECT DISTINCT retrieved FROM sources WHERE retrieved IS NOT NULL)),
s AS (SELECT * FROM settled JOIN cal USING (retrieved))"""

_CHANGES = f"""
WITH {_SETTLED},
ev AS (
  SELECT b.register_id, b.retrieved,
         CASE WHEN a.register_id IS NULL THEN 'added'
              WHEN a.cn IS DISTINCT FROM b.cn OR a.compilation_date IS DISTINCT FROM b.compilation_date THEN 'changed' END AS change
  FROM s b LEFT JOIN s a ON a.register_id = b.register_id AND a.i = b.i - 1 WHERE b.i > 1
  UNION ALL
  SELECT a.register_id, a.nxt, 'removed' FROM s a LEFT JOIN s b ON b.register_id = a.register_id AND b.i = a.i + 1
  WHERE a.nxt IS NOT NULL AND b.register_id IS NULL)
"""

_HISTORY = f"""
WITH {_SETTLED},
marked AS (
  SELECT *, CASE WHEN lag(i) OVER w = i - 1 AND lag(cn) OVER w IS NOT DISTINCT FROM cn
                  AND lag(version_is_current) OVER w IS NOT DISTINCT FROM version_is_current
                  AND lag(current_version_start) OVER w IS NOT DISTINCT FROM current_version_start THEN 0 ELSE 1 END AS fresh
  FROM s WINDOW w AS (PARTITION BY register_id ORDER BY i)),
grp AS (SELECT *, sum(fresh) OVER (PARTITION BY register_id ORDER BY i) AS g FROM marked),
h AS (SELECT register_id, any_value(cn) AS compilation_number, any_value(version_is_current) AS version_is_current,
             any_value(current_version_start) AS current_version_start,
             strftime(min(retrieved), '%Y-%m-%d') AS valid_from,
             coalesce(strftime(max_by(coalesce(nxt, DATE '9999-12-31'), i), '%Y-%m-%d'), '9999-12-31') AS valid_to
      FROM grp GROUP BY register_id, g)
"""

ORACLE = {
    "p5_changes": _CHANGES + "SELECT register_id, retrieved, change FROM ev WHERE change IS NOT NULL",
    "p5_found": _CHANGES + "SELECT register_id, strftime(retrieved, '%Y-%m-%d') AS retrieved, change FROM ev WHERE change IS NOT NULL",
    "p6_history": _HISTORY + "SELECT register_id, compilation_number, version_is_current, current_version_start, valid_from, valid_to FROM h",
    "p6_found": _HISTORY + "SELECT register_id, valid_from, valid_to FROM h",
}
