"""Queries over the project's tables for the general problems 2 and 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.shred import shred
from corpusloom.operators.timestamps import with_instant
from corpusloom.sources.tables import table


def _dated_values(spark: SparkSession, folder: str) -> DataFrame:
    """(field, row_id, source, value) of the four date fields that hold anything."""
    fields = ("pub_date", "sitemap_lastmod", "last_updated")
    manifest = table(spark, folder, "manifest").select(
        "source", F.col("entry_id").alias("row_id"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields])).alias("e")
    )
    documents = table(spark, folder, "documents").select(F.lit("updated_at").alias("field"), F.col("doc_id").alias("row_id"), "source", F.col("updated_at").alias("value"))
    return manifest.select("e.field", "row_id", "source", "e.value").unionByName(documents).where(F.col("value").isNotNull())


def _zones(spark: SparkSession, folder: str) -> DataFrame:
    """One zone and locale for each source; the planner broadcasts the table where its size allows."""
    return table(spark, folder, "sources").groupBy("source").agg(F.min("tz_name").alias("tz_name"), F.min("locale").alias("locale"))


def p2_instants(spark: SparkSession, folder: str) -> DataFrame:
    """Every dated value with its instant; null where the value names none."""
    rows = _dated_values(spark, folder).join(_zones(spark, folder), "source", "left")
    return with_instant(rows, "value", "tz_name", "locale").select("field", "row_id", "value", "utc_us")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_instants(spark, folder).where(F.col("utc_us").isNotNull()).select("field", "row_id", "utc_us")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return shred(table(spark, folder, "raw_records")).select("rec_id", "node_path", "parent_path")


def p5_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All flat tables in one: each object's leaves as a map, with the link to its parent."""
    return shred(table(spark, folder, "raw_records"), leaves=True)


P5_FOUND = r"""WITH RECURSIVE raw AS (SELECT rec_id, ltrim(payload, chr(65279)) AS p FROM raw_records),
j0 AS (SELECT rec_id, p::JSON AS j FROM raw WHERE json_valid(p)),
j AS (SELECT rec_id, CASE WHEN json_type(j) = 'OBJECT' AND json_keys(j) = ['document'] AND json_type(j, '$.document') = 'OBJECT' THEN json_extract(j, '$.document') ELSE j END AS j FROM j0 WHERE json_type(j) = 'OBJECT'),
names AS MATERIALIZED (SELECT DISTINCT t.key AS k FROM j, json_tree(j.j) t WHERE t.type = 'ARRAY' AND NOT regexp_matches(t.fullkey, '\\."?tables"?(\\[\\d+\\])*\\."?data"?[.\\[]')),
n(rec_id, path, parent, k, is_elem, v) AS (
  SELECT rec_id, '', '', NULL::VARCHAR, false, j FROM j
  UNION ALL
  SELECT n.rec_id, CASE WHEN json_type(n.v) = 'ARRAY' THEN n.path || '[' || e.key || ']' WHEN n.path = '' THEN e.key ELSE n.path || '.' || e.key END,
    CASE WHEN n.is_elem AND json_type(n.v) = 'OBJECT' THEN n.path ELSE n.parent END,
    CASE WHEN json_type(n.v) = 'ARRAY' THEN n.k ELSE e.key END, json_type(n.v) = 'ARRAY',
    CASE WHEN json_type(n.v) = 'OBJECT' AND e.key IN (SELECT k FROM names) AND e.type = 'OBJECT' THEN ('[' || e.value || ']')::JSON
         WHEN json_type(n.v) = 'OBJECT' AND e.key IN (SELECT k FROM names) AND e.type = 'VARCHAR' AND ltrim(json_extract_string(e.value, '$')) LIKE '[%' AND json_valid(json_extract_string(e.value, '$')) THEN json_extract_string(e.value, '$')::JSON
         ELSE e.value END
  FROM n, json_each(n.v) e
  WHERE json_type(n.v) IN ('OBJECT', 'ARRAY') AND NOT (json_type(n.v) = 'OBJECT' AND n.k = 'tables' AND e.key = 'data'))
SELECT rec_id, path AS node_path, parent AS parent_path FROM n WHERE is_elem AND json_type(v) = 'OBJECT'
"""


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_instants, p5_found, p5_tables)}


def oracle_sql() -> dict[str, str]:
    return {"p5_found": P5_FOUND}
