"""Queries of the general training-data problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.text import na_to_null
from skyloom.operators.drift import Drift
from skyloom.operators.near import field_polygons, pairs_within, points_in_regions
from skyloom.operators.packed import split_packed
from skyloom.operators.rejects import load_records
from skyloom.session import table

QUERIES = {}
SQL = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return split_packed(table(spark, d, "crd_catalog"), "CRD_ID", "compared_to")


SQL["p1_found"] = r"""
WITH f AS (
  SELECT DISTINCT CRD_ID,
    regexp_replace(regexp_replace(compared_to, '[\x{200B}-\x{200D}\x{FEFF}]', '', 'g'),
      '^[\s\x{A0},，;；|/\[\]{}()]+|[\s\x{A0},，;；|/\[\]{}()]+$', '', 'g') AS s
  FROM crd_catalog WHERE compared_to IS NOT NULL),
t AS (
  SELECT CRD_ID, list_filter(list_transform(
    regexp_extract_all(s, '"[^"]*(?:""[^"]*)*"|''[^'']*(?:''''[^'']*)*''|[^\s\x{A0},，;；|/]+'),
    lambda v: trim(CASE WHEN v[1] = '"' THEN replace(v[2:-2], '""', '"') WHEN v[1] = '''' THEN replace(v[2:-2], '''''', '''') ELSE v END)),
    lambda v: lower(v) NOT IN ('', 'na', 'nan', 'null', 'none', '<na>')) AS vs
  FROM f)
SELECT DISTINCT CRD_ID, CAST(u.pos AS INTEGER) AS pos, u.v AS value
FROM t, LATERAL (SELECT unnest(vs) AS v, generate_subscripts(vs, 1) AS pos) u"""


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = pairs_within(table(spark, d, "crd_catalog"), "CRD_ID", "ra", "dec", 0.5)
    return pairs.select(F.col("left").alias("left_crd_id"), F.col("right").alias("right_crd_id"))


SQL["p4_found"] = """
WITH v AS (
  SELECT DISTINCT CRD_ID, cos(radians(dec)) * cos(radians(ra)) AS x, cos(radians(dec)) * sin(radians(ra)) AS y, sin(radians(dec)) AS z
  FROM crd_catalog WHERE CRD_ID IS NOT NULL AND NOT isnan(ra) AND NOT isnan(dec) AND ra >= 0 AND ra < 360 AND dec >= -90 AND dec <= 90),
c AS (SELECT *, floor(x * 1e5) AS cx, floor(y * 1e5) AS cy, floor(z * 1e5) AS cz FROM v),
n AS (
  SELECT c.*, cx + i AS nx, cy + j AS ny, cz + k AS nz
  FROM c, (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j), (SELECT unnest([-1, 0, 1]) AS k))
SELECT DISTINCT a.CRD_ID AS left_crd_id, b.CRD_ID AS right_crd_id
FROM n a JOIN c b ON a.nx = b.cx AND a.ny = b.cy AND a.nz = b.cz
WHERE a.CRD_ID < b.CRD_ID
  AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) <= pow(2 * sin(radians(0.25 / 3600)), 2)"""


def _records(spark: SparkSession, d: str, every: bool) -> DataFrame:
    return load_records(table(spark, d, "raw_lines"), table(spark, d, "catalog_files"), table(spark, d, "catalog_columns"), every)


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d, False).where("reason is not null").select("file_id", "line_no", "reason").distinct()


@query
def p3_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The loadable records as (file_id, line_no, column, value), missing-value tokens as null."""
    rows = _records(spark, d, True).where("reason is null")
    cells = rows.select("file_id", "line_no", F.explode(F.arrays_zip("header", "fields")).alias("c"))
    return cells.select("file_id", "line_no", F.col("c.header").alias("column"), na_to_null(F.col("c.fields")).alias("value"))


def _drift(spark: SparkSession, d: str) -> Drift:
    return Drift(table(spark, d, "release_rows"), table(spark, d, "catalog_files"), table(spark, d, "catalog_columns"))


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _drift(spark, d).changes()


@query
def p2_table(spark: SparkSession, d: str) -> DataFrame:
    drift = _drift(spark, d)
    return drift.table(drift.changes())


@query
def p4_regions(spark: SparkSession, d: str) -> DataFrame:
    """The observed fields, as polygons about their rows, that contain each row of the catalog, whatever field it names."""
    rows = table(spark, d, "crd_catalog").select("CRD_ID", "obs_field", "ra", "dec")
    regions = field_polygons(rows, "obs_field", "ra", "dec")
    return points_in_regions(rows, regions, "CRD_ID", "ra", "dec", "obs_field", "ring")
