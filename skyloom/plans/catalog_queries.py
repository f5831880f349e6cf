"""Queries of the catalog pipeline's own operators, each over a whole table, and the SQL that each must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.healpix import pixel
from skyloom.functions.rules import Rule, compile_condition
from skyloom.functions.sky import PREVIEW_FIELDS, footprint_segments, in_fields, in_footprint
from skyloom.functions.text import BLANKS, canonical_id, na_to_null, nan_to_null, number
from skyloom.operators import validate
from skyloom.operators.consolidate import draw_one, drop_empty_columns, merge_labels, remove_duplicates, sample_rows, union_aligned
from skyloom.operators.crossmatch import match, match_catalogs, merge_neighbors, neighbor_text, self_match
from skyloom.operators.dedup import deduplicate, pieces, priority_key
from skyloom.operators.graph import components, edge_diagnostics, edges, groups
from skyloom.operators.homogenize import FLAGS, TYPES, confidence_flag
from skyloom.plans.prepare import fault_counts, ids_by_order, quality_cut
from skyloom.session import table
from skyloom.sources.catalogs import infer_types

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _catalog(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "crd_catalog")


def _rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the catalog, those delivered twice once."""
    return _catalog(spark, d).drop("loaded_at").distinct()


_B = BLANKS.replace("'", "''")
_ROWS = "rows AS (SELECT DISTINCT * EXCLUDE (loaded_at) FROM crd_catalog)"


def _canon(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[\x{{200B}}-\x{{200D}}\x{{FEFF}}]', '', 'g'), '{_B}')"


def _na(x: str) -> str:
    return f"CASE WHEN lower(trim({x}, '{_B}')) NOT IN ('', 'na', 'nan', 'null', 'none', '<na>') THEN trim({x}, '{_B}') END"


# ------------------------------------------------------- projections and types


def _no_nan(x: str) -> str:
    return f"CASE WHEN NOT isnan({x}) THEN {x} END"


# NaN is a missing value, here as everywhere.
@query(f"SELECT CRD_ID, id AS object_id, {_no_nan('ra')} AS ra, {_no_nan('dec')} AS dec, {_no_nan('z')} AS redshift, CAST(NULL AS VARCHAR) AS remark, survey AS catalog FROM crd_catalog")
def scan_project_rename(spark, d):
    numbers = [nan_to_null(F.col(c)).alias(n) for c, n in (("ra", "ra"), ("dec", "dec"), ("z", "redshift"))]
    df = _catalog(spark, d).select("CRD_ID", F.col("id").alias("object_id"), *numbers, F.col("survey").alias("catalog"))
    return df.withColumn("remark", F.lit(None).cast("string"))


@query(f"SELECT CRD_ID, {_na('id')} AS id, {_na('compared_to')} AS compared_to, {_na('instrument_type_homogenized')} AS kind FROM crd_catalog")
def string_na_normalize(spark, d):
    c = {"id": "id", "compared_to": "compared_to", "kind": "instrument_type_homogenized"}
    return _catalog(spark, d).select("CRD_ID", *[na_to_null(F.col(v)).alias(k) for k, v in c.items()])


@query(rf"""SELECT CRD_ID, CASE WHEN regexp_full_match(trim(id, '{_B}'), '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') THEN TRY_CAST(trim(id, '{_B}') AS DOUBLE) END AS number
FROM crd_catalog""")
def safe_numeric_cast(spark, d):
    return _catalog(spark, d).select("CRD_ID", number(F.col("id")).alias("number"))


_INFERRED = ("id", "ra", "z", "z_flag", "tie_result", "compared_to", "obs_field")


def _inferred(c: str) -> str:
    v, num = _na(f"CAST({c} AS VARCHAR)"), rf"regexp_full_match(v, '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?')"
    return f"""SELECT '{c}' AS "column", CASE WHEN n > 0 AND b = n THEN 'boolean' WHEN n > 0 AND k >= 0.995 * n THEN CASE WHEN f > 0 THEN 'double' ELSE 'bigint' END ELSE 'string' END AS type
FROM (SELECT count(v) AS n, count(*) FILTER (lower(v) IN ('true', 'false')) AS b, count(*) FILTER ({num}) AS k,
  count(*) FILTER ({num} AND TRY_CAST(v AS DOUBLE) <> floor(TRY_CAST(v AS DOUBLE))) AS f FROM (SELECT {v} AS v FROM crd_catalog))"""


@query(" UNION ALL ".join(map(_inferred, _INFERRED)))
def csv_type_inference(spark, d):
    types = infer_types(_catalog(spark, d).select(*[F.col(c).cast("string").alias(c) for c in _INFERRED]))
    return spark.createDataFrame(list(types.items()), "column string, type string")


@query("SELECT file_id, 'CRD007_' || CAST(row_number() OVER (ORDER BY file_id) AS VARCHAR) AS CRD_ID FROM catalog_files")
def crd_ids(spark, d):
    return ids_by_order(table(spark, d, "catalog_files").select("file_id"), "007_files", "file_id")


_FAULTS = {
    "ra_missing": "ra IS NULL OR isnan(ra)", "dec_missing": "dec IS NULL OR isnan(dec)", "ra_infinite": "isinf(ra)", "dec_infinite": "isinf(dec)",
    "ra_below": "isfinite(ra) AND ra < 0", "ra_above": "isfinite(ra) AND ra >= 360", "dec_below": "isfinite(dec) AND dec < -90", "dec_above": "isfinite(dec) AND dec > 90",
}


@query(
    "SELECT " + ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in _FAULTS.items())
    + ", CAST(count(*) FILTER (" + " OR ".join(f"({c})" for c in _FAULTS.values()) + ") AS BIGINT) AS any_fault FROM crd_catalog"
)
def coord_validation_counts(spark, d):
    return fault_counts(_catalog(spark, d))


@query("SELECT CRD_ID, z_flag_homogenized FROM crd_catalog WHERE z_flag_homogenized >= 3 AND NOT isnan(z_flag_homogenized)")
def quality_cut_rows(spark, d):
    return quality_cut(_catalog(spark, d), 3).select("CRD_ID", "z_flag_homogenized")


# -------------------------------------------------------------- rule language


@query("""SELECT CRD_ID, CASE z_flag WHEN 1 THEN 0.0 WHEN 2 THEN 1.0 WHEN 3 THEN 3.0 WHEN 4 THEN 4.0 END::DOUBLE AS flag,
  CASE WHEN lower(trim(instrument_type)) = 'spec' THEN 's' ELSE 'p' END AS kind FROM crd_catalog""")
def rule_direct_map(spark, d):
    df = _catalog(spark, d)
    flag = Rule(direct={1: 0, 2: 1, "3": 3, 4.0: 4}).column("z_flag", df.schema, (), "double")
    return df.select("CRD_ID", flag.alias("flag"), Rule(direct={"Spec": "s"}, default="p").column("instrument_type", df.schema, (), "string").alias("kind"))


@query("""SELECT CRD_ID, CASE WHEN z_err >= 0.001 AND NOT isnan(z_err) AND z > 0 AND NOT isnan(z) THEN 3.0
  WHEN z_flag = 4 AND z_flag <> 0 THEN 4.0 WHEN z > 0.5 AND NOT isnan(z) THEN 2.0 ELSE 0.0 END::DOUBLE AS flag FROM crd_catalog""")
def rule_conditions_last_match(spark, d):
    df = _catalog(spark, d)
    rule = Rule(conditions=[("z > 0.5", 2), ("(z_flag == 4) and z_flag != 0", 4), ("z_err >= 0.001 and z > 0", 3)], default=0)
    return df.select("CRD_ID", rule.column("z_flag", df.schema, ("z", "z_flag", "z_err"), "double").alias("flag"))


@query("SELECT p_partkey, p_size % 10 = 4 AS hit FROM part")
def rule_ones_digit(spark, d):
    df = table(spark, d, "part")
    return df.select("p_partkey", compile_condition("np.trunc(float(p_size)) - 10*np.trunc(np.trunc(float(p_size))/10) == 4", df.schema).alias("hit"))


@query("""SELECT CRD_ID, coalesce(z >= 0.1 AND z < 0.7 AND NOT isnan(z), false) AND NOT coalesce(isfinite(z_err), false) AS hit,
  coalesce(z_err <> 0.5 OR isnan(z_err), true) AS differs FROM crd_catalog""")
def rule_chained_not_isfinite(spark, d):
    df = _catalog(spark, d)
    hit = compile_condition("0.1 <= z < 0.7 and not np.isfinite(z_err)", df.schema)
    return df.select("CRD_ID", hit.alias("hit"), compile_condition("z_err != 0.5", df.schema).alias("differs"))


@query("SELECT CRD_ID, coalesce(id[-1] = '3' AND length(id) > 2 AND id[1] = 'S', false) AS hit FROM crd_catalog")
def rule_str_index(spark, d):
    df = _catalog(spark, d)
    return df.select("CRD_ID", compile_condition("str(id)[-1] == '3' and len(id) > 2 and str(id)[0] == 'S'", df.schema).alias("hit"))


@query("""SELECT CRD_ID, CASE WHEN isnan(q) THEN NULL WHEN q = 0 THEN 0.0 WHEN q > 0 AND q < 0.7 THEN 1.0 WHEN q >= 0.7 AND q < 0.9 THEN 2.0
  WHEN q >= 0.9 AND q < 0.99 THEN 3.0 WHEN q >= 0.99 AND q <= 1 THEN 4.0 END::DOUBLE AS flag FROM (SELECT CRD_ID, z AS q FROM crd_catalog)""")
def quality_fast_path(spark, d):
    return _catalog(spark, d).select("CRD_ID", confidence_flag(F.col("z")).alias("flag"))


@query("SELECT DISTINCT upper(trim(survey)) AS survey FROM crd_catalog WHERE upper(trim(survey)) NOT IN (SELECT upper(survey) FROM catalog_columns WHERE survey IS NOT NULL)")
def survey_coverage(spark, d):
    known = table(spark, d, "catalog_columns").select(F.upper("survey").alias("survey"))
    return _catalog(spark, d).select(F.upper(F.trim("survey")).alias("survey")).where("survey is not null").distinct().join(known, "survey", "left_anti")


@query("""SELECT DISTINCT upper(trim(survey)) AS survey FROM crd_catalog WHERE upper(trim(survey)) NOT IN (SELECT upper(survey) FROM catalog_columns WHERE survey IS NOT NULL AND source < '010')""")
def survey_coverage_by_some(spark, d):
    """The surveys that the catalogs before number 010 don't name."""
    known = table(spark, d, "catalog_columns").where("source < '010'").select(F.upper("survey").alias("survey"))
    return _catalog(spark, d).select(F.upper(F.trim("survey")).alias("survey")).where("survey is not null").distinct().join(known, "survey", "left_anti")


@query("""SELECT source, count(*) FILTER (z_flag_homogenized IS NOT NULL AND NOT isnan(z_flag_homogenized) AND z_flag_homogenized NOT IN (0, 1, 2, 3, 4, 6)) AS flags,
  count(*) FILTER (instrument_type_homogenized NOT IN ('s', 'g', 'p')) AS types FROM crd_catalog GROUP BY source""")
def domain_check(spark, d):
    flag = nan_to_null(F.col("z_flag_homogenized"))
    bad = [F.count_if(~flag.isin(*FLAGS)).alias("flags"), F.count_if(~F.col("instrument_type_homogenized").isin(*TYPES)).alias("types")]
    return _catalog(spark, d).groupBy("source").agg(*bad)


# ------------------------------------------------------------------ positions

_XYZ = "cos(radians(dec)) * cos(radians(ra)) AS x, cos(radians(dec)) * sin(radians(ra)) AS y, sin(radians(dec)) AS z3"
_VALID = "NOT isnan(ra) AND NOT isnan(dec) AND ra >= 0 AND ra < 360 AND dec >= -90 AND dec <= 90"


@query("SELECT CRD_ID, ra, dec, CAST(coalesce(" + " OR ".join(
    f"degrees(acos(greatest(-1, least(1, sin(radians(dec)) * sin(radians({b}e0)) + cos(radians(dec)) * cos(radians({b}e0)) * cos(radians(ra) - radians({a}e0)))))) <= {r}"
    for a, b, r in PREVIEW_FIELDS
) + ", false) AS BIGINT) AS inside FROM (SELECT CRD_ID, ra, dec FROM crd_catalog WHERE " + _VALID + ")")
def field_flag(spark, d):
    df = _catalog(spark, d).where("ra >= 0 and ra < 360 and dec between -90 and 90")
    return df.select("CRD_ID", "ra", "dec", in_fields(F.col("ra"), F.col("dec")).alias("inside"))


@query(f"""WITH v AS (SELECT CRD_ID, ra, dec, source FROM crd_catalog WHERE {_VALID}),
t AS (SELECT (floor(ra / 0.5) + 0.5) * 0.5e0 AS mid, max(dec) + 1 AS lim FROM v WHERE source = '008_desi_dr1' AND dec < 30 GROUP BY floor(ra / 0.5)),
s AS (SELECT mid AS lo, lim AS a, coalesce(lead(mid) OVER (ORDER BY mid), (SELECT min(mid) FROM t) + 360) AS hi, coalesce(lead(lim) OVER (ORDER BY mid), (SELECT arg_min(lim, mid) FROM t)) AS b FROM t),
w AS (SELECT lo, hi, a, (b - a) / (hi - lo) AS m FROM s UNION ALL SELECT lo - 360, hi - 360, a, (b - a) / (hi - lo) FROM s WHERE hi > 360)
SELECT CRD_ID, ra, dec, CAST(coalesce(dec <= a + m * (ra - lo), false) AS BIGINT) AS inside FROM v LEFT JOIN w ON ra >= lo AND ra < hi""")
def footprint_flag(spark, d):
    df = _catalog(spark, d).where("ra >= 0 and ra < 360 and dec between -90 and 90").select("CRD_ID", "ra", "dec", "source")
    border = footprint_segments(df.where("source = '008_desi_dr1' and dec < 30"), "ra", "dec")
    return in_footprint(df, border, "ra", "dec", "inside").select("CRD_ID", "ra", "dec", "inside")


def _pairs_sql(left: str, right: str, on: str) -> str:
    return f"""v AS (SELECT DISTINCT CRD_ID, source, {_XYZ} FROM crd_catalog WHERE CRD_ID IS NOT NULL AND {_VALID}),
c AS (SELECT *, floor(x * 1e5) AS cx, floor(y * 1e5) AS cy, floor(z3 * 1e5) AS cz FROM v),
nb AS (SELECT c.*, cx + i AS nx, cy + j AS ny, cz + k AS nz FROM c, (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j), (SELECT unnest([-1, 0, 1]) AS k)),
pr AS (SELECT a.CRD_ID AS left_id, b.CRD_ID AS right_id, b.source AS right_source, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z3 - b.z3) * (a.z3 - b.z3) AS d2
  FROM nb a JOIN c b ON a.nx = b.cx AND a.ny = b.cy AND a.nz = b.cz WHERE {left} AND {right} AND {on}
  AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z3 - b.z3) * (a.z3 - b.z3) <= pow(2 * sin(radians(0.25 / 3600)), 2))"""


@query(f"WITH {_pairs_sql("a.source < '008'", "b.source >= '008'", 'true')} SELECT left_id, right_id FROM pr")
def crossmatch_radius(spark, d):
    df = _rows(spark, d)
    return match(df.where("source < '008'"), df.where("source >= '008'"), 0.5).select("left_id", "right_id")


@query(f"""WITH {_pairs_sql('true', 'true', 'a.source <> b.source')}
SELECT left_id, right_id FROM pr QUALIFY row_number() OVER (PARTITION BY left_id, right_source ORDER BY d2, right_id) <= 2""")
def crossmatch_knn(spark, d):
    return match_catalogs(_rows(spark, d), 0.5, 2)


@query(f"""WITH {_pairs_sql('true', 'true', 'true')}, k AS (SELECT * FROM pr QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY d2, right_id) <= 10)
SELECT left_id, right_id FROM k WHERE left_id <> right_id""")
def self_match_rows(spark, d):
    return self_match(_rows(spark, d), 0.5, 10)


@query(f"""WITH {_pairs_sql('true', 'true', 'a.source <> b.source')}
SELECT left_id AS CRD_ID, string_agg(right_id, ', ' ORDER BY right_id) AS compared_to FROM pr GROUP BY left_id""")
def compared_to_strings(spark, d):
    return neighbor_text(match_catalogs(_rows(spark, d), 0.5, 1_000_000))


@query(f"""WITH {_ROWS}, {_pairs_sql('true', 'true', 'a.CRD_ID <> b.CRD_ID')},
t AS (SELECT CRD_ID, trim(unnest(string_split(coalesce(compared_to, ''), ',')), '{_B}') AS n FROM rows UNION SELECT left_id, right_id FROM pr),
g AS (SELECT CRD_ID, string_agg(n, ', ' ORDER BY n) AS compared_to FROM (SELECT DISTINCT CRD_ID, n FROM t WHERE n <> '' AND n <> CRD_ID) GROUP BY CRD_ID)
SELECT r.CRD_ID, g.compared_to FROM (SELECT DISTINCT CRD_ID FROM rows) r LEFT JOIN g USING (CRD_ID)""")
def neighbors_merged(spark, d):
    df = _rows(spark, d).select("CRD_ID", "ra", "dec", "compared_to")
    found = neighbor_text(match(df, df, 0.5).where("left_id <> right_id"))
    return merge_neighbors(df, found).select("CRD_ID", "compared_to")


def _pixel_sql(order: int) -> str:
    side = 1 << order
    spread = lambda c: " + ".join(f"((({c})::BIGINT >> {k}) & 1) * {1 << 2 * k}" for k in range(order))
    return f"""WITH p AS (SELECT CRD_ID, sin(radians(dec)) AS z, ra / 90.0e0 AS t FROM crd_catalog WHERE {_VALID}),
q AS (SELECT *, CAST(floor({side} * (t + 0.5e0) - {side} * 0.75e0 * z) AS BIGINT) AS u, CAST(floor({side} * (t + 0.5e0) + {side} * 0.75e0 * z) AS BIGINT) AS w,
  CAST(least(floor(t), 3) AS BIGINT) AS k, {side} * sqrt(3 * (1 - abs(z))) AS r FROM p),
f AS (SELECT *, u // {side} AS fu, w // {side} AS fw, CAST(least(floor((t - k) * r), {side - 1}) AS BIGINT) AS i, CAST(least(floor((1 - (t - k)) * r), {side - 1}) AS BIGINT) AS o FROM q),
x AS (SELECT CRD_ID, CASE WHEN abs(z) <= 2.0e0 / 3 THEN CASE WHEN fu = fw THEN fu % 4 + 4 WHEN fu < fw THEN fu ELSE fw + 8 END WHEN z > 0 THEN k ELSE k + 8 END AS face,
  CASE WHEN abs(z) <= 2.0e0 / 3 THEN w % {side} WHEN z > 0 THEN {side - 1} - o ELSE i END AS px,
  CASE WHEN abs(z) <= 2.0e0 / 3 THEN {side - 1} - u % {side} WHEN z > 0 THEN {side - 1} - i ELSE o END AS py FROM f)
SELECT CAST(face * {side * side} + {spread('px')} + 2 * ({spread('py')}) AS BIGINT) AS pixel, count(*) AS "rows" FROM x GROUP BY 1"""


@query(_pixel_sql(4))
def healpix_counts(spark, d):
    df = _catalog(spark, d).where("ra >= 0 and ra < 360 and dec between -90 and 90")
    return df.groupBy(pixel(F.col("ra"), F.col("dec"), 4).alias("pixel")).agg(F.count(F.lit(1)).alias("rows"))


@query(f"WITH {_ROWS} SELECT ra, dec, count(*) AS \"rows\" FROM rows WHERE {_VALID} GROUP BY ra, dec HAVING count(*) > 1")
def duplicate_positions(spark, d):
    df = _rows(spark, d).where("ra >= 0 and ra < 360 and dec between -90 and 90")
    return df.groupBy("ra", "dec").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


# -------------------------------------------------------------- graph and ties

_IDS = f"ids AS (SELECT {_canon('CRD_ID')} AS CRD_ID, bool_or(coalesce(z_flag_homogenized = 6, false)) AS star FROM crd_catalog GROUP BY 1)"
_NEIGHBORS = f"""n AS (SELECT DISTINCT CRD_ID, nb FROM (SELECT {_canon('CRD_ID')} AS CRD_ID, {_canon("unnest(string_split(compared_to, ','))")} AS nb FROM crd_catalog)
  WHERE nb <> '' AND nb <> CRD_ID)"""
_EDGES = f"""{_IDS}, {_NEIGHBORS},
e AS (SELECT DISTINCT least(CRD_ID, nb) AS a, greatest(CRD_ID, nb) AS b FROM n
  WHERE CRD_ID IN (SELECT CRD_ID FROM ids WHERE NOT star) AND nb IN (SELECT CRD_ID FROM ids WHERE NOT star))"""
_COMPONENTS = f"""{_EDGES}, w AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a, b FROM w UNION SELECT r.a, w.b FROM reach r JOIN w ON r.b = w.a),
comp AS (SELECT a AS id, least(a, min(b)) AS component FROM reach GROUP BY a)"""
_GROUPS = f"""{_COMPONENTS},
lab AS (SELECT i.CRD_ID, star, coalesce(component, CASE WHEN NOT star THEN i.CRD_ID END) AS g FROM ids i LEFT JOIN comp ON id = i.CRD_ID),
beside AS (SELECT CRD_ID, nb FROM n UNION SELECT nb, CRD_ID FROM n),
grp AS (SELECT l.CRD_ID, l.star, coalesce(l.g, (SELECT min(o.g) FROM beside b JOIN lab o ON o.CRD_ID = b.nb WHERE b.CRD_ID = l.CRD_ID), l.CRD_ID) AS "group" FROM lab l)"""
_SCORED = f"""{_GROUPS},
one AS (SELECT DISTINCT {_canon('CRD_ID')} AS CRD_ID, z, z_flag_homogenized AS f, instrument_type_homogenized AS t, tie_result AS came FROM crd_catalog),
sc AS (SELECT one.*, star, "group", CASE WHEN f IS NULL OR isnan(f) THEN -1e9 ELSE f END AS s1,
  CASE trim(t, '{_B}') WHEN 's' THEN 3 WHEN 'g' THEN 2 WHEN 'p' THEN 1 ELSE 0 END AS s2 FROM one JOIN grp USING (CRD_ID)),
m1 AS (SELECT * FROM sc WHERE NOT star QUALIFY s1 = max(s1) OVER (PARTITION BY "group")),
m2 AS (SELECT * FROM m1 QUALIFY s2 = max(s2) OVER (PARTITION BY "group")),
cut AS (SELECT "group", CRD_ID, CASE WHEN z - lag(z) OVER (PARTITION BY "group" ORDER BY z, CRD_ID) > 0.001 THEN 1 ELSE 0 END AS c, z FROM m2 WHERE z IS NOT NULL AND NOT isnan(z)),
pc AS (SELECT *, sum(c) OVER (PARTITION BY "group" ORDER BY z, CRD_ID ROWS UNBOUNDED PRECEDING) AS p FROM cut),
stay AS (SELECT "group", min(CRD_ID) AS CRD_ID FROM pc GROUP BY "group", p UNION SELECT "group", CRD_ID FROM m2 WHERE z IS NULL OR isnan(z)),
cnt AS (SELECT "group", count(*) AS k FROM stay GROUP BY "group"), sz AS (SELECT "group", count(*) AS size FROM grp GROUP BY "group"),
tie AS (SELECT s.CRD_ID, s."group", s.came, s.star, CASE WHEN s.star THEN 3 WHEN size = 1 THEN 1 WHEN st.CRD_ID IS NOT NULL THEN CASE WHEN k = 1 THEN 1 ELSE 2 END ELSE 0 END AS tie_result
  FROM sc s JOIN sz USING ("group") LEFT JOIN cnt USING ("group") LEFT JOIN stay st ON st.CRD_ID = s.CRD_ID)"""
_PRIORITIES = ["z_flag_homogenized", "instrument_type_homogenized"]
_REAL = "(SELECT CRD_ID FROM n WHERE nb NOT IN (SELECT CRD_ID FROM ids WHERE star))"
_RESTORED = f"""{_SCORED}, fin AS (SELECT CRD_ID, "group", CASE WHEN NOT star AND CRD_ID NOT IN {_REAL} THEN coalesce(came, 1) ELSE tie_result END AS tie_result FROM tie)"""


@query(f"WITH {_EDGES} SELECT a, b FROM e")
def edges_nonstar(spark, d):
    return edges(_catalog(spark, d))


@query(f"""WITH {_EDGES}, l AS (SELECT {_canon('CRD_ID')} AS a, {_canon("unnest(string_split(compared_to, ','))")} AS b FROM crd_catalog),
k AS (SELECT l.*, x.star AS sa, y.star AS sb, y.CRD_ID IS NULL AS gone FROM l LEFT JOIN ids x ON x.CRD_ID = l.a LEFT JOIN ids y ON y.CRD_ID = l.b WHERE b <> '' AND a IS NOT NULL)
SELECT count(*) AS named, count(*) FILTER (a = b) AS of_itself, count(*) FILTER (a <> b AND sa) AS from_star, count(*) FILTER (a <> b AND NOT sa AND coalesce(sb, false)) AS to_star,
  count(*) FILTER (a <> b AND NOT sa AND gone) AS to_absent, count(*) FILTER (a <> b AND NOT sa AND NOT gone AND NOT sb) AS linking,
  (SELECT count(*) FROM e) AS edges FROM k""")
def edge_counts(spark, d):
    return edge_diagnostics(_catalog(spark, d))


@query(f"WITH RECURSIVE {_COMPONENTS} SELECT id, component FROM comp")
def connected_components(spark, d):
    return components(edges(_catalog(spark, d)))


@query(f'WITH RECURSIVE {_GROUPS} SELECT CRD_ID, "group" FROM grp')
def star_bridging(spark, d):
    return groups(_catalog(spark, d))


@query("""WITH r AS (SELECT DISTINCT CRD_ID, obs_field, CASE WHEN z_flag IS NULL OR isnan(z_flag) THEN -1e9 ELSE z_flag END AS s1,
  CASE WHEN z_err IS NULL OR isnan(z_err) THEN -1e9 ELSE z_err END AS s2 FROM crd_catalog WHERE obs_field IS NOT NULL),
a AS (SELECT * FROM r QUALIFY s1 = max(s1) OVER (PARTITION BY obs_field))
SELECT obs_field, CRD_ID FROM a QUALIFY s2 = max(s2) OVER (PARTITION BY obs_field)""")
def tie_priority(spark, d):
    rows = _rows(spark, d).where("obs_field is not null").withColumn("key", priority_key([F.col("z_flag"), F.col("z_err")], F.lit(True)))
    best = rows.groupBy("obs_field").agg(F.max("key").alias("best"))
    return rows.join(best, "obs_field").where("key = best").select("obs_field", "CRD_ID")


@query("""WITH r AS (SELECT DISTINCT CRD_ID, source, z FROM crd_catalog),
c AS (SELECT *, CASE WHEN z - lag(z) OVER (PARTITION BY source ORDER BY z, CRD_ID) > 0.001 THEN 1 ELSE 0 END AS c FROM r WHERE z IS NOT NULL AND NOT isnan(z)),
p AS (SELECT *, sum(c) OVER (PARTITION BY source ORDER BY z, CRD_ID ROWS UNBOUNDED PRECEDING) AS p FROM c)
SELECT source, min(CRD_ID) AS CRD_ID FROM p GROUP BY source, p UNION ALL SELECT source, CRD_ID FROM r WHERE z IS NULL OR isnan(z)""")
def dz_collapse(spark, d):
    rows = _rows(spark, d).select(F.col("source").alias("group"), F.col("CRD_ID").alias("id"), F.col("z").alias("x"))
    return pieces(rows, 0.001).select(F.col("group").alias("source"), F.col("id").alias("CRD_ID"))


def _labels(spark, d, restore: bool = False) -> DataFrame:
    return deduplicate(_catalog(spark, d), _PRIORITIES, 0.001, restore=restore)


@query(f'WITH RECURSIVE {_SCORED} SELECT CRD_ID, "group", tie_result FROM tie')
def tie_result(spark, d):
    return _labels(spark, d)


@query(f'WITH RECURSIVE {_RESTORED} SELECT CRD_ID, "group", tie_result FROM fin')
def guard_restore(spark, d):
    return _labels(spark, d, restore=True)


@query(f"""WITH RECURSIVE {_SCORED} SELECT c.CRD_ID, {_no_nan('c.z')} AS z, t."group", coalesce(t.tie_result, c.tie_result) AS tie_result
FROM (SELECT CRD_ID, z, tie_result FROM crd_catalog) c LEFT JOIN (SELECT * FROM tie WHERE tie_result IN (1, 2)) t ON t.CRD_ID = c.CRD_ID""")
def merged_labels(spark, d):
    labels = _labels(spark, d).where("tie_result in (1, 2)")
    return merge_labels(_catalog(spark, d).select("CRD_ID", nan_to_null(F.col("z")).alias("z"), "tie_result"), labels).select("CRD_ID", "z", "group", "tie_result")


@query(f"WITH RECURSIVE {_SCORED} SELECT CRD_ID, tie_result FROM tie WHERE tie_result = 1")
def remove_all(spark, d):
    return remove_duplicates(_labels(spark, d), "remove_all").select("CRD_ID", "tie_result")


@query(f"WITH RECURSIVE {_SCORED} SELECT CRD_ID, tie_result FROM tie WHERE tie_result IN (1, 2)")
def keep_all(spark, d):
    return remove_duplicates(_labels(spark, d), "keep_all").select("CRD_ID", "tie_result")


@query(f"""WITH RECURSIVE {_SCORED}, dr AS (SELECT "group", count(*) FILTER (tie_result = 1) AS won, min(CASE WHEN tie_result = 2 THEN md5('7:' || CRD_ID) || ':' || CRD_ID END) AS drawn FROM tie GROUP BY "group")
SELECT CRD_ID, CASE WHEN tie_result = 2 AND won = 0 THEN CAST(md5('7:' || CRD_ID) || ':' || CRD_ID = drawn AS INTEGER) ELSE tie_result END AS tie_result FROM tie JOIN dr USING ("group")""")
def draw_one_rows(spark, d):
    return draw_one(_labels(spark, d), seed=7).select("CRD_ID", "tie_result")


# --------------------------------------------------------- unions and columns


@query("""SELECT CRD_ID AS key, CAST(tie_result AS BIGINT) AS n, z, CAST(NULL AS VARCHAR) AS fmt FROM crd_catalog
UNION ALL SELECT CAST(file_id AS VARCHAR), release_no, NULL, format FROM catalog_files""")
def unioned_aligned(spark, d):
    a = _catalog(spark, d).select(F.col("CRD_ID").alias("key"), F.col("tie_result").alias("n"), "z")
    b = table(spark, d, "catalog_files").select(F.col("file_id").alias("key"), F.col("release_no").cast("long").alias("n"), F.col("format").alias("fmt"))
    return union_aligned(a, b)


@query("SELECT CRD_ID, id, source FROM crd_catalog")
def empty_columns_dropped(spark, d):
    df = _catalog(spark, d).select("CRD_ID", "id", F.lit(None).cast("double").alias("spare"), F.lit("  ").alias("blank"), "source")
    return drop_empty_columns(df)


@query(f"""SELECT CRD_ID, source, z FROM (SELECT DISTINCT CRD_ID, source, z FROM crd_catalog WHERE z IS NOT NULL AND NOT isnan(z)) ORDER BY z DESC, CRD_ID LIMIT 100""")
def highest_redshifts(spark, d):
    """The 100 rows with the highest redshifts."""
    rows = _rows(spark, d).where("z is not null and not isnan(z)").select("CRD_ID", "source", "z").distinct()
    return rows.orderBy(F.desc("z"), "CRD_ID").limit(100)


@query("SELECT CRD_ID, id FROM (SELECT DISTINCT CRD_ID, id FROM crd_catalog) ORDER BY md5('42:' || CRD_ID), CRD_ID LIMIT 1000")
def reservoir_sample(spark, d):
    return sample_rows(_catalog(spark, d).select("CRD_ID", "id").distinct(), "CRD_ID", 1000)


# ------------------------------------------------------------------ validation


@query(f"""WITH r AS (SELECT DISTINCT {_canon('CRD_ID')} AS CRD_ID, source, round_even(ra, 2) AS ra_cell, round_even(dec, 2) AS dec_cell FROM crd_catalog
  WHERE ra IS NOT NULL AND dec IS NOT NULL AND NOT isnan(ra) AND NOT isnan(dec)), {_NEIGHBORS},
s AS (SELECT source, ra_cell, dec_cell, count(*) AS n FROM r GROUP BY ALL HAVING count(*) > 1),
l AS (SELECT a.source, a.ra_cell, a.dec_cell, least(a.CRD_ID, b.CRD_ID) AS lo, greatest(a.CRD_ID, b.CRD_ID) AS hi, count(*) AS ways
  FROM n JOIN r a ON a.CRD_ID = n.CRD_ID JOIN r b ON b.CRD_ID = n.nb AND b.source = a.source AND b.ra_cell = a.ra_cell AND b.dec_cell = a.dec_cell GROUP BY ALL),
f AS (SELECT source, ra_cell, dec_cell, count(*) FILTER (ways = 2) AS both_ways, count(*) FILTER (ways = 1) AS one_way FROM l GROUP BY ALL)
SELECT s.source, s.ra_cell, s.dec_cell, n AS "rows", CAST(n * (n - 1) // 2 AS BIGINT) AS pairs, coalesce(both_ways, 0) AS both_ways, coalesce(one_way, 0) AS one_way,
  CAST(n * (n - 1) // 2 - coalesce(both_ways, 0) - coalesce(one_way, 0) AS BIGINT) AS missing FROM s LEFT JOIN f USING (source, ra_cell, dec_cell)""")
def intra_source_cells(spark, d):
    return validate.intra_source_cells(_rows(spark, d), places=2)


_ALIVE = "tie IN (1, 2)"


@query(f"""WITH RECURSIVE {_COMPONENTS},
r AS (SELECT DISTINCT {_canon('c.CRD_ID')} AS CRD_ID, coalesce(component, {_canon('c.CRD_ID')}) AS component, coalesce(z_flag_homogenized = 6, false) AS star, coalesce(tie_result, -1) AS tie,
  CASE WHEN isnan(z) THEN NULL ELSE z END AS z, CASE WHEN z_flag_homogenized IS NULL OR isnan(z_flag_homogenized) THEN -1 ELSE z_flag_homogenized END AS flag,
  CASE trim(instrument_type_homogenized, '{_B}') WHEN 's' THEN 3 WHEN 'g' THEN 2 WHEN 'p' THEN 1 ELSE 0 END AS score FROM crd_catalog c LEFT JOIN comp ON comp.id = {_canon('c.CRD_ID')}),
m AS (SELECT *, flag * 10 + score AS k, count(*) OVER (PARTITION BY component) AS n, max(flag) OVER (PARTITION BY component) AS top FROM r WHERE NOT star AND tie <> 3),
q AS (SELECT a.component, a.tie AS ta, b.tie AS tb, a.k AS ka, b.k AS kb, coalesce(abs(a.z - b.z) <= 0.001, false) AS near FROM m a JOIN m b ON a.component = b.component AND a.CRD_ID <> b.CRD_ID
  WHERE a.n = 2 AND (a.tie > b.tie OR (a.tie = b.tie AND a.CRD_ID < b.CRD_ID))),
t AS (SELECT *, max(CASE WHEN flag = top THEN score END) OVER (PARTITION BY component) AS top_score, {_ALIVE} AS stays FROM m WHERE n > 2),
s AS (SELECT component, count(*) FILTER (stays) AS k, count(*) FILTER (tie = 1) AS ones FROM t GROUP BY component)
SELECT CASE WHEN star THEN 'STAR_MUST_BE_3' ELSE 'NONSTAR_MUST_NOT_BE_3' END AS rule, component, CRD_ID FROM r WHERE star <> (tie = 3)
UNION ALL SELECT 'PAIR_1v0_PRIORITY', component, NULL FROM q WHERE ta = 1 AND tb = 0 AND (ka < kb OR (ka = kb AND NOT near))
UNION ALL SELECT 'PAIR_2v2_TIE_CONSISTENCY', component, NULL FROM q WHERE ta = 2 AND tb = 2 AND (ka <> kb OR near)
UNION ALL SELECT 'PAIR_0v0_SUSPECT', component, NULL FROM q WHERE ta = 0 AND tb = 0
UNION ALL SELECT 'PAIR_INVALID_TIE_PATTERN', component, NULL FROM q WHERE NOT ((ta = 1 AND tb = 0) OR (ta = tb AND ta IN (0, 2)))
UNION ALL SELECT DISTINCT 'GROUP_FLAG_DOMINANCE', component, NULL FROM t WHERE stays AND flag < top
UNION ALL SELECT DISTINCT 'GROUP_TYPE_DOMINANCE', component, NULL FROM t WHERE stays AND score < top_score
UNION ALL SELECT DISTINCT 'GROUP_DELTZ_INDEPENDENCE', a.component, NULL FROM t a JOIN t b ON a.component = b.component AND a.CRD_ID < b.CRD_ID
  WHERE a.stays AND b.stays AND a.flag = a.top AND b.flag = b.top AND a.score = a.top_score AND b.score = b.top_score AND abs(a.z - b.z) <= 0.001
UNION ALL SELECT 'GROUP_NO_SURVIVOR_SUSPECT', component, NULL FROM s WHERE k = 0
UNION ALL SELECT 'GROUP_SINGLE_SURVIVOR_MUST_BE_1', component, NULL FROM s WHERE k = 1 AND ones = 0
UNION ALL SELECT 'GROUP_MULTI_SURVIVOR_MUST_BE_2', component, NULL FROM s WHERE k > 1 AND ones > 0""")
def tie_rule_findings(spark, d):
    return validate.tie_findings(_rows(spark, d))


@query(SQL["tie_rule_findings"])
def tie_rule_violations(spark, d):
    """The same under its older name, by which it is timed."""
    return tie_rule_findings(spark, d)


@query(f"""WITH r AS (SELECT DISTINCT CRD_ID, tie_result, coalesce(z_flag_homogenized = 6, false) AS star, ({_na('compared_to')}) IS NULL AS alone FROM crd_catalog)
SELECT CRD_ID, tie_result, CASE WHEN star AND coalesce(tie_result, -1) <> 3 THEN 'star is not 3' WHEN NOT star AND tie_result = 3 THEN '3 is no star' ELSE 'no neighbors but not 1' END AS problem
FROM r WHERE (star AND coalesce(tie_result, -1) <> 3) OR (NOT star AND tie_result = 3) OR (alone AND NOT star AND coalesce(tie_result, -1) <> 1)""")
def na_compared_rule(spark, d):
    return validate.unlinked_rule(_rows(spark, d))


@query("""SELECT CASE WHEN z_flag_homogenized IS NULL OR isnan(z_flag_homogenized) THEN 'none' ELSE CAST(CAST(z_flag_homogenized AS INTEGER) AS VARCHAR) END AS flag,
  count(*) FILTER (tie_result = 0) AS tie_0, count(*) FILTER (tie_result = 1) AS tie_1, count(*) FILTER (tie_result = 2) AS tie_2, count(*) FILTER (tie_result = 3) AS tie_3,
  count(*) FILTER (tie_result IS NULL OR tie_result NOT BETWEEN 0 AND 3) AS other FROM crd_catalog GROUP BY 1""")
def tie_crosstab(spark, d):
    return validate.tie_crosstab(_catalog(spark, d))


@query(f"""WITH RECURSIVE {_SCORED}, a AS (SELECT DISTINCT CRD_ID, coalesce(tie_result, -1) AS b FROM crd_catalog)
SELECT b AS before, coalesce(t.tie_result, -2) AS after, count(*) AS "rows" FROM a LEFT JOIN tie t USING (CRD_ID) GROUP BY 1, 2""")
def tie_preservation(spark, d):
    return validate.tie_preservation(_rows(spark, d).select("CRD_ID", "tie_result"), _labels(spark, d))


@query(f"""WITH {_ROWS} SELECT obs_field, count(*) AS "rows" FROM (SELECT obs_field, ({_na('compared_to')}) IS NOT NULL AS named FROM rows WHERE z_flag_homogenized = 0)
GROUP BY obs_field HAVING count(*) > 1 AND count(*) FILTER (named) = 0""")
def group_integrity(spark, d):
    return validate.group_integrity(_rows(spark, d).where("z_flag_homogenized = 0"), "obs_field")


_CASE_COLUMNS = f"""CASE WHEN isfinite(z) THEN z END AS z, nullif(trim(survey, '{_B}'), '') AS survey, CASE WHEN NOT isnan(z_flag_homogenized) THEN z_flag_homogenized END AS flag,
  nullif(trim(instrument_type_homogenized, '{_B}'), '') AS kind, lower(nullif(trim(source, '{_B}'), '')) AS source"""
_CASES = """g AS (SELECT g, count(*) AS n, coalesce(max(z) - min(z), 0) <= 0.001 AS small, count(DISTINCT survey) AS sv, count(DISTINCT flag) AS fl, count(DISTINCT kind) AS ki,
  count(DISTINCT source) AS so, count(source) AS ns FROM r GROUP BY g HAVING count(*) > 1),
b AS (SELECT CASE WHEN n = 2 THEN 'CASE1' ELSE 'CASE2' END || CASE WHEN small THEN '_small' ELSE '_large' END || CASE WHEN sv = 1 THEN '_same' ELSE '_diff' END AS bucket, n FROM g
  UNION ALL SELECT CASE WHEN n = 2 THEN 'TIE_FLAG_TYPE_BREAK_PAIR' ELSE 'TIE_FLAG_TYPE_BREAK_GROUP' END, n FROM g WHERE fl = 1 AND ki > 1 AND sv > 1
  UNION ALL SELECT 'SAME_FLAG_DIFF_TYPE', n FROM g WHERE fl = 1 AND ki > 1 AND n > 2 UNION ALL SELECT 'SAME_SOURCE_PAIR', n FROM g WHERE n = 2 AND ns = 2 AND so = 1)
SELECT bucket, count(*) AS groups, CAST(sum(n) AS BIGINT) AS "rows" FROM b GROUP BY 1"""


@query(f"""WITH RECURSIVE {_COMPONENTS}, r AS (SELECT DISTINCT {_canon('c.CRD_ID')} AS CRD_ID, coalesce(component, {_canon('c.CRD_ID')}) AS g, {_CASE_COLUMNS}
  FROM crd_catalog c LEFT JOIN comp ON comp.id = {_canon('c.CRD_ID')} WHERE NOT coalesce(z_flag_homogenized = 6, false)), {_CASES}""")
def group_buckets(spark, d):
    return validate.group_cases(validate.nonstar_components(_rows(spark, d)), "component")


def _grouped(spark, d) -> DataFrame:
    """The rows of the catalog with the groups of all labels."""
    return _rows(spark, d).withColumn("CRD_ID", canonical_id(F.col("CRD_ID"))).join(_labels(spark, d).select("CRD_ID", "group"), "CRD_ID")


@query(f"""WITH RECURSIVE {_NEIGHBORS}, w AS (SELECT CRD_ID AS a, nb AS b FROM n UNION SELECT nb, CRD_ID FROM n),
reach AS (SELECT a, b FROM w UNION SELECT r.a, w.b FROM reach r JOIN w ON r.b = w.a), comp AS (SELECT a AS id, least(a, min(b)) AS component FROM reach GROUP BY a),
r AS (SELECT DISTINCT {_canon('c.CRD_ID')} AS CRD_ID, component AS g, {_CASE_COLUMNS} FROM crd_catalog c JOIN comp ON comp.id = {_canon('c.CRD_ID')} WHERE ({_na('compared_to')}) IS NOT NULL), {_CASES}""")
def linked_group_cases(spark, d):
    return validate.group_cases(validate.linked_groups(_rows(spark, d)), "component")


@query(f"""WITH RECURSIVE {_SCORED}, r AS (SELECT DISTINCT tie.CRD_ID, "group" AS g, {_CASE_COLUMNS} FROM crd_catalog c JOIN tie ON tie.CRD_ID = {_canon('c.CRD_ID')}), {_CASES}""")
def label_group_cases(spark, d):
    return validate.group_cases(_grouped(spark, d), "group")


@query(f"""WITH RECURSIVE {_SCORED}, r AS (SELECT DISTINCT tie.CRD_ID, "group", ({_na('compared_to')}) IS NOT NULL AS named FROM crd_catalog c JOIN tie ON tie.CRD_ID = {_canon('c.CRD_ID')})
SELECT "group", count(*) AS "rows" FROM r GROUP BY 1 HAVING count(*) > 1 AND count(*) FILTER (named) = 0""")
def label_group_integrity(spark, d):
    return validate.group_integrity(_grouped(spark, d))


@query(f"""WITH RECURSIVE {_SCORED} SELECT c.CRD_ID, {_no_nan('c.z')} AS z, t."group", coalesce(t.tie_result, c.tie_result) AS tie_result
FROM (SELECT CRD_ID, z, tie_result FROM crd_catalog) c LEFT JOIN tie t ON t.CRD_ID = c.CRD_ID""")
def all_merged_labels(spark, d):
    return merge_labels(_catalog(spark, d).select("CRD_ID", nan_to_null(F.col("z")).alias("z"), "tie_result"), _labels(spark, d)).select("CRD_ID", "z", "group", "tie_result")


@query("SELECT CAST(tie_result AS INTEGER) AS tie_result, count(*) AS \"rows\", count(*) / (SELECT count(*) FROM crd_catalog)::DOUBLE AS share FROM crd_catalog GROUP BY 1")
def tie_counts(spark, d):
    return validate.tie_counts(_catalog(spark, d))


@query("""WITH l AS (SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, CASE WHEN event_id % 2 = 0 THEN 'START' ELSE 'END' END AS what, event_type AS phase FROM events)
SELECT phase, min(CASE WHEN what = 'START' THEN t END) AS started, max(CASE WHEN what = 'END' THEN t END) AS ended FROM l GROUP BY phase""")
def time_profile(spark, d):
    what = F.when(F.col("event_id") % 2 == 0, "START").otherwise("END")
    lines = table(spark, d, "events").select(F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("[INFO] phase"), what, F.col("event_type")).alias("line"))
    return validate.time_profile(lines, "line")


@query("""SELECT source, count(*) AS "rows", count(z) AS with_z, min(CASE WHEN isnan(z) THEN NULL ELSE z END) AS z_min, max(CASE WHEN isnan(z) THEN NULL ELSE z END) AS z_max,
  count(DISTINCT survey) AS surveys FROM crd_catalog GROUP BY source""")
def source_summary(spark, d):
    z = nan_to_null(F.col("z"))
    return _catalog(spark, d).groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.count("z").alias("with_z"), F.min(z).alias("z_min"), F.max(z).alias("z_max"), F.count_distinct("survey").alias("surveys")
    )


_DESCRIBED = ("ra", "dec", "z", "z_err", "z_flag_homogenized")


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(v) AS "count", avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50,
  quantile_cont(v, 0.75) AS q75, max(v) AS max FROM (SELECT {_no_nan(c)} AS v FROM crd_catalog)""" for c in _DESCRIBED
))
def column_statistics(spark, d):
    """Count, mean, deviation, extremes and exact quartiles of the numeric columns."""
    return validate.describe(_catalog(spark, d), _DESCRIBED)


@query(f"""WITH RECURSIVE {_RESTORED}, a AS (SELECT DISTINCT {_canon('CRD_ID')} AS CRD_ID, tie_result AS before FROM crd_catalog),
k AS (SELECT i.CRD_ID, CASE WHEN i.star THEN 'star' WHEN NOT EXISTS (SELECT 1 FROM n WHERE n.CRD_ID = i.CRD_ID) THEN 'no neighbors'
  WHEN i.CRD_ID NOT IN {_REAL} THEN 'stars only' END AS kind FROM ids i)
SELECT kind, count(*) AS "rows", count(*) FILTER (CASE WHEN kind = 'star' THEN fin.tie_result = 3 ELSE fin.tie_result = coalesce(a.before, 1) END) AS kept
FROM k JOIN fin USING (CRD_ID) JOIN a USING (CRD_ID) WHERE kind IS NOT NULL GROUP BY kind""")
def guarded_ties(spark, d):
    df = _rows(spark, d)
    return validate.guarded_ties(df, _labels(spark, d, restore=True))
