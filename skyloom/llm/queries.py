"""Queries of the problems tagged llm, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.text import nan_to_null, strip
from skyloom.llm.groups import group_table, smallest_ids, table_numbers
from skyloom.llm.leaks import find_leaks
from skyloom.llm.packing import count_tokens, pack
from skyloom.llm.survivors import Field, count_claims, discover_truth, survivors
from skyloom.llm.truncation import find_truncated
from skyloom.operators.joins import hot_keys, lookup
from skyloom.operators.packed import packed_values
from skyloom.session import Scratch, seen, table

QUERIES = {}
SQL = {}

#: Where the public vocabularies lie on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def query(f):
    QUERIES[f.__name__] = f
    return f


def _grouped(spark: SparkSession, d: str, scratch: Scratch) -> tuple[DataFrame, Callable[[Column], Column]]:
    """(v, group) of the catalog's ids that are linked, held by ``scratch``, and what gives ``v`` for an id. Flag 6, a star, links nothing."""
    catalog = table(spark, d, "crd_catalog")
    number = table_numbers(catalog, "CRD_ID")
    rows = catalog.where(~F.coalesce(F.col("z_flag_homogenized") == 6, F.lit(False)))
    named = packed_values(rows.select(number(F.col("CRD_ID")).alias("v"), "compared_to"), "v", "compared_to")
    return group_table(rows, "CRD_ID", named.select("v", F.explode_outer("values").alias("value")), number, scratch), number


@query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    scratch = Scratch(spark, "table-groups")
    groups, number = _grouped(spark, d, scratch)
    # Copies of a row are where the join put them, so that dropping them shuffles nothing.
    ids = table(spark, d, "crd_catalog").select(number(F.col("CRD_ID")).alias("v"), F.col("CRD_ID").alias("id"))
    members = Scratch(spark, "members").keep(ids.join(groups, "v").distinct().select("id", "group"))
    scratch.clear()
    return lookup(members, smallest_ids(members), "group", hot_keys(members, "group", seen(members))).select(F.col("id").alias("CRD_ID"), "group_key")


def _members(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, list[int]]:
    """The catalog's distinct rows that are in groups, with a number for the group, kept; (group, group_key); and the hot groups."""
    scratch = Scratch(spark, "table-groups")
    groups, number = _grouped(spark, d, scratch)
    wanted = "source", "z", "z_flag_homogenized", "instrument_type_homogenized"
    rows = table(spark, d, "crd_catalog").select(number(F.col("CRD_ID")).alias("v"), F.col("CRD_ID").alias("id"), *wanted)
    rows = Scratch(spark, "members").keep(rows.join(groups, "v").distinct().drop("v"))
    scratch.clear()
    return rows, smallest_ids(rows), hot_keys(rows, "group", seen(rows))


def _rank(kind: Column) -> Column:
    kind = strip(kind)
    return F.when(kind == "s", 3).when(kind == "g", 2).when(kind == "p", 1).otherwise(0)


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rows, keys, hot = _members(spark, d)
    flag = nan_to_null(F.col("z_flag_homogenized"))
    rank = _rank(F.col("instrument_type_homogenized"))
    fields = [
        Field("z_flag_homogenized", flag, F.coalesce(flag, F.lit(float("-inf")))),
        Field("instrument_type_homogenized", rank, rank),
    ]
    out = survivors(rows, fields, F.col("z"), 0.001, hot, repeated=False)
    return lookup(out, keys, "group", hot).select("group_key", F.col("id").alias("CRD_ID"), "tie_result")


@query
def p5_truth(spark: SparkSession, d: str) -> DataFrame:
    """For each group the redshift (to 0.001) and the kind of instrument that the votes alone give, without any stated order."""
    rows, keys, _ = _members(spark, d)
    z, rank = F.round(nan_to_null(F.col("z")), 3), _rank(F.col("instrument_type_homogenized"))
    # A missing value is no claim: it has less trust than any value there is.
    fields = [Field("z", z, z.isNotNull().cast("int")), Field("instrument_type_homogenized", rank, (rank > 0).cast("int"))]
    won, _, _ = discover_truth(Scratch(spark, "p5-truth").keep(count_claims(rows, fields)), [("v0", "t0"), ("v1", "t1")])
    kind = F.element_at(F.create_map(F.lit(3), F.lit("s"), F.lit(2), F.lit("g"), F.lit(1), F.lit("p")), F.col("v1"))
    return won.select("group", F.col("v0").alias("z"), kind.alias("instrument_type")).distinct().join(keys, "group").select("group_key", "z", "instrument_type")


_LINKS_SQL = r"""
f AS (
  SELECT DISTINCT CRD_ID,
    regexp_replace(regexp_replace(compared_to, '[\x{200B}-\x{200D}\x{FEFF}]', '', 'g'),
      '^[\s\x{A0},，;；|/\[\]{}()]+|[\s\x{A0},，;；|/\[\]{}()]+$', '', 'g') AS s
  FROM crd_catalog WHERE compared_to IS NOT NULL AND NOT coalesce(z_flag_homogenized = 6, false)),
t AS (
  SELECT CRD_ID AS a, unnest(list_transform(
    regexp_extract_all(s, '"[^"]*(?:""[^"]*)*"|''[^'']*(?:''''[^'']*)*''|[^\s\x{A0},，;；|/]+'),
    lambda v: trim(CASE WHEN v[1] = '"' THEN replace(v[2:-2], '""', '"') WHEN v[1] = '''' THEN replace(v[2:-2], '''''', '''') ELSE v END))) AS b
  FROM f),
able AS (SELECT CRD_ID FROM crd_catalog WHERE NOT coalesce(z_flag_homogenized = 6, false)),
e AS (SELECT DISTINCT a, b FROM t WHERE a <> b AND a IN (SELECT CRD_ID FROM able) AND b IN (SELECT CRD_ID FROM able)),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a),
g AS (SELECT a AS CRD_ID, least(a, min(b)) AS group_key FROM reach GROUP BY a)"""

SQL["p6_found"] = f"WITH RECURSIVE {_LINKS_SQL} SELECT CRD_ID, group_key FROM g"

SQL["p5_found"] = f"""WITH RECURSIVE {_LINKS_SQL},
r AS (
  SELECT DISTINCT group_key, CRD_ID, CASE WHEN isnan(z) THEN NULL ELSE z END AS z,
    CASE WHEN z_flag_homogenized IS NULL OR isnan(z_flag_homogenized) THEN -1e9 ELSE z_flag_homogenized END AS flag,
    CASE trim(instrument_type_homogenized, E' \\t\\n\\r') WHEN 's' THEN 3 WHEN 'g' THEN 2 WHEN 'p' THEN 1 ELSE 0 END AS kind
  FROM crd_catalog JOIN g USING (CRD_ID)),
c1 AS (SELECT * FROM r QUALIFY flag = max(flag) OVER (PARTITION BY group_key)),
c2 AS (SELECT * FROM c1 QUALIFY kind = max(kind) OVER (PARTITION BY group_key)),
piece AS (SELECT *, sum(c) OVER (PARTITION BY group_key ORDER BY z, CRD_ID ROWS UNBOUNDED PRECEDING) AS p FROM
  (SELECT group_key, CRD_ID, z, CASE WHEN z - lag(z) OVER (PARTITION BY group_key ORDER BY z, CRD_ID) > 0.001 THEN 1 ELSE 0 END AS c FROM c2 WHERE z IS NOT NULL)),
s AS (SELECT group_key, min(CRD_ID) AS CRD_ID FROM piece GROUP BY group_key, p UNION SELECT group_key, CRD_ID FROM c2 WHERE z IS NULL)
SELECT group_key, CRD_ID, CAST(CASE WHEN count(*) OVER (PARTITION BY group_key) = 1 THEN 1 ELSE 2 END AS INTEGER) AS tie_result FROM s"""


@query
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    hits = find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), "doc_id", "text", "item_id", "text")
    return hits.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id")).distinct()


# Documents and items meet on their runs of 13 words.
SQL["p8_found"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_items),
dr AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS run FROM d WHERE len(w) >= 13),
ir AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS run FROM i WHERE len(w) >= 13)
SELECT DISTINCT doc_id, item_id FROM dr JOIN ir USING (run)"""


@query
def p8_passages(spark: SparkSession, d: str) -> DataFrame:
    """For each document and item: the passages of 25 words or more that agree up to one edit for each such length."""
    hits = find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"), "doc_id", "text", "item_id", "text", words=25, exact=False)
    hits = hits.distinct().groupBy(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))
    return hits.agg(F.count(F.lit(1)).alias("passages"), F.max(F.col("end") - F.col("start")).alias("longest"), F.min("edits").alias("least_edits"))


@query
def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return find_truncated(table(spark, d, "documents"), "doc_id", "text", "lang").where("truncated").select("doc_id").distinct()


@query
def p9_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each source truncates, over its distinct documents."""
    docs = table(spark, d, "documents")
    judged = find_truncated(docs, "doc_id", "text", "lang").select("doc_id", "truncated").distinct()
    rates = docs.select("doc_id", "source").distinct().join(judged, "doc_id").groupBy("source")
    return rates.agg(F.count(F.lit(1)).alias("documents"), F.count_if("truncated").alias("truncated"), F.avg(F.col("truncated").cast("double")).alias("share"))


@query
def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    """The place of each document in containers of 2,048 tokens."""
    return pack(count_tokens(table(spark, d, "documents"), "doc_id", "text", VOCABULARY), "doc_id", "tokens", 2048)
