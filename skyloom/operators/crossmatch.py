"""Cross-match of catalogs: the nearest rows within a radius, by an equi-join on cells of a grid in space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyloom.functions.sky import chord, unit_vector
from skyloom.functions.text import strip
from skyloom.operators.near import valid_position

#: Side of a cell in units of the radius: wide enough that few rows touch several cells, narrow enough that cells stay small.
CELL = 6.0


def _vectors(df: DataFrame, tag: str, extra: list[str]) -> DataFrame:
    x, y, z = unit_vector(F.col("ra"), F.col("dec"))
    rows = df.where(F.col("CRD_ID").isNotNull() & valid_position(F.col("ra"), F.col("dec")))
    return rows.select(F.col("CRD_ID").alias(f"{tag}_id"), *[F.col(c).alias(f"{tag}_{c}") for c in extra], x.alias(f"{tag}x"), y.alias(f"{tag}y"), z.alias(f"{tag}z"))


def _cells(c: Column, side: float, reach: float) -> Column:
    low, high = F.floor((c - reach) / side), F.floor((c + reach) / side)
    return F.when(low == high, F.array(low)).otherwise(F.array(low, high))


def match(left: DataFrame, right: DataFrame, radius_arcsec: float, k: int | None = None, per_source: bool = False, keep=None) -> DataFrame:
    """(left_id, right_id, d2) of rows at most ``radius_arcsec`` apart, for each left row the ``k`` nearest only (None: all).

    Equal distances rank by right id. With ``per_source`` the k nearest of each source of the right side count. ``keep`` restricts pairs
    before they are ranked; it sees left_id, right_id and, if both sides have it, left_source and right_source. Rows without id or
    valid position match nothing. A row matches its own copy in the other table.
    """
    extra = ["source"] if "source" in left.columns and "source" in right.columns else []
    reach = chord(radius_arcsec)
    side = max(CELL * reach, 1e-9)
    a = _vectors(left, "left", extra)
    b = _vectors(right, "right", extra)
    for axis in "xyz":
        a = a.withColumn(f"c{axis}", F.floor(F.col(f"left{axis}") / side))
        b = b.withColumn(f"c{axis}", F.explode(_cells(F.col(f"right{axis}"), side, 1.001 * reach)))
    d2 = sum(((F.col(f"left{x}") - F.col(f"right{x}")) * (F.col(f"left{x}") - F.col(f"right{x}")) for x in "xyz"), F.lit(0.0))
    pairs = a.join(b, ["cx", "cy", "cz"]).withColumn("d2", d2).where(F.col("d2") <= reach * reach)
    if keep is not None:
        pairs = pairs.where(keep)
    if k is not None:
        by = ["left_id", "right_source"] if per_source else ["left_id"]
        pairs = pairs.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy("d2", "right_id"))).where(F.col("rank") <= k)
    return pairs.select("left_id", "right_id", "d2")


def self_match(df: DataFrame, radius_arcsec: float, k: int = 10) -> DataFrame:
    """(left_id, right_id) within one table; a row is one of its own k nearest, so it has k - 1 others at most."""
    pairs = match(df, df, radius_arcsec, k)
    return pairs.where("left_id <> right_id").select("left_id", "right_id")


def match_catalogs(df: DataFrame, radius_arcsec: float, k: int = 10) -> DataFrame:
    """(left_id, right_id) between different sources of one table, the k nearest of each other source.

    One join of all catalogs at once, in place of a tournament of pairs of catalogs.
    """
    pairs = match(df, df, radius_arcsec, k, per_source=True, keep=F.col("left_source") != F.col("right_source"))
    return pairs.select("left_id", "right_id")


def neighbor_text(pairs: DataFrame) -> DataFrame:
    """(CRD_ID, compared_to): the neighbors of each row found from either side, sorted as text and joined by comma and blank.

    Pairs are made distinct before they are gathered, so what is gathered is as long as the text it becomes.
    """
    both = pairs.select(F.col("left_id").alias("CRD_ID"), F.col("right_id").alias("n")).unionAll(pairs.select(F.col("right_id").alias("CRD_ID"), F.col("left_id").alias("n")))
    both = both.where("CRD_ID <> n").distinct()
    return both.groupBy("CRD_ID").agg(F.array_join(F.array_sort(F.collect_list("n")), ", ").alias("compared_to"))


def merge_neighbors(df: DataFrame, found: DataFrame) -> DataFrame:
    """``df`` with ``compared_to`` united with the neighbors of ``found`` (CRD_ID, compared_to): distinct, sorted, without the row itself; null if none."""
    split = lambda c: F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip)
    j = df.join(found.withColumnRenamed("compared_to", "found"), "CRD_ID", "left")
    own = F.filter(F.array_union(split(F.col("compared_to")), split(F.col("found"))), lambda v: (v != "") & (v != F.col("CRD_ID")))
    merged = F.array_join(F.array_sort(own), ", ")
    return j.withColumn("compared_to", F.when(merged != "", merged)).select(*df.columns)
