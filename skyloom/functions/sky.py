"""Positions on the sky as Catalyst expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The first data preview's fields as (ra, dec, radius) in degrees.
PREVIEW_FIELDS = (
    (6.02, -72.08, 2.5),
    (37.86, 6.98, 2.5),
    (40.00, -34.45, 2.5),
    (53.13, -28.10, 2.5),
    (59.10, -48.73, 2.5),
    (95.00, -25.00, 2.5),
    (106.23, -10.51, 2.5),
)


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    a, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def chord(radius_arcsec: float) -> float:
    """The straight distance of two unit vectors that are ``radius_arcsec`` apart."""
    return 2 * math.sin(math.radians(radius_arcsec / 3600) / 2)


def in_fields(ra: Column, dec: Column, fields=PREVIEW_FIELDS) -> Column:
    """1 within one of the circular fields, borders included, else 0; 0 for missing positions."""
    x, y, z = unit_vector(ra, dec)
    inside = F.lit(False)
    for fra, fdec, radius in fields:
        a, d = math.radians(fra), math.radians(fdec)
        dot = x * (math.cos(d) * math.cos(a)) + y * (math.cos(d) * math.sin(a)) + z * math.sin(d)
        inside = inside | (dot >= math.cos(math.radians(radius)))
    return F.coalesce(inside, F.lit(False)).cast("long")


def footprint_segments(border: DataFrame, ra: str, dec: str, bin_deg: float = 0.5, above: float = 1.0) -> DataFrame:
    """(lo, hi, at_lo, slope): the upper limit in dec as straight pieces over ra, from border points.

    The limit of a bin of ra is its largest dec plus ``above``, at the bin's middle; between middles it is linear, across ra 0/360 too.
    """
    top = border.where(f"{ra} is not null and {dec} is not null").groupBy(F.floor(F.pmod(F.col(ra), F.lit(360.0)) / bin_deg).alias("bin"))
    top = top.agg((F.max(dec) + above).alias("limit")).select(((F.col("bin") + 0.5) * bin_deg).alias("mid"), "limit")
    # At most 360 / bin_deg rows are in this one window partition.
    order = W.partitionBy(F.lit(1)).orderBy("mid")
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    nxt = F.coalesce(F.lead("mid").over(order), F.first("mid").over(whole) + 360.0)
    to = F.coalesce(F.lead("limit").over(order), F.first("limit").over(whole))
    pieces = top.select(F.col("mid").alias("lo"), nxt.alias("hi"), F.col("limit").alias("at_lo"), ((to - F.col("limit")) / (nxt - F.col("mid"))).alias("slope"))
    wrapped = pieces.where("hi > 360").select(F.col("lo") - 360.0, F.col("hi") - 360.0, "at_lo", "slope")
    return pieces.unionAll(wrapped)


def in_footprint(df: DataFrame, segments: DataFrame, ra: str, dec: str, name: str) -> DataFrame:
    """``df`` with ``name``: 1 where dec is at or below the limit at its ra, else 0; 0 for missing positions.

    Rows look their piece up by degree of ra rather than by range; the pieces are one row for each bin of ra at most.
    """
    binned = (segments.select("lo", "hi", "at_lo", "slope", F.explode(F.sequence(F.floor("lo").cast("int"), F.ceil("hi").cast("int") - 1)).alias("deg")))
    rows = df.withColumn("deg", F.floor(F.pmod(F.col(ra), F.lit(360.0))).cast("int"))
    at = F.pmod(rows[ra], F.lit(360.0))
    out = rows.join(binned, (rows["deg"] == binned["deg"]) & (at >= binned["lo"]) & (at < binned["hi"]), "left")
    flag = F.coalesce(rows[dec] <= F.col("at_lo") + F.col("slope") * (at - F.col("lo")), F.lit(False)).cast("long")
    return out.select(*[rows[c] for c in df.columns], flag.alias(name))
