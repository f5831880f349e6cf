"""Tie-breaking within groups of the same object: tie_result 0 lost, 1 won, 2 undecided, 3 star."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyloom.functions.text import canonical_id, strip
from skyloom.operators.graph import groups, is_star, neighbors
from skyloom.operators.joins import hot_keys, lookup
from skyloom.session import Scratch, seen

# Spectroscopic before grism before photometric.
TYPE_ORDER = {"s": 3, "g": 2, "p": 1}


def type_score(kind: Column, order: Mapping[str, int] = TYPE_ORDER) -> Column:
    """The score of an instrument type, exact letters after trimming; 0 for anything else and null."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in order.items() for x in kv]), strip(kind)), F.lit(0))


def priority_key(scores: Sequence[Column], competes: Column) -> Column:
    """A struct that is larger for better scores, the first score first; null and NaN are lowest; null for rows that don't compete."""
    best = F.struct(*[F.coalesce(F.when(~F.isnan(s.cast("double")), s.cast("double")), F.lit(float("-inf"))).alias(f"s{i}") for i, s in enumerate(scores)])
    return F.when(competes, best)


def pieces(rows: DataFrame, gap: float) -> DataFrame:
    """(group, id, x) -> (group, id): x sorted within each group and cut where neighbors differ by more than ``gap``; the smallest id of each piece.

    Equal x are one before they are sorted, and a group is scanned in bands of x that are joined afterwards, so that no task sorts a
    whole group. Rows with null or NaN x all stay, and so do all rows if ``gap`` is 0 or less.
    """
    if gap <= 0:
        return rows.select("group", "id")
    loose = rows.where(F.col("x").isNull() | F.isnan("x")).select("group", "id")
    fixed = rows.where(F.col("x").isNotNull() & ~F.isnan("x"))
    points = fixed.groupBy("group", "x").agg(F.min("id").alias("id")).withColumn("band", F.floor(F.col("x") / (1000 * gap)))
    inside = W.partitionBy("group", "band").orderBy("x")
    points = points.withColumn("cut", (F.col("x") - F.lag("x").over(inside) > gap).cast("int"))
    points = points.withColumn("cuts", F.sum(F.coalesce("cut", F.lit(0))).over(inside.rowsBetween(W.unboundedPreceding, 0)))
    over = W.partitionBy("group").orderBy("band")
    bands = points.groupBy("group", "band").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.max("cuts").alias("cuts"))
    first = F.coalesce((F.col("lo") - F.lag("hi").over(over) > gap).cast("int"), F.lit(0))
    bands = bands.select("group", "band", "cuts", first.alias("first"))
    before = F.sum(F.col("cuts") + F.col("first")).over(over.rowsBetween(W.unboundedPreceding, 0)) - F.col("cuts")
    joined = points.select("group", "band", "cuts", "id").join(bands.select("group", "band", before.alias("before")), ["group", "band"])
    kept = joined.groupBy("group", F.col("cuts") + F.col("before")).agg(F.min("id").alias("id")).select("group", "id")
    return kept.unionAll(loose)


def deduplicate(df: DataFrame, priorities: Sequence[str], gap: float = 0.0, type_order: Mapping[str, int] = TYPE_ORDER, restore: bool = True) -> DataFrame:
    """(CRD_ID, group, tie_result), one row for each distinct CRD_ID.

    Groups are connected components of ``compared_to`` over rows that aren't stars; a star joins its neighbors' smallest group but
    never competes. Of each group the rows with the best priorities stay (instrument types by ``type_order``), thinned by redshift; one
    is 1, several are 2, the rest are 0, stars are 3. With ``restore`` rows without neighbors, or with stars only, keep the tie_result
    they came with (null: 1). Rows with a null CRD_ID are left out; copies of a row count once. Raises KeyError for missing columns,
    TypeError for no priorities, ValueError for a negative gap.
    """
    if not isinstance(priorities, (list, tuple)) or not priorities:
        raise TypeError("priorities: a list of columns is needed")
    missing = [c for c in ("CRD_ID", "compared_to", "z", "z_flag_homogenized", *priorities) if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    if gap < 0:
        raise ValueError("the gap can't be negative")
    came = F.col("tie_result").cast("int") if "tie_result" in df.columns else F.lit(None).cast("int")
    wanted = [c for c in dict.fromkeys(["z", "z_flag_homogenized", *priorities])]
    key, scratch = canonical_id(F.col("CRD_ID")), Scratch(df.sparkSession, "ties")
    named = scratch.keep(neighbors(df))
    rows = df.where(key.isNotNull()).groupBy(key.alias("CRD_ID")).agg(F.min(F.struct(*[F.col(c) for c in wanted], came.alias("came"))).alias("r")).select("CRD_ID", "r.*")
    rows = rows.join(groups(df, named), "CRD_ID").withColumn("star", is_star(F.col("z_flag_homogenized")))
    scores = [type_score(F.col(c), type_order) if dict(df.dtypes)[c] == "string" else F.col(c) for c in priorities]
    rows = scratch.keep(rows.select("CRD_ID", "group", "star", "z", "came", priority_key(scores, ~F.col("star")).alias("score")))
    hot = hot_keys(rows, "group", seen(rows))
    best = rows.groupBy("group").agg(F.max("score").alias("best"), F.count(F.lit(1)).alias("size"))
    rows = scratch.keep(lookup(rows, best, "group", hot).select("CRD_ID", "group", "star", "z", "came", "size", (F.col("score") == F.col("best")).alias("leads")))
    leaders = scratch.keep(pieces(rows.where("leads").select("group", F.col("CRD_ID").alias("id"), F.col("z").alias("x")), gap))
    counts = leaders.groupBy("group").agg(F.count(F.lit(1)).alias("k"))
    stays = leaders.select(F.col("id").alias("CRD_ID"), F.lit(True).alias("stays"))
    rows = lookup(rows.join(stays, "CRD_ID", "left"), counts, "group", hot, "left")
    tie = F.when(F.col("star"), 3).when(F.col("size") == 1, 1).when(F.col("stays"), F.when(F.col("k") == 1, 1).otherwise(2)).otherwise(0)
    if restore:
        stars = rows.where("star").select(F.col("CRD_ID").alias("neighbor"))
        real = named.join(stars, "neighbor", "left_anti").select("CRD_ID", F.lit(True).alias("linked")).distinct()
        rows = rows.join(real, "CRD_ID", "left")
        tie = F.when(~F.col("star") & F.col("linked").isNull(), F.coalesce("came", F.lit(1))).otherwise(tie)
    return rows.select("CRD_ID", "group", tie.cast("int").alias("tie_result"))
