"""The graph of matches: edges from neighbor texts, connected components, and stars beside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.text import canonical_id
from skyloom.operators.joins import hot_keys, lookup
from skyloom.session import Scratch, seen

# Fixed value: the flag of a star, which links nothing.
STAR = 6


def is_star(flag: Column) -> Column:
    return F.coalesce(flag == STAR, F.lit(False))


def id_hash(c: Column) -> Column:
    """The number tried first for an id."""
    return F.xxhash64(c)


def numbered(pairs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) of numbers, a < b, distinct, of kept pairs (x, y) of different ids, and vertices (id, v).

    Numbers are of fixed width, so that what follows aggregates them by hash. Hashes serve unless two ids share one; then ids are counted.
    """
    vertices = scratch.keep(pairs.select("x").unionAll(pairs.select("y")).distinct().select(F.col("x").alias("id"), id_hash(F.col("x")).alias("v")))
    if vertices.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        numbers = pairs.select(id_hash(F.col("x")).alias("x"), id_hash(F.col("y")).alias("y"))
    else:
        vertices = scratch.keep(vertices.select("id", F.monotonically_increasing_id().alias("v")))
        numbers = pairs
        for end in "xy":
            known = vertices.select(F.col("id").alias(end), F.col("v").alias(f"n{end}"))
            numbers = lookup(numbers, known, end, hot_keys(pairs, end, seen(pairs)))
        numbers = numbers.select(F.col("nx").alias("x"), F.col("ny").alias("y"))
    return scratch.keep(numbers.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()), vertices


def neighbors(df: DataFrame) -> DataFrame:
    """(CRD_ID, neighbor): the values of ``compared_to`` between commas in canonical form, without empty ones and the row itself."""
    pairs = df.select(canonical_id(F.col("CRD_ID")).alias("CRD_ID"), F.explode(F.split("compared_to", ",")).alias("v"))
    pairs = pairs.select("CRD_ID", canonical_id(F.col("v")).alias("neighbor"))
    return pairs.where("CRD_ID is not null and neighbor <> '' and neighbor <> CRD_ID")


def edges(df: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """(a, b), a < b: distinct undirected edges whose ends are both in the table and neither a star. ``named``: its neighbors, if at hand."""
    able = df.groupBy(canonical_id(F.col("CRD_ID")).alias("id")).agg(F.max(is_star(F.col("z_flag_homogenized"))).alias("star")).where("not star")
    able = able.select("id", F.xxhash64("id").alias("h"))  # the hash goes first, as ids that begin alike are slow to sort
    n = neighbors(df) if named is None else named
    for end in ("CRD_ID", "neighbor"):
        n = n.withColumn("h", F.xxhash64(end)).join(able.withColumnRenamed("id", end), ["h", end], "left_semi").drop("h")
    return n.select(F.least("CRD_ID", "neighbor").alias("a"), F.greatest("CRD_ID", "neighbor").alias("b")).distinct()


def edge_diagnostics(df: DataFrame) -> DataFrame:
    """One row: how many neighbors are named, and of these how many link: (named, of_itself, from_star, to_star, to_absent, linking, edges).

    Each naming counts, of copies of a row too; ``edges`` are the distinct ones that are left.
    """
    ids = df.groupBy(canonical_id(F.col("CRD_ID")).alias("id")).agg(F.max(is_star(F.col("z_flag_homogenized"))).alias("star")).where("id is not null")
    named = df.select(canonical_id(F.col("CRD_ID")).alias("a"), F.explode(F.split("compared_to", ",")).alias("v")).select("a", canonical_id(F.col("v")).alias("b")).where("a is not null and b <> ''")
    both = named.join(ids.toDF("a", "sa"), "a").join(ids.toDF("b", "sb"), "b", "left")
    other = F.col("a") != F.col("b")
    out = both.agg(
        F.count(F.lit(1)).alias("named"), F.count_if(~other).alias("of_itself"), F.count_if(other & F.col("sa")).alias("from_star"),
        F.count_if(other & ~F.col("sa") & F.coalesce("sb", F.lit(False))).alias("to_star"), F.count_if(other & ~F.col("sa") & F.col("sb").isNull()).alias("to_absent"),
        F.count_if(other & ~F.col("sa") & ~F.col("sb")).alias("linking"),
    )
    return out.join(edges(df).agg(F.count(F.lit(1)).alias("edges")), F.lit(True))


def components(pairs: DataFrame) -> DataFrame:
    """(id, component) of every end of a pair (a, b); ``component`` is the smallest id of the connected component.

    Alternating large-star and small-star steps over numbers (each vertex hangs its larger, then its smaller neighbors under its
    smallest one) until the edges stand still; every step is a join and an aggregate, and the edges of a step are written to the shared
    folder. Null ends and loops are left out.
    """
    scratch = Scratch(pairs.sparkSession, "components")
    ends = scratch.keep(pairs.where("a is not null and b is not null and a <> b").select(F.col("a").alias("x"), F.col("b").alias("y")).distinct())
    e, vertices = numbered(ends, scratch)
    before = None
    while True:
        both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        hung = lookup(both.where("b > a"), least, "a", hot_keys(both, "a", 2 * seen(e)))
        large = hung.select(F.col("b").alias("u"), "m").where("u <> m").distinct()
        # Small star: now every pair is (u, m) with m < u; the smaller neighbors of u meet under the smallest.
        low = large.groupBy("u").agg(F.min("m").alias("least"))
        small = large.join(low, "u").select(F.col("m").alias("b"), F.col("least").alias("a")).where("a <> b").unionAll(low.select(F.col("u").alias("b"), F.col("least").alias("a")))
        nxt = scratch.keep(small.select("a", "b").distinct(), h=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        state = seen(nxt), seen(nxt, "h")
        scratch.drop(e)
        e = nxt
        if state == before:
            break
        before = state
    roots = e.select(F.col("b").alias("v"), F.col("a").alias("root")).unionAll(e.select(F.col("a").alias("v"), F.col("a").alias("root")).distinct())
    placed = scratch.keep(vertices.join(roots, "v").select("id", "root"))
    least = placed.groupBy("root").agg(F.min("id").alias("component"))
    return lookup(placed, least, "root", hot_keys(placed, "root", seen(placed))).select("id", "component")


def groups(df: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """(CRD_ID, group): the component of each distinct id; singletons are their own group. ``named``: its neighbors, if at hand.

    Stars, which link nothing, join the smallest group among their neighbors' groups, if any.
    """
    scratch = Scratch(df.sparkSession, "star-groups")
    ids = df.groupBy(canonical_id(F.col("CRD_ID")).alias("CRD_ID")).agg(F.max(is_star(F.col("z_flag_homogenized"))).alias("star")).where("CRD_ID is not null")
    n = scratch.keep(neighbors(df)) if named is None else named
    found = components(edges(df, n))
    labeled = ids.join(found, ids["CRD_ID"] == found["id"], "left").select("CRD_ID", "star", F.coalesce("component", F.when(~F.col("star"), F.col("CRD_ID"))).alias("group"))
    labeled = scratch.keep(labeled)
    stars = labeled.where("star").select("CRD_ID")
    beside = n.unionAll(n.select(F.col("neighbor").alias("CRD_ID"), F.col("CRD_ID").alias("neighbor"))).join(stars, "CRD_ID", "left_semi")
    other = labeled.where("group is not null").select(F.col("CRD_ID").alias("neighbor"), F.col("group").alias("g"))
    bridged = beside.join(other, "neighbor").groupBy("CRD_ID").agg(F.min("g").alias("g"))
    return labeled.join(bridged, "CRD_ID", "left").select("CRD_ID", F.coalesce("group", "g", "CRD_ID").alias("group"))
