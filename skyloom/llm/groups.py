"""Pairwise matches consolidated into groups by low-diameter decomposition.

Every vertex draws an exponentially distributed shift. Clusters start at their centers, the sooner the larger the center's shift,
and grow by one link a step; a vertex joins the cluster that reaches it first. Clusters contract to super-vertices, the links between
different clusters are decomposed again, and the assignments of all levels are composed. Growth ends after ``STEPS`` steps: the
diameter is at most twice that, and the share of links that cross clusters on a long chain is a third, not ``BETA``. (Grown until
nothing changed, a level took 28 steps on the test data at BETA = 0.3, a shuffle each, for 16 %; with shifts limited to 5 steps it
took 4, for 43 %. Both needed two to three times as many shuffles until no link was left.)

Ids become numbers once, so that every step aggregates fixed-width values by hash. Where the ids are those of a table, the number of
an id is a hash that no other id of the table has, and a name is that id if two hashes of 64 bits agree (``group_table``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.operators.graph import numbered
from skyloom.operators.joins import hot_keys, lookup
from skyloom.session import Scratch, seen, shuffles_freed

#: Rate of the exponential shifts.
BETA = 0.05
#: Growth steps of a level. Clusters that could grow further are joined on the next level, so this bounds work, not the result.
STEPS = 2


def _shift(v: str) -> Column:
    """An exponential variate that depends on vertex and level alone, so that a task run again draws the same.

    The level is a column, as Spark compiles a plan anew for each constant.
    """
    u = (F.pmod(F.xxhash64(v, "level"), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    return -F.log(u) / BETA


def _both(links: DataFrame) -> DataFrame:
    # No end is null; said here, so that Spark doesn't say it in some readers only, whose shuffles would differ by that from the others'.
    links = links.where("a is not null and b is not null")
    return links.select(F.col("a").alias("u"), F.col("b").alias("v"), "level").unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v"), "level"))


def _grow(links: DataFrame, hot: list[int]) -> DataFrame:
    """(v, center) of every vertex that has a link."""
    both = _both(links)
    if not hot:  # the links of a vertex lie together for all that it hears and tells, and are shuffled once for both
        both = both.repartition("u")
    earliest = (F.min("key").alias("key"), F.min_by("center", "key").alias("center"))
    # In the first step a vertex hears the start times of its neighbors, which it can draw itself from their names.
    starts = 1.0 - _shift("v")
    first = both.groupBy("u").agg(F.min(starts).alias("key"), F.min_by("v", starts).alias("center"), F.min("v").alias("least"), F.max("level").alias("level"))
    own = -_shift("u")
    joins = F.col("key") < own
    after = F.when(joins, F.col("key")).otherwise(own).alias("key"), F.when(joins, F.col("center")).otherwise(F.col("u")).alias("center")
    if STEPS == 1:
        return first.select(F.col("u").alias("v"), after[1])
    # In the second it tells each neighbor what it heard, and itself once, beside the first of them.
    told = lookup(both, first.drop("level"), "u", hot).select("u", "v", "least", *after)
    itself = F.struct(F.col("u").alias("v"), "key", "center")
    others = F.struct("v", (F.col("key") + 1.0).alias("key"), "center")
    alone, news = F.col("v") == F.col("least"), F.col("center") != F.col("u")
    state = told.select(F.inline(F.when(alone & news, F.array(itself, others)).when(alone, F.array(itself)).when(news, F.array(others)))).groupBy("v").agg(*earliest)
    for _ in range(STEPS - 2):
        news = state.where("center <> v").select(F.col("v").alias("u"), (F.col("key") + 1.0).alias("key"), "center")
        heard = lookup(both, news, "u", hot).select("v", "key", "center")
        state = heard.unionAll(state).groupBy("v").agg(*earliest)
    return state.select("v", "center")


def _roots(links: DataFrame, scratch: Scratch) -> DataFrame | None:
    """(v, center) of every end of the kept links (a, b), a < b; ``center`` is one vertex of the whole group. None if there are no links.

    Every table is dropped with the last plan that reads it, the given links too if there are any.
    """
    levels: list[DataFrame] = []
    left, kept = seen(links), links
    links = links.withColumn("level", F.lit(0))
    while left:
        hot = hot_keys(_both(links), "u", 2 * left)
        clusters = scratch.keep(_grow(links, hot))
        levels.append(clusters)
        between = lookup(lookup(links, clusters.toDF("a", "ca"), "a", hot), clusters.toDF("b", "cb"), "b", hot).where("ca <> cb")
        after = scratch.keep(between.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), (F.col("level") + 1).alias("level")).distinct())
        scratch.drop(kept)
        links, kept, left = after, after, seen(after)
    roots = None
    for k, clusters in reversed(list(enumerate(levels))):
        if roots is not None:
            moved = lookup(clusters, roots.toDF("center", "root"), "center", hot_keys(clusters, "center", seen(clusters)), "left")
            clusters = moved.select("v", F.coalesce("root", "center").alias("center"))
            clusters = scratch.keep(clusters) if k == 0 else clusters
        roots = clusters
    if len(levels) > 1:
        scratch.drop(*levels)
    return roots


def linked(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(id, v, group): ``group`` is a number for each group, ``v`` one for each id; otherwise as ``group_matches``."""
    scratch = Scratch(pairs.sparkSession, "groups")
    ends = pairs.select(F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")).where("x is not null and y is not null and x <> y")
    links, vertices = numbered(scratch.keep(ends), scratch)
    roots = _roots(links, scratch)
    if roots is None:
        return vertices.select("id", "v", F.col("v").alias("group"))
    return vertices.join(roots, "v").select("id", "v", F.col("center").alias("group"))


def id_number(c: Column, salt: int) -> Column:
    """The number of an id under a salt: the hash of the id, seeded by the salt; null for null."""
    return F.when(c.isNotNull(), F.xxhash64(F.lit(salt), c))


def table_numbers(ids: DataFrame, id: str) -> Callable[[Column], Column]:
    """The number of an id as a function, with a salt under which no two ids of the table share a number.

    Up to some billion ids the first salt serves nearly always; each further one is another pass over the ids. Raises RuntimeError
    where none of 64 serves.
    """
    c = F.col(id)
    for salt in range(64):
        twice = ids.select(id_number(c, salt).alias("v"), _second(c).alias("w")).groupBy("v").agg(F.min("w").alias("lo"), F.max("w").alias("hi"))
        with shuffles_freed(ids.sparkSession):
            alone = twice.where("lo <> hi").isEmpty()
        if alone:
            return lambda c: id_number(c, salt)
    raise RuntimeError("too many ids for numbers of 64 bits")


def _second(c: Column) -> Column:
    """Another hash of an id, which tells ids apart that share a number."""
    return F.xxhash64(F.lit(-1), c)


def group_table(ids: DataFrame, id: str, named: DataFrame, number: Callable[[Column], Column], scratch: Scratch | None = None) -> DataFrame:
    """(v, group) of every id of the table that is linked to another of them; ``v`` is its ``number`` (see ``table_numbers``).

    ``named`` has v, the number of an id of the table, and value, the name it gives. Names that aren't ids of the table, null names
    and an id's own name link nothing; repeated ids and names count once. No links give no rows. ``scratch`` holds the result, so that
    the caller can clear it.
    """
    scratch = scratch or Scratch(ids.sparkSession, "table-groups")
    known = ids.select(number(F.col(id)).alias("y"), _second(F.col(id)).alias("w")).where(F.col(id).isNotNull())
    ends = named.where("value is not null").select(F.col("v").alias("x"), number(F.col("value")).alias("y"), _second(F.col("value")).alias("w"))
    ends = ends.where("x <> y").join(known, ["y", "w"], "left_semi")
    links = scratch.keep(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    roots = _roots(links, scratch)
    if roots is None:
        return links.select(F.col("a").alias("v"), F.col("b").alias("group"))
    return roots.select("v", F.col("center").alias("group"))


def smallest_ids(groups: DataFrame) -> DataFrame:
    """(group, group_key): the smallest id of each group."""
    return groups.groupBy("group").agg(F.min("id").alias("group_key"))


def group_matches(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(id, group_key) of every id that is linked, directly or not, to another; ``group_key`` is the smallest id of the group.

    Pairs are undirected; repeated pairs count once; pairs with a null end and links of an id to itself are left out. No pairs give
    no rows. Other columns are ignored; ids are compared as text.
    """
    groups = Scratch(pairs.sparkSession, "group-keys").keep(linked(pairs, a, b))
    return lookup(groups, smallest_ids(groups), "group", hot_keys(groups, "group", seen(groups))).select("id", "group_key")
