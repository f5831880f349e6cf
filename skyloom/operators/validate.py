"""Checks of an output catalog: each returns a frame of findings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyloom.functions.text import canonical_id, is_na_token, strip
from skyloom.operators.dedup import type_score
from skyloom.operators.graph import components, edges, is_star, neighbors
from skyloom.session import Scratch


def intra_source_cells(df: DataFrame, places: int = 4) -> DataFrame:
    """(source, ra_cell, dec_cell, rows, pairs, both_ways, one_way, missing) of each cell with two rows or more of a source.

    A cell is a rounded position (half to even). Of the pairs of its rows, those count whose ids name each other, whose one names the
    other, and the rest. Linked pairs are found by joining the links, not by forming all pairs; ``missing`` is what is left of n(n-1)/2.
    Rows without id or position are in no cell; copies of a row count once.
    """
    rows = df.select(canonical_id(F.col("CRD_ID")).alias("CRD_ID"), "source", F.bround("ra", places).alias("ra_cell"), F.bround("dec", places).alias("dec_cell"))
    rows = rows.where("CRD_ID is not null and ra_cell is not null and dec_cell is not null and not isnan(ra_cell) and not isnan(dec_cell)").distinct()
    cell = ["source", "ra_cell", "dec_cell"]
    sizes = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    n = neighbors(df).distinct()
    a = rows.withColumnRenamed("CRD_ID", "a").withColumnsRenamed({c: f"{c}_a" for c in cell})
    b = rows.withColumnRenamed("CRD_ID", "b").withColumnsRenamed({c: f"{c}_b" for c in cell})
    directed = n.select(F.col("CRD_ID").alias("a"), F.col("neighbor").alias("b")).join(a, "a").join(b, "b")
    for c in cell:
        directed = directed.where(F.col(f"{c}_a").eqNullSafe(F.col(f"{c}_b")))
    links = directed.groupBy(*[F.col(f"{c}_a").alias(c) for c in cell], F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(F.count(F.lit(1)).alias("ways"))
    found = links.groupBy(*cell).agg(F.count_if(F.col("ways") == 2).alias("both_ways"), F.count_if(F.col("ways") == 1).alias("one_way"))
    f = found.withColumnsRenamed({c: f"{c}_f" for c in cell})
    on = [sizes[c].eqNullSafe(f[f"{c}_f"]) for c in cell]
    out = sizes.join(f, on[0] & on[1] & on[2], "left").withColumn("pairs", F.expr("`rows` * (`rows` - 1) div 2"))
    both, one = F.coalesce("both_ways", F.lit(0)), F.coalesce("one_way", F.lit(0))
    return out.select(*cell, "rows", "pairs", both.alias("both_ways"), one.alias("one_way"), (F.col("pairs") - both - one).alias("missing"))


def _components_of(df: DataFrame) -> DataFrame:
    found = components(edges(df))
    ids = df.withColumn("CRD_ID", canonical_id(F.col("CRD_ID"))).where("CRD_ID is not null").dropDuplicates(["CRD_ID"])
    return ids.join(found.withColumnRenamed("id", "CRD_ID"), "CRD_ID", "left").withColumn("component", F.coalesce("component", "CRD_ID"))


def smallest_gaps(rows: DataFrame, width: float) -> DataFrame:
    """(component, z) -> (component, gap): the smallest distance of two z of a component, null if it has only one.

    Equal z are counted, and a component is scanned in bands of ``width`` that are joined afterwards, so that no task sorts a whole one.
    """
    points = rows.groupBy("component", "z").agg(F.count(F.lit(1)).alias("n")).withColumn("band", F.floor(F.col("z") / width))
    inside, over = W.partitionBy("component", "band").orderBy("z"), W.partitionBy("component").orderBy("band")
    near = F.when(F.col("n") > 1, 0.0).otherwise(F.col("z") - F.lag("z").over(inside))
    bands = points.withColumn("gap", near).groupBy("component", "band").agg(F.min("z").alias("lo"), F.max("z").alias("hi"), F.min("gap").alias("gap"))
    return bands.withColumn("gap", F.least("gap", F.col("lo") - F.lag("hi").over(over))).groupBy("component").agg(F.min("gap").alias("gap"))


def tie_findings(df: DataFrame, gap: float = 0.001) -> DataFrame:
    """(rule, component, CRD_ID): broken rules of tie_result by the reference's definitions; CRD_ID is null for rules about a whole component.

    Pairs have rules of their own, with flag, type and redshift of both rows, and of larger components any two survivors with the best flag and type have to be more than ``gap`` apart. Components leave out stars and rows marked as such.
    """
    scratch = Scratch(df.sparkSession, "tie-findings")
    rows = scratch.keep(_components_of(df).select(
        "CRD_ID", "component", is_star(F.col("z_flag_homogenized")).alias("star"), F.coalesce(F.col("tie_result").cast("int"), F.lit(-1)).alias("tie"), F.when(~F.isnan("z"), F.col("z")).alias("z"),
        F.struct(F.coalesce(F.when(~F.isnan("z_flag_homogenized"), F.col("z_flag_homogenized")), F.lit(-1.0)).alias("flag"), type_score(F.col("instrument_type_homogenized")).alias("score")).alias("rank"),
    ))
    single = rows.select(
        F.when(F.col("star") & (F.col("tie") != 3), "STAR_MUST_BE_3").when(~F.col("star") & (F.col("tie") == 3), "NONSTAR_MUST_NOT_BE_3").alias("rule"), "component", "CRD_ID"
    ).where("rule is not null")
    members = rows.where(~F.col("star") & (F.col("tie") != 3))
    alive = F.col("tie").isin(1, 2)
    g = members.groupBy("component").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("tie") == t).alias(f"n{t}") for t in range(3)], F.max("rank").alias("best"), F.min("rank").alias("worst"),
        F.max(F.when(F.col("tie") == 1, F.col("rank"))).alias("winner"), F.max(F.when(F.col("tie") == 0, F.col("rank"))).alias("loser"),
        F.min(F.when(alive, F.col("rank.flag"))).alias("tail_flag"), F.min(F.when(alive, F.col("rank.score"))).alias("tail_score"),
        F.when(F.count("z") == 2, F.max("z") - F.min("z")).alias("dz"),
    ).where("n > 1")
    top = members.where(alive & F.col("z").isNotNull()).join(g.where("n > 2").select("component", "best"), "component").where("rank = best").select("component", "z")
    g = g.join(smallest_gaps(top, 1000 * gap if gap > 0 else 1.0), "component", "left")
    pair, more, survivors = F.col("n") == 2, F.col("n") > 2, F.col("n1") + F.col("n2")
    close = F.coalesce(F.col("dz") <= gap, F.lit(False))
    won, tied, lost = (F.col("n1") == 1) & (F.col("n0") == 1), F.col("n2") == 2, F.col("n0") == 2
    equal = F.col("best") == F.col("worst")
    rules: list[tuple[str, Column]] = [
        ("PAIR_1v0_PRIORITY", pair & won & ~((F.col("winner") > F.col("loser")) | (equal & close))),
        ("PAIR_2v2_TIE_CONSISTENCY", pair & tied & ~(equal & ~close)),
        ("PAIR_0v0_SUSPECT", pair & lost),
        ("PAIR_INVALID_TIE_PATTERN", pair & ~won & ~tied & ~lost),
        ("GROUP_FLAG_DOMINANCE", more & (F.col("tail_flag") < F.col("best.flag"))),
        ("GROUP_TYPE_DOMINANCE", more & (F.col("tail_score") < F.col("best.score"))),
        ("GROUP_DELTZ_INDEPENDENCE", more & (F.col("gap") <= gap)),
        ("GROUP_NO_SURVIVOR_SUSPECT", more & (survivors == 0)),
        ("GROUP_SINGLE_SURVIVOR_MUST_BE_1", more & (survivors == 1) & (F.col("n1") == 0)),
        ("GROUP_MULTI_SURVIVOR_MUST_BE_2", more & (survivors > 1) & (F.col("n1") > 0)),
    ]
    named = F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in rules]), lambda v: v.isNotNull())
    whole = g.select(F.explode(named).alias("rule"), "component", F.lit(None).cast("string").alias("CRD_ID"))
    return single.select("rule", "component", "CRD_ID").unionAll(whole)


def unlinked_rule(df: DataFrame) -> DataFrame:
    """(CRD_ID, tie_result, problem): rows without neighbors must be 1, or 3 if stars; stars are 3 and nothing else is."""
    star = is_star(F.col("z_flag_homogenized"))
    tie = F.coalesce(F.col("tie_result"), F.lit(-1))
    problem = (
        F.when(star & (tie != 3), "star is not 3").when(~star & (tie == 3), "3 is no star")
        .when(is_na_token(F.col("compared_to")) & ~star & (tie != 1), "no neighbors but not 1")
    )
    return df.select("CRD_ID", "tie_result", problem.alias("problem")).where("problem is not null").distinct()


def tie_crosstab(df: DataFrame) -> DataFrame:
    """(flag, tie_0, tie_1, tie_2, tie_3, other): how often flags and tie results meet; flag as text, null as "none"."""
    flag = F.coalesce(F.when(~F.isnan("z_flag_homogenized"), F.col("z_flag_homogenized").cast("int").cast("string")), F.lit("none"))
    ties = [F.count_if(F.col("tie_result") == t).alias(f"tie_{t}") for t in range(4)]
    return df.groupBy(flag.alias("flag")).agg(*ties, F.count_if(~F.coalesce(F.col("tie_result").between(0, 3), F.lit(False))).alias("other"))


def nonstar_components(df: DataFrame) -> DataFrame:
    """The rows that aren't stars, one for each CRD_ID, with the ``component`` of the links between such rows."""
    return _components_of(df).where(~is_star(F.col("z_flag_homogenized")))


def linked_groups(df: DataFrame) -> DataFrame:
    """The rows that name a neighbor, one for each CRD_ID, with the ``component`` of all links, those of stars and of absent rows too."""
    links = neighbors(df).select(F.least("CRD_ID", "neighbor").alias("a"), F.greatest("CRD_ID", "neighbor").alias("b")).distinct()
    rows = df.where(~is_na_token(F.col("compared_to"))).withColumn("CRD_ID", canonical_id(F.col("CRD_ID"))).dropDuplicates(["CRD_ID"])
    return rows.join(components(links).withColumnRenamed("id", "CRD_ID"), "CRD_ID")


def group_cases(df: DataFrame, group: str, gap: float = 0.001) -> DataFrame:
    """(bucket, groups, rows): groups of two rows or more by the reference's kinds, of which a group may have several.

    CASE1 is a pair, CASE2 more; small is no z farther than ``gap`` from another, infinite ones aside; same is one survey. The others
    are of one flag and several types, or of one source. Missing values don't count, so a group without z is small.
    """
    text = lambda c: F.when(strip(F.col(c)) != "", strip(F.col(c)))
    z = F.when(~F.isnan("z") & (F.abs("z") != float("inf")), F.col("z"))
    flag = F.when(~F.isnan("z_flag_homogenized"), F.col("z_flag_homogenized"))
    n_of = lambda c: F.least(F.lit(2), F.count_distinct(c))
    g = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max(z) - F.min(z), F.lit(0.0)).alias("dz"), n_of(text("survey")).alias("surveys"), n_of(flag).alias("flags"),
        n_of(text("instrument_type_homogenized")).alias("types"), n_of(F.lower(text("source"))).alias("sources"), F.count(text("source")).alias("sourced"),
    ).where("n > 1")
    pair = F.col("n") == 2
    broken = (F.col("flags") == 1) & (F.col("types") > 1)
    case = F.concat(F.when(pair, "CASE1").otherwise("CASE2"), F.when(F.col("dz") <= gap, "_small").otherwise("_large"), F.when(F.col("surveys") == 1, "_same").otherwise("_diff"))
    tie = F.when(broken & (F.col("surveys") > 1), F.when(pair, "TIE_FLAG_TYPE_BREAK_PAIR").otherwise("TIE_FLAG_TYPE_BREAK_GROUP"))
    buckets = F.array_compact(F.array(case, tie, F.when(broken & ~pair, "SAME_FLAG_DIFF_TYPE"), F.when(pair & (F.col("sourced") == 2) & (F.col("sources") == 1), "SAME_SOURCE_PAIR")))
    return g.select(F.explode(buckets).alias("bucket"), "n").groupBy("bucket").agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows"))


def tie_preservation(before: DataFrame, after: DataFrame, key: str = "CRD_ID") -> DataFrame:
    """(before, after, rows): how tie results of an earlier output fared, over the keys of both; null as -1, gone as -2."""
    a = before.select(key, F.coalesce("tie_result", F.lit(-1)).cast("int").alias("before"))
    b = after.select(key, F.coalesce("tie_result", F.lit(-1)).cast("int").alias("now"))
    return a.join(b, key, "left").groupBy("before", F.coalesce("now", F.lit(-2)).alias("after")).agg(F.count(F.lit(1)).alias("rows"))


def guarded_ties(df: DataFrame, after: DataFrame) -> DataFrame:
    """(kind, rows, kept) of the rows that a run has to leave alone: those without neighbors and with stars only keep the tie_result they
    came with (null: 1), stars are 3. ``after`` has CRD_ID and tie_result; copies of a row count once; ``kept`` are the right ones.
    """
    ids = df.groupBy(canonical_id(F.col("CRD_ID")).alias("CRD_ID")).agg(F.max(is_star(F.col("z_flag_homogenized"))).alias("star"), F.min(F.col("tie_result").cast("int")).alias("before"))
    n = neighbors(df).join(ids.select(F.col("CRD_ID").alias("neighbor"), F.col("star").alias("to_star")), "neighbor", "left")
    n = n.groupBy("CRD_ID").agg(F.min(F.coalesce("to_star", F.lit(False))).alias("stars_only"))
    kind = F.when(F.col("star"), "star").when(F.col("stars_only").isNull(), "no neighbors").when(F.col("stars_only"), "stars only")
    rows = ids.where("CRD_ID is not null").join(n, "CRD_ID", "left").withColumn("kind", kind).where("kind is not null").join(after.select("CRD_ID", "tie_result"), "CRD_ID")
    right = F.when(F.col("kind") == "star", F.col("tie_result") == 3).otherwise(F.col("tie_result") == F.coalesce("before", F.lit(1)))
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), F.count_if(right).alias("kept"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) of numeric columns; null and NaN don't count. Quartiles are exact.

    Equal values are counted before they are ordered, and ordered by ranges that are numbered from the sizes of those before.
    """
    values = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])).alias("c")).select("c.*")
    counted = values.where("v is not null and not isnan(v)").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    placed = Scratch(df.sparkSession, "describe").keep(counted.repartitionByRange("column", "v").withColumn("part", F.spark_partition_id()))
    sizes = placed.groupBy("column", "part").agg(F.sum("n").alias("size"))
    by = W.partitionBy("column")
    sizes = sizes.withColumns({"before": F.sum("size").over(by.orderBy("part")) - F.col("size"), "count": F.sum("size").over(by)})
    end = F.col("before") + F.sum("n").over(W.partitionBy("column", "part").orderBy("v"))
    ranked = placed.join(sizes, ["column", "part"]).withColumn("end", end)

    def quarter(p: float) -> Column:
        at = p * (F.col("count") - 1)
        holds = lambda k: F.max(F.when((k >= F.col("end") - F.col("n")) & (k < F.col("end")), F.col("v")))
        low = holds(F.floor(at))
        return low + F.max(at - F.floor(at)) * (F.coalesce(holds(F.floor(at) + 1), low) - low)

    rest = ranked.groupBy("column").agg(
        F.max("count").alias("count"), F.min("v").alias("min"), quarter(0.25).alias("q25"), quarter(0.5).alias("q50"), quarter(0.75).alias("q75"), F.max("v").alias("max")
    )
    stats = df.agg(*[f(F.when(~F.isnan(c), F.col(c).cast("double"))).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_samp))])
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"{c}_mean").alias("mean"), F.col(f"{c}_std").alias("std")) for c in columns]
    out = stats.select(F.explode(F.array(*parts)).alias("c")).select("c.*").join(rest, "column", "left")
    return out.select("column", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max")


def group_integrity(df: DataFrame, group: str = "group") -> DataFrame:
    """(group, rows): groups of two rows or more in which no row names a neighbor."""
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), F.count_if(~is_na_token(F.col("compared_to"))).alias("named"))
    return g.where("rows > 1 and named = 0").select(group, "rows")


def tie_counts(df: DataFrame) -> DataFrame:
    """(tie_result, rows, share) over all rows; null is a value of its own."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    counts = df.groupBy("tie_result").agg(F.count(F.lit(1)).alias("rows"))
    return counts.join(F.broadcast(total)).select(F.col("tie_result").cast("int").alias("tie_result"), "rows", (F.col("rows") / F.col("total")).alias("share"))


def time_profile(lines: DataFrame, line: str) -> DataFrame:
    """(phase, started, ended) from log lines ``<time> ... START|END <phase>``; lines of any other form are passed over."""
    form = r"^(\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\d)\S*\s.*\b(START|END)\s+(\w+)"
    part = lambda k: F.regexp_extract(F.col(line), form, k)
    rows = lines.select(part(1).alias("at"), part(2).alias("what"), part(3).alias("phase")).where("phase <> ''")
    return rows.groupBy("phase").agg(F.min(F.when(F.col("what") == "START", F.col("at"))).alias("started"), F.max(F.when(F.col("what") == "END", F.col("at"))).alias("ended"))
