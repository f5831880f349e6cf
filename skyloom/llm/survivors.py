"""The best representative of each duplicate group, by iterative truth discovery.

The reliability of the sources and the support of each field's values in each group are estimated in turn until the reliabilities
stand still: a value's support is its stated trust (a fixed order, where the project has one: a prior that no votes overturn) and,
within one degree of trust, the reliability-weighted votes for it; a source is as reliable as its claims on all fields agree with the
values supported best. Fields are decided one after another: claims with the best-supported value stay candidates for the next field.
Claims are counted by (group, values, source) before anything else, so a group is as large here as it has different claims, however
many rows it has. A round is one shuffle by group for all fields.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyloom.operators.dedup import pieces
from skyloom.operators.joins import lookup
from skyloom.session import Scratch, seen


@dataclass
class Field:
    """A field to decide: ``value`` (what is voted on; null is a value like any other) and ``trust`` (larger wins before any vote).

    ``trust`` is a function of the value: equal values of a field have equal trust.
    """

    name: str
    value: Column
    trust: Column


def discover_truth(claims: DataFrame, fields: Sequence[tuple[str, str]], tolerance: float = 1e-3, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame, int]:
    """The claims that carry the best-supported value of every field in their group, the reliabilities (source, weight), and the rounds taken.

    ``claims`` has group, source and n (how often), and for each field the columns of value and trust named. Sources start equally
    reliable; a source's weight is (agreeing claims + 1) / (claims + 2). Equal support goes to the larger value. A claim without source
    is of a source of its own. From the tenth round on each step is half the one before, so that weights that would swing settle too.
    ``scratch`` holds the results, so that the caller can clear it.
    """
    scratch = scratch or Scratch(claims.sparkSession, "truth")
    group = W.partitionBy("group")
    claims = claims.withColumn("source", F.coalesce("source", F.lit("")))
    weights, rounds = None, 0
    while True:
        rounds += 1
        voted = claims.withColumn("weight", F.lit(0.5)) if weights is None else claims.join(weights, "source")
        # One order serves all windows: candidates for a field have the values decided before in common.
        values = [v for v, _ in fields]
        voted = voted.repartition("group").sortWithinPartitions("group", *values)
        # Rows alike in the first k values are candidates for the next field together, so the best combination is the largest at once.
        order = []
        for k, (value, trust) in enumerate(fields):
            voted = voted.withColumn(f"_votes{k}", F.sum(F.col("n") * F.col("weight")).over(W.partitionBy("group", *values[: k + 1])))
            order += [trust, f"_votes{k}", value]
        voted = voted.withColumn("_best", F.max(F.struct(*order)).over(group))
        alive, judged, agreed = F.lit(True), F.lit(0), F.lit(0)
        for value, _ in fields:
            judged = judged + alive.cast("int")
            alive = alive & F.col(value).eqNullSafe(F.col(f"_best.{value}"))
            agreed = agreed + alive.cast("int")
        voted = voted.select(*claims.columns, alive.alias("_alive"), judged.alias("_judged"), agreed.alias("_agreed"))
        judged = scratch.keep(voted)
        new = judged.groupBy("source").agg(((F.sum(F.col("n") * F.col("_agreed")) + 1.0) / (F.sum(F.col("n") * F.col("_judged")) + 2.0)).alias("weight"))
        if weights is None:
            weights, moved = scratch.keep(new), 1.0
        else:
            step = 0.5 ** max(0, rounds - 9)
            both = new.join(weights.withColumnRenamed("weight", "old"), "source").select("source", (F.col("old") + step * (F.col("weight") - F.col("old"))).alias("weight"), "old")
            both = scratch.keep(both, moved=F.max(F.abs(F.col("weight") - F.col("old"))))
            moved = seen(both, "moved")
            weights = both.select("source", "weight")
        if moved is None or moved < tolerance:
            return judged.where("_alive").drop("_alive", "_judged", "_agreed"), weights, rounds
        scratch.drop(judged)


def count_claims(members: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """(group, source, v0, t0, v1, t1, ..., n) from rows that are distinct."""
    named = [c for i, f in enumerate(fields) for c in (f.value.alias(f"v{i}"), f.trust.alias(f"t{i}"))]
    rows = members.select("group", "source", *named)
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


def survivors(members: DataFrame, fields: Sequence[Field], x: Column, gap: float, hot: Sequence[int] = (), repeated: bool = True) -> DataFrame:
    """(group, id, tie_result) of the surviving rows of each group; ``tie_result`` is 1 for a single survivor, else 2.

    ``members`` has group, id and source and the columns that the fields use. Repeated rows count once; ``repeated`` says whether there may be some; if not, ``members`` is read twice as it is. After the fields, several
    candidates are thinned by ``pieces``. ``hot``: groups with so many rows that they aren't shuffled by group (see ``hot_keys``). A group whose rows have no value in any field keeps all its candidates up to that step.
    """
    scratch, truth = Scratch(members.sparkSession, "survivors"), Scratch(members.sparkSession, "truth")
    names = [(f"v{i}", f"t{i}") for i in range(len(fields))]
    rows = members.select("group", "id", "source", x.alias("x"), *[c.alias(n) for f, (v, t) in zip(fields, names) for c, n in ((f.value, v), (f.trust, t))])
    rows = scratch.keep(rows.distinct()) if repeated else rows
    claims = scratch.keep(count_claims(rows, [Field(f.name, F.col(v), F.col(t)) for f, (v, t) in zip(fields, names)]))
    won, _, _ = discover_truth(claims, names, scratch=truth)
    scratch.drop(claims)
    # ``n`` of the claims that won are the candidates of a group: a single one needs no thinning.
    best = won.groupBy("group", *[F.col(v).alias(f"b{v}") for v, _ in names]).agg(F.sum("n").alias("m"))
    held = lookup(rows, best, "group", list(hot))
    for v, _ in names:
        held = held.where(F.col(v).eqNullSafe(F.col(f"b{v}")))
    held = scratch.keep(held.select("group", "id", "x", "m"))
    truth.clear()
    if repeated:
        scratch.drop(rows)
    left = scratch.keep(pieces(held.where("m > 1").select("group", "id", "x"), gap).distinct())
    counts = left.groupBy("group").agg(F.count(F.lit(1)).alias("k"))
    thinned = lookup(left, counts, "group", list(hot)).select("group", "id", F.when(F.col("k") == 1, 1).otherwise(2).alias("tie_result"))
    return held.where("m = 1").select("group", "id", F.lit(1).alias("tie_result")).unionAll(thinned)
