"""The output catalog: which rows and columns remain."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions.text import is_na_token

log = logging.getLogger(__name__)


def merge_labels(df: DataFrame, labels: DataFrame) -> DataFrame:
    """``df`` with tie_result (and group) of ``labels`` where they have the row's CRD_ID, else as it was."""
    new = labels.withColumnRenamed("tie_result", "_tie")
    old = F.col("tie_result") if "tie_result" in df.columns else F.lit(None)
    out = df.join(new, "CRD_ID", "left").withColumn("tie_result", F.coalesce("_tie", old).cast("int"))
    return out.drop("_tie")


def draw_one(df: DataFrame, seed: int = 0) -> DataFrame:
    """One of the undecided rows of each group without a winner becomes 1, the other undecided ones 0.

    The draw is by md5 of seed and CRD_ID, so it is the same wherever and however often it runs. Equal ids draw equally.
    """
    draw = F.concat(F.md5(F.concat(F.lit(f"{seed}:"), F.col("CRD_ID"))), F.lit(":"), F.col("CRD_ID"))
    tie = F.coalesce(F.col("tie_result"), F.lit(0))
    g = df.groupBy("group").agg(F.count_if(tie == 1).alias("_won"), F.min(F.when(tie == 2, draw)).alias("_drawn"))
    out = df.join(g, "group", "left")
    decided = F.when((tie == 2) & (F.col("_won") == 0), (draw == F.col("_drawn")).cast("int")).otherwise(F.col("tie_result"))
    return out.withColumn("tie_result", decided).drop("_won", "_drawn")


def remove_duplicates(df: DataFrame, option: str = "remove_all", seed: int = 0) -> DataFrame:
    """Winners only: ``remove_all`` drops undecided rows, ``keep_all`` keeps them, ``draw_one`` draws one for each group.

    Stars are dropped. An unknown option, or draw_one without groups, counts as remove_all.
    """
    if option not in ("remove_all", "keep_all", "draw_one") or (option == "draw_one" and "group" not in df.columns):
        log.warning("tie treatment %r isn't possible here; remove_all is used", option)
        option = "remove_all"
    if option == "draw_one":
        df = draw_one(df, seed)
    keep = (1, 2) if option == "keep_all" else (1,)
    return df.where(F.coalesce(F.col("tie_result"), F.lit(0)).isin(*keep))


def empty_columns(df: DataFrame, keep: Sequence[str] = ()) -> list[str]:
    """The columns that hold nothing but null and blank text, found in one pass; those in ``keep`` aside."""
    if not df.columns:
        return []
    filled = [F.count_if(F.col(f"`{c}`").isNotNull() & (F.trim(F.col(f"`{c}`")) != "" if t == "string" else F.lit(True))).alias(str(i)) for i, (c, t) in enumerate(df.dtypes)]
    r = df.agg(*filled).first()
    return [c for i, c in enumerate(df.columns) if not r[str(i)] and c not in keep]


def drop_empty_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.drop(*empty_columns(df, keep))


def require_rows(df: DataFrame, stage: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(f"no rows are left {stage}")
    return df


def sample_rows(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """A uniform sample of at most ``k`` rows that depends on seed and key alone; equal keys by the order of the hash only."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(k)


def union_aligned(*frames: DataFrame) -> DataFrame:
    """All rows, columns by name: missing ones null, types that differ as text (numbers of different width as the wider)."""
    order = ["tinyint", "smallint", "int", "bigint", "float", "double"]
    types: dict[str, str] = {}
    for f in frames:
        for c, t in f.dtypes:
            have = types.setdefault(c, t)
            if have != t:
                types[c] = order[max(order.index(have), order.index(t))] if have in order and t in order else "string"
    aligned = [f.select(*[(F.col(f"`{c}`") if c in f.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]) for f in frames]
    out = aligned[0]
    for f in aligned[1:]:
        out = out.unionAll(f)
    return out
