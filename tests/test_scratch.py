"""What kept tables leave on disk."""

import gc
import time
from pathlib import Path

from pyspark.sql import functions as F

from skyloom.operators.joins import hot_keys
from skyloom.session import FREED, Scratch, scratch_root, seen


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(files.apply(i)) for i in range(files.size()) if "shuffle_" in str(files.apply(i))}


def left_by(spark, run):
    """The shuffle files that a run adds and that are there still when they had time to be deleted."""
    spark.range(1).count()
    before = shuffle_files(spark)
    run()
    for _ in range(20):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    return left


def test_a_kept_table_leaves_no_shuffle_files(spark):
    gc.disable()  # no garbage of this process may free them
    try:
        kept = []
        summed = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))
        assert not left_by(spark, lambda: kept.append(Scratch(spark, "test").keep(summed, most=F.max("s"))))
        assert seen(kept[0]) == 100 == kept[0].count() and seen(kept[0], "most") == sum(range(99, 10_000, 100))
        skewed = spark.range(4000).select(F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("k"))
        assert not left_by(spark, lambda: kept.append(hot_keys(skewed, "k", 10**6))) and kept[1] == []
        assert spark.conf.get(FREED, None) in (None, "false")
        # A frame from before runs as often as one likes.
        assert summed.count() == summed.count() == 100
    finally:
        gc.enable()


def test_p5_keeps_only_what_its_result_reads(spark, data):
    from skyloom.llm.queries import QUERIES

    root = Path(scratch_root(spark).removeprefix("file:")) / "skyloom"
    tables = lambda: {p.parent for p in root.rglob("*.parquet") if p.parent.parent.name.rpartition("-")[0] in ("members", "survivors", "truth", "table-groups")}
    before = tables()
    out = QUERIES["p5_found"](spark, data)
    assert tables() - before == {Path(f.removeprefix("file://").removeprefix("file:")).parent for f in out.inputFiles()}
    assert out.count() == out.count() > 0


def test_the_first_step_of_growth_is_shuffled_once(spark):
    from skyloom.llm.groups import _grow

    links = Scratch(spark, "test").keep(spark.range(5000).select(F.col("id").alias("a"), (F.col("id") + F.col("id") % 7 + 1).alias("b"))).withColumn("level", F.lit(0))
    grown = _grow(links, [])
    assert len(grown.collect()) == links.select("a").union(links.select("b")).distinct().count()
    assert grown._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0].count("ReusedExchange") == 1
