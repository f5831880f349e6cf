"""Many-to-one joins whose keys may be hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.session import shuffles_freed

#: A key is hot if it holds more than one in so many rows; so there are fewer hot keys than this.
HOT_PARTS = 200
#: Fewer rows than this are small work for one task, so that hot keys aren't looked for.
HOT_FROM = 1_000_000
#: Keys are counted in so many buckets first, and one by one only in buckets that hold as much as a hot key.
BUCKETS = 1 << 14


def hot_keys(df: DataFrame, key: str, total: int) -> list:
    """The keys that hold more than 1 / HOT_PARTS of all ``total`` rows, fewer than HOT_PARTS of them."""
    if total < HOT_FROM:
        return []
    df = df.where(F.col(key).isNotNull())
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS))

    def large(df: DataFrame, k: Column) -> list:
        with shuffles_freed(df.sparkSession):
            sizes = df.groupBy(k.alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
            return [r[0] for r in sizes.where(F.col("_n") * HOT_PARTS > total).select("_k").collect()]

    full = large(df, bucket)
    return large(df.where(bucket.isin(full)), F.col(key)) if full else []


def lookup(rows: DataFrame, table: DataFrame, key: str, hot: list, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has each key once. Rows of ``hot`` keys stay where they are: those few entries are broadcast."""
    if not hot:
        return rows.join(table, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return rows.where(~is_hot).join(table, key, how).unionByName(rows.where(is_hot).join(F.broadcast(table.where(is_hot)), key, how))
