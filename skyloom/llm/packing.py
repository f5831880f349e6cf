"""Fixed-capacity containers filled with items of varying length, by bounded-space online best fit.

A fixed number of bins is open at a time, kept in a bitset keyed by free space. An item goes to the open bin that it fills best; if
none has room, a bin is opened, and if too many are open, the fullest closes first. Spark deals the items out by hash into streams
long enough that what remains open at their ends is a small share.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.chars import blocks
from skyloom.session import Scratch, seen

#: Bins open at a time in a stream.
OPEN_BINS = 64
#: Containers that a stream should fill: at most OPEN_BINS of so many are left partly filled when it ends. On the test documents 256 give
#: many streams for the price of half a percent of space against 8,192.
CONTAINERS_PER_STREAM = 256
#: Containers for each task where there are more streams than cores.
CONTAINERS_PER_TASK = 16_384

#: The pattern that splits texts before merging, unless another is given.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(df: DataFrame, key: str, text: str, vocabulary: str, pattern: str = PATTERN) -> DataFrame:
    """(key, tokens): the length of each text in tokens; 0 for null and empty texts.

    ``vocabulary``: the path, on every machine, of a byte-level BPE vocabulary as lines of token (base64) and rank.
    """
    key_type = dict(df.dtypes)[key]

    def run(batches):
        encode = _encoding(vocabulary, pattern).encode_ordinary
        for b, texts in blocks(batches):
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([len(encode(t)) for t in texts], pa.int64())], names=["key", "tokens"])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {key_type}, tokens long").select(F.col("key").alias(key), "tokens")


class OpenBins:
    """At most ``most`` open bins of a capacity. ``place`` returns the number of the bin that takes an item, and the space used before it."""

    def __init__(self, capacity: int, most: int = OPEN_BINS):
        self.capacity, self.most = capacity, most
        self.bits, self.bins, self.open, self.opened = 0, {}, 0, 0

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        number = stack.pop()
        if not stack:
            del self.bins[free]
            self.bits ^= 1 << free
        self.open -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        room = self.bits >> size
        if room:
            free = size + (room & -room).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.capacity, self.opened
            self.opened += 1
        left = free - size
        if left:
            self.bins.setdefault(left, []).append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - free


def pack(sizes: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """(key, piece, container, start, length): where each piece of each item lies.

    Items up to ``capacity`` stay whole (piece 0). A longer item is cut into pieces of the full capacity, each in a container of its
    own, and a rest that is packed like any item. Null and negative sizes count as 0; items of size 0 are placed too. Every row is
    an item, repeated keys included. No rows give no containers.
    """
    spark = sizes.sparkSession
    items = Scratch(spark, "packing").keep(sizes.select(F.col(key).alias("key"), F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("size")), total=F.sum("size"))
    total = seen(items, "total") or 0
    streams = max(1, int(total // (capacity * CONTAINERS_PER_STREAM)))
    tasks = min(streams, max(spark.sparkContext.defaultParallelism, int(total // (capacity * CONTAINERS_PER_TASK))))
    dealt = items.withColumn("stream", F.pmod(F.xxhash64("key"), F.lit(streams)).cast("int"))
    key_type = dict(items.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]):
        stream, bins = None, None
        for b in batches:
            keys, pieces, containers, starts, lengths = [], [], [], [], []
            for k, (s, n) in enumerate(zip(b.column("stream").to_pylist(), b.column("size").to_pylist())):
                if s != stream:
                    stream, bins = s, OpenBins(capacity)
                piece = 0
                while n > capacity:  # a full container of its own
                    keys.append(k), pieces.append(piece), containers.append((s << 32) + bins.opened), starts.append(0), lengths.append(capacity)
                    bins.opened += 1
                    n, piece = n - capacity, piece + 1
                number, start = bins.place(n)
                keys.append(k), pieces.append(piece), containers.append((s << 32) + number), starts.append(start), lengths.append(n)
            yield pa.RecordBatch.from_arrays(
                [b.column("key").take(pa.array(keys, pa.int64())), *(pa.array(np.array(x, np.int64)) for x in (pieces, containers, starts, lengths))],
                names=["key", "piece", "container", "start", "length"],
            )

    laid = dealt.repartition(tasks, "stream").sortWithinPartitions("stream", F.xxhash64("key", F.lit(1)), "key", "size")
    out = laid.mapInArrow(run, f"key {key_type}, piece long, container long, start long, length long")
    return out.withColumnRenamed("key", key)
