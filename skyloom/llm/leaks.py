"""Evaluation texts within training texts, by q-gram lemma filtering.

Two texts that share a passage of ``m`` characters up to ``e`` edits share at least ``m - q + 1 - q * e`` character q-grams on
diagonals (place in the document minus place in the item) that differ by ``e`` at most. Shared q-grams are counted in overlapping
bands of diagonals; bands that reach the bound are kept as regions. In each region every run of so many words of the item is aligned
with the document within the band, free to start on any diagonal of it.

The items are the stated query set: their texts are sent to the tasks in blocks of bounded size, the tasks index them, and each block
is compared with every document where the document lies, so that documents are never shuffled.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from skyloom.llm.chars import blocks, code_points, gram_hashes, gram_sums, words_only

#: Most characters of items that are sent to the tasks at once; more items make more blocks.
ITEM_BLOCK_CHARS = 4_000_000
_BITS = 24
#: Cells of the table in which the q-grams of bands are counted first.
_CELLS = 1 << 20


class ItemIndex:
    """The q-grams of a block of items, and for each item its runs of ``words`` words.

    ``need`` tells, for each q-gram of the block, how many q-grams a run that holds it must share at least.
    """

    def __init__(self, texts: list[str], words: int, q: int, edits: int):
        self.q, self.edits = q, edits
        codes = [words_only(code_points([t]))[1:-1] for t in texts]
        self.codes, need, hashes, items, places = codes, [], [], [], []
        self.windows: list[tuple[np.ndarray, np.ndarray]] = []
        for k, c in enumerate(codes):
            gap = np.flatnonzero(c == 32)
            starts, ends = np.r_[0, gap + 1], np.r_[gap, len(c)]
            if len(c) == 0 or len(starts) < words:
                self.windows.append((starts[:0], ends[:0]))
                continue
            self.windows.append((starts[: len(starts) - words + 1], ends[words - 1 :]))
            least = np.full(max(0, len(c) - q + 1), np.iinfo(np.int64).max)
            for s, e in zip(*self.windows[-1]):
                # With runs shorter than the bound can use, a single shared q-gram is enough.
                part = least[s : max(s, e - q + 1)]
                np.minimum(part, max(1, e - s - q + 1 - q * edits), out=part)
            need.append(least)
            h = gram_hashes(gram_sums(c), q)
            hashes.append(h)
            items.append(np.full(len(h), k, np.int64))
            places.append(np.arange(len(h)))
        cat = lambda x, t: np.concatenate(x).astype(t) if x else np.empty(0, t)
        h, item, place = cat(hashes, np.uint64), cat(items, np.int64), cat(places, np.int64)
        order = np.argsort(h, kind="stable")
        self.item, self.place, self.need = item[order], place[order], cat(need, np.int64)[order]
        self.hash, self.first, self.count = np.unique(h[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << _BITS, bool)
        self.seen[(self.hash >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place in the block, item, place in the item, need) of every shared q-gram."""
        h = gram_hashes(gram_sums(codes), self.q)
        at = np.flatnonzero(self.seen[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not len(at) or not len(self.hash):
            return (np.empty(0, np.int64),) * 4
        h = h[at]
        k = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        ok = self.hash[k] == h
        at, k = at[ok], k[ok]
        n = self.count[k]
        rep = np.repeat(np.arange(len(at)), n)
        inner = np.arange(len(rep)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[k], n)
        return at[rep], self.item[inner], self.place[inner], self.need[inner]

    def regions(self, codes: np.ndarray) -> list[tuple[int, int, int, int, int, np.ndarray]]:
        """(item, start and end in the block, lowest and highest diagonal, places in the item of the shared q-grams) of each region that
        meets the bound.

        A band is ``2 * (edits + 1)`` diagonals wide; bands overlap by half. Bands without enough q-grams in all are left out by counts
        in a table, in which bands may share a place, before anything is sorted. Within a band a region ends where ``edits`` edits can't
        explain the gap to the next shared q-gram.
        """
        at, item, place, need = self.hits(codes)
        if not len(at):
            return []
        half = self.edits + 1
        diagonal = at - place + (1 << 20)
        reach = self.q * max(1, self.edits) + 1 if self.edits else 1
        key = (diagonal // half + item * 7_919) & (_CELLS - 1)
        halves = np.bincount(key, minlength=_CELLS)
        bands = halves + np.roll(halves, 1)
        full = np.flatnonzero(np.maximum(bands, np.roll(bands, -1))[key] >= need)
        at, item, diagonal, need = at[full], item[full], diagonal[full], need[full]
        if not len(full):
            return []
        out = {}
        for shift in (0, half):
            band = (diagonal + shift) // (2 * half)
            order = np.lexsort((at, band, item))
            a, i, b, p = at[order], item[order], band[order], diagonal[order] - (1 << 20)
            new = np.r_[True, (i[1:] != i[:-1]) | (b[1:] != b[:-1]) | (a[1:] - a[:-1] > reach)]
            start = np.flatnonzero(new)
            end = np.r_[start[1:], len(a)]
            ok = end - start >= np.minimum.reduceat(need[order], start)
            low, high = np.minimum.reduceat(p, start), np.maximum.reduceat(p, start)
            for s, e, d0, d1 in zip(start[ok], end[ok], low[ok].tolist(), high[ok].tolist()):
                out[int(i[s]), int(a[s]), int(a[e - 1]) + self.q, d0, d1] = np.sort(a[s:e] - p[s:e])
        return [(*k, places) for k, places in sorted(out.items(), key=lambda x: x[0])]

    def aligned(self, codes: np.ndarray, region) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number, start, end, edits) of the item's runs of words that the region holds with at most ``edits`` edits.

        For a run, a diagonal to start on and a number of edits, the farthest place in the item that an alignment reaches on each
        diagonal follows from those reached with one edit less. All runs are aligned at once.
        """
        item, lo, hi, low, high, places = region
        c, (starts, ends) = self.codes[item], self.windows[item]
        # The bound holds for each run by itself, too: its length and the q-grams within it.
        at, to = np.searchsorted(ends, lo - high, side="right"), np.searchsorted(starts, hi - low)
        shared = np.searchsorted(places, ends[at:to] - self.q, side="right") - np.searchsorted(places, starts[at:to])
        w = at + np.flatnonzero(shared >= np.maximum(1, ends[at:to] - starts[at:to] - self.q + 1 - self.q * self.edits))
        s, e = starts[w], ends[w]
        if not len(w):
            return w, w, w, w
        first, last, spare = int(s.min()), int(e.max()), 2 * self.edits
        along = np.arange(first, last)
        matched = {}
        for d in range(low - spare, high + spare + 1):  # the first place from each place on that differs on this diagonal
            there = along + d
            same = (there >= 0) & (there < len(codes))
            same &= codes[np.clip(there, 0, len(codes) - 1)] == c[first:last]
            differs = np.where(same, last, along)
            matched[d] = np.r_[np.minimum.accumulate(differs[::-1])[::-1], last]

        def slide(d: int, i: np.ndarray) -> np.ndarray:
            return matched[d][np.minimum(i, last) - first]

        best = np.full(len(w), self.edits + 1)
        begin, stop = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
        for d0 in range(low - self.edits, high + self.edits + 1):
            reached = {d0: slide(d0, s)}
            for k in range(self.edits + 1):
                if k:
                    before, reached = reached, {}
                    for d in range(d0 - k, d0 + k + 1):
                        if d not in matched:
                            continue
                        ways = [before[x] + step for x, step in ((d, 1), (d - 1, 0), (d + 1, 1)) if x in before]
                        reached[d] = slide(d, np.maximum.reduce(ways))
                for d, i in reached.items():
                    better = (i >= e) & (k < best)
                    best[better], begin[better], stop[better] = k, s[better] + d0, e[better] + d
        ok = best <= self.edits
        return w[ok], begin[ok], stop[ok], best[ok]


def _passages(index: ItemIndex, codes: np.ndarray, exact: bool) -> list[tuple[int, int, int, int]]:
    """(item, start, end, edits) of the passages in a block of documents: runs of words one after another are one passage."""
    found = {}
    for region in index.regions(codes):
        w, begin, stop, edits = index.aligned(codes, region)
        if exact:
            border = np.isin(codes[begin - 1], (0, 32)) & np.isin(codes[np.minimum(stop, len(codes) - 1)], (0, 32))
            w, begin, stop, edits = (x[(edits == 0) & border] for x in (w, begin, stop, edits))
        for k, b, e, n in zip(w.tolist(), begin.tolist(), stop.tolist(), edits.tolist()):
            key = (region[0], b, k)
            if key not in found or n < found[key][1]:
                found[key] = e, n
    out: list[list[int]] = []
    last = {}  # the passage that the next run of words would carry on
    for (item, b, k), (e, n) in sorted(found.items()):
        at = last.pop((item, k - 1), None)
        if at is None or not out[at][1] <= b <= out[at][2]:
            at = len(out)
            out.append([item, b, e, n])
        out[at][2:] = max(out[at][2], e), max(out[at][3], n)
        last[item, k] = at
    return [tuple(x) for x in out]


_INDEXES: dict[str, ItemIndex] = {}


def _index(token: str, texts: list[str], *how: int) -> ItemIndex:
    """The index of a block of items, built once by each Python process."""
    if token not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[token] = ItemIndex(texts, *how)
    return _INDEXES[token]


def find_leaks(documents: DataFrame, items: DataFrame, doc: str, text: str, item: str, item_text: str, words: int = 13, q: int = 14, edits: int = 1, exact: bool = True) -> DataFrame:
    """Passages of items within documents: (doc, item, start, end, edits), places in the document's words joined by single blanks.

    Words are runs of letters and digits in any script in lower case. A passage is one or more runs of ``words`` words of the item,
    each with at most ``edits`` edits of a character; ``edits`` is the most that one of its runs has. With ``exact`` only runs without
    edits that are whole words in the document remain. Items with fewer words, and null or empty texts, are in nothing. Repeated rows
    give repeated passages. Ids may be of any type.
    """
    spark = documents.sparkSession
    wanted = items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where("text is not null")
    total = wanted.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // ITEM_BLOCK_CHARS))
    docs = documents.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    item_type, arrow = dict(wanted.dtypes)["item"], to_arrow_schema(wanted.select("item").schema).field("item").type
    found = []
    for part in range(parts):
        rows = wanted.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).collect()
        shared = spark.sparkContext.broadcast(([r["item"] for r in rows], [r["text"] for r in rows]))  # bounded by ITEM_BLOCK_CHARS

        def search(batches, shared=shared, token=uuid.uuid4().hex):
            ids, texts = shared.value
            ix, ids = _index(token, texts, words, q, edits), pa.array(ids, arrow)
            for b, block in blocks(batches):
                codes = words_only(code_points(block))
                border = np.flatnonzero(codes == 0)
                got = _passages(ix, codes, exact)
                if not got:
                    continue
                k, s, e, n = (np.array(x, np.int64) for x in zip(*got))
                row = np.searchsorted(border, s, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc").take(pa.array(row)), ids.take(pa.array(k)), *(pa.array(x.astype(np.int32)) for x in (s - border[row] - 1, e - border[row] - 1, n))],
                    names=["doc", "item", "start", "end", "edits"],
                )

        found.append(docs.mapInArrow(search, f"doc {dict(docs.dtypes)['doc']}, item {item_type}, start int, end int, edits int"))
    return reduce(DataFrame.unionAll, found)
