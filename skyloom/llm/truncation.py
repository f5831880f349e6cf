"""Texts cut off by field limits or broken transfers, by a backward character n-gram model.

For the last characters of a text the model compares how often texts or lines end after them with how often they go on; a text is cut
off where the log-odds of an end fall below a threshold, fitted for each language by one rule at every size. The model is trained on
every character of all texts; contexts are kept apart by their 64-bit hashes, counted in the tasks and summed by Spark. Marks and
closing lines behind a break are taken off first; what counts as a closing line is learned from how often its form is the last line
of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.text import strip
from skyloom.llm.chars import blocks, code_points, gram_hashes, gram_sums
from skyloom.operators.joins import hot_keys, lookup
from skyloom.session import Scratch, seen

#: Context lengths, the shortest first; each is the prior of the next with the weight PRIOR.
ORDERS = (2, 4, 6)
PRIOR = 10.0
#: Contexts of an order that a task counts in place (a power of 2); the others are counted by sorting, and sent on when there are so many.
SLOTS = 1 << 20
SENT_ON = 1 << 20
#: A closing line is at most this long, and its form is last in at least this share of all texts.
CLOSER_CHARS = 40
CLOSER_SHARE = 0.002
#: The weight, in texts, of the whole table's histogram in that of each language, and the log-odds between which a threshold is sought.
PRIOR_TEXTS = 500.0
SPAN, STEP = (-6.0, -1.0), 0.25

# The codes in use for each language.
LANGUAGES = {"en": "en", "eng": "en", "de": "de", "ger": "de", "deu": "de", "fr": "fr", "fra": "fr", "fre": "fr", "es": "es", "spa": "es"}

_MARKS = regex.compile(r"(?:\s|\.\.+|…|\[(?:\.\.+|…)\]|�|\[\s*\]?|<[a-z/]{0,3})+$")


def line_form(line: Column) -> Column:
    """A line with digit runs as 0 and capitals as A."""
    return F.regexp_replace(F.regexp_replace(strip(line), r"\d+", "0"), r"\p{Lu}", "A")


def closing_forms(texts: Column, df: DataFrame) -> list[str]:
    """The forms of closing lines; at most 1 / CLOSER_SHARE of them."""
    last = F.substring_index(F.rtrim(F.regexp_replace(F.right(texts, F.lit(4 * CLOSER_CHARS)), r"\s+$", "")), "\n", -1)
    forms = df.select(F.when(F.length(last) <= CLOSER_CHARS, line_form(last)).alias("form")).groupBy("form").agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return [r["form"] for r in forms.where(F.col("form").isNotNull() & (F.col("form") != "") & (F.col("n") >= max(3.0, CLOSER_SHARE * total))).collect()]


class Trimmer:
    def __init__(self, forms: list[str]):
        self.forms = frozenset(forms)
        self.digits, self.capitals = regex.compile(r"\d+"), regex.compile(r"\p{Lu}")

    def __call__(self, text: str) -> str:
        """The text without marks and closing lines at its end."""
        t = text.rstrip()
        while (at := t.rfind("\n", max(0, len(t) - CLOSER_CHARS - 2))) >= 0:
            if self.capitals.sub("A", self.digits.sub("0", t[at + 1 :].strip())) not in self.forms:
                break
            t = t[:at].rstrip()
        if t[-1:] == "." and t[-2:] != "..":
            return t
        width = 24
        while (tail := _MARKS.search(t, max(0, len(t) - width))) and tail.start() == len(t) - width:
            width *= 2
        return t[: tail.start()] if tail else t


def _contexts(codes: np.ndarray) -> np.ndarray:
    """Code points with digits alike, blanks alike, and those of numbered list lines ("12 rotor") marked off from running text."""
    c = codes.copy()
    c[(c >= 48) & (c <= 57)] = 48
    c[(c == 9) | (c == 13) | (c == 160)] = 32
    line = np.flatnonzero((c == 10) | (c == 0))
    starts = line[:-1] + 1
    starts = starts[c[np.minimum(starts, len(c) - 1)] == 48]
    if len(starts):
        # A list line is digits, a blank and words; the mark begins with its first word and ends with the line or other signs.
        ends = line[np.searchsorted(line, starts)]
        short = ends - starts <= 64
        for s, e in zip(starts[short], ends[short]):
            part = c[s:e]
            first = int(np.argmax(part != 48))
            if part[first] == 32 and first + 1 < len(part) and part[first + 1] > 64:
                stop = np.flatnonzero((part[first:] < 65) & (part[first:] != 32) & (part[first:] != 45) & (part[first:] != 48))
                to = first + int(stop[0]) if len(stop) else len(part)
                part[first + 1 : to] += 0x200000
    return c


class Counts:
    """How often each context of one order occurs, and how often before an end. Contexts are apart by their whole hash.

    The first context to come to a slot owns it; contexts whose slot is taken are counted by sorting.
    """

    def __init__(self):
        self.owner = np.zeros(SLOTS, np.uint64)
        self.n, self.ends = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.others, self.waiting = [], 0

    def add(self, h: np.ndarray, ends: np.ndarray) -> None:
        """``h``: the hashes of contexts in a row; ``ends``: places in it of contexts before an end."""
        slot = (h & np.uint64(SLOTS - 1)).astype(np.int64)
        free = self.owner[slot] == 0
        self.owner[slot[free]] = h[free]
        own = self.owner[slot] == h
        self.n += np.bincount(slot[own], minlength=SLOTS)
        at_end = own[ends]
        self.ends += np.bincount(slot[ends[at_end]], minlength=SLOTS)
        if not own.all():
            u, n = np.unique(h[~own], return_counts=True)
            e = np.bincount(np.searchsorted(u, h[ends[~at_end]]), minlength=len(u))
            self.others.append((u, n, e))
            self.waiting += len(u)

    def rest(self):
        """(hashes, n, ends) of the contexts without a slot, which are forgotten here."""
        h, n, e = (np.concatenate(x) for x in zip(*self.others)) if self.others else (np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 2)
        u, at = np.unique(h, return_inverse=True)
        self.others, self.waiting = [], 0
        return u, np.bincount(at, n, len(u)).astype(np.int64), np.bincount(at, e, len(u)).astype(np.int64)

    def slots(self):
        at = np.flatnonzero(self.owner)
        return self.owner[at], self.n[at], self.ends[at]


def _train(forms: list[str]):
    names = ["doc", "size", *(f"f{q}" for q in ORDERS), "order", "context", "n", "ends"]

    def counted(q: int, h: np.ndarray, n: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        none = [pa.nulls(len(h), t) for t in (pa.int64(), pa.int32(), *[pa.int64()] * len(ORDERS))]
        return pa.RecordBatch.from_arrays([*none, pa.array(np.full(len(h), q, np.int32)), pa.array(h.view(np.int64)), pa.array(n), pa.array(ends)], names=names)

    def run(batches):
        trim = Trimmer(forms)
        counts = [Counts() for _ in ORDERS]
        for b, texts in blocks(batches):
            codes = code_points([trim(t) for t in texts])
            c = _contexts(codes)
            sums = gram_sums(c)
            border = np.flatnonzero(c == 0)
            stop = np.flatnonzero((c == 10) | (c == 0))
            finals = []
            for q, count in zip(ORDERS, counts):
                h = gram_hashes(sums, q)
                h[h == 0] = 1  # 0 marks a free slot
                count.add(h, stop[stop >= q] - q)  # the context before a line end or the end of a text
                at = border[1:] - q
                ok = at > border[:-1]
                final = h[at[ok]].view(np.int64)
                whole = np.zeros(len(texts), np.int64)
                whole[ok] = final
                finals.append(pa.array(whole, mask=~ok))
                if count.waiting > SENT_ON:
                    yield counted(q, *count.rest())
            size = np.diff(border) - 1
            none = (pa.nulls(len(b), t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(size.astype(np.int32)), *finals, *none], names=names)
        for q, count in zip(ORDERS, counts):
            yield counted(q, *count.slots())
            yield counted(q, *count.rest())

    return run


def end_log_odds(df: DataFrame, doc: str, text: str, scratch: Scratch) -> DataFrame:
    """(doc, log_odds) of an end after the last characters of each non-empty text, its own end left out of the counts.

    Texts that end alike are scored once, and endings that many texts share are looked up where the texts are.
    """
    rows = df.select(F.col(doc).alias("doc"), F.col(text).alias("text")).where(F.col("text").rlike(r"\S"))
    forms = closing_forms(F.col("text"), rows)
    finals = [f"f{q}" for q in ORDERS]
    columns = ", ".join(f"{f} long" for f in finals)
    trained = scratch.keep(rows.mapInArrow(_train(forms), f"doc long, size int, {columns}, `order` int, context long, n long, ends long"), texts=F.count("size"))
    model = scratch.keep(trained.where("context is not null").groupBy("order", "context").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends")))
    texts = seen(trained, "texts")
    docs = trained.where("size is not null").select("doc", *finals, F.concat_ws("/", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in finals]).alias("tail"))
    tails = scratch.keep(docs.select("tail", *finals).distinct())
    out, p = tails, F.lit(0.02)
    for q in ORDERS:
        counts = model.where(F.col("order") == q).select(F.col("context").alias(f"f{q}"), F.col("n").alias(f"n{q}"), F.col("ends").alias(f"e{q}"))
        out = lookup(out, counts, f"f{q}", hot_keys(tails, f"f{q}", seen(tails)), "left")
        n, e = F.greatest(F.coalesce(f"n{q}", F.lit(1)) - 1, F.lit(0)), F.greatest(F.coalesce(f"e{q}", F.lit(1)) - 1, F.lit(0))
        p = (e + PRIOR * p) / (n + PRIOR)
    scores = out.select("tail", F.log((p + 1e-6) / (1 - p + 1e-6)).alias("log_odds"))
    return lookup(docs.select("doc", "tail"), scores, "tail", hot_keys(docs, "tail", texts)).select("doc", "log_odds")


def language(code: Column) -> Column:
    """The language of a code in any use; "und" for null and unknown codes."""
    pairs = [x for k, v in LANGUAGES.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.lower(strip(code))), F.lit("und"))


def _thresholds(scored: DataFrame) -> dict[str, float]:
    """The emptiest place between ends and breaks for each language, its histogram shrunk towards that of all texts.

    No count switches the method: the more texts a language has, the less the whole table counts. A language in which nothing rises
    again below its emptiest place has no breaks, and no threshold.
    """
    rows = scored.groupBy("language", F.floor(F.col("log_odds") / STEP).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    lo, hi = (round(x / STEP) for x in SPAN)
    total = sum(r["n"] for r in rows)
    # The first place counts everything below the span.
    whole, each = np.zeros(hi - lo + 1), {r["language"]: np.zeros(hi - lo + 1) for r in rows}
    for r in rows:
        if r["bin"] < hi:
            whole[max(r["bin"] - lo, -1) + 1] += r["n"]
            each[r["language"]][max(r["bin"] - lo, -1) + 1] += r["n"]

    def valley(n: np.ndarray) -> float | None:
        smooth = np.convolve(n[1:], [0.25, 0.5, 1, 0.5, 0.25], "same")[2:-2]
        best = np.flatnonzero(smooth == smooth.min())
        at = best[len(best) // 2]
        return float((at + 2.5 + lo) * STEP) if max(n[: at + 3].max(), smooth[: at + 1].max()) > smooth[at] else None

    found = {name: valley(n + PRIOR_TEXTS / total * whole) for name, n in sorted(each.items())}
    return {name: at for name, at in found.items() if at is not None}


def find_truncated(df: DataFrame, doc: str, text: str, lang: str) -> DataFrame:
    """(doc, log_odds, truncated) of each row; one row for each row of ``df``.

    Null, empty and blank texts have null log-odds and are not truncated. Texts shorter than a context are judged by the shorter
    contexts. Whole texts train the model, however long.
    """
    scratch = Scratch(df.sparkSession, "truncation")
    odds = scratch.keep(end_log_odds(df, doc, text, scratch).distinct())
    scored = df.select(F.col(doc).alias("doc"), language(F.col(lang)).alias("language")).join(odds, "doc", "left")
    limit = F.lit(None).cast("double")
    for name, at in _thresholds(scored.where("log_odds is not null")).items():
        limit = F.when(F.col("language") == name, at).otherwise(limit)
    return scored.select(F.col("doc").alias(doc), "log_odds", F.coalesce(F.col("log_odds") < limit, F.lit(False)).alias("truncated"))
