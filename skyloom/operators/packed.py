"""Several values packed in one field: one row per value, with its place.

The writing of a field (its *dialect*: which delimiters separate, which quotes enclose) is not declared anywhere.
Every candidate dialect is a description of the field, and the shortest description wins (minimum description length):

* A field's *pattern* is the field with digit runs as ``9`` and letter runs as ``A``. Letters and digits cost the same bits under
  every dialect, so a choice made for a pattern holds for all its fields, and only distinct patterns are scored.
* The code length of a value comes from how often its shape occurs among all values of the column, counted by Spark over every row.
  Shapes that never occur pay for each of their characters.
* Delimiters that a parse uses pay for themselves once, and each separator pays a little.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.text import BLANKS, INVISIBLE, is_na_token, strip
from skyloom.session import Scratch, seen, shuffles_freed

# The delimiters and quotes that a dialect may use; "s" stands for a run of blanks.
DELIMITERS = {",": ",，", ";": ";；", "|": "|", "/": "/", "s": None}
QUOTES = ("\"", "'")
BRACKETS = "[]{}()"

_PY_BLANK = r"\s\u0085"
# The signs of BLANKS, in ranges: Java tries the parts of a class one after another.
_JAVA_BLANK = "\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Signs that may cling to a value besides the common blanks: brackets and the other blanks.
_UNUSUAL = "[\\[\\]{}()" + "".join(c for c in BLANKS if c not in " \t\r\n\xa0") + "]"

#: Most bytes of patterns that are broadcast; beyond it rows and patterns meet in a shuffled join.
MAX_BROADCAST_BYTES = 16 << 20
#: Parts of each pattern's rows in that join.
SALTS = 16


def _class(delims: str, blank: str) -> str:
    return "".join(blank if d == "s" else re.escape(DELIMITERS[d]) for d in delims)


def token_regex(delims: str, quotes: str, blank: str = _JAVA_BLANK) -> str:
    """What a dialect takes for one value: a quoted run (a doubled quote counts as one) or a run without delimiters and outer blanks.

    Repeats are possessive: they can't match otherwise, and Java tries them without recursion, however long the field.
    """
    quoted = "".join(f"{q}[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}|" for q in quotes)
    run = f"[^{_class(delims.replace('s', ''), blank)}{blank}]++"
    return f"{quoted}{run}" if "s" in delims else f"{quoted}{run}(?:[{blank}]++{run})*+"


def cleaned(field: Column) -> Column:
    """The field without invisible characters, enclosing brackets, and blanks and delimiters (they hold empty values) at its ends."""
    edge = BLANKS + BRACKETS + "".join(c for c in DELIMITERS.values() if c)
    return F.btrim(F.regexp_replace(field, INVISIBLE, ""), F.lit(edge))


def pattern_of(field: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(field, r"\d+", "9"), r"\p{L}+", "A")


def unquoted(token: Column) -> Column:
    """The value of a token: outer blanks, brackets and enclosing quotes removed, doubled quotes as one."""
    t = strip(token)
    for q in QUOTES:
        body = F.substring(t, F.lit(2), F.length(t) - 2)
        t = F.when(t.startswith(q) & t.endswith(q) & (F.length(t) >= 2), F.regexp_replace(body, q + q, q)).otherwise(t)
    return F.btrim(t, F.lit(BLANKS + BRACKETS))


def _parses(batches):
    """(pattern, dialect, quotes, regex, fixed, value, m): the values of each pattern under each dialect, and the bits besides their codes."""
    finders: dict[tuple[str, str], re.Pattern] = {}
    for pdf in batches:
        out = []
        for pattern in pdf["pattern"]:
            present = [d for d in DELIMITERS if (re.search(rf"[{_PY_BLANK}]", pattern) if d == "s" else any(c in pattern for c in DELIMITERS[d]))]
            quotes = [q for q in QUOTES if q in pattern]
            options = itertools.product(*([[x for n in range(len(have) + 1) for x in itertools.combinations(have, n)] for have in (present, quotes)]))
            for d, q in (("".join(d), "".join(q)) for d, q in options):
                if (d, q) not in finders:
                    finders[d, q] = re.compile(token_regex(d, q, _PY_BLANK))
                fixed, covered, values = 2.0 * len(d) + 3.0 * len(q), 0, Counter()  # naming the dialect
                for m in finders[d, q].finditer(pattern):
                    token = m.group().strip()
                    covered += len(m.group())
                    fixed += 1.0
                    if len(token) > 1 and token[0] in q and token[-1] == token[0]:
                        token, fixed = token[1:-1].strip(), fixed + 1.0
                    values[token] += 1
                fixed += 3.0 * (len(pattern) - covered)  # separators, at the same cost under every dialect
                regex = token_regex(d, q) if q else None
                out += [(pattern, d, q, regex, fixed, v, n) for v, n in (values or {"": 0}).items()]
        yield pd.DataFrame(out, columns=["pattern", "dialect", "quotes", "regex", "fixed", "value", "m"])


def choose_dialects(patterns: DataFrame) -> DataFrame:
    """(pattern, n) -> (pattern, dialect, regex, unusual): the cheapest dialect of each pattern, ties to fewer delimiters.

    ``dialect`` are the keys of the DELIMITERS that separate; ``regex`` finds the values, and is null for dialects without quotes. Code
    lengths stay distributed: the values of all parses meet the counts of their shapes in a join.
    """
    finest = token_regex("".join(DELIMITERS), "".join(QUOTES))
    shapes = (
        patterns.select("n", F.explode(F.regexp_extract_all("pattern", F.lit(finest), F.lit(0))).alias("token"))
        .select("n", unquoted(F.col("token")).alias("value"))
        .where(F.col("value") != "")
        .groupBy("value").agg(F.sum("n").alias("n"))
    )
    shapes = Scratch(patterns.sparkSession, "shapes").keep(shapes, values=F.sum("n"))
    total = (seen(shapes, "values") or 0) + 1
    parses = patterns.select("pattern").mapInPandas(_parses, "pattern string, dialect string, quotes string, regex string, fixed double, value string, m int")
    code = F.when(F.col("n").isNotNull(), -F.log2(F.col("n") / float(total))).otherwise(math.log2(total) + 7.0 * F.length("value"))
    bits = F.round(F.max("fixed") + F.sum(F.col("m") * code), 6)
    scored = parses.join(shapes, "value", "left").groupBy("pattern", "dialect", "quotes", "regex").agg(bits.alias("bits"))
    best = F.min(F.struct("bits", F.length("dialect").alias("signs"), "dialect", "quotes", "regex"))
    # Letters and digits don't cling, so what has to be taken off values shows in the pattern.
    return scored.groupBy("pattern").agg(best.alias("b")).select("pattern", "b.dialect", "b.regex", F.col("pattern").rlike(_UNUSUAL).alias("unusual"))


def _divided(field: Column, dialect: Column) -> Column:
    """The field cut at the separators of an unquoted dialect. Each dialect has a pattern of its own, so none is compiled row by row."""
    out = F.array(field)
    for n in range(1, len(DELIMITERS) + 1):
        for d in itertools.combinations(DELIMITERS, n):
            signs = "".join(re.escape(DELIMITERS[c]) for c in d if c != "s")
            cut = f"[{signs}{_JAVA_BLANK}]++" if "s" in d else f"[ \t\r\n\xa0]*+[{signs}][{signs} \t\r\n\xa0]*+"
            out = F.when(dialect == "".join(d), F.split(F.regexp_replace(field, cut, "\u0001"), "\u0001")).otherwise(out)
    return out


def _regexes(chosen: DataFrame) -> list[str]:
    """The regexes in use, no more than there are dialects with quotes. Each has a place of its own in the plan, so none is compiled row by row."""
    with shuffles_freed(chosen.sparkSession):
        return sorted(r[0] for r in chosen.where("regex is not null").select("regex").distinct().collect())


def packed_values(df: DataFrame, key: str, field: str) -> DataFrame:
    """(key, values): the values of each row's field in order, null fields left out; the rest as in ``split_packed``.

    For one row each, take ``explode_outer`` and leave out nulls: before ``explode`` Spark tests the size of the array, which would
    parse every field twice.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("key"), cleaned(F.col(field)).alias("field"), F.col(field).alias("raw")).where("raw is not null").drop("raw")
    # No pattern is null; said here, else the join would test it and parse every field twice.
    rows = rows.withColumn("pattern", F.coalesce(pattern_of(F.col("field")), F.lit("")))
    patterns = rows.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    scratch = Scratch(spark, "packed")
    size = F.sum(F.octet_length("pattern") + F.coalesce(F.octet_length("regex"), F.lit(0)) + 64)
    chosen = scratch.keep(choose_dialects(scratch.keep(patterns)), bytes=size)
    if (seen(chosen, "bytes") or 0) <= MAX_BROADCAST_BYTES:
        joined = rows.join(F.broadcast(chosen), "pattern")
    else:  # one pattern may hold a third of all rows
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("key", "field"), F.lit(SALTS)).cast("int"))
        joined = salted.join(chosen.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["salt", "pattern"])
    # Without quotes and brackets every separator separates, and what lies between is a value as it stands.
    plain = _divided(F.col("field"), F.col("dialect"))
    bare = F.filter(F.transform(plain, unquoted), lambda v: v != "")
    values = F.when(F.col("unusual"), bare).otherwise(plain)
    if regexes := _regexes(chosen):
        tokens = F
        for regex in regexes:
            tokens = tokens.when(F.col("regex") == regex, F.regexp_extract_all("field", F.lit(regex), F.lit(0)))
        values = F.when(F.col("regex").isNotNull(), F.filter(F.transform(tokens, unquoted), lambda v: v != "")).otherwise(values)
    # Only fields with the letters of a missing-value token can hold one.
    low = F.lower("field")
    values = F.when(low.contains("na") | low.contains("null") | low.contains("none"), F.filter(values, lambda v: ~is_na_token(v))).otherwise(values)
    return joined.select(F.col("key").alias(key), F.when(F.col("field") == "", F.array().cast("array<string>")).otherwise(values).alias("values"))


def split_packed(df: DataFrame, key: str, field: str) -> DataFrame:
    """Distinct (key, pos, value) of every value in ``field``; ``pos`` counts the values of a field from 1, repeats included.

    Null, empty and missing-value fields give no rows, nor do empty values within a field. Rows whose key is null are kept with a
    null key. Repeated rows give their values once. Fields of any length are parsed whole.
    """
    out = packed_values(df, key, field).select(key, F.posexplode_outer("values").alias("at", "value")).where("value is not null")
    return out.select(key, (F.col("at") + 1).cast("int").alias("pos"), "value").distinct()
