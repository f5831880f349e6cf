"""Text normalization as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The missing-value tokens, compared in lower case with blanks around them ignored.
NA_TOKENS = ("", "na", "nan", "null", "none", "<na>")

# Characters that show nothing (U+200B-U+200D and U+FEFF).
INVISIBLE = "[​-‍﻿]"

# Every Unicode blank. Java's \\s and Spark's trim know only some of them.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
BLANK = f"[{BLANKS}]"


def strip(c: Column) -> Column:
    """Remove every kind of blank at both ends. Null stays null."""
    return F.btrim(c, F.lit(BLANKS))


def canonical_id(c: Column) -> Column:
    """An identifier without invisible characters and outer blanks. Null stays null."""
    return strip(F.regexp_replace(c, INVISIBLE, ""))


def is_na_token(c: Column) -> Column:
    """True for null and for a missing-value token."""
    return c.isNull() | F.lower(strip(c)).isin(*NA_TOKENS)


def na_to_null(c: Column) -> Column:
    """The stripped text, or null for a missing-value token."""
    return F.when(~is_na_token(c), strip(c))


def number(c: Column) -> Column:
    """A double from text as pandas would read it, else null: no type suffixes, no NaN."""
    t = strip(c.cast("string"))
    ok = t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.when(ok, t.try_cast("double"))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)
