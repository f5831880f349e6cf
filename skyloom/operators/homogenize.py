"""Every survey's own quality flags and instrument types on one scale."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.rules import Rule
from skyloom.functions.text import NA_TOKENS, nan_to_null, strip

# The common scales.
FLAGS = (0.0, 1.0, 2.0, 3.0, 4.0, 6.0)
TYPES = ("s", "g", "p")

# Letter and text flags of two surveys as numbers.
LETTER_FLAGS = {
    "JADES": {"A": 4.0, "B": 3.0, "C": 2.0, "D": 1.0, "E": 0.0},
    "VIMOS": {"LRB_X": 0.0, "MR_X": 0.0, "LRB_B": 1.0, "LRB_C": 1.0, "MR_C": 1.0, "MR_B": 3.0, "LRB_A": 4.0, "MR_A": 4.0},
}

# Lower ends of the parts of a confidence between 0 and 1, and what they mean.
CONFIDENCE = ((0.99, 4.0), (0.9, 3.0), (0.7, 2.0))

NORMALIZED = ("id", "ra", "dec", "z", "z_flag", "z_err", "survey", "instrument_type")


def confidence_flag(c: Column) -> Column:
    """0 for 0, 1 for (0, 0.7), 2 for [0.7, 0.9), 3 for [0.9, 0.99), 4 for [0.99, 1]; null for null, NaN and anything outside."""
    out = F.when(c == 0, 0.0).when((c > 0) & (c < CONFIDENCE[-1][0]), 1.0)
    for low, flag in CONFIDENCE:
        out = out.when((c >= low) & (c <= 1), flag)
    return F.when(~F.isnan(c), out)


def letter_flag(survey: Column, flag: Column) -> Column:
    """The number of a flag: as written, or by the survey's letters; null for anything else."""
    text = strip(flag.cast("string"))
    out = text.try_cast("double")
    for name, letters in LETTER_FLAGS.items():
        table = F.create_map(*[F.lit(x) for kv in letters.items() for x in kv])
        out = F.coalesce(out, F.when(F.upper(survey) == name, F.element_at(table, F.upper(text))))
    return nan_to_null(out)


def flags_are_confidences(df: DataFrame, flag: str) -> bool:
    """Whether all flags lie in [0, 1], and one at least strictly inside. No flags: no."""
    c = nan_to_null(F.col(flag).cast("double"))
    r = df.agg(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"), F.count_if((c > 0) & (c < 1)).alias("inside")).first()
    return bool(r["n"] and r["lo"] >= 0 and r["hi"] <= 1 and r["inside"])


def types_are_common(df: DataFrame, kind: str) -> bool:
    """Whether all non-missing types are on the common scale already. No types: no."""
    c = F.lower(strip(F.col(kind)))
    r = df.where(c.isNotNull() & ~c.isin(*NA_TOKENS)).agg(F.count(F.lit(1)).alias("n"), F.bool_and(c.isin(*TYPES)).alias("ok")).first()
    return bool(r["n"] and r["ok"])


def surveys_without_rules(df: DataFrame, rules: Mapping[str, Mapping]) -> list[str]:
    """The surveys of the rows, upper-cased and sorted, that no rule block is for."""
    known = sorted({k.upper() for k in rules})
    surveys = df.select(F.upper(strip(F.col("survey"))).alias("s")).where("s is not null and s <> ''").distinct()
    return sorted(r["s"] for r in surveys.where(~F.col("s").isin(*known)).collect())


def outside_domain(df: DataFrame, flag: str, kind: str) -> tuple[int, int]:
    """How many flags and types are off the common scales; null is on them."""
    f, t = nan_to_null(F.col(flag).cast("double")), F.lower(strip(F.col(kind)))
    r = df.agg(F.count_if(~f.isin(*FLAGS)).alias("f"), F.count_if(~t.isin(*TYPES)).alias("t")).first()
    return r["f"], r["t"]


def translate(df: DataFrame, rules: Mapping[str, Mapping], target: str, source: str, result: str, surveys: Iterable[str] | None = None) -> Column:
    """Column ``source`` by the rule of each row's survey. Only rules of ``surveys`` are compiled (default: all)."""
    wanted = None if surveys is None else {s.upper() for s in surveys}
    survey = F.upper(strip(F.col("survey")))
    out = F.lit(None).cast(result)
    for name, block in rules.items():
        if target in block and (wanted is None or name.upper() in wanted):
            rule = Rule.parse(block[target])
            out = F.when(survey == name.upper(), rule.column(source, df.schema, NORMALIZED, result)).otherwise(out)
    return out


def homogenize(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """``df`` with z_flag_homogenized and instrument_type_homogenized.

    User-provided columns of these names are checked against the scales and kept. Otherwise flags that are confidences and types that
    are common already take the short way, and the rest the rule of its survey. Raises ValueError for surveys without rules, for
    provided values off the scales, and where a whole column would be null though there are rows.
    """
    out = df
    if {"z_flag_homogenized", "instrument_type_homogenized"} & set(df.columns):
        probe = df
        for c, t in (("z_flag_homogenized", "double"), ("instrument_type_homogenized", "string")):
            if c not in probe.columns:
                probe = probe.withColumn(c, F.lit(None).cast(t))
        bad = outside_domain(probe, "z_flag_homogenized", "instrument_type_homogenized")
        if any(bad):
            raise ValueError(f"provided values off the scale: {bad[0]} flags, {bad[1]} types")
    fast_flag = "z_flag_homogenized" not in df.columns and flags_are_confidences(df, "z_flag")
    fast_type = "instrument_type_homogenized" not in df.columns and types_are_common(df, "instrument_type")
    by_rule = [c for c, fast in (("z_flag_homogenized", fast_flag), ("instrument_type_homogenized", fast_type)) if c not in df.columns and not fast]
    if by_rule:
        missing = surveys_without_rules(df, rules)
        if missing:
            raise ValueError(f"no translation for the surveys {missing}")
    present = [r["s"] for r in df.select(F.upper(strip(F.col("survey"))).alias("s")).distinct().collect() if r["s"]] if by_rule else []
    if "z_flag_homogenized" not in df.columns:
        flag = confidence_flag(F.col("z_flag")) if fast_flag else translate(df, rules, "z_flag", "z_flag", "double", present)
        out = out.withColumn("z_flag_homogenized", flag)
    if "instrument_type_homogenized" not in df.columns:
        kind = F.lower(strip(F.col("instrument_type"))) if fast_type else translate(df, rules, "instrument_type", "instrument_type", "string", present)
        out = out.withColumn("instrument_type_homogenized", kind)
    counts = out.agg(F.count(F.lit(1)).alias("n"), F.count("z_flag_homogenized").alias("f"), F.count("instrument_type_homogenized").alias("t")).first()
    if counts["n"] and not (counts["f"] and counts["t"]):
        raise ValueError("no row has a homogenized " + ("flag" if not counts["f"] else "type"))
    return out
