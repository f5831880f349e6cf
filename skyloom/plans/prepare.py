"""One catalog made ready: its own columns renamed, typed, identified, homogenized, cut, checked and put in the common order.

The order of the steps is part of the meaning: ids are given before the quality cut, so a cut leaves gaps in them, and coordinates are
checked after it, so that rows that are cut can't fail.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyloom.functions.sky import in_fields, in_footprint
from skyloom.functions.text import na_to_null, nan_to_null, number, strip
from skyloom.operators.homogenize import homogenize, letter_flag
from skyloom.session import Scratch

# The base columns and their types, the output order, and the columns that mark an earlier output.
BASE = {"id": "string", "instrument_type": "string", "survey": "string", "ra": "double", "dec": "double", "z": "double", "z_flag": "double", "z_err": "double"}
OUTPUT = (
    "CRD_ID", "id", "ra", "dec", "z", "z_flag", "z_err", "instrument_type", "survey", "source", "tie_result", "is_in_preview_fields", "is_in_footprint",
    "compared_to", "z_flag_homogenized", "instrument_type_homogenized",
)
OWN_OUTPUT = {"CRD_ID", "ra", "dec", "z", "source"}
OWN_MARKS = {"tie_result", "compared_to", "group_id", "z_flag_homogenized", "instrument_type_homogenized"}
PREVIOUS = ("CRD_ID", "compared_to", "group_id")
CUTS = (1, 2, 3, 4, 5, 6)

# Names of the types that extra columns may have.
TYPE_NAMES = {"str": "string", "string": "string", "float": "double", "float64": "double", "double": "double", "int": "bigint", "int64": "bigint", "bool": "boolean", "boolean": "boolean"}


class EmptyCatalog(RuntimeError):
    """A catalog that has no rows after the quality cut."""


@dataclass
class Catalog:
    """A catalog as configured: its name (``<number>_<name>``), how its columns map to the base columns, and extra columns to carry."""

    name: str
    columns: Mapping[str, str | None]
    #: output name -> (source column, type)
    extra: Mapping[str, tuple[str, str]] = field(default_factory=dict)


def extra_columns(config: Mapping | None) -> dict[str, tuple[str, str]]:
    """Extra columns from a configuration ``{name: {source: ..., type: ...}}``; TypeError and ValueError for what can't be."""
    if config is None:
        return {}
    if not isinstance(config, Mapping):
        raise TypeError("extra columns: a mapping is needed")
    out = {}
    for name, spec in config.items():
        spec = {"source": name, "type": "str"} | ({"type": spec} if isinstance(spec, str) else dict(spec or {}))
        if unknown := set(spec) - {"source", "type"}:
            raise ValueError(f"extra column {name!r}: unknown options {sorted(unknown)}")
        if not str(name).strip() or not str(spec["source"]).strip():
            raise ValueError("extra columns need names")
        if spec["type"] not in TYPE_NAMES:
            raise ValueError(f"extra column {name!r}: no type {spec['type']!r}")
        if name in OUTPUT or name in BASE or name == "group_id":
            raise ValueError(f"extra column {name!r}: the name is taken")
        out[name] = (spec["source"], TYPE_NAMES[spec["type"]])
    return out


def as_bool(value) -> bool:
    """A configured truth value in any of its spellings."""
    return value if isinstance(value, bool) else str(value).strip().lower() in ("1", "true", "yes", "y", "on")


def is_own_output(columns: Sequence[str]) -> bool:
    return set(columns) >= OWN_OUTPUT and bool(set(columns) & OWN_MARKS)


def own_id_mapping(catalog: Catalog, columns: Sequence[str]) -> Catalog:
    """For an earlier output of this pipeline the id is its ``id``, or ``CRD_ID`` where it has none."""
    if not is_own_output(columns):
        return catalog
    return Catalog(catalog.name, dict(catalog.columns) | {"id": "id" if "id" in columns else "CRD_ID"}, catalog.extra)


def copy_extra(df: DataFrame, catalog: Catalog) -> DataFrame:
    """Extra columns copied from their sources before anything is renamed; a column of that name without its source is dropped."""
    for name, (source, _) in catalog.extra.items():
        df = df.withColumn(name, F.col(f"`{source}`")) if source in df.columns else df.drop(name)
    return df


def rename(df: DataFrame, catalog: Catalog) -> DataFrame:
    """The mapped columns under their base names; ``source`` and missing base columns added; ValueError for columns that aren't there.

    A column in the way of a base name is kept as ``<name>__orig``, numbered if that is taken too.
    """
    wanted = {t: s for t, s in catalog.columns.items() if s}
    missing = {t: s for t, s in wanted.items() if s not in df.columns}
    if missing:
        hints = {s: difflib.get_close_matches(s, df.columns, 3) for s in missing.values()}
        raise ValueError(f"{catalog.name}: columns that aren't there, and similar names: {hints}")
    names = {}
    taken = set(df.columns) | set(wanted)
    for target, source in wanted.items():
        if target in df.columns and target != source:
            k, parked = 0, f"{target}__orig"
            while parked in taken:
                k += 1
                parked = f"{target}__orig{k}"
            taken.add(parked)
            names[target] = parked
    cols = [F.col(f"`{s}`").alias(t) for t, s in wanted.items()]
    used = set(wanted.values())
    cols += [F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns if c in names or (c not in used and c not in wanted)]
    out = df.select(*cols)
    for c, t in BASE.items():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(t))
    return out.withColumn("source", F.lit(catalog.name))


def drop_previous(df: DataFrame) -> DataFrame:
    """Without the results of an earlier run; its tie_result stays."""
    return df.drop(*[c for c in df.columns if c in PREVIOUS or c.startswith(tuple(f"{p}_prev" for p in PREVIOUS))])


def normalize_types(df: DataFrame) -> DataFrame:
    """Base columns as their types: text stripped, missing-value tokens and NaN null, surveys in capitals, letter flags as numbers.

    ValueError, with examples, if a value of a numeric column is neither missing nor a number.
    """
    out = df
    text = {c for c, t in df.dtypes if t == "string"}
    survey = F.upper(strip(F.col("survey").cast("string")))
    checks = {}
    for c in ("ra", "dec", "z", "z_err", "z_flag", "z_flag_homogenized"):
        if c not in df.columns:
            continue
        if c in text:
            raw = na_to_null(F.col(c))
            value = letter_flag(survey, raw) if c == "z_flag" else number(raw)
            checks[c] = raw.isNotNull() & value.isNull()
        else:
            value = nan_to_null(F.col(c).cast("double"))
        out = out.withColumn(c, value)
    if checks:
        r = df.agg(*[F.count_if(v).alias(c) for c, v in checks.items()]).first()
        for c, v in checks.items():
            if r[c]:
                examples = [x[0] for x in df.where(v).select(c).limit(5).collect()]
                raise ValueError(f"{c}: {r[c]} values are no numbers, such as {examples}")
    for c in ("id", "survey", "instrument_type"):
        out = out.withColumn(c, na_to_null(F.col(c).cast("string")))
    return out.withColumn("survey", F.upper("survey")).withColumn("instrument_type", F.lower("instrument_type"))


def with_ids(df: DataFrame, name: str) -> DataFrame:
    """``df`` with CRD_ID = CRD<digits of the name>_<n>, n from 1 in the order of files and rows.

    The rows are written once with partition and place, so that every later reading sees the same ones, and numbered by the sizes of the
    partitions before, which meet them in a join. ValueError for names that don't begin with digits and an underscore.
    """
    m = re.match(r"(\d+)_", name)
    if not m:
        raise ValueError(f"a catalog name begins with a number and an underscore: {name!r}")
    placed = Scratch(df.sparkSession, "ids").keep(df.withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id()))
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("n"))
    # One row for each partition is in this one window partition.
    before = sizes.select("_p", (F.sum("n").over(W.partitionBy(F.lit(1)).orderBy("_p")) - F.col("n")).alias("_before"))
    # The lower 33 bits of the increasing id are the row's place within its partition.
    n = F.col("_before") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(before, "_p").withColumn("CRD_ID", F.concat(F.lit(f"CRD{m[1]}_"), n.cast("string"))).drop("_p", "_m", "_before")


def ids_by_order(df: DataFrame, name: str, *order: str) -> DataFrame:
    """As ``with_ids``, in the order of columns: a range shuffle, then numbers within the ranges plus the sizes of those before."""
    return with_ids(df.repartitionByRange(*order).sortWithinPartitions(*order), name)


def quality_cut(df: DataFrame, cut) -> DataFrame:
    """Rows whose homogenized flag is ``cut`` or more; every row unless ``cut`` is one of 1 to 6. Null and NaN are below any cut."""
    if cut is None or float(cut) not in CUTS:
        return df
    return df.where(nan_to_null(F.col("z_flag_homogenized")) >= float(cut))


def position_faults(ra: Column, dec: Column) -> dict[str, Column]:
    """What may be wrong with a position, as conditions that are never null."""
    no = lambda c: F.coalesce(c, F.lit(False))
    finite = lambda c: no(F.abs(c) < float("inf"))
    return {
        "ra_missing": ra.isNull() | no(F.isnan(ra)), "dec_missing": dec.isNull() | no(F.isnan(dec)),
        "ra_infinite": no(F.abs(ra) == float("inf")), "dec_infinite": no(F.abs(dec) == float("inf")),
        "ra_below": finite(ra) & no(ra < 0), "ra_above": finite(ra) & no(ra >= 360),
        "dec_below": finite(dec) & no(dec < -90), "dec_above": finite(dec) & no(dec > 90),
    }


def fault_counts(df: DataFrame) -> DataFrame:
    """One row: how many positions have each fault, and any."""
    faults = position_faults(F.col("ra"), F.col("dec"))
    anything = F.greatest(*[c.cast("int") for c in faults.values()])
    return df.agg(*[F.count_if(c).alias(n) for n, c in faults.items()], F.coalesce(F.sum(anything), F.lit(0)).alias("any_fault"))


def require_positions(df: DataFrame) -> DataFrame:
    r = fault_counts(df).first()
    if r["any_fault"]:
        bad = F.greatest(*[c.cast("int") for c in position_faults(F.col("ra"), F.col("dec")).values()]) == 1
        examples = [tuple(x) for x in df.where(bad).select("CRD_ID", "ra", "dec").limit(5).collect()]
        raise ValueError(f"positions that can't be: {r.asDict()}, such as {examples}")
    return df


def prepare(df: DataFrame, catalog: Catalog, rules: Mapping[str, Mapping], cut=None, preview_flag: bool = False, footprint: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The rows of one catalog in the output schema. ``footprint``: limit segments, where that flag is wanted; ``keep``: further columns."""
    catalog = own_id_mapping(catalog, df.columns)
    out = drop_previous(rename(copy_extra(df, catalog), catalog))
    for alias in ("z_flag_homogenized", "instrument_type_homogenized"):
        base = alias.removesuffix("_homogenized")
        if catalog.columns.get(base) == alias:  # what the mapping calls homogenized is mirrored
            out = out.withColumn(alias, F.col(base))
    out = with_ids(normalize_types(out), catalog.name)
    out = quality_cut(homogenize(out, rules), cut)
    if cut is not None and out.isEmpty():
        raise EmptyCatalog(f"{catalog.name}: no rows after the quality cut")
    tie = F.coalesce(F.col("tie_result").cast("string").try_cast("double").cast("tinyint"), F.lit(1).cast("tinyint")) if "tie_result" in out.columns else F.lit(1).cast("tinyint")
    out = require_positions(out.withColumn("compared_to", F.lit(None).cast("string")).withColumn("tie_result", tie))
    if preview_flag:
        out = out.withColumn("is_in_preview_fields", in_fields(F.col("ra"), F.col("dec")))
    if footprint is not None:
        out = in_footprint(out, footprint, "ra", "dec", "is_in_footprint")
    cols = [F.col(c) for c in OUTPUT if c in out.columns]
    for name, (_, kind) in catalog.extra.items():
        if name not in out.columns:
            cols.append(F.lit(None).cast(kind).alias(name))
        elif kind == "boolean":  # only real truth values are
            cols.append((F.col(name) if dict(out.dtypes)[name] == "boolean" else F.lit(None).cast("boolean")).alias(name))
        else:
            cols.append((F.col(name).cast("string") if kind == "string" else number(F.col(name)).try_cast(kind)).alias(name))
    cols += [F.col(f"`{c}`") for c in keep if c in out.columns and c not in OUTPUT and c not in catalog.extra]
    return out.select(*cols)
