"""The whole run: catalogs prepared, matched, tied and written, resumable phase by phase."""

from __future__ import annotations

import argparse
import json
import logging
import sys
import time
from collections.abc import Callable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.rules import variables
from skyloom.functions.sky import footprint_segments
from skyloom.operators import validate
from skyloom.operators.consolidate import drop_empty_columns, merge_labels, remove_duplicates, require_rows, union_aligned
from skyloom.operators.crossmatch import match, match_catalogs, merge_neighbors, neighbor_text
from skyloom.operators.dedup import TYPE_ORDER, deduplicate
from skyloom.plans.prepare import Catalog, EmptyCatalog, as_bool, extra_columns, prepare
from skyloom.session import Scratch, read_note, write_note
from skyloom.sources.catalogs import by_size, read_catalog
from skyloom.sources.sinks import column_association, save

log = logging.getLogger(__name__)

# Modes, and the parameters of matching where the rules name none.
MODES = ("concatenate", "concatenate_and_mark_duplicates", "concatenate_and_remove_duplicates")
RADIUS_ARCSEC, NEIGHBORS, GAP = 0.75, 10, 0.0


def combine(prepared: Sequence[DataFrame], mode: str, rules: Mapping, tie_option: str = "remove_all", seed: int = 0, keep: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """One catalog from prepared ones. ValueError for an unknown mode, RuntimeError where no rows are left.

    All catalogs are matched in one join: first each with itself, then each row with the nearest rows of every other source. ``keep``
    writes what a phase left under a name, or reads it where an earlier run got so far; a frame it is given may never be computed.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; there are {MODES}")
    rows = require_rows(union_aligned(*prepared), "after preparation")
    if mode == "concatenate":
        return drop_empty_columns(rows.drop("tie_result"))
    scratch = Scratch(rows.sparkSession, "combine")
    keep = keep or (lambda name, df: scratch.keep(df))
    radius, k = float(rules.get("crossmatch_radius_arcsec", RADIUS_ARCSEC)), int(rules.get("crossmatch_n_neighbors", NEIGHBORS))
    pairs = match_catalogs(rows, radius, k).unionAll(self_match_by_source(rows, radius, k))
    rows = keep("matched", merge_neighbors(rows, neighbor_text(pairs)))
    labels = keep("labels", deduplicate(rows, list(rules["tiebreaking_priority"]), float(rules.get("delta_z_threshold", GAP)), rules.get("instrument_type_priority") or TYPE_ORDER))
    rows = merge_labels(rows, labels)
    if mode == "concatenate_and_remove_duplicates":
        rows = require_rows(remove_duplicates(scratch.keep(rows), tie_option, seed), "after duplicates were removed")
    return drop_empty_columns(rows.withColumnRenamed("group", "group_id"))


def self_match_by_source(rows: DataFrame, radius: float, k: int) -> DataFrame:
    """Self-matches within each source, in one join over all sources."""
    pairs = match(rows, rows, radius, k, per_source=True, keep=F.col("left_source") == F.col("right_source"))
    return pairs.where("left_id <> right_id").select("left_id", "right_id")


class Resume:
    """The steps of a run that are done, a small file for each, and the tables they left."""

    def __init__(self, spark: SparkSession, work: str):
        self.spark, self.work = spark, work

    def done(self, step: str) -> dict | None:
        text = read_note(self.spark, f"{self.work}/steps/{step}.json")
        return json.loads(text) if text else None

    def mark(self, step: str, **what) -> dict:
        write_note(self.spark, f"{self.work}/steps/{step}.json", json.dumps(what))
        return what

    def keep(self, step: str, df: DataFrame) -> DataFrame:
        if self.done(step) is None:
            df.write.mode("overwrite").parquet(f"{self.work}/{step}")
            self.mark(step)
        return self.spark.read.parquet(f"{self.work}/{step}")


def _footprint(spark: SparkSession, param: Mapping) -> DataFrame | None:
    """The limits of the footprint from the table of border points that ``footprint_border`` names, unless the flag is switched off."""
    wanted, path = param.get("insert_rubin_footprint_flag"), param.get("footprint_border")
    if wanted is not None and not as_bool(wanted):
        return None
    if path is None:
        if wanted is not None:
            raise ValueError("the footprint flag needs footprint_border, a table of border points with ra and dec")
        return None
    return footprint_segments(read_catalog(spark, path), "ra", "dec")


def expression_columns(rules: Mapping[str, Mapping]) -> list[str]:
    """The columns that the conditions of translation rules name."""
    blocks = [b for survey in rules.values() for b in (survey or {}).values() if isinstance(b, Mapping)]
    return sorted({v for b in blocks for c in b.get("conditions") or [] for v in variables(c["expr"])})


def _checks(out: DataFrame, work: str) -> list[str]:
    """The validators' findings about a marked output, each a table in ``work``."""
    out = out.withColumns({c: F.lit(None).cast(t) for c, t in (("compared_to", "string"), ("z_flag_homogenized", "double"), ("instrument_type_homogenized", "string")) if c not in out.columns})
    checks = {"tie_findings": validate.tie_findings, "unlinked_rule": validate.unlinked_rule, "tie_crosstab": validate.tie_crosstab, "tie_counts": validate.tie_counts}
    for name, check in checks.items():
        check(out).write.mode("overwrite").parquet(f"{work}/checks/{name}")
    return sorted(checks)


def run(spark: SparkSession, config: Mapping, rules: Mapping, work: str) -> dict:
    """A run by configuration; what it did is returned and written to ``process.json`` in ``work``, with configuration and rules beside it.

    Prepared catalogs, matches and labels are kept in ``work`` and used again when a run is resumed. Empty catalogs are left out; if all
    are, RuntimeError. Columns of the tie-breaking order, and with ``save_expr_columns`` those of rule conditions, are carried along.
    """
    resume, report = Resume(spark, work), {"status": "Failed", "started": time.time(), "catalogs": {}}
    param, translations = config.get("param") or {}, rules.get("translation_rules") or {}
    entries = {e["path"]: e for e in config["inputs"]["specz"]}
    for name, what in (("config", config), ("rules", rules)):
        write_note(spark, f"{work}/{name}.json", json.dumps(what, default=str))
    try:
        prepared, border = [], _footprint(spark, param)
        extra = extra_columns(param.get("extra_columns"))
        keep = [*(rules.get("tiebreaking_priority") or []), *(expression_columns(translations) if as_bool(rules.get("save_expr_columns", False)) else [])]
        for path in by_size(list(entries)):
            entry = entries[path]
            name, kept = entry["internal_name"], f"{work}/prepared_{entry['internal_name']}"
            done = resume.done(name)
            if done is None:
                try:
                    rows = prepare(read_catalog(spark, path), Catalog(name, entry["columns"], extra), translations, param.get("z_flag_homogenized_value_to_cut"), as_bool(param.get("insert_DP1_footprint_flag", False)), border, list(dict.fromkeys(keep)))
                    rows.write.mode("overwrite").parquet(kept)
                    done = resume.mark(name, empty=False)
                except EmptyCatalog as e:
                    log.warning("%s", e)
                    done = resume.mark(name, empty=True)
            report["catalogs"][name] = "empty" if done["empty"] else "prepared"
            if not done["empty"]:
                prepared.append(spark.read.parquet(kept))
        if not prepared:
            raise RuntimeError("every catalog is empty")
        mode = param.get("combine_type", MODES[1])
        out = combine(prepared, mode, rules, param.get("tie_treatment_option", "remove_all"), int(param.get("seed", 0)), resume.keep)
        target = f"{config['output_root_dir']}/{config.get('output_dir', '')}/{config['output_name']}"
        save(out, target, config.get("output_format", "parquet"))
        report |= {"status": "Successful", "output": target, "columns_assoc": column_association(out)}
        if mode == MODES[1]:
            report["checks"] = _checks(out, work)
    finally:
        report["ended"] = time.time()
        write_note(spark, f"{work}/process.json", json.dumps(report, indent=1))
    return report


def main(args: Sequence[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Combine catalogs by a configuration.")
    p.add_argument("config", help="YAML or JSON configuration")
    p.add_argument("--work", default="work", help="folder for prepared catalogs and the report")
    a = p.parse_args(args)

    def load(path: Path):
        if path.suffix == ".json":
            return json.loads(path.read_text())
        import yaml

        return yaml.safe_load(path.read_text())

    path = Path(a.config)
    config = load(path)
    rules = load(path.parent / config["param"]["flags_translation_file"])
    from skyloom.session import build_session

    spark = build_session(**{"spark.sql.caseSensitive": "true"})
    print(json.dumps(run(spark, config, rules, a.work)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
