"""Rows that fail to parse: the loadable records of text files, and apart from them the rejected ones with the reason.

Records are parsed in blocks on Arrow's columnar CSV reader. A block it refuses (or that breaks a rule which that reader doesn't
know) is parted again and again until the records at fault stand alone; only these are diagnosed character by character. Where the
block's columnar tests accuse some of its records, these are parted from the rest first; otherwise a block is halved. Blocks
hold records of any files that share delimiter, width and position of the checked column, so small files make no small blocks and
a file with a third of all lines is spread over many tasks.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.text import INVISIBLE, NA_TOKENS, strip

# Formats that can be loaded, and the compressions that may follow.
FORMAT = r"^\.?(csv|tsv|txt)(\.(gz|bz2|xz|zst))?$"
FORMAT_IN_NAME = r"\.(csv|tsv|txt)(\.(gz|bz2|xz|zst))?$"
DELIMITERS = (",", ";", "\t", "|")
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_NUMBER = re.compile(NUMBER)

#: Records parsed at once.
BLOCK = 4096
#: Records a task should have: their cost is Python's time, not their bytes, by which Spark would size tasks.
RECORDS_PER_TASK = 20_000


def loadable_format(fmt: Column, name: Column) -> Column:
    """Whether the declared format (or, where that is null, the end of the file name) can be loaded. Both null: no."""
    declared = F.lower(strip(fmt)).rlike(FORMAT)
    return F.coalesce(declared, F.lower(strip(name)).rlike(FORMAT_IN_NAME), F.lit(False))


def clean_line(line: Column) -> Column:
    """Without byte-order marks at the start and carriage returns and line feeds at the end."""
    return F.regexp_replace(F.regexp_replace(line, r"^﻿+", ""), r"[\r\n]+$", "")


def split_record(line: str, delimiter: str) -> list[str] | None:
    """The fields of a record; None if a quote that opens a field isn't closed or isn't followed by delimiter or end."""
    out, at, n = [], 0, len(line)
    while True:
        if at < n and line[at] == '"':
            end = at + 1
            while True:
                end = line.find('"', end)
                if end < 0:
                    return None
                if line[end + 1 : end + 2] != '"':
                    break
                end += 2
            out.append(line[at + 1 : end].replace('""', '"'))
            at = end + 1
            if at < n and line[at] != delimiter:
                return None
        else:
            end = line.find(delimiter, at)
            end = n if end < 0 else end
            out.append(line[at:end])
            at = end
        if at >= n:
            return out
        at += 1


def good_number(text: str) -> bool:
    t = text.strip()
    return t.lower() in NA_TOKENS or bool(_NUMBER.match(t)) and t.isascii() and math.isfinite(float(t))


def diagnose(line: str, delimiter: str, width: int, at: int) -> tuple[str | None, list[str] | None]:
    """(reason, fields) of one record, strictly; no reason if it loads after all."""
    fields = split_record(line, delimiter)
    if fields is None:
        return "quoting", None
    if len(fields) != width:
        return "column_count", fields
    if at >= 0 and not good_number(fields[at]):
        return "z_value", fields
    return None, fields


def _bulk(lines: pa.Array, delimiter: str, width: int, at: int) -> tuple[list[pa.Array] | None, np.ndarray | None]:
    """The columns of a block in which every record loads; else None and, as far as the columnar tests can tell, the records at fault."""
    d = re.escape(delimiter).replace("\\\t", "\t")
    quoted = pc.match_substring(lines, '"')
    field = rf'(?:"(?:[^"]|"")*"|[^"{d}][^{d}]*|)'
    whole = pc.match_substring_regex(lines, rf"\A(?s:{field}(?:{d}{field})*)\z") if pc.any(quoted).as_py() else quoted
    broken = pc.if_else(quoted, pc.invert(whole), pc.match_substring_regex(lines, r"[\r\n]")).to_numpy(zero_copy_only=False)
    if broken.any():
        return None, broken
    names, wrong = [str(i) for i in range(width)], []

    def note(row: csv.InvalidRow) -> str:
        wrong.append(row.number - 1)
        return "skip"

    try:
        t = csv.read_csv(
            pa.py_buffer(("\n".join(lines.to_pylist()) + "\n").encode()),
            csv.ReadOptions(column_names=names, block_size=1 << 27, use_threads=False),
            csv.ParseOptions(delimiter=delimiter, newlines_in_values=True, ignore_empty_lines=False, invalid_row_handler=note),
            csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False),
        )
    except pa.ArrowInvalid:
        return None, None
    if t.num_rows + len(wrong) != len(lines):
        return None, None
    if wrong:
        broken[wrong] = True
        return None, broken
    columns = [c.combine_chunks() for c in t.columns]
    if at >= 0:
        z = pc.utf8_trim_whitespace(columns[at])
        numeric = pc.match_substring_regex(z, NUMBER)
        finite = pc.is_finite(pc.cast(pc.if_else(numeric, z, "0"), pa.float64(), safe=False))
        good = pc.or_(pc.is_in(pc.utf8_lower(z), pa.array(NA_TOKENS)), pc.and_(numeric, finite))
        if not pc.all(good).as_py():
            return None, pc.invert(good).to_numpy(zero_copy_only=False)
    return columns, None


def _rows_of(columns: list[pa.Array]) -> pa.ListArray:
    n, width = len(columns[0]), len(columns)
    cells = pa.concat_arrays(columns).take(pa.array(np.arange(n * width).reshape(width, n).T.ravel()))
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width), pa.int32()), cells)


def parse_block(lines: pa.Array, delimiter: str, width: int, at: int):
    """(positions, reasons, fields) of the records in runs; reasons is None for a run that loads."""
    todo = [np.arange(s, min(s + BLOCK, len(lines))) for s in range(0, len(lines), BLOCK)]
    while todo:
        k = todo.pop()
        if len(k) == 1:
            reason, fields = diagnose(lines[k[0]].as_py(), delimiter, width, at)
            yield k, [reason], pa.array([fields], pa.list_(pa.string()))
            continue
        columns, accused = _bulk(lines.take(pa.array(k)), delimiter, width, at)
        if columns is not None:
            yield k, None, _rows_of(columns)
        elif accused is not None and not accused.all():
            todo += [k[accused], k[~accused]]
        else:
            todo += [k[: len(k) // 2], k[len(k) // 2 :]]


def _load(every: bool):
    """Parses batches of records; with ``every`` the records that load come out too, with their fields."""
    names = ["file_id", "line_no", "reason", "fields"]

    def run(batches):
        for b in batches:
            where = b.select(["file_id", "line_no"])
            ok = b.column("ok").to_numpy(zero_copy_only=False)
            wrong = np.flatnonzero(~ok)
            if len(wrong):
                w = where.take(pa.array(wrong))
                yield pa.RecordBatch.from_arrays([*w.columns, pa.array(["format"] * len(w), pa.string()), pa.nulls(len(w), pa.list_(pa.string()))], names=names)
            kind = pc.binary_join_element_wise(b.column("delimiter"), b.column("width").cast(pa.string()), b.column("at").cast(pa.string()), " ").dictionary_encode()
            codes = kind.indices.to_numpy()
            for code in np.unique(codes[ok]):
                at = np.flatnonzero(ok & (codes == code))
                first = at[0]
                lines = b.column("line").take(pa.array(at))
                for k, reasons, fields in parse_block(lines, b.column("delimiter")[first].as_py(), b.column("width")[first].as_py(), b.column("at")[first].as_py()):
                    if every or reasons and reasons[0]:
                        w = where.take(pa.array(at[k]))
                        yield pa.RecordBatch.from_arrays([*w.columns, pa.array(reasons or [None] * len(k), pa.string()), fields], names=names)

    return run


def _header_fields(header: pd.Series, delimiter: pd.Series) -> pd.Series:
    return pd.Series([split_record(h, d) or h.replace('"', "").split(d) for h, d in zip(header, delimiter)])


def load_records(lines: DataFrame, files: DataFrame, columns: DataFrame, every: bool = True) -> DataFrame:
    """(file_id, line_no, reason, fields, header) of every record of ``lines``; ``reason`` is null where the record loads.

    Without ``every`` only the rejected ones come out.

    The first line of a file that is neither blank nor a comment is its header; its commonest of comma, semicolon, tab and bar
    outside quotes is the delimiter (ties by that order; none: one column). Null lines count as blank. A file missing from
    ``files`` has no loadable format; a file without header has no records; a source without ``z_column``, or whose header doesn't
    name it, has no checked column. Repeated rows are judged each. Lines of any length are parsed whole.
    """
    text = lines.select("file_id", "line_no", clean_line(F.col("line")).alias("line"))
    text = text.where(F.col("line").isNotNull() & (strip(F.col("line")) != "") & ~F.ltrim("line").startswith("#"))
    header = text.groupBy("file_id").agg(F.min("line_no").alias("header_no"), F.min_by("line", "line_no").alias("header"))
    bare = F.regexp_replace("header", r'"[^"]*+(?:""[^"]*+)*+"', "")
    counts = F.array(*[F.struct((F.length(bare) - F.length(F.replace(bare, F.lit(c)))).alias("n"), F.lit(-i).alias("i"), F.lit(c).alias("c")) for i, c in enumerate(DELIMITERS)])
    info = header.join(files.select("file_id", "source", "format", "file_name").dropDuplicates(["file_id"]), "file_id", "left").join(
        columns.select("source", "z_column"), "source", "left"
    )
    info = info.withColumn("delimiter", F.array_max(counts)["c"])
    info = info.withColumn("names", F.transform(F.pandas_udf(_header_fields, "array<string>")("header", "delimiter"), lambda v: strip(F.regexp_replace(v, INVISIBLE, ""))))
    names = F.col("names")
    info = info.select(
        "file_id", "header_no", "delimiter", names.alias("header"), F.size(names).alias("width"),
        (F.coalesce(F.array_position(names, F.col("z_column")), F.lit(0)) - 1).cast("int").alias("at"),
        loadable_format(F.col("format"), F.col("file_name")).alias("ok"),
    )
    records = text.join(info, "file_id").where(F.col("line_no") > F.col("header_no"))
    sc = lines.sparkSession.sparkContext
    tasks = max(sc.defaultParallelism, -(-lines.count() // RECORDS_PER_TASK))
    dealt = records.select("file_id", "line_no", "line", "delimiter", "width", "at", "ok").repartition(tasks, "file_id", "line_no")
    parsed = dealt.mapInArrow(_load(every), "file_id long, line_no int, reason string, fields array<string>")
    return parsed.join(info.select("file_id", "header"), "file_id", "left")
