"""Catalog files as DataFrames: parquet, delimited text, FITS tables and HATS directories."""

from __future__ import annotations

import bz2
import gzip
import logging
import lzma
import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.text import na_to_null, number, strip

log = logging.getLogger(__name__)

# Compressions and endings of text files, and the share of numbers that makes a column numeric.
COMPRESSIONS = (".gz", ".bz2", ".xz", ".zst")
TEXT = (".csv", ".tsv", ".txt")
SNIFF_BYTES = 128 * 1024
NUMERIC_SHARE = 0.995
FITS_ROWS_PER_TASK = 1_000_000


def format_of(path: str) -> str:
    """parquet, text, fits, hdf5 or hats; ValueError for anything else. Directories must be HATS or parquet part files."""
    p = Path(path)
    if p.is_dir():
        if hats_root(path):
            return "hats"
        if any(p.glob("*.parquet")):
            return "parquet"
        raise ValueError(f"a directory that is no HATS catalog: {path}")
    name = p.name.lower()
    for c in COMPRESSIONS:
        if name.endswith(c) and Path(name[: -len(c)]).suffix in TEXT:
            return "text"
    match p.suffix.lower():
        case ".parquet" | ".pq":
            return "parquet"
        case ".csv" | ".tsv" | ".txt":
            return "text"
        case ".fits" | ".fit":
            return "fits"
        case ".hdf5" | ".h5" | ".hdf":
            return "hdf5"
    raise ValueError(f"unknown format: {path}")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    match format_of(path):
        case "parquet":
            return unique_names(spark.read.parquet(path))
        case "text":
            return read_text(spark, path)
        case "fits":
            return read_fits(spark, path)
        case "hats":
            return read_hats(spark, path)
    return read_hdf5(spark, path)


def unique_names(df: DataFrame) -> DataFrame:
    """Repeated column names become ``name__dup1`` and so on."""
    seen, names = set(), []
    for c in df.columns:
        n, k = c, 0
        while n in seen:
            k += 1
            n = f"{c}__dup{k}"
        seen.add(n)
        names.append(n)
    return df.toDF(*names) if names != df.columns else df


# ------------------------------------------------------------ delimited text


def _first_bytes(path: str) -> bytes:
    name = path.lower()
    if name.endswith(".gz"):
        opened = gzip.open(path, "rb")
    elif name.endswith(".bz2"):
        opened = bz2.open(path, "rb")
    elif name.endswith(".xz"):
        opened = lzma.open(path, "rb")
    elif name.endswith(".zst"):
        import zstandard

        opened = zstandard.open(path, "rb")
    else:
        opened = open(path, "rb")
    with opened as f:
        return f.read(SNIFF_BYTES)


def sniff(path: str) -> tuple[str, bool, int]:
    """(delimiter, whether the first row is a header, width) from the first bytes, unpacked first.

    The delimiter is the commonest of comma, tab, semicolon and bar in the first row; it is a header if half its cells or more are no
    numbers (one at least).
    """
    lines = [x for x in _first_bytes(path).decode("utf-8", "replace").lstrip("﻿").splitlines() if x.strip() and not x.startswith("#")]
    if not lines:
        return ",", False, 0
    d = max(",\t;|", key=lambda c: (lines[0].count(c), -",\t;|".index(c)))
    cells = [c.strip().strip('"') for c in lines[0].split(d)]

    def numeric(c: str) -> bool:
        try:
            float(c)
            return True
        except ValueError:
            return False

    return d, sum(not numeric(c) for c in cells) >= max(1, len(cells) // 2), len(cells)


def infer_types(df: DataFrame) -> dict[str, str]:
    """boolean, bigint, double or string for each text column, from one aggregate over all rows.

    Columns whose values are all true or false are boolean; those of which NUMERIC_SHARE or more are numbers are double, or bigint if
    no number has a fraction; columns without values are string. Values that such a column can't hold are counted in the log.
    """
    aggs = []
    for i, c in enumerate(df.columns):
        v = na_to_null(F.col(f"`{c}`"))
        n = number(v)
        aggs += [
            F.count(v).alias(f"n{i}"), F.count(n).alias(f"k{i}"), F.count_if(F.lower(v).isin("true", "false")).alias(f"b{i}"), F.count_if(n != F.floor(n)).alias(f"f{i}")
        ]
    r = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(df.columns):
        n = r[f"n{i}"]
        if n and r[f"b{i}"] == n:
            out[c] = "boolean"
        elif n and r[f"k{i}"] / n >= NUMERIC_SHARE:
            out[c] = "double" if r[f"f{i}"] else "bigint"
            if n > r[f"k{i}"]:
                log.warning("column %s: %d values are no numbers and become null", c, n - r[f"k{i}"])
        else:
            out[c] = "string"
    return out


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns as their types; what doesn't fit, and missing-value tokens, become null. 0 and 1 never become boolean."""
    cols = []
    for c in df.columns:
        v = na_to_null(F.col(f"`{c}`"))
        match types.get(c, "string"):
            case "boolean":
                v = F.when(F.lower(v) == "true", True).when(F.lower(v) == "false", False)
            case "bigint":
                n = number(v)
                v = F.coalesce(v.try_cast("bigint"), F.when(n == F.floor(n), n.cast("bigint")))
            case "double":
                v = number(v)
        cols.append(v.alias(c))
    return df.select(*cols)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """A delimited text file with inferred types. ``#`` lines are comments; bad bytes are replaced.

    A file is read in many tasks unless a quoted value holds a line break, which one pass over its lines finds out. Files that Hadoop
    can't unpack (xz, zst) are unpacked within one task.
    """
    delimiter, header, width = sniff(path)
    options = {"sep": delimiter, "comment": "#", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    if path.lower().endswith((".xz", ".zst")):
        records = spark.createDataFrame([(path,)], "path string").mapInArrow(_unpacked_records, "value string, first boolean")
        names = [f"col_{i}" for i in range(width)]
        cells = F.from_csv("value", ", ".join(f"{n} string" for n in names), options).alias("c")
        raw = records.where(~F.col("first")).select(cells).select("c.*") if header else records.select(cells).select("c.*")
        if header:
            got = records.where("first").select(cells).first()
            raw = raw.toDF(*[v or n for n, v in zip(names, got["c"])])
    else:
        quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
        broken = not spark.read.text(path).where(quotes % 2 == 1).limit(1).isEmpty()
        raw = spark.read.options(**options, multiLine=str(broken).lower(), inferSchema="false", header=str(header).lower()).csv(path)
        if not header:
            raw = raw.toDF(*[f"col_{i}" for i in range(len(raw.columns))])
    raw = unique_names(raw)
    return apply_types(raw, infer_types(raw))


def _unpacked_records(batches):
    """(value, first): the records of packed files, comments left out; a record ends at a line break outside quotes."""
    for b in batches:
        for path in b.column("path").to_pylist():
            if path.lower().endswith(".xz"):
                opened = lzma.open(path, "rt", encoding="utf-8", errors="replace")
            else:
                import zstandard

                opened = zstandard.open(path, "rt", encoding="utf-8", errors="replace")
            out, part, first = [], "", True
            with opened as f:
                for line in f:
                    if not part and (line.startswith("#") or not line.strip()):
                        continue
                    part += line
                    if part.count('"') % 2 == 0:
                        out.append(part.rstrip("\r\n"))
                        part = ""
                    if len(out) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(out), pa.array([first] + [False] * (len(out) - 1))], names=["value", "first"])
                        out, first = [], False
            out += [part.rstrip("\r\n")] if part else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out), pa.array([first] + [False] * (len(out) - 1))], names=["value", "first"])


# ------------------------------------------------------------------- FITS

# Fixed values of the FITS standard: letters of binary table formats as big-endian types.
FITS_TYPES = {"L": "S1", "B": "u1", "I": ">i2", "J": ">i4", "K": ">i8", "E": ">f4", "D": ">f8"}
_SPARK = {"L": "boolean", "B": "smallint", "I": "smallint", "J": "int", "K": "bigint", "E": "float", "D": "double", "A": "string"}


def _header(f) -> dict[str, str]:
    cards: dict[str, str] = {}
    while True:
        block = f.read(2880)
        if len(block) < 2880:
            raise ValueError("the FITS file ends within a header")
        for k in range(0, 2880, 80):
            card = block[k : k + 80].decode("ascii", "replace")
            if card[:8].strip() == "END":
                return cards
            if card[8:10] == "= ":
                v = card[10:].strip()
                cards[card[:8].strip()] = v[1 : v.index("'", 1)].rstrip() if v.startswith("'") else v.split("/")[0].strip()


def _skip(f, cards: dict[str, str]) -> None:
    n = int(cards.get("NAXIS", 0))
    size = abs(int(cards.get("BITPIX", 8))) // 8 * int(np.prod([int(cards[f"NAXIS{i + 1}"]) for i in range(n)])) if n else 0
    f.seek(-(-(size + int(cards.get("PCOUNT", 0))) // 2880) * 2880, os.SEEK_CUR)


def read_fits(spark: SparkSession, path: str) -> DataFrame:
    """The first binary table of a FITS file: scalar and text columns; TNULL integers, NaN and unset logicals are null.

    The header is read here, the rows by as many tasks as there are runs of FITS_ROWS_PER_TASK rows. Array columns are left out.
    """
    with open(path, "rb") as f:
        cards = _header(f)
        while cards.get("XTENSION") != "BINTABLE":
            _skip(f, cards)
            cards = _header(f)
        at = f.tell()
    rows, width = int(cards["NAXIS2"]), int(cards["NAXIS1"])
    fields, keep, offset = [], [], 0
    for i in range(1, int(cards["TFIELDS"]) + 1):
        form = cards[f"TFORM{i}"].strip()
        digits = form[: len(form) - len(form.lstrip("0123456789"))]
        n, letter = int(digits or 1), form[len(digits)]
        name = cards.get(f"TTYPE{i}", f"col_{i - 1}")
        if letter == "A":
            keep.append((name, f"S{max(n, 1)}", offset, "A", None))
            offset += n
        elif letter in FITS_TYPES:
            size = np.dtype(FITS_TYPES[letter]).itemsize
            if n == 1:
                keep.append((name, FITS_TYPES[letter], offset, letter, cards.get(f"TNULL{i}")))
            offset += size * n
        else:
            offset += {"X": -(-n // 8), "C": 8 * n, "M": 16 * n, "P": 8 * n, "Q": 16 * n}[letter]
        fields.append(name)
    layout = np.dtype({"names": [str(i) for i in range(len(keep))], "formats": [k[1] for k in keep], "offsets": [k[2] for k in keep], "itemsize": width})
    schema = pa.schema([(k[0], {"A": pa.string(), "L": pa.bool_(), "B": pa.int16(), "I": pa.int16(), "J": pa.int32(), "K": pa.int64(), "E": pa.float32(), "D": pa.float64()}[k[3]]) for k in keep])
    starts = max(1, -(-rows // FITS_ROWS_PER_TASK))

    def part(batches):
        for b in batches:
            for start in b.column("id").to_pylist():
                n = min(FITS_ROWS_PER_TASK, rows - start * FITS_ROWS_PER_TASK)
                with open(path, "rb") as f:
                    f.seek(at + start * FITS_ROWS_PER_TASK * width)
                    data = np.frombuffer(f.read(n * width), layout)
                out = []
                for i, (name, _, _, letter, null) in enumerate(keep):
                    v = data[str(i)]
                    if letter == "A":
                        text = [x.split(b"\0")[0].decode("ascii", "replace").strip() for x in v]
                        out.append(pa.array(text, pa.string()))
                    elif letter == "L":
                        out.append(pa.array([True if x == b"T" else False if x == b"F" else None for x in v], pa.bool_()))
                    else:
                        v = v.astype(v.dtype.newbyteorder("="))
                        missing = np.isnan(v) if v.dtype.kind == "f" else (v == int(null)) if null is not None else np.zeros(len(v), bool)
                        out.append(pa.array(v.astype("i2") if letter == "B" else v, mask=missing).cast(schema.field(i).type))
                yield pa.RecordBatch.from_arrays(out, schema=schema)

    ddl = ", ".join(f"`{k[0]}` {_SPARK[k[3]]}" for k in keep)
    return unique_names(spark.range(0, starts, 1, starts).mapInArrow(part, ddl))


def read_hdf5(spark: SparkSession, path: str) -> DataFrame:
    """An HDF5 table, where h5py is installed; else ImportError."""
    try:
        import h5py
    except ImportError as e:
        raise ImportError("reading HDF5 needs h5py, which isn't installed") from e
    with h5py.File(path) as f:
        data = {k: np.asarray(v) for k, v in f.items() if getattr(v, "ndim", 0) == 1}
    return decode_bytes(spark.createDataFrame(pa.table({k: pa.array(v.tolist()) for k, v in data.items()})))


def decode_bytes(df: DataFrame) -> DataFrame:
    """Binary columns as stripped text; text columns that hold only true and false stay text (``apply_types`` makes them boolean)."""
    return df.select(*[strip(F.decode(F.col(f"`{c}`"), "UTF-8")).alias(c) if t == "binary" else F.col(f"`{c}`") for c, t in df.dtypes])


# ------------------------------------------------------------------- HATS


def _properties(path: Path) -> dict[str, str]:
    if not path.is_file():
        return {}
    pairs = (x.split("=", 1) for x in path.read_text().splitlines() if "=" in x and not x.startswith("#"))
    return {k.strip(): v.strip() for k, v in pairs}


def hats_root(path: str, depth: int = 3) -> str | None:
    """The object catalog of a HATS directory: what collection.properties names, else the nearest folder whose properties say object."""
    top = Path(path)
    level = [top]
    for _ in range(depth + 1):
        for p in level:
            primary = _properties(p / "collection.properties").get("hats_primary_table_url")
            if primary and (p / primary).is_dir():
                return str(p / primary)
        for name in ("hats.properties", "properties"):
            for p in level:
                if _properties(p / name).get("dataproduct_type") == "object":
                    return str(p)
        level = sorted(c for p in level for c in p.iterdir() if c.is_dir()) if all(p.is_dir() for p in level) else []
    return None


def hats_payload(root: str) -> str:
    """Where the parquet files lie: the folder with _metadata, else the one with Norder=* folders, else any with parquet files."""
    folders = [Path(root), *sorted(p for p in Path(root).rglob("*") if p.is_dir())]
    for test in (lambda p: (p / "_metadata").exists(), lambda p: any(p.glob("Norder=*")), lambda p: any(p.glob("*.parquet"))):
        for p in folders:
            if test(p):
                return str(p)
    raise ValueError(f"no parquet files in {root}")


def read_hats(spark: SparkSession, path: str) -> DataFrame:
    root = hats_root(path)
    if root is None:
        raise ValueError(f"no HATS object catalog: {path}")
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(hats_payload(root))
    return unique_names(df.drop("Norder", "Dir", "Npix"))


def by_size(paths: list[str]) -> list[str]:
    """Catalog paths by their size on disk, the smallest first."""

    def size(p: str) -> int:
        q = Path(p)
        return q.stat().st_size if q.is_file() else sum(x.stat().st_size for x in q.rglob("*") if x.is_file())

    return sorted(paths, key=lambda p: (size(p), p))
