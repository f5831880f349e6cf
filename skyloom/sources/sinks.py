"""Catalogs written: parquet, CSV, FITS tables and HATS directories."""

from __future__ import annotations

from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions.healpix import order_for, pixel
from skyloom.operators.consolidate import empty_columns
from skyloom.session import write_note

# Rows that a HATS pixel should hold, and the widest text column of a FITS table in bytes.
ROWS_PER_PIXEL = 1_000_000
WIDEST = 65_536
#: Rows that are gathered for one FITS file; the format has no parallel writer.
FITS_MOST_ROWS = 20_000_000


def save(df: DataFrame, path: str, fmt: str, single: bool = False) -> None:
    """Writes ``df`` as parquet, csv, hats, fits or hdf5; ValueError for anything else. ``single``: one part file."""
    out = df.coalesce(1) if single else df
    match fmt:
        case "parquet":
            out.write.mode("overwrite").parquet(path)
        case "csv":
            out.write.mode("overwrite").option("header", "true").csv(path)
        case "hats":
            save_hats(df, path)
        case "fits":
            save_fits(df, path)
        case "hdf5":
            save_hdf5(df, path)
        case _:
            raise ValueError(f"unknown output format: {fmt}")


def save_hats(df: DataFrame, path: str, rows_per_pixel: int = ROWS_PER_PIXEL) -> None:
    """A HATS object catalog: parquet by HEALPix pixel of one order, clustered by the order-29 index, and its properties.

    Needs ra and dec. Rows are dealt out by pixel and a salt that grows with the pixel's rows, so a crowded pixel is many files.
    """
    if not {"ra", "dec"} <= set(df.columns):
        raise ValueError("HATS needs ra and dec")
    rows = df.count()
    order = order_for(rows, rows_per_pixel)
    out = df.withColumn("_healpix_29", pixel(F.col("ra"), F.col("dec"), 29)).withColumn("Norder", F.lit(order)).withColumn("Npix", F.shiftright("_healpix_29", 2 * (29 - order)))
    out = out.withColumn("Dir", (F.floor(F.col("Npix") / 10000) * 10000).cast("long"))
    parts = max(1, -(-rows // rows_per_pixel) * 2)
    out = out.repartitionByRange(parts, "_healpix_29").sortWithinPartitions("Npix", "_healpix_29")
    out.write.mode("overwrite").partitionBy("Norder", "Dir", "Npix").parquet(f"{path}/dataset")
    text = {"dataproduct_type": "object", "hats_col_ra": "ra", "hats_col_dec": "dec", "hats_nrows": rows, "hats_order": order, "hats_max_rows": rows_per_pixel}
    write_note(df.sparkSession, f"{path}/hats.properties", "".join(f"{k}={v}\n" for k, v in text.items()))


def fits_ready(df: DataFrame) -> DataFrame:
    """Columns that FITS can hold: empty ones dropped, booleans as true/false, tiny integers wider, nullable integers with nulls as double, the rest as text."""
    df = df.drop(*empty_columns(df))
    whole = [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint")]
    nulls = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(str(i)) for i, c in enumerate(whole)]).first() if whole else {}
    with_null = {c for i, c in enumerate(whole) if nulls[str(i)]}
    cols = []
    for c, t in df.dtypes:
        v = F.col(f"`{c}`")
        if c in with_null:
            v = v.cast("double")
        elif t == "tinyint":
            v = v.cast("smallint")
        elif t == "boolean":
            v = F.coalesce(v.cast("string"), F.lit(""))
        elif t.startswith(("array", "map", "struct")):
            v = F.to_json(v)
        elif t not in ("smallint", "int", "bigint", "float", "double", "string"):
            v = v.cast("string")
        cols.append(v.alias(c))
    return df.select(*cols)


def text_widths(df: DataFrame) -> dict[str, int]:
    """Bytes that the text columns need: the longest value, 1 at least. ValueError beyond WIDEST, as the value would be cut."""
    text = [c for c, t in df.dtypes if t == "string"]
    if not text:
        return {}
    r = df.agg(*[F.max(F.octet_length(f"`{c}`")).alias(str(i)) for i, c in enumerate(text)]).first()
    if wide := [c for i, c in enumerate(text) if (r[str(i)] or 0) > WIDEST]:
        raise ValueError(f"text longer than {WIDEST} bytes doesn't fit a FITS column: {wide}")
    return {c: max(1, r[str(i)] or 1) for i, c in enumerate(text)}


def save_fits(df: DataFrame, path: str) -> None:
    """One FITS binary table. ValueError beyond FITS_MOST_ROWS rows, as one process writes the file."""
    df = fits_ready(df)
    rows = df.count()
    if rows > FITS_MOST_ROWS:
        raise ValueError(f"{rows} rows are too many for one FITS file; write parquet or hats")
    widths = text_widths(df)
    forms = {"smallint": ("I", ">i2"), "int": ("J", ">i4"), "bigint": ("K", ">i8"), "float": ("E", ">f4"), "double": ("D", ">f8")}
    layout = np.dtype([(c, f"S{widths[c]}" if t == "string" else forms[t][1]) for c, t in df.dtypes])
    cards = [
        "XTENSION= 'BINTABLE'", "BITPIX  =                    8", "NAXIS   =                    2", f"NAXIS1  = {layout.itemsize:20d}", f"NAXIS2  = {rows:20d}",
        "PCOUNT  =                    0", "GCOUNT  =                    1", f"TFIELDS = {len(df.columns):20d}",
    ]
    for i, (c, t) in enumerate(df.dtypes, 1):
        form = f"{widths[c]}A" if t == "string" else forms[t][0]
        cards += [f"{f'TTYPE{i}':8s}= '{c}'", f"{f'TFORM{i}':8s}= '{form:8s}'"]

    def block(lines: list[str]) -> bytes:
        text = "".join(x.ljust(80) for x in [*lines, "END"])
        return text.ljust(-(-len(text) // 2880) * 2880).encode("ascii", "replace")

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "wb") as f:
        f.write(block(["SIMPLE  =                    T", "BITPIX  =                    8", "NAXIS   =                    0", "EXTEND  =                    T"]))
        f.write(block(cards))
        for chunk in df.toLocalIterator(prefetchPartitions=True) if rows else ():
            row = np.zeros(1, layout)
            for c, t in df.dtypes:
                v = chunk[c]
                row[c] = (v or "").encode("ascii", "replace") if t == "string" else (np.nan if v is None else v)
            f.write(row.tobytes())
        f.write(b"\0" * (-(rows * layout.itemsize) % 2880))


def save_hdf5(df: DataFrame, path: str) -> None:
    try:
        import h5py
    except ImportError as e:
        raise ImportError("writing HDF5 needs h5py, which isn't installed") from e
    data = fits_ready(df).toPandas()
    with h5py.File(path, "w") as f:
        for c in data.columns:
            v = data[c]
            f[c] = v.fillna("").str.encode("utf-8").to_numpy("S") if v.dtype == object else v.to_numpy()


def column_association(df: DataFrame) -> dict[str, str]:
    """What the columns of an output stand for when it is read again as a catalog."""
    special = {"id": "CRD_ID", "z_flag": "z_flag_homogenized", "instrument_type": "instrument_type_homogenized"}
    return {c: special[c] if special.get(c) in df.columns else c for c in df.columns}
