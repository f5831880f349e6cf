import bz2
import gzip
import lzma
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from skyloom.functions.healpix import order_for, pixel
from skyloom.sources import sinks
from skyloom.sources.catalogs import by_size, format_of, hats_root, read_catalog, read_hdf5, sniff, unique_names

CSV = "# notes\nid,ra,ok,mix,name\n1,1.5,true,3,x\n2,NA,False,x,\"a, b\"\n3,2.5,,5,null\n"
ROWS = [("1", 1.5, True, "3", "x"), ("2", None, False, "x", "a, b"), ("3", 2.5, None, "5", None)]


@pytest.mark.parametrize("ending, pack", [("", None), (".gz", gzip.compress), (".bz2", bz2.compress), (".xz", lzma.compress), (".zst", zstandard.compress)])
def test_text(spark, tmp_path, ending, pack):
    p = tmp_path / f"a.csv{ending}"
    p.write_bytes(pack(CSV.encode()) if pack else CSV.encode())
    df = read_catalog(spark, str(p))
    assert [t for _, t in df.dtypes] == ["bigint", "double", "boolean", "string", "string"]
    assert sorted((str(r[0]), *r[1:]) for r in df.collect()) == ROWS


def test_sniffing(tmp_path):
    p = tmp_path / "a.tsv"
    p.write_text("1\t2\t3\n4\t5\t6\n")
    assert sniff(str(p)) == ("\t", False, 3)
    p.write_text("a;b;1\n4;5;6\n")
    assert sniff(str(p)) == (";", True, 3)
    p.write_text("")
    assert sniff(str(p)) == (",", False, 0)


def test_formats(tmp_path):
    assert format_of("x.parquet") == "parquet" and format_of("X.FITS") == "fits" and format_of("x.h5") == "hdf5" and format_of("x.txt.zst") == "text"
    for bad in ("x.json", "x.parquet.gz", str(tmp_path)):
        with pytest.raises(ValueError):
            format_of(bad)


def test_unique_names(spark):
    assert unique_names(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "a", "a__dup1")).columns == ["a", "a__dup1", "a__dup1__dup1"]


def test_fits_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("skyloom.sources.catalogs.FITS_ROWS_PER_TASK", 2)
    df = spark.createDataFrame([(1, 2, 0.5, "ab", True, None, None), (2, None, None, None, False, None, 7), (3, 4, float("nan"), "c", None, None, 8)], "a bigint, b int, x double, s string, f boolean, e string, t tinyint")
    path = str(tmp_path / "a.fits")
    sinks.save(df, path, "fits")
    back = read_catalog(spark, path)
    assert "e" not in back.columns
    assert sorted(tuple(r) for r in back.select("a", "b", "x", "s", "f").collect()) == [(1, 2.0, 0.5, "ab", "true"), (2, None, None, "", "false"), (3, 4.0, None, "c", "")]
    with open(path, "rb") as f:
        assert len(f.read()) % 2880 == 0


def test_fits_types_of_the_standard(spark, tmp_path):
    cards = ["XTENSION= 'BINTABLE'", "BITPIX  = 8", "NAXIS   = 2", "NAXIS1  = 12", "NAXIS2  = 2", "PCOUNT  = 0", "GCOUNT  = 1", "TFIELDS = 4", "TTYPE1  = 'L'", "TFORM1  = 'L'", "TTYPE2  = 'N'", "TFORM2  = '1I'", "TNULL2  = -9", "TTYPE3  = 'V'", "TFORM3  = '2I'", "TFORM4  = '5A'", "END"]
    head = "".join(c.ljust(80) for c in ["SIMPLE  = T", "BITPIX  = 8", "NAXIS   = 0", "END"]).ljust(2880) + "".join(c.ljust(80) for c in cards).ljust(2880)
    body = b"".join(struct.pack(">chhh5s", *v) for v in ((b"T", 5, 1, 2, b"abc  "), (b"\0", -9, 3, 4, b"\0")))
    p = tmp_path / "b.fits"
    p.write_bytes(head.encode() + body.ljust(2880, b"\0"))
    df = read_catalog(spark, str(p))
    assert df.columns == ["L", "N", "col_3"] and sorted((tuple(r) for r in df.collect()), key=repr) == [(None, None, ""), (True, 5, "abc")]


def test_hats_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(i, (i * 37.7) % 360, (i * 11.3) % 180 - 90) for i in range(500)], "n int, ra double, dec double")
    path = str(tmp_path / "cat")
    sinks.save_hats(df, path, rows_per_pixel=20)
    assert hats_root(path) == path
    back = read_catalog(spark, path)
    assert {"Norder", "Npix", "Dir"}.isdisjoint(back.columns) and sorted(r["n"] for r in back.collect()) == list(range(500))
    with pytest.raises(ValueError):
        sinks.save(df.drop("ra"), path, "hats")
    with pytest.raises(ValueError):
        sinks.save(df, path, "xls")


def test_collections_point_to_their_catalog(spark, tmp_path):
    inner = tmp_path / "coll" / "catalog"
    sinks.save_hats(spark.createDataFrame([(1, 5.0, 5.0)], "n int, ra double, dec double"), str(inner))
    (tmp_path / "coll" / "collection.properties").write_text("hats_primary_table_url=catalog\n")
    margin = tmp_path / "coll" / "margin"
    margin.mkdir()
    (margin / "hats.properties").write_text("dataproduct_type=margin\n")
    assert hats_root(str(tmp_path / "coll")) == str(inner)
    assert hats_root(str(margin)) is None


def test_pixels_halve_evenly(spark):
    df = spark.range(20_000).select((F.rand(1) * 360).alias("ra"), F.degrees(F.asin(F.rand(2) * 2 - 1)).alias("dec"))
    for order in (0, 3):
        n = df.groupBy(pixel(F.col("ra"), F.col("dec"), order).alias("p")).count().collect()
        assert {r["p"] for r in n} == set(range(12 << 2 * order))
    nested = df.where(F.shiftright(pixel(F.col("ra"), F.col("dec"), 8), 10) != pixel(F.col("ra"), F.col("dec"), 3))
    assert nested.count() == 0
    assert order_for(0, 10) == 0 and order_for(10_000_000, 1_000_000) == 0 and order_for(100_000_000, 1_000_000) == 2


def test_csv_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    sinks.save(df, str(tmp_path / "p"), "parquet", single=True)
    sinks.save(df, str(tmp_path / "c"), "csv")
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    assert sinks.text_widths(df) == {"s": 1}
    assert by_size([str(tmp_path / "c"), str(tmp_path / "p")])[0] == str(tmp_path / "c")


def test_hdf5_says_what_it_needs(spark):
    try:
        import h5py  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError, match="h5py"):
            read_hdf5(spark, "x.h5")


def test_text_files_split_unless_a_value_holds_a_line_break(spark, tmp_path):
    plain, broken = tmp_path / "plain.csv", tmp_path / "broken.csv"
    plain.write_text("a,b\n" + "".join(f"{i},x{i}\n" for i in range(20_000)) + "9z,last\n")
    broken.write_text('a,b\n1,"two\nlines"\n2,x\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = read_catalog(spark, str(plain))
        assert df.rdd.getNumPartitions() > 4 and df.count() == 20_001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert dict(df.dtypes)["a"] == "bigint" and df.where("a is null").count() == 1
    assert sorted(tuple(r) for r in read_catalog(spark, str(broken)).collect()) == [(1, "two\nlines"), (2, "x")]


def test_text_that_fits_does_not_hold(spark):
    with pytest.raises(ValueError, match="doesn't fit"):
        sinks.text_widths(spark.createDataFrame([("x" * 70_000,)], "s string"))
