import json
import math
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyloom.operators.drift import Drift, canonical, path_values
from skyloom.operators.rejects import diagnose, load_records, parse_block, split_record
from skyloom.plans.problem_queries import p2_found, p3_found, p3_loaded


def drift(spark, payloads, releases=((1, 1), (2, 2), (3, 3))):
    rows = spark.createDataFrame([(i, f, p) for i, (f, p) in enumerate(payloads)], "row_id long, file_id long, payload string")
    files = spark.createDataFrame([(f, "s", n, "src") for f, n in releases], "file_id long, series string, release_no int, source string")
    columns = spark.createDataFrame(
        [("src", "name", "ra", "dec", "z", "q", None, None)],
        "source string, id_column string, ra_column string, dec_column string, z_column string, z_flag_column string, z_err_column string, survey_column string",
    )
    return Drift(rows, files, columns)


def test_changes_and_table(spark):
    d = drift(spark, [
        (1, '{"ra": 1.0, "dec": 2.0, "z": 0.5, "q": 3, "old": "x", "name": 7}'), (1, '{"ra": 2.0, "dec": 2.0, "z": 0.25, "q": 4, "name": 8}'),
        (2, '{"dec": 2.0, "ra": 1, "z": "0.50", "Q": 3.0, "name": "7", "extra": true}'), (2, '{"ra": 2.0, "dec": 2.0, "z": "bad", "Q": 4.5, "name": " na "}'), (2, "no json"), (2, None),
    ])
    changes = d.changes()
    assert sorted(tuple(r) for r in changes.collect()) == [
        (2, "added", "", "Q"), (2, "added", "", "extra"), (2, "removed", "old", ""), (2, "removed", "q", ""), (2, "retyped", "name", "name"), (2, "retyped", "ra", "ra"), (2, "retyped", "z", "z"),
    ]
    table = {r["row_id"]: r for r in d.table(changes).collect()}
    assert len(table) == 6 and table[0]["z"] == 0.5 and table[3]["failed"] == "z=bad" and table[4]["ra"] is None and table[2]["id"] == "7"


def test_every_value_is_in_the_table_or_failed(spark):
    payloads = [
        (1, '{"ra": 1.5, "dec": 2.5, "z": 0.5, "q": 3, "name": "A7", "snr": 12.5, "SPECTYPE": "GALAXY", "lost": null}'), (1, '{"ra": 3.5, "dec": 2.5, "z": "bad", "q": 4, "snr": "NaN"}'),
        (2, '{"ra": 1.5, "dec": 2.5, "z": 0.5, "Q": 3, "name": "A7", "SNR": "12.5", "nbfilt": 40, "ok": true}'), (2, '{"ra": 3.5, "dec": 2.5, "Q": 4, "mags": [1, 2]}'), (2, "no json"), (2, "[7]"), (2, None), (2, "{}"),
        (3, '{"ra": 1.5, "dec": 2.5, "Q": 3, "q": 9, "name": "A7", "nbfilt": "forty"}'), (4, '{"ra": 8.5, "chi_a": 0.75}'),
    ]
    d = drift(spark, payloads)
    table = {r["row_id"]: r for r in d.table(d.changes()).collect()}
    assert len(table) == len(payloads)
    for i, (_, payload) in enumerate(payloads):
        r = table[i]
        try:
            fields = json.loads(payload or "{}")
        except ValueError:
            fields = payload
        if not isinstance(fields, dict):
            assert r["failed"] == f"payload={payload}" and not r["other"]
            continue
        typed = [r[c] for c in ("id", "ra", "dec", "z", "z_flag", "z_err", "survey") if r[c] is not None]
        others = {o["field"]: o["value"] for o in r["other"]}
        failed = [x.partition("=")[2] for x in r["failed"].split(";") if x]
        there = {k: v for k, v in fields.items() if v is not None and v != "NaN"}
        assert len(typed) + len(others) + len(failed) == len(there)
        for k, v in there.items():
            assert v in typed or v in failed or others[k] == (json.dumps(v, separators=(",", ":")) if not isinstance(v, str) else v)
    assert [tuple(o) for o in table[0]["other"]] == [("SPECTYPE", "SPECTYPE", "GALAXY", "string"), ("snr", "snr", "12.5", "fractional")]
    # A field renamed keeps its origin; a new field of the old name doesn't take the column from it. File 4 is in no list of files.
    assert table[2]["z_flag"] == table[8]["z_flag"] == 3.0 and ("q", "q", "9", "integer") in [tuple(o) for o in table[8]["other"]]
    assert {o["origin"] for o in table[9]["other"]} == {"ra", "chi_a"}


def test_renames_need_equal_values(spark):
    same = [(1, '{"ra": 1.0, "dec": 2.0, "q": 3, "w": 1}'), (2, '{"ra": 1.0, "dec": 2.0, "flag": "3", "v": 2}'), (3, '{"ra": 1.0, "dec": 2.0, "FLAG": 3, "v": 2}')]
    got = sorted(tuple(r) for r in drift(spark, same).changes().collect())
    assert got == [(2, "added", "", "v"), (2, "removed", "w", ""), (2, "renamed", "q", "flag"), (2, "retyped", "q", "flag"), (3, "renamed", "flag", "FLAG"), (3, "retyped", "flag", "FLAG")]


def test_no_rows_and_missing_values(spark):
    assert drift(spark, []).changes().count() == 0
    d = drift(spark, [(1, '{"ra": 1.0, "dec": 1.0, "a": null}'), (2, '{"ra": 1.0, "dec": 1.0, "b": "NaN"}')])
    assert sorted(tuple(r) for r in d.changes().collect()) == [(2, "added", "", "b"), (2, "removed", "a", "")]


def test_types_and_canonical_values(spark):
    df = spark.createDataFrame([(1, 1, '{"i": 3, "f": 3.0, "s": "3", "b": true, "n": null, "t": "NA", "big": 12345678901234567890, "o": {"x": 1}, "l": [1]}')], "f long, r long, p string")
    got = {r["field"]: r["type"] for r in path_values(df, "f", "r", "p").collect()}
    assert got == {"i": "integer", "f": "fractional", "s": "string", "b": "boolean", "n": None, "t": None, "big": "integer", "o": "object", "l": "array"}
    values = spark.createDataFrame([("3",), ("3.0",), ("+03",), ("3e0",), ("0.50",), (".5",), ("-0",), (" x ",), ("12345678901234567891",)], "v string")
    assert [r[0] for r in values.select(canonical(values["v"])).collect()] == ["3", "3", "3", "3", "0.5", "0.5", "0", "x", "12345678901234567891"]


# ------------------------------------------------------------------- rejects


def load(spark, lines, fmt="csv", name="f.csv", z="z"):
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines, 1)], "file_id long, line_no int, line string")
    files = spark.createDataFrame([(1, "src", fmt, name)], "file_id long, source string, format string, file_name string")
    columns = spark.createDataFrame([("src", z)], "source string, z_column string")
    return {r["line_no"]: r["reason"] or r["fields"] for r in load_records(df, files, columns).collect()}


def test_reasons(spark):
    lines = [
        "# notes", "", "﻿id,z,remark\r", 'a,1.5,"x, ""y"" z"\r', "b,1e3", 'c,1.0,"open', 'd,1.0,"x"y', "e,1.2e,ok", "f, NaN ,ok", "g,-Infinity,ok", None, "  ", "# more", 'h,"2.5",two', "i,1e999,ok",
        'j,+.5,"two\nlines"', 'k,1,in "the" middle',
    ]
    assert load(spark, lines) == {
        4: ["a", "1.5", 'x, "y" z'], 5: "column_count", 6: "quoting", 7: "quoting", 8: "z_value", 9: ["f", " NaN ", "ok"], 10: "z_value", 14: ["h", "2.5", "two"], 15: "z_value",
        16: ["j", "+.5", "two\nlines"], 17: ["k", "1", 'in "the" middle'],
    }


@pytest.mark.parametrize("fmt, name, ok", [(" .CSV.GZ ", "x", True), ("tsv", "x", True), ("cvs", "x.csv", False), (None, "x.txt.zst", True), (None, "x.fits", False), (None, None, False), ("", "x.csv", False)])
def test_formats(spark, fmt, name, ok):
    assert load(spark, ["id\tz", "a\t1"], fmt, name) == {2: ["a", "1"] if ok else "format"}


def test_files_without_records(spark):
    assert load(spark, ["# only notes", "", None]) == {}
    assert load(spark, ["id,z"]) == {}
    assert load(spark, ["id;w", "a;b"]) == {2: ["a", "b"]}


def test_quoted_header_and_long_record(spark):
    assert load(spark, ['"id","z","a,b"', "x,1," + "y" * 200_000, "u,2,v"])[3] == ["u", "2", "v"]


fields = st.lists(st.text(st.sampled_from('ab,;"\n 1'), max_size=6), min_size=1, max_size=4)


@settings(max_examples=200, deadline=None)
@given(fields)
def test_record_round_trip(values):
    line = ",".join('"' + v.replace('"', '""') + '"' for v in values)
    assert split_record(line, ",") == values


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from('ab,"1. '), max_size=8).filter(str.strip), min_size=1, max_size=5))
def test_blocks_give_what_the_strict_path_gives(lines):
    got = {}
    for k, reasons, fields in parse_block(pa.array(lines), ",", 2, 1):
        got |= {i: (reasons and reasons[0], f) for i, f in zip(k.tolist(), fields.to_pylist())}
    assert got == dict(enumerate(diagnose(x, ",", 2, 1) for x in lines))


def plain_reasons(data):
    """The rejected records of the whole tables, character by character."""
    files, columns, lines = (pq.read_table(f"{data}/{t}.parquet").to_pylist() for t in ("catalog_files", "catalog_columns", "raw_lines"))
    zs = {c["source"]: c["z_column"] for c in columns}
    missing, by_file, out = ("", "na", "nan", "null", "none", "<na>"), {}, set()
    for r in lines:
        by_file.setdefault(r["file_id"], []).append((r["line_no"], r["line"]))

    def fields(text, sign):
        got, cell, state = [], "", "start"
        for ch in text:
            if state == "start" and ch == '"':
                state = "in"
            elif state == "in":
                state, cell = ("quote", cell) if ch == '"' else ("in", cell + ch)
            elif state == "quote" and ch == '"':
                state, cell = "in", cell + ch
            elif ch == sign:
                got, cell, state = [*got, cell], "", "start"
            elif state == "quote":
                return None
            else:
                state, cell = "bare", cell + ch
        return None if state == "in" else [*got, cell]

    for f in files:
        header = None
        ending = r"(csv|tsv|txt)(\.(gz|bz2|xz|zst))?"
        fmt = (f["format"] or "").strip().lower()
        ok = re.fullmatch(r"\.?" + ending, fmt) if f["format"] is not None else re.search(r"\." + ending + "$", (f["file_name"] or "").strip().lower())
        for n, line in sorted(by_file.get(f["file_id"], [])):
            line = re.sub(r"[\r\n]+$", "", (line or "").lstrip("\ufeff"))
            if not line.strip() or line.lstrip(" ").startswith("#"):
                continue
            if header is None:
                bare = re.sub(r'"[^"]*(?:""[^"]*)*"', "", line)
                sign = max(",;\t|", key=bare.count)
                header = [h.strip() for h in fields(line, sign)]
                continue
            cells = fields(line, sign)
            z = header.index(zs[f["source"]]) if zs.get(f["source"]) in header else None
            if not ok:
                out.add((f["file_id"], n, "format"))
            elif cells is None:
                out.add((f["file_id"], n, "quoting"))
            elif len(cells) != len(header):
                out.add((f["file_id"], n, "column_count"))
            elif z is not None and cells[z].strip().lower() not in missing:
                v = cells[z].strip()
                if not re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", v) or math.isinf(float(v)):
                    out.add((f["file_id"], n, "z_value"))
    return out


def test_rejects_against_brute_force(spark, data):
    assert {tuple(r) for r in p3_found(spark, data).collect()} == plain_reasons(data)


def plain_changes(data):
    """Every change between the files of the whole tables, file by file."""
    files, columns, rows = (pq.read_table(f"{data}/{t}.parquet").to_pylist() for t in ("catalog_files", "catalog_columns", "release_rows"))
    places = {c["source"]: (c["ra_column"], c["dec_column"]) for c in columns}
    missing, payloads, out = ("", "na", "nan", "null", "none", "<na>"), {}, set()
    for r in rows:
        payloads.setdefault(r["file_id"], []).append(json.loads(r["payload"]))

    def gone(v):
        return v is None or isinstance(v, str) and v.strip().lower() in missing

    def plain(v):
        if isinstance(v, bool):
            return str(v).lower()
        try:
            return float(v)
        except ValueError:
            return {"true": "true", "false": "false"}.get(v.strip().lower(), v.strip())

    def kinds(rs, name):
        return {{bool: "b", int: "i", float: "f", str: "s"}[type(r[name])] for r in rs if name in r and not gone(r[name])}

    def values(rs, name, objects, at):
        return {(o, plain(r[name])) for r in rs if name in r and not gone(r[name]) and (o := place(r, at)) in objects}

    def place(r, at):
        return None if any(gone(r.get(c)) for c in at) else tuple(plain(r[c]) for c in at)

    series = {}
    for f in sorted({f["file_id"]: f for f in files}.values(), key=lambda f: (f["release_no"], f["file_id"])):
        if f["series"] is not None and f["file_id"] in payloads:
            series.setdefault(f["series"], []).append(f)
    for run in series.values():
        for f, g in zip(run, run[1:]):
            old, new, at = payloads[f["file_id"]], payloads[g["file_id"]], places[g["source"]]
            objects = {place(r, at) for r in old} & {place(r, at) for r in new} - {None}
            a, b = {k for r in old for k in r}, {k for r in new for k in r}
            pairs, taken = {}, set()
            for x in sorted(a - b):
                v = values(old, x, objects, at)
                for y in sorted(b - a - taken):
                    if v and v == values(new, y, objects, at):
                        pairs[x] = y
                        taken.add(y)
                        break
            out |= {(g["file_id"], "renamed", x, y) for x, y in pairs.items()} | {(g["file_id"], "added", "", y) for y in b - a - taken}
            out |= {(g["file_id"], "removed", x, "") for x in a - b - set(pairs)}
            for x, y in [*pairs.items(), *((n, n) for n in a & b)]:
                s, t = kinds(old, x), kinds(new, y)
                if s and t and s != t:
                    out.add((g["file_id"], "retyped", x, y))
    return out


def test_changes_against_brute_force(spark, data):
    assert {tuple(r) for r in p2_found(spark, data).collect()} == plain_changes(data)


def test_every_record_is_loaded_or_rejected(spark, data):
    rejected, loaded = p3_found(spark, data).select("file_id", "line_no"), p3_loaded(spark, data).select("file_id", "line_no").distinct()
    assert rejected.join(loaded, ["file_id", "line_no"]).count() == 0 and rejected.count() and loaded.count()
