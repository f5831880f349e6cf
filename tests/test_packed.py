import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyloom.operators import packed
from skyloom.operators.packed import split_packed
from skyloom.plans.problem_queries import p1_found
from skyloom.session import table


def split(spark, rows, schema="CRD_ID string, compared_to string"):
    out = split_packed(spark.createDataFrame(rows, schema), "CRD_ID", "compared_to").collect()
    return sorted((tuple(r) for r in out), key=repr)


@pytest.mark.parametrize("most", [20_000, 0])
def test_writings(spark, monkeypatch, most):
    monkeypatch.setattr(packed, "MAX_BROADCAST_BYTES", most)
    rows = [
        ("a", "X1, X2"), ("b", "X1;;X2|X3 X4"), ("c", '"X 1, b", X2'), ("d", "['X1', 'X2']"), ("e", '"MASK ""6,B""" / X1'), ("f", "{X1,X1}"),
        ("g", "​X1﻿ ；X2"), ("h", "X1, null,, <NA>,X2"), ("i", ';["X1"],'), ("j", "{A1,B2},C3"),
    ]
    got = {}
    for k, p, v in split(spark, rows):
        got.setdefault(k, {})[p] = v
    assert {k: [v for _, v in sorted(x.items())] for k, x in got.items()} == {
        "a": ["X1", "X2"], "b": ["X1", "X2", "X3", "X4"], "c": ["X 1, b", "X2"], "d": ["X1", "X2"], "e": ['MASK "6,B"', "X1"], "f": ["X1", "X1"],
        "g": ["X1", "X2"], "h": ["X1", "X2"], "i": ["X1"], "j": ["A1", "B2", "C3"],
    }


def test_nothing_to_split(spark):
    assert split(spark, []) == []
    assert split(spark, [("a", None), ("b", ""), ("c", " , "), ("d", "NaN"), ("e", "[]")]) == []


def test_null_key_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, "X1;X2", "p"), (None, "X1;X2", "q"), ("a", "X1", "r")], "CRD_ID string, compared_to string, pattern string")
    got = sorted((tuple(r) for r in split_packed(df, "CRD_ID", "compared_to").collect()), key=repr)
    assert got == [("a", 1, "X1"), (None, 1, "X1"), (None, 2, "X2")]


def test_very_long_fields(spark):
    rows = [("a", "X1, " * 60_000), ("b", '"' + 'q""' * 30_000 + '", X2'), ("c", "X1, " + "word " * 40_000), ("d", "x" * 300_000)]
    got = split_packed(spark.createDataFrame(rows, "CRD_ID string, compared_to string"), "CRD_ID", "compared_to").groupBy("CRD_ID").count()
    assert {r[0]: r[1] for r in got.collect()} == {"a": 60_000, "b": 2, "c": 40_001, "d": 1}


values = st.lists(st.from_regex(r"[A-Z]{2,4}[0-9]{1,4}", fullmatch=True), min_size=1, max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(values, st.sampled_from([", ", ";", " | ", "/", "\t", "  ", "；"]), st.sampled_from(["", '"', "'"]), st.sampled_from(["", "[]", "{}"])), min_size=1, max_size=20))
def test_round_trip(spark, fields):
    rows, expected = [], []
    for i, (vs, d, q, b) in enumerate(fields):
        rows.append((str(i), (b[:1] + d.join(f"{q}{v}{q}" for v in vs) + b[1:])))
        expected += [(str(i), n, v) for n, v in enumerate(vs, 1)]
    na = {"NAN", "NA", "NULL", "NONE"}
    assert not any(v in na for _, _, v in expected)
    assert split(spark, rows) == sorted(expected, key=repr)


@pytest.mark.parametrize("scale", ["sf0.001"])
def test_whole_column_against_a_plain_parser(spark, data, scale):
    expected = set()
    token = re.compile(r'"((?:[^"]|"")*)"|\'([^\']*)\'|([^,，;；|/\s]+)')
    for r in table(spark, data, "crd_catalog").where("compared_to is not null").select("CRD_ID", "compared_to").distinct().collect():
        text = re.sub("[​-‍﻿]", "", r[1]).strip(" \t\r\n\xa0,;|/，；[]{}")
        n = 0
        for m in token.finditer(text):
            v = (m[1].replace('""', '"') if m[1] is not None else m[2] if m[2] is not None else m[3]).strip()
            if v.lower() not in ("", "na", "nan", "null", "none", "<na>"):
                n += 1
                expected.add((r[0], n, v))
    assert {tuple(r) for r in p1_found(spark, data).collect()} == expected


def test_no_field_is_parsed_twice(spark):
    df = spark.createDataFrame([(1, "a1, b2"), (2, "'a1'; 'b2'"), (3, '"a, b" "c"'), (4, None)], "k int, f string")
    out = packed.packed_values(df, "k", "f")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_replace" in line]
    assert "regexp_extract_all(field#" in plan and ", regex#" not in plan.split("regexp_extract_all(", 1)[1].split(")")[0]
    assert {r["k"]: r["values"] for r in out.collect()} == {1: ["a1", "b2"], 2: ["a1", "b2"], 3: ["a, b", "c"]}


def test_blanks_in_ranges_are_the_blanks(spark):
    signs = spark.range(1, 0xD800).select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c"))
    assert {r["c"] for r in signs.where(F.col("c").rlike(f"^[{packed._JAVA_BLANK}]$")).collect()} == set(packed.BLANKS) != set(packed._JAVA_BLANK)
