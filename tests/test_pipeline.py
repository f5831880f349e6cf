import json

import pytest
from pyspark.sql import functions as F

from skyloom.operators import validate
from skyloom.operators.consolidate import draw_one, drop_empty_columns, merge_labels, remove_duplicates, require_rows, sample_rows, union_aligned
from skyloom.operators.crossmatch import match, match_catalogs, merge_neighbors, neighbor_text, self_match
from skyloom.operators.dedup import deduplicate, pieces
from skyloom.operators.graph import components
from skyloom.plans import pipeline, prepare
from skyloom.plans.prepare import Catalog, EmptyCatalog

COLUMNS = "CRD_ID string, z double, z_flag_homogenized double, instrument_type_homogenized string, compared_to string, tie_result int"
PRIORITIES = ["z_flag_homogenized", "instrument_type_homogenized"]


def ties(spark, rows, gap=0.001, **more):
    df = spark.createDataFrame(rows, COLUMNS)
    return {r["CRD_ID"]: r["tie_result"] for r in deduplicate(df, PRIORITIES, gap, **more).collect()}


@pytest.mark.parametrize("rows, expected", [
    ([("a", 0.1, 4.0, "s", None, None)], {"a": 1}),
    ([("a", 0.1, 4.0, "s", None, 0)], {"a": 0}),
    ([("a", 0.1, 4.0, "s", "b", 1), ("b", 0.9, 3.0, "s", None, 1)], {"a": 1, "b": 1}),
    ([("a", 0.1, 4.0, "s", "b", 1), ("b", 0.9, 3.0, "s", "a", 1)], {"a": 1, "b": 0}),
    ([("a", 0.1, 4.0, "s", "b", 1), ("b", 0.9, 4.0, " g ", "a", 1)], {"a": 1, "b": 0}),
    ([("a", 0.1, 4.0, "s", "b", 1), ("b", 0.1005, 4.0, "s", "a", 1)], {"a": 1, "b": 0}),
    ([("a", 0.1, 4.0, "s", "b", 1), ("b", 0.2, 4.0, "s", "a", 1)], {"a": 2, "b": 2}),
    ([("a", 0.0, 4.0, "s", "b, c", 1), ("b", 0.0008, 4.0, "s", "a,c", 1), ("c", 0.0016, 4.0, "s", "a , b", 1)], {"a": 1, "b": 0, "c": 0}),
    ([("a", None, 4.0, "s", "b", 1), ("b", 0.1, 4.0, "s", "a", 1)], {"a": 2, "b": 2}),
    ([("a", 0.1, None, None, "b", 1), ("b", 0.9, float("nan"), "x", "a", 1)], {"a": 2, "b": 2}),
    ([("a", 0.1, 4.0, "s", "t", 1), ("t", 0.1, 6.0, "s", "a, b", 1), ("b", 0.1, 3.0, "s", "t", 0)], {"a": 1, "t": 3, "b": 0}),
    ([("t", 0.1, 6.0, "s", "a", 1), ("a", 0.1, 4.0, "s", "b, t", 1), ("b", 0.1, 3.0, "s", "a", 1)], {"t": 3, "a": 1, "b": 0}),
    ([("CRD10_1", 0.1, 4.0, "s", "CRD2_1", 1), ("CRD2_1", 0.1, 4.0, "s", "CRD10_1", 1)], {"CRD10_1": 1, "CRD2_1": 0}),
    ([("​a", 0.1, 4.0, "s", "b﻿, missing, a", 1), ("b", 0.9, 3.0, "s", "a", 1), (None, 0.1, 4.0, "s", "a", 1)], {"a": 1, "b": 0}),
    ([], {}),
])
def test_tie_results(spark, rows, expected):
    assert ties(spark, rows) == expected


def test_star_shares_the_group_of_its_neighbors(spark):
    df = spark.createDataFrame([("t", 0.1, 6.0, "s", "c", 1), ("b", 0.1, 4.0, "s", "c", 1), ("c", 0.1, 3.0, "s", "b", 1)], COLUMNS)
    assert {r["group"] for r in deduplicate(df, PRIORITIES).collect()} == {"b"}


def test_bad_parameters(spark):
    df = spark.createDataFrame([], COLUMNS)
    with pytest.raises(TypeError):
        deduplicate(df, [])
    with pytest.raises(KeyError):
        deduplicate(df, ["nothing"])
    with pytest.raises(ValueError):
        deduplicate(df, PRIORITIES, -1.0)


def test_pieces_across_bands(spark):
    rows = [("g", f"k{i:04d}", i * 0.0009) for i in range(3000)] + [("g", "n", None), ("g", "m", float("nan")), ("h", "x", 5.0), ("h", "w", 5.0), ("h", "y", -5.0)]
    got = sorted(tuple(r) for r in pieces(spark.createDataFrame(rows, "group string, id string, x double"), 0.001).collect())
    assert got == [("g", "k0000"), ("g", "m"), ("g", "n"), ("h", "w"), ("h", "y")]
    assert pieces(spark.createDataFrame(rows, "group string, id string, x double"), 0).count() == len(rows)


def test_components_of_a_long_chain_and_a_hub(spark):
    pairs = [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(400)] + [("hub", f"s{i}") for i in range(500)] + [("x", "x"), (None, "y")]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    assert len(got) == 401 + 501 and {v for k, v in got.items() if k.startswith("c")} == {"c0000"} and {v for k, v in got.items() if not k.startswith("c")} == {"hub"}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


# ------------------------------------------------------------------- matching

SKY = [("A1", "a", 10.0, 5.0), ("A2", "a", 10.00005, 5.0), ("B1", "b", 10.0001, 5.0), ("B2", "b", 359.99999, 0.0), ("C1", "c", 0.00001, 0.0), ("C2", "c", 77.0, 90.0), ("A3", "a", 200.0, 90.0), ("X", "a", None, 1.0)]


def test_matching(spark):
    df = spark.createDataFrame(SKY, "CRD_ID string, source string, ra double, dec double")
    pair = lambda d: sorted((r["left_id"], r["right_id"]) for r in d.collect())
    assert pair(match_catalogs(df, 0.5)) == [("A1", "B1"), ("A2", "B1"), ("A3", "C2"), ("B1", "A1"), ("B1", "A2"), ("B2", "C1"), ("C1", "B2"), ("C2", "A3")]
    assert pair(match_catalogs(df, 0.5, 1)) == [("A1", "B1"), ("A2", "B1"), ("A3", "C2"), ("B1", "A2"), ("B2", "C1"), ("C1", "B2"), ("C2", "A3")]
    assert ("A1", "A2") in pair(self_match(df, 0.5)) and pair(self_match(df, 0.5, 1)) == []
    assert match(df.limit(0), df, 0.5).count() == 0
    text = {r["CRD_ID"]: r["compared_to"] for r in neighbor_text(match_catalogs(df, 0.5)).collect()}
    assert text["B1"] == "A1, A2" and "X" not in text
    merged = merge_neighbors(df.withColumn("compared_to", F.lit("Z, B1 ,")), neighbor_text(match_catalogs(df, 0.5)))
    got = {r["CRD_ID"]: r["compared_to"] for r in merged.collect()}
    assert got["A1"] == "B1, Z" and got["B1"] == "A1, A2, Z" and got["X"] == "B1, Z"


# -------------------------------------------------------------------- output


def test_consolidation(spark):
    df = spark.createDataFrame([("a", 1, 2), ("b", 1, 2), ("c", 2, 1), ("d", 2, 2), ("e", 3, 3), ("f", 4, None)], "CRD_ID string, group int, tie_result int")
    keep = lambda *a, **k: {r["CRD_ID"] for r in remove_duplicates(*a, **k).collect()}
    assert keep(df) == keep(df, "nonsense") == {"c"} and keep(df, "keep_all") == {"a", "b", "c", "d"} and keep(df.drop("group"), "draw_one") == {"c"}
    drawn = keep(df, "draw_one", 3)
    assert len(drawn) == 2 and "c" in drawn and drawn == keep(df, "draw_one", 3)
    assert {len(keep(df, "draw_one", s) & {"a", "b"}) for s in range(5)} == {1} and draw_one(df, 1).count() == 6
    labels = spark.createDataFrame([("a", 7, 0)], "CRD_ID string, group int, tie_result int")
    assert {r["CRD_ID"]: r["tie_result"] for r in merge_labels(df.drop("group"), labels).collect()} == {"a": 0, "b": 2, "c": 1, "d": 2, "e": 3, "f": None}
    wide = df.withColumn("blank", F.lit(" ")).withColumn("none", F.lit(None).cast("int"))
    assert drop_empty_columns(wide, keep=["none"]).columns == ["CRD_ID", "group", "tie_result", "none"]
    with pytest.raises(RuntimeError):
        require_rows(df.limit(0), "here")
    assert sample_rows(df, "CRD_ID", 3).count() == 3 and sample_rows(df, "CRD_ID", 3).collect() == sample_rows(df, "CRD_ID", 3).collect()
    u = union_aligned(df, spark.createDataFrame([(1, 2.5)], "CRD_ID int, x double"))
    assert u.columns == ["CRD_ID", "group", "tie_result", "x"] and u.count() == 7


def test_validators_find_nothing_in_own_output(spark, data):
    rows = spark.read.parquet(f"{data}/crd_catalog.parquet").drop("loaded_at", "tie_result").distinct()
    done = merge_labels(rows, deduplicate(rows, PRIORITIES, 0.001, restore=False))
    assert validate.tie_findings(done, 0.001).count() == 0
    assert validate.unlinked_rule(done).where("problem <> 'no neighbors but not 1'").count() == 0


def test_pairs_and_close_survivors_are_found(spark):
    rows = [
        ("a1", "a2", 0.1, 4.0, "s", 1, "ONE"), ("a2", "a1", 0.9, 4.0, "s", 0, "ONE"),
        ("b1", "b2", 0.1, 4.0, "s", 2, "ONE"), ("b2", "b1", 0.1005, 4.0, "s", 2, "TWO"),
        ("c1", "c2,c3", 0.1, 4.0, "s", 2, "ONE"), ("c2", "c1,c3", 0.5, 4.0, "s", 2, "ONE"), ("c3", "c1,c2", 0.1001, 4.0, "s", 2, "ONE"),
        ("d1", "d2,d3", 0.1, 4.0, "s", 2, "ONE"), ("d2", "d1,d3", 0.5, 4.0, "s", 2, "ONE"), ("d3", "d1,d2", 0.9, 4.0, "g", 0, "ONE"),
        ("e1", "e2", 0.1, 4.0, "s", 1, "ONE"), ("e2", "e1", 0.9, 4.0, "g", 0, "TWO"), ("f1", "f2", None, 4.0, "s", 2, "ONE"), ("f2", "f1", 0.1, 4.0, "s", 2, "ONE"),
    ]
    df = spark.createDataFrame(rows, "CRD_ID string, compared_to string, z double, z_flag_homogenized double, instrument_type_homogenized string, tie_result int, survey string").withColumn("source", F.col("survey"))
    assert sorted((r["rule"], r["component"]) for r in validate.tie_findings(df).collect()) == [("GROUP_DELTZ_INDEPENDENCE", "c1"), ("PAIR_1v0_PRIORITY", "a1"), ("PAIR_2v2_TIE_CONSISTENCY", "b1")]
    got = {r["bucket"]: r["groups"] for r in validate.group_cases(validate.linked_groups(df), "component").collect()}
    assert got == {"CASE1_large_same": 1, "CASE1_small_diff": 1, "CASE2_large_same": 2, "CASE1_large_diff": 1, "CASE1_small_same": 1, "TIE_FLAG_TYPE_BREAK_PAIR": 1, "SAME_FLAG_DIFF_TYPE": 1, "SAME_SOURCE_PAIR": 2}


# ------------------------------------------------------------------ preparing

RULES = {"ONE": {"z_flag": {"direct": {1: 1, 2: 3, 4: 4, 6: 6}}, "instrument_type": {"default": "s"}}}
MAPPING = {"id": "name", "ra": "RA", "dec": "DEC", "z": "zz", "z_flag": "q", "z_err": None, "survey": "who"}


def raw(spark, rows, schema="name string, RA double, DEC double, zz string, q double, who string, CRD_ID_prev string, z double"):
    return spark.createDataFrame(rows, schema)


def test_prepare(spark):
    df = raw(spark, [(" n1 ", 10.0, 5.0, "0.5", 4.0, "one", "old", 9.0), ("NaN", 10.0, 6.0, " nan ", 2.0, "One", "old", 9.0), ("n3", 999.0, 6.0, "1", 1.0, "one", "old", 9.0)]).coalesce(1)
    extra = prepare.extra_columns({"original": {"source": "name", "type": "str"}, "w": {"source": "gone", "type": "float"}, "num": {"source": "zz", "type": "int"}})
    out = prepare.prepare(df, Catalog("007_one", MAPPING, extra), RULES, cut=3, preview_flag=True)
    assert out.columns == ["CRD_ID", "id", "ra", "dec", "z", "z_flag", "z_err", "instrument_type", "survey", "source", "tie_result", "is_in_preview_fields", "compared_to", "z_flag_homogenized", "instrument_type_homogenized", "original", "w", "num"]
    rows = out.collect()
    assert [(r["CRD_ID"], r["id"], r["z"], r["survey"], r["original"], r["w"], r["num"], r["tie_result"]) for r in rows] == [("CRD007_1", "n1", 0.5, "ONE", " n1 ", None, 0, 1), ("CRD007_2", None, None, "ONE", "NaN", None, None, 1)]
    with pytest.raises(ValueError, match="positions"):
        prepare.prepare(df, Catalog("007_one", MAPPING), RULES)
    with pytest.raises(EmptyCatalog):
        prepare.prepare(df, Catalog("007_one", MAPPING), RULES, cut=5)
    with pytest.raises(ValueError, match="number and an underscore"):
        prepare.prepare(df, Catalog("one", MAPPING), RULES)
    with pytest.raises(ValueError, match="similar"):
        prepare.prepare(df, Catalog("007_one", MAPPING | {"ra": "RAA"}), RULES)
    with pytest.raises(ValueError, match="no numbers"):
        prepare.prepare(df.withColumn("zz", F.lit("1d")), Catalog("007_one", MAPPING), RULES)


def test_schema_steps(spark):
    df = spark.createDataFrame([(1, "x", 2)], "id int, name string, ra int")
    out = prepare.rename(df, Catalog("001_a", {"id": "name"}))
    assert {"id", "id__orig", "ra", "source", "z_err"} <= set(out.columns) and out.first()["id"] == "x" and out.first()["id__orig"] == 1
    prev = spark.createDataFrame([(1,) * 8], "id int, CRD_ID int, compared_to int, group_id int, CRD_ID_prev2 int, compared_to_prev3 int, tie_result int, ra int")
    assert prepare.drop_previous(prev).columns == ["id", "tie_result", "ra"]
    own = ["CRD_ID", "ra", "dec", "z", "source", "tie_result"]
    assert prepare.own_id_mapping(Catalog("1_a", {}), own).columns == {"id": "CRD_ID"} and prepare.own_id_mapping(Catalog("1_a", {}), [*own, "id"]).columns == {"id": "id"}
    assert prepare.own_id_mapping(Catalog("1_a", {}), ["id"]).columns == {}
    assert prepare.copy_extra(df, Catalog("1_a", {}, {"ra": ("gone", "string")})).columns == ["id", "name"]
    for bad, error in (([1], TypeError), ({"a": {"what": 1}}, ValueError), ({" ": "str"}, ValueError), ({"a": "list"}, ValueError), ({"ra": "float"}, ValueError)):
        with pytest.raises(error):
            prepare.extra_columns(bad)
    assert [prepare.as_bool(x) for x in (True, "YES", "on", 1, "0", None)] == [True, True, True, True, False, False]


def test_ids_follow_the_order_over_partitions(spark):
    ids = prepare.ids_by_order(spark.range(1000).repartition(7), "012_x", "id").collect()
    assert {r["id"]: r["CRD_ID"] for r in ids} == {i: f"CRD012_{i + 1}" for i in range(1000)}


@pytest.mark.parametrize("mode, rows", [("concatenate", 5), ("concatenate_and_mark_duplicates", 5), ("concatenate_and_remove_duplicates", 3)])
def test_whole_run(spark, tmp_path, mode, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("name,RA,DEC,zz,q,who\nn1,10,5,0.5,4,one\nn2,20,5,0.6,2,one\nn3,30,5,0.1,6,one\n")
    (tmp_path / "in" / "b.csv").write_text("name,RA,DEC,zz,q,who\nm1,10.00001,5,0.5001,2,one\nm2,40,5,0.6,4,one\n")
    (tmp_path / "in" / "c.csv").write_text("name,RA,DEC,zz,q,who\nk1,10,5,0.5,1,one\n")
    config = {
        "inputs": {"specz": [{"path": str(tmp_path / "in" / f"{n}.csv"), "internal_name": f"00{i}_{n}", "columns": MAPPING} for i, n in enumerate("abc", 1)]},
        "output_root_dir": str(tmp_path), "output_dir": "out", "output_name": "cat", "param": {"combine_type": mode, "z_flag_homogenized_value_to_cut": 2},
    }
    rules = {"translation_rules": RULES, "tiebreaking_priority": PRIORITIES, "crossmatch_radius_arcsec": 0.5, "delta_z_threshold": 0.001}
    for _ in range(2):  # the second run resumes
        report = pipeline.run(spark, config, rules, str(tmp_path / "work"))
    assert report["status"] == "Successful" and report["catalogs"]["003_c"] == "empty"
    out = spark.read.parquet(report["output"])
    assert out.count() == rows
    if mode != "concatenate":
        tie = {r["CRD_ID"]: r["tie_result"] for r in out.collect()}
        assert tie["CRD001_1"] == 1 and tie.get("CRD002_1", 0) == 0 and tie.get("CRD001_3", 3) == 3
        assert report["columns_assoc"]["id"] == "CRD_ID"
    else:
        assert "tie_result" not in out.columns


def test_run_with_footprint_and_a_priority_of_its_own(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("name,RA,DEC,zz,q,who,depth,seen\nn1,10,-5,0.5,4,one,1.5,9\nn2,20,50,0.6,2,one,2,9\n")
    (tmp_path / "in" / "b.csv").write_text("name,RA,DEC,zz,q,who,depth,seen\nm1,10.00001,-5,0.5001,4,one,3.5,9\n")
    (tmp_path / "in" / "c.csv").write_text("name,RA,DEC,zz,q,who,depth,seen\nk1,10,-5.00001,0.5,4,one,2.5,9\nk2,200,0,0.5,4,one,2.5,9\n")
    spark.createDataFrame([(float(k), 0.0) for k in range(0, 360, 5)], "ra double, dec double").write.parquet(str(tmp_path / "border"))
    config = {
        "inputs": {"specz": [{"path": str(tmp_path / "in" / f"{n}.csv"), "internal_name": f"00{i}_{n}", "columns": MAPPING} for i, n in enumerate("abc", 1)]},
        "output_root_dir": str(tmp_path), "output_dir": "out", "output_name": "cat", "param": {"insert_rubin_footprint_flag": True, "footprint_border": str(tmp_path / "border")},
    }
    translations = {"ONE": {"z_flag": {"conditions": [{"expr": "seen == 9", "value": 4}], "default": 3}, "instrument_type": {"default": "s"}}}
    rules = {"translation_rules": translations, "tiebreaking_priority": ["z_flag_homogenized", "depth"], "crossmatch_radius_arcsec": 0.5, "save_expr_columns": "true"}
    work = str(tmp_path / "work")
    report = pipeline.run(spark, config, rules, work)
    out = {r["id"]: r for r in spark.read.parquet(report["output"]).collect()}
    assert {k: r["tie_result"] for k, r in out.items()} == {"n1": 0, "m1": 1, "k1": 0, "n2": 1, "k2": 1}
    assert {k: r["is_in_footprint"] for k, r in out.items()} == {"n1": 1, "m1": 1, "k1": 1, "n2": 0, "k2": 1} and out["m1"]["depth"] == 3.5 and out["k2"]["seen"] == 9
    assert spark.read.parquet(f"{work}/checks/tie_counts").count() == 2 and json.loads((tmp_path / "work" / "config.json").read_text()) == config
    # A run that is resumed matches nothing anew: what the phases left is taken as it is.
    spark.read.parquet(f"{work}/labels").withColumn("tie_result", F.lit(2)).write.parquet(f"{work}/other")
    (tmp_path / "work" / "labels").rename(tmp_path / "work" / "old")
    (tmp_path / "work" / "other").rename(tmp_path / "work" / "labels")
    again = pipeline.run(spark, config, rules, work)
    assert {r["tie_result"] for r in spark.read.parquet(again["output"]).collect()} == {2}
    with pytest.raises(ValueError, match="border"):
        pipeline.run(spark, {**config, "param": {"insert_rubin_footprint_flag": True}}, rules, str(tmp_path / "w2"))


def test_ids_stay_dense_when_partitions_are_coalesced(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
    try:
        df = spark.range(5000).withColumn("text", F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")))
        ids = prepare.ids_by_order(df, "012_x", "id").select("id", "CRD_ID").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert {r["id"]: r["CRD_ID"] for r in ids} == {i: f"CRD012_{i + 1}" for i in range(5000)}


def test_runs_that_fail(spark, tmp_path):
    with pytest.raises(ValueError):
        pipeline.combine([spark.range(1)], "mix", {})
    with pytest.raises(RuntimeError):
        pipeline.combine([spark.range(0)], "concatenate", {})
    p = tmp_path / "a.csv"
    p.write_text("name,RA,DEC,zz,q,who\nn1,10,5,0.5,1,one\n")
    config = {"inputs": {"specz": [{"path": str(p), "internal_name": "001_a", "columns": MAPPING}]}, "output_root_dir": str(tmp_path), "output_name": "x", "param": {"z_flag_homogenized_value_to_cut": 4}}
    with pytest.raises(RuntimeError, match="empty"):
        pipeline.run(spark, config, {"translation_rules": RULES, "tiebreaking_priority": PRIORITIES}, str(tmp_path / "w"))
    assert json.loads((tmp_path / "w" / "process.json").read_text())["status"] == "Failed"
