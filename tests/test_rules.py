
import pytest
from pyspark.sql import functions as F

from skyloom.functions.rules import Rule, RuleError, compile_condition, variables
from skyloom.operators.homogenize import confidence_flag, flags_are_confidences, homogenize, letter_flag, surveys_without_rules, types_are_common

ROWS = [
    (1, 0.5, 3.0, "AB12", 7.0), (2, None, 13.0, "x", float("nan")), (3, float("nan"), -4.5, None, -1.0), (4, -0.25, None, "", 0.0), (5, float("inf"), 240.0, "ABCDEFG", 24.0),
]
SCHEMA = "n int, z double, flag double, name string, raw double"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


CONDITIONS = {
    "z > 0.1": {1, 5}, "z != 0.5": {4, 5}, "raw != -1": {1, 2, 4, 5}, "raw == -1": {3}, "0 <= z < 1": {1}, "not (z > 0.1)": {4}, "np.isfinite(z)": {1, 4}, "not np.isfinite(z)": {2, 3, 5},
    "np.abs(flag) == 4.5": {3}, "np.trunc(flag) == -4": {3}, "np.trunc(float(flag)) - 10*np.trunc(np.trunc(float(flag))/10) == 3": {1, 2}, "len(name) == 4": {1}, "name[0] == 'A'": {1, 5},
    "name[-1] == '2'": {1}, "str(name)[1:3] == 'BC'": {5}, "str(name)[-2:] == '12'": {1}, "name == 3": set(), "name != 3": {1, 2, 3, 4, 5}, "int(flag) == 3": {1}, "z > 0.1 and flag < 10 or raw == 0": {1, 4},
    "(flag >= 3) and (flag < 100)": {1, 2}, "flag / 0 == 1": set(), "-z == 0.25": {4},
}


@pytest.mark.parametrize("text", CONDITIONS)
def test_conditions(rows, text):
    c = compile_condition(text, rows.schema, ("z", "flag"))
    out = rows.select("n", c.alias("hit")).collect()
    assert all(r["hit"] is not None for r in out)
    assert {r["n"] for r in out if r["hit"]} == CONDITIONS[text]


@pytest.mark.parametrize("text", ["missing > 1", "__import__('os')", "z.real > 1", "[z]", "z ** 2 > 1", "open('x')", "z >", "name[::2] == 'x'", "z in (1, 2)", "lambda: z"])
def test_what_the_language_lacks(rows, text):
    with pytest.raises(RuleError):
        compile_condition(text, rows.schema)


def test_variables():
    assert variables("np.isfinite(z) and len(name) > flag") == {"z", "name", "flag"}


def test_last_condition_wins_over_direct_over_default(rows):
    rule = Rule.parse({"default": 0, "direct": {3: 1, 13.0: 2}, "conditions": [{"expr": "flag > 2", "value": 3}, {"expr": "flag > 10", "value": 4}, {"expr": "flag > 200"}]})
    got = {r["n"]: r["v"] for r in rows.select("n", rule.column("flag", rows.schema, ("flag",), "double").alias("v")).collect()}
    assert got == {1: 3.0, 2: 4.0, 3: 0.0, 4: 0.0, 5: 0.0}
    assert {r[0] for r in rows.select(Rule(direct={9: 1}).column("flag", rows.schema, (), "double")).collect()} == {None}


def test_fast_paths(spark):
    q = spark.createDataFrame([(v,) for v in (0.0, 0.1, 0.7, 0.9, 0.99, 1.0, None, float("nan"), 2.0)], "z_flag double")
    assert [r[0] for r in q.select(confidence_flag(F.col("z_flag"))).collect()] == [0.0, 1.0, 2.0, 3.0, 4.0, 4.0, None, None, None]
    assert not flags_are_confidences(q, "z_flag") and flags_are_confidences(q.where("z_flag <= 1 and not isnan(z_flag)"), "z_flag")
    assert not flags_are_confidences(q.where("z_flag in (0, 1)"), "z_flag") and not flags_are_confidences(q.limit(0), "z_flag")
    t = spark.createDataFrame([("S ",), ("g",), (None,), ("nan",)], "k string")
    assert types_are_common(t, "k") and not types_are_common(t.union(spark.createDataFrame([("x",)], "k string")), "k")


def test_letter_flags(spark):
    df = spark.createDataFrame([("jades", "A"), ("VIMOS", "MR_B"), ("VIMOS", "A"), ("X", "2"), ("JADES", None)], "survey string, f string")
    assert [r[0] for r in df.select(letter_flag(F.col("survey"), F.col("f"))).collect()] == [4.0, 3.0, None, 2.0, None]


RULES = {"One": {"z_flag": {"direct": {1: 0, 2: 3}}, "instrument_type": {"default": "s"}}, "Two": {"z_flag": {"default": 0, "conditions": [{"expr": "w > 1", "value": 4}]}, "instrument_type": {"default": "p"}}}


def test_homogenize_by_survey(spark):
    df = spark.createDataFrame([("ONE", 1.0, None, 5.0), ("one ", 2.0, None, 5.0), ("TWO", 9.0, None, 5.0)], "survey string, z_flag double, instrument_type string, w double")
    out = homogenize(df, RULES).select("z_flag_homogenized", "instrument_type_homogenized").collect()
    assert [tuple(r) for r in out] == [(0.0, "s"), (3.0, "s"), (4.0, "p")]
    assert homogenize(df.drop("w").where("survey <> 'TWO'"), RULES).count() == 2  # a rule for a survey that isn't there needs no columns


@pytest.mark.parametrize("survey, flag, match", [("not_supported", 3.0, "no translation"), (None, 3.0, "no row"), ("ONE", 15.0, "no row")])
def test_failures(spark, survey, flag, match):
    df = spark.createDataFrame([(survey, flag, None)], "survey string, z_flag double, instrument_type string")
    with pytest.raises(ValueError, match=match):
        homogenize(df, RULES)


def test_provided_values_off_the_scale(spark):
    df = spark.createDataFrame([("X", 1.0, "x", 7.0, "galaxy")], "survey string, z_flag double, instrument_type string, z_flag_homogenized double, instrument_type_homogenized string")
    with pytest.raises(ValueError, match="off the scale"):
        homogenize(df, {})
    assert surveys_without_rules(df, {"x": {}}) == [] and surveys_without_rules(df, {}) == ["X"]
