import random

import pytest
from pyspark.sql import functions as F

from skyloom.llm import groups
from skyloom.llm.groups import group_matches
from skyloom.llm.survivors import Field, discover_truth, survivors
from skyloom.operators import graph, joins


def plain_groups(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        if a and b and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {x: root(x) for x in parent}


def grouped(spark, pairs):
    return {r["id"]: r["group_key"] for r in group_matches(spark.createDataFrame(pairs, "x string, y string"), "x", "y").collect()}


CASES = {
    "none": [], "odd": [("a", "a"), (None, "b"), ("b", None), (None, None)], "repeated": [("b", "a"), ("a", "b"), ("a", "b")],
    "chain": [(f"c{i:04d}", f"c{i + 1:04d}") for i in range(300)], "hub": [("hub", f"s{i:03d}") for i in range(400)],
    "random": [(f"r{random.Random(i).randrange(500)}", f"r{random.Random(-i - 1).randrange(500)}") for i in range(330)],
}


@pytest.mark.parametrize("name", CASES)
def test_groups_against_union_find(spark, name):
    assert grouped(spark, CASES[name]) == plain_groups(CASES[name])


@pytest.mark.parametrize("beta, steps", [(0.6, 1), (0.05, 4)])
def test_any_rate_gives_the_same_groups(spark, monkeypatch, beta, steps):
    monkeypatch.setattr(groups, "BETA", beta)
    monkeypatch.setattr(groups, "STEPS", steps)
    pairs = CASES["random"] + CASES["repeated"]
    assert grouped(spark, pairs) == plain_groups(pairs)


def test_ids_that_share_a_hash(spark, monkeypatch):
    monkeypatch.setattr(graph, "id_hash", lambda c: F.pmod(F.xxhash64(c), F.lit(11)))
    assert grouped(spark, CASES["random"]) == plain_groups(CASES["random"])


def in_table(spark, ids, named):
    table = spark.createDataFrame([(i,) for i in ids], "id string")
    number = groups.table_numbers(table, "id")
    names = spark.createDataFrame(named, "id string, value string").select(number(F.col("id")).alias("v"), "value")
    got = groups.group_table(table, "id", names, number)
    return {r["id"]: r["group"] for r in table.distinct().join(got, number(F.col("id")) == got["v"]).collect()}, number


@pytest.mark.parametrize("salted", [False, True])
def test_groups_of_a_table(spark, monkeypatch, salted):
    if salted:  # the first salts give numbers that ids share
        right = groups.id_number
        monkeypatch.setattr(groups, "id_number", lambda c, salt: F.pmod(right(c, salt), F.lit(11)) if salt < 2 else right(c, salt))
    ids = [f"r{i}" for i in range(500) if i % 7] + ["r1", "r1", None, "alone"]
    named = [p for p in CASES["random"] if p[0] in ids] + [("r1", None), (None, "r2"), ("r3", "r3"), ("r4", "some object"), ("r5", "r7"), ("r5", "r14")]
    got, number = in_table(spark, ids, named)
    expected = plain_groups([p for p in named if p[0] in ids and p[1] in ids])
    assert set(got) == set(expected)
    assert len({(got[i], expected[i]) for i in got}) == len(set(got.values())) == len(set(expected.values()))
    assert not salted or number(F.lit("r1"))._jc.toString() == right(F.lit("r1"), 2)._jc.toString()


@pytest.mark.parametrize("ids, named", [([], []), ([None], [(None, "a")]), (["a"], [("a", "b"), ("a", "a")])])
def test_a_table_without_links(spark, ids, named):
    assert in_table(spark, ids, named)[0] == {}


def test_share_of_crossing_links_on_a_long_chain(spark):
    n = 100_000
    links = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.lit(0).alias("level"))
    c = groups._grow(links, [])
    crossing = links.join(c.toDF("a", "ca"), "a").join(c.toDF("b", "cb"), "b").where("ca <> cb").count() / n
    assert 0.31 < crossing < 0.36


def test_hubs_are_looked_up_apart(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_FROM", 0)
    assert joins.hot_keys(spark.createDataFrame([(1,)] * 300 + [(i,) for i in range(2, 900)], "u long"), "u", 1198) == [1]
    pairs = CASES["hub"] + [(f"q{i}", f"r{i}") for i in range(300)] + [("s001", "q5")]
    assert grouped(spark, pairs) == plain_groups(pairs)


MEMBERS = "group string, id string, source string, flag double, kind int, z double"


def surviving(spark, rows):
    fields = [Field("flag", F.col("flag"), F.coalesce("flag", F.lit(-1.0))), Field("kind", F.col("kind"), F.coalesce("kind", F.lit(0)))]
    return {(r["group"], r["id"]): r["tie_result"] for r in survivors(spark.createDataFrame(rows, MEMBERS), fields, F.col("z"), 0.001).collect()}


@pytest.mark.parametrize("rows, expected", [
    ([], {}),
    ([("g", "a", "s", 4.0, 1, 0.5), ("g", "b", "s", 3.0, 3, 0.5)], {("g", "a"): 1}),
    ([("g", "a", "s", 4.0, 1, 0.5), ("g", "b", "s", 4.0, 3, 0.5)], {("g", "b"): 1}),
    ([("g", "b", "s", 4.0, 1, 0.5), ("g", "a", None, 4.0, 1, 0.5004), ("g", "c", "s", 4.0, 1, 0.7)], {("g", "a"): 2, ("g", "c"): 2}),
    ([("g", "a", "s", None, None, None), ("g", "b", "t", None, None, float("nan")), ("g", "c", "t", None, None, 0.1)], {("g", "a"): 2, ("g", "b"): 2, ("g", "c"): 2}),
    ([("g", "a", "s", 4.0, 1, 0.5)] * 3 + [("h", "b", "s", 1.0, 0, 0.1)], {("g", "a"): 1, ("h", "b"): 1}),
])
def test_survivors(spark, rows, expected):
    assert surviving(spark, rows) == expected


def test_a_hot_group_with_many_rows(spark):
    rows = [("hot", f"k{i:05d}", f"s{i % 7}", float(i % 4), i % 3, (i % 50) * 0.01) for i in range(6000)]
    got = surviving(spark, rows)
    best = [r for r in rows if r[3] == 3.0 and r[4] == 2]
    assert set(got) == {("hot", min(r[1] for r in best if r[5] == z)) for z in {r[5] for r in best}} and set(got.values()) == {2}


def test_reliable_sources_outvote_a_majority_of_poor_ones(spark):
    good = [(f"g{i}", v, 0, s, 1) for i in range(40) for s, v in [("a", i), ("b", i), ("x", 1000 + i), ("y", 2000 + i), ("z", 3000 + i)]]
    hard = [("hard", 1, 0, "a", 1), ("hard", 2, 0, "x", 1), ("hard", 1, 0, "b", 1), ("hard", 2, 0, "y", 1), ("hard", 2, 0, "z", 1)]
    claims = spark.createDataFrame(good + hard, "group string, value int, trust int, source string, n long")
    best, weights, rounds = discover_truth(claims, [("value", "trust")])
    assert {r["value"] for r in best.where("group = 'hard'").collect()} == {1} and rounds > 1
    w = {r["source"]: r["weight"] for r in weights.collect()}
    assert w["a"] > 0.9 and w["x"] < 0.1
    trusted = claims.withColumn("trust", F.when((F.col("group") == "hard") & (F.col("value") == 2), 1).otherwise(0))
    assert {r["value"] for r in discover_truth(trusted, [("value", "trust")])[0].where("group = 'hard'").collect()} == {2}
    assert discover_truth(claims.limit(0), [("value", "trust")])[0].isEmpty()


def test_hot_keys_are_exact_whatever_the_buckets(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_FROM", 0)
    keys = spark.createDataFrame([("a",)] * 300 + [(None,)] * 300 + [("b",)] * 6 + [("c",)] * 5 + [(f"k{i}",) for i in range(589)], "u string")
    for buckets in (1, 7, 1 << 14):
        monkeypatch.setattr(joins, "BUCKETS", buckets)
        assert sorted(joins.hot_keys(keys, "u", 1200)) == ["a"]
        assert sorted(joins.hot_keys(keys, "u", 1100)) == ["a", "b"]
    assert joins.hot_keys(keys.where("u > 'd'"), "u", 1200) == []


def test_the_links_of_a_vertex_are_shuffled_once_for_hearing_and_telling(spark):
    links = spark.range(5000).select(F.col("id").alias("a"), (F.col("id") + F.col("id") % 7 + 1).alias("b"), F.lit(0).alias("level"))
    plan = groups._grow(links, [])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(v#") == 1 and "Exchange hashpartitioning(u#" in plan
