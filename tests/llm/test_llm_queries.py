import re

import pytest
from comparing import compare

from skyloom.llm import queries
from skyloom.session import table


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, data, name):
    compare(spark, data, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, data, name):
    df = queries.QUERIES[name](spark, data)
    assert df.columns and df.count() > 0


def test_leaks_against_brute_force(spark, data):
    word = re.compile(r"[^\W_]+")
    grams = {}
    for r in table(spark, data, "eval_items").collect():
        w = word.findall(r["text"].lower())
        for k in range(len(w) - 12):
            grams.setdefault(" ".join(w[k : k + 13]), set()).add(r["item_id"])
    expected = set()
    for r in table(spark, data, "documents").collect():
        w = word.findall(r["text"].lower())
        for k in range(len(w) - 12):
            expected |= {(r["doc_id"], i) for i in grams.get(" ".join(w[k : k + 13]), ())}
    assert {tuple(r) for r in queries.QUERIES["p8_found"](spark, data).collect()} == expected
