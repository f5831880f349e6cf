import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyloom.llm import leaks, packing
from skyloom.llm.chars import code_points, gram_hashes, gram_sums, words_only
from skyloom.llm.leaks import ItemIndex, find_leaks
from skyloom.llm.packing import OpenBins, count_tokens, pack
from skyloom.llm.queries import VOCABULARY
from skyloom.llm.truncation import Trimmer, _thresholds, find_truncated

# ------------------------------------------------------------------ characters


def test_words_and_hashes():
    c = words_only(code_points(["  Één, TWO_three!\n", "", None or "", "x²—y"]))
    assert "".join(map(chr, c)) == "\0één two three\0\0\0x² y\0"
    h = gram_hashes(gram_sums(np.frombuffer("abcabcd".encode("utf-32-le"), np.uint32)), 3)
    assert h[0] == h[3] and len(set(h.tolist())) == 4
    assert len(gram_hashes(gram_sums(np.zeros(2, np.uint32)), 3)) == 0


# --------------------------------------------------------------------- packing


def packed(spark, sizes, capacity):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id long, size long")
    return pack(df, "id", "size", capacity).collect()


@pytest.mark.parametrize("streams", [8192, 10])
def test_packing(spark, monkeypatch, streams):
    monkeypatch.setattr(packing, "CONTAINERS_PER_STREAM", streams)
    rng = random.Random(5)
    sizes = [rng.randrange(0, 900) for _ in range(4000)] + [5000, 2048, 4096, 0, None, -3]
    out = packed(spark, sizes, 2048)
    used, pieces = defaultdict(int), defaultdict(list)
    for r in sorted(out, key=lambda r: (r["container"], r["start"], r["length"])):
        assert r["start"] == used[r["container"]] or r["length"] == 0
        used[r["container"]] += r["length"]
        pieces[r["id"]].append(r["length"])
    assert max(used.values()) <= 2048
    assert {i: sum(p) for i, p in pieces.items()} == {i: max(s or 0, 0) for i, s in enumerate(sizes)}
    assert all(len(pieces[i]) == 1 for i, s in enumerate(sizes) if 0 < (s or 0) <= 2048)
    assert sum(used.values()) / (2048 * sum(v > 0 for v in used.values())) > (0.97 if streams == 8192 else 0.7)


def test_nothing_to_pack(spark):
    assert packed(spark, [], 100) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=200), st.integers(1, 5))
def test_open_bins(sizes, most):
    bins, free = OpenBins(50, most), {}
    for s in sizes:
        number, start = bins.place(s)
        assert free.get(number, 50) == 50 - start and start + s <= 50
        free[number] = 50 - start - s
        assert bins.open <= most + 1
    assert sum(50 - f for f in free.values()) == sum(sizes)


def test_tokens(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (3, "")], "id long, t string")
    assert {r["id"]: r["tokens"] for r in count_tokens(df, "id", "t", VOCABULARY).collect()} == {1: 2, 2: 0, 3: 0}


# ----------------------------------------------------------------------- leaks


def edits(a, b):
    """The fewest edits that turn ``a`` into a part of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def coded(text):
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=3), min_size=3, max_size=6), st.text("ab ", max_size=25), st.integers(0, 2))
def test_alignment_of_runs_of_words(item, doc, budget):
    text = " ".join(item)
    ix = ItemIndex([text], 3, 2, budget)
    codes = coded(f"\0{doc}\0")
    whole = (0, 0, len(codes), -len(text), len(codes), np.repeat(np.arange(len(text)), 9))  # a region of all diagonals
    w, _, _, n = ix.aligned(codes, whole)
    runs = [" ".join(item[k : k + 3]) for k in range(len(item) - 2)]
    assert dict(zip(w.tolist(), n.tolist())) == {k: edits(r, f"\0{doc}\0") for k, r in enumerate(runs) if edits(r, f"\0{doc}\0") <= budget}


def words(rng, n):
    return [rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa"]) + str(rng.randrange(30)) for _ in range(n)]


def found(spark, docs, items, **more):
    d = spark.createDataFrame(list(enumerate(docs)), "doc long, text string")
    i = spark.createDataFrame(list(enumerate(items)), "item long, text string")
    return {(r["doc"], r["item"]) for r in find_leaks(d, i, "doc", "text", "item", "text", **more).collect()}


@pytest.mark.parametrize("limit", [4_000_000, 300])
def test_leaks(spark, monkeypatch, limit):
    monkeypatch.setattr(leaks, "ITEM_BLOCK_CHARS", limit)
    rng = random.Random(1)
    items = [" ".join(words(rng, 40)) for _ in range(6)] + ["too short", "", None]
    part = items[0].split()
    docs = [
        f"intro, {'; '.join(part[5:18]).upper()}. end", f"intro {' '.join(part[5:17])} end", f"x{' '.join(part[5:18])}", items[1], f"{items[2]}\n\n{items[3]}" * 3, None, "", "too short",
        " ".join(words(rng, 3000)) + " " + " ".join(items[4].split()[-13:]), " ".join(part[5:12] + ["other"] + part[12:18]),
    ]
    assert found(spark, docs, items) == {(0, 0), (3, 1), (4, 2), (4, 3), (8, 4)}


def test_leaks_with_edits(spark):
    """An insertion, deletion or substitution anywhere in a passage of 25 words, between other words."""
    rng = random.Random(2)
    item = words(rng, 60)
    docs = []
    for k in range(300):
        at = rng.randrange(36)
        passage = " ".join(item[at : at + 25])
        x = rng.randrange(1, len(passage) - 1)
        passage = passage[:x] + rng.choice(["", "j", passage[x] + "j"]) + passage[x + 1 :]
        docs.append(" ".join([*words(rng, 20), passage, *words(rng, 20)]))
    text = " ".join(item)
    assert len(found(spark, docs, [text], words=25, exact=False)) >= 0.99 * len(docs)
    twice = text[:150] + "XY" + text[152:300]
    assert found(spark, [twice[60:240], "plain words only"], [text[:300]], words=25, exact=False) == set()
    assert found(spark, [], [text]) == set() and found(spark, [text], []) == set()


def test_ids_of_any_type(spark):
    text = " ".join(words(random.Random(4), 30))
    d, i = spark.createDataFrame([("d", text)], "doc string, text string"), spark.createDataFrame([(1.5, text)], "item double, text string")
    assert [(r["doc"], r["item"], r["edits"]) for r in find_leaks(d, i, "doc", "text", "item", "text").collect()] == [("d", 1.5, 0)]


# ------------------------------------------------------------------ truncation


def test_trimmer():
    trim = Trimmer(["- 0 -", "Aheet 0 of 0"])
    assert trim("The end.\n- 12 -\nSheet 3 of 14 \n") == "The end."
    assert trim("It broke he...") == "It broke he" and trim("It broke […]") == "It broke" and trim("") == "" and trim("Done.") == "Done."


def corpus(n, seed=3):
    rng = random.Random(seed)
    out, cut = [], set()
    for k in range(n):
        lines = []
        for _ in range(rng.randrange(4, 9)):
            lines.append(" ".join(f"The {rng.choice(['red', 'blue', 'old'])} {rng.choice(['rotor', 'valve', 'lamp'])} {rng.choice(['turns', 'holds', 'meets'])} the {rng.choice(['axle', 'plate', 'cover'])}." for _ in range(3)))
        text = "\n".join(lines)
        if k % 5 == 0:
            at = len(text) - rng.randrange(3, 40)
            text = text[:at].rstrip()
            if not text.endswith("."):
                cut.add(k)
        if k % 3 == 0:
            text += rng.choice(["\n- 7 -", "..." if k in cut else "", "\n"])
        out.append((k, text, rng.choice(["en", "EN", None])))
    return out, cut


def test_truncation_on_held_out_breaks(spark):
    rows, cut = corpus(1200)
    df = spark.createDataFrame([*rows, (9001, None, "en"), (9002, "", "en"), (9003, " \n ", None), (9004, "a", None)], "id long, text string, lang string")
    out = {r["id"]: r["truncated"] for r in find_truncated(df, "id", "text", "lang").collect()}
    assert len(out) == 1204 and not out[9001] and not out[9002] and not out[9003]
    got = {k for k, v in out.items() if v and k < 9000}
    assert len(got & cut) / len(got) > 0.95 and len(got & cut) / len(cut) > 0.95


def test_truncation_of_no_rows(spark):
    assert find_truncated(spark.createDataFrame([], "id long, text string, lang string"), "id", "text", "lang").count() == 0


def test_no_count_switches_the_thresholds(spark):
    def fitted(n):
        # English breaks lie below -4.5 and ends begin at -3.25, German ones below -3 and at -1.5.
        en = [("en", -6.0 + 0.25 * k, 400 if k < 6 else 0 if k < 11 else 1000) for k in range(20)] + [("en", 1.0, 8000)]
        de = [("de", -6.0 + 0.25 * k, n // 20) for k in range(12)] + [("de", -1.5, n // 5), ("de", 1.0, n - n // 5 - 12 * (n // 20))]
        rows = spark.createDataFrame([r for r in en + de if r[2]], "language string, log_odds double, n int")
        return _thresholds(rows.selectExpr("language", "log_odds + 0.1 as log_odds", "explode(sequence(1, n)) as i"))

    just_below, just_above, many = fitted(1999), fitted(2000), fitted(200_000)
    assert just_below == just_above
    assert -3.0 <= many["de"] <= -1.5 and -4.5 <= just_below["en"] <= -3.25
