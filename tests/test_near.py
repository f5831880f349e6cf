import math

import numpy as np
import pytest

from skyloom.operators import near
from skyloom.operators.near import cap_triangles, ear_clip, pairs_within, points_in_regions, unit


def brute(points, radius):
    ids = [p[0] for p in points]
    v = unit(np.array([p[1] for p in points], float), np.array([p[2] for p in points], float))
    limit = (2 * math.sin(math.radians(radius / 3600) / 2)) ** 2
    out = set()
    for i in range(len(ids)):
        for j in np.flatnonzero(((v - v[i]) ** 2).sum(axis=1) <= limit):
            if ids[i] < ids[j]:
                out.add((ids[i], ids[j]))
    return out


def crowded(n, seed=1):
    rng = np.random.default_rng(seed)
    centers = [(0.0, 0.0), (359.9999, 10.0), (180.0, 89.9999), (12.0, -90.0), (200.0, 45.0)]
    out = []
    for k in range(n):
        ra, dec = centers[k % len(centers)]
        dec = dec + rng.normal() * 2e-4
        dec = max(-90.0, min(90.0, dec))
        ra = (ra + rng.normal() * 2e-4 / max(math.cos(math.radians(dec)), 1e-6)) % 360
        out.append((f"p{k:05d}", ra, dec))
    return out


@pytest.mark.parametrize("leaf", [40_000, 50])
def test_pairs_against_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(near, "ROWS_PER_LEAF", leaf)
    points = crowded(1500)
    df = spark.createDataFrame(points, "id string, ra double, dec double").repartition(4)
    got = {tuple(r) for r in pairs_within(df, "id", "ra", "dec", 0.5).collect()}
    assert got == brute(points, 0.5) and len(got) > 500


def test_pairs_of_odd_rows(spark):
    rows = [("b", 10.0, 10.0, 1), ("a", 10.0, 10.0, 2), ("a", 10.0, 10.0, 2), (None, 10.0, 10.0, 3), ("c", None, 10.0, 4), ("d", float("nan"), 10.0, 5), ("e", 360.0, 10.0, 6), ("f", 10.0, 91.0, 7)]
    df = spark.createDataFrame(rows, "id string, ra double, dec double, leaf int")
    assert [tuple(r) for r in pairs_within(df, "id", "ra", "dec", 0.5).collect()] == [("a", "b")]
    assert pairs_within(df.limit(0), "id", "ra", "dec", 0.5).collect() == []


def test_many_copies_of_one_position(spark):
    df = spark.createDataFrame([(f"k{i:03d}", 5.0, 5.0) for i in range(150)], "id string, ra double, dec double")
    assert pairs_within(df, "id", "ra", "dec", 0.5).count() == 150 * 149 // 2


def area(ring):
    return abs(sum(ring[i - 1][0] * ring[i][1] - ring[i][0] * ring[i - 1][1] for i in range(len(ring)))) / 2


@pytest.mark.parametrize("turn", [1, -1])
@pytest.mark.parametrize("ring", [[(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)], [(0, 0), (3, 0), (3, 3), (0, 3)], [(0, 0), (2, 0), (4, 0), (4, 2), (1, 2), (1, 3), (0, 3)]])
def test_ear_clipping_covers_the_polygon_once(ring, turn):
    ring = np.array(ring[::turn], float)
    tri = ear_clip(ring)
    assert sum(area(ring[t]) for t in tri) == pytest.approx(area(ring))


def test_ear_clipping_of_degenerate_rings():
    assert len(ear_clip(np.array([[0.0, 0.0], [1, 1]]))) == 0
    assert len(ear_clip(np.array([[0.0, 0.0], [1, 1], [2, 2]]))) == 0


def test_cap_polygon_holds_the_cap():
    c = unit(np.array([10.0, 0.0, 200.0]), np.array([89.99, 0.0, -45.0]))
    tri = cap_triangles(c, math.radians(0.5 / 3600))
    assert tri.shape == (3, 2, 3, 3)


SQUARE = [(359.0, -1.0), (1.0, -1.0), (1.0, 1.0), (359.0, 1.0)]
NEXT = [(1.0, -1.0), (3.0, -1.0), (3.0, 1.0), (1.0, 1.0)]
POLE = [(0.0, 80.0), (90.0, 80.0), (180.0, 80.0), (270.0, 80.0)]


def test_regions(spark):
    regions = spark.createDataFrame([("sq", SQUARE), ("next", NEXT), ("pole", POLE[::-1]), ("none", None), ("two", SQUARE[:2])], "region string, ring array<struct<ra:double,dec:double>>")
    points = [(1, 0.0, 0.0), (2, 359.5, 0.5), (3, 2.0, 0.0), (4, 45.0, 89.0), (5, 10.0, 0.0), (6, 1.0, 0.0), (7, None, 0.0), (1, 0.0, 0.0), (8, 90.0, 82.0), (9, 180.0, -89.0)]
    df = spark.createDataFrame(points, "id long, ra double, dec double")
    got = sorted(tuple(r) for r in points_in_regions(df, regions, "id", "ra", "dec", "region", "ring").collect())
    assert got == [(1, "sq"), (2, "sq"), (3, "next"), (4, "pole"), (6, "next"), (6, "sq"), (8, "pole")]
    once = sorted(tuple(r) for r in points_in_regions(df, regions, "id", "ra", "dec", "region", "ring", unique=True).collect())
    assert once == [(1, "sq"), (2, "sq"), (3, "next"), (4, "pole"), (6, "next"), (8, "pole")]
    assert points_in_regions(df.limit(0), regions, "id", "ra", "dec", "region", "ring").count() == 0


@pytest.mark.parametrize("leaf", [40_000, 100])
def test_regions_against_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(near, "ROWS_PER_LEAF", leaf)
    rng = np.random.default_rng(3)
    ra, dec = rng.uniform(0, 20, 3000), rng.uniform(-10, 10, 3000)
    star = [(10 + r * math.cos(a), r * math.sin(a)) for k in range(14) for r, a in [((8, 3)[k % 2], 2 * math.pi * k / 14)]]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(ra, dec))], "id long, ra double, dec double")
    regions = spark.createDataFrame([(7, star)], "region int, ring array<struct<ra:double,dec:double>>")
    got = {r[0] for r in points_in_regions(df, regions, "id", "ra", "dec", "region", "ring").collect()}
    v, p = unit(*np.array(star).T), unit(ra, dec)
    c = v.mean(axis=0)
    c /= np.linalg.norm(c)
    e1 = np.cross(c, [0, 0, 1.0])
    e1 /= np.linalg.norm(e1)
    e2 = np.cross(c, e1)
    flat, q = np.stack([v @ e1, v @ e2], 1) / (v @ c)[:, None], np.stack([p @ e1, p @ e2], 1) / (p @ c)[:, None]
    inside = np.zeros(len(q), bool)
    for a, b in zip(flat, np.roll(flat, -1, axis=0)):
        crosses = (a[1] > q[:, 1]) != (b[1] > q[:, 1])
        with np.errstate(divide="ignore", invalid="ignore"):
            inside ^= crosses & (q[:, 0] < (b[0] - a[0]) * (q[:, 1] - a[1]) / (b[1] - a[1]) + a[0])
    assert got == set(np.flatnonzero(inside))


def test_field_polygons_hold_their_rows(spark, data):
    from skyloom.plans.problem_queries import p4_regions
    from skyloom.session import table

    rows = table(spark, data, "crd_catalog").where("ra >= 0 and ra < 360 and dec between -90 and 90 and obs_field is not null").select("CRD_ID", "obs_field").distinct()
    got = p4_regions(spark, data)
    fields = got.select("obs_field").distinct()
    lost = rows.join(fields, "obs_field").join(got, ["CRD_ID", "obs_field"], "left_anti")
    assert lost.count() == 0 and fields.count() > 0
