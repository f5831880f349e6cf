"""Points near other points, and the regions that contain points, on the sphere.

Every neighborhood and every region is a polygon. Polygons are cut into triangles by ear clipping, the triangles are distributed
through a bounding-volume hierarchy, candidate triangles are tested exactly, and assignments found through two triangles that share
a border are made once.

The hierarchy has two parts. Its upper part (median splits of a bounded sample, so that the leaves hold about as many rows each
however crowded the sky is) is sent to every task and routes rows to leaves; Spark shuffles the rows by leaf. Its lower part is
built over the triangles of one leaf inside the task. All positions are unit vectors, so ra 0/360 and the poles need no care.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.healpix import pixel
from skyloom.session import Scratch

#: Rows a leaf should hold, and the most leaves; the upper hierarchy is fitted on at most SAMPLE_PER_LEAF rows for each leaf.
ROWS_PER_LEAF = 40_000
MAX_LEAVES = 1 << 16
SAMPLE_PER_LEAF = 64
#: Points tested at a time within a task.
BLOCK = 1 << 15


def valid_position(ra: Column, dec: Column) -> Column:
    """Within 0 <= ra < 360 and -90 <= dec <= 90; null and NaN are not."""
    return F.coalesce((ra >= 0) & (ra < 360) & (dec >= -90) & (dec <= 90), F.lit(False))


def unit(ra: np.ndarray, dec: np.ndarray) -> np.ndarray:
    a, d = np.radians(ra), np.radians(dec)
    return np.stack([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)], axis=1)


# ---------------------------------------------------------------- ear clipping


def ear_clip(ring: np.ndarray) -> np.ndarray:
    """Triangles (k, 3) of vertex numbers of a simple polygon ``ring`` (n, 2), in any direction of turn.

    Fewer than three vertices give no triangles; a vertex on a straight line or a repeated vertex is clipped without a triangle.
    """
    n = len(ring)
    if n < 3:
        return np.empty((0, 3), np.int64)
    x, y = ring[:, 0], ring[:, 1]
    area = float(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y))
    left = list(range(n)) if area >= 0 else list(range(n))[::-1]
    out = []

    def turn(a, b, c):
        return (ring[b, 0] - ring[a, 0]) * (ring[c, 1] - ring[a, 1]) - (ring[b, 1] - ring[a, 1]) * (ring[c, 0] - ring[a, 0])

    while len(left) > 3:
        for k in range(len(left)):
            a, b, c = left[k - 1], left[k], left[(k + 1) % len(left)]
            t = turn(a, b, c)
            if t == 0:
                left.pop(k)
                break
            if t < 0:
                continue
            rest = np.array([v for v in left if v not in (a, b, c)])
            inside = (turn(a, b, rest) >= 0) & (turn(b, c, rest) >= 0) & (turn(c, a, rest) >= 0)
            same = np.isin(x[rest], x[[a, b, c]]) & np.isin(y[rest], y[[a, b, c]])
            if not (inside & ~same).any():
                out.append((a, b, c))
                left.pop(k)
                break
        else:  # not a simple polygon: what is left is cut as a fan
            out += [(left[0], left[k], left[k + 1]) for k in range(1, len(left) - 1)]
            return np.array(out, np.int64)
    if len(left) == 3 and turn(*left) > 0:
        out.append(tuple(left))
    return np.array(out, np.int64).reshape(-1, 3)


def region_triangles(ra: np.ndarray, dec: np.ndarray) -> np.ndarray:
    """Triangles (k, 3, 3) of unit vectors of a region with great-circle borders, within a half sphere about its center."""
    v = unit(np.asarray(ra, float), np.asarray(dec, float))
    c = v.mean(axis=0)
    c /= np.linalg.norm(c) or 1.0
    e1 = np.cross(c, [0.0, 0.0, 1.0] if abs(c[2]) < 0.9 else [1.0, 0.0, 0.0])
    e1 /= np.linalg.norm(e1)
    e2 = np.cross(c, e1)
    depth = v @ c
    flat = np.stack([v @ e1, v @ e2], axis=1) / depth[:, None]  # great circles become straight lines
    return v[ear_clip(flat)]


def cap_triangles(center: np.ndarray, radius: float, corners: int = 4) -> np.ndarray:
    """Triangles (m, k, 3, 3) that cover the cap of ``radius`` (radians) about each center: a regular polygon around it, ear-clipped once."""
    reach = 1.02 * math.tan(radius) / math.cos(math.pi / corners)
    at = 2 * np.pi * np.arange(corners) / corners
    ring = np.stack([np.cos(at), np.sin(at)], axis=1)
    pole = np.where(np.abs(center[:, 2:3]) < 0.9, [[0.0, 0.0, 1.0]], [[1.0, 0.0, 0.0]])
    e1 = np.cross(center, pole)
    e1 /= np.linalg.norm(e1, axis=1, keepdims=True)
    e2 = np.cross(center, e1)
    v = center[:, None] + reach * (ring[None, :, 0:1] * e1[:, None] + ring[None, :, 1:2] * e2[:, None])
    return v[:, ear_clip(ring)]


# ------------------------------------------------- the hierarchy within a leaf


class TriangleTree:
    """A bounding-volume hierarchy over triangles (n, 3, 3); boxes are grown by ``slack``, as the sphere bulges from the plane of a triangle."""

    WIDTH = 4

    def __init__(self, tri: np.ndarray, slack: float):
        n = len(tri)
        lo, hi = tri.min(axis=1), tri.max(axis=1)
        mid = (lo + hi) / 2
        base, span = mid.min(axis=0), np.ptp(mid, axis=0).max() or 1.0
        code = np.zeros(n, np.uint64)
        cell = ((mid - base) / span * ((1 << 20) - 1)).astype(np.uint64)
        for axis in range(3):
            v = cell[:, axis]
            for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
                v = (v | (v << np.uint64(shift))) & np.uint64(mask)
            code |= v << np.uint64(axis)
        order = np.argsort(code, kind="stable")
        self.depth = max(0, math.ceil(math.log2(max(1, -(-n // self.WIDTH)))))
        size = self.WIDTH << self.depth
        self.order = np.concatenate([order, np.full(size - n, -1)])
        low, high = np.full((size, 3), np.inf), np.full((size, 3), -np.inf)
        low[:n], high[:n] = lo[order] - slack, hi[order] + slack
        low, high = low.reshape(-1, self.WIDTH, 3).min(axis=1), high.reshape(-1, self.WIDTH, 3).max(axis=1)
        self.levels = [(low, high)]
        while len(low) > 1:
            low, high = low.reshape(-1, 2, 3).min(axis=1), high.reshape(-1, 2, 3).max(axis=1)
            self.levels.append((low, high))
        self.levels.reverse()
        a, b, c = tri[:, 0], tri[:, 1], tri[:, 2]
        flip = np.sign(np.einsum("ij,ij->i", np.cross(b - a, c - a), a))[:, None]
        self.normals = np.stack([np.cross(a, b - a), np.cross(b, c - b), np.cross(c, a - c)], axis=1) * flip[:, None]
        self.corner = tri

    def hits(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point number, triangle number) of every triangle that holds a point, borders included."""
        at, node = np.arange(len(p)), np.zeros(len(p), np.int64)
        for low, high in self.levels:
            q = p[at]
            ok = ((q >= low[node]) & (q <= high[node])).all(axis=1)
            at, node = at[ok], node[ok]
            if low is not self.levels[-1][0]:
                at, node = np.repeat(at, 2), np.repeat(node * 2, 2)
                node[1::2] += 1
        tri = self.order[(node[:, None] * self.WIDTH + np.arange(self.WIDTH)).ravel()]
        at = np.repeat(at, self.WIDTH)
        at, tri = at[tri >= 0], tri[tri >= 0]
        q = p[at]
        inside = np.ones(len(at), bool)
        for k in range(3):
            inside &= np.einsum("ij,ij->i", self.normals[tri, k], q - self.corner[tri, k]) >= -1e-16
        inside &= np.einsum("ij,ij->i", q, self.corner[tri, 0]) > 0
        return at[inside], tri[inside]


# -------------------------------------------------- the hierarchy above leaves


class TopTree:
    """Median splits of a sample of unit vectors; a leaf is the part of space that the splits above it leave."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.axis, self.cut = np.zeros(1 << depth, np.int8), np.zeros(1 << depth)
        self._split(sample, 1, depth)

    def _split(self, s: np.ndarray, node: int, depth: int) -> None:
        if depth:
            axis = int(np.argmax(np.ptp(s, axis=0))) if len(s) else 0
            cut = float(np.median(s[:, axis])) if len(s) else 0.0
            self.axis[node], self.cut[node] = axis, cut
            below = s[:, axis] < cut
            self._split(s[below], 2 * node, depth - 1)
            self._split(s[~below], 2 * node + 1, depth - 1)

    def home(self, p: np.ndarray) -> np.ndarray:
        node, rows = np.ones(len(p), np.int64), np.arange(len(p))
        for _ in range(self.depth):
            node = 2 * node + (p[rows, self.axis[node]] >= self.cut[node])
        return node - (1 << self.depth)

    def touching(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that the box of a row touches."""
        at, node = np.arange(len(low)), np.ones(len(low), np.int64)
        for _ in range(self.depth):
            axis, cut = self.axis[node], self.cut[node]
            down, up = low[at, axis] < cut, high[at, axis] >= cut
            at, node = np.concatenate([at[down], at[up]]), np.concatenate([2 * node[down], 2 * node[up] + 1])
        return at, node - (1 << self.depth)


def fit_top_tree(points: DataFrame, ra: str, dec: str, rows: int) -> TopTree:
    """The upper hierarchy from a sample of at most about SAMPLE_PER_LEAF rows a leaf. ``rows``: rows there are, at most."""
    depth = min(int(math.log2(MAX_LEAVES)), max(0, math.ceil(math.log2(max(1, rows / ROWS_PER_LEAF)))))
    if depth == 0:
        return TopTree(np.empty((0, 3)), 0)
    want = SAMPLE_PER_LEAF << depth
    got = points.select(ra, dec).sample(min(1.0, want / rows), seed=7).limit(2 * want).toPandas()
    return TopTree(unit(got[ra].to_numpy(float), got[dec].to_numpy(float)), depth)


def _by_leaf(batches, build, probe, schema):
    """Runs through rows sorted by (leaf, kind): gathers a leaf's regions (kind 0), then streams its points (kind 1) past them."""
    leaf, parts, tree = None, [], None
    for batch in batches:
        leaves = batch.column("leaf").to_numpy()
        kinds = batch.column("kind").to_numpy()
        starts = np.flatnonzero(np.r_[True, (leaves[1:] != leaves[:-1]) | (kinds[1:] != kinds[:-1])]) if len(leaves) else []
        for s, e in zip(starts, [*starts[1:], len(leaves)]):
            if leaves[s] != leaf:
                leaf, parts, tree = leaves[s], [], None
            piece = batch.slice(s, e - s)
            if kinds[s] == 0:
                parts.append(piece)
                continue
            if parts:
                tree, parts = build(pa.Table.from_batches(parts)), []
            if tree is not None:
                for k in range(0, len(piece), BLOCK):
                    out = probe(tree, piece.slice(k, BLOCK))
                    if len(out[0]):
                        yield pa.RecordBatch.from_arrays(out, schema=schema)


# ------------------------------------------------------------------ operators


def pairs_within(df: DataFrame, key: str, ra: str, dec: str, radius_arcsec: float) -> DataFrame:
    """Distinct (left, right) keys of different rows at most ``radius_arcsec`` apart on the sphere, left < right by code point.

    Rows with a null key, or with null, NaN or out-of-range coordinates, are near nothing. Rows of one key never pair with each
    other; a key with several positions is near whatever any of them is near. Repeated rows and exact copies of a position pair
    once for each two keys. An empty table gives no rows.
    """
    rows = df.select(F.col(key).alias("id"), F.col(ra).cast("double").alias("ra"), F.col(dec).cast("double").alias("dec"))
    rows = rows.where(F.col("id").isNotNull() & valid_position(F.col("ra"), F.col("dec")))
    total = df.select(F.count(F.lit(1))).first()[0]
    top = fit_top_tree(rows, "ra", "dec", total)
    radius = math.radians(radius_arcsec / 3600)
    chord2 = (2 * math.sin(radius / 2)) ** 2
    reach = 1.01 * radius + 1e-12
    shared = df.sparkSession.sparkContext.broadcast(top)  # bounded by MAX_LEAVES

    def route(batches):
        tree = shared.value
        for b in batches:
            p = unit(b.column("ra").to_numpy(), b.column("dec").to_numpy())
            home = tree.home(p)
            at, leaf = tree.touching(p - reach, p + reach)
            take = np.concatenate([np.arange(len(p)), at])
            picked = b.take(pa.array(take))
            kind = np.concatenate([np.zeros(len(p), np.int8), np.ones(len(at), np.int8)])
            leaves = np.concatenate([home, leaf]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(leaves), pa.array(kind), *picked.columns], names=["leaf", "kind", "id", "ra", "dec"])

    def build(t):
        t = t.select(["id", "ra", "dec"]).group_by(["id", "ra", "dec"]).aggregate([])  # rows delivered twice
        center = unit(t.column("ra").to_numpy(), t.column("dec").to_numpy())
        tri = cap_triangles(center, radius)
        ids = t.column("id").combine_chunks()
        return TriangleTree(tri.reshape(-1, 3, 3), 2 * radius * radius + 1e-15), tri.shape[1], center, pa.chunked_array([ids]).combine_chunks()

    def probe(tree, b):
        bvh, per, center, ids = tree
        p = unit(b.column("ra").to_numpy(), b.column("dec").to_numpy())
        at, tri = bvh.hits(p)
        both = np.unique(at * np.int64(len(center)) + tri // per)  # a point on the border of two triangles of a cap
        at, region = both // len(center), both % len(center)
        near = ((p[at] - center[region]) ** 2).sum(axis=1) <= chord2
        left, right = ids.take(pa.array(region[near])), b.column("id").take(pa.array(at[near]))
        less = pa.compute.less(left, right)
        return [left.filter(less), right.filter(less)]

    schema = pa.schema([("left", pa.string()), ("right", pa.string())])
    routed = rows.mapInArrow(route, "leaf int, kind byte, id string, ra double, dec double")
    placed = routed.repartition(F.col("leaf")).sortWithinPartitions("leaf", "kind")
    return placed.mapInArrow(lambda b: _by_leaf(b, build, probe, schema), "left string, right string").distinct()


def points_in_regions(points: DataFrame, regions: DataFrame, key: str, ra: str, dec: str, region: str, ring: str, unique: bool = False) -> DataFrame:
    """Distinct (key, region) of every point within a region, borders included.

    ``ring`` is an array of (ra, dec) structs, the corners of a simple polygon with great-circle borders in any direction of turn,
    less than a half sphere wide; fewer than three corners, a null ring or a null corner contain nothing. With ``unique`` a point on
    the border of several regions, or within several, goes to the smallest of them. Points with null, NaN or out-of-range
    coordinates are in no region; repeated rows come out once; a null key stays null.
    """
    key_type = dict(points.dtypes)[key]
    region_type = dict(regions.dtypes)[region]
    rows = points.select(F.col(key).alias("id"), F.col(ra).cast("double").alias("ra"), F.col(dec).cast("double").alias("dec"))
    rows = rows.where(valid_position(F.col("ra"), F.col("dec")))
    total = points.select(F.count(F.lit(1))).first()[0]
    shared = points.sparkSession.sparkContext.broadcast(fit_top_tree(rows, "ra", "dec", total))

    def cut(batches):
        tree = shared.value
        for b in batches:
            for r, corners in zip(b.column("region").to_pylist(), b.column("ring").to_pylist()):
                at = [(c["ra"], c["dec"]) for c in corners or [] if c]
                if len(at) < 3 or len(at) < len(corners) or any(x is None for c in at for x in c):
                    continue
                tri = region_triangles(*np.array(at, float).T)
                bulge = np.ptp(tri, axis=1).max(axis=1, keepdims=True) ** 2  # arcs reach beyond the box of their ends
                row, leaf = tree.touching(tri.min(axis=1) - bulge, tri.max(axis=1) + bulge)
                flat = pa.array(list(tri[row].reshape(-1, 9)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), pa.array([r] * len(row), b.schema.field("region").type), flat], names=["leaf", "region", "tri"])

    def route(batches):
        tree = shared.value
        for b in batches:
            leaf = tree.home(unit(b.column("ra").to_numpy(), b.column("dec").to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), *b.columns], names=["leaf", "id", "ra", "dec"])

    triangles = regions.select(F.col(region).alias("region"), F.col(ring).alias("ring")).mapInArrow(cut, f"leaf int, region {region_type}, tri array<double>")
    placed = triangles.withColumn("kind", F.lit(0).cast("byte")).unionByName(
        rows.mapInArrow(route, f"leaf int, id {key_type}, ra double, dec double").withColumn("kind", F.lit(1).cast("byte")), allowMissingColumns=True
    ).repartition(F.col("leaf")).sortWithinPartitions("leaf", "kind")

    def build(t):
        tri = np.array(t.column("tri").combine_chunks().values.to_numpy()).reshape(-1, 3, 3)
        side = np.ptp(tri, axis=1).max()
        return TriangleTree(tri, side**2), t.column("region").combine_chunks()

    def probe(tree, b):
        bvh, names = tree
        at, tri = bvh.hits(unit(b.column("ra").to_numpy(), b.column("dec").to_numpy()))
        return [b.column("id").take(pa.array(at)), names.take(pa.array(tri))]

    sample = placed.select("id", "region").schema
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(sample)
    found = placed.mapInArrow(lambda b: _by_leaf(b, build, probe, schema), f"id {key_type}, region {region_type}").distinct()
    if unique:
        found = found.groupBy("id").agg(F.min("region").alias("region"))
    return found.select(F.col("id").alias(key), F.col("region").alias(region))


def _caps(rows: DataFrame, *by: str) -> DataFrame:
    """(by..., mx, my, mz, r): the mean position of each group's rows (x, y, z), and the angle to the farthest; half a sphere without a mean."""
    mean = rows.groupBy(*by).agg(*[F.avg(c).alias(f"m{c}") for c in "xyz"])
    length = F.sqrt(F.col("mx") * F.col("mx") + F.col("my") * F.col("my") + F.col("mz") * F.col("mz"))
    mean = mean.select(*by, length.alias("l"), *[F.when(length > 1e-6, F.col(f"m{c}") / length).alias(f"m{c}") for c in "xyz"])
    dot = F.col("x") * F.col("mx") + F.col("y") * F.col("my") + F.col("z") * F.col("mz")
    far = rows.join(mean, list(by)).groupBy(*by, "mx", "my", "mz").agg(F.min(dot).alias("d"))
    return far.select(*by, "mx", "my", "mz", F.coalesce(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), "d"))), F.lit(math.pi)).alias("r"))


def field_polygons(df: DataFrame, field: str, ra: str, dec: str, corners: int = 8) -> DataFrame:
    """(field, ring): for each field a polygon about the mean position of its rows that holds them all.

    A field that reaches 45 degrees or more from its mean has a polygon for each of the sky's 48 pixels of order 1 that hold rows of it.
    Fields without valid positions have none. Means and reaches are aggregates; no field's rows are gathered.
    """
    rows = df.where(F.col(field).isNotNull() & valid_position(F.col(ra), F.col(dec)))
    rows = rows.select(F.col(field).alias("f"), pixel(F.col(ra), F.col(dec), 1).alias("p"), *[c.alias(n) for c, n in zip(_vector(F.col(ra), F.col(dec)), "xyz")])
    whole = Scratch(df.sparkSession, "fields").keep(_caps(rows, "f"))
    wide = whole.where(F.col("r") >= math.pi / 4).select("f")
    reach = whole.where(F.col("r") < math.pi / 4).unionByName(_caps(rows.join(wide, "f", "left_semi"), "f", "p").drop("p"))
    # Corners at an angle that keeps the sides outside the circle of the farthest row.
    out = F.atan(F.tan(F.col("r") * 1.001 + 1e-9) / math.cos(math.pi / corners))
    d0, a0 = F.asin(F.col("mz")), F.atan2("my", "mx")
    ring = []
    for k in range(corners):
        t = 2 * math.pi * k / corners
        d1 = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.sin(d0) * F.cos(out) + F.cos(d0) * F.sin(out) * math.cos(t))))
        a1 = a0 + F.atan2(math.sin(t) * F.sin(out) * F.cos(d0), F.cos(out) - F.sin(d0) * F.sin(d1))
        ring.append(F.struct(F.pmod(F.degrees(a1), F.lit(360.0)).alias("ra"), F.degrees(d1).alias("dec")))
    return reach.select(F.col("f").alias(field), F.array(*ring).alias("ring"))


def _vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    a, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)
