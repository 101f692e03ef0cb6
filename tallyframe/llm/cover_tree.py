"""Exact cosine threshold pairs by dual traversal of cover trees.

Equal vectors are one point with a multiplicity. Points are dealt by hash to shards of bounded
size, and each shard builds a cover tree: nested levels of centers with halving radii, where
every point lies within the radius of a center of each level and centers are further apart
than it. The root has all points below it; the first radius under it is the distance asked for,
as with many dimensions a wider node is too near to everything to be dropped. Every node
knows how far its furthest point is. Each pair of shards is then one task that
walks both trees from the top: a pair of nodes is dropped if their distance less both covering
radii is beyond the threshold, taken as a whole if their distance plus both radii is within
it, and else split into its children. What is left at the lowest level is compared in double
precision. Dot products of centers use single precision; its worst rounding error is taken off
the squared distance before the root, to the safe side of each bound, and covering radii are
computed in double precision and rounded up, so that no bound drops or adds a link.

A task puts out, per point, how many vectors it is linked to and the smallest point of its
part, not the pairs, so a large group of near copies costs no more rows than it has members.
The number of shard pairs grows with the square of the shards, and so do the trees shipped: the
join brings every tree to every other, and only the walk within a task drops pairs of nodes.

Defined results: vectors that are null, zero, or have null or non-finite components link with
nothing, as do vectors of different length; a row without id links with nothing and is kept;
an id that several rows share is compared with each of its vectors.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .frames import arrow_rows, row_by_row, stage

COSINE = 0.9
SHARD_POINTS = 8192
LEVELS = 5
#: What a whole pair of nodes must be nearer than the threshold, above any rounding in double.
INSIDE = 1e-9
BLOCK = 2048

TREES_DDL = "dim int, shard int, tree binary"
FOUND = pa.schema([("point", pa.int64()), ("links", pa.int64()), ("part", pa.int64())])
FOUND_DDL = "point long, links long, part long"


def dot_error(dimension: int) -> float:
    """Bound on the error of a single-precision dot product of unit vectors, in any order."""
    return (dimension + 4) * 2.0**-24


def nearest_and_furthest(near: np.ndarray, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the distance of unit vectors from their single-precision dot product."""
    squared, error = 2 - 2 * near.astype(np.float64), 2 * dot_error(dimension)
    return np.sqrt(np.maximum(0, squared - error)), np.sqrt(np.maximum(0, squared + error))


class CoverTree:
    """Arrays of a cover tree: per level the centers, their parents, radii and children."""

    def __init__(
        self, ids: np.ndarray, weights: np.ndarray, points: np.ndarray, cosine: float = COSINE
    ):
        self.ids, self.weights, self.points = ids, weights, points
        self.single = points.astype(np.float32)
        centers = np.zeros(1, np.int64)
        self.centers, self.parents = [centers], []
        cover = np.zeros(len(points), np.int64)
        radius = float(np.sqrt(2 - 2 * cosine))
        for _ in range(LEVELS):
            wider, finer = self._refined(centers, cover, radius)
            self.parents.append(cover[wider])
            self.centers.append(wider)
            centers, cover = wider, finer
            radius /= 2
        self.leaf = cover
        self._measure()

    def _refined(
        self, centers: np.ndarray, before: np.ndarray, radius: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """The centers and, greedily, points beyond ``radius`` of all; and each point's center.

        A point that is a center, or within ``radius`` of its center ``before``, is covered.
        """
        bound = np.float32(1 - radius * radius / 2)
        chosen = list(centers)
        near = np.einsum("ij,ij->i", self.single, self.single[centers[before]])
        cover = np.where(near >= bound, before, -1)
        cover[centers] = np.arange(len(centers))
        open_points = np.flatnonzero(cover < 0)
        for first in range(0, len(open_points), BLOCK):
            rows = open_points[first:first + BLOCK]
            for start in range(0, len(chosen), BLOCK):
                some = np.array(chosen[start:start + BLOCK])
                close = self.single[rows] @ self.single[some].T
                best = close.argmax(axis=1)
                hit = (cover[rows] < 0) & (close[np.arange(len(rows)), best] >= bound)
                cover[rows[hit]] = start + best[hit]
            left = rows[cover[rows] < 0]
            close = self.single[left] @ self.single[left].T >= bound
            for i, row in enumerate(left):
                if cover[row] < 0:
                    number = len(chosen)
                    chosen.append(row)
                    covered = left[close[i]]
                    covered = covered[cover[covered] < 0]
                    cover[covered] = number
                    cover[row] = number
        return np.array(chosen, np.int64), cover

    def _measure(self) -> None:
        """Covering radius, weight and children of each node."""
        self.radii, self.children, self.sizes = [], [], []
        owner = self.leaf
        for level in range(LEVELS, -1, -1):
            centers = self.centers[level]
            near = np.einsum("ij,ij->i", self.points, self.points[centers[owner]])
            rounding = 8 * (self.points.shape[1] + 4) * 2.0**-53
            far = np.sqrt(np.maximum(0, 2 - 2 * near) + rounding)
            radii = np.zeros(len(centers))
            np.maximum.at(radii, owner, far)
            self.radii.insert(0, radii)
            self.sizes.insert(0, np.bincount(owner, minlength=len(centers)))
            members = owner if level == LEVELS else self.parents[level]
            order = np.argsort(members, kind="stable")
            bounds = np.searchsorted(members[order], np.arange(len(centers) + 1))
            self.children.insert(0, (order, bounds))
            if level:
                owner = self.parents[level - 1][owner]

    def below(self, level: int, node: int) -> np.ndarray:
        """Nodes of the next level under a node; at the lowest level, its points."""
        order, bounds = self.children[level]
        return order[bounds[node]:bounds[node + 1]]

    def points_under(self, level: int, node: int) -> np.ndarray:
        nodes = np.array([node])
        for depth in range(level, LEVELS + 1):
            nodes = np.concatenate([self.below(depth, n) for n in nodes])
        return nodes

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        named = {"ids": self.ids, "weights": self.weights, "points": self.points, "leaf": self.leaf}
        named |= {f"centers{i}": x for i, x in enumerate(self.centers)}
        named |= {f"parents{i}": x for i, x in enumerate(self.parents)}
        np.savez(out, **named)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, body: bytes) -> CoverTree:
        tree, named = cls.__new__(cls), np.load(io.BytesIO(body))
        for name in ("ids", "weights", "points", "leaf"):
            setattr(tree, name, named[name])
        tree.single = tree.points.astype(np.float32)
        tree.centers = [named[f"centers{i}"] for i in range(LEVELS + 1)]
        tree.parents = [named[f"parents{i}"] for i in range(LEVELS)]
        tree._measure()
        return tree


class Parts:
    """Link counts of the points of two trees, and the parts their links join them to."""

    def __init__(self, one: CoverTree, two: CoverTree, same: bool):
        self.same, self.one, self.two = same, one, two
        self.shift = 0 if same else len(one.ids)
        total = len(one.ids) if same else len(one.ids) + len(two.ids)
        self.links = np.zeros(total, np.int64)
        self.part = np.arange(total)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unite the parts of the ends of links (positions over both trees)."""
        part = self.part
        while len(a):
            while (part[part] != part).any():
                part[:] = part[part]
            one, two = part[a], part[b]
            apart = one != two
            a, b, one, two = a[apart], b[apart], one[apart], two[apart]
            if len(a):
                np.minimum.at(part, np.maximum(one, two), np.minimum(one, two))

    def block(self, rows: np.ndarray, cols: np.ndarray, linked: np.ndarray, diagonal: bool) -> None:
        """Links given as a boolean matrix of points; ``diagonal``: both sides are one node."""
        self.links[rows] += linked @ self.two.weights[cols]
        if diagonal:
            self.links[rows] -= self.one.weights[rows] * linked.diagonal()
        else:
            self.links[self.shift + cols] += self.one.weights[rows] @ linked
        i, j = np.nonzero(linked)
        self.join(rows[i], self.shift + cols[j])

    def whole(self, rows: np.ndarray, cols: np.ndarray) -> None:
        """Every point of one side is linked to every point of the other."""
        self.links[rows] += self.two.weights[cols].sum()
        self.links[self.shift + cols] += self.one.weights[rows].sum()
        self.join(rows, np.full(len(rows), self.shift + cols[0]))
        self.join(self.shift + cols, np.full(len(cols), rows[0]))


def traverse(one: CoverTree, two: CoverTree, same: bool, cosine: float) -> Parts:
    """Walk two trees (or one with itself) down to the linked points."""
    parts = Parts(one, two, same)
    reach = float(np.sqrt(2 - 2 * cosine))
    dimension = one.points.shape[1]
    stack = [(0, 0, 0)]
    while stack:
        level, a, b = stack.pop()
        rows, cols = one.below(level, a), two.below(level, b)
        own = same and a == b
        if level == LEVELS:
            for x in range(0, len(rows), BLOCK):
                for y in range(x if own else 0, len(cols), BLOCK):
                    r, c = rows[x:x + BLOCK], cols[y:y + BLOCK]
                    close = one.points[r] @ two.points[c].T >= cosine
                    parts.block(r, c, close, own and x == y)
            continue
        below = level + 1
        for x in range(0, len(rows), BLOCK):
            for y in range(x if own else 0, len(cols), BLOCK):
                r, c = rows[x:x + BLOCK], cols[y:y + BLOCK]
                near = one.single[one.centers[below][r]] @ two.single[two.centers[below][c]].T
                widest = one.radii[below][r].max() + two.radii[below][c].max()
                loose = 1 - (reach + widest + INSIDE) ** 2 / 2 - 2 * dot_error(dimension)
                i, j = np.nonzero(near >= loose)
                if own and x == y:  # each pair once, and no point with itself
                    once = (i < j) | ((i == j) & (one.sizes[below][r[i]] > 1))
                    i, j = i[once], j[once]
                nearest, furthest = nearest_and_furthest(near[i, j], dimension)
                radii = one.radii[below][r[i]] + two.radii[below][c[j]]
                for k in np.flatnonzero(nearest - radii <= reach + INSIDE):
                    p, q = int(r[i[k]]), int(c[j[k]])
                    if furthest[k] + radii[k] <= reach - INSIDE and not (same and p == q):
                        parts.whole(one.points_under(below, p), two.points_under(below, q))
                    else:
                        stack.append((below, p, q))
    return parts


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def build_tree(cosine: float):
    def build(rows: pa.Table) -> pa.Table:
        return _tree_row(rows, cosine)

    return build


def _tree_row(rows: pa.Table, cosine: float) -> pa.Table:
    vectors = np.array(rows["v"].to_pylist(), np.float64)
    order = np.argsort(rows["point"].to_numpy())
    tree = CoverTree(
        rows["point"].to_numpy()[order], rows["copies"].to_numpy()[order], unit(vectors)[order],
        cosine,
    )
    return pa.table({
        "dim": pa.array([rows["dim"][0].as_py()], pa.int32()),
        "shard": pa.array([rows["shard"][0].as_py()], pa.int32()),
        "tree": pa.array([tree.to_bytes()], pa.binary()),
    })


def threshold_links(
    vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_points: int = SHARD_POINTS,
) -> DataFrame:
    """Per vector row: number of other vectors at ``cosine`` or closer, and its component."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    usable = F.col("vec_id").isNotNull() & F.coalesce(
        finite & F.exists("v", lambda x: x != 0), F.lit(False)
    )
    valid = rows.where(usable)
    same = stage(
        valid.groupBy("v").agg(F.min("vec_id").alias("point"), F.count(F.lit(1)).alias("copies")),
        "points",
    )
    sizes = same.select(F.size("v").alias("dim")).groupBy("dim").agg(
        F.ceil(F.count(F.lit(1)) / shard_points).cast("int").alias("shards")
    )
    dealt = same.withColumn("dim", F.size("v")).join(F.broadcast(sizes), "dim").withColumn(
        "shard", F.pmod(F.xxhash64("point"), F.col("shards")).cast("int")
    )
    trees = stage(
        dealt.groupBy("dim", "shard").applyInArrow(build_tree(cosine), TREES_DDL), "cover-trees"
    )
    pairs = sizes.select("dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "shards")
    pairs = pairs.select(
        "dim", "shard", F.explode(F.sequence(F.col("shard"), F.col("shards") - 1)).alias("other")
    )
    both = pairs.join(trees, ["dim", "shard"]).join(
        trees.select("dim", F.col("shard").alias("other"), F.col("tree").alias("other_tree")),
        ["dim", "other"],
    ).repartition(F.col("dim"), F.col("shard"), F.col("other"))

    def walk(batches):
        for row in row_by_row(batches):
            alike = row["shard"] == row["other"]
            one = CoverTree.from_bytes(row["tree"])
            two = one if alike else CoverTree.from_bytes(row["other_tree"])
            parts = traverse(one, two, alike, cosine)
            ids = one.ids if alike else np.concatenate([one.ids, two.ids])
            some = np.flatnonzero(parts.links)
            yield arrow_rows(
                FOUND, point=ids[some], links=parts.links[some],
                part=ids[roots(parts.part)[some]],
            )

    found = stage(
        both.select("shard", "other", "tree", "other_tree").mapInArrow(walk, FOUND_DDL), "point-links"
    )
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    component = connected_components(found, "point", "part")
    points = same.join(links, "point", "left").join(
        component.withColumnRenamed("node", "point"), "point", "left"
    ).select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "point").alias("component_id"),
    )
    joined = valid.join(points, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return joined.unionByName(alone).withColumn(
        "kept", F.col("vec_id").isNull() | (F.col("vec_id") == F.col("component_id"))
    )


def roots(part: np.ndarray) -> np.ndarray:
    while (part[part] != part).any():
        part = part[part]
    return part
