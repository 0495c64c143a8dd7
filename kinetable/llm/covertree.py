"""Pairs of close vectors by dual traversal of cover trees.

Vectors are compared within a label (and dimension).  On unit vectors a cosine threshold
is a distance threshold, so vectors are put into nested cells whose net radius halves from
level to level, until a cell fits into a task.  Every cell is covered by a ball around one
of its points.  Pairs of cells are traversed together from the roots down, and a pair is
dropped when its balls are further apart than the threshold allows.  Pairs of leaves that
remain are traversed the same way inside a task, with a cover tree of each leaf, and only
leaves of those are compared vector by vector, in double precision.

Equal vectors are one point with a count, so copies cost one point however many there are.
Tasks return link counts and a spanning forest of their links instead of the pairs.  Cells
that cannot be split (points closer than the last radius) are dealt into parts by digest,
and each two parts meet.

Vectors that are null, zero or hold null or non-finite numbers, and vectors without a
label, have no links and are their own component.  Ids may repeat or be null: the least id
that is not null names a component.  Extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import StageArea
from .common import map_batches, map_rows
from .components import components


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.93
    cell: int = 1024
    pivots: int = 16
    levels: int = 8
    # Points that move through one task while cells are split.
    moved: int = 50_000
    # In a task: points of a leaf, and children of a node.
    leaf: int = 32
    children: int = 24

    @property
    def distance(self) -> float:
        """Unit vectors at least this alike are at most this far apart; a little wider."""
        return math.sqrt(max(0.0, 2 - 2 * self.cosine)) + 1e-7


# --- inside a task -----------------------------------------------------------------------


class Node:
    """A ball around one of its points; children are smaller balls, or none in a leaf."""

    def __init__(self, center: int, radius: float, members: np.ndarray, children: list):
        self.center, self.radius, self.members = center, radius, members
        self.children = children


def build(unit: np.ndarray, members: np.ndarray, center: int, reach: float, settings) -> Node:
    """A cover tree: children are a net of half the reach, each covering what is next to it.

    In many dimensions a net can be as large as its ball; it ends at a number of children,
    and radii are measured, so the bounds hold all the same.
    """
    away = np.linalg.norm(unit[members] - unit[center], axis=1)
    radius = float(away.max(initial=0.0))
    if len(members) <= settings.leaf or radius < 1e-9:
        return Node(center, radius, members, [])
    while reach / 2 >= radius:
        reach /= 2
    centers, nearest, owner = [center], away, np.zeros(len(members), np.int64)
    while nearest.max() > reach / 2 and len(centers) < settings.children:
        far = int(nearest.argmax())
        centers.append(int(members[far]))
        new = np.linalg.norm(unit[members] - unit[members[far]], axis=1)
        closer = new < nearest
        owner[closer] = len(centers) - 1
        nearest = np.minimum(nearest, new)
    children = [
        build(unit, members[owner == place], one, reach / 2, settings)
        for place, one in enumerate(centers)
    ]
    return Node(center, radius, members, children)


def traverse(left: Node, right: Node, unit: np.ndarray, distance: float):
    """Members of node pairs that may hold close points; a node with itself is one pair.

    A pair whose children are mostly close is not taken further apart.
    """
    pending = [(left, right)]
    while pending:
        one, two = pending.pop()
        ones, twos = one.children or [one], two.children or [two]
        apart = _distances(unit[[n.center for n in ones]], unit[[n.center for n in twos]])
        bound = np.add.outer([n.radius for n in ones], [n.radius for n in twos]) + distance
        near = apart <= bound
        if not (one.children or two.children) and near.any() or 2 * near.sum() > near.size:
            yield one.members, two.members, one is two
            continue
        if one is two:
            near = np.triu(near)
        pending += [(ones[i], twos[j]) for i, j in zip(*np.nonzero(near), strict=True)]


def _distances(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    squares = 2 - 2 * (one @ two.T)
    # Rounding below the root must not drop a pair.
    return np.sqrt(np.maximum(squares - 1e-12, 0))


class Forest:
    """Union of places; the least place is the root."""

    def __init__(self, count: int):
        self.parent = list(range(count))

    def root(self, place: int) -> int:
        while self.parent[place] != place:
            self.parent[place] = place = self.parent[self.parent[place]]
        return place

    def join(self, one: int, two: int) -> None:
        one, two = self.root(one), self.root(two)
        self.parent[max(one, two)] = min(one, two)


def _columns(members: pa.StructArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    keys, vectors, copies = members.flatten()
    return keys, vectors.flatten().to_numpy().reshape(len(keys), -1), copies.to_numpy()


def close_points(left: pa.StructArray, right: pa.StructArray | None, settings: Settings):
    """``key, links, root`` of the points with links in a leaf, or between two."""
    parts = [_columns(side) for side in (left, right) if side is not None]
    keys = pa.concat_arrays([part[0] for part in parts])
    raw = np.concatenate([part[1] for part in parts])
    copies = np.concatenate([part[2] for part in parts])
    lengths = np.sqrt((raw * raw).sum(1))
    unit = raw / lengths[:, None]
    one = two = build(unit, np.arange(len(left)), 0, 2.0, settings)
    if right is not None:
        two = build(unit, np.arange(len(left), len(keys)), len(left), 2.0, settings)
    links, forest = np.zeros(len(keys), np.int64), Forest(len(keys))
    for some, others, same in traverse(one, two, unit, settings.distance):
        cosines = (raw[some] @ raw[others].T) / np.outer(lengths[some], lengths[others])
        linked = cosines >= settings.cosine
        if same:
            np.fill_diagonal(linked, False)
        links[some] += linked @ copies[others]
        if not same:
            links[others] += linked.T @ copies[some]
        for i, j in zip(*np.nonzero(linked), strict=True):
            forest.join(int(some[i]), int(others[j]))
    for place in np.flatnonzero(links).tolist():
        yield keys[place].as_py(), int(links[place]), keys[forest.root(place)].as_py()


# --- distributed -------------------------------------------------------------------------


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


# Between these, squares of components neither vanish nor overflow.
_SMALL, _LARGE = 1e-100, 1e100


def _scaled(vector: Column) -> Column:
    """A vector of odd magnitude divided by its largest component; others as they are."""
    largest = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    return F.when(largest.between(_SMALL, _LARGE) | (largest == 0), vector).otherwise(
        F.transform(vector, lambda x: x / largest)
    )


def _keyed(vectors: DataFrame) -> DataFrame:
    """``vec_id, key, cell, vector``; the key is null where nothing can be linked.

    A cosine does not depend on lengths, so vectors whose squares would leave the range
    of doubles are scaled first.
    """
    vector = F.col("embedding").cast("array<double>")
    group = F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string"))
    usable = _usable(vector) & F.col("label").isNotNull()
    key = F.unhex(F.md5(F.concat_ws("|", group, vector.cast("string"))))
    return vectors.select(
        "vec_id",
        F.when(usable, key).alias("key"),
        group.alias("cell"),
        F.when(usable, _scaled(vector)).alias("vector"),
    )


def _net(sample: list, reach: float) -> list[list[float]]:
    """Points of the sample that are more than the reach apart, in the sample's order."""
    chosen: list[np.ndarray] = []
    for point in sorted(sample, key=lambda point: point["key"]):
        unit = np.array(point["vector"])
        unit = unit / np.linalg.norm(unit)
        if all(np.linalg.norm(unit - other) > reach for other in chosen):
            chosen.append(unit)
    return [one.tolist() for one in chosen]


def _cells(points: DataFrame, settings: Settings, stage: StageArea) -> DataFrame:
    """The points with the paths of their cells, from the root's down."""
    points = stage.table(points.withColumn("path", F.array("cell")), "level-0")
    for level in range(1, settings.levels + 1):
        sizes = points.groupBy("cell").agg(F.count("*").alias("size"))
        large = stage.table(sizes.where(F.col("size") > settings.cell), f"large-{level}")
        if large.isEmpty():
            break
        reach = 2.0 / 2**level
        some = F.pmod(F.xxhash64("key", F.lit(level)), F.ceil(F.col("size") / settings.pivots)) == 0
        sampled = points.join(large, "cell").where(some).groupBy("cell").agg(
            F.collect_list(F.struct("key", "vector")).alias("sample")
        )

        def make_net(reach=reach):
            return lambda rows: ((cell, _net(sample, reach)) for cell, sample in rows)

        nets = map_rows(sampled, "cell string, net array<array<double>>", make_net)

        def make_owner():
            def each(rows):
                net = None
                for key, cell, vector, copies, path, centers in rows:
                    if centers is not None:
                        net = np.array(centers)
                        continue
                    cell = f"{cell}.{int(np.argmax(net @ np.array(vector)))}"
                    yield key, cell, vector, copies, [*path, cell]

            return each

        # A net comes before its points in every task that large cells are dealt to.
        names = ("key", "cell", "vector", "copies", "path")
        marked = points.join(large, "cell", "left")
        tasks = F.ceil(F.col("size") / settings.moved)
        moving = marked.where(F.col("size").isNotNull()).select(
            *names,
            F.lit(None).cast("array<array<double>>").alias("net"),
            F.pmod(F.xxhash64("key"), tasks).alias("task"),
        )
        ahead = nets.join(large, "cell").select(
            *(F.lit(None).cast(points.schema[name].dataType).alias(name) if name != "cell" else "cell"
              for name in names),
            "net",
            F.explode(F.sequence(F.lit(0).cast("bigint"), tasks - 1)).alias("task"),
        )
        dealt = ahead.union(moving).repartition("cell", "task").sortWithinPartitions(
            "cell", "task", F.col("net").isNull()
        )
        ddl = "key binary, cell string, vector array<double>, copies long, path array<string>"
        moved = map_rows(dealt.select(*names, "net"), ddl, make_owner)
        still = marked.where(F.col("size").isNull()).select(*names)
        points = stage.table(still.union(moved), f"level-{level}")
    sizes = points.groupBy("cell").agg(F.count("*").alias("size"))
    parts = F.ceil(F.col("size") / settings.cell)
    part = F.concat_ws("#", "cell", F.pmod(F.xxhash64("key"), parts).cast("string"))
    dealt = points.join(sizes.where(F.col("size") > settings.cell), "cell", "left")
    cell = F.when(F.col("size").isNotNull(), part).otherwise(F.col("cell"))
    path = F.when(
        F.col("size").isNotNull(), F.concat("path", F.array(part))
    ).otherwise(F.col("path"))
    dealt = dealt.select("key", cell.alias("cell"), "vector", "copies", path.alias("path"))
    return stage.table(dealt, "points")


def _distance(one: Column, two: Column) -> Column:
    squares = F.zip_with(one, two, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def _unit(vector: Column) -> Column:
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))
    return F.transform(vector, lambda x: x / length)


def _balls(points: DataFrame, stage: StageArea) -> DataFrame:
    """``parent, node, center, radius``; leaves are their own children as well."""
    placed = points.select(
        "key", _unit(F.col("vector")).alias("unit"), F.posexplode("path").alias("depth", "node"),
        "path",
    ).withColumn("parent", F.get("path", F.col("depth") - 1))
    leaf = F.max(F.col("depth") == F.size("path") - 1).alias("leaf")
    centers = placed.groupBy("node").agg(
        F.min_by("unit", "key").alias("center"), F.first("parent").alias("parent"), leaf
    )
    centers = stage.table(centers, "centers")
    away = placed.select("node", "unit").join(centers.select("node", "center"), "node")
    radii = away.groupBy("node").agg(F.max(_distance(F.col("unit"), F.col("center"))).alias("radius"))
    balls = centers.join(radii, "node")
    again = balls.where("leaf").withColumn("parent", F.col("node"))
    both = balls.union(again).select("parent", "node", "center", "radius")
    return stage.table(both, "balls")


def _leaf_pairs(balls: DataFrame, depth: int, settings: Settings, stage: StageArea) -> DataFrame:
    """Pairs of leaves whose balls are close, by descending in both trees at once."""
    one = balls.select(*(F.col(name).alias(f"{name}_1") for name in balls.columns))
    two = balls.select(*(F.col(name).alias(f"{name}_2") for name in balls.columns))
    roots = balls.where(F.col("parent").isNull()).select("node")
    pairs = roots.select(F.col("node").alias("one"), F.col("node").alias("two"))
    for level in range(depth):
        joined = pairs.join(one, F.col("one") == F.col("parent_1")).join(
            two, F.col("two") == F.col("parent_2")
        )
        near = _distance(F.col("center_1"), F.col("center_2")) <= (
            F.col("radius_1") + F.col("radius_2") + settings.distance
        )
        once = (F.col("one") != F.col("two")) | (F.col("node_1") <= F.col("node_2"))
        pairs = joined.where(near & once).select(
            F.col("node_1").alias("one"), F.col("node_2").alias("two")
        )
        pairs = stage.table(pairs, f"pairs-{level}")
    return pairs


def close_vectors(
    vectors: DataFrame, settings: Settings | None = None, stage: StageArea | None = None
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each vector."""
    settings = settings or Settings()
    stage = stage or StageArea(vectors.sparkSession)
    keyed = _keyed(vectors)
    points = keyed.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.first("cell").alias("cell"), F.first("vector").alias("vector"),
        F.count("*").alias("copies"),
    )
    points = _cells(points.select("key", "cell", "vector", "copies"), settings, stage)
    depth = points.agg(F.max(F.size("path"))).first()[0] or 0
    balls = _balls(points, stage)
    pairs = _leaf_pairs(balls, depth, settings, stage)
    leaves = points.groupBy("cell").agg(
        F.collect_list(F.struct("key", "vector", "copies")).alias("members")
    )
    leaves = stage.table(leaves, "leaves")
    left = leaves.select(F.col("cell").alias("one"), F.col("members").alias("left"))
    right = leaves.select(F.col("cell").alias("two"), F.col("members").alias("right"))
    right = F.when(F.col("one") != F.col("two"), F.col("right")).alias("right"), right

    def make():
        def each(batches):
            for batch in batches:
                for some, others in zip(*batch.columns, strict=True):
                    yield from close_points(some.values, others.values, settings)

        return each

    both = pairs.join(left, "one").join(right[1], "two").select("left", right[0])
    found = stage.table(map_batches(both, "key binary, links long, root binary", make), "found")
    roots = components(
        found.select(F.col("key").alias("a"), F.col("root").alias("b")), stage, "vectors"
    ).withColumnRenamed("node", "key")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    rows = keyed.select("vec_id", "key")
    classes = rows.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("least")
    )
    classes = classes.join(links, "key", "left").join(roots, "key", "left").select(
        "key", "least", F.coalesce("root", "key").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    classes = stage.table(classes, "classes")
    names = classes.groupBy("root").agg(F.min("least").alias("name"))
    named = classes.join(names, "root").select("key", "n_links", "name")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("name"))
    return rows.join(named, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
