"""Embedding near-dedup: exact threshold pairs by a dual traversal of cover trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.components import components
from tripmill.llm.shared import settle

THRESHOLD = 0.9
#: Different vectors in one tree, about.
TREE_SIZE = 4096
LEAF = 24
#: Pivots that put alike vectors into the same tree, drawn from the table.
PIVOTS = 256
_STEP, _BLOCK = 1024, 256
#: Leaves are no wider than this, about the distance of a cosine of 0.9.
_FINE = 0.45


@dataclass
class Tree:
    """Nested levels of nodes. Node k owns ``points[start[k]:end[k]]`` and has a center among them.

    ``radius`` is the covering radius: no point of the node is farther from its center.
    A node's children are the nodes ``first[k]`` up to ``last[k]``; a leaf has none.
    """

    points: np.ndarray
    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray
    center: np.ndarray
    radius: np.ndarray


def _radius(points: np.ndarray, center: np.ndarray) -> float:
    """The farthest point's distance from the center, with room for rounding."""
    cosines = points @ center
    if not np.isfinite(cosines).all():
        raise ValueError("a point is not a unit vector")
    return float(np.sqrt(max(0.0, 2 - 2 * cosines.min(initial=1.0)))) + 1e-7


def _net(points: np.ndarray, reach: float) -> list[np.ndarray] | None:
    """Parts of the points: the first that no center reaches becomes one, and takes what it reaches.

    Each part begins with its center. Candidates meet all open points in one matrix product.
    None if the reach is wide and the first candidates group little: such a level prunes little.
    """
    least = 1 - reach**2 / 2 - 1e-12
    open_ = np.ones(len(points), dtype=bool)
    parts: list[np.ndarray] = []
    while open_.any():
        rest = np.nonzero(open_)[0]
        some = rest[:_BLOCK]
        near = points[some] @ points[rest].T >= least
        for row, candidate in zip(near, some.tolist()):
            if open_[candidate]:
                part = rest[row & open_[rest]]
                part = np.concatenate([[candidate], part[part != candidate]])
                parts.append(part)
                open_[part] = False
        if reach > _FINE and len(rest) == len(points) and len(parts) * 4 > len(points) - open_.sum():
            return None
    return parts


def build(points: np.ndarray) -> Tree:
    """A cover tree of unit vectors: each level's centers are nets of half the radius within their parent."""
    order = np.arange(len(points))
    start, end, first, last, center, radius, scale = [0], [len(points)], [0], [0], [0], [0.0], [2.0]
    node = 0
    while node < len(start):
        low, high = start[node], end[node]
        own = points[order[low:high]]
        radius[node] = _radius(own, points[center[node]])
        if high - low > (LEAF if radius[node] <= _FINE else 1) and radius[node] > 1e-5:
            reach = scale[node]
            while reach >= radius[node]:
                reach /= 2
            parts = _net(own, reach)
            while parts is None:
                reach /= 2
                parts = _net(own, reach)
            order[low:high] = order[low:high][np.concatenate(parts)]
            first[node] = len(start)
            at = low
            for part in parts:
                start.append(at)
                center.append(int(order[at]))
                at += len(part)
                end.append(at)
                first.append(0), last.append(0), radius.append(0.0), scale.append(reach)
            last[node] = len(start)
        node += 1
    arrays = (np.array(x) for x in (start, end, first, last))
    return Tree(points, order, *arrays, np.array(center), np.array(radius))


def _least(bound: np.ndarray) -> np.ndarray:
    """The least cosine of centers within a distance, with room for rounding."""
    return (1 - np.minimum(bound, 2.0) ** 2 / 2 - 1e-5).astype(np.float32)


def dual_pairs(a: Tree, b: Tree, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs of points with a cosine of ``threshold`` or more; both orders if ``a`` is ``b``.

    Two nodes are pruned when their centers are farther apart than the threshold's distance
    and both covering radii together. Surviving pairs of inner nodes meet child by child,
    in blocks of matrix products; the points of leaves are compared by their cosine itself.
    """
    limit = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-7
    stack = [(0, 0)]
    leaves: list[tuple[int, int]] = []
    while stack:
        x, y = stack.pop()
        if a.first[x] == a.last[x] and b.first[y] == b.last[y]:
            leaves.append((x, y))
            continue
        xs = np.arange(a.first[x], a.last[x]) if a.last[x] > a.first[x] else np.array([x])
        ys = np.arange(b.first[y], b.last[y]) if b.last[y] > b.first[y] else np.array([y])
        centers = b.points[b.center[ys]].astype(np.float32)
        for low in range(0, len(xs), _STEP):
            some = xs[low : low + _STEP]
            cosines = a.points[a.center[some]].astype(np.float32) @ centers.T
            # A cosine below that of the block's widest bound is pruned without a bound of its own.
            rows, columns = np.nonzero(cosines >= _least(limit + a.radius[some].max() + b.radius[ys].max()))
            own = _least(limit + a.radius[some][rows] + b.radius[ys][columns])
            near = cosines[rows, columns] >= own
            rows, columns = rows[near], columns[near]
            for i, j in zip(some[rows].tolist(), ys[columns].tolist()):
                done = a.first[i] == a.last[i] and b.first[j] == b.last[j]
                (leaves if done else stack).append((i, j))
    for x, y in leaves:
        rows, columns = a.order[a.start[x] : a.end[x]], b.order[b.start[y] : b.end[y]]
        for low in range(0, len(rows), _STEP):
            i, j = np.nonzero(a.points[rows[low : low + _STEP]] @ b.points[columns].T >= threshold)
            if len(i):
                yield rows[low + i], columns[j]


def _unit(values: pa.ListArray) -> np.ndarray:
    found = np.array(values.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(values), -1)
    return unit(found)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Each row divided by its length; the largest component becomes 1 first, so that no square is lost or infinite."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _placed(classes: DataFrame) -> DataFrame:
    """Adds ``place``, an order in which vectors near one pivot are neighbours, and ``size``."""
    sample = classes.orderBy(F.xxhash64("vector"), "class").limit(PIVOTS).select("vector").toArrow()
    by_size: dict[int, list] = {}
    for vector in sample.column("vector").to_pylist():
        by_size.setdefault(len(vector), []).append(vector)
    pivots = {size: unit(np.array(v, dtype=np.float64)) for size, v in by_size.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            near = np.zeros(batch.num_rows, dtype=np.int64)
            sizes = np.array([len(v) for v in vectors])
            for size in np.unique(sizes):
                rows = np.nonzero(sizes == size)[0]
                if size in pivots:
                    near[rows] = (_unit(vectors.take(pa.array(rows))) @ pivots[size].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], names=["class", "vector", "n", "near"])

    schema = "class long, vector array<double>, n long, near long"
    placed = classes.mapInArrow(run, schema)
    # Pivot cells are joined or cut by hash, so that no tree grows with a cell.
    spread = F.pmod(F.xxhash64("class"), F.lit(1 << 20)) / float(1 << 20)
    place = (F.col("near") + spread) / float(PIVOTS)
    return placed.withColumn("place", place).withColumn("size", F.size("vector")).drop("near")


def _numbered(placed: DataFrame, n_trees: int) -> DataFrame:
    """Adds ``tree``: the order is cut into that many parts of about one size, whatever the cells' sizes."""
    cuts = placed.stat.approxQuantile("place", [k / n_trees for k in range(1, n_trees)], 0.001) if n_trees > 1 else []
    number = F.lit(0)
    for cut in sorted(set(cuts)):
        number = number + (F.col("place") > cut).cast("int")
    return placed.withColumn("tree", number)


def linked(classes: DataFrame, threshold: float, tree_size: int = TREE_SIZE) -> DataFrame:
    """For each of the different vectors (``class``, ``vector``, ``n`` copies), a row per tree pair in which it has links.

    ``class``, ``n_links`` (vectors linked, copies counted) and ``root``, the smallest class
    that it reaches within that pair of trees. Every two trees meet in one task, a tree with
    itself too, so all pairs are found and none is written out.
    """
    total = classes.agg(F.count("*")).first()[0]
    n_trees = max(1, -(-total // tree_size))
    numbered = _numbered(_placed(classes), n_trees)
    sides = F.transform(
        F.sequence(F.lit(0), F.lit(n_trees - 1)),
        lambda other: F.struct(F.least("tree", other).alias("a"), F.greatest("tree", other).alias("b")),
    )
    meeting = numbered.select("class", "vector", "n", "size", "tree", F.explode_outer(sides).alias("pair")).select(
        "class", "vector", "n", "size", "tree", "pair.a", "pair.b"
    )

    def meet(group: pa.Table) -> pa.Table:
        tree = group.column("tree").to_numpy()
        names, copies = group.column("class").to_numpy(), group.column("n").to_numpy()
        sizes = group.column("size").to_numpy()
        vectors = group.column("vector").combine_chunks()
        parent = np.arange(len(names))
        links = np.zeros(len(names), dtype=np.int64)
        same = tree.min() == tree.max() and group.column("a")[0] == group.column("b")[0]
        if not same and tree.min() == tree.max():
            return pa.table({"class": names[:0], "n_links": links[:0], "root": names[:0]})
        for size in np.unique(sizes):
            rows = [np.nonzero((sizes == size) & (tree == t))[0] for t in np.unique(tree)]
            if not all(len(r) for r in rows) or (len(rows) == 1 and not same):
                continue
            rows = [r[np.argsort(names[r])] for r in rows]
            trees = [build(_unit(vectors.take(pa.array(r)))) for r in rows]
            left, right = rows[0], rows[-1]
            for i, j in dual_pairs(trees[0], trees[-1], threshold):
                x, y = left[i], right[j]
                np.add.at(links, x, copies[y])
                if not same:
                    np.add.at(links, y, copies[x])
                _unite(parent, x, y, names)
        if same:  # a vector met itself, and its copies with it
            links -= 1
        root = parent
        while (root != root[root]).any():
            root = root[root]
        some = (links > 0) | (root != np.arange(len(names)))
        return pa.table({"class": names[some], "n_links": links[some], "root": names[root[some]]})

    return meeting.groupBy("a", "b").applyInArrow(meet, "class long, n_links long, root long")


def _unite(parent: np.ndarray, x: np.ndarray, y: np.ndarray, names: np.ndarray) -> None:
    """Join the sets of each pair; the smaller name becomes the parent."""
    while True:
        while (parent != parent[parent]).any():
            parent[:] = parent[parent]
        a, b = parent[x], parent[y]
        open_ = a != b
        if not open_.any():
            return
        a, b = a[open_], b[open_]
        low, high = np.where(names[a] < names[b], a, b), np.where(names[a] < names[b], b, a)
        parent[high] = low


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD, tree_size: int = TREE_SIZE
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept``, one row per row of ``vectors``.

    Vectors link at a cosine of ``threshold`` or more, in double precision; those of
    different lengths never do. Vectors that are null, empty, zero, or hold null, NaN or infinite
    components link with nothing. Equal vectors are compared as one and counted as many.
    ``component_id`` is the smallest key reachable; repeated keys count as rows, a null key
    names nothing and isn't kept. An empty table gives an empty result; further columns
    are ignored.
    """
    rows = vectors.select(vectors[key].cast("long").alias("key"), vectors[vector].cast("array<double>").alias("vector"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    sound = F.coalesce(~F.exists("vector", bad) & F.exists("vector", lambda x: x != 0.0), F.lit(False))
    # The key that copies are grouped by, without the sign of a zero.
    plain = F.transform("vector", lambda x: x + 0.0)
    rows = settle(rows.select("key", F.when(sound, plain).alias("vector")), "vectors")
    classes = settle(
        rows.where("vector is not null")
        .groupBy("vector")
        .agg(F.min(F.coalesce("key", F.lit((1 << 63) - 1))).alias("least"), F.count("*").alias("n"))
        .withColumn("class", F.xxhash64("vector"))
        .select("class", "vector", "n", "least"),
        "classes",
    )
    found = settle(linked(classes.select("class", "vector", "n"), threshold, tree_size), "linked")
    counts = found.groupBy("class").agg(F.sum("n_links").alias("n_links"))
    stars = settle(components(found.select(F.col("class").alias("a"), F.col("root").alias("b"))), "stars")
    named = classes.select("class", "least", "n").join(stars, F.col("class") == F.col("node"), "left").select(
        "class", "least", F.coalesce("root", "class").alias("root"), "n"
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    lookup = named.join(least, "root").join(counts, "class", "left").select(
        "class", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    lookup = settle(lookup, "names")
    marked = rows.select("key", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")).alias("mark"))
    joined = marked.join(lookup, F.col("mark") == F.col("class"), "left")
    component = F.coalesce(F.nullif("component_id", F.lit((1 << 63) - 1)), F.col("key"))
    return joined.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"),
    )
