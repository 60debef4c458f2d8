"""All pairs of vectors above a cosine threshold, by dual traversal of cover trees."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storesales.llm.common import cut, small_enough
from storesales.llm.components import components, roots_of

# Vectors of one subtree, which is what a task holds twice; fewer if the table makes less than PARTS of that size.
CHUNK = 24_576
LEAST_CHUNK = 8_192
PARTS = 16

# Cells of the top level; their centres are broadcast.
MOST_CELLS = 1_024

# Nearest centres by which full cells are divided, and parts that the last of these is cut into.
DEPTH = 4
MOST_PARTS = 1 << 18

# Sizes of parts up to which they are broadcast.
BROADCAST_ROWS = 2_000_000

# Vectors among which the first net of a subtree is laid, about.
STRIP = 512

# Coordinates by which most pairs are ruled out, and the nodes of either side whose bounds are taken at once.
LEADING = 24
ROWS, COLUMNS = 256, 1024

# Pairs of points that are compared at once rather than by going down further.
AT_ONCE = 1 << 21

# Pairs of nodes with no more pairs of points than this are compared in bulk.
FEW = 64

# Below this radius a node is not divided any more.
SMALLEST = 1e-3

# Option: bytes that a Python task gets at a time. A pair of trees is much already, and Spark's own 64 MB are held
# several times over outside the heap. What the user sets stays.
BATCH_BYTES_OPTION, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20

# Bounds are taken this much wider than rounding errors, so that only exact comparisons decide at the edge. Distances
# of nearly equal vectors come from dot products near 1 and are off by up to some 1e-7.
SLACK = 1e-6

# The same for bounds in single precision: sums of at most 28 products, whose sizes add up to some 20.
SINGLE_SLACK = 1e-4


@dataclass
class CoverTree:
    """Nodes of nested levels with halving radii over unit vectors.

    A node's points lie side by side in ``points``; its children follow each
    other in the node arrays. ``radius`` is the largest distance of any of its
    points from its centre, which is itself a point. The root's children reach
    no further than ``r``; they are nets of neighbourhoods of some ``STRIP``
    points and lie in this order.
    """

    points: np.ndarray
    weights: np.ndarray
    keys: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray
    child: np.ndarray
    children: np.ndarray

    @staticmethod
    def build(points: np.ndarray, weights: np.ndarray, keys: np.ndarray, r: float = 1.0) -> CoverTree:
        place = np.arange(len(points))
        nodes = [[0, 2.0 if len(points) > 1 else 0.0, 0, len(points), 0, 0]]
        radii = [r]
        at = 0
        while at < len(nodes):
            _, radius, first, last, *_ = nodes[at]
            r = radii[at]
            groups = None
            while radius > SMALLEST and r > SMALLEST / 2 and last - first > 1:
                groups = _net(points[place[first:last]], r) if at else _nets(points, r)
                r /= 2
                if len(groups) > 1 or at == 0:
                    break
                groups = None
            if groups:
                nodes[at][4:] = [len(nodes), len(groups)]
                here = place[first:last].copy()
                start = first
                for members, reach in groups:
                    place[start : start + len(members)] = here[members]
                    nodes.append([start, reach, start, start + len(members), 0, 0])
                    radii.append(r)
                    start += len(members)
            at += 1
        table = np.array(nodes, float)
        # Dividing a node may move its centre among its points; it stays the first of its first child.
        whole = table[:, [0, 2, 3, 4, 5]].astype(np.int64)
        return CoverTree(
            points[place], weights[place], keys[place], whole[:, 1], table[:, 1], whole[:, 1], whole[:, 2], whole[:, 3], whole[:, 4]
        )


def _nets(points: np.ndarray, r: float) -> list[tuple[np.ndarray, float]]:
    """``_net`` of each neighbourhood of evenly taken points, so that time doesn't grow with the square of all."""
    if len(points) <= 2 * STRIP:
        return _net(points, r)
    middles = points[::STRIP]
    owner = np.concatenate([np.argmax(points[at : at + COLUMNS] @ middles.T, axis=1) for at in range(0, len(points), COLUMNS)])
    groups = []
    for some in np.split(np.argsort(owner, kind="stable"), np.cumsum(np.bincount(owner, minlength=len(middles)))[:-1]):
        groups.extend((some[members], reach) for members, reach in _net(points[some], r))
    return groups


def _net(points: np.ndarray, r: float) -> list[tuple[np.ndarray, float]]:
    """Groups around points more than ``r`` apart, each with its centre first, and how far each reaches."""
    left = np.arange(len(points))
    groups = []
    while len(left):
        some = left[: max(16, min(256, AT_ONCE // len(left)))]
        near = _distances(points[some], points[left])
        close = near <= r
        alone = close.sum(axis=1) <= 1
        found = {i: (left[i : i + 1], 0.0) for i in np.flatnonzero(alone).tolist()}
        own = close[:, : len(some)]
        centres = []
        for i in np.flatnonzero(~alone).tolist():
            if not own[centres, i].any():
                centres.append(i)
        taken = np.zeros(len(left), bool)
        if centres:
            inside = close[centres]
            taken = inside.any(axis=0)
            owner = inside.argmax(axis=0)
            for c, i in enumerate(centres):
                members = np.flatnonzero(taken & (owner == c))
                members = np.concatenate([[i], members[members != i]])
                found[i] = left[members], float(near[i, members].max())
        # The first point stays the first.
        groups.extend(found[i] for i in sorted(found))
        taken[: len(some)] |= alone
        left = left[~taken]
    return groups


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class Traversal:
    """Links between two trees, or within one: how many of each point, and edges that connect what they connect.

    ``axes`` are orthonormal columns, best those along which the points differ
    most; by default the first coordinates are taken.
    """

    def __init__(self, a: CoverTree, b: CoverTree | None, threshold: float, axes: np.ndarray | None = None):
        self.a, self.b, self.within = a, a if b is None else b, b is None
        self.threshold, self.reach = threshold, math.sqrt(max(0.0, 2 - 2 * threshold))
        self.axes = np.eye(a.points.shape[1])[:, :LEADING] if axes is None else axes
        self.counts_a = np.zeros(len(a.points))
        self.counts_b = self.counts_a if self.within else np.zeros(len(self.b.points))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0
        for top in self._top():
            self._descend(*top)

    def _descend(self, *top: int) -> None:
        pairs = [top]
        while pairs:
            i, j = pairs.pop()
            a, b = self.a, self.b
            same = self.within and i == j
            d = 0.0 if same else float(_distances(a.points[a.centre[i], None], b.points[b.centre[j], None])[0, 0])
            spread = a.radius[i] + b.radius[j]
            if d > spread + self.reach + SLACK:
                continue
            sizes = (a.last[i] - a.first[i]) * (b.last[j] - b.first[j])
            if d + spread <= self.reach - SLACK:
                self._all_link(i, j, same)
            # Pairs of many children with few points each would cost more than their points.
            elif sizes <= AT_ONCE or not (a.children[i] or b.children[j]) or same and a.children[i] * FEW > a.last[i] - a.first[i]:
                self._compare(a.first[i], a.last[i], b.first[j], b.last[j], same)
            elif same:
                own = range(a.child[i], a.child[i] + a.children[i])
                pairs.extend((x, y) for x in own for y in own if x <= y)
            elif b.children[j] == 0 or a.children[i] and a.radius[i] >= b.radius[j]:
                pairs.extend((x, j) for x in range(a.child[i], a.child[i] + a.children[i]))
            else:
                pairs.extend((i, y) for y in range(b.child[j], b.child[j] + b.children[j]))

    def _top(self) -> Iterator[tuple[int, int]]:
        """Pairs of children of the roots whose bounds do not rule out a link.

        Runs of children are passed over if balls around them are too far apart.
        For the others, two nodes p and q can link if |p - q| <= R + r, where r
        is q's radius and R p's and the threshold distance, that is
        pq + Rr + (R^2 + r^2) / 2 - 1 >= 0. The product pq is at most that of the
        leading coordinates and that of the lengths of what they leave.
        """
        a, b = self.a, self.b
        rows, low_a, wide_a = self._units(a)
        columns, low_b, wide_b = (rows, low_a, wide_a) if self.within else self._units(b)
        middles_a, balls_a = _balls(low_a, wide_a, ROWS)
        middles_b, balls_b = _balls(low_b, wide_b, COLUMNS)
        far = wide_a + self.reach
        left = np.column_stack([low_a, far, far**2 / 2 - 1, np.ones(len(rows))]).astype(np.float32)
        right = np.column_stack([low_b, wide_b, np.ones(len(columns)), wide_b**2 / 2]).astype(np.float32)
        single = a.last[rows] - a.first[rows] == 1
        space = np.empty(ROWS * COLUMNS, np.float32)
        for block, i0 in enumerate(range(0, len(rows), ROWS)):
            i1 = min(len(rows), i0 + ROWS)
            apart = np.linalg.norm(middles_b - middles_a[block], axis=1)
            few: list[tuple[np.ndarray, np.ndarray]] = []
            for j0 in (np.flatnonzero(apart <= balls_a[block] + balls_b + self.reach + SLACK) * COLUMNS).tolist():
                j1 = min(len(columns), j0 + COLUMNS)
                if self.within and j1 <= i0:
                    continue
                bounds = np.matmul(left[i0:i1], right[j0:j1].T, out=space[: (i1 - i0) * (j1 - j0)].reshape(i1 - i0, -1))
                if bounds.max() < -SINGLE_SLACK:
                    continue
                x, y = np.nonzero(bounds >= -SINGLE_SLACK)
                points = a.first[rows[i0]], a.last[rows[i1 - 1]], b.first[columns[j0]], b.last[columns[j1 - 1]]
                sizes = (points[1] - points[0]) * (points[3] - points[2])
                if bounds.size >> 4 < len(x) >= sizes / FEW and not (self.within and j0 < i1):
                    self._compare(*points, False)
                    continue
                if self.within:
                    once = (x + i0 < y + j0) | (x + i0 == y + j0) & ~single[x + i0]
                    x, y = x[once], y[once]
                i, j = rows[x + i0], columns[y + j0]
                small = (a.last[i] - a.first[i]) * (b.last[j] - b.first[j]) <= FEW
                if self.within:
                    small &= i != j
                few.append((i[small], j[small]))
                yield from zip(i[~small].tolist(), j[~small].tolist(), strict=True)
            if few:
                self._compare_few(*(np.concatenate(side) for side in zip(*few, strict=True)))

    def _units(self, tree: CoverTree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The root's children (or the root, if it has none), leading coordinates of their centres with the length of the rest, and radii."""
        nodes = np.arange(tree.child[0], tree.child[0] + tree.children[0]) if tree.children[0] else np.array([0])
        low = tree.points[tree.centre[nodes]] @ self.axes
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", low, low)))
        return nodes, np.column_stack([low, rest]), tree.radius[nodes]

    def _compare_few(self, i: np.ndarray, j: np.ndarray) -> None:
        """Compare the points of many pairs of small, different nodes at once."""
        a, b = self.a, self.b
        for at in range(0, len(i), 1 << 14):
            left, right = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            wide = b.last[right] - b.first[right]
            sizes = (a.last[left] - a.first[left]) * wide
            place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            x = np.repeat(a.first[left], sizes) + place // np.repeat(wide, sizes)
            y = np.repeat(b.first[right], sizes) + place % np.repeat(wide, sizes)
            for part in range(0, len(x), 1 << 16):
                p, q = x[part : part + (1 << 16)], y[part : part + (1 << 16)]
                hit = np.einsum("ij,ij->i", a.points[p], b.points[q]) >= self.threshold
                p, q = p[hit], q[hit]
                np.add.at(self.counts_a, p, b.weights[q])
                np.add.at(self.counts_b, q, a.weights[p])
                self._edges(p, q)

    def _all_link(self, i: int, j: int, same: bool) -> None:
        a, b = slice(self.a.first[i], self.a.last[i]), slice(self.b.first[j], self.b.last[j])
        if same:
            self.counts_a[a] += self.a.weights[a].sum() - self.a.weights[a]
            self._edges(np.arange(a.start, a.stop), np.full(a.stop - a.start, a.start))
            return
        self.counts_a[a] += self.b.weights[b].sum()
        self.counts_b[b] += self.a.weights[a].sum()
        self._edges(np.arange(a.start, a.stop), np.full(a.stop - a.start, b.start))
        self._edges(np.full(b.stop - b.start, a.start), np.arange(b.start, b.stop))

    def _compare(self, a0: int, a1: int, b0: int, b1: int, same: bool) -> None:
        step = max(1, AT_ONCE // (b1 - b0))
        for at in range(a0, a1, step):
            end = min(a1, at + step)
            links = self.a.points[at:end] @ self.b.points[b0:b1].T >= self.threshold
            if same:
                links[np.arange(end - at), np.arange(at - b0, end - b0)] = False
            if not links.any():
                continue
            self.counts_a[at:end] += links @ self.b.weights[b0:b1]
            if not same:
                self.counts_b[b0:b1] += self.a.weights[at:end] @ links
            x, y = np.flatnonzero(links.any(axis=1)), np.flatnonzero(links.any(axis=0))
            links = links[np.ix_(x, y)]
            rows, columns = np.arange(len(x)), np.full(len(y), len(x))
            while True:  # every row takes the smallest row that it reaches over columns
                columns = np.minimum(columns, np.where(links, rows[:, None], len(x)).min(axis=0))
                lower = np.minimum(rows, np.where(links, columns, len(x)).min(axis=1))
                if np.array_equal(lower, rows):
                    break
                rows = lower
            # Edges within a component, each row and column to its smallest row.
            self._edges(x[columns] + at, y + b0)
            self._pairs(self.a.keys[x + at], self.a.keys[x[rows] + at])

    def _edges(self, x: np.ndarray, y: np.ndarray) -> None:
        self._pairs(self.a.keys[x], self.b.keys[y])

    def _pairs(self, x: np.ndarray, y: np.ndarray) -> None:
        if len(x):
            self.edges.append((x, y))
            self.held += len(x)
            if self.held > 16 * CHUNK:
                self.edges, self.held = [self.forest()], 0

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.edges:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        vertices, roots = roots_of(*(np.concatenate(side) for side in zip(*self.edges, strict=True)))
        return vertices[vertices != roots], roots[vertices != roots]


def _balls(points: np.ndarray, radii: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Centres and radii of balls around runs of ``size`` points with these radii."""
    runs = [slice(at, at + size) for at in range(0, len(points), size)]
    middles = np.array([points[run].mean(axis=0) for run in runs])
    return middles, np.array([(np.linalg.norm(points[run] - middle, axis=1) + radii[run]).max() for run, middle in zip(runs, middles, strict=True)])


def _given(column: pa.Array, kind: str) -> np.ndarray:
    """A row for each list; all are of one length."""
    return np.array(column.flatten().to_numpy(zero_copy_only=False), kind).reshape(len(column), -1)


def _unit(packed: list | np.ndarray) -> np.ndarray:
    points = np.array(packed, np.float64)
    largest = np.abs(points).max(axis=1, keepdims=True)
    # Squares of such components are no doubles any more.
    odd = np.flatnonzero((largest > 1e150) | (largest < 1e-150))
    points[odd] /= largest[odd]
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    return points


def _sample(vectors: DataFrame, cells: int) -> np.ndarray:
    """Eight vectors for each cell, those of the smallest hashes."""
    sample = vectors.orderBy(F.xxhash64("key"), "key").limit(8 * cells).select("v").collect()
    return _unit([row["v"] for row in sample])


def _centres(points: np.ndarray, cells: int) -> np.ndarray:
    """Centres of the top level: spread over the sample, and numbered so that those next to each other are near."""
    chosen = [0]
    far = _distances(points[:1], points)[0]
    while len(chosen) < min(cells, len(points)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(points[chosen[-1:]], points)[0])
    return points[_side_by_side(points, np.array(chosen))]


def _side_by_side(points: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Halves of halves, each along the coordinate in which they differ most."""
    if len(some) < 3:
        return some
    some = some[np.argsort(points[some, points[some].var(axis=0).argmax()], kind="stable")]
    return np.concatenate([_side_by_side(points, half) for half in np.array_split(some, 2)])


def _axes(points: np.ndarray) -> np.ndarray:
    """Orthonormal axes along which the sample spreads most."""
    _, axes = np.linalg.eigh(np.cov(points.T, bias=True).reshape(points.shape[1], -1))
    return np.ascontiguousarray(axes[:, ::-1][:, :LEADING])


def embedding_links(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: links of cosine >= ``threshold`` in double precision, a row per row.

    Equal vectors are folded first, so a vector of a third of all rows is
    compared once, with its number as weight. The others are dealt to cells of
    the nearest of a few broadcast centres, the top level, those of cells with
    more than ``CHUNK`` vectors also to the next nearest ones, and what is still
    larger to equal parts. A task builds the cover tree of each part: nested
    levels with halving radii. Pairs of cells, then of parts, then pairs of nodes
    on the way down, are pruned when their centres are further apart than both
    radii and the threshold distance; when even the furthest points are near
    enough, all pairs link and are counted without being looked at. Pairs of the
    uppermost nodes are first ruled out by a few leading coordinates of theirs
    and the length of the others, in single precision. Links are exact: nothing
    is approximated and no number of partners is capped.

    Tasks hand on how many links each vector has and a spanning forest of them,
    never the pairs. Data that no bound can prune, such as independent random
    directions in many dimensions, costs the square of the number of vectors in
    arithmetic, some 0.8 ns for a pair; tasks then read the trees of all pairs
    of parts where they were written, and nothing is shuffled for it.

    NULL, empty and zero vectors and those with a NULL, NaN or infinite
    component link with nothing, and so do vectors with a NULL id; vectors of
    different lengths never link. Repeated rows are vectors that link to each
    other. An empty table gives an empty result. Other columns are not read.
    """
    # Vectors are met by a hash and then themselves, which sorts by one number.
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"), F.xxhash64(F.col(vector_col)).alias("hash"))
    wrong = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    usable = (
        F.col("vec_id").isNotNull()
        & F.coalesce(~F.exists("v", wrong), F.lit(False))
        & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False))
    )
    folded = (
        rows.where(usable)
        .groupBy("hash", "v")
        .agg(F.min("vec_id").alias("least_id"), F.count("*").alias("weight"))
        .withColumn("key", F.monotonically_increasing_id())
    )
    folded = cut(folded, "embedding-distinct")
    links, edges = _links(folded, threshold)
    roots = components(edges)
    labelled = (
        folded.join(links, "key", "left")
        .join(roots.withColumnRenamed("vertex", "key"), "key", "left")
        .select(
            "hash",
            "v",
            "least_id",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
            F.coalesce("root", "key").alias("root"),
        )
    )
    smallest = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    known = labelled.join(smallest, "root").select("hash", "v", "n_links", "component_id")
    single = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (
        rows.where(usable)
        .join(known, ["hash", "v"], "left")
        .select("vec_id", "n_links", "component_id")
        .unionByName(single)
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def _links(vectors: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links of each ``key`` (``key, n``) and edges that connect the same components (``a, b``)."""
    spark = vectors.sparkSession
    total = vectors.count()
    if not total:
        return spark.createDataFrame([], "key long, n long"), spark.createDataFrame([], "a long, b long")
    lengths = [row["size"] for row in vectors.select(F.size("v").alias("size")).distinct().orderBy("size").collect()]
    found = [_links_of(spark, vectors.where(F.size("v") == n), threshold) for n in lengths]
    both = found[0]
    for other in found[1:]:
        both = both.unionByName(other)
    return (
        both.where("b IS NULL").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n")),
        both.where("b IS NOT NULL").select("a", "b"),
    )


def _links_of(spark: SparkSession, vectors: DataFrame, threshold: float) -> DataFrame:
    """``a, b, n`` of vectors of one length: links of a vector (b NULL) and edges."""
    total = vectors.count()
    chunk = min(CHUNK, max(LEAST_CHUNK, math.ceil(total / PARTS)))
    wanted = min(MOST_CELLS, math.ceil(total / (chunk // 2)))
    sample = _sample(vectors, wanted)
    centres, axes = _centres(sample, wanted), _axes(sample)
    shared = spark.sparkContext.broadcast(centres)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    kind = vectors.schema["v"].dataType.elementType.simpleString()
    scalar = "f4" if kind == "float" else "f8"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                some = batch.slice(at, 2048)
                near = _distances(_unit(_given(some.column("v"), scalar)), shared.value)
                depth = min(DEPTH, near.shape[1])
                path = np.argpartition(near, depth - 1, axis=1)[:, :depth]
                path = np.take_along_axis(path, np.argsort(np.take_along_axis(near, path, axis=1), axis=1), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(path[:, 0]), pa.array(path.tolist(), pa.list_(pa.int64())), pa.array(near.min(axis=1))],
                    ["key", "weight", "v", "cell", "path", "far"],
                )

    celled = cut(
        vectors.select("key", "weight", "v").mapInArrow(
            assign, f"key long, weight long, v array<{kind}>, cell long, path array<long>, far double"
        ),
        "embedding-cells",
    )
    # At most MOST_CELLS rows.
    cells = {r["cell"]: (r["n"], r["far"]) for r in celled.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    parted = _parted(celled, any(n > chunk for n, _ in cells.values()), chunk).drop("path", "far")

    def grow(table: pa.Table) -> pa.Table:
        given = _given(table.column("v").combine_chunks(), scalar)
        keys = table.column("key").to_numpy()
        points = _unit(given)
        middle = points.mean(axis=0)
        radius = float(np.linalg.norm(points - middle, axis=1).max())
        # Nodes with points far from each other would rule out little.
        tree = CoverTree.build(points, table.column("weight").to_numpy().astype(float), keys, min(1.0, max(SMALLEST, reach / 2)))
        by_key = np.argsort(keys)
        # The vectors move as they were given; unit length in double precision comes back from them.
        tree.points = given[by_key[np.searchsorted(keys[by_key], tree.keys)]]
        return pa.table(
            {
                "cell": table.column("cell")[:1],
                "part": table.column("part")[:1],
                "middle": pa.array([middle.tolist()], pa.list_(pa.float64())),
                "radius": pa.array([radius]),
                "tree": pa.array([_packed(tree)], pa.binary()),
            }
        )

    trees = cut(parted.groupBy("cell", "part").applyInArrow(grow, "cell long, part long, middle array<double>, radius double, tree binary"), "embedding-trees")
    near = _distances(centres, centres)
    pairs = [
        (a, b)
        for a in cells
        for b in cells
        if a <= b and near[a, b] <= cells[a][1] + cells[b][1] + reach + SLACK
    ]
    cell_pairs = spark.createDataFrame(pairs, "ca long, cb long")
    met = _part_pairs(trees, cell_pairs, reach + SLACK).select(((F.col("ca") == F.col("cb")) & (F.col("pa") == F.col("pb"))).alias("within"), "ta", "tb")

    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a = _unpacked(batch.column("ta")[i].as_py())
                b = None if batch.column("within")[i].as_py() else _unpacked(batch.column("tb")[i].as_py())
                done = Traversal(a, b, threshold, axes)
                for tree, counts in [(a, done.counts_a)] + ([] if b is None else [(b, done.counts_b)]):
                    some = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(tree.keys[some]), pa.nulls(len(some), pa.int64()), pa.array(counts[some].astype(np.int64))],
                        ["a", "b", "n"],
                    )
                x, y = done.forest()
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.nulls(len(x), pa.int64())], ["a", "b", "n"])

    with _small_batches(spark):
        return cut(met.mapInArrow(traverse, "a long, b long, n long"), "embedding-links")


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    own = spark.conf.get(BATCH_BYTES_OPTION, None) is None
    if own:
        spark.conf.set(BATCH_BYTES_OPTION, str(BATCH_BYTES))
    try:
        yield
    finally:
        if own:
            spark.conf.unset(BATCH_BYTES_OPTION)


def _parted(celled: DataFrame, full: bool, chunk: int) -> DataFrame:
    """``celled`` with the number of the ``part`` of its cell that each vector lies in, of about ``chunk`` vectors at most.

    What is too large is divided by the next nearest centre, again and again:
    vectors that see the centres in the same order are near each other. Centres
    with few vectors each share a part with those numbered next to them, so that
    parts do not become many and small. What is still too large at the last
    centre is divided evenly.
    """
    rows = celled.withColumn("part", F.lit(1).cast("long"))
    if not full:
        return rows
    for depth in range(1, DEPTH):
        next_one = F.get("path", F.lit(depth))
        sizes = cut(rows.groupBy("cell", "part", next_one.alias("next")).agg(F.count("*").alias("n")), "embedding-sizes")
        siblings = Window.partitionBy("cell", "part")
        before = F.coalesce(F.sum("n").over(siblings.orderBy("next").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        run = F.greatest(F.lit(chunk / 2), F.col("all") / MOST_CELLS)
        deeper = F.col("part") * (2 * MOST_CELLS) + F.floor(before / run) + 1
        runs = sizes.withColumn("all", F.sum("n").over(siblings)).where((F.col("all") > chunk) & F.col("next").isNotNull())
        runs = cut(runs.select("cell", "part", "next", deeper.alias("deeper")), "embedding-runs")
        rows = rows.withColumn("next", next_one).join(small_enough(runs, BROADCAST_ROWS), ["cell", "part", "next"], "left")
        rows = rows.withColumn("part", F.coalesce("deeper", "part")).drop("next", "deeper")
    sizes = cut(rows.groupBy("cell", "part").agg(F.count("*").alias("size")).where(F.col("size") > chunk), "embedding-full")
    rows = rows.join(small_enough(sizes, BROADCAST_ROWS), ["cell", "part"], "left")
    return rows.withColumn("part", F.col("part") * MOST_PARTS + F.pmod(F.xxhash64("key"), F.ceil(F.coalesce("size", F.lit(1)) / chunk)))


def _part_pairs(trees: DataFrame, cell_pairs: DataFrame, reach: float) -> DataFrame:
    """``ca, pa, ta, cb, pb, tb``: the parts of near cells whose balls are not too far apart to hold a link, and their trees.

    Each task reads the trees of two files as they were written: nothing is shuffled, so moved data do not grow with the
    square of the vectors.
    """

    def side(mark: str) -> DataFrame:
        short = {"cell": "c", "part": "p", "middle": "m", "radius": "r", "tree": "t"}
        return trees.select(*(F.col(c).alias(f"{s}{mark}") for c, s in short.items()))

    apart = F.sqrt(F.aggregate(F.zip_with("ma", "mb", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, x: total + x))
    met = side("a").crossJoin(side("b")).where("ca < cb OR ca = cb AND pa <= pb").where(apart <= F.col("ra") + F.col("rb") + reach)
    return met.join(F.broadcast(cell_pairs), ["ca", "cb"], "left_semi").select("ca", "pa", "ta", "cb", "pb", "tb")


def _packed(tree: CoverTree) -> bytes:
    """The tree's arrays."""
    return pickle.dumps(tuple(getattr(tree, f) for f in tree.__dataclass_fields__), protocol=5)


def _unpacked(packed: bytes) -> CoverTree:
    tree = CoverTree(*pickle.loads(packed))
    tree.points = _unit(tree.points)
    return tree
