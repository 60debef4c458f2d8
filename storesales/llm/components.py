"""Connected components of a graph that is nowhere held whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storesales.llm.common import cut

# Edges that a task folds at a time.
FOLDED = 1 << 19


def roots_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The vertices of these edges, sorted, and the smallest vertex each is connected to."""
    vertices, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = places[: len(a)], places[len(a) :]
    root = np.arange(len(vertices))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        while not np.array_equal(jumped := root[root], root):
            root = jumped
        if np.array_equal(before, root):
            return vertices, vertices[root]


def _fold(edges: DataFrame) -> DataFrame:
    """Each task replaces its edges by stars with the same components; never more edges than before."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def star() -> tuple[np.ndarray, np.ndarray]:
            vertices, roots = roots_of(*(np.concatenate(side) for side in zip(*held, strict=True)))
            child = vertices != roots
            return vertices[child], roots[child]

        def batch_of(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            held.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
            if sum(len(a) for a, _ in held) > FOLDED:
                held = [star()]
                if len(held[0][0]) > FOLDED // 2:
                    yield batch_of(*held.pop())
        if held:
            yield batch_of(*star())

    return edges.mapInArrow(fold, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``vertex, root`` for every vertex of ``edges`` (``a, b`` long) but the roots: the smallest vertex connected to it.

    Tasks fold what they hold to stars. Then large-star and small-star rounds
    alternate until only stars are left: all larger neighbours of a vertex are
    linked to its smallest neighbour, then all smaller ones. Rounds grow with
    the log of the number of vertices. A vertex with very many edges is summed
    up in the map tasks, and its rows of the join are split by adaptive
    execution. Each round is written out. No more edges than a task folds at
    once need no rounds. Loops and repeated edges are allowed,
    edges with a NULL end are ignored.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    edges = cut(edges, "components")
    few = edges.count() <= FOLDED
    current = cut(_fold(edges.coalesce(1) if few else edges), "components")
    while not few and not _only_stars(current):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), "a").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = smallest.select("a", F.col("m").alias("b"))
        current = cut(_fold(small.unionByName(own).distinct()), "components")
    return current.select(F.col("a").alias("vertex"), F.col("b").alias("root"))


def _only_stars(edges: DataFrame) -> bool:
    again = edges.groupBy("a").count().where("count > 1").select("a")
    parents = edges.select(F.col("b").alias("a"))
    return edges.join(parents, "a", "left_semi").select("a").unionByName(again).isEmpty()
