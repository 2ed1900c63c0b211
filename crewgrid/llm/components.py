"""Connected components of a table of links; nothing but counts reaches the driver.

Links are contracted locally first (a piece of a task's rows becomes its spanning stars), then by
alternating large and small stars. Up to `ONE_TASK` links, 16 bytes each, are contracted by one task
instead, which gives the same and spares the rounds' jobs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, written

#: Rounds after which an error is raised; stars need about the logarithm of a component's size.
MOST_ROUNDS = 60
#: Links that one task may hold (64 MB), and rows that a task contracts at a time.
ONE_TASK, PIECE = 4_000_000, 500_000


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links among some nodes: every node but the roots, and its root, the least node that it reaches."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _contracted(links: DataFrame, piece: int) -> DataFrame:
    """u, v: the spanning stars of every `piece` rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0

        def stars() -> pa.RecordBatch:
            u, v = (np.concatenate(c) for c in zip(*held, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in contracted(u, v)], ["u", "v"])

        for b in batches:
            held.append((b.column("u").to_numpy(), b.column("v").to_numpy()))
            n += b.num_rows
            if n >= piece:
                yield stars()
                held, n = [], 0
        if held:
            yield stars()

    return links.select("u", "v").mapInArrow(run, "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges with u > v: a node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: u, v (longs, not null), a written table. node and root (its component's smallest node) of every linked node but the roots; a written table."""
    named = lambda edges: edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    if links.count() <= ONE_TASK:
        return written(named(_contracted(links.coalesce(1), ONE_TASK + 1)), "stars")
    edges, before = _contracted(links, PIECE).distinct(), None
    for _ in range(MOST_ROUNDS):
        last, edges = edges, written(_small_star(_large_star(edges)), "stars")
        discard(last)
        now = tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        if now == before or not now[0]:
            out = named(edges)
            out.written_at = edges.written_at
            return out
        before = now
    raise RuntimeError(f"no end after {MOST_ROUNDS} rounds")
