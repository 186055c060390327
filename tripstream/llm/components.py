"""Connected components of a large graph by alternating stars.

Large star: every node hands its larger neighbours to its smallest neighbour.
Small star: every node hands its smaller neighbours, and itself, to the smallest.
The edge set converges to one star per component, centred on its smallest node, in
about log n rounds. Minima are combined before the shuffle and staged, so the joins
that bring them back are ordinary shuffle joins whose hot nodes Spark splits.

Before that, each task replaces the edges it reads (at most about ``AT_ONCE``) by a
spanning star of each group they connect. Where all edges fit one such task, that is
already the answer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstream.llm.common import staged


AT_ONCE = 500_000


def labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node reachable over the edges a-b, for nodes 0..n-1."""
    label = np.arange(n)
    while True:
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
        if not len(a):
            return label
        m = np.minimum(label[a], label[b])
        # hook the roots, then let every node follow its root to the end
        np.minimum.at(label, label[a], m)
        np.minimum.at(label, label[b], m)
        while (label != label[label]).any():
            label = label[label]


def _contracted(edges: DataFrame, tasks: int) -> DataFrame:
    def run(batches):
        held = [(b.column("u").to_numpy(), b.column("v").to_numpy()) for b in batches]
        if held:
            u, v = (np.concatenate(x) for x in zip(*held))
            nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
            label = labels(at[: len(u)], at[len(u) :], len(nodes))
            moved = np.flatnonzero(label != np.arange(len(nodes)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[label[moved]])], names=["u", "v"])

    return edges.coalesce(tasks).mapInArrow(run, "u bigint, v bigint")


def _smallest(edges: DataFrame) -> DataFrame:
    return staged(edges.groupBy("u").agg(F.min("v").alias("m")), "star-minima")


def stars(edges: DataFrame, a: str = "a", b: str = "b", at_once: int = AT_ONCE) -> DataFrame:
    """(node, root) for every node that has an edge and is not itself its component's smallest.

    Loops, repeated edges and both orientations are fine; an edge with a null end is
    left out; without edges there are no rows.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("a"), F.col(b).alias("b"))
    e = staged(e.where("a IS NOT NULL AND b IS NOT NULL AND u > v").select("u", "v"), "star-edges")
    tasks = -(-e.count() // at_once)
    if tasks:
        e = staged(_contracted(e, tasks), "star-contracted")
    if tasks <= 1:
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    e, seen = staged(e.distinct(), "star-distinct"), None
    while True:
        mark = e.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("h")).first()
        if mark.n == 0 or (mark.n, mark.h) == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = (mark.n, mark.h)
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.where("v > u").join(_smallest(both), "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = staged(large.distinct(), "star-large")
        low = _smallest(large)
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = staged(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "star-small")
