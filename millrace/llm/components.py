"""Connected components: contraction inside tasks, then alternating stars in joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import written

#: Links that a task contracts at a time; up to so many may share a task.
HELD = 1 << 18


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the same components: one from each node to the least one, except from that."""
    nodes, code = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = code[: len(u)], code[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    tied = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[tied], nodes[root[tied]]


def _contracted(links: DataFrame) -> DataFrame:
    """Each task's links as stars, a range of them at a time; rows may repeat between tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            total += batch.num_rows
            if total >= HELD:
                held = [forest(*map(np.concatenate, zip(*held)))]
                total = len(held[0][0])
                if 2 * total > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(side) for side in held[0]], names=["u", "v"])
                    held, total = [], 0
        if held:
            last = forest(*map(np.concatenate, zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(side) for side in last], names=["u", "v"])

    return links.select("u", "v").mapInArrow(run, "u bigint, v bigint")


def _large_star(links: DataFrame) -> DataFrame:
    """Tie every larger neighbour of a node to the least node around it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours ``v`` to the least of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    ends = F.array(*(F.struct(F.col(c).alias("u"), F.col("m").alias("v")) for c in ("u", "v")))
    return links.join(least, "u").select(F.inline(ends)).where("u <> v")


def _tied(links: DataFrame) -> DataFrame:
    """``node, label``: the upper end of each link with the lower one, and the lower with itself."""
    return links.select(F.inline(F.array(*(F.struct(F.col(c).alias("node"), F.col("v").alias("label")) for c in ("u", "v")))))


def _all_stars(links: DataFrame) -> bool:
    """Whether every node is tied to one node below it only, and that to none."""
    nodes = _tied(links).groupBy("node").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return nodes.where("lo < hi").isEmpty()


def _gathered(links: DataFrame) -> DataFrame:
    """Links contracted task by task, as long as fewer tasks can read what the last ones wrote.

    Spark puts small files together. Where that ends, splits share a task of up to ``HELD``
    links; more links than that stay in as many tasks, so a task never holds more at a time.
    """
    while True:
        files, tasks = len(links.inputFiles()), max(1, links.rdd.getNumPartitions())
        if 2 * tasks > files:
            tasks = max(1, min(tasks, -(-links.count() // HELD)))
        if 2 * tasks > files:
            return links
        links = written(_contracted(links.coalesce(tasks)))


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``u``, ``v``): its component's least node.

    Tasks contract the links that they read, without an exchange. Rounds of stars join what
    different tasks still hold, until all links are stars. A round needs two aggregations and
    two joins on nodes, whose hot side the skew join splits. All of them are written one after
    another. No links give no rows.
    """
    now = _gathered(written(links.where("u <> v").select("u", "v")))
    while not _all_stars(now):
        now = _gathered(written(_small_star(_large_star(_contracted(now))).distinct()))
    return _tied(now).distinct()
