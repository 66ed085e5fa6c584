"""Connected components of an edge table: edges are contracted where they lie, then by star operations."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.scratch import Scratch
from broadsheet.llm.windows import distinct

#: Edges that one task contracts at once, some 300 MB of them.
TASK_EDGES = 500_000


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node it reaches) of every node but those smallest ones."""
    nodes = distinct(np.concatenate([a, b]))
    root = np.arange(len(nodes))
    left, right = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
    while True:
        # Hang the larger root of every edge to the smaller one, then shorten all ways.
        x, y = root[left], root[right]
        if (x == y).all():
            break
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _contract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def out() -> pa.RecordBatch:
        a, b = contracted(*(np.concatenate(c) for c in zip(*held)))
        return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        held.append((batch["a"].to_numpy(), batch["b"].to_numpy()))
        size += batch.num_rows
        if size >= 2 * TASK_EDGES:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of ``edges`` (a, b; longs) reaches.

    Tasks contract their own edges first; up to TASK_EDGES edges one task does all. Beyond, every round
    hangs the larger neighbours of a node to its smallest neighbour, then the smaller ones; the rounds
    needed grow with the logarithm of the nodes. Each round is a written table, so a lost executor costs
    one round. No edges give no rows. Edges with a null end and loops are left out; a node of loops
    only has no row.
    """
    scratch = Scratch(edges.sparkSession, "components")
    a, b = F.col("a"), F.col("b")
    own = edges.filter(a != b).select(a.cast("long"), b.cast("long")).mapInArrow(_contract, "a long, b long")
    current = scratch.write(own.distinct())
    n = current.count()
    if n <= TASK_EDGES:
        current = scratch.write(current.repartition(1).mapInArrow(_contract, "a long, b long"))
    else:
        current = _stars(current, scratch)
    roots = current.select(b.alias("node"), b.alias("component")).distinct()
    return current.select(a.alias("node"), b.alias("component")).union(roots)


def _stars(current: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges from every node to the smallest it reaches, from edges of a node to a smaller one."""
    a, b, seen = F.col("a"), F.col("b"), None
    while True:
        both = current.union(current.select(b.alias("a"), a.alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), a).alias("m"))
        large = both.join(lowest.hint("merge"), "a").filter(b > a).select(b.alias("a"), F.col("m").alias("b")).distinct()
        large = large.filter(a != b)
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = large.join(lowest.hint("merge"), "a")
        small = (
            pairs.select(b.alias("a"), F.col("m").alias("b"))
            .union(lowest.select("a", F.col("m").alias("b")))
            .filter(a != b)
            .distinct()
        )
        following = scratch.write(small)
        state = following.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        scratch.drop(current)
        current = following
        if state == seen:
            return current
        seen = state
