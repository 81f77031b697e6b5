"""Connected components over an edge DataFrame, with no driver-side state."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..session import cut

#: Distinct edges that one task settles (4 MB of them); more are contracted in rounds of shuffles.
ONE_TASK = 1 << 18


def merged(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node linked to each node, given that of earlier links and more links a, b; ``root`` is changed."""
    while len(a):
        ra, rb = root[a], root[b]
        differ = ra != rb
        if not differ.any():
            break
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def _stars(batches):
    """All edges (a, b) of a task as stars around the smallest node of each component."""
    held = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches if batch.num_rows]
    if held:
        a, b = map(np.concatenate, zip(*held))
        nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = merged(np.arange(len(nodes)), code[: len(a)], code[len(a) :])
        ends = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[root[ends]]), pa.array(nodes[ends])], ["a", "b"])


def _settled(pairs: DataFrame) -> bool:
    """Every larger end has one edge and is no smaller end: the edges are stars around their smallest node."""
    ends = pairs.select(F.col("b").alias("n"), F.lit(1).alias("x")).unionAll(pairs.select(F.col("a").alias("n"), F.lit(0).alias("x")))
    return ends.groupBy("n").agg(F.sum("x").alias("up"), F.min("x").alias("low")).filter("up > 1 or (up = 1 and low = 0)").isEmpty()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60, one_task: int = ONE_TASK) -> DataFrame:
    """``(node, component)`` for every node that has an edge; component is the smallest node reachable.

    Up to ``one_task`` distinct edges between whole numbers are settled by one task, whose work
    is bounded so: a round costs eight shuffles over all partitions, however few the edges.
    More edges, and other nodes, alternate large-star and small-star contraction (O(log^2 n) rounds). Nulls and
    self loops are ignored; no edges give no rows. Each round is checkpointed, so a
    lost executor costs one round; only the number of edges and whether they are stars reach the driver.
    """
    real = edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst)))
    pairs = real.select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b")).distinct()
    pairs = cut(pairs)
    whole = all(isinstance(f.dataType, IntegralType) for f in pairs.schema)
    few = whole and pairs.count() <= one_task
    if few:
        pairs = cut(pairs.coalesce(1).mapInArrow(_stars, pairs.schema))
    for _ in range(max_rounds):
        if few or _settled(pairs):
            break
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")), F.struct(F.col("m").alias("a"), "b"))).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        pairs = cut(small)
    else:
        raise RuntimeError("connected components did not settle")
    return pairs.select(F.col("b").alias("node"), F.col("a").alias("component")).unionAll(pairs.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
