"""Connected components of links held in a table, without a group or the links in one place."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlive.llm.common import saved


def forest(count: int, one: np.ndarray, other: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """For nodes 0 to count - 1 the smallest node that links lead to, starting from ``root``."""
    root = np.arange(count) if root is None else root
    while True:
        a, b = root[one], root[other]
        apart = a != b
        if not apart.any():
            return root
        one, other, a, b = one[apart], other[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root[root], root):
            root = root[root]


def contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a batch, replaced by links of each node to the smallest it reaches there."""
    for batch in batches:
        ends = np.concatenate([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        nodes, place = np.unique(ends, return_inverse=True)
        root = forest(len(nodes), place[: batch.num_rows], place[batch.num_rows :])
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_pydict({"a": nodes[moved], "b": nodes[root[moved]]})


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b; long); component is the smallest node reached.

    Large-star and small-star steps in turn: neighbours are tied to the smallest
    node around them until only stars are left. Minima are combined before the
    shuffle. They are written to the shared folder before rows are joined to
    them, so that the join has plain shuffles on both sides and adaptive
    execution can split the rows of a node with very many links.
    """
    real = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars, known = saved(real.mapInArrow(contracted, "a long, b long"), "links"), None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        near = both.where("b > a").join(saved(lowest, "lowest"), "a")
        large = saved(near.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-stars")
        parent = saved(large.groupBy("a").agg(F.min("b").alias("m")), "parents")
        others = large.join(parent, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = others.unionByName(parent.select("a", F.col("m").alias("b"))).distinct()
        stars = saved(small, "stars")
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38)"))).first()
        if state == known:
            break
        known = state
    centres = stars.select(F.col("b").alias("a")).distinct()
    return stars.unionByName(centres.select("a", F.col("a").alias("b"))).toDF("node", "component")
