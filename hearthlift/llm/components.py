"""Connected components of a link table. Only numbers of rows reach the driver."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlift.llm.common import discard, map_arrow, stage

# Links up to which, after counting them, one task finds all components: 8 MB. Beyond, alternating stars do, with
# the same result; for few links their jobs would be all overhead.
TASK_LINKS = 500_000


def smallest_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All nodes of the links, and the smallest node that links lead to from each."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        least = np.minimum(root[u], root[v])
        for end in (u, v):  # a node's root moves with it
            np.minimum.at(root, root[end], least)
            np.minimum.at(root, end, least)
        root = root[root]
        if (root == before).all():
            return nodes, nodes[root]


def _in_one_task(edges: DataFrame) -> DataFrame:
    def run(batches):
        held = [(x.column(0).to_numpy(zero_copy_only=False), x.column(1).to_numpy(zero_copy_only=False)) for x in batches]
        if held:
            nodes, roots = smallest_reached(*(np.concatenate(x) for x in zip(*held, strict=True)))
            away = nodes != roots
            yield pa.RecordBatch.from_arrays([pa.array(nodes[away]), pa.array(roots[away])], ["node", "root"])

    return map_arrow(edges.coalesce(1), run, "node long, root long")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root, the smallest node that links lead to; nodes without links are not in it, nor are roots.
    Nodes are whole numbers.

    Many links are handled in rounds. Each points the larger neighbours of every node to its smallest neighbour,
    then does the same for the smaller ones, and writes the links; a round that changes nothing ends it. The
    number of rounds grows with the logarithm of the longest path. Minima are formed before the shuffle, so a node
    with very many links is no single task's work, and adaptive execution can split it in the join.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, state = stage(edges, "links"), None
    if edges.count() <= TASK_LINKS:
        return stage(_in_one_task(edges), "links")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select("u", F.col("m").alias("v")).union(joined.select(F.col("v"), F.col("m"))).where("u <> v")
        before, edges = edges, stage(small.distinct(), "links")
        discard(before)
        # Both are counts or sums over rows that are distinct, so equal pairs mean equal sets of links.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
