"""Connected components of a table of links, as rounds of joins and aggregations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import written


#: Nodes that a task joins before it hands its links on.
HELD = 4_000_000
#: So many links are joined by one task instead of further rounds, whatever the table holds.
FEW = 5_000
#: So many partitions go through one task, which hands on a link once that several of them have.
TOGETHER = 8


class Forest:
    """Nodes joined so far, by smallest node; as many links as nodes that are not a root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, node: int) -> int:
        up = self.up
        top = node
        while (above := up.get(top, top)) != top:
            top = above
        while node != top:
            up[node], node = top, up.get(node, top)
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _handed_on(forest: Forest) -> Iterator[pd.DataFrame]:
    found = [(forest.root(node), node) for node in list(forest.up)]
    for start in range(0, len(found), 100_000):
        yield pd.DataFrame(found[start : start + 100_000], columns=["a", "b"])


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(root, node) of each node that is not a root, of all links of a task or of HELD nodes at a time."""
    forest = Forest()
    for batch in batches:
        pairs = np.unique(batch.to_numpy(dtype=np.int64), axis=0)
        for a, b in pairs.tolist():
            forest.join(a, b)
        if len(forest.up) > HELD:
            yield from _handed_on(forest)
            forest = Forest()
    yield from _handed_on(forest)


def spanning(links: DataFrame) -> DataFrame:
    """(a, b) that connect what the links of each task connect, one link for each node of it at most.

    Links of one group that meet in a task all point to its smallest node there, which is
    mostly the group's smallest, so that few distinct links remain of many. Tasks take
    TOGETHER partitions each, as long as there are enough for all cores.
    """
    spark = links.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // TOGETHER)
    return links.select("a", "b").coalesce(tasks).mapInPandas(_joined, "a long, b long")


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long); component is the smallest node.

    Every round each node hooks onto the neighbour of least priority, if it has less than its
    own, and all links are rewritten to what their ends hook onto: links within a group vanish
    and the rest shrink, by a random part each round since priorities are hashes that
    change with the round. No node is lost: a node and what it hooks onto were linked, so
    their new names are. Partial aggregation keeps a node with very many links from
    meeting in one task. The last links, FEW at most, are joined in one task. At the end the
    hooks are followed from the last round to the first, so that the rows joined are as many
    as all hooks, a small multiple of the nodes.
    """
    # written first: links may come out of another evaluation in another order or choice
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = written(links, "links")
    hooks: list[DataFrame] = []
    for turn in range(rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        priority = lambda node: F.struct(F.xxhash64(node, F.lit(turn)).alias("priority"), node.alias("node"))  # noqa: B023, E731
        least = both.groupBy(F.col("a").alias("node")).agg(F.min(priority(F.col("b"))).alias("best"))
        hooks.append(written(least.select("node", F.least(priority(F.col("node")), F.col("best"))["node"].alias("onto")), "hooks"))
        a = hooks[-1].select(F.col("node").alias("a"), F.col("onto").alias("x"))
        b = hooks[-1].select(F.col("node").alias("b"), F.col("onto").alias("y"))
        moved = links.join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        links = written(moved.distinct(), "links")
        if links.count() <= FEW:
            break
    else:
        raise RuntimeError(f"links still connect different groups after {rounds} rounds")
    # the last links in one task; nodes without a link are groups by now
    labels = links.coalesce(1).mapInPandas(_joined, "a long, b long").select(F.col("b").alias("node"), F.col("a").alias("component"))
    # from the last round back: each round's nodes are joined once, and the rounds shrink
    for earlier in reversed(hooks):
        later = labels.withColumnRenamed("node", "onto")
        labels = earlier.join(later, "onto", "left").select("node", F.coalesce("component", "onto").alias("component"))
    labels = written(labels, "labels")
    smallest = labels.groupBy("component").agg(F.min("node").alias("smallest"))
    return labels.join(smallest, "component").select("node", F.col("smallest").alias("component"))
