"""Connected components of a link table, with every step a join and a grouping.

Each round first moves a node's larger neighbours to its smallest neighbour,
then a node's smaller neighbours; both keep the components and shorten the
paths, so the number of rounds grows with the logarithm of the longest path.
Rounds are written to the shared folder: lineage stays short, and a lost
executor costs no finished round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.llm.base import stage


def _mark(links: DataFrame):
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.count_distinct("u")
    ).first()
    return tuple(row)


def _low(links: DataFrame, name: str) -> DataFrame:
    """Smallest neighbour of each node, written so that the join that follows has
    a plain table on this side and Spark can split a hot node's rows."""
    return stage(links.groupBy("u").agg(F.min("v").alias("m")), name)


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for each node with a link: root is the smallest node of its
    component.  Links may repeat, point either way or from a node to itself."""
    now = stage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u > v").distinct(), "links",
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _low(both, "low").withColumn("m", F.least("u", "m"))
        large = stage(
            both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct(), "large",
        )
        low = _low(large, "low")
        moved = large.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, mark = mark, _mark(now)
        # one link per node, and a round that changed nothing: every node hangs on its root
        if mark == before and mark[0] == mark[2]:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def merge_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give linked nodes of a small in-memory graph the smallest label, in place.
    labels[k] is a node number; i and j are linked node numbers."""
    while True:
        a, b = labels[i], labels[j]
        low = np.minimum(a, b)
        if (a == b).all():
            return
        for end in (a, b, i, j):
            np.minimum.at(labels, end, low)
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]
