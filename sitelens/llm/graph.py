"""Connected components by random contraction, in rounds of staged tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges(u, v)``; equal labels mean connected.

    Each round every node hooks to the neighbour, or itself, that is smallest under a hash
    drawn anew per round, and edges are rewritten to the hooks.  The expected number of
    nodes falls by a constant factor, so a chain ends as soon as a star: the rounds follow
    the logarithm of the largest component.  Nulls, loops and repeated edges are ignored.
    Hooks are ``min`` aggregates that combine map-side; the joins on a hot node are plain
    sort-merge joins, which the adaptive skew join splits.
    """
    tidy = lambda df: df.filter("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    live = staged(tidy(edges))
    labels, turn = None, 0
    while labels is None or not live.isEmpty():
        both = live.union(live.select(F.col("v"), F.col("u")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("p"), F.col(c).alias("id"))  # noqa: B023, E731
        hook = staged(
            both.groupBy("u")
            .agg(F.min(rank("v")).alias("best"))
            .select(F.col("u").alias("node"), F.least("best", rank("u"))["id"].alias("label"))
        )
        a = hook.select(F.col("node").alias("u"), F.col("label").alias("hu"))
        b = hook.select(F.col("node").alias("v"), F.col("label").alias("hv"))
        live = staged(tidy(live.join(a, "u").join(b, "v").select(F.col("hu").alias("u"), F.col("hv").alias("v"))))
        if labels is None:
            labels = hook
        else:
            step = hook.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = staged(labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label")))
        turn += 1
    return labels


def forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest index connected to each of ``n`` nodes, for links inside one task."""
    label = np.arange(n)
    while len(u):
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while True:
            jump = label[label]
            if (jump == label).all():
                break
            label = jump
        keep = label[u] != label[v]
        u, v = u[keep], v[keep]
    return label
