"""Connected components of a distributed link table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def local_roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of the component of each of the nodes 0 to n - 1, given
    links u[i] - v[i]: hooking to the smaller root and pointer jumping."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        open_ = a != b
        if not open_.any():
            break
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def components(links: DataFrame, src: str = "src", dst: str = "dst", most_rounds: int = 64) -> DataFrame:
    """(node, root): smallest node reachable from each node that has a link to
    another one; ``links`` holds (src, dst) pairs of one orderable type.

    Each round hooks every node to its smallest neighbour if that is smaller,
    follows the hooks by pointer jumping, and rewrites the links to the roots,
    so that links shrink by half and more each round; the hooks of all rounds
    are then followed.  Neighbour minima are pre-aggregated, so a node with a
    third of all links is no hot task.  Rounds are cut by ``checkpoint()``;
    nothing but row counts reaches the driver.  Null ends, links to itself and
    repeated links do no harm; no links give an empty result.
    """
    edges = links.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a <> b")
    edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().checkpoint()
    known: DataFrame | None = None  # (node, root) of all nodes so far
    for _ in range(most_rounds):
        if edges.isEmpty():
            break
        # smallest neighbour of every node; the larger end of a link has a smaller one
        hooks = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        hooks = _jump(hooks)
        if known is None:
            known = hooks
        else:
            k, h = known.select("node", F.col("root").alias("mid")), hooks.select(F.col("node").alias("h_node"), F.col("root").alias("h_root"))
            moved = k.join(h, F.col("mid") == F.col("h_node"), "left").select("node", F.coalesce("h_root", "mid").alias("root"))
            known = moved.unionByName(hooks).checkpoint()
        left = hooks.select(F.col("node").alias("la"), F.col("root").alias("ra"))
        right = hooks.select(F.col("node").alias("lb"), F.col("root").alias("rb"))
        new = edges.join(left, F.col("a") == F.col("la"), "left").join(right, F.col("b") == F.col("lb"), "left")
        new = new.select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y")).where("x <> y")
        edges = new.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct().checkpoint()
    else:
        raise RuntimeError("links did not settle")
    if known is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = known.groupBy("root").count().select(F.col("root").alias("node"), "root")
    return known.unionByName(roots)


def _jump(hooks: DataFrame) -> DataFrame:
    """Follow the hooks to their ends."""
    hooks = hooks.checkpoint()
    while True:
        up = hooks.select(F.col("node").alias("u_node"), F.col("root").alias("u_root"))
        nxt = hooks.join(up, F.col("root") == F.col("u_node"), "left")
        nxt = nxt.select("node", F.coalesce("u_root", "root").alias("root"), F.col("u_node").isNotNull().alias("moved")).checkpoint()
        hooks = nxt.drop("moved")
        if nxt.where("moved").isEmpty():
            return hooks
