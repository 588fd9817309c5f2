"""Merkle manifest of a dataset by slot pivots (operator 12).

Rows become leaves; the leaves of a group stand in order, and every ``fanout``
consecutive nodes have one parent.  A parent is one row: conditional aggregates
spread its children into ``fanout`` slot columns.  The columns put together are
hashed to the parent's digest; put together without a child's own column they
are that child's siblings.  Levels are built upwards by one aggregation each
(a level has an eighth of the rows below it), then paths flow down the same
pivot rows, so leaves are never joined to anything.  The roots of the groups
are the leaves of a last tree of the same kind.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FANOUT = 8
_PLACES = 33  # low bits of monotonically_increasing_id: the place in a partition
_STEP = "struct<left:string,right:string>"


def encoded(value: Column) -> Column:
    """A field as text that can be told from any other: its UTF-8 length, a
    colon and its value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*(encoded(c) for c in fields)), 256)


def proof_text(path: Column) -> Column:
    """All siblings of a path in one text, from the leaf to the root."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))


def _numbered(leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, ord, digest, ...) with ``idx``, the place in the group
    from 0, and ``total``, the group's size.  No group passes through one task:
    rows are dealt out by ranges, and only a count for each group and partition
    goes through a window."""
    leaves = leaves.withColumn("tie", F.monotonically_increasing_id()).checkpoint()
    order = ["grp", "ord", "digest", "tie"]
    ranged = leaves.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("mid", F.monotonically_increasing_id())
    ranged = ranged.withColumns({"part": F.shiftright("mid", _PLACES), "place": F.col("mid").bitwiseAND((1 << _PLACES) - 1)}).drop("mid", "tie").checkpoint()
    spans = ranged.groupBy("grp", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("grp")
    before = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select(F.col("grp").alias("s_grp"), F.col("part").alias("s_part"), (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("total"))
    placed = ranged.join(spans, (F.col("grp") == F.col("s_grp")) & (F.col("part") == F.col("s_part")))
    return placed.withColumn("idx", F.col("place") + F.col("shift")).drop("s_grp", "s_part", "part", "place", "shift")


def _parents(nodes: DataFrame, fanout: int, payload: Sequence[str]) -> DataFrame:
    """One row for each parent: (grp, total, idx, width, slot_0 ... slot_7),
    ``width`` being the nodes of the group at the parents' level."""
    child = F.struct(*payload)
    slots = [F.max(F.when(F.col("idx") % fanout == k, child)).alias(f"slot_{k}") for k in range(fanout)]
    up = F.floor(F.col("idx") / fanout).cast("long")
    width = F.ceil(F.col("width") / fanout).cast("long")
    return nodes.groupBy("grp", "total", up.alias("up"), width.alias("wide")).agg(*slots).withColumnsRenamed({"up": "idx", "wide": "width"})


def _slot(k: int) -> Column:
    return F.coalesce(F.col(f"slot_{k}.digest"), F.lit(""))


def _children(pivot: DataFrame, fanout: int, payload: Sequence[str]) -> DataFrame:
    """(grp, idx, payload..., subroot, path) of the children of parents with a
    ``path`` of their own: a child's first step is the other slot columns."""
    rows = []
    for k in range(fanout):
        own = [F.concat(*(_slot(j) for j in side)) if side else F.lit("") for side in (range(k), range(k + 1, fanout))]
        step = F.struct(own[0].alias("left"), own[1].alias("right"))
        fields = [(F.col("idx") * fanout + k).alias("idx"), *(F.col(f"slot_{k}.{c}").alias(c) for c in payload)]
        rows.append(F.when(F.col(f"slot_{k}").isNotNull(), F.struct(*fields, F.concat(F.array(step), F.col("path")).alias("path"))))
    return pivot.select("grp", "subroot", F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull())))


def _tree(leaves: DataFrame, fanout: int, payload: Sequence[str]) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Numbered leaves, the pivots of levels 1, 2, ..., and for each level from
    0 on the groups' roots that stand on it: (grp, idx, digest)."""
    nodes = _numbered(leaves).withColumn("width", F.col("total"))
    base, pivots, roots = nodes, [], []
    height = nodes.agg(F.max("width")).first()[0] or 0
    fields = list(payload)
    while True:
        roots.append(nodes.where("width = 1").select("grp", "idx", "digest"))
        if height <= 1:
            return base, pivots, roots
        pivots.append(_parents(nodes.where("width > 1"), fanout, fields).checkpoint())
        digest = F.sha2(F.concat(*(_slot(k) for k in range(fanout))), 256)
        nodes = pivots[-1].select("grp", "total", "idx", "width", digest.alias("digest"))
        height, fields = -(-height // fanout), ["digest"]


def _paths(base: DataFrame, pivots: list[DataFrame], roots: list[DataFrame], fanout: int, payload: Sequence[str], above: DataFrame | None) -> DataFrame:
    """(grp, idx, payload..., subroot, path) of all leaves; ``above`` has the
    path of each group's root (u_grp, u_path), none if the root is the end."""
    none = F.array().cast(f"array<{_STEP}>")

    def started(found: DataFrame) -> DataFrame:
        if above is None:
            return found.withColumn("path", none)
        return found.join(above, F.col("grp") == F.col("u_grp")).withColumnRenamed("u_path", "path").drop("u_grp")

    known: DataFrame | None = None  # (grp, idx, subroot, path) of the nodes of a level
    for level in range(len(pivots), 0, -1):
        tops = started(roots[level].select("grp", "idx", F.col("digest").alias("subroot")))
        known = tops if known is None else known.select("grp", "idx", "subroot", "path").unionByName(tops)
        at = known.select(F.col("grp").alias("k_grp"), F.col("idx").alias("k_idx"), "subroot", "path")
        with_path = pivots[level - 1].join(at, (F.col("grp") == F.col("k_grp")) & (F.col("idx") == F.col("k_idx")))
        known = _children(with_path, fanout, payload if level == 1 else ["digest"])
    lone = started(base.where("width = 1").select("grp", "idx", *payload, F.col("digest").alias("subroot")))
    return lone if known is None else known.unionByName(lone)


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    altered: Mapping[str, Column] | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """One row for each row of ``docs``: (id, grp, idx, leaf, altered_leaf,
    subroot, root, path); no other column of the table is read.

    ``leaf`` is the hash of the ``fields``; ``idx`` its place among the leaves
    of its ``group``, which ascend by ``order``; ``path`` the siblings left and
    right of it on each level, up to the root of all groups.  ``altered`` maps
    fields to what a check finds in their place: ``altered_leaf`` is the hash
    then (equal to ``leaf`` if nothing is altered).

    Null fields are hashed as ``-``.  Rows without a group are a group of their
    own, the first one; rows without an id come first in their group.  Rows
    with one id follow each other by digest, equal rows are leaves each.  Empty
    and very long texts are hashed like any other, texts are never shuffled.  A
    lone leaf is its group's root, a lone group's root the root of all.  An
    empty table gives an empty result.  Only the heights of the trees and the
    root reach the driver.
    """
    changed = [(altered or {}).get(c, F.col(c)) for c in fields]
    leaves = docs.select(
        # a null group is the empty text, others begin with a sign: same order, no null keys
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
        F.col(order).alias("ord"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"),
        leaf_digest(changed).alias("altered"),
    )
    payload = ["digest", "ord", "altered"]
    base, pivots, roots = _tree(leaves, fanout, payload)
    tops = roots[0]
    for more in roots[1:]:
        tops = tops.unionByName(more)
    tops = tops.select(F.lit("").alias("grp"), F.col("grp").alias("ord"), "digest")
    t_base, t_pivots, t_roots = _tree(tops, fanout, ["digest", "ord"])
    over = _paths(t_base, t_pivots, t_roots, fanout, ["digest", "ord"], None).checkpoint()
    first = over.select("subroot").first()  # of the last tree: the root of all
    above = over.select(F.col("ord").alias("u_grp"), F.col("path").alias("u_path"))
    rows = _paths(base, pivots, roots, fanout, payload, above)
    name = F.when(F.col("grp") != "", F.expr("substring(grp, 2)"))
    return rows.select(
        F.col("ord").alias("id"), name.alias("grp"), "idx", F.col("digest").alias("leaf"), F.col("altered").alias("altered_leaf"), "subroot",
        F.lit(first[0] if first else None).cast("string").alias("root"), "path",
    )
