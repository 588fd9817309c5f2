"""SimHash near-duplicates by a Gray-order hierarchical index (operator 10).

Equal fingerprints collapse first.  The distinct ones, in Gray order, fall
into blocks that share their leading bits: the upper nodes of the index.  A
fingerprint visits the blocks whose shared bits differ from its own by at most
the allowed distance, carrying what it has used up.  Inside a block the sorted
fingerprints form a tree of shared masked bit patterns; all visitors descend
it together, and a group is dropped as soon as the accumulated differences
exceed the distance.  A block larger than the aim gets deeper leading bits by
itself, so a crowd of near copies is dealt out further.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import by_size, renamed, text_bytes
from vaultline.llm.components import components, local_roots

SEED = 42
BLOCK = 1 << 14  # distinct fingerprints that a block aims at
_STEP = 6  # bits that one level of a block's tree covers
_PAIRS = 1 << 17  # visitor-group pairs that are expanded and compared at once
_LOWER = bytes(range(256)).lower()


def _lanes() -> np.ndarray:
    """For each byte, its bits as eight lanes of one byte in a 64-bit number."""
    byte = np.arange(256, dtype=np.uint64)
    return sum(((byte >> np.uint64(k)) & np.uint64(1)) << np.uint64(8 * k) for k in range(8))


def fingerprint(text: bytes, width: int, lanes: np.ndarray) -> int:
    """SimHash of a text's word shingles (repeats counted, XXH64, seed 42)."""
    import xxhash

    words = text.translate(_LOWER).split()
    if not words:
        return 0
    last = max(1, len(words) - width + 1)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    h = np.fromiter((digest(join(words[i : i + width]), SEED) for i in range(last)), np.uint64, last)
    counts = np.zeros(64, np.int64)
    rows = h.view(np.uint8).reshape(-1, 8)
    firsts = np.arange(0, last, 255)  # a lane holds sums up to 255
    for k in range(8):
        sums = np.add.reduceat(lanes[rows[:, k]], firsts)
        counts[8 * k : 8 * k + 8] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0)
    return int(((counts * 2 > last).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint's 64 bits as a long.  Null and
    texts without words have fingerprint 0; every row is taken by itself; no
    shuffle."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lanes = _lanes()
        for b in by_size(batches, "text"):
            fps = np.array([fingerprint(t, width, lanes) for t in text_bytes(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps)], names=["doc_id", "text_hash", "fp"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of a code in the reflected Gray sequence."""
    out = fp.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def near_pairs(index: np.ndarray, visitors: np.ndarray, used: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(visitor, index) places of all pairs within ``distance`` bits.

    ``index``: distinct codes in Gray order; ``used``: leading bits in which
    the codes of the index agree.  Level by level, codes that agree in the
    next ``_STEP`` bits are one group; pairs of visitors and groups go on
    while the differences of all levels so far are within ``distance``."""
    if not len(index) or not len(visitors):
        return
    levels = []
    for bits in [*range(used + _STEP, 64, _STEP), 64]:
        head = index >> np.uint64(64 - bits)
        first = np.flatnonzero(np.concatenate(([True], head[1:] != head[:-1])))
        levels.append((bits, head[first], first))
    # children of a group: the groups of the next level that begin inside it;
    # above the first level stands one group that holds them all
    spans = [np.array([0, len(levels[0][1])])]
    for (_, _, first), (_, _, below) in zip(levels, levels[1:], strict=False):
        spans.append(np.searchsorted(below, np.append(first, len(index))))
    # visitors with a range of children each; a pair becomes its children only
    # when these are compared, about _PAIRS at once
    todo = [(0, np.arange(len(visitors), dtype=np.int32), np.zeros(len(visitors), np.int32))]
    while todo:
        k, v, g = todo.pop()
        span = spans[k]
        head = g[:_PAIRS]  # each has a child at least
        total = np.cumsum(span[head + 1] - span[head])
        end = max(1, int(np.searchsorted(total, _PAIRS, side="right")))
        if end < len(v):
            todo.append((k, v[end:], g[end:]))
            v, g = v[:end], g[:end]
        n = span[g + 1] - span[g]
        inner = np.arange(int(n.sum()), dtype=np.int32) - np.repeat((np.cumsum(n) - n).astype(np.int32), n)
        v, g = np.repeat(v, n), np.repeat(span[g].astype(np.int32), n) + inner
        bits, heads, _ = levels[k]
        ok = np.bitwise_count(heads[g] ^ (visitors[v] >> np.uint64(64 - bits))) <= distance
        v, g = v[ok], g[ok]
        if not len(v):
            continue
        if k + 1 == len(levels):
            yield v, g
        else:
            todo.append((k + 1, v, g))


def _masks(bits: int, distance: int) -> list[tuple[int, int]]:
    """Patterns of ``bits`` bits with at most ``distance`` ones, and their ones."""
    out = [(0, 0)]
    for n in range(1, distance + 1):
        stack = [(0, 0, n)]
        while stack:
            at, mask, left = stack.pop()
            if not left:
                out.append((mask, n))
                continue
            stack += [(b + 1, mask | 1 << b, left - 1) for b in range(at, bits - left + 1)]
    return out


_LINK = "src long, dst long"


def _block_links(rows: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links of each block of a partition that is sorted by (head, depth,
    sub); rows are (head, depth, sub, own, fp).  A block's links are reduced
    to one for each linked fingerprint, to the smallest of its component."""
    held: list[pa.RecordBatch] = []
    key = None

    def done() -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        own, fp = t["own"].to_numpy().astype(bool), t["fp"].to_numpy().astype(np.int64).view(np.uint64)
        index = np.unique(fp[own])
        index = index[np.argsort(gray_rank(index))]
        visitors = fp[~own]
        nodes = np.concatenate((index, visitors))
        root = np.arange(len(nodes))
        used = t["head_bits"][0].as_py() + t["depth"][0].as_py()
        for shift, who in ((0, index), (len(index), visitors)):
            for v, g in near_pairs(index, who, used, distance):
                v = v + shift
                more = root[v] != root[g]
                if more.any():
                    root = local_roots(root[v[more]], root[g[more]], len(nodes))[root]
        linked = np.flatnonzero(root != np.arange(len(nodes)))
        if len(linked):
            cols = [pa.array(nodes[linked].view(np.int64)), pa.array(nodes[root[linked]].view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=["src", "dst"])

    for b in rows:
        keys = np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(3)])
        cut = np.flatnonzero(np.concatenate(([True], (np.diff(keys) != 0).any(axis=0)))) if b.num_rows else []
        for i, at in enumerate(cut):
            now = tuple(keys[:, at])
            if key is not None and now != key:
                yield from done()
                held = []
            key = now
            end = cut[i + 1] if i + 1 < len(cut) else b.num_rows
            held.append(b.slice(at, end - at))
    if held:
        yield from done()


def fingerprint_links(fps: DataFrame, distance: int = 2, block: int = BLOCK) -> DataFrame:
    """Links (src, dst) that connect exactly what pairs of ``fp`` within
    ``distance`` bits connect; ``fps`` holds distinct codes and is read a few
    times, so let it be a checkpoint.

    Leading bits: log2(count / block).  Blocks with over four times the aim
    take further bits of their own; their table has at most count / 4 block
    rows.  A code visits later blocks only (the pair is then found once), so
    the shuffle holds about half of 1 + d + d(d-1)/2 copies of a code for d
    leading bits and distance 2."""
    spark = fps.sparkSession
    total = fps.count()
    d = max(0, (max(1, total // block)).bit_length() - 1)
    head = F.shiftrightunsigned("fp", 64 - d) if d else F.lit(0).cast("long")
    counts = fps.groupBy(head.alias("head")).count()
    steps = F.greatest(F.lit(0), F.ceil(F.log2(F.col("count") / block))).cast("int")
    deep = counts.where(F.col("count") > 4 * block).select(F.col("head").alias("d_head"), F.least(steps, F.lit(63 - d)).alias("d_depth"))
    visits = F.explode(F.array(*(F.struct(F.lit(m).cast("long").alias("mask"), F.lit(n).alias("n")) for m, n in _masks(d, distance))))
    probes = fps.select("fp", head.alias("own_head"), visits.alias("m"))
    probes = probes.select("fp", "own_head", F.col("own_head").bitwiseXOR(F.col("m.mask")).alias("head"), F.col("m.n").alias("n"))
    probes = probes.where("head >= own_head").join(deep, F.col("head") == F.col("d_head"), "left")
    probes = probes.withColumn("depth", F.coalesce("d_depth", F.lit(0)))

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Visits of the sub-blocks of deep blocks; others have one."""
        for b in batches:
            t = {n: b.column(i).to_numpy().astype(np.int64) for i, n in enumerate(b.schema.names)}
            parts = []
            for depth in np.unique(t["depth"]):
                at = np.flatnonzero(t["depth"] == depth)
                bits = t["fp"][at].view(np.uint64)
                own_sub = ((bits << np.uint64(d)) >> np.uint64(64 - depth)).astype(np.int64) if depth else np.zeros(len(at), np.int64)
                for mask, n in _masks(int(depth), distance):
                    on = t["n"][at] + n <= distance
                    sub = own_sub ^ mask
                    home = t["head"][at] == t["own_head"][at]
                    on &= ~home | (sub >= own_sub)
                    own = home & (sub == own_sub)
                    parts.append((t["head"][at][on], np.full(on.sum(), depth), sub[on], own[on].astype(np.int64), t["fp"][at][on]))
            if parts:
                cols = [np.concatenate(x) for x in zip(*parts, strict=True)]
                cols.insert(3, np.full(len(cols[0]), d))
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["head", "depth", "sub", "head_bits", "own", "fp"])

    rows = probes.select("fp", "own_head", "head", "n", F.col("depth").cast("long")).mapInArrow(below, "head long, depth long, sub long, head_bits long, own long, fp long")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * (1 << d))
    rows = rows.repartition(parts, "head", "depth", "sub").sortWithinPartitions("head", "depth", "sub")
    return rows.mapInArrow(lambda it: _block_links(it, distance), _LINK)


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, distance: int = 2, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_hash, fp, component_id), one row for each row of ``docs``.

    Rows link if their fingerprints differ in at most ``distance`` bits; the
    component id is the smallest non-null id reachable (null if all are).
    Rows without words share fingerprint 0 and link like any other; repeated
    rows and ids are in one component anyway; an empty table gives an empty
    result."""
    return _rooted(docs, doc_id, text, width, distance, block).select("doc_id", "text_hash", "fp", "component_id")


def _rooted(docs: DataFrame, doc_id: str, text: str, width: int, distance: int, block: int = BLOCK) -> DataFrame:
    """Columns of ``simhash_components``, and ``root``: the fingerprint that
    tells components apart, also where ids are repeated."""
    prints = fingerprints(docs, doc_id, text, width).checkpoint()
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).checkpoint()
    found = components(fingerprint_links(classes.select("fp"), distance, block))
    rooted = classes.join(found, classes["fp"] == found["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    heads = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    members = rooted.select("fp", "root").join(heads, "root").select(F.col("fp").alias("m_fp"), "root", "component_id")
    return prints.join(members, prints["fp"] == members["m_fp"]).select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row
    with the smallest id.  Of its rows that share that id the first by text,
    then by the other columns, stays; rows without an id have no place in that
    order and all stay.  The table itself is joined once, with the (id, text
    hash) of the rows that go or share an id."""
    src, at = renamed(docs)
    key, body = at[doc_id], at[text]
    got = _rooted(src.where(F.col(key).isNotNull()), key, body, width, distance).checkpoint()
    per = got.where("doc_id = component_id").groupBy("doc_id", "root").agg(F.count("*").alias("n"))
    shared = per.where("n > 1").select(F.col("doc_id").alias("s_id"), F.col("root").alias("s_root"))
    marks = got.join(shared, (F.col("doc_id") == F.col("s_id")) & (F.col("root") == F.col("s_root")), "left").where("doc_id <> component_id or s_id is not null")
    # one text has one fingerprint, so one root
    marks = marks.groupBy(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash")).agg(F.min("component_id").alias("m_component"), F.min("root").alias("m_root"))
    marked = src.join(marks, (F.col(key) == F.col("m_id")) & (F.xxhash64(body) == F.col("m_hash")), "left")
    names = src.columns
    once = marked.where("m_id is null").select(*names)
    again = marked.where("m_id = m_component")
    first = again.groupBy("m_root").agg(F.min(F.struct(body, *(c for c in names if c != body))).alias("m_row"))
    return once.unionByName(first.select(*(F.col("m_row")[c].alias(c) for c in names))).toDF(*docs.columns)
