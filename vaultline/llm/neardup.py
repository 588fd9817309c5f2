"""Embedding near-duplicates by collision-counting projections (operator 8).

Vectors are centred and projected on many random lines.  A table combines
``sides`` lines, of which only the side of the mean counts (its cell), with
one more line on which the vectors of a cell are sorted; two vectors collide
in the table if they share the cell and each lies in the window centred at
the other.  Collisions are counted over all tables, pairs with at least
``least`` of them are verified by their cosine.  Tables and count are
calibrated on a bounded sample, so that pairs at the limit are found with the
wanted recall; every vector is indexed.

Equal vectors collapse first.  Vectors do not travel to every table: ids,
sorting values and a sketch of ``MARKS`` signs do, and of these the rows stay
that hold a partner in their window whose sketch differs in few enough bits
for a pair at the limit (calibrated too).  Only such rows fetch their vector.
A pair is handled in the first table in which it collides: the rows there
recompute their cells in all tables, so nothing but counts and a few links
leaves a task, however large a group of near copies is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb, erf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.components import components, local_roots

CELL = 16  # distinct vectors that a cell aims at
BLOCK = 2048  # vectors of one cell that meet in one task group
MARKS = 128  # signs of a sketch, two 64-bit words
MARK_MISS = 0.0005  # share of the pairs at the limit that sketches may cost
_PAIRS = 1 << 16
_SLACK = 1e-4  # sorting values travel in single precision
_KEYS = ["d", "t", "cell", "block"]


@dataclass(frozen=True)
class Tables:
    """Random lines of one dimension, and the calibrated numbers."""

    lines: np.ndarray  # (dimension, tables * (sides + 1))
    cut: np.ndarray  # projections of the mean
    tables: int
    sides: int
    window: float  # half width
    least: int
    marks: np.ndarray  # (dimension, MARKS)
    mark_cut: np.ndarray
    differ: int  # sketches of a pair differ in at most this many bits

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and sorting value of each vector in each table."""
        h = (x @ self.lines - self.cut).reshape(len(x), self.tables, self.sides + 1)
        bits = (h[:, :, : self.sides] > 0) @ (1 << np.arange(self.sides, dtype=np.int64))
        return bits, h[:, :, self.sides]

    def sketch(self, x: np.ndarray) -> np.ndarray:
        """(vectors, 2) words of the signs on the sketch's lines."""
        return np.packbits(x @ self.marks > self.mark_cut, axis=1).view(np.int64)


def _lines(dimension: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dimension]).standard_normal((dimension, count))


def _collide(x: np.ndarray, y: np.ndarray, mean: np.ndarray, window: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each pair, the chance to be on one side of a random line through the
    mean, and to be within the window on another; both are exact."""
    a, b = x - mean, y - mean
    long = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
    angle = np.arccos(np.clip(np.divide((a * b).sum(axis=1), long, out=np.zeros(len(x)), where=long > 1e-12), -1, 1))
    apart = np.maximum(np.linalg.norm(x - y, axis=1), 1e-12)
    return 1 - angle / np.pi, np.array([erf(window / (np.sqrt(2) * v)) for v in apart])


def _partners(sample: np.ndarray, mean: np.ndarray, cosine: float, seed: int) -> list[np.ndarray]:
    """Partners of the sample at the limit: in a random direction, and (off
    centre these are the harder ones) as far along the mean as the vector
    itself; where that is nearer than the limit, the one opposite."""
    noise = np.random.default_rng(seed).standard_normal(sample.shape)

    def across(v: np.ndarray, *axes: np.ndarray) -> np.ndarray:
        for axis in axes:
            v = v - (v * axis).sum(axis=1, keepdims=True) * axis
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        return np.divide(v, norm, out=np.zeros_like(v), where=norm > 1e-9)

    free = across(noise, sample)
    out = [np.where(free.any(axis=1, keepdims=True), cosine * sample + np.sqrt(1 - cosine**2) * free, sample)]
    size = np.linalg.norm(mean)
    if size > 1e-9 and sample.shape[1] > 2:
        axis = np.broadcast_to(mean / size, sample.shape)
        along = (sample * axis).sum(axis=1, keepdims=True)
        rest = np.sqrt(np.maximum(1 - along**2, 1e-12))
        own = across(sample, axis)
        turn = np.clip((cosine - along**2) / rest**2, -1, 1)
        out.append(along * axis + rest * (turn * own + np.sqrt(1 - turn**2) * across(noise, axis, own)))
    return out


def calibrate(sample: np.ndarray, mean: np.ndarray, total: int, cosine: float, recall: float, seed: int, window: float = 1.0, most: int = 512) -> Tables:
    """Tables for ``total`` vectors of the sample's kind.

    Each sample vector gets partners at exactly the limit; the chance that a
    table makes the harder of them collide is known exactly, and gives the
    number of tables with which two collisions reach ``recall`` on the average
    of the sample (one collision where even ``most`` tables do not), and then
    the largest count that still does.  Where ``most`` tables are too few, the
    cells get larger, side by side, until they reach it; a recall that no cell
    size reaches is an error."""
    d = sample.shape[1]
    if len(sample):
        # of each vector by itself: where vectors crowd, pairs at the limit collide less often
        chances = [_collide(sample, partner, mean, window) for partner in _partners(sample, mean, cosine, seed)]
    else:
        chances = [(np.full(1, 0.9), np.full(1, 0.9))]

    def reached(sides: int, t: int, least: int) -> bool:
        p = np.clip(np.min([side**sides * near for side, near in chances], axis=0), 0, 1 - 1e-9)
        miss, term = np.zeros(len(p)), (1 - p) ** t
        for k in range(least):
            miss += term
            term = term * ((t - k) / (k + 1)) * p / (1 - p)
        return float((1 - miss).mean()) >= recall

    top = int(np.clip(np.log2(max(total, 1) / CELL), 0, 40))
    fits = next(((s, k) for s in range(top, -1, -1) for k in (2, 1) if most >= k and reached(s, most, k)), None)
    if fits is None:
        raise ValueError(f"a recall of {recall} at cosine {cosine} needs more than {most} tables")
    sides, least = fits
    tables = next(t for t in range(least, most + 1) if reached(sides, t, least))
    least = max(k for k in range(1, 9) if k <= least or reached(sides, tables, k))
    lines, marks = _lines(d, tables * (sides + 1), seed), _lines(d, MARKS, seed + 1)
    return Tables(lines, mean @ lines, tables, sides, window, least, marks, mean @ marks, _differ(np.min([side for side, _ in chances], axis=0)))


def _differ(side: np.ndarray) -> int:
    """The number of bits within which the sketches of all but ``MARK_MISS`` of
    the pairs differ; ``side``: the chance of a pair to agree in one bit."""
    within = 0.0
    for bits in range(MARKS + 1):
        within += float(np.mean(comb(MARKS, bits) * (1 - side) ** bits * side ** (MARKS - bits)))
        if within >= 1 - MARK_MISS:
            return bits
    return MARKS


def _usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    x = lambda v: v.cast("double")
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(x(v)) & (F.abs(x(v)) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda v: v != 0), F.lit(False))


def unit_rows(values: pa.Array, d: int) -> np.ndarray:
    """Vectors of one dimension, in double precision and of length 1."""
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), d)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)  # else squares may overflow
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _groups(table: pa.Table) -> np.ndarray:
    """Number of each row's (dimension, table, cell, block), rows in key order."""
    key = np.stack([table[n].to_numpy().astype(np.int64) for n in _KEYS])
    return np.cumsum(np.append(False, (np.diff(key) != 0).any(axis=0)))


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of complete groups from the sorted rows of a partition."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size < 4 * BLOCK:
            continue
        table = pa.Table.from_batches(held)
        ends = np.flatnonzero(np.diff(_groups(table)))
        if not len(ends):
            continue
        cut = int(ends[-1]) + 1
        yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        size = table.num_rows - cut
    if size:
        yield pa.Table.from_batches(held)


def _hopeful(table: pa.Table, t: dict[int, Tables]) -> np.ndarray:
    """Of each row, whether one in its window may be its partner by the sketch."""
    group, own = _groups(table), table["own"].to_numpy()
    order = np.lexsort((own, group))
    g, own = group[order], own[order].astype(np.float64)
    d, p, b = (table[n].to_numpy()[order] for n in ("d", "part", "block"))
    m0, m1 = (table[n].to_numpy()[order].view(np.uint64) for n in ("m0", "m1"))
    dims, at = np.unique(d, return_inverse=True)
    window = np.array([t[int(v)].window + _SLACK for v in dims])[at]
    differ = np.array([t[int(v)].differ for v in dims])[at]
    near = np.zeros(len(g), bool)
    alive, step = np.flatnonzero(np.append(g[1:] == g[:-1], False)), 1
    while len(alive):  # row i meets row i + step while that lies in its window
        alive = alive[alive + step < len(g)]
        alive = alive[(g[alive] == g[alive + step]) & (own[alive + step] - own[alive] <= window[alive])]
        i = alive[_meets(b[alive], p[alive], p[alive + step])]
        j = i + step
        close = np.bitwise_count(m0[i] ^ m0[j]) + np.bitwise_count(m1[i] ^ m1[j]) <= differ[i]
        near[i[close]] = near[j[close]] = True
        step += 1
    out = np.empty(len(g), bool)
    out[order] = near
    return out


def _meets(block: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Blocks (a, b) of a large cell compare part a with part b, and (a, a) within it."""
    return (block == 0) | (p != q) | (block % (1 << 31) == block >> 31)


def _spread(table: pa.Table, t: dict[int, Tables], cosine: float) -> Iterator[pa.RecordBatch]:
    """Links of the complete (dimension, table, cell, block) groups of a
    partition; see ``near_links``."""
    d, tab, pair = (table[n].to_numpy() for n in ("d", "t", "block"))
    group = _groups(table)
    rep, n, part = table["rep"].to_numpy(), table["n"].to_numpy(), table["part"].to_numpy()
    vec = table["vec"].combine_chunks()
    for dim in np.unique(d):
        at = np.flatnonzero(d == dim)
        x = unit_rows(vec.take(pa.array(at)), int(dim))
        spec = t[int(dim)]
        cells, h = spec.cells(x)
        tt, own = tab[at], h[np.arange(len(at)), tab[at]]
        order = np.lexsort((own, group[at]))
        x, cells, h, tt, own = x[order], cells[order], h[order], tt[order], own[order]
        g, r, m, p, b = group[at][order], rep[at][order], n[at][order], part[at][order], pair[at][order]
        last = np.append(g[1:] != g[:-1], True)
        links, roots = np.zeros(len(g), np.int64), np.arange(len(g))
        alive, step = np.flatnonzero(~last), 1
        while len(alive):  # row i meets row i + step while that lies in its window
            alive = alive[alive + step < len(g)]
            alive = alive[(g[alive] == g[alive + step]) & (own[alive + step] - own[alive] <= spec.window)]
            for k in range(0, len(alive), _PAIRS):
                i = alive[k : k + _PAIRS]
                j = i + step
                meets = _meets(b[i], p[i], p[j])
                i, j = i[meets], j[meets]
                hits = (cells[i] == cells[j]) & (np.abs(h[i] - h[j]) <= spec.window)
                mine = (hits.argmax(axis=1) == tt[i]) & (hits.sum(axis=1) >= spec.least)
                i, j = i[mine], j[mine]
                ok = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
                i, j = i[ok], j[ok]
                np.add.at(links, i, m[j])
                np.add.at(links, j, m[i])
                more = roots[i] != roots[j]
                if more.any():
                    roots = local_roots(roots[i[more]], roots[j[more]], len(g))[roots]
            step += 1
        on = np.flatnonzero((links > 0) | (roots != np.arange(len(g))))
        if len(on):
            cols = [pa.array(r[on]), pa.array(r[roots[on]]), pa.array(links[on])]
            yield pa.RecordBatch.from_arrays(cols, names=["src", "dst", "links"])


def near_links(classes: DataFrame, spec: dict[int, Tables], cosine: float = 0.9) -> DataFrame:
    """(src, dst, links): ``dst`` is in the component of ``src``; the links of
    a class add up over the rows.  ``classes``: (rep, n, vec), distinct usable
    vectors.

    Cells with more than BLOCK rows are dealt out by a hash into parts; every
    two parts meet in a block of their own."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                b = batch.slice(begin, 1024)
                d = np.array([len(v) for v in b.column(1)])
                for dim in np.unique(d):
                    at = pa.array(np.flatnonzero(d == dim))
                    x, rep = unit_rows(b.column(1).take(at), int(dim)), b.column(0).take(at)
                    cells, own = spec[int(dim)].cells(x)
                    m0, m1 = (pa.array(m) for m in spec[int(dim)].sketch(x).T)
                    for t in range(cells.shape[1]):
                        key = [pa.array(np.full(len(at), v, np.int32)) for v in (dim, t)]
                        cols = [*key, pa.array(cells[:, t]), rep, pa.array(own[:, t].astype(np.float32)), m0, m1]
                        yield pa.RecordBatch.from_arrays(cols, names=["d", "t", "cell", "rep", "own", "m0", "m1"])

    rows = classes.select("rep", "vec").mapInArrow(deal, "d int, t int, cell long, rep long, own float, m0 long, m1 long")
    # cells over BLOCK, from keys alone; at most tables * vectors / BLOCK of them
    large = rows.groupBy("d", "t", "cell").count().where(F.col("count") > BLOCK)
    large = large.select(F.col("d").alias("l_d"), F.col("t").alias("l_t"), F.col("cell").alias("l_cell"), F.ceil(F.col("count") / BLOCK).cast("int").alias("parts"))
    large = large.checkpoint()
    slim = ["rep", "own", "m0", "m1"]
    if large.isEmpty():  # no cell to split: spare the rows a shuffle
        dealt = rows.select("d", "t", "cell", F.lit(0).cast("long").alias("block"), F.lit(0).alias("part"), *slim)
    else:
        both = rows.join(large, (rows["d"] == large["l_d"]) & (rows["t"] == large["l_t"]) & (rows["cell"] == large["l_cell"]), "left")
        both = both.withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("rep"), F.col("parts"))).cast("int"))
        meets = lambda k: F.struct(F.least(k, F.col("part") + 1).cast("long").alias("a"), F.greatest(k, F.col("part") + 1).cast("long").alias("b"))
        pairs = F.transform(F.transform(F.sequence(F.lit(1), F.col("parts")), meets), lambda s: s["a"] * (1 << 31) + s["b"])
        blocks = F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pairs)
        dealt = both.select("d", "t", "cell", F.explode(blocks).alias("block"), "part", *slim)

    def hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            yield from table.select([*_KEYS, "part", "rep"]).filter(pa.array(_hopeful(table, spec))).to_batches()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            yield from _spread(table, spec, cosine)

    grouped = lambda df: df.repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    some = grouped(dealt).mapInArrow(hopeful, "d int, t int, cell long, block long, part int, rep long")
    some = some.withColumnRenamed("rep", "s_rep")
    full = some.join(classes, some["s_rep"] == classes["rep"]).select(*_KEYS, "part", "rep", "n", "vec")
    return grouped(full).mapInArrow(meet, "src long, dst long, links long")


def embedding_components(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = 0.9, recall: float = 0.97, sample: int = 2000, seed: int = 7,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row.

    Links join different rows whose vectors have a cosine of at least
    ``cosine``, computed in double precision; found with about ``recall`` or
    more at the limit itself, nearer pairs more surely, and never below the
    limit.  Vectors that are null, zero, or hold null or non-finite components
    link with nothing; vectors of different length do not link.  Equal vectors
    are one class and need no pairs.  The sample that calibrates is bounded by
    ``sample`` for each length.  Rows need distinct ids; a null id is passed
    over as a component's name.  An empty table gives an empty result."""
    src = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vec"))
    good = src.where(_usable(F.col("vec")))
    classes = good.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")).where("rep is not null").checkpoint()
    spec = {}
    for row in classes.groupBy(F.size("vec").alias("d")).count().collect():  # one row for each length
        d = row["d"]
        one = classes.where(F.size("vec") == d)
        picked = one.orderBy(F.xxhash64("rep")).limit(sample).select("vec").collect()
        x = unit_rows(pa.array([r["vec"] for r in picked], pa.list_(pa.float64())), d)
        spec[d] = calibrate(x, _mean(one, d), row["count"], cosine, recall, seed)
    if not spec:
        links = src.select(F.col("vec_id").alias("src"), F.col("vec_id").alias("dst"), F.lit(0).cast("long").alias("links")).limit(0)
    else:
        links = near_links(classes, spec, cosine).groupBy("src", "dst").agg(F.sum("links").alias("links")).checkpoint()
    counts = links.groupBy(F.col("src").alias("k_rep")).agg(F.sum("links").alias("links"))
    roots = components(links)
    done = classes.join(counts, classes["rep"] == counts["k_rep"], "left").join(roots, classes["rep"] == roots["node"], "left")
    done = done.select(F.col("vec").alias("c_vec"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("c_links"), F.coalesce("root", "rep").alias("c_root"))
    out = src.join(done, _usable(src["vec"]) & (src["vec"] == done["c_vec"]), "left")
    root = F.coalesce("c_root", "vec_id")
    return out.select("vec_id", F.coalesce("c_links", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"), (F.col("vec_id") == root).alias("kept"))


def _mean(classes: DataFrame, d: int) -> np.ndarray:
    """Mean direction of all classes; tasks send one sum each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d), 0
        for b in batches:
            if b.num_rows:
                total += unit_rows(b.column(0), d).sum(axis=0)
                n += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array(np.append(total, n))], names=["at", "v"])

    sums = classes.select("vec").mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    got = {r["at"]: r["v"] for r in sums}
    return np.array([got[i] for i in range(d)]) / max(got[d], 1.0)
