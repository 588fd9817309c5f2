"""Line dedup by range-partitioned hashes (operator 13).

Each line that counts becomes a row (hash, document, place).  The rows are
dealt out by ranges of hash and document and sorted by document and place
within a hash, so one stream over a partition sees the first occurrence of
every hash before all others.  A hash that stands in a third of all documents
spans many partitions; the first document of a hash that begins in an earlier
partition comes from a summary of one row for each partition.  What goes back
to the documents is a compressed bitmap of the lines to keep, not text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import by_size, renamed

_LOWER = bytes(range(256)).lower()
_STRIP = " \t\n\r\x0b\f"
_ORDER = ["hi", "lo", "none", "doc", "row", "place"]


def line_key(line: str, least_chars: int) -> bytes | None:
    """What lines are compared by: stripped, A-Z lowered; None if too short."""
    line = line.strip(_STRIP)
    return line.encode().translate(_LOWER) if len(line) >= least_chars else None


def pack_bits(keep: np.ndarray) -> bytes:
    """A bitmap of lines, compressed: the runs of equal bits of common texts take a few bytes."""
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes())


def unpack_bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=n, bitorder="little").astype(bool)


def apply_bitmap(text: str | None, packed: bytes | None) -> str:
    """The kept lines of a text joined by line ends (no bitmap: all)."""
    if packed is None:
        return text or ""
    parts = (text or "").split("\n")
    return "\n".join(p for p, k in zip(parts, unpack_bits(packed, len(parts)), strict=True) if k)


def line_rows(docs: DataFrame, doc_id: str, text: str, least_chars: int) -> DataFrame:
    """(hi, lo, none, doc, row, place, n_lines) of every line that counts;
    ``row`` is the hash of the whole text: rows of one id with other texts are
    told apart by it."""
    key = F.col(doc_id)
    src = docs.select(key.isNull().alias("none"), key.alias("doc"), F.xxhash64(text).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in by_size(batches, "text"):
            row, place, count, keys = [], [], [], []
            for k, t in enumerate(b.column(3).to_pylist()):
                parts = t.split("\n")
                for p, line in enumerate(parts):
                    found = line_key(line, least_chars)
                    if found is not None:
                        row.append(k)
                        place.append(p)
                        count.append(len(parts))
                        keys.append(xxhash.xxh3_128_digest(found))
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            at = pa.array(row, pa.int64())
            cols = [pa.array(halves[:, 0]), pa.array(halves[:, 1]), *(b.column(i).take(at) for i in range(3)), pa.array(place, pa.int32()), pa.array(count, pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=[*_ORDER, "n_lines"])

    return src.mapInArrow(run, f"hi long, lo long, none boolean, doc {src.schema['doc'].dataType.simpleString()}, row long, place int, n_lines int")


def _starts(b: pa.RecordBatch, last: tuple[int, int] | None) -> np.ndarray:
    """Whether a row of a sorted batch begins a hash; ``last``: the hash before."""
    hi, lo = b.column(0).to_numpy(), b.column(1).to_numpy()
    begins = np.empty(len(hi), bool)
    begins[0] = last is None or (int(hi[0]), int(lo[0])) != last
    begins[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
    return begins


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for a partition: its first and last hash, and the first document of the last hash."""
    first = last = holder = part = None
    for b in batches:
        if not b.num_rows:
            continue
        begins = _starts(b, last)
        if first is None:
            first, part = (b.column(0)[0].as_py(), b.column(1)[0].as_py()), b.column(3)[0].as_py()
        if begins.any():
            holder = b.column(2).slice(int(np.flatnonzero(begins)[-1]), 1)
        last = (b.column(0)[-1].as_py(), b.column(1)[-1].as_py())
    if first is not None:
        cols = [pa.array([v], pa.int64()) for v in (part, *first, *last)]
        yield pa.RecordBatch.from_arrays([*cols, holder], names=["part", "f_hi", "f_lo", "l_hi", "l_lo", "doc"])


def _carried(summaries: list) -> dict[int, tuple[int, int, Any]]:
    """For a partition that begins inside a hash: that hash and its first document."""
    out: dict[int, tuple[int, int, Any]] = {}
    before = None  # the last hash so far, and its first document
    for s in sorted(summaries, key=lambda s: s["part"]):
        first, last = (s["f_hi"], s["f_lo"]), (s["l_hi"], s["l_lo"])
        if before is not None and before[0] == first:
            out[s["part"]] = (*first, before[1])
            if last != first:
                before = (last, s["doc"])
        else:
            before = (last, s["doc"])
    return out


def _later(batches: Iterator[pa.RecordBatch], carried: dict[int, tuple[int, int, Any]]) -> Iterator[pa.RecordBatch]:
    """Rows whose hash an earlier document holds, streamed in order; the
    places of one text within a batch come as one row."""
    last = holder = None
    begun = False
    for b in batches:
        if not b.num_rows:
            continue
        doc, row = b.column(3), b.column(4)
        if not begun:
            begun = True
            got = carried.get(b.column(7)[0].as_py())
            if got is not None:
                last, holder = got[:2], pa.array([got[2]], doc.type)
        begins = _starts(b, last)
        # the document that holds a row's hash first, as a place in (carried one, documents of the batch)
        here = np.maximum.accumulate(np.where(begins, np.arange(1, b.num_rows + 1), 0))
        docs = pa.concat_arrays([holder if holder is not None else pa.nulls(1, doc.type), doc])
        firsts = docs.take(pa.array(here))
        same = pc.or_kleene(pc.fill_null(pc.equal(firsts, doc), False), pc.and_(pc.is_null(firsts), pc.is_null(doc)))
        last, holder = (b.column(0)[-1].as_py(), b.column(1)[-1].as_py()), firsts.slice(b.num_rows - 1, 1)
        gone = b.filter(pc.invert(same))
        if gone.num_rows:
            t = pa.Table.from_batches([gone]).select(["doc", "row", "n_lines", "place"])
            t = t.group_by(["doc", "row", "n_lines"]).aggregate([("place", "list")])
            yield from t.select(["doc", "row", "n_lines", "place_list"]).rename_columns(["doc", "row", "n_lines", "places"]).combine_chunks().to_batches()


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each text, of rows sorted by text: its bitmap."""
    key, keep = None, None

    def done() -> pa.RecordBatch:
        cols = [key[1], key[2], pa.array([int((~keep).sum())], pa.int64()), pa.array([pack_bits(keep)], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=["doc", "row", "n_dropped", "bitmap"])

    held: list[pa.RecordBatch] = []
    for b in batches:
        docs, rows, sizes, places = (b.column(i).to_pylist() for i in range(4))
        for k in range(b.num_rows):
            now = (docs[k], rows[k])
            if key is None or now != key[0]:
                if key is not None:
                    held.append(done())
                key, keep = (now, b.column(0).slice(k, 1), b.column(1).slice(k, 1)), np.ones(sizes[k], bool)
            keep[places[k]] = False
        if len(held) > 1000:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if key is not None:
        held.append(done())
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def line_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = 10) -> DataFrame:
    """(doc, row, n_dropped, bitmap) of every text that loses lines: its id,
    the hash (xxhash64) of the text, the lines that go, and a compressed bitmap
    (``unpack_bits``) of those that stay.

    Lines are compared stripped and with A-Z lowered; keys under
    ``least_chars`` code points never go.  Of the documents that hold a key the
    one with the smallest id keeps all its lines, the others lose theirs.
    Documents are told apart by id: rows that share an id, and rows without one
    (they rank last), are one document, so they take nothing from each other;
    equal rows have one bitmap.  Null and empty texts are one empty line and
    lose nothing; very long texts are cut into lines like any other; an empty
    table gives an empty result; other columns are not read.
    """
    src, at = renamed(docs)
    rows = line_rows(src, at[doc_id], at[text], least_chars).checkpoint()
    ranged = rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER).withColumn("part", F.spark_partition_id().cast("long"))
    ranged = ranged.select("hi", "lo", "none", "doc", "row", "place", "n_lines", "part").checkpoint()
    kind = rows.schema["doc"].dataType.simpleString()
    heads = ranged.select("hi", "lo", "doc", "part").mapInArrow(_summaries, f"part long, f_hi long, f_lo long, l_hi long, l_lo long, doc {kind}")
    carried = _carried(heads.collect())  # one row for each partition
    later = ranged.mapInArrow(lambda it: _later(it, carried), f"doc {kind}, row long, n_lines int, places array<int>")
    texts = later.repartition("doc", "row").sortWithinPartitions("doc", "row")
    return texts.mapInArrow(_bitmaps, f"doc {kind}, row long, n_dropped long, bitmap binary")


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = 10) -> DataFrame:
    """All columns of ``docs``, then ``n_lines``, ``n_dropped`` (longs) and
    ``keep`` (bitmap; null: all lines stay), by the rules of ``line_bitmaps``.
    Columns of the table with these names come as ``in_...``."""
    src, at = renamed(docs)
    key, body = at[doc_id], at[text]
    marks = line_bitmaps(src, key, body, least_chars).withColumnsRenamed({"doc": "m_doc", "row": "m_row"})
    joined = src.join(marks, F.col(key).eqNullSafe(F.col("m_doc")) & (F.xxhash64(body) == F.col("m_row")), "left")
    count = F.coalesce(F.length(body) - F.length(F.replace(F.col(body), F.lit("\n"), F.lit(""))), F.lit(0)) + F.lit(1)
    out = joined.select(*src.columns, count.cast("long"), F.coalesce("n_dropped", F.lit(0).cast("long")), "bitmap")
    own = ("n_lines", "n_dropped", "keep")
    return out.toDF(*(f"in_{c}" if c in own else c for c in docs.columns), *own)


def kept_digest(docs: DataFrame, text: str, keep: str, out: str = "kept_sha256") -> DataFrame:
    """``docs`` without the two columns, and the sha256 of the kept lines."""
    from hashlib import sha256

    names = [c for c in docs.columns if c not in (text, keep)]
    src = docs.select(*names, text, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, text):
            pairs = zip(b.column(len(names)).to_pylist(), b.column(len(names) + 1).to_pylist(), strict=True)
            found = [sha256(apply_bitmap(t, k).encode()).hexdigest() for t, k in pairs]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(found, pa.string())], names=[*names, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.select(*names).schema.fields)
    return src.mapInArrow(run, f"{fields}, {out} string")
