"""Substring dedup by line or paragraph hashing (operator 7).

Texts are cut into lines (as a whole, or further at sentence ends, since prose
wraps a passage in other lines wherever it stands, or at clause ends, since a
passage may begin and end inside a sentence) or paragraphs, each unit is normalised (A-Z in lower case,
white space made one space) and hashed to 128 bits.  Digests are grouped
globally; of each the earliest occurrence stays, ranked by document id, then
by place.  All others are removed, with their offsets in the original text
retained.  Only digests and places are shuffled; texts move once, to the
removals of their document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import by_size, renamed

_LOWER = bytes(range(256)).lower()
#: line ends, these and the white space behind a sentence, or runs of white space that hold two line ends
_BREAKS = {
    "line": re.compile(r"\n"),
    "sentence": re.compile(r"\n|(?<=[.!?])[ \t\r\x0b\f]+"),
    "clause": re.compile(r"\n|(?<=[.!?,;:])[ \t\r\x0b\f]+"),
    "paragraph": re.compile(r"\n[ \t\r\x0b\f]*\n\s*"),
}
#: with ``least_run``, units of fewer words go with their neighbours
LEAST_UNIT = 3


def units(text: str, unit: str = "line") -> list[tuple[int, int]]:
    """(start, end) of each unit in code points, without its break."""
    out, at = [], 0
    for m in _BREAKS[unit].finditer(text):
        out.append((at, m.start()))
        at = m.end()
    out.append((at, len(text)))
    return out


def digest(unit: str, least_words: int) -> bytes | None:
    """Hash of the normalised unit; None if it has too few words to count."""
    words = unit.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    return blake2b(b" ".join(words), digest_size=16).digest() if len(words) >= least_words else None


def in_runs(text: str, gone: list[dict], own: list[bool], unit: str, least_words: int, least_run: int) -> list[dict]:
    """Those of the repeated units that go: in runs of units repeated from
    other rows that have ``least_run`` words in all, and in whole sentences of
    ``least_words`` words that the row repeats from itself (``own``); with them
    the units under ``LEAST_UNIT`` words inside."""
    at = {s["start"]: k for k, s in enumerate(gone)}
    out: list[dict] = []
    run: list[dict] = []
    small: list[dict] = []
    words = between = said = 0
    mine = False

    def close(whole: bool = False) -> None:
        nonlocal words, between
        if words >= least_run and not mine or whole and words + between >= least_words:
            out.extend([*run, *small] if mine else run)
        run.clear()
        small.clear()
        words = between = 0

    for a, z in units(text, unit) if gone else []:
        n = len(text[a:z].encode("utf-8", "surrogatepass").split())
        k = at.get(a)
        said += n
        if n < LEAST_UNIT:
            if n and run:
                small.append({"start": a, "end": z, "kept_id": run[-1]["kept_id"]})
                between += n
        elif k is None:
            close()
        else:
            if own[k] != mine:
                close()
                mine = own[k]
            run += [*small, gone[k]]
            words += between + n
            small.clear()
            between = 0
        if text[a:z].endswith((".", "!", "?")) or text[z : z + 1] in ("\n", ""):
            if mine:
                close(whole=words + between == said)
            said = 0
    close()
    return out


def without(text: str, gone: list[tuple[int, int]], unit: str = "line") -> str:
    """The text without the units that begin at the given offsets, each with
    the break behind it (the last one with the break before it); the sentence
    before one that ended its line ends it then."""
    starts = {a for a, _ in gone}
    cut = units(text, unit)
    if not any(a in starts for a, _ in cut):
        return text
    out: list[str] = []  # units and breaks in turn
    for (a, b), (c, _) in zip(cut, [*cut[1:], (len(text), 0)], strict=True):
        if a not in starts:
            out += [text[a:b], text[b:c]]
        elif out and "\n" in text[b:c] and "\n" not in out[-1]:
            out[-1] = text[b:c]
    return "".join(out[:-1])


def unit_rows(docs: DataFrame, doc_id: str, text: str, unit: str, least_words: int) -> DataFrame:
    """(id, hash, start, end, digest) of every unit that counts; ``hash`` is
    that of the whole text."""
    src = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, "text"):
            row, start, end, key = [], [], [], []
            for k, t in enumerate(b.column(2).to_pylist()):
                for a, z in units(t, unit):
                    d = digest(t[a:z], least_words)
                    if d is not None:
                        row.append(k)
                        start.append(a)
                        end.append(z)
                        key.append(d)
            at = pa.array(row, pa.int64())
            cols = [b.column(0).take(at), b.column(1).take(at), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(key, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "hash", "start", "end", "digest"])

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, hash long, start long, end long, digest binary")


def dedup_units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str = "line", least_words: int = 5, least_run: int = 0) -> DataFrame:
    """All columns of ``docs``, the text without repeated units, then
    ``removed`` (array of start, end, kept_id: offsets in the original text,
    and the document that keeps the unit), sorted by start.

    Units under ``least_words`` words are no repeats of anything and stay.
    Documents rank by id, null last, then by the hash of their text; rows that
    share both are ranked one after another, so all but one lose every unit
    that counts.  Null texts stay null and empty ones empty; an empty table
    gives an empty result; a column ``removed`` of the table comes as
    ``in_removed``.  No document is dropped, even if nothing is left of it.
    With ``least_run`` a unit repeated from another row goes only in a run of
    such units of so many words (``in_runs``), and all units of ``LEAST_UNIT``
    words and more are compared.
    """
    src, at = renamed(docs)
    key, body = at[doc_id], at[text]
    rows = unit_rows(src, key, body, unit, LEAST_UNIT if least_run else least_words)
    rows = rows if least_run else rows.checkpoint()  # many small units: cutting again costs less than keeping them
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "hash", "start")
    first = rows.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.col("digest").alias("f_digest"), "first")
    both = rows.join(first, F.col("digest") == F.col("f_digest")).withColumn("is_first", rank.eqNullSafe(F.col("first")))
    own = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("hash") == F.col("first.hash"))
    spans = both.select("id", "hash", F.struct("start", "end", F.col("first.id").alias("kept_id"), "is_first", own.alias("own")).alias("span"))
    # rows of equal id and text: one set here for all, told apart below
    marks = spans.groupBy("id", "hash").agg(F.sort_array(F.collect_set("span")).alias("spans"))
    marks = marks.select(F.col("id").alias("m_id"), F.col("hash").alias("m_hash"), "spans")
    joined = src.join(marks, F.col(key).eqNullSafe(F.col("m_id")) & (F.xxhash64(body) == F.col("m_hash")), "left")
    # which of several equal rows this is; only rows that hold a kept unit need to know
    keeps = F.exists("spans", lambda s: s["is_first"])
    plain = joined.where(F.col("spans").isNull() | ~keeps).withColumn("nth", F.lit(1))
    order = Window.partitionBy("m_id", "m_hash").orderBy(*(c for c in src.columns if c != body))
    holders = joined.where(F.col("spans").isNotNull() & keeps).withColumn("nth", F.row_number().over(order))
    every = plain.unionByName(holders)
    gone = F.filter("spans", lambda s: ~s["is_first"] | (F.col("nth") > 1))
    removed = F.transform(gone, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kept_id"].alias("kept_id")))
    id_type = src.schema[key].dataType.simpleString()
    kind = f"array<struct<start:long,end:long,kept_id:{id_type}>>"
    repeats_itself = F.transform(gone, lambda s: s["own"] & (F.col("nth") == 1))
    repeats_itself = [F.coalesce(repeats_itself, F.array().cast("array<boolean>")).alias("__own")] if least_run else []
    every = every.select(*src.columns, *repeats_itself, F.coalesce(removed, F.array().cast(kind)).cast(kind).alias("removed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, body):
            place, last = b.schema.get_field_index(body), b.num_columns - 1
            texts, spans = b.column(place).to_pylist(), b.column(last).to_pylist()
            if least_run:
                flags = b.column(last - 1).to_pylist()
                spans = [in_runs(t or "", g, o, unit, least_words, least_run) for t, g, o in zip(texts, spans, flags, strict=True)]
            out = [t if t is None or not gone else without(t, [(s["start"], s["end"]) for s in gone], unit) for t, gone in zip(texts, spans, strict=True)]
            cols = [pa.array(out, pa.string()) if k == place else c for k, c in enumerate(b.columns)]
            names = b.schema.names
            if least_run:
                cols[last - 1 :] = [pa.array(spans, b.schema.field(last).type)]
                names = [*names[: last - 1], names[last]]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in every.schema.fields if f.name != "__own")
    names = [f"in_{c}" if c == "removed" else c for c in docs.columns]
    return every.mapInArrow(run, fields).toDF(*names, "removed")
