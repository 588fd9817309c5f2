"""Best-fit packing by minimum bin slack (operator 9).

Documents become token pieces of at most ``capacity`` ids.  What has to be
decided depends only on how many pieces there are of each length, a table of
at most ``capacity`` rows whatever the data: minimum bin slack fills one bin
by a bitset subset-sum over the available lengths and repeats the found
combination as long as its lengths last, which gives a schedule of a few
thousand rows at most.  The pieces of each length are numbered by running
totals over hash buckets, and each looks up its bin and offset by its number.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import by_size, text_bytes

CAPACITY = 2048
END_ID = 0
PIECE = "doc_id {id}, piece int, start long, length long, ids_crc32 long"
BUCKETS = 1 << 12
_CACHE = 96 << 20  # bytes of words and ids that a worker keeps at hand; the result does not depend on it
_ENTRY = 150  # bytes that a cached word takes besides its own and its ids
#: ASCII punctuation that forms a token apart from the letters before it (an apostrophe may not)
_TAIL = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27)


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabet: printable Latin-1 characters stand for themselves,
    the other bytes for the code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: 256 + k for k, b in enumerate(rest)}


class WordIds(dict):
    """Ids of a white-space-free word as uint32 bytes, found on first use.

    Letters below U+0250 with punctuation behind them go straight to the
    tokenizer's own model, lower-cased and in its byte-level alphabet; any
    other word goes through the whole tokenizer.  When the words fill half the
    cache they become the old ones, and those before go: a word in use comes
    back from the old ones, rare ones are forgotten."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.letters, self.tails = tokenizer, tokenizer.model, _byte_letters(), {b"": b""}
        self.size, self.old = 0, {}

    def whole(self, word: bytes) -> bytes:
        return np.asarray(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids, np.uint32).tobytes()

    def letters_only(self, name: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(name)]).tobytes()

    def end(self, tail: bytes) -> bytes:
        if tail not in self.tails:
            self.tails[tail] = self.whole(tail)
        return self.tails[tail]

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is not None:
            return self.keep(word, ids)
        core = word.rstrip(_TAIL).lower()  # ASCII only
        tail = word[len(core) :]
        known = (self.get(core) or self.old.get(core)) if tail and core[-1:].isalnum() else None  # an ASCII letter or digit ends a token here
        if known is not None:
            ids = known + self.end(tail)
        elif core.isalpha():
            ids = self.letters_only(core.decode()) + self.end(tail)
        else:
            name = core.decode().lower()
            if name.isalpha() and max(name) < "\u0250":
                ids = self.letters_only(name.encode().decode("latin-1").translate(self.letters)) + self.end(tail)
            else:
                return self.keep(word, self.whole(word))
        if tail:
            self.keep(core, ids[: len(ids) - len(self.end(tail))])
        return self.keep(word, ids)

    def keep(self, word: bytes, ids: bytes) -> bytes:
        if self.size >= _CACHE // 2:
            self.old = dict(self)
            self.clear()
            self.tails, self.size = {b"": b""}, 0
        self.size += len(word) + len(ids) + _ENTRY
        self[word] = ids
        return ids


def _worker_words(content: str) -> WordIds:
    """The words of this Python worker, which runs many tasks one by one."""
    import sys
    import types

    held = sys.modules.setdefault("_vaultline_worker", types.ModuleType("_vaultline_worker")).__dict__.setdefault("words", {})
    key = crc32(content.encode())
    if key not in held:
        from tokenizers import Tokenizer

        held[key] = WordIds(Tokenizer.from_str(content))
    return held[key]


def document_ids(text: bytes, words: WordIds) -> np.ndarray:
    """Token ids of a text, then the end id.  The tokenizer splits at white
    space before anything else, so a text's ids are its words' ids in turn."""
    return np.frombuffer(b"".join(map(words.__getitem__, text.split())) + _END, np.uint32)


_END = np.array([END_ID], np.uint32).tobytes()


def tokenizer_json(path: str | None = None) -> str:
    """Content of a tokenizer file, the public word BPE by default."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def token_pieces(docs: DataFrame, tokenizer_json: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: ``doc_id``, piece, start, length,
    ids_crc32 (of the ids as little-endian unsigned 32 bits) and, if asked
    for, the ids themselves.

    ``tokenizer_json``: content of a tokenizer file whose words end at white
    space.  A document is its text's ids and then id 0; null and empty texts
    are just that id.  Only longer documents are cut.  Every row is taken by
    itself, equal ids too; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # a file of fixed size
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _worker_words(held.value)
        for b in by_size(batches, "text"):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, one in enumerate(text_bytes(b.column(1))):
                got = document_ids(one, words)
                for p, at in enumerate(range(0, len(got), capacity)):
                    cut = got[at : at + capacity]
                    row.append(k)
                    piece.append(p)
                    start.append(at)
                    length.append(len(cut))
                    crc.append(crc32(cut.tobytes()))
                    if with_ids:
                        ids.append(cut.astype(np.int32))
            arrays = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return src.mapInArrow(run, PIECE.format(id=id_type) + (", ids array<int>" if with_ids else ""))


def fullest(available: dict[int, int], capacity: int) -> Counter:
    """The fullest combination of available lengths within ``capacity`` that
    holds the longest of them (minimum bin slack with a fixed first item).

    Bit s of ``reach`` tells whether some combination of the lengths so far
    sums to s; lengths come in descending order, and the search stops as soon
    as the capacity itself is reached, so that long pieces go first."""
    first = max(available)
    room = capacity - first
    chosen = Counter({first: 1})
    mask, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []  # (length, copies in this step, sums reached before)
    for length in sorted((x for x in available if x <= room), reverse=True):
        left = min(available[length] - (length == first), room // length)
        size = 1
        while left > 0 and not reach >> room & 1:
            take = min(size, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left -= take
            size *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] += take
    return chosen


def schedule(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, dict[int, int]]]:
    """Bins for ``counts`` pieces of each length: (first bin, bins, pieces of
    each length in one such bin).

    Every combination is repeated while all its lengths last; the length that
    ends it falls to less than it needs, at most half of what one more bin
    could use, so there are at most about 2.5 x ``capacity`` combinations,
    whatever the number of pieces."""
    left, out, bins = {k: v for k, v in counts.items() if v > 0}, [], 0
    while left:
        combo = fullest(left, capacity)
        times = min(left[k] // v for k, v in combo.items())
        out.append((bins, times, dict(combo)))
        bins += times
        for k, v in combo.items():
            left[k] -= v * times
            if not left[k]:
                del left[k]
    return out


def _lookup(plan: list[tuple[int, int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """For the pieces of each length, numbered from 0: from which number on
    which combination holds them.  Sorted by (length, number)."""
    used: Counter = Counter()
    rows = []
    for first, times, combo in plan:
        at = 0
        for length in sorted(combo, reverse=True):
            rows.append((length, used[length], first, combo[length], at))
            used[length] += times * combo[length]
            at += length * combo[length]
    rows.sort()
    names = ("length", "number", "bin", "each", "at")
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(names)}


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with ``length`` (1 to ``capacity``).

    ``pieces`` is read twice, so let it be a checkpoint or a table.  Its other
    columns pass through; sequence ids run from 0, offsets are gapless from 0.
    The driver gets one row for each length.  Equal rows take each other's
    places.  An empty table gives an empty result."""
    counts = {int(r["length"]): int(r["count"]) for r in pieces.groupBy("length").count().collect()}
    if any(not 0 < x <= capacity for x in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    table = _lookup(schedule(counts, capacity))

    # number the pieces of each length: running totals over buckets, then within a bucket
    names = [c for c in pieces.columns if c != "length"]
    rows = pieces.select("length", *names).withColumn("__bucket", F.pmod(F.xxhash64(*names) if names else F.lit(0), F.lit(BUCKETS)).cast("int"))
    sums = rows.groupBy("length", "__bucket").count()
    base = sums.select("length", "__bucket", (F.sum("count").over(Window.partitionBy("length").orderBy("__bucket")) - F.col("count")).alias("__base"))
    inside = Window.partitionBy("length", "__bucket").orderBy(*(names or ["length"]))
    numbered = rows.join(base, ["length", "__bucket"]).withColumn("__number", F.col("__base") + F.row_number().over(inside) - 1)
    numbered = numbered.select(*pieces.columns, "__number")
    shift = 44  # numbers stay below 2^44, lengths below 2^19

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (table["length"] << shift) | table["number"]
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            number = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            k = np.searchsorted(keys, (length << shift) | number, side="right") - 1
            nth, slot = np.divmod(number - table["number"][k], table["each"][k])
            more = [pa.array(table["bin"][k] + nth), pa.array(table["at"][k] + slot * length)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *more], names=[*b.schema.names[:-1], "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return numbered.mapInArrow(place, fields + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_json: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack; the pieces are kept in the checkpoint folder
    between, so that texts are tokenized once."""
    return pack_pieces(token_pieces(docs, tokenizer_json, doc_id, text, capacity, with_ids).checkpoint(), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences (sequence_id, ids) of rows with ids; a sequence is
    at most ``capacity`` tokens, so its rows are few."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"))
