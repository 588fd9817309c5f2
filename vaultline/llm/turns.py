"""Conversation structure repair by a run-length DP (operator 11).

A conversation's rows become symbols: the role's class (system, user,
assistant, other) and the fault (none, truncated, must go).  Equal consecutive
symbols are one run.  What a symbol does to the cost of each state (nothing
yet, after system, after user, after assistant) is a min-plus matrix; a run
advances the costs by the binary powers of its symbol's matrix, which are
cached.  From the costs to the end the cheapest edits are unrolled, the
ASCII-least where several cost the same.

A conversation may hold a third of all rows, so rows are dealt out by ranges of
(conversation, turn) and a task sees its part of a conversation only.  Parts
that lie in one partition as a whole are repaired there.  Of the others, at
most two for each partition, the task sends one matrix, and then where each
state leads to; put in a row these give every part its first state and the
costs behind it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import renamed

_INF = 1 << 50
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)  # the state that a required row leads to
_OK, _CUT, _GONE = range(3)  # faults: none, truncated, must be deleted
_WORD = r"[^\x20\x09-\x0D]"
_SPACES = " \t\n\r\x0b\f"

Vector = tuple[int, ...]


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5  # added to a truncated row that stays


def _keeps(state: int, role: int) -> int | None:
    """The state after a row of this role class, if it may stand there."""
    if role == 0:
        return _SYSTEM if state == _START else None
    if role == 1:
        return _USER if state != _USER else None
    return _ASSISTANT if role == 2 and state == _USER else None


@dataclass
class Repair:
    """Min-plus steps of one set of costs, with their cached powers.

    A symbol is 3 * role class + fault.  Vectors hold, for each state, the cost
    from there to the end."""

    costs: Costs = field(default_factory=Costs)

    def __post_init__(self) -> None:
        self.power = lru_cache(maxsize=None)(self._power)  # 12 symbols, at most 63 powers
        self.block = lru_cache(maxsize=4096)(self._block)  # strings of at most 1024 edits
        self.whole = lru_cache(maxsize=65536)(self._whole)  # conversations of few runs
        jump = np.full((4, 4), _INF)
        for s in range(4):
            at, paid = s, 0
            for _ in range(4):
                jump[s, at] = min(jump[s, at], paid)
                at, paid = _NEXT[at], paid + self.costs.insert
        self.jump = jump  # inserts before a row, or behind the last one
        self.end: Vector = tuple(int(min(jump[s, _START], jump[s, _ASSISTANT])) for s in range(4))

    def options(self, symbol: int, state: int) -> list[tuple[str, int, int]]:
        """(edit, cost, next state) for one row, in ASCII order."""
        role, fault = divmod(symbol, 3)
        out = [("D", self.costs.delete, state)]
        if fault != _GONE:
            more = self.costs.truncated if fault == _CUT else 0
            kept = _keeps(state, role)
            if kept is not None:
                out.append(("K", more, kept))
            out.append(("R", self.costs.rerole + more, _NEXT[state]))
        return out

    def _power(self, symbol: int, k: int) -> np.ndarray:
        """The matrix of 2 ** k rows of a symbol, inserts before each included."""
        if k:
            return times(self.power(symbol, k - 1), self.power(symbol, k - 1))
        step = np.full((4, 4), _INF)
        for s in range(4):
            for _, cost, t in self.options(symbol, s):
                step[s, t] = min(step[s, t], cost)
        return times(self.jump, step)

    def matrix(self, runs: list[tuple[int, int]]) -> np.ndarray:
        out = np.where(np.eye(4, dtype=bool), 0, _INF)
        for symbol, n in runs:
            for k in range(n.bit_length()):
                if n >> k & 1:
                    out = times(out, self.power(symbol, k))
        return out

    def before(self, symbol: int, n: int, v: Vector) -> Vector:
        """Costs before a run, given those behind it."""
        for k in range(n.bit_length()):
            if n >> k & 1:
                v = ahead(self.power(symbol, k), v)
        return v

    def _row(self, symbol: int, state: int, v: Vector) -> tuple[str, int]:
        left = ahead(self.power(symbol, 0), v)
        out = ""
        while True:
            for edit, cost, t in self.options(symbol, state):
                if edit > "I" and self.costs.insert + left[_NEXT[state]] == left[state]:
                    break  # an insert comes before K and R
                if cost + v[t] == left[state]:
                    return out + edit, t
            out, state = out + "I", _NEXT[state]

    def _block(self, symbol: int, k: int, state: int, v: Vector) -> tuple[str, int]:
        """Edits of 2 ** k rows from a state, and the state behind them."""
        if not k:
            return self._row(symbol, state, v)
        one, mid = self.unroll(symbol, k - 1, state, ahead(self.power(symbol, k - 1), v))
        two, end = self.unroll(symbol, k - 1, mid, v)
        return one + two, end

    def unroll(self, symbol: int, k: int, state: int, v: Vector) -> tuple[str, int]:
        low = min(v)
        v = tuple(min(x - low, _INF) for x in v)
        return (self.block if k <= 10 else self._block)(symbol, k, state, v)

    def run(self, symbol: int, n: int, state: int, v: Vector) -> tuple[str, int]:
        """Edits of a run: its binary parts one after another, the costs behind
        each known from the parts that follow."""
        bits = [k for k in range(n.bit_length()) if n >> k & 1]
        behind = []
        for k in bits:
            behind.append(v)
            v = ahead(self.power(symbol, k), v)
        out = []
        for k, after in zip(reversed(bits), reversed(behind), strict=True):
            edits, state = self.unroll(symbol, k, state, after)
            out.append(edits)
        return "".join(out), state

    def _whole(self, runs: tuple[tuple[int, int], ...], state: int, v: Vector, last: bool) -> tuple[str, int]:
        behind = []
        for symbol, n in reversed(runs):
            behind.append(v)
            v = self.before(symbol, n, v)
        out = []
        for (symbol, n), after in zip(runs, reversed(behind), strict=True):
            edits, state = self.run(symbol, n, state, after)
            out.append(edits)
        while last and state not in (_START, _ASSISTANT):
            out.append("I")
            state = _NEXT[state]
        return "".join(out), state

    def edits(self, runs: list[tuple[int, int]], state: int = _START, v: Vector | None = None, last: bool = True) -> tuple[str, int]:
        """Cheapest edits of the runs from a state, given the costs behind them;
        ``last``: the conversation ends here, missing rows are inserted."""
        found = self.whole if len(runs) <= 16 and sum(n for _, n in runs) <= 64 else self._whole
        return found(tuple(runs), state, self.end if v is None else v, last)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), _INF)


def ahead(m: np.ndarray, v: Vector) -> Vector:
    return tuple(int(x) for x in np.minimum((m + np.array(v)).min(axis=1), _INF))


def runs_of(symbols: np.ndarray, copies: np.ndarray) -> list[tuple[int, int]]:
    """Runs of rows; of a row's copies only the first has the row's symbol, the
    others repeat it and must go."""
    more = copies > 1
    both = np.stack([symbols, symbols // 3 * 3 + _GONE], axis=1).ravel()
    count = np.stack([np.ones(len(symbols), np.int64), copies - 1], axis=1).ravel()
    if not more.any():
        both, count = symbols, np.ones(len(symbols), np.int64)
    on = count > 0
    both, count = both[on], count[on]
    if not len(both):
        return []
    begins = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1])))
    return list(zip(both[begins].tolist(), np.add.reduceat(count, begins).tolist(), strict=True))


# ------------------------------------------------------------------ rows ---

def _truncated(text: Column) -> Column:
    return ~F.substring(F.rtrim(text, F.lit(_SPACES)), -1, 1).isin(".", "!", "?")


def ordered_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, copies, fault, symbol, part), each row once with
    its number of equal copies, dealt out by ranges of (conv, turn, role, text)
    and sorted in each; a checkpoint, so that a row stays in its part."""
    space = F.lit(" ")
    src = conversations.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"))
    # copies are counted before the shuffle, so a row that is there a million times is one
    rows = src.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    # ranges are cut by the text's beginning and its hash: bounds stay short
    rows = rows.withColumns({"head": F.substring("text", 1, 64), "hash": F.md5("text")})
    rows = rows.select("conv", "turn", "role", "head", "hash", F.lit(1).alias("is_row"), "text", "copies")
    # the first place of each (role, text) of a conversation goes before its row as a mark
    early = F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("first")
    marks = rows.groupBy("conv", "role", "head", "hash").agg(early)
    marks = marks.select("conv", F.col("first.turn").alias("turn"), "role", "head", "hash", F.lit(0).alias("is_row"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"))
    place = ["conv", "turn", "role", "head", "hash"]
    both = rows.unionByName(marks).repartitionByRange(*place).sortWithinPartitions(*place, "is_row")
    new = F.coalesce(F.lag("is_row").over(Window.partitionBy(*place).orderBy("is_row")) == 0, F.lit(False))
    both = both.withColumn("new", new).where("is_row = 1")
    fault = F.when(~F.col("text").rlike(_WORD), "blank").when(~F.col("new"), "duplicate").when(_truncated(F.col("text")), "truncated")
    kind = F.coalesce(F.array_position(F.array(F.lit("s"), F.lit("u"), F.lit("a")), F.substring("role", 1, 1)), F.lit(0)).cast("int")
    kind = F.when(kind == 0, 3).otherwise(kind - 1)
    both = both.withColumn("fault", fault)
    severity = F.when(F.col("fault") == "truncated", _CUT).when(F.col("fault").isNotNull(), _GONE).otherwise(_OK)
    both = both.withColumn("symbol", (kind * 3 + severity).cast("int")).sortWithinPartitions(*place)
    return both.select("conv", "turn", "role", "text", "copies", "fault", "symbol", F.spark_partition_id().cast("long").alias("part")).checkpoint()


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, bool, list[pa.RecordBatch]]]:
    """(conversation, whether it is the partition's first, its rows) of a sorted
    partition; column 0 is the conversation."""
    held: list[pa.RecordBatch] = []
    name, first = None, True
    for b in batches:
        if not b.num_rows:
            continue
        names = b.column(0).to_pylist()
        cuts = [0, *(k for k in range(1, len(names)) if names[k] != names[k - 1]), len(names)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            if held and names[a] != name:
                yield name, first, held
                held, first = [], False
            name = names[a]
            held.append(b.slice(a, z - a))
    if held:
        yield name, first, held


def _runs(held: list[pa.RecordBatch], symbol: int, copies: int) -> list[tuple[int, int]]:
    syms = np.concatenate([b.column(symbol).to_numpy(zero_copy_only=False) for b in held])
    return runs_of(syms, np.concatenate([b.column(copies).to_numpy(zero_copy_only=False) for b in held]))


def _edges(batches: Iterator[pa.RecordBatch], costs: Costs) -> Iterator[pa.RecordBatch]:
    """The first and the last conversation of a partition with their runs and
    matrix; rows are (conv, part, symbol, copies)."""
    repair = Repair(costs)

    def row(seg: tuple[Any, bool, list[pa.RecordBatch]]) -> pa.RecordBatch:
        _, first, held = seg
        runs = _runs(held, 2, 3)
        flat = [int(x) for x in repair.matrix(runs).ravel()]
        cols = [held[0].column(0).slice(0, 1), held[0].column(1).slice(0, 1), pa.array([0 if first else 1], pa.int32())]
        cols += [pa.array([list(x)], pa.list_(pa.int64())) for x in ([s for s, _ in runs], [n for _, n in runs], flat)]
        return pa.RecordBatch.from_arrays(cols, names=["conv", "part", "side", "symbols", "counts", "matrix"])

    last = None
    for seg in _segments(batches):
        if seg[1]:
            yield row(seg)
        last = seg
    if last is not None and not last[1]:
        yield row(last)


def _chains(edges: list) -> list[list]:
    """Parts of conversations that go over partitions, in order."""
    out: list[list] = []
    edges = sorted(edges, key=lambda e: (e["part"], e["side"]))
    for before, e in zip([None, *edges], edges, strict=False):
        if before is not None and before["conv"] == e["conv"] and before["part"] < e["part"]:
            out[-1].append(e)
        else:
            out.append([e])
    return [c for c in out if len(c) > 1]


def _starts(rows: DataFrame, costs: Costs) -> dict[tuple[int, int], tuple[int, Vector, bool]]:
    """For each part of a conversation that goes over partitions, by (part,
    side): its first state, the costs behind it, and whether it is the last."""
    narrow = rows.select("conv", "part", "symbol", "copies")
    kind = rows.schema["conv"].dataType.simpleString()
    fields = f"conv {kind}, part long, side int, symbols array<long>, counts array<long>, matrix array<long>"
    edges = narrow.mapInArrow(lambda it: _edges(it, costs), fields).checkpoint()
    # at most two rows of 16 numbers for each partition
    chains = _chains(edges.select("conv", "part", "side", "matrix").collect())
    if not chains:
        return {}
    behind: dict[tuple[int, int], Vector] = {}
    for chain in chains:
        v = Repair(costs).end
        for e in reversed(chain):
            behind[e["part"], e["side"]] = v
            v = ahead(np.array(e["matrix"]).reshape(4, 4), v)

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Where each of the four states leads to."""
        repair = Repair(costs)
        for b in batches:
            t = b.to_pydict()
            got: list[tuple] = []
            for part, side, symbols, counts in zip(t["part"], t["side"], t["symbols"], t["counts"], strict=True):
                v = behind.get((part, side))
                if v is not None:
                    runs = list(zip(symbols, counts, strict=True))
                    got.append((part, side, [repair.edits(runs, s, v, False)[1] for s in range(4)]))
            if got:
                cols = [pa.array(c, k) for c, k in zip(zip(*got, strict=True), (pa.int64(), pa.int32(), pa.list_(pa.int32())), strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names=["part", "side", "ends"])

    found = edges.select("part", "side", "symbols", "counts").mapInArrow(leads, "part long, side int, ends array<int>").collect()
    ends = {(r["part"], r["side"]): r["ends"] for r in found}
    out = {}
    for chain in chains:
        state = _START
        for n, e in enumerate(chain):
            key = (e["part"], e["side"])
            out[key] = (state, behind[key], n + 1 == len(chain))
            state = ends[key][state]
    return out


REPAIRED = "turn {turn}, role string, text string, copies long, fault string, part long, place long, whole boolean, edit string, new_role string, cost long"


def repair_turns(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", costs: Costs = Costs()
) -> DataFrame:
    """One row for each different row of a conversation and each inserted one:
    (conv, turn, role, text, copies, fault, part, place, whole, edit, new_role,
    cost), in order of (part, place) within a conversation; ``edit`` is K(eep),
    R(erole), D(elete) or I(nsert), ``new_role`` the role of rows that stay,
    ``copies`` how many equal rows the edit stands for (over 1 for D only: the
    later ones of equal rows always go), ``whole`` whether the conversation
    lies in one ``part``.  Other columns of the table are not read.

    The edits are the cheapest ones after which role initials read
    ``(s?(ua)+)?`` and no blank or duplicate row is left; of equally cheap ones
    the ASCII-least.  Rows stand by turn (null first), then role, then text (by
    its first 64 code points, then its md5).  Null roles and texts are read as
    one space; rows without a conversation id are one conversation; roles other
    than s..., u... and a... can be reroled or deleted only.  Repeated rows are
    duplicates; empty texts are blank; very long ones are read whole; an empty
    table gives an empty result.  A task holds its part of one conversation at
    a time; what reaches the driver is bounded by the number of partitions.
    """
    src, at = renamed(conversations)
    rows = ordered_turns(src, at[conv_id], at[turn], at[role], at[text])
    starts = _starts(rows, costs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repair = Repair(costs)
        paid = {"K": 0, "R": costs.rerole, "D": costs.delete, "I": costs.insert}
        place = 0
        segments = _segments(batches)
        todo = next(segments, None)
        while todo is not None:
            (_, first, held), todo = todo, next(segments, None)
            part = held[0].column(7)[0].as_py()
            key = (part, 0 if first else 1)
            known = starts.get(key) if first or todo is None else None
            state, v, last = known or (_START, repair.end, True)
            edits, _ = repair.edits(_runs(held, 6, 4), state, v, last)
            at_edit = 0
            for n, b in enumerate(held):
                out: list[tuple] = []
                copies, symbols, faults = (b.column(i).to_pylist() for i in (4, 6, 5))

                def insert(i: int | None) -> None:
                    nonlocal state
                    state = _NEXT[state]
                    out.append((i, None, 1, "I", "user" if state == _USER else "assistant", costs.insert))

                for k in range(b.num_rows):
                    while edits[at_edit] == "I":
                        insert(k)
                        at_edit += 1
                    edit = edits[at_edit]
                    new = None
                    if edit == "K":
                        state = _keeps(state, symbols[k] // 3)
                    elif edit == "R":
                        state = _NEXT[state]
                        new = "user" if state == _USER else "assistant"
                    cost = paid[edit] + (costs.truncated if faults[k] == "truncated" and edit != "D" else 0)
                    rest = copies[k] - 1
                    at_edit += 1 + rest
                    if edit == "D" and (not rest or faults[k] in ("blank", "duplicate")):
                        out.append((k, faults[k], copies[k], edit, None, cost * copies[k]))
                        continue
                    out.append((k, faults[k], 1, edit, new, cost))
                    if rest:
                        out.append((k, "duplicate", rest, "D", None, paid["D"] * rest))
                if n + 1 == len(held):
                    while at_edit < len(edits):
                        insert(b.num_rows - 1)
                        at_edit += 1
                at_row, fault, count, edit, role_now, cost = zip(*out, strict=True)
                got = b.take(pa.array(at_row, pa.int64()))
                real = np.array([e != "I" for e in edit])
                keep = np.array([e == "K" for e in edit])
                blank = lambda c, mask: pc.if_else(pa.array(mask), c, pa.scalar(None, c.type))
                empty = pc.if_else(pa.array(real), got.column(3), "")
                new_role = pc.if_else(pa.array(keep), got.column(2), pa.array(role_now, pa.string()))
                cols = [got.column(0), blank(got.column(1), real), blank(got.column(2), real), empty, pa.array(count, pa.int64()), pa.array(fault, pa.string()), got.column(7)]
                cols += [pa.array(np.arange(place, place + len(out))), pa.array([known is None] * len(out)), pa.array(edit, pa.string()), new_role, pa.array(cost, pa.int64())]
                place += len(out)
                yield pa.RecordBatch.from_arrays(cols, names=["conv", "turn", "role", "text", "copies", "fault", "part", "place", "whole", "edit", "new_role", "cost"])

    kinds = {n: rows.schema[n].dataType.simpleString() for n in ("conv", "turn")}
    return rows.mapInArrow(run, f"conv {kinds['conv']}, " + REPAIRED.format(turn=kinds["turn"]))


# --------------------------------------------------------------- digests ---

_PIECE = 1 << 20
_PAIRS = {("s", "u"), ("u", "a"), ("a", "u")}
_PART = "first_initial string, last_initial string, first_turn {turn}, last_turn {turn}, least {turn}, most {turn}, turns long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, sha string, pieces array<binary>"


def _part_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over each conversation's part, in order; rows are those of
    ``repair_turns``.  A whole conversation's repaired text is hashed here, the
    text of another comes in pieces."""
    from hashlib import sha256

    for _, _, held in _segments(batches):
        counts = {"blank": 0, "duplicate": 0, "truncated": 0, None: 0}
        turns = illegal = cost = 0
        first_initial = last_initial = first_turn = last_turn = least = most = None
        audit, pieces = [], []
        size, any_row = 0, False
        whole = held[0].column(8)[0].as_py()
        hashed = sha256()
        begun = False
        for b in held:
            cols = [b.column(i).to_pylist() for i in (1, 2, 3, 4, 5, 9, 10, 11)]
            lines = []
            for turn, role, text, copies, fault, edit, new_role, paid in zip(*cols, strict=True):
                audit.append(edit * copies)
                cost += paid
                if edit != "D":
                    lines.append(f"{new_role}:{text}".encode())
                if edit == "I":
                    continue
                counts[fault] += copies
                initial = role[:1]
                if not any_row:
                    first_initial, first_turn, any_row = initial, turn, True
                else:
                    illegal += (last_initial, initial) not in _PAIRS
                illegal += (copies - 1) * ((initial, initial) not in _PAIRS)
                if turn is not None and turn != last_turn:
                    turns += 1
                    least = turn if least is None else least
                    most = turn
                last_initial, last_turn = initial, turn
            for line in lines:
                if whole:
                    hashed.update(line if not begun else b"\n" + line)
                    begun = True
                else:
                    size += len(line)
                    if not pieces or size > _PIECE:
                        pieces.append([])
                        size = len(line)
                    pieces[-1].append(b"\n" + line)
        kind, key = held[0].column(1).type, held[0].column(0).slice(0, 1)
        texts = [pa.array([x], pa.string()) for x in (first_initial, last_initial)]
        times_ = [pa.array([x], kind) for x in (first_turn, last_turn, least, most)]
        longs = [pa.array([x], pa.int64()) for x in (turns, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost)]
        ends = [pa.array(["".join(audit)], pa.string()), pa.array([hashed.hexdigest() if whole else None], pa.string()), pa.array([[b"".join(p) for p in pieces]], pa.list_(pa.binary()))]
        names = ["conv", "part", *(f.split()[0] for f in _PART.split(", "))]
        yield pa.RecordBatch.from_arrays([key, held[0].column(6).slice(0, 1), *texts, *times_, *longs, *ends], names=names)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of the pieces of each conversation of a sorted partition."""
    from hashlib import sha256

    hashed, key, begun = None, None, False

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([key, pa.array([hashed.hexdigest()], pa.string())], names=["conv", "sha"])

    for b in batches:
        for k, (name, piece) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
            if key is None or name != key[0].as_py():
                if key is not None:
                    yield done()
                hashed, key, begun = sha256(), b.column(0).slice(k, 1), False
            hashed.update(piece if begun else piece[1:])
            begun = True
    if key is not None:
        yield done()


def conversation_digests(conversations: DataFrame, repaired: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of every conversation of ``conversations``; those without
    a row in ``repaired`` (of ``repair_turns``) have zeros, an empty audit and
    the hash of the empty text.

    Sums go over the parts of a conversation, at most one for each partition.
    sha256 has no parallel form: the repaired text of a conversation that spans
    partitions is streamed through one task in pieces, none of it is held."""
    kinds = {n: repaired.schema[n].dataType.simpleString() for n in ("conv", "turn")}
    parts = repaired.mapInArrow(_part_rows, f"conv {kinds['conv']}, part long, " + _PART.format(turn=kinds["turn"])).checkpoint()
    w = Window.partitionBy("conv").orderBy("part")
    # a part may hold inserted rows only: then the last real row is further back
    prev_initial, prev_turn = (F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)) for c in ("last_initial", "most"))
    pair = F.concat(prev_initial, "first_initial")
    joint = F.when(prev_initial.isNotNull() & F.col("first_initial").isNotNull() & ~pair.isin("su", "ua", "au"), 1).otherwise(0)
    again = F.when(prev_turn == F.col("least"), 1).otherwise(0)
    lined = parts.select("*", joint.alias("joint"), again.alias("again"))
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "cost")]
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "audit"))), lambda p: p["audit"]), "")
    found = lined.groupBy("conv").agg(
        F.max("most").alias("most"), F.min("least").alias("least"), F.sum(F.col("turns") - F.col("again")).alias("turns"),
        *sums, F.sum(F.col("illegal") + F.col("joint")).alias("illegal"), audit.alias("audit"), F.max("sha").alias("sha"),
    )
    pieces = parts.where("sha is null").select("conv", "part", F.posexplode("pieces").alias("n", "piece"))
    spanning = pieces.repartition("conv").sortWithinPartitions("conv", "part", "n").select("conv", "piece").mapInArrow(_streamed, f"conv {kinds['conv']}, sha string")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in ((f.name, f.dataType) for f in found.schema.fields) if c not in ("conv", "sha")]
    every = conversations.select(F.col(conv_id).alias("conv")).distinct().select("conv", *nothing, F.lit(None).cast("string").alias("sha"))
    late = spanning.select("conv", *nothing, "sha")
    alls = found.unionByName(every).unionByName(late).groupBy("conv").agg(*(F.max(c).alias(c) for c in found.columns if c != "conv"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    gaps = F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return alls.select(
        F.col("conv").alias("conv_id"), gaps.alias("gaps"), *(zero(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
