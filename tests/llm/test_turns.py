import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from vaultline.llm.queries import damaged
from vaultline.llm.turns import _NEXT, Costs, Repair, _chains, _keeps, conversation_digests, repair_turns, runs_of

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\r\x0b\f"


def cheapest(symbols, costs):
    """(cost, audit) by trying every edit of every row, from the last row on."""
    after = [(0, "") if state in (0, 3) else (1 << 40, "") for state in range(4)]
    for symbol in [None, *reversed(symbols)]:
        here = []
        for state in range(4):
            found = []
            if symbol is None:
                found.append(after[state])
            else:
                role, fault = divmod(symbol, 3)
                steps = [("D", costs.delete, state)]
                if fault < 2:
                    more = costs.truncated * fault
                    steps.append(("R", costs.rerole + more, _NEXT[state]))
                    kept = _keeps(state, role)
                    steps += [("K", more, kept)] if kept is not None else []
                found += [(cost + after[t][0], e + after[t][1]) for e, cost, t in steps]
            here.append(min(found))
        for _ in range(3):
            here = [min(here[s], (costs.insert + here[_NEXT[s]][0], "I" + here[_NEXT[s]][1])) for s in range(4)]
        after = here
    return after[0]


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        if not text.strip(SPACES):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if text.rstrip(SPACES)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(rows):
    """The digest row of one conversation's (turn, role, text) rows."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    bad = faults(rows)
    symbols = tuple(3 * {"s": 0, "u": 1, "a": 2}.get(r[1][:1], 3) + (1 if f == "truncated" else 2 if f else 0) for r, f in zip(rows, bad, strict=True))
    cost, audit = cheapest(symbols, Costs())
    state, out, at = 0, [], iter(rows)
    for e in audit:
        row = (None, "", "") if e == "I" else next(at)
        if e in "IR":
            state = _NEXT[state]
            out.append(("user" if state == 2 else "assistant") + ":" + row[2])
        elif e == "K":
            state = _keeps(state, {"s": 0, "u": 1, "a": 2}[row[1][:1]])
            out.append(f"{row[1]}:{row[2]}")
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    return gaps, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"), illegal, cost, audit, sha256("\n".join(out).encode()).hexdigest()


@pytest.mark.parametrize("costs", [Costs(), Costs(insert=1), Costs(rerole=3, delete=2, insert=1, truncated=1), Costs(rerole=1, delete=5, insert=2, truncated=0)])
def test_edits_match_brute_force(costs):
    rng, repair = random.Random(7), Repair(costs)
    for _ in range(400):
        symbols = [s for _ in range(rng.randrange(5)) for s in [rng.randrange(12)] * rng.choice([1, 1, 2, 3, 5])]
        runs = runs_of(np.array(symbols, np.int64), np.ones(len(symbols), np.int64))
        assert repair.edits(runs)[0] == cheapest(tuple(symbols), costs)[1]


def test_long_runs_take_binary_powers():
    repair = Repair()
    edits, state = repair.edits([(3, 100_001)])  # user rows without fault
    assert edits.count("D") == 1 and edits.count("R") == 50_000 and state == 3
    assert repair.before(3, 100_001, repair.end)[0] == 50_002


def corpus(seed, n):
    rng = random.Random(seed)
    said = ["Yes.", "No!", "and then", "Why?\n", " ", "", "ok. ", "Fine.\t"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), rng.choice(["user", "assistant", "system", "tool", None, ""]), rng.choice([*said, None])))
    return rows


def digests(spark, df):
    return {r[0]: tuple(r)[1:] for r in conversation_digests(df, repair_turns(df)).collect()}


def test_conversations_match_brute_force(spark):
    rows = corpus(3, 150)
    got = digests(spark, spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert got == {c: brute([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}


def test_a_conversation_over_many_partitions(spark):
    """One conversation holds most rows and spans all ranges; the result is that of one pass."""
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant"]), rng.choice([f"row {t}.", f"row {t}", "same again."])) for t in range(900)]
    rows += [(c, t, "user", f"{c} {t}.") for c in (0, 2, 3) for t in range(3)]
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, SCHEMA).repartition(8)
        fixed = repair_turns(df).checkpoint()
        per = {r["part"]: r["count"] for r in fixed.where("conv = 1").groupBy("part").count().collect()}
        assert len(per) > 8 and max(per.values()) < 300
        got = {r[0]: tuple(r)[1:] for r in conversation_digests(df, fixed).collect()}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert got == {c: brute([r[1:] for r in rows if r[0] == c]) for c in range(4)}


def test_copies_count_without_a_row_each(spark):
    df = spark.range(5000).select(F.lit(4).cast("long").alias("conv_id"), F.lit(None).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("again.").alias("text"))
    fixed = repair_turns(df)
    assert fixed.count() == 2  # the row and its copies
    got = conversation_digests(df, fixed).first()
    assert (got["gaps"], got["duplicate"], got["illegal"], got["cost"], got["audit"]) == (0, 4999, 4999, 10_000, "D" * 5000)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_turns(empty).count() == 0 and conversation_digests(empty, repair_turns(empty)).count() == 0
    rows = [(None, 0, "user", "a."), (None, 1, None, None), (7, None, "assistant", "x " * 300_000 + "."), (8, 2, "user", "q?"), (8, 2, "user", "q?")]
    df = spark.createDataFrame([(*r, "p", 1, "c") for r in rows], SCHEMA + ", part string, fault int, conv string")
    got = digests(spark, df)
    assert got == {c: brute([r[1:] for r in rows if r[0] == c]) for c in (None, 7, 8)}
    kept = spark.createDataFrame([(9, 0, "user", "a.")], SCHEMA)
    lone = conversation_digests(kept, repair_turns(kept.where("false"))).first()
    assert tuple(lone) == (9, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())


def test_damage(spark):
    rows = [(c, t, r, x) for c in range(40) for t, r, x in [(0, "system", "A. b? c!"), (1, None, None), (None, "assistant", "x.")]]
    got = sorted(map(tuple, damaged(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        fate = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        x = "" if fate == 1 else "".join(ch for ch in x if ch not in ".!?") if fate == 2 else x
        want += [(c, t, "user" if fate == 4 else r, x)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    assert got == sorted(want, key=str)


def test_chains_link_parts_in_order():
    e = lambda p, s, c: {"part": p, "side": s, "conv": c}
    assert [len(c) for c in _chains([e(0, 0, 1), e(0, 1, 2), e(2, 0, 2), e(3, 0, 2), e(3, 1, None), e(4, 0, None), e(5, 0, 9)])] == [3, 2]
