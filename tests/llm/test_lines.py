import random
from hashlib import sha256

import numpy as np
from pyspark.sql import functions as F

from tests.llm.cases import edge_docs, edge_rows, no_docs
from vaultline.llm.lines import _carried, apply_bitmap, dedup_lines, kept_digest, line_key, pack_bits, unpack_bits

SCHEMA = "doc_id long, text string"


def brute(rows, least=10):
    """(id, lines, dropped, kept text) of every row."""
    holder = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            k = line_key(line, least)
            if k is not None:
                rank = (d is None, d or 0)
                holder[k] = min(holder.get(k, rank), rank)
    out = []
    for d, text in rows:
        parts = (text or "").split("\n")
        kept = [p for p in parts if line_key(p, least) is None or holder[line_key(p, least)] == (d is None, d or 0)]
        out.append((d, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def result(df, **more):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], apply_bitmap(r["text"], r["keep"])) for r in dedup_lines(df, **more).collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice(["Aa", "bé", "c", "D!", " x"]) for _ in range(rng.randrange(0, 9))) for _ in range(60)]
    return [(k, None if k == 3 else "\n".join(rng.choice(["", " ", "\t"]) + rng.choice(lines) + rng.choice(["", " \r", "\x0b"]) for _ in range(rng.randrange(12)))) for k in range(n)]


def test_matches_brute_force(spark):
    rows = corpus(1, 250)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert result(df) == brute(rows) and result(df, least_chars=3) == brute(rows, 3)


def test_a_hash_over_many_partitions(spark):
    """A line in every document spans all ranges; its first document still holds it."""
    rows = [(d, f"the line that all share\nown line of {d // 2}\nThe LINE that all share ") for d in range(1, 1200)]
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert result(spark.createDataFrame(rows, SCHEMA).repartition(8)) == brute(rows)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_carried_documents_go_on():
    s = lambda p, f, z, d: {"part": p, "f_hi": f, "f_lo": 0, "l_hi": z, "l_lo": 0, "doc": d}
    assert _carried([s(4, 9, 9, 30), s(0, 1, 5, 7), s(1, 5, 5, 8), s(3, 5, 9, 20)]) == {1: (5, 0, 7), 3: (5, 0, 7), 4: (9, 0, 20)}


def test_bitmaps_are_small_and_whole():
    keep = np.random.default_rng(1).random(1001) < 0.5
    assert (unpack_bits(pack_bits(keep), 1001) == keep).all()
    assert len(pack_bits(np.ones(80_000, bool))) < 100


def test_edges(spark):
    rows = [r[:2] for r in edge_rows()]
    docs = edge_docs(spark).withColumn("keep", F.lit("k"))
    out = dedup_lines(docs)
    assert out.columns == [*(c for c in docs.columns if c != "keep"), "in_keep", "n_lines", "n_dropped", "keep"]
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], apply_bitmap(r["text"], r["keep"])) for r in out.collect()), key=str) == brute(rows)
    assert dedup_lines(no_docs(spark)).count() == 0
    twins = [(1, "one long line\none long line")] * 4 + [(None, "one long line"), (None, None)]
    assert result(spark.createDataFrame(twins, SCHEMA)) == brute(twins)


def test_digest(spark):
    rows = [(1, "shared line one\nb"), (2, "a\nshared line one"), (3, "shared line one"), (4, None)]
    got = kept_digest(dedup_lines(spark.createDataFrame(rows, SCHEMA)), "text", "keep").collect()
    assert {r["doc_id"]: r["kept_sha256"] for r in got} == {d: sha256(t.encode()).hexdigest() for d, t in ((1, rows[0][1]), (2, "a"), (3, ""), (4, ""))}
