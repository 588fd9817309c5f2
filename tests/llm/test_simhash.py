import random

import numpy as np
import pytest
import xxhash

from tests.llm.cases import edge_docs, edge_rows, no_docs
from vaultline.llm import simhash
from vaultline.llm.components import local_roots
from vaultline.llm.stages import near_duplicates


def brute_fingerprint(text, width):
    words = "".join(c.lower() if c.isascii() else c for c in text).encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_match_brute_force():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 17, 300, 1200):
        t = " ".join(rng.choice(["Aé", "b", "cc", "D\n", "É"]) for _ in range(n))
        assert simhash.fingerprint(t.encode(), 3, simhash._lanes()) == brute_fingerprint(t, 3)


def crowd(seed, n):
    rng = random.Random(seed)
    out = {0, (1 << 64) - 1, 1, 3, 7}
    for _ in range(n):
        x = rng.getrandbits(64) if rng.random() < 0.2 or not out else rng.choice(sorted(out))
        for _ in range(rng.randrange(4)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return np.array(sorted(out), np.uint64)


def test_gray_rank_orders_neighbours_by_one_bit():
    codes = np.arange(256, dtype=np.uint64)
    by = codes[np.argsort(simhash.gray_rank(codes))]
    assert (np.bitwise_count(by[1:] ^ by[:-1]) == 1).all()


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_tree_finds_all_pairs(distance):
    x = crowd(2, 400)
    index = x[np.argsort(simhash.gray_rank(x))]
    got = {(int(v), int(g)) for a, b in simhash.near_pairs(index, index, 0, distance) for v, g in zip(a, b, strict=True)}
    near = np.bitwise_count(index[:, None] ^ index[None, :]) <= distance
    assert got == set(zip(*map(np.ndarray.tolist, np.nonzero(near)), strict=True))


def test_pairs_are_expanded_a_part_at_a_time():
    """Memory of a call does not grow with the visitors or the block."""
    import tracemalloc

    rng = np.random.default_rng(3)
    index = np.unique(rng.integers(0, 1 << 63, 16_384, np.uint64))
    index = index[np.argsort(simhash.gray_rank(index))]
    visitors = rng.integers(0, 1 << 63, 50_000, np.uint64)
    tracemalloc.start()
    found = sum(len(v) for v, _ in simhash.near_pairs(index, visitors, 0, 2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20 and found == 0


@pytest.mark.parametrize("block", [8, 64, 100_000])
def test_links_connect_what_brute_force_connects(spark, block):
    x = np.concatenate([crowd(3, 500), crowd(4, 100)])
    x = np.unique(x)
    fps = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long").checkpoint()
    links = simhash.fingerprint_links(fps, 2, block).collect()
    place = {int(v): k for k, v in enumerate(x.view(np.int64))}
    u, v = (np.array([place[r[c]] for r in links], np.int64) for c in ("src", "dst"))
    a, b = np.nonzero(np.bitwise_count(x[:, None] ^ x[None, :]) <= 2)
    assert local_roots(u, v, len(x)).tolist() == local_roots(a, b, len(x)).tolist()


def test_components_of_documents(spark):
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(120)) for _ in range(15)]
    texts = [b + (f" extra{k}" if k % 2 else "") for k, b in enumerate(base * 4)] + ["", None, " "]
    docs = spark.createDataFrame([(1000 - k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in simhash.simhash_components(docs).collect()}
    fp = np.array([brute_fingerprint(t or "", 3) for t in texts], np.uint64)
    ids = np.array([1000 - k for k in range(len(texts))])
    a, b = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 2)
    root = local_roots(a, b, len(fp))
    for k in range(len(texts)):
        assert got[ids[k]]["component_id"] == ids[root == root[k]].min() and got[ids[k]]["fp"] % (1 << 64) == fp[k]


def test_one_row_of_each_group_stays(spark):
    kept = near_duplicates(spark, edge_docs(spark), "")
    rows = kept.collect()
    assert kept.columns == edge_docs(spark).columns
    named = [r for r in rows if r["doc_id"] is not None]
    assert sorted(r["doc_id"] for r in named if r["doc_id"] not in (5, 6)) == [1, 4, 7, 8, 9]  # 1, 2, 3 have no words; 5 copies 4
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert near_duplicates(spark, no_docs(spark), "").count() == 0


def test_repeated_rows_leave_one(spark):
    t = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(3, t, "a"), (3, t, "a"), (3, t, "b"), (4, t, "a"), (5, "other words here", "a"), (5, "other words here", "a")], "doc_id long, text string, m_row string")
    assert sorted(map(tuple, simhash.keep_one(docs).collect())) == [(3, t, "a"), (5, "other words here", "a")]


def test_edge_rows(spark):
    assert simhash.simhash_components(edge_docs(spark)).count() == len(edge_rows())
    assert simhash.simhash_components(no_docs(spark)).count() == 0


def test_keep_one_of_each_group_under_a_repeated_id(spark):
    one, two = " ".join(f"apple{k} pear{k}" for k in range(60)), " ".join(f"stone{k} river{k}" for k in range(60))
    rows = [(1, one), (1, one), (2, one), (1, two), (1, two), (3, two), (4, "some other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, simhash.keep_one(docs).collect())) == sorted([(1, one), (1, two), (4, "some other words")])
