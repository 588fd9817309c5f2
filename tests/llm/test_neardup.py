import numpy as np
import pyarrow as pa
import pytest

from vaultline.llm import neardup
from vaultline.llm.components import components, local_roots


def test_components_match_local_roots(spark):
    rng = np.random.default_rng(1)
    chains = [(k, k + 1) for k in range(0, 60)] + [(500, k) for k in range(300, 400)]
    links = [*chains, *map(tuple, rng.integers(1000, 1100, (60, 2)).tolist()), (7, 7), (None, 3), (3, None), (0, 1)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "src long, dst long")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    u, v = map(np.array, zip(*real, strict=True))
    root = local_roots(u, v, 1200)
    assert got == {n: int(root[n]) for n in set(u.tolist()) | set(v.tolist())}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def clusters(seed, groups, d, each):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((groups, d))
    x = np.repeat(base, each, axis=0)
    x += rng.standard_normal(x.shape) * rng.uniform(0, 0.45, (len(x), 1))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def check(spark, x, least=0.9):
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(6)
    got = sorted(neardup.embedding_components(df).collect())
    link = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    found = sum(r["n_links"] for r in got)
    assert all(r["n_links"] <= link[k].sum() for k, r in enumerate(got))
    assert found >= least * link.sum()
    return got, link


def test_recall_against_brute_force(spark):
    x = clusters(3, 250, 24, 6)
    got, link = check(spark, x, 0.95)
    u, v = np.nonzero(link)
    root = local_roots(u, v, len(x))
    assert np.mean([r["component_id"] == root[k] for k, r in enumerate(got)]) > 0.9
    assert all(r["kept"] == (r["component_id"] == r["vec_id"]) for r in got)


@pytest.mark.parametrize("norm", [0.02, 0.85, 0.9])
def test_recall_holds_off_centre_and_at_scale(norm):
    rng = np.random.default_rng(4)
    d, n = 64, 300
    mean = np.zeros(d)
    mean[0] = norm
    turn = (0.9 - norm**2) / (1 - norm**2)
    e, f = np.linalg.qr(rng.standard_normal((n, d - 1, 2)))[0].transpose(2, 0, 1)
    whole = lambda v: np.concatenate([np.full((n, 1), norm), np.sqrt(1 - norm**2) * v], axis=1)
    x, y = whole(e), whole(turn * e + np.sqrt(1 - turn**2) * f)  # pairs of the set, at the limit
    assert np.allclose((x * y).sum(axis=1), 0.9)
    spec = neardup.calibrate(x, mean, 20_000_000, 0.9, 0.97, 7)
    (ca, ha), (cb, hb) = spec.cells(x), spec.cells(y)
    hits = ((ca == cb) & (np.abs(ha - hb) <= spec.window)).sum(axis=1)
    assert spec.tables <= 512 and np.mean(hits >= spec.least) >= 0.95
    bits = np.bitwise_count((spec.sketch(x) ^ spec.sketch(y)).view(np.uint64)).sum(axis=1)
    assert np.mean(bits <= spec.differ) >= 0.99
    if norm == 0.02:  # unlike vectors are told apart
        assert np.mean(np.bitwise_count((spec.sketch(x) ^ spec.sketch(x[::-1])).view(np.uint64)).sum(axis=1) <= spec.differ) < 0.01


def test_hopeful_rows_against_a_plain_loop():
    x = clusters(8, 40, 16, 4)
    spec = {16: neardup.calibrate(x, x.mean(axis=0), 64, 0.9, 0.97, 7)}
    cells, own = spec[16].cells(x)
    own, m = own[:, 0].astype(np.float32), spec[16].sketch(x)
    rng = np.random.default_rng(2)
    rows = []
    for k, part in enumerate(rng.integers(0, 2, len(x)).tolist()):  # every other cell is split into two parts
        blocks = [0] if cells[k, 0] % 2 else [(part + 1) * (1 << 31) + part + 1, (1 << 31) + 2]
        rows += [(16, 0, int(cells[k, 0]), b, part, k) for b in blocks]
    rows.sort(key=lambda r: r[:4])
    at = [r[5] for r in rows]
    cols = dict(zip(("d", "t", "cell", "block", "part"), map(list, zip(*[r[:5] for r in rows], strict=True)), strict=True))
    table = pa.table({**cols, "own": own[at], "m0": np.ascontiguousarray(m[at, 0]), "m1": np.ascontiguousarray(m[at, 1])})

    def partner(r, s):
        if r is s or r[:4] != s[:4] or abs(float(own[r[5]]) - float(own[s[5]])) > spec[16].window + neardup._SLACK:
            return False
        mixed = r[3] == (1 << 31) + 2  # the block of two different parts
        return not (mixed and r[4] == s[4]) and sum(int(v) for v in np.bitwise_count((m[r[5]] ^ m[s[5]]).view(np.uint64))) <= spec[16].differ

    want = [any(partner(r, s) for s in rows) for r in rows]
    assert neardup._hopeful(table, spec).tolist() == want and 0 < sum(want) < len(want)


def test_recall_out_of_reach_is_an_error():
    x = np.eye(8)
    with pytest.raises(ValueError):
        neardup.calibrate(x, x.mean(axis=0), 1000, 0.9, 0.97, 7, most=1, window=0.1)


def test_crowded_cell_is_split(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 32)
    check(spark, np.concatenate([clusters(5, 1, 16, 200), clusters(6, 60, 16, 2)]), 0.95)


def test_edge_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, []), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, None]), (9, [1.0, 0.0]), (10, [1.0]),
            (11, [1e300, 0.0]), (12, [0.0, 1.0]), (13, [1e-300, 0.0])]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id long, embedding array<double>, vec string, links int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neardup.embedding_components(df).collect()}
    for k in (1, 2, 9, 11, 13):
        assert got[k] == (4, 1)
    assert all(got[k] == (0, k) for k in (3, 4, 5, 6, 7, 8, 10, 12))
    assert neardup.embedding_components(df.limit(0)).count() == 0
