import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import edge_docs, edge_rows, no_docs
from vaultline.llm import ppm


def brute_counts(train, order):
    n = defaultdict(Counter)
    for t in train:
        s = [0] * order + [b + 1 for b in t] + [0]
        for i in range(order, len(s)):
            for o in range(order + 1):
                n[tuple(s[i - o : i])][s[i]] += 1
    return n


def brute_prob(n, ctx, y, order):
    p, out = 1.0, set()
    for o in range(order, -1, -1):
        c = tuple(ctx[order - o :])
        if c not in n:
            continue
        items = {t: v for t, v in n[c].items() if t not in out}
        total, kinds = sum(items.values()), len(items)
        if y in items:
            return p * items[y] / (total + kinds)
        if kinds:
            p *= kinds / (total + kinds)
        out |= set(n[c])
    return p / (ppm.SYMBOLS - len(out))


def brute_score(n, t, order):
    s = [0] * order + [b + 1 for b in t] + [0]
    return sum(math.log10(brute_prob(n, s[i - order : i], s[i], order)) for i in range(order, len(s)))


def test_probabilities_sum_to_one():
    n = brute_counts([b"abcabc", b"abd"], 3)
    for ctx in ([98, 99, 100], [1, 2, 3], [0, 0, 98]):
        assert sum(brute_prob(n, ctx, y, 3) for y in range(ppm.SYMBOLS)) == pytest.approx(1)


@pytest.mark.parametrize("train", [0, 25])
def test_scores_match_brute_force(spark, train):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc \nÉd") for _ in range(rng.randrange(14))) for _ in range(60)] + ["", None, "A B a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in ppm.ppm_score(docs, F.col("doc_id") < train).collect()}
    low = [(t or "").encode().translate(ppm._LOWER) for t in texts]
    n = brute_counts(low[:train], ppm.ORDER)
    words = Counter(w for t in low[:train] for w in [*t.split(), None])
    size, kinds = sum(words.values()), len(words)
    for k, t in enumerate(low):
        tokens = [*t.split(), None]
        base = sum(math.log10((words[w] + 0.5) / (size + 0.5 * (kinds + 1))) for w in tokens)
        r = got[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(tokens), sum(words[w] > 0 for w in tokens), size)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(brute_score(n, t, ppm.ORDER))


def test_chunks_do_not_change_scores(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words {i % 7} and {i}") for i in range(80)], "doc_id long, text string")
    one = {r["doc_id"]: r["score"] for r in ppm.ppm_score(docs, F.col("doc_id") % 2 == 0).collect()}
    monkeypatch.setattr(ppm, "CHUNK_BYTES", 200)
    many = {r["doc_id"]: r["score"] for r in ppm.ppm_score(docs, F.col("doc_id") % 2 == 0).collect()}
    assert all(abs(one[k] - many[k]) < 1e-9 for k in one) and len(many) == 80


def test_windows_stay_inside_texts():
    code, starts = ppm.leaves([b"ab", b"", b"c"], 2)
    sym = [[int(c >> 18), int(c >> 9) & 511, int(c) & 511] for c in code]
    assert starts.tolist() == [0, 3, 4, 6]
    assert sym == [[0, 0, 98], [0, 98, 99], [98, 99, 0], [0, 0, 0], [0, 0, 100], [0, 100, 0]]
    assert len(ppm.leaves([], 2)[0]) == 0 and np.array_equal(ppm.leaves([], 2)[1], [0])


def test_edge_rows(spark):
    got = ppm.ppm_score(edge_docs(spark), F.coalesce(F.col("doc_id") > 3, F.lit(True)), carry={"lang": F.col("lang")}).collect()
    assert len(got) == len(edge_rows()) and all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert ppm.ppm_score(no_docs(spark), F.lit(True)).count() == 0
