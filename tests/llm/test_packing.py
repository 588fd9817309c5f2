import random
from collections import Counter
from itertools import combinations
from zlib import crc32

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.cases import edge_docs, edge_rows, no_docs
from vaultline.llm.packing import CAPACITY, WordIds, document_ids, fullest, pack_documents, pack_pieces, schedule, sequences, token_pieces, tokenizer_json

ODD = ["", "  ", "a\x1cb \x85c\xa0d", "é éx  'S it's <|endoftext|> a<|startoftext|>b", "ΑΣ ΣΑΣ\n\tς", "don't we'll I'M 12345 ½ x»!! it's!!", " x　y", "a\x00b",
       "Straße’s ÀÉ«x» Ünï. ǅx ŉa ĲAB İI ΩS'T", "日本語 テキスト Å ﬁ", "word.. WORD## word!! ab1!! -x- ''"]


def test_ids_are_the_tokenizers():
    tk = Tokenizer.from_str(tokenizer_json())
    words = WordIds(tk)
    for t in [*ODD, *ODD]:
        assert document_ids(t.encode(), words).tolist() == [*tk.encode(t, add_special_tokens=False).ids, 0], t


def test_fullest_matches_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randrange(1, 15): rng.randrange(1, 4) for _ in range(rng.randrange(1, 5))}
        items = sorted(Counter(counts).elements())
        cap = max(items[-1], rng.randrange(1, 30))
        best = max(sum(c) for n in range(1, len(items) + 1) for c in combinations(items, n) if items[-1] in c and sum(c) <= cap)
        got = fullest(counts, cap)
        assert sum(k * v for k, v in got.items()) == best and all(v <= counts[k] for k, v in got.items())


def test_schedule_uses_every_piece_and_stays_small():
    rng = random.Random(2)
    counts = {k: rng.randrange(1, 10**7) for k in range(1, CAPACITY + 1)}
    plan = schedule(counts)
    used = Counter()
    for _, times, combo in plan:
        assert sum(k * v for k, v in combo.items()) <= CAPACITY
        used.update({k: v * times for k, v in combo.items()})
    assert used == Counter(counts) and len(plan) < 3 * CAPACITY


def check_layout(rows, capacity):
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
        assert ends[r["sequence_id"]] <= capacity
    return len(ends)


def test_packing_is_gapless_and_near_the_bound(spark):
    rng = random.Random(3)
    rows = [(k, 7 if k % 3 == 0 else rng.randrange(1, 60)) for k in range(4000)]
    pieces = spark.createDataFrame(rows, "doc_id long, length long").repartition(5)
    got = pack_pieces(pieces, 64).collect()
    assert sorted((r["doc_id"], r["length"]) for r in got) == rows
    assert check_layout(got, 64) <= sum(n for _, n in rows) / 64 * 1.05 + 1


def test_lengths_outside_the_capacity_are_refused(spark):
    with pytest.raises(ValueError):
        pack_pieces(spark.createDataFrame([(1, 65)], "doc_id long, length long"), 64)


def test_round_trip_of_ids(spark):
    texts = ["some words " * n for n in (1, 5, 900, 3000)] + ODD
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packed = pack_documents(docs, tokenizer_json(), with_ids=True).cache()
    flat = {r["sequence_id"]: r["ids"] for r in sequences(packed).collect()}
    parts = {}
    for r in packed.collect():
        ids = flat[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert crc32(np.asarray(ids, np.uint32).tobytes()) == r["ids_crc32"]
        parts.setdefault(r["doc_id"], {})[r["start"]] = ids
    tk = Tokenizer.from_str(tokenizer_json())
    for k, t in enumerate(texts):
        assert sum((parts[k][s] for s in sorted(parts[k])), []) == [*tk.encode(t, add_special_tokens=False).ids, 0]


def test_edge_rows(spark):
    got = pack_documents(edge_docs(spark), tokenizer_json()).collect()
    check_layout(got, CAPACITY)
    assert sum(r["piece"] == 0 for r in got) == len(edge_rows())
    assert pack_documents(no_docs(spark), tokenizer_json()).count() == 0
    assert token_pieces(no_docs(spark), tokenizer_json()).count() == 0


def test_a_full_cache_changes_no_ids(monkeypatch):
    from tokenizers import Tokenizer

    from vaultline.llm import packing

    rng = random.Random(9)
    text = " ".join("".join(rng.choice("abcé") for _ in range(rng.randrange(1, 6))) + rng.choice(["", ",", "!?"]) for _ in range(3000)).encode()
    tk = Tokenizer.from_str(packing.tokenizer_json())
    whole = packing.document_ids(text, packing.WordIds(tk))
    monkeypatch.setattr(packing, "_CACHE", 20_000)
    words = packing.WordIds(tk)
    assert (packing.document_ids(text, words) == whole).all() and len(words) + len(words.old) < 400
    assert whole.tolist()[:-1] == tk.encode(text.decode(), add_special_tokens=False).ids
