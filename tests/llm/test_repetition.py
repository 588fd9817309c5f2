import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import LONG, edge_docs, edge_rows, no_docs
from vaultline.llm.repetition import RepetitionRules, covered, maximal_repeats, measure, repeat_lengths, repetition_quality, spans


def brute_longest(ids):
    n = len(ids)
    out = []
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and i + k < n and j + k < n and ids[i + k] == ids[j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=18), min_size=1, max_size=4))
def test_longest_repeats_match_brute_force(seqs):
    starts = np.cumsum([0, *map(len, seqs)])
    ids = np.array(sum(seqs, []), np.int64)
    assert repeat_lengths(ids, starts).tolist() == sum(map(brute_longest, seqs), [])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=14))
def test_maximal_repeats_match_brute_force(ids):
    found = {(n, tuple(at)) for n, at in maximal_repeats(np.array(ids, np.int64))}
    want = set()
    for n in range(1, len(ids)):
        for s in {tuple(ids[i : i + n]) for i in range(len(ids) - n + 1)}:
            at = [i for i in range(len(ids) - n + 1) if tuple(ids[i : i + n]) == s]
            before, after = {ids[i - 1] if i else -1 for i in at}, [ids[i + n] if i + n < len(ids) else -1 - i for i in at]
            if len(at) > 1 and len(before) > 1 and len(set(after)) > 1:
                want.add((n, tuple(at)))
    assert found == want


def brute_base(text):
    words = text.encode().split()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\n#\x85\t|"), max_size=40), min_size=1, max_size=3))
def test_base_counts_match_brute_force(texts):
    got = measure([t.encode() for t in texts], RepetitionRules())
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(got[n][k] for n in names) for k in range(len(texts))] == [brute_base(t) for t in texts]


def test_spans_of_covered_words():
    longest = np.array(brute_longest([1, 2, 3, 9, 1, 2, 3, 8]))
    assert spans(covered(longest, 3)) == [(0, 3), (4, 7)]


def test_limits_of_fraction_and_longest():
    fresh = " ".join(f"f{i}" for i in range(300)).encode()
    passage = " ".join(f"p{i}" for i in range(120)).encode()
    got = measure([fresh, fresh + b" " + passage + b" x " + passage, passage + b" x " + passage], RepetitionRules())
    assert got["kept"] == [True, False, False]  # clean; one repeat of 120 words; nearly all covered
    assert got["longest_repeat"] == [0, 120, 120] and got["repeat_spans"][1] == [[300, 420], [421, 541]]


def test_edge_rows(spark):
    got = repetition_quality(edge_docs(spark))
    rows = got.collect()
    assert len(rows) == len(edge_rows()) and got.columns.count("kept") == 1 and "in_kept" in got.columns
    by_text = {r["text"]: r for r in rows}
    assert by_text[None]["n_words"] == 0 and not by_text[None]["kept"] and by_text[""]["base_failed"]
    assert by_text[LONG]["n_words"] == 120_000 and not by_text[LONG]["kept"]
    assert repetition_quality(no_docs(spark)).count() == 0
