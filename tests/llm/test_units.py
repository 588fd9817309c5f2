import random

from tests.llm.cases import edge_docs, edge_rows, no_docs
from vaultline.llm.queries import op7_dedup_lines
from vaultline.llm.units import LEAST_UNIT, dedup_units, digest, in_runs, units, without


def brute(rows, unit, least):
    """Removals and texts, one row after another in rank order."""
    seen, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        gone = []
        for a, b in units(text or "", unit):
            d = digest((text or "")[a:b], least)
            if d is not None:
                if d in seen:
                    gone.append((a, b, seen[d]))
                else:
                    seen[d] = doc
        out[doc] = (None if text is None else without(text, [g[:2] for g in gone], unit), gone)
    return out


def corpus(seed, n, br):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice(["Aa", "bé", "c", "D!"]) for _ in range(rng.randrange(0, 9))) for _ in range(60)]
    return [(k, None if k == 3 else br.join(rng.choice(lines) + rng.choice(["", " ", "x y z w v"]) for _ in range(rng.randrange(6)))) for k in range(n)]


def test_lines_match_brute_force(spark):
    rows = corpus(1, 200, "\n")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["text"], [tuple(s) for s in r["removed"]]) for r in dedup_units(df, least_words=3).collect()}
    assert got == brute(rows, "line", 3)


def test_paragraphs_match_brute_force(spark):
    rows = corpus(2, 150, "\n \n\n")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["text"], [tuple(s) for s in r["removed"]]) for r in dedup_units(df, unit="paragraph", least_words=2).collect()}
    assert got == brute(rows, "paragraph", 2)


def test_sentences_match_brute_force(spark):
    rng = random.Random(4)
    said = [" ".join(rng.choice(["Aa", "bé", "c", "d"]) for _ in range(rng.randrange(1, 9))) + rng.choice([".", "!", "", "?!"]) for _ in range(50)]
    rows = [(k, "".join(rng.choice(said) + rng.choice([" ", "\n", "  ", " \n\n"]) for _ in range(rng.randrange(8)))) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["text"], [tuple(s) for s in r["removed"]]) for r in dedup_units(df, unit="sentence", least_words=3).collect()}
    assert got == brute(rows, "sentence", 3)


def test_sentences_leave_the_lines():
    text = "One two. Three four!  Five\nsix. Seven"
    assert [text[a:b] for a, b in units(text, "sentence")] == ["One two.", "Three four!", "Five", "six.", "Seven"]
    cut = units(text, "sentence")
    assert without(text, cut[2:3], "sentence") == "One two. Three four!\nsix. Seven"
    assert without(text, cut[:3], "sentence") == "six. Seven" and without(text, cut[3:], "sentence") == "One two. Three four!  Five"
    assert without(text, cut[1:2], "sentence") == "One two. Five\nsix. Seven"


def test_a_passage_is_found_in_other_lines(spark):
    passage = "this sentence of the passage has more than fifteen words so that it counts as one by itself here. " * 3
    rows = [(1, "own start. " + passage.strip()), (2, "other\nlines about. " + passage + "and an end."), (3, "nothing shared in this one.")]
    got = {r["doc_id"]: r for r in dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), unit="sentence", least_words=15).collect()}
    assert got[2]["text"] == "other\nlines about. and an end." and len(got[2]["removed"]) == 3 and not got[3]["removed"]


def test_cutting_keeps_the_rest():
    assert without("a\nb\n\nc", [(2, 3)]) == "a\n\nc" and without("a\nb", [(2, 3)]) == "a" and without("a\nb", [(0, 1)]) == "b"
    assert without("a\nb", [(0, 1), (2, 3)]) == "" and without("a\nb", []) == "a\nb"


def test_offsets_point_into_the_original(spark):
    line = "the same long line in two places"
    df = spark.createDataFrame([(2, f"é\U0001f600\n{line}\nend"), (1, f"{line}\nother")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in dedup_units(df).collect()}
    s = got[2]["removed"][0]
    assert f"é\U0001f600\n{line}\nend"[s["start"] : s["end"]] == line and s["kept_id"] == 1 and got[2]["text"] == "é\U0001f600\nend"
    assert got[1]["removed"] == []


def test_repeated_rows_and_edges(spark):
    docs = edge_docs(spark)
    got = dedup_units(docs)
    rows = got.collect()
    assert got.columns == [*docs.columns, "removed"] and len(rows) == len(edge_rows())
    words = " ".join(f"w{i}" for i in range(80))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in rows if r["text"] == words) == [(4, words)]
    assert sum(r["text"] is None for r in rows) == 2
    assert dedup_units(no_docs(spark)).count() == 0
    twin = spark.createDataFrame([(1, "one two three four five", 3)] * 3, "doc_id long, text string, removed int")
    assert sorted(r["text"] for r in dedup_units(twin).collect()) == ["", "", "one two three four five"]


def brute_runs(rows, least, run):
    """As ``brute``, by runs of clauses; ids differ."""
    seen, out = {}, {}
    for doc, text in sorted(rows):
        cut = [(a, b, digest(text[a:b], LEAST_UNIT)) for a, b in units(text, "clause")]
        gone = [{"start": a, "end": b, "kept_id": seen.get(d, doc)} for k, (a, b, d) in enumerate(cut) if d and (d in seen or d in [c[2] for c in cut[:k]])]
        own = [s["kept_id"] == doc for s in gone]
        for _, _, d in cut:
            seen.setdefault(d, doc)
        left = in_runs(text, gone, own, "clause", least, run)
        out[doc] = (without(text, [(s["start"], s["end"]) for s in left], "clause"), [(s["start"], s["end"], s["kept_id"]) for s in left])
    return out


def test_runs_match_brute_force(spark):
    rng = random.Random(7)
    said = [" ".join(f"w{rng.randrange(90)}" for _ in range(rng.randrange(1, 25))) + rng.choice([".", ",", "", "?!"]) for _ in range(60)]
    rows = [(k, "".join(rng.choice(said) + rng.choice([" ", "\n", "  "]) for _ in range(rng.randrange(9)))) for k in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["text"], [tuple(s) for s in r["removed"]]) for r in dedup_units(df, unit="clause", least_words=8, least_run=20).collect()}
    assert got == brute_runs(rows, 8, 20) and any(v[1] for v in got.values())


def test_query_finds_passages_that_begin_anywhere(spark, tmp_path):
    """Passages of over 50 words in short sentences or clauses, or from the
    midst of one, go; a single sentence that two documents share stays."""
    rng = random.Random(3)
    some = lambda n, end="": " ".join(f"x{rng.randrange(5000)}" for _ in range(n)) + end
    short, long, alone, mine = " ".join(some(6, ".") for _ in range(10)), some(4) + " " + " ".join(some(9, ",") for _ in range(6)) + " " + some(4), some(17, "."), some(17, ".")
    rows = [(1, f"{some(30)}. {short} {some(30)}"), (2, f"{some(9)}. {short} {some(9)}"), (3, f"{some(40)} {long} {some(8)}"), (4, f"{some(25)} {long} {some(31)}")]
    rows += [(5, f"{some(20)}. {alone} {some(20)}"), (6, f"{some(11)}. {alone} {some(20)}"), (7, f"{short}\n{short}"), (8, None), (8, ""), (9, f"{mine} {mine}")] + [(10, short)] * 2
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op7_dedup_lines(spark, str(tmp_path)).collect()
    n = {r["doc_id"]: r["n_removed"] for r in got}
    assert len(got) == 12 and all(n[k] for k in (2, 4, 7, 9, 10)) and not any(n[k] for k in (1, 3, 5, 6, 8))
    text = {r["doc_id"]: r["text"] for r in got}
    assert text[7] == text[10] == "" and text[2] == rows[1][1].replace(short + " ", "")
