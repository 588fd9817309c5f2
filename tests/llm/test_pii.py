import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import LONG, edge_docs, edge_rows, no_docs
from vaultline.llm import pii
from vaultline.llm.boosting import Boosted, calibrate, fit
from vaultline.llm.stages import personal_data

RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = []
    for rank, (kind, rule) in enumerate(RULES):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")))
            ok = ok or (kind == "card" and 12 <= len(digits) <= 19 and luhn(digits)) or (kind == "phone" and 9 <= len(digits) <= 15)
            if ok:
                out.append((m.start(), rank, m.end()))
    return sorted(out)


def test_base_spans_match_brute_force(spark):
    rng = random.Random(3)
    parts = ["a@b.c", "_d@e.f", "4111 1111 1111 1111", "+1 (743) 555-3824", "1.2.3.4", "256.1.1.1", "007.0.0.1", " ", "-", ".", "é", "\U0001f600", "@", "+", "12", "\n"]
    letters = "a.b@c-d 0123456789+().- \né%_\U0001f600"
    texts = ["".join(rng.choice(parts if rng.random() < 0.7 else letters) for _ in range(rng.randrange(30))) for _ in range(800)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["pii_base"]] for r in pii.find_pii(docs, models={}).collect()}
    assert got == {k: brute(t) for k, t in enumerate(texts)}


def test_long_runs_are_linear(spark):
    texts = ["1" * 200_000, "a" * 200_000, "1 " * 100_000, "a@b.c " * 2000, "1." * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n"] for r in pii.find_pii(docs).select("doc_id", F.size("pii_base").alias("n")).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 2000, 4: got[4]}


def test_redaction_merges_overlaps(spark):
    docs = spark.createDataFrame([("x 4111 1111 1111 1111 y a@b.co", [(2, 2, 21), (10, 3, 24), (24, 0, 30)])], "text string, s array<struct<start:int,rank:int,end:int>>")
    assert docs.select(pii.redact(F.col("text"), F.col("s")).alias("r")).first()["r"] == "x [CARD][EMAIL]"


def test_trees_learn_and_columns_agree(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 6, (600, 3)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] <= 1)).astype(float)
    model = calibrate(fit(x[:400], y[:400]), x[400:], y[400:], 0.95)
    chosen = model.predict(x[400:]) >= model.threshold
    assert y[400:][chosen].mean() >= 0.95 and chosen.sum() > 50
    rows = spark.createDataFrame([(r.tolist(),) for r in x[:50]], "f array<double>")
    got = [r[0] for r in rows.select(model.column(F.col("f"))).collect()]
    assert got == pytest.approx(model.predict(x[:50]).tolist())
    assert fit(x, np.ones(600)).trees == [] and Boosted().threshold > 1


def test_selected_proposals_join_base_spans(spark):
    rows = [(k, f"call {200 + k % 700} 555 {1000 + k} or +1 {200 + k % 700} 555 {1000 + k} now") for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    always = Boosted(start=5.0, trees=[0.0], threshold=0.5)
    got = pii.find_pii(docs, models={"phone": always}).first()
    spans = [tuple(s) for s in got["pii_spans"]]
    assert {tuple(s) for s in got["pii_base"]} < set(spans) and spans == sorted(spans)
    assert all(a[2] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_models_fit_and_hold_precision(spark):
    rows = [(k, f"mail u{k}@host{k}.com or tel +1 ({200 + k % 700}) 555-{1000 + k} size {k}.{k % 9}.{k % 7} number {k * 37 % 1000} {k % 100}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    models = pii.fit_models(docs)
    assert models["email"].trees or models["email"].threshold > 1  # one class selects nothing
    got = pii.find_pii(docs, models=models).select(F.sum(F.size("pii_base")).alias("b"), F.sum(F.size("pii_spans")).alias("s")).first()
    assert got["s"] >= got["b"] == 600


def test_loose_forms_are_learned_and_added(spark):
    rng = random.Random(5)
    rows = [f"text u{k}.x@host{k}.com and +1 ({200 + k % 700}) 555-{1000 + k} of 10.{k % 250}.7.{k % 99} on 20{k % 90 + 10}-05-{k % 28 + 1:02} size {k} {k + 120} {k + 340} {k + 560}" for k in range(300)]
    card = next(c for c in (f"4{rng.randrange(10**14):014}{d}" for _ in range(9) for d in range(10)) if luhn(c))
    four = [card[k : k + 4] for k in range(0, 16, 4)]
    loose = {"email": "ann.lee [at] host9.com", "phone": "(377) 555-0271", "card": ".".join(four), "ip": "10[.]20[.]30[.]40"}
    rows += [f"here is {v} for them" for v in loose.values()]
    plain = ["on 1990 1991 1992 1993 there", "see you @ noon", "12:30:45:123 and 1,234,190,200", f"{'.'.join(four)[:-1]}{(int(card[-1]) + 1) % 10} is no card", "date 2026-12-04 and 12/04/2026"]
    docs = spark.createDataFrame(list(enumerate(rows + plain)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find_pii(docs, models=pii.fit_models(docs)).collect()}
    for k, (kind, value) in enumerate(loose.items()):
        assert [tuple(s) for s in got[300 + k]["pii_spans"]] == [(8, pii.KINDS.index(kind), 8 + len(value))], kind
        assert got[300 + k]["pii_base"] == []
    assert all(got[304 + k]["pii_spans"] == [] for k in range(len(plain)))
    assert all(got[k]["pii_spans"] == got[k]["pii_base"] for k in range(300))  # dates and sizes stay


def test_numbers_side_by_side_are_told_apart(spark):
    rng = random.Random(6)
    card = next(c for c in (f"4{rng.randrange(10**14):014}{d}" for _ in range(9) for d in range(10)) if luhn(c))
    four = " ".join(card[k : k + 4] for k in range(0, 16, 4))
    cases = [("phone", "+1 (843) 555-7672", " 170.106.47.218"), ("phone", "+1 (843) 555-7672", " 170 106"), ("card", four, " 77"), ("card", four, " 124")]  # tails without a check sum of their own
    rows = [f"text u{k}.x@host{k}.com and +1 ({200 + k % 700}) 555-{1000 + k} of 10.{k % 250}.7.{k % 99} on 20{k % 90 + 10}-05-{k % 28 + 1:02} size {k} {k + 120} {k + 340} {k + 560}" for k in range(300)]
    docs = spark.createDataFrame(list(enumerate([f"see {v}{tail} there" for _, v, tail in cases] + rows)), "doc_id long, text string")
    got = {r["doc_id"]: [tuple(s) for s in r["pii_spans"]] for r in pii.find_pii(docs, models=pii.fit_models(docs)).collect()}
    for k, (kind, value, tail) in enumerate(cases):
        assert (4, pii.KINDS.index(kind), 4 + len(value)) in got[k], (kind, value, tail, got[k])


def test_cuts_are_all_runs_of_groups(spark):
    values = {"phone": ["+1 (843) 555-7672 170", "(843)555 7672", "++49 89 1234 55"], "card": ["5 4111 1111 1111 1111", "1-2-3-4-5-6-7-8-9-0-1-2-3", "4111/1111._1111 1111"], "email": ["a @ b.c"]}
    for kind, all_values in values.items():
        rows = [("<left >", "<" + v, v, "! r") for v in all_values]
        df = spark.createDataFrame(rows, "b string, t string, v string, a string").select("v", F.struct(F.lit(100).alias("start"), (F.length("v") + 100).alias("end"), F.col("v").alias("value"), F.col("b").alias("before"), F.col("a").alias("after")).alias("x"))
        for r in df.select("v", pii._cuts(kind, F.col("x")).alias("c")).collect():
            v, want = r["v"], {(100, 100 + len(r["v"]))}
            groups = [m.span() for m in re.finditer(r"[+(]*[0-9]+[)]?", v)] if kind != "email" else []
            for i in range(len(groups)):
                for j in range(i, len(groups)):
                    piece = v[groups[i][0] : groups[j][1]]
                    digits = len(re.sub("[^0-9]", "", piece))
                    if digits >= 12 if kind == "card" else digits >= 7 and j - i >= 2:
                        want.add((100 + groups[i][0], 100 + groups[j][1]))
            assert {(c["start"], c["end"]) for c in r["c"]} == want and len(r["c"]) == len(want), (kind, v)
            for c in r["c"]:
                at, end = c["start"] - 100, c["end"] - 100
                assert c["value"] == v[at:end] and c["before"] == ("<left >" + v[:at])[-24:] and c["after"] == (v[end:] + "! r")[:4]


def test_repeated_rows_are_one_row_of_the_sample(spark):
    rows = [(k, f"tel {200 + k} 555 {1000 + k} and size {k} {k + 120} {k + 340} {k + 560}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    copies = docs.union(docs.where("doc_id < 3").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("n"))
    rules = pii.PiiRules(sample_documents=40)
    a, b = pii.fit_models(docs, rules=rules), pii.fit_models(copies, rules=rules)
    assert all(a[k].trees == b[k].trees and a[k].threshold == b[k].threshold for k in pii.KINDS)


def test_small_table_is_scored(spark):
    docs = spark.createDataFrame([(1, "write to joe [at] mail.example.org today"), (2, "nothing")], "doc_id long, text string")
    got = {r["doc_id"]: len(r["pii_spans"]) for r in pii.find_pii(docs, models=pii.fit_models(docs)).collect()}
    assert got == {1: 1, 2: 0}


def test_native_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.cd")], "doc_id long, text string")
    plan = pii.find_pii(docs, models={"email": Boosted(1.0, [(0, 3.0, -1.0, 1.0)], 0.5)})._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_edge_rows(spark):
    got = pii.find_pii(edge_docs(spark), models=pii.fit_models(edge_docs(spark)))
    assert got.count() == len(edge_rows()) and "in_pii_base" in got.columns
    stage = personal_data(spark, edge_docs(spark), "")
    assert stage.columns == edge_docs(spark).columns
    by_id = {r["text"]: r for r in stage.collect()}
    assert None in by_id and LONG in by_id
    hit = next(r for t, r in by_id.items() if t and t.startswith("mail"))
    assert hit["text"] == "mail [EMAIL], call [PHONE] or [IP], card [CARD]" and hit["n_chars"] == len(hit["text"])
    assert personal_data(spark, no_docs(spark), "").count() == 0
