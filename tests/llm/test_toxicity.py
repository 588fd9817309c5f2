import random
import re

import numpy as np
from pyspark.sql import functions as F

from tests.llm.cases import edge_docs, edge_rows, no_docs
from vaultline.llm.toxicity import ToxicityRules, fit_toxicity, score_toxicity, train, units

BAD = ["idiotic", "moronish", "scumbag"]


def corpus(n, seed, bad=BAD):
    rng = random.Random(seed)
    syllables = ["ta", "re", "mon", "li", "ve", "su", "ka", "no", "per"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    rows = []
    for k in range(n):
        text = [word() for _ in range(60)]
        if k % 4 == 0:
            for _ in range(3):
                text[rng.randrange(60)] = rng.choice(bad)
        rows.append((k, " ".join(text), int(k % 4 == 0)))
    return rows


def test_units_are_n_grams_inside_words():
    rules = ToxicityRules(grams=(3,))
    u, of = units(["ab c", "", "ab"], rules)
    assert of.tolist() == [0, 0, 0, 2, 2]  # " ab", "ab ", " c "; " ab", "ab "
    assert u[0] == u[3] and u[1] == u[4]
    assert len(units([], rules)[0]) == 0


def plain_logit(model, text):
    """The average over n-grams one by one, each hashed on its own."""
    mask, mix = (1 << 64) - 1, 0x9E3779B97F4A7C15
    total = n = 0
    for word in re.split("[ \t\n\r\x0b\f]+", text.lower()):
        marked = f" {word} "
        for size in model.rules.grams:
            for at in range(len(marked) - size + 1 if word else 0):
                code = ord(marked[at])
                for c in marked[at + 1 : at + size]:
                    code = (code * mix + ord(c)) & mask
                    code ^= code >> 29
                value = model.value[((code * mix) & mask) >> (64 - model.rules.bucket_bits)]
                total, n = total + value, n + (value != 0)
    return (total / n if n else 0.0) + model.bias


def test_logits_against_a_plain_loop():
    rows = corpus(200, 9)
    model = train([t for _, t, _ in rows], np.array([y for *_, y in rows]), 0.25, ToxicityRules())
    texts = [t for _, t, _ in corpus(30, 10)] + ["", "a", " a  b ", "Tab\tand\nLINE\x0b\fend", "é ß İ 漢字 😀", "idiotic", "  ", "never"]
    assert np.allclose(model.logits(texts), [plain_logit(model, t) for t in texts], atol=1e-12)


def test_rare_words_have_vectors():
    rows = corpus(1000, 11)
    texts, y = [t for _, t, _ in rows], np.array([x for *_, x in rows])
    rare = [k for k in range(1000) if y[k] == 0][:3]
    for k in rare:  # a word in three of a thousand texts
        texts[k] += " qwxzy" * 6
        y[k] = 1
    model = train(texts, y, 0.25, ToxicityRules(held=1000))
    plain = [t for _, t, x in corpus(40, 12) if x == 0]
    assert all(b > a for a, b in zip(model.scores(plain), model.scores([t + " qwxzy" * 3 for t in plain]), strict=True))


def test_repeated_ids_and_long_texts_stay_within_the_sample(spark):
    rows = corpus(200, 13)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    once = fit_toxicity(docs, labels, F.lit(True))
    # copies of rows, a later text under the same ids, rows without an id
    more = docs.union(docs).union(docs.select("doc_id", F.concat(F.lit("\U0010ffff"), "text"))).union(docs.select(F.lit(None).cast("long"), "text"))
    again = fit_toxicity(more, labels.union(labels).union(labels.select(F.lit(None).cast("long"), "toxic")).where("doc_id is not null"), F.lit(True))
    assert np.array_equal(once.value, again.value) and once.bias == again.bias
    # one long text does not fit: it is passed over, the others teach as before
    long = docs.withColumn("text", F.when(F.col("doc_id") == 7, F.repeat("text", 10_000)).otherwise(F.col("text")))
    rules = ToxicityRules(bytes_per_label=1 << 20)
    a, b = fit_toxicity(long, labels, F.lit(True), rules), fit_toxicity(docs.where("doc_id <> 7"), labels, F.lit(True), rules)
    assert np.array_equal(a.value, b.value) and a.bias == b.bias


def test_misspellings_are_caught(spark):
    rows = corpus(600, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit_toxicity(docs.drop("toxic"), docs.select("doc_id", "toxic"), F.lit(True))
    seen = corpus(200, 2)
    unseen = corpus(200, 3, ["idiotics", "moronisch", "scumbagz"])
    for rows in (seen, unseen):
        p = model.scores([t for _, t, _ in rows])
        y = np.array([x for *_, x in rows])
        assert ((p >= 0.5) == y).mean() > 0.95


def test_labels_outside_learn_are_not_used(spark):
    docs = spark.createDataFrame(corpus(200, 5), "doc_id long, text string, toxic int")
    flipped = docs.withColumn("toxic", F.when(F.col("doc_id") % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    learn = F.col("doc_id") % 5 != 0
    a, b = (fit_toxicity(docs, x.select("doc_id", "toxic"), learn) for x in (docs, flipped))
    assert np.array_equal(a.value, b.value) and a.bias == b.bias


def test_one_class_and_edge_rows(spark):
    model = train(["a b", "c d"], np.array([0, 0]), 0.0, ToxicityRules())
    got = score_toxicity(edge_docs(spark), model)
    rows = got.collect()
    assert len(rows) == len(edge_rows()) and "in_score" in got.columns
    assert all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in rows)
    assert score_toxicity(no_docs(spark), model).count() == 0
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert fit_toxicity(no_docs(spark), empty, F.lit(True)).scores([""])[0] < 0.5
