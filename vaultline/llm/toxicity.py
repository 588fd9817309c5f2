"""Toxicity by subword-bag embeddings and a linear softmax (operator 5).

The character n-grams of a text's words, with a mark at each word's start and
end, hash into buckets; each bucket has a small vector; a text is the average
of its vectors, and a linear softmax over it gives the label.  Vectors and
softmax are trained jointly in numpy on a bounded sample of labelled rows.  An
unseen misspelling or inflection shares most n-grams, and so most of its
vector, with the words seen.

As everything after the buckets is linear, scoring needs one number for each
bucket: the difference of the two classes' products with its vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import by_size, renamed
from vaultline.session import ensure_checkpoint_dir

_SPACE = str.maketrans({c: " " for c in "\t\n\r\x0b\f"})
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class ToxicityRules:
    """Bounds of the sample and of the training."""

    rows_per_label: int = 2000  # the smallest by a hash of the id, for each label
    bytes_per_label: int = 64 << 20  # of their texts in UTF-8; a row that does not fit any more is passed over
    grams: tuple[int, ...] = (3, 4, 5)
    bucket_bits: int = 18
    dimension: int = 8
    epochs: int = 12
    batch: int = 64
    rate: float = 1.0
    decay: float = 0.015  # of the vectors, each step, times the rate
    least_texts: int = 2  # buckets in fewer of the sample's texts have no vector
    held: int = 5  # every so many sample rows calibrate instead of training
    seed: int = 11


def units(texts: list[str], rules: ToxicityRules) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of several texts, and for each the text's number."""
    flat = " ".join(["", *(t.translate(_SPACE).lower() for t in texts), ""])
    chars = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(t.translate(_SPACE).lower()) + 1 for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)  # a text's characters and the space before it
    owner = np.append(owner, len(texts) - 1) if len(texts) else owner
    space = chars == 32
    before = np.concatenate(([0], np.cumsum(space)))
    out, of = [], []
    code = chars.copy()
    for n in range(2, max(rules.grams) + 1):
        code = code[:-1] * _MIX + chars[n - 1 :]
        code ^= code >> np.uint64(29)
        if n in rules.grams:
            at = np.arange(len(code))
            inner = before[at + n - 1] - before[at + 1]  # spaces strictly inside
            keep = np.flatnonzero((inner == 0) & ~(space[at] & space[at + 1]) & ~(space[at + n - 1] & space[at + n - 2]))
            out.append(((code[keep] * _MIX) >> np.uint64(64 - rules.bucket_bits)).astype(np.int32))
            of.append(owner[keep])
    return np.concatenate(out), np.concatenate(of)


@dataclass
class Model:
    """What scoring needs: one number for each bucket (0: no vector), which
    buckets have one, and the offset."""

    value: np.ndarray
    bias: float
    rules: ToxicityRules

    def logits(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        u, of = units(texts, self.rules)
        total = np.bincount(of, weights=self.value[u], minlength=len(texts))
        n = np.bincount(of, weights=self.value[u] != 0, minlength=len(texts))
        return np.divide(total, n, out=np.zeros(len(texts)), where=n > 0) + self.bias

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -700, 700)))


def train(texts: list[str], labels: np.ndarray, share: float, rules: ToxicityRules) -> Model:
    """Joint training by mini-batches with Adam, then calibration: a slope and
    offset of the logit from the held rows, weighted so that label 1 has its
    ``share`` of all labelled rows."""
    size = 1 << rules.bucket_bits
    none = Model(np.zeros(size), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))), rules)
    if len(set(labels.tolist())) < 2:
        return none
    every = np.arange(len(texts)) % rules.held == rules.held - 1
    if len(set(labels[~every].tolist())) < 2:
        every[:] = False
    checks, check_labels = [t for t, h in zip(texts, every, strict=True) if h], labels[every]
    texts, labels = [t for t, h in zip(texts, every, strict=True) if not h], labels[~every]
    rows = []
    for begin in range(0, len(texts), 200):
        u, of = units(texts[begin : begin + 200], rules)
        key, n = np.unique(of * size + u, return_counts=True)
        rows += [(key[a:b] % size, n[a:b]) for a, b in zip(*(lambda c: (c[:-1], c[1:]))(np.searchsorted(key // size, np.arange(min(200, len(texts) - begin) + 1))), strict=True)]
    frequency = np.zeros(size, np.int64)
    for u, _ in rows:
        frequency[u] += 1
    live = frequency >= rules.least_texts
    slot = np.cumsum(live) - 1
    data = []
    for u, n in rows:
        ok = live[u]
        data.append((slot[u[ok]].astype(np.int32), (n[ok] / max(1, n[ok].sum())).astype(np.float32)))
    rng = np.random.default_rng(rules.seed)
    k = int(live.sum())
    vec = rng.uniform(-1, 1, (k, rules.dimension)).astype(np.float32) / rules.dimension
    soft = rng.standard_normal((rules.dimension, 2)).astype(np.float32) * 0.1
    bias = np.zeros(2, np.float32)
    params = [vec, soft, bias]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    goal = np.eye(2, dtype=np.float32)[labels.astype(int)]
    step = 0
    total = max(1, rules.epochs * -(-len(data) // rules.batch))
    for _ in range(rules.epochs):
        order = rng.permutation(len(data))
        for begin in range(0, len(order), rules.batch):
            pick = order[begin : begin + rules.batch]
            ids = np.concatenate([data[i][0] for i in pick])
            w = np.concatenate([data[i][1] for i in pick])
            row = np.repeat(np.arange(len(pick)), [len(data[i][0]) for i in pick])
            hidden = np.stack([np.bincount(row, weights=vec[ids, j] * w, minlength=len(pick)) for j in range(rules.dimension)], axis=1).astype(np.float32)
            logit = hidden @ soft + bias
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            err = (p - goal[pick]) / len(pick)
            back = err @ soft.T
            grad_vec = np.stack([np.bincount(ids, weights=back[row, j] * w, minlength=k) for j in range(rules.dimension)], axis=1).astype(np.float32)
            step += 1
            rate = rules.rate * (1 - (step - 1) / total)
            for p_, g, m_, v_, r in zip(params, (grad_vec, hidden.T @ err, err.sum(axis=0)), m, v, (rate, rate * 0.1, rate * 0.1), strict=True):
                m_ *= 0.9
                m_ += 0.1 * g
                v_ *= 0.99
                v_ += 0.01 * g * g
                if p_ is vec:
                    p_ *= 1 - r * rules.decay
                p_ -= r * (m_ / (1 - 0.9**step)) / (np.sqrt(v_ / (1 - 0.99**step)) + 1e-8)
    value = np.zeros(size)
    value[live] = vec @ (soft[:, 1] - soft[:, 0])
    even = labels.mean()
    prior = np.log(share / (1 - share)) - np.log(even / (1 - even))
    model = Model(value, float(bias[1] - bias[0] + prior), rules)
    if len(set(check_labels.tolist())) == 2:
        model = _calibrated(model, checks, check_labels, share)
    return model


def _calibrated(model: Model, texts: list[str], labels: np.ndarray, share: float) -> Model:
    """Weighted logistic regression of the label on the logit, kept near the
    logit itself by a small ridge."""
    logit = np.concatenate([model.logits(texts[i : i + 200]) for i in range(0, len(texts), 200)])
    scale = max(1.0, float(np.abs(logit).std()))
    x = np.stack([logit / scale, np.ones(len(logit))], axis=1)
    weight = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    start = np.array([scale, 0.0])
    beta = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        grad = x.T @ (weight * (labels - p)) - 0.01 * (beta - start)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        beta = beta + np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-6:
            break
    slope = beta[0] / scale
    if slope <= 0:  # too few rows to tell
        return model
    return Model(model.value * slope, float(model.bias * slope + beta[1]), model.rules)


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, rules: ToxicityRules = ToxicityRules(), doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model of the labelled rows for which ``learn`` (a condition on the
    id) holds.  The driver gets at most ``rows_per_label`` texts a label, those
    with the smallest hashes of their ids, and at most ``bytes_per_label`` of
    them.  An id is one row: the greatest of its labels, the least of its
    texts by code point (null as empty).  Null ids teach nothing."""
    ensure_checkpoint_dir(docs.sparkSession)
    known = labels.where(learn & F.col(label).isNotNull()).select(F.col(doc_id).alias("k_id"), (F.col(label) == 1).cast("int").alias("k_label"))
    known = known.groupBy("k_id").agg(F.max("k_label").alias("k_label"))
    counts = {r["k_label"]: r["count"] for r in known.groupBy("k_label").count().collect()}
    key = F.xxhash64(F.col("k_id").cast("string"))
    picks = [known.where(F.col("k_label") == v).orderBy(key, "k_id").limit(rules.rows_per_label) for v in (0, 1)]
    picked = F.broadcast(picks[0].unionByName(picks[1]))  # bounded by the rules
    texts = docs.join(picked, F.col(doc_id) == F.col("k_id")).select("k_id", "k_label", F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.groupBy("k_id", "k_label").agg(F.min("text").alias("text")).withColumn("h", F.xxhash64("k_id", "text")).checkpoint()
    sizes = texts.select("k_id", "k_label", F.octet_length("text").alias("bytes"), key.alias("h")).collect()
    room = {v: rules.bytes_per_label for v in (0, 1)}
    fits = []
    for r in sorted(sizes, key=lambda r: (r["h"], r["k_id"])):
        if r["bytes"] <= room[r["k_label"]]:
            room[r["k_label"]] -= r["bytes"]
            fits.append(r["k_id"])
    rows = texts.where(F.col("k_id").isin(fits)).collect()
    rows.sort(key=lambda r: (r["h"], r["k_label"], r["text"]))
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    return train([r["text"] for r in rows], np.array([r["k_label"] for r in rows]), share, rules)


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) with ``score``, 0 to 1, and
    ``predicted`` (score >= 0.5); of equal names the table's own comes as
    ``in_`` and the name.  Null and empty texts, and those without a known
    n-gram, get the model's offset.  Rows are scored one by one, whole; an
    empty table gives an empty result.  The broadcast model is of fixed size."""
    keep = docs.columns if keep is None else keep
    names = [f"in_{c}" if c in ("score", "predicted") else c for c in keep]
    src, at = renamed(docs)
    src = src.select(F.coalesce(at[text], F.lit("")).alias("text"), *(at[c] for c in keep))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, "text", 1 << 20):
            p = held.value.scores(b.column(0).to_pylist())
            cols = [*b.columns[1:], pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[1:], "score", "predicted"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[1:]]
    return src.mapInArrow(run, ", ".join([*fields, "score double, predicted int"])).toDF(*names, "score", "predicted")
