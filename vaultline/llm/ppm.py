"""Language-model score by prediction by partial matching (operator 2).

A byte-context trie of fixed order, learned from the training rows, gives the
probability of each next byte: by the longest context seen, with PPM-C escape
estimates (as many escapes as distinct symbols) and exclusion of the symbols
of longer contexts.  The code length of a text is the sum over its bytes and
one end symbol.

The trie never sits in one place.  Its leaves, the (context, symbol) counts,
are a table; contexts that end in the same two symbols form a branch, in which
all longer orders are computed together; the two shortest orders are tables of
fixed size.  Documents are dealt into chunks of bounded size; a chunk asks
for the distinct leaves and words it holds, a join brings the answers, and the
chunk scores its documents.  What moves is texts once and distinct keys of
each chunk, and it grows with the input.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import by_size, text_bytes
from vaultline.session import scratch_path

BITS = 9  # of a symbol: 0 is a text's end, and what stands before its start; byte b is b + 1
SYMBOLS = 257
ORDER = 4
CHUNK_BYTES = 24 << 20
_PART_BYTES = 2 << 20
_LOWER = bytes(range(256)).lower()
_GRAM, _WORD = b"g", b"w"


def leaves(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, symbol) codes of every byte and the end of each text, laid
    end to end, and where each text's begin."""
    pad = np.zeros(order, np.int64)
    parts = []
    for t in texts:
        parts += [pad, np.frombuffer(t, np.uint8).astype(np.int64) + 1, np.zeros(1, np.int64)]
    n = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(n)))
    if not len(texts):
        return np.empty(0, np.int64), starts
    x = np.concatenate(parts)
    code = np.zeros(len(x) - order, np.int64)
    for k in range(order + 1):
        code = (code << BITS) | x[k : len(x) - order + k]
    # windows that begin in a text's end or run over it belong to no text
    keep = np.ones(len(code), bool)
    for k, s in enumerate(starts[1:-1]):
        at = s + order * k
        keep[at : at + order] = False
    return code[keep], starts


def branch_costs(code: np.ndarray, count: np.ndarray, low: np.ndarray, order: int = ORDER) -> np.ndarray:
    """log10 probability of each leaf of one branch.

    ``code``: all distinct leaves whose contexts end in the same two symbols;
    ``count``: how often each was seen in training (0: asked for only);
    ``low``: counts of (last symbol, next symbol), SYMBOLS x SYMBOLS."""
    mask = (1 << BITS) - 1
    y = code & mask
    out = np.zeros(len(code))
    done = np.zeros(len(code), bool)
    gone, gone_distinct = np.zeros(len(code)), np.zeros(len(code))  # what a longer context has excluded

    def level(total, distinct, own):
        """One context: answer if the symbol is there, else escape."""
        t, d = total - gone, distinct - gone_distinct
        seen = ~done & (total > 0)
        hit = seen & (own > 0)
        out[hit] += np.log10(own[hit] / (t[hit] + d[hit]))
        esc = seen & ~hit & (d > 0)
        out[esc] += np.log10(d[esc] / (t[esc] + d[esc]))
        done[hit] = True
        return seen & ~hit

    last = (code >> BITS) & mask
    for o in range(order, -1, -1):
        if o >= 2:
            key = code & ((1 << (BITS * (o + 1))) - 1)
            entry, at = np.unique(key, return_inverse=True)
            n = np.bincount(at, weights=count, minlength=len(entry))
            ctx, of = np.unique(entry >> BITS, return_inverse=True)
            total = np.bincount(of, weights=n, minlength=len(ctx))
            distinct = np.bincount(of, weights=n > 0, minlength=len(ctx))
            # counts of the same symbols in the next shorter context
            if o > 2:
                short = entry & ((1 << (BITS * o)) - 1)
                s_entry, s_at = np.unique(short, return_inverse=True)
                below = np.bincount(s_at, weights=n, minlength=len(s_entry))[s_at]
            else:
                below = low[(entry >> BITS) & mask, entry & mask].astype(float)
            excluded = np.bincount(of, weights=np.where(n > 0, below, 0.0), minlength=len(ctx))
            c = of[at]
            left = level(total[c], distinct[c], n[at])
            gone, gone_distinct = np.where(left, excluded[c], gone), np.where(left, distinct[c], gone_distinct)
        elif o == 1:
            sums, kinds = low.sum(axis=1).astype(float), (low > 0).sum(axis=1).astype(float)
            base = low.sum(axis=0)
            excluded = np.where(low > 0, base[None, :], 0).sum(axis=1).astype(float)
            left = level(sums[last], kinds[last], low[last, y].astype(float))
            gone, gone_distinct = np.where(left, excluded[last], gone), np.where(left, kinds[last], gone_distinct)
        else:
            base = low.sum(axis=0)
            size, kinds = float(base.sum()), float((base > 0).sum())
            level(np.full(len(code), size), np.full(len(code), kinds), base[y].astype(float))
            out[~done] -= np.log10(SYMBOLS - kinds)
    return out


def _gram_keys(codes: np.ndarray) -> list[bytes]:
    raw = codes.astype(">i8").tobytes()
    return [_GRAM + raw[i : i + 8] for i in range(0, len(raw), 8)]


def count_table(docs: DataFrame, train: Column, text: str, order: int = ORDER) -> DataFrame:
    """(key, n): leaves and words with their training counts; leaves of other
    rows come with 0.  Tasks count what they read before anything moves."""
    src = docs.select(train.cast("int").alias("train"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        found: list[tuple[np.ndarray, np.ndarray]] = []  # leaves and counts, merged now and then

        def merged() -> tuple[np.ndarray, np.ndarray]:
            if not found:
                return np.empty(0, np.int64), np.empty(0, np.int64)
            codes, at = np.unique(np.concatenate([u for u, _ in found]), return_inverse=True)
            return codes, np.bincount(at, weights=np.concatenate([n for _, n in found]), minlength=len(codes)).astype(np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            codes, sums = merged()
            for keys, n in ((_gram_keys(codes), sums.tolist()), ([_WORD + w for w in words], list(words.values()))):
                for i in range(0, len(keys), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 50_000], pa.binary()), pa.array(n[i : i + 50_000], pa.int64())], names=["key", "n"])

        for b in by_size(batches, "text", _PART_BYTES):
            texts = [t.translate(_LOWER) for t in text_bytes(b.column(1))]
            learn = np.array([bool(x) for x in b.column(0).to_pylist()])
            for t, yes in zip(texts, learn, strict=True):
                if yes:
                    words.update(t.split())
                    words[b""] += 1  # the end, counted as a token
            for yes in (True, False):
                u, n = np.unique(leaves([t for t, x in zip(texts, learn, strict=True) if x == yes], order)[0], return_counts=True)
                found.append((u, n if yes else np.zeros(len(u), np.int64)))
            if sum(len(u) for u, _ in found) > 1_000_000:
                found = [merged()]
            if len(words) > 600_000 or len(found[0][0]) > 900_000:  # partial counts add up anyway
                yield from flush()
                words.clear()
                found = []
        yield from flush()

    return src.mapInArrow(run, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _code(key: Column) -> Column:
    return F.conv(F.hex(F.substring(key, 2, 8)), 16, 10).cast("long")


def leaf_costs(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, value): log10 probability of each of the leaves (key, n).  A
    branch has at most SYMBOLS^(order - 1) rows, whatever the corpus; the
    table of the shortest orders has at most SYMBOLS^2."""
    coded = grams.select("key", _code(F.col("key")).alias("code"), "n")
    pair = coded.groupBy(F.expr(f"code & {(1 << 2 * BITS) - 1}").alias("pair")).agg(F.sum("n").alias("n"))
    low = np.zeros((SYMBOLS, SYMBOLS), np.int64)
    for r in pair.collect():
        low[r["pair"] >> BITS, r["pair"] & ((1 << BITS) - 1)] = r["n"]

    def branch(table: pa.Table) -> pa.Table:
        cost = branch_costs(table["code"].to_numpy(), table["n"].to_numpy(), low, order)
        return pa.table({"key": table["key"], "value": pa.array(cost)})

    tail = F.expr(f"(code >> {BITS}) & {(1 << 2 * BITS) - 1}")
    return coded.withColumn("tail", tail).groupBy("tail").applyInArrow(branch, "key binary, value double")


def _parts(texts: pa.ChunkedArray) -> Iterator[list[bytes]]:
    """The texts in lower case, some megabytes at a time."""
    part, size = [], 0
    for block in texts.chunks:
        for begin in range(0, len(block), 256):
            for t in text_bytes(block.slice(begin, 256)):
                part.append(t.translate(_LOWER))
                size += len(t)
                if size >= _PART_BYTES:
                    yield part
                    part, size = [], 0
    if part:
        yield part


_UNSEEN = float(np.log10(0.5))


class _Logs(dict):
    """log10(count + 0.5) of a word; no known word has that of count 0."""

    def __missing__(self, word: bytes) -> float:
        return _UNSEEN


def ppm_score(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per document: doc_id, the ``carry`` columns, n_tokens, n_known,
    train_tokens, base_score and score.

    ``train`` marks the rows to learn from (pretrained mode).  The score is
    the log10 probability of the text's bytes, A-Z in lower case, and its end;
    the base score is that of a smoothed unigram of words.  Null and empty
    texts are just the end.  Equal rows count and are scored one by one.  With
    no training rows all symbols are alike, and the base score is that of one
    unseen token kind.  An empty table gives an empty result."""
    spark = docs.sparkSession
    path = scratch_path(spark, "ppm")
    count_table(docs, train, text, order).write.parquet(path)
    counts = spark.read.parquet(path)
    is_word = F.substring("key", 1, 1) == F.lit(_WORD)
    words = counts.where(is_word & (F.col("n") > 0)).select("key", F.col("n").cast("double").alias("value"))
    row = words.agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("N"), F.count("*").alias("V")).first()
    size, kinds = int(row["N"]), int(row["V"])
    ends = words.where(F.col("key") == F.lit(_WORD)).select("value").collect()
    end_count = float(ends[0]["value"]) if ends else 0.0
    model = leaf_costs(counts.where(~is_word), order).unionByName(words)

    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, -(-int(total) // CHUNK_BYTES))
    carry = carry or {}
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *(c.alias(f"c_{k}") for k, c in carry.items()))
    src = src.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int")).repartition(chunks, "chunk")

    def ask(table: pa.Table) -> pa.Table:
        """The distinct leaves and words of a chunk."""
        lists, known = [np.empty(0, np.int64)], set()
        for part in _parts(table["text"]):
            lists.append(np.unique(leaves(part, order)[0]))
            if sum(map(len, lists)) > 1_000_000:
                lists = [np.unique(np.concatenate(lists))]
            for t in part:
                known.update(t.split())
        grams = pa.array(_gram_keys(np.unique(np.concatenate(lists))), pa.binary())
        keys = pa.chunked_array([grams, pa.array([_WORD + w for w in known], pa.binary())])
        chunk = table["chunk"][0].as_py() if table.num_rows else 0
        return pa.table({"chunk": pa.array(np.full(len(keys), chunk, np.int32)), "key": keys})

    asked = src.groupBy("chunk").applyInArrow(ask, "chunk int, key binary")
    answers = asked.join(model, "key").select("chunk", is_word.alias("is_word"), F.expr("substring(key, 2)").alias("key"), "value")
    names = [f"c_{k}" for k in carry]

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        grams, known = right.filter(pc.invert(right["is_word"])).select(["key", "value"]), right.filter(right["is_word"]).select(["key", "value"])
        codes = np.frombuffer(b"".join(grams["key"].to_pylist()), ">i8").astype(np.int64)
        order_ = np.argsort(codes)
        codes, cost = codes[order_], grams["value"].to_numpy()[order_]
        logs = _Logs()
        for block in known.to_batches(max_chunksize=50_000):
            logs.update(zip(block.column(0).to_pylist(), np.log10(block.column(1).to_numpy() + 0.5).tolist(), strict=True))
        scale, end_log = np.log10(size + 0.5 * (kinds + 1)), np.log10(end_count + 0.5)
        n_tokens, n_known, base, score_ = [], [], [], []
        for part in _parts(left["text"]):
            code, starts = leaves(part, order)
            score_ += np.add.reduceat(cost[np.searchsorted(codes, code)], starts[:-1]).tolist()
            for t in part:
                each = list(map(logs.__getitem__, t.split()))
                n_tokens.append(len(each) + 1)
                n_known.append(len(each) - each.count(_UNSEEN) + (end_count > 0))
                base.append(sum(each) + end_log - (len(each) + 1) * scale)
        cols = {"doc_id": left["doc_id"], **{n: left[n] for n in names}}
        more = {"n_tokens": n_tokens, "n_known": n_known, "train_tokens": [size] * len(base)}
        out = {**cols, **{k: pa.array(v, pa.int64()) for k, v in more.items()}}
        out |= {"base_score": pa.array(np.array(base, float)), "score": pa.array(np.array(score_, float))}
        return pa.table(out)

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields if f.name == "doc_id" or f.name in names)
    done = src.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, f"{kept}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return done.withColumnsRenamed({f"c_{k}": k for k in carry})
