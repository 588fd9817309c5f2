"""Mixing sources to target weights by a time-varying curriculum (operator 6).

A source's share of the mix is fixed by its weight, up to ``max_epochs`` times
its own size.  Its weight over training time is a schedule: the schedule is
integrated into a cumulative token demand, every copy of a document stands at
a place in its source's stream of tokens, and inverting the demand at that
place gives the copy's training position in [0, 1].  Sorting by position makes
the training order.

Only DataFrame functions; no driver-side data.  Running totals inside a
source come from bucket sums (a bucket is a range of the documents' hash
order), so that a source with a third of all rows is dealt over up to
``BUCKETS`` groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import renamed, word_count
from vaultline.session import ensure_checkpoint_dir

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
#: a document over 1 / FINE of its source's target is large
FINE = 20
Knots = Sequence[tuple[float, float]]

#: weights over time as (time, weight) knots, for the sources in turn: level, falling, rising
SCHEDULES: tuple[Knots, ...] = (
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
)
MIX_COLUMNS = ("size", "source_size", "target", "copies", "taken", "positions")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """Targets of the sources: ``sizes`` has (source, source_size), one row a
    source; adds ``turn`` (from 0, by code point, null last), ``weight`` and
    ``target``.

    Sources share the sum of all sizes by weight; what a target has above
    ``max_epochs`` times its source's size is shared again by weight.  The
    sources at their limit are those with the smallest limit per weight: one
    running sum over the sources in that order finds them all.  The table of
    sources is the only thing that is ordered as a whole.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(by_name) - 1
    wide = sizes.withColumn("turn", turn.cast("long"))
    wide = wide.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("turn") % len(weights) + 1).cast("int")))
    wide = wide.withColumn("limit", F.col("source_size") * F.lit(max_epochs))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "turn")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    wide = wide.withColumn("rate", left / F.sum("weight").over(rest))
    wide = wide.withColumn("at_limit", F.col("limit") <= F.col("rate") * F.col("weight"))
    # the first source below its limit has the rate of all that follow
    rate = F.min(F.when(~F.col("at_limit"), F.struct(F.col("limit") / F.col("weight"), "turn", "rate"))).over(whole)["rate"]
    target = F.when(F.col("at_limit"), F.col("limit").cast("double")).otherwise(rate * F.col("weight"))
    return wide.withColumn("target", target).select("source", "source_size", "turn", "target")


def _invert(share: Column, knots: Knots) -> Column:
    """Time at which the integral of the schedule, scaled to 1, reaches ``share``."""
    done, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        done.append((t0, w0, t1, w1, total))
        total += (t1 - t0) * (w0 + w1) / 2
    need = share * F.lit(total)
    out = None
    for t0, w0, t1, w1, base in reversed(done):
        slope = (w1 - w0) / (t1 - t0)
        more = F.greatest(need - F.lit(base), F.lit(0.0))
        # w0 * x + slope * x^2 / 2 = more, in the form that also holds for slope 0
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + more * (2 * slope), F.lit(0.0)))
        x = F.when(F.lit(w0) + root > 0, more * 2 / (F.lit(w0) + root)).otherwise(0.0)
        at = F.least(F.lit(t0) + x, F.lit(t1))
        out = at if out is None else F.when(need < F.lit(done[done.index((t0, w0, t1, w1, base)) + 1][4]), at).otherwise(out)
    return out


def position(share: Column, turn: Column, schedules: Sequence[Knots] = SCHEDULES) -> Column:
    """Training position of a share of a source's demand; sources take the
    schedules in turn."""
    out = _invert(share, schedules[-1])
    for k in range(len(schedules) - 2, -1, -1):
        out = F.when(turn % len(schedules) == k, _invert(share, schedules[k])).otherwise(out)
    return out


def mix_sources(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = (1, 2, 3), max_epochs: int = 3, schedules: Sequence[Knots] = SCHEDULES,
) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, MIX_COLUMNS, then ``key``,
    a hash of id, source and text.

    ``size`` is the text's words (null text: 0).  All documents of a source
    are taken floor(target / source_size) times.  The rest of the target goes
    to one more copy of some: documents stand in the order of a hash of the id
    (ties: id, size, text's hash); the large ones (over 1 / ``FINE`` of the
    target) are taken from the front up to their own share of the rest, the
    others up to what is then left, so that the mix ends within half a small
    document of the target wherever there are enough of them.  ``positions``
    holds the training position of every copy, ascending.  Equal rows take
    each other's places, so reruns agree; null ids and sources are ordinary
    values; documents without words are never taken; an empty table gives an
    empty result.
    """
    pick = [F.col(doc_id).alias("__id"), F.col(source).alias("__source"), word_count(F.col(text)).alias("__size")]
    order = F.xxhash64(F.col(doc_id).cast("string"))
    pick += [order.alias("__hash"), F.xxhash64(F.col(text)).alias("__text"), _key(doc_id, source, text).alias("__key")]
    rows = docs.select(*pick).withColumn("__bucket", F.shiftrightunsigned("__hash", 64 - BUCKET_BITS).cast("int"))
    ensure_checkpoint_dir(docs.sparkSession)
    rows = rows.checkpoint()  # the texts are read and counted once; what follows reads ids, sizes and hashes

    sizes = rows.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs).withColumnRenamed("source", "t_source")
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs))).otherwise(0)
    targets = targets.withColumn("whole", whole.cast("int"))
    targets = targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))

    large = F.when(F.col("__size") > F.col("target") / FINE, F.col("__size")).otherwise(F.lit(0).cast("long"))
    rows = rows.join(targets, rows["__source"].eqNullSafe(targets["t_source"])).withColumn("__large", large)
    sums = rows.groupBy("__source", "__bucket").agg(F.sum("__size").alias("sum"), F.sum("__large").alias("sum_large"))
    running = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(
        F.col("__source").alias("b_source"), F.col("__bucket").alias("b_bucket"),
        F.coalesce(F.sum("sum").over(running), F.lit(0)).alias("base"), F.coalesce(F.sum("sum_large").over(running), F.lit(0)).alias("base_large"),
        F.sum("sum_large").over(Window.partitionBy("__source")).alias("all_large"),
    )
    inside = Window.partitionBy("__source", "__bucket").orderBy("__hash", "__id", "__size", "__text").rowsBetween(Window.unboundedPreceding, -1)

    def placed(part: DataFrame) -> DataFrame:
        both = part.join(base, part["__source"].eqNullSafe(base["b_source"]) & (part["__bucket"] == base["b_bucket"]))
        start = F.col("base") + F.coalesce(F.sum("__size").over(inside), F.lit(0))
        start_large = F.col("base_large") + F.coalesce(F.sum("__large").over(inside), F.lit(0))
        out = both.withColumn("start", start).withColumn("start_large", start_large)
        share = F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(0.0)
        fits = F.col("start_large") + F.col("__large") / 2 <= F.col("all_large") * share
        return out.withColumn("more_large", fits & (F.col("__large") > 0) & (F.col("whole") < max_epochs))

    taken_large = placed(rows.where(F.col("__large") > 0)).where("more_large").groupBy(F.col("__source").alias("l_source")).agg(F.sum("__large").alias("got_large"))
    both = placed(rows)
    both = both.join(taken_large, both["__source"].eqNullSafe(taken_large["l_source"]), "left")
    small = F.col("start") - F.col("start_large") + F.col("__size") / 2 <= F.col("rest") - F.coalesce(F.col("got_large"), F.lit(0))
    more = F.when(F.col("__large") > 0, F.col("more_large")).otherwise(small & (F.col("whole") < max_epochs))
    both = both.withColumn("copies", F.when(F.col("__size") > 0, F.col("whole") + more.cast("int")).otherwise(0))
    places = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda e: _place(e, schedules))).otherwise(
        F.array().cast("array<double>")
    )
    return both.select(
        F.col("__id").alias(doc_id), F.col("__source").alias(source), F.col("__size").alias("size"), "source_size", "target", "copies",
        (F.col("__size") * F.col("copies")).cast("long").alias("taken"), places.alias("positions"), F.col("__key").alias("key"),
    )


def _place(epoch: Column, schedules: Sequence[Knots]) -> Column:
    """Training position of the middle of the document's copy number ``epoch``;
    the copies of the last, partial round are spread over the whole of it."""
    middle = F.col("start") + F.col("__size") / 2
    at = F.when(epoch < F.col("whole"), middle).otherwise(middle * F.col("rest") / F.col("source_size"))
    return position(F.least((epoch * F.col("source_size") + at) / F.col("target"), F.lit(1.0)), F.col("turn"), schedules)


def _key(doc_id: str, source: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.col(source), F.xxhash64(F.col(text)))


def training_places(mixed: DataFrame, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """``mixed`` (of ``mix_sources``) with ``places``: the number, from 0, of
    every copy in the training order, ascending as ``positions``.

    All copies are range-sorted by position (ties: id, source, key); a copy's
    number is its place in its sorted range plus the rows of the ranges before,
    so only one row a range is summed up as a whole."""
    ensure_checkpoint_dir(mixed.sparkSession)
    rows = mixed.withColumn("__row", F.monotonically_increasing_id()).checkpoint()  # the row numbers must not change
    copies = rows.select("__row", doc_id, source, "key", F.explode("positions").alias("__position"))
    ordered = copies.orderBy("__position", doc_id, source, "key", "__row").select("__row", F.monotonically_increasing_id().alias("__at"))
    ordered = ordered.checkpoint()  # an id tells the range (above 33 bits) and the place in it
    ordered = ordered.select("__row", F.shiftright("__at", 33).alias("__range"), F.col("__at").bitwiseAND((1 << 33) - 1).alias("__at"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    base = ordered.groupBy("__range").agg(F.count("*").alias("__n"))
    base = base.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    places = ordered.join(F.broadcast(base), "__range").groupBy("__row").agg(F.sort_array(F.collect_list(F.col("__base") + F.col("__at"))).alias("places"))
    out = rows.join(places, "__row", "left")
    return out.select(*mixed.columns, F.coalesce("places", F.array().cast("array<long>")).alias("places"))


def training_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **mix) -> DataFrame:
    """The mix itself: the rows of ``docs``, one for every copy taken,
    range-sorted by training position (ties by id).

    The mix is made of ids, sizes and hashes alone; texts move twice, to the
    positions of their row and to their place in the order.  Rows of one key
    (equal id, source and text) take its positions in the order of their
    other columns."""
    src, at = renamed(docs)
    key_cols = at[doc_id], at[source], at[text]
    mixed = mix_sources(src, at[doc_id], at[text], at[source], **mix).where("copies > 0")
    lists = mixed.groupBy("key").agg(F.sort_array(F.collect_list("positions")).alias("lists")).withColumnRenamed("key", "m_key")
    keyed = src.withColumn("key", _key(*key_cols))
    both = keyed.join(lists, keyed["key"] == lists["m_key"])
    others = [c for c in src.columns if c != at[text]]
    nth = F.row_number().over(Window.partitionBy("key").orderBy(*others))
    copies = both.withColumn("nth", nth).select(*src.columns, F.explode(F.try_element_at("lists", F.col("nth"))).alias("position"))
    return copies.orderBy("position", at[doc_id]).select(*src.columns).toDF(*docs.columns)
