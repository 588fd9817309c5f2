"""Personal data by candidate gradient boosting (operator 3), native.

Fixed rules find the base spans.  High-recall generators propose looser spans
of the same kinds, which overlap: a run of digit groups is proposed whole and
with groups left off at either end, as numbers side by side look like one.
Boosted trees score each by its format
and context, and a threshold per kind, calibrated for precision, selects which
of them are redacted too.  The trees learn from a bounded sample, for each
kind, of documents that hold proposals.  Positive are base spans rewritten in
loose forms that the rules miss, and proposals with evidence of their own
(check sums, cue words, structure of hosts and numbers); negative are the same
forms with that evidence broken, and proposals without any.  Proposals that
overlap a base span of their kind teach nothing, as they add nothing.  A few
fixed texts join every sample, so that a small table is scored as well.
Finding, scoring, selecting and redacting are DataFrame functions in one
narrow pass; Python runs on the driver alone, to fit the trees.

Positions of regular-expression matches come from ``split`` and
``regexp_extract_all`` with the same pattern: pieces and matches alternate, so
their running lengths are the spans.  Patterns are possessive: long runs cost
linear time and no stack.
"""

from __future__ import annotations

import random
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.boosting import Boosted, calibrate, fit
from vaultline.llm.common import renamed
from vaultline.session import ensure_checkpoint_dir

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
#: a match begins where its run of characters does, or where the last match ended: the leftmost one does anyway
_PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_AT = r"(?:@| @ | ?[\[({<] ?(?i:at) ?[\])}>] ?)"
_DOT = r"(?: ?[\[({<] ?(?:\.|(?i:dot)) ?[\])}>] ?)"
_WORD = r"[\p{L}\p{N}._%+'-]"
_LABEL = r"[\p{L}\p{N}-]{1,63}+"
#: looser forms of the same kinds: spaced or spelled at-signs and dots, letters beyond ASCII, any quadruple, long digit groups, numbers without a plus
_PROPOSALS = {
    "email": rf"(?<!{_WORD}){_WORD}{{1,64}}+{_AT}{_LABEL}(?:(?:\.|{_DOT}){_LABEL}){{0,8}}+",
    "ip": rf"(?<![0-9])[0-9]{{1,4}}+(?:(?:[.,:]|{_DOT})[0-9]{{1,4}}+){{3}}(?![0-9])",
    "card": r"(?<![0-9])(?:(?:[0-9]{4}[ ./_-]{1,2}){3}[0-9]{4}|[0-9](?:[ ./_-]{0,2}[0-9]){11,18})(?![0-9])",
    "phone": r"(?<![0-9])[+(]{0,2}[0-9]{1,4}[)]?(?:(?:[ ./-]{1,2}|(?<=[)]))[(]?[0-9]{2,4}[)]?){2,4}(?![0-9])",
}
_MAY = {
    "email": lambda t: F.contains(t, F.lit("@")) | t.rlike(r"[\[({<] ?(?i:at) ?[\])}>]"),
    "ip": lambda t: t.rlike(rf"[0-9](?:[.,:]|{_DOT})[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[ ./_-]{0,2}[0-9]){10}"),
    "phone": lambda t: t.rlike(r"[0-9][ ()./-][ ()./0-9-]*[0-9]|\+[0-9]"),
}
_CUES = (r"(?i)(?:tel|phone|call|fax|mobile|cell)", r"(?i)(?:card|visa|credit|pay)", r"(?i)(?:mail|contact|write)", r"(?i)(?:\bip\b|host|server|addr)")


@dataclass(frozen=True)
class PiiRules:
    """Bounds of the training sample and the aim of the thresholds."""

    sample_documents: int = 2000  # for each kind, of those that hold proposals: the smallest by a hash
    sample_proposals: int = 20000  # for each kind
    precision: float = 0.95


def _found(text: Column, pattern: str, may: Column) -> tuple[Column, Column]:
    """Matches of a pattern, and the pieces around them; null where it can't match."""
    return F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), F.when(may, F.split(text, pattern, -1))


def _spans(matches: Column, pieces: Column) -> Column:
    """Array of (start, end, value, before, after) from alternating pieces."""
    n = F.size(matches)
    rows = F.arrays_zip(matches.alias("value"), F.slice(pieces, 1, n).alias("before"), F.slice(pieces, 2, n).alias("after"))
    kind = "array<struct<start:int,end:int,value:string,before:string,after:string>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def add(state: Column, row: Column) -> Column:
        start = state["at"] + F.length(row["before"])
        end = start + F.length(row["value"])
        span = F.struct(
            start.alias("start"), end.alias("end"), row["value"].alias("value"), F.right(row["before"], F.lit(24)).alias("before"), F.left(row["after"], F.lit(4)).alias("after")
        )
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    none = F.array().cast(kind)
    return F.when(matches.isNull() | (n == 0), none).otherwise(F.aggregate(rows, zero, add, lambda s: s["out"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn's check of a string of digits."""
    at = F.sequence(F.lit(1), F.length(digits))

    def one(i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        folded = F.when(twice > 9, twice - 9).otherwise(twice)
        return F.when((F.length(digits) - i) % 2 == 1, folded).otherwise(d)

    return F.aggregate(F.transform(at, one), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":  # a part of up to 255, whatever its leading zeros
        return F.forall(F.split(value, r"\.", -1), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike(r"^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    n = F.length(_digits(value))
    if kind == "phone":
        return n.between(9, 15)
    return F.when(n.between(12, 19), _luhn(_digits(value))).otherwise(False)


FEATURES = ("length", "digits", "groups", "first_group", "last_group", "longest_group", "letters", "others", "separators", "plus", "dots", "brackets", "listed",
            "letter_before", "letter_after", "dot_after", "quoted", "cue_phone", "cue_card", "cue_mail", "cue_host", "cue_near", "check", "shape")
#: a cue word with no other number between it and the proposal
_NEAR = {
    "email": r"(?i)\b(?:e?-?mail|contact|write)\b[^0-9]{0,12}$",
    "ip": r"(?i)\b(?:ip|host|server|addr|address)\b[^0-9]{0,12}$",
    "card": r"(?i)\b(?:card|visa|credit|pay)\b[^0-9]{0,12}$",
    "phone": r"(?i)\b(?:tel|telephone|phone|call|fax|mobile|cell)\b[^0-9]{0,12}$",
}
#: one separator throughout, in groups as the kind is written
_SHAPES = {
    "email": rf"^{_WORD}+@{_LABEL}(?:\.{_LABEL})*\.\p{{L}}{{2,24}}$",
    "ip": r"^[0-9]+([^0-9]+)[0-9]+\1[0-9]+\1[0-9]+$",
    "card": r"^(?:[0-9]{4}([ ./_-]{1,2})[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|3[0-9]{3}([ ./_-]{1,2})[0-9]{6}\2[0-9]{5}|[0-9]{13,19})$",
    "phone": r"^(?:(?:[+]|00)?[0-9]{1,3}[ ./-]{1,2})?(?:[(][0-9]{3}[)][ ./-]{0,2}[0-9]{3}[ ./-][0-9]{4}|[0-9]{3}([ ./-])[0-9]{3}\1[0-9]{4})$",
}


def _plain(value: Column) -> Column:
    """Spelled or spaced signs as the signs themselves."""
    return F.regexp_replace(F.regexp_replace(value, _AT, "@"), _DOT, ".")


def _check(kind: str, value: Column) -> Column:
    """Evidence in the value itself: host, range of the parts, check sum, count of digits."""
    if kind == "email":
        return _plain(value).rlike(rf"@(?:{_LABEL}\.)+\p{{L}}{{2,24}}$")
    if kind == "ip":
        return _valid(kind, F.regexp_replace(_plain(value), "[,:]", "."))
    if kind == "card":
        return _valid(kind, value) & value.rlike("^[2-6]")
    return _valid(kind, value)


def _shape(kind: str, value: Column) -> Column:
    return (_plain(value) if kind == "email" else value).rlike(_SHAPES[kind])


def _evidence(kind: str, x: Column) -> Column:
    """Whether a proposal is personal data by what no base pattern looks at."""
    v, near = x["value"], x["before"].rlike(_NEAR[kind])
    alone = ~(x["before"].rlike(r"[\p{L}0-9_]$") | x["after"].rlike(r"^(?:[\p{L}0-9_]|[.,:/-][0-9])"))
    fits = _check(kind, v) & _shape(kind, v)
    if kind == "ip":  # lists, times and sums look alike, a spelled dot does not
        fits &= v.rlike(_DOT) | near
    if kind == "phone":
        fits = _check(kind, v) & ~v.rlike(r"^[0-9]+(?:[.][0-9]+){3}$") & (_shape(kind, v) | near)
    return alone & fits


def _cuts(kind: str, x: Column) -> Column:
    """A proposal, and for numbers in groups every run of its groups that is
    still long enough for the kind, whole one included.  The generator bounds
    the groups: five of a phone number, nineteen of a card."""
    if kind not in ("card", "phone"):
        return F.array(x)
    groups = F.regexp_extract_all(x["value"], F.lit(r"[ ./_-]*[+(]*[0-9]+[)]?"), F.lit(0))
    n = F.size(groups)

    def cut(i: Column, j: Column) -> Column:
        """Groups i to j, from 1, both included."""
        value = F.regexp_replace(F.array_join(F.slice(groups, i, j - i + 1), ""), "^[ ./_-]+", "")
        used = F.length(F.array_join(F.slice(groups, 1, j), ""))
        begin = used - F.length(value)
        return F.struct(
            (x["start"] + begin).alias("start"), (x["start"] + used).alias("end"), value.alias("value"),
            F.right(F.concat(x["before"], F.left(x["value"], begin)), F.lit(24)).alias("before"), F.left(F.concat(F.substr(x["value"], used + 1), x["after"]), F.lit(4)).alias("after"),
        )

    runs = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(i, n), lambda j: cut(i, j))))
    digits = lambda v: F.length(_digits(v))
    long = (lambda v: digits(v) >= 12) if kind == "card" else (lambda v: (digits(v) >= 7) & v.rlike("[0-9][^0-9]+[0-9]+[^0-9]+[0-9]"))
    part = F.filter(runs, lambda c: long(c["value"]) & (F.length(c["value"]) < F.length(x["value"])))
    return F.concat(F.array(F.struct(*(x[c].alias(c) for c in ("start", "end", "value", "before", "after")))), part)


def _rewritten(kind: str, value: Column) -> list[Column]:
    """A base match in loose forms that the rules miss."""
    digits = _digits(value)
    put = lambda sep: F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", f"$1{sep}")
    if kind == "email":
        host = F.regexp_replace(F.regexp_extract(value, "@(.*)$", 1), r"\.", " [dot] ")
        return [F.regexp_replace(value, "@", at) for at in (" [at] ", "[at]", " (at) ", " @ ")] + [F.concat(F.regexp_extract(value, "^[^@]*", 0), F.lit(" [at] "), host)]
    if kind == "ip":
        return [F.regexp_replace(value, r"\.", dot) for dot in ("[.]", "(.)", "[dot]", " [.] ")]
    if kind == "card":
        return [put(sep) for sep in (".", "/", "_", "  ")]
    bare = F.regexp_replace(value, r"^[+][0-9]{1,3}[ .-]+(?=[(]?[0-9])", "")
    return [F.regexp_replace(value, "^[+]", ""), bare, F.regexp_replace(F.regexp_replace(bare, "[^0-9]+", "-"), "^-", ""), F.regexp_replace(F.regexp_replace(bare, "[^0-9]+", "."), "^[.]", ""),
            F.regexp_replace(F.regexp_replace(bare, "[^0-9]+", " "), "^ ", ""), F.regexp_replace(value, "^[+]", "00")]


def _damaged(kind: str, value: Column) -> Column:
    """The same form without what makes it personal data: a host without a
    top level, a part over 255, another last digit, groups of a table."""
    if kind == "email":
        return F.regexp_replace(value, r"(?:\.|" + _DOT + r")(?=[\p{L}\p{N}-]+(?:\.|" + _DOT + r"|$))", "")
    if kind == "ip":
        return F.regexp_replace(value, "^[0-9]+", "777")
    if kind == "card":
        last = F.right(value, F.lit(1)).cast("int")
        return F.concat(F.left(value, F.length(value) - 1), F.pmod(last + 1 + F.length(value) % 7, F.lit(10)).cast("string"))
    return F.regexp_replace(_digits(value), "([0-9]{4})(?=[0-9])", "$1 ")


def _features(kind: str, x: Column) -> Column:
    """Format, context and check of a proposal."""
    v, b, a = x["value"], x["before"], x["after"]
    flag = lambda c: c.cast("double")
    runs = F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0))
    digits, letters = F.length(_digits(v)), F.length(F.regexp_replace(v, r"[^\p{L}]", ""))
    seps = F.size(F.array_distinct(F.regexp_extract_all(v, F.lit("[^0-9]+"), F.lit(0))))
    size = lambda r: F.coalesce(F.length(r), F.lit(0))
    cols = [
        F.length(v), digits, F.size(runs), size(F.get(runs, F.lit(0))), size(F.get(runs, F.size(runs) - 1)), F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0)),
        letters, F.length(v) - digits - letters, seps,
        flag(F.contains(v, F.lit("+")) | b.endswith("+")), F.length(F.regexp_replace(v, "[^.]", "")), flag(v.rlike(r"[\[({<]")), flag(v.rlike("[,:]")),
        flag(b.rlike(r"[\p{L}0-9_]$")), flag(a.rlike(r"^[\p{L}0-9_]")), flag(a.rlike("^[.,:/-][A-Za-z0-9]")), flag(b.rlike("[\"'=#/_:]$")),
        *(flag(b.rlike(cue)) for cue in _CUES), flag(b.rlike(_NEAR[kind])), flag(_check(kind, v)), flag(_shape(kind, v)),
    ]
    return F.array(*(c.cast("double") for c in cols))


def _seeds() -> list[str]:
    """Texts with base spans of each kind, and with what only looks like one."""
    rng = random.Random(0)
    words = "the report was sent there and then read again by all of them before noon".split()
    some = lambda n=3: " ".join(rng.choice(words) for _ in range(n))
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    out = []
    for k in range(90):
        card = rng.choice(["4", "51", "37", "6011"]) + num(11)
        card += next(d for d in "0123456789" if _luhn_of(card + d))
        phone = rng.choice([f"+1 ({rng.randrange(200, 999)}) {num(3)}-{num(4)}", f"+1 {num(3)} {num(3)} {num(4)}", f"+49 {num(3)} {num(3)}-{num(4)}"])
        ip = ".".join(str(rng.randrange(256)) for _ in range(4))
        year = rng.randrange(1900, 2030)
        out.append(f"{some()} {rng.choice(words)}.{k}@{rng.choice(words)}{k}.{rng.choice(['com', 'org', 'example.net', 'de'])} {some()}")
        out += [f"{some()} {ip} {some()}", f"{some()} {card} {some()}", f"{some()} {phone} {some()}"]
        out += [f"{some()} {year}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02} {some()}", f"{some()} {year} {year + 1} {year + 2} {some()}",
                f"{some()} {rng.randrange(1, 9)},{rng.randrange(100, 256)},{rng.randrange(100, 256)},{rng.randrange(100, 256)} {some()}",
                f"{some()} {rng.randrange(24)}:{rng.randrange(10, 60)}:{rng.randrange(10, 60)}:{rng.randrange(100, 256)} {some()}", f"{some()} 978-{num(1)}-{num(2)}-{num(4)}-{num(2)} {some()}",
                f"{some()} {num(2)} {num(3)} {num(3)} {num(3)} {some()}", f"{some()} {num(4)}.{num(4)}.{num(4)}.{num(4)} {some()}", f"{some()} @ {rng.choice(words)} {some()}",
                f"{some()} [at] {rng.choice(words)} {some()}", f"{some()} {rng.randrange(10, 32)}/{rng.randrange(10, 13)}/{year} {some()}"]
    return out


def _luhn_of(digits: str) -> bool:
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def _base(docs: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """``keep``, then b_<kind> and p_<kind>: spans of the rules, and proposals."""
    t = F.coalesce(F.col(text), F.lit(""))
    cols = []
    for kind in KINDS:
        may = _MAY[kind](t)
        for letter, patterns in (("b", _PATTERNS), ("p", _PROPOSALS)):
            m, s = _found(t, patterns[kind], may)
            cols += [m.alias(f"__{letter}m_{kind}"), s.alias(f"__{letter}s_{kind}")]
    # two steps, so that no regular expression runs twice
    wide = docs.select(*keep, *cols)
    names = [c for c in wide.columns if not c.startswith(("__bm_", "__bs_", "__pm_", "__ps_"))]
    out = []
    for kind in KINDS:
        base = F.filter(_spans(F.col(f"__bm_{kind}"), F.col(f"__bs_{kind}")), lambda x: _valid(kind, x["value"]))
        out += [base.alias(f"b_{kind}"), _spans(F.col(f"__pm_{kind}"), F.col(f"__ps_{kind}")).alias(f"p_{kind}")]
    return wide.select(*names, *out)


def _overlaps(x: Column, spans: Column) -> Column:
    return F.exists(spans, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))


def _examples(spans: DataFrame) -> DataFrame:
    """(kind, x, y, h) of all kinds, from base spans and proposals."""
    all_kinds = []
    for k, kind in enumerate(KINDS):
        whole = f"^(?:{_PROPOSALS[kind]})$"
        others = F.concat(*(F.col(f"b_{other}") for other in KINDS if other != kind))
        own = F.filter(F.flatten(F.transform(F.col(f"p_{kind}"), lambda x: _cuts(kind, x))), lambda x: ~_overlaps(x, F.col(f"b_{kind}")))
        seen = F.transform(own, lambda x: F.struct(x.alias("x"), (_evidence(kind, x) & ~_overlaps(x, others)).alias("y"), F.xxhash64(x["value"]).alias("h")))

        def loose(x: Column) -> Column:
            pairs = []
            for form in _rewritten(kind, x["value"]):
                pairs += [(form, True), (_damaged(kind, form), False)]
            put = lambda v: F.struct(x["start"], x["end"], v.alias("value"), x["before"], x["after"])
            return F.array(*(F.struct(put(v).alias("x"), F.lit(y).alias("y"), F.xxhash64(x["value"]).alias("h")) for v, y in pairs))

        made = F.filter(F.flatten(F.transform(F.col(f"b_{kind}"), loose)), lambda r: r["x"]["value"].rlike(whole))
        all_kinds.append(F.transform(F.concat(seen, made), lambda r: F.struct(F.lit(k).alias("kind"), _features(kind, r["x"]).alias("x"), r["y"].alias("y"), r["h"].alias("h"))))
    return spans.select(F.explode(F.concat(*all_kinds)).alias("r")).select("r.*")


def fit_models(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: PiiRules = PiiRules()) -> dict[str, Boosted]:
    """Trees and threshold of each kind, from a bounded sample for each: the
    documents with its proposals that have the smallest hashes, and the seeds.
    A third of the examples, by hash, calibrates the threshold."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    t = F.coalesce(F.col(text), F.lit(""))
    key = F.xxhash64(F.col(doc_id).cast("string"), F.col(text))
    holds = [(_MAY[kind](t) & t.rlike(_PROPOSALS[kind])).alias(f"__{kind}") for kind in KINDS]
    held = docs.select(key.alias("__key"), *holds).where(reduce(lambda a, b: a | b, (F.col(f"__{kind}") for kind in KINDS))).checkpoint()
    # repeated rows are one row of the sample
    picked = reduce(DataFrame.unionByName, (held.where(f"__{kind}").select("__key").distinct().orderBy("__key").limit(rules.sample_documents) for kind in KINDS)).distinct()
    sample = docs.select(key.alias("__key"), F.col(text).alias("__text")).join(F.broadcast(picked), "__key").groupBy("__key").agg(F.min("__text").alias("__text")).select("__text")
    # a bounded sample needs few tasks, and each compiles the wide expressions below
    sample = sample.coalesce(8)
    seeds = spark.createDataFrame([(s,) for s in _seeds()], "__text string").coalesce(1)
    # spans, then examples: the wide expressions of both in one task take memory to compile
    spans = _base(sample.unionByName(seeds), "__text", []).checkpoint()
    rows = _examples(spans).checkpoint()
    models = {}
    for k, kind in enumerate(KINDS):
        mine = rows.where(F.col("kind") == k).orderBy("h", "x", "y").limit(rules.sample_proposals).collect()
        x, y = np.array([r["x"] for r in mine]).reshape(len(mine), len(FEATURES)), np.array([float(r["y"]) for r in mine])
        held_out = np.array([r["h"] % 3 == 0 for r in mine], bool)
        models[kind] = calibrate(fit(x[~held_out], y[~held_out]), x[held_out], y[held_out], rules.precision) if len(mine) else Boosted()
    return models


def find_pii(docs: DataFrame, text: str = "text", keep: list[str] | None = None, models: dict[str, Boosted] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default), then ``pii_base`` and ``pii_spans``:
    arrays of (start, rank, end) in code points, end exclusive, sorted by
    start, then kind; rank is the kind's place in KINDS.

    Base spans are always in ``pii_spans``; a proposal is added if its kind's
    model selects it and it overlaps no base span and no earlier added one.  Of
    the overlapping runs of one match's groups the one that scores best is
    taken (of equal ones the longest, then the last).
    Null and empty texts have no spans; every row is taken by itself; an empty
    table gives an empty result.  A kept column that bears one of the two
    names comes as ``in_`` and its name."""
    src, at = renamed(docs)
    wanted = docs.columns if keep is None else keep
    keep = [at[c] for c in wanted]
    spans = _base(src, at[text], [F.col(c) for c in keep])
    kind_of = "array<struct<start:int,rank:int,end:int>>"
    plain = lambda c, k: F.transform(c, lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("rank"), x["end"].alias("end")))
    base = F.array_sort(F.concat(*(plain(F.col(f"b_{kind}"), k) for k, kind in enumerate(KINDS))))
    models = {k: m for k, m in (models or {}).items() if m.trees and m.threshold <= 1}
    # features first, then scores: two steps, so that a tree reads ready values
    ready = lambda kind, x: F.transform(_cuts(kind, x), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), _features(kind, c).alias("f")))
    scored = spans.select(*keep, base.alias("pii_base"), *(F.transform(F.col(f"p_{kind}"), lambda x: ready(kind, x)).alias(f"f_{kind}") for kind in models))

    def best(kind: str, m: Boosted, cuts: Column) -> Column:
        rated = F.transform(cuts, lambda c: F.struct(m.column(c["f"]).alias("score"), (c["end"] - c["start"]).alias("size"), c["start"].alias("start"), c["end"].alias("end")))
        return F.array_max(F.filter(rated, lambda c: (c["score"] >= F.lit(m.threshold)) & ~_overlaps(c, F.col("pii_base"))))

    more = [
        plain(F.filter(F.transform(F.col(f"f_{kind}"), lambda x: best(kind, m, x)), lambda x: x.isNotNull()), KINDS.index(kind)) for kind, m in models.items()
    ]
    added = reduce(lambda a, b: F.concat(a, b), more) if more else F.array().cast(kind_of)
    with_added = scored.select(*keep, "pii_base", added.alias("__added"))
    final = F.when(F.size("__added") == 0, F.col("pii_base")).otherwise(_merged(F.col("pii_base"), F.col("__added")))
    names = [f"in_{c}" if c in ("pii_base", "pii_spans") else c for c in wanted]
    return with_added.select(*keep, "pii_base", final.alias("pii_spans")).toDF(*names, "pii_base", "pii_spans")


def _merged(base: Column, added: Column) -> Column:
    """Base spans and those added ones that overlap none of them: one pass
    from the end that drops what reaches into a later base span, then one from
    the front that drops what begins inside an earlier span."""
    tag = lambda c, b: F.transform(c, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"), F.lit(b).alias("base")))
    both = F.reverse(F.array_sort(F.concat(tag(base, True), tag(added, False))))
    kind = "array<struct<start:int,rank:int,end:int,base:boolean>>"

    def step(limit_of, clear):
        def add(s: Column, x: Column) -> Column:
            fits = x["base"] | clear(s["at"], x)
            return F.struct(F.when(fits, limit_of(s["at"], x)).otherwise(s["at"]).alias("at"), F.when(fits, F.concat(s["out"], F.array(x))).otherwise(s["out"]).alias("out"))

        return add

    start = lambda v: F.struct(F.lit(v).alias("at"), F.array().cast(kind).alias("out"))
    back = F.aggregate(both, start(2**31 - 1), step(lambda at, x: F.when(x["base"], F.least(at, x["start"])).otherwise(at), lambda at, x: x["end"] <= at), lambda s: s["out"])
    front = F.aggregate(F.reverse(back), start(0), step(lambda at, x: F.greatest(at, x["end"]), lambda at, x: x["start"] >= at), lambda s: s["out"])
    return F.transform(front, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end")))


def spans_text(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["rank"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each run of overlapping spans replaced by its first
    span's kind, as in ``[EMAIL]``; texts without spans stay as they are."""
    marks = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(s: Column, x: Column) -> Column:
        more = F.concat(s["out"], F.substr(text, s["at"] + 1, x["start"] - s["at"]), F.element_at(marks, x["rank"] + 1))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(x["start"] >= s["at"], more).otherwise(s["out"]).alias("out"))

    done = F.aggregate(spans, zero, add, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
