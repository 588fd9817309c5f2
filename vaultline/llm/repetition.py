"""Quality rules by suffix-array repetition (operator 1).

The words of each text form one sequence.  A suffix array over the sequences
of a record batch, with the longest common prefix (LCP) of neighbours, gives
every maximal repeated substring as an LCP interval; the union of their spans
and the longest of them are then limited.  Texts never mix: a suffix is
ordered by its text first, so no common prefix crosses a text's end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vaultline.llm.common import SPACES, by_size, renamed, text_bytes

SYMBOLS = b"#*$%&|<>"
_NOT_WORD_CHARS = SPACES + bytes(range(0x80, 0xC0))  # white space and UTF-8 continuation bytes


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the verdict.  A repeat counts from ``min_words`` words on; a
    text fails if repeats cover more than ``max_fraction`` of its words, or if
    one repeat is longer than ``max_longest`` words."""

    min_words: int = 5
    max_fraction: float = 0.5
    max_longest: int = 100
    base_min_words: int = 50
    base_window: int = 3
    base_percent: int = 50


def _sorted_by(key: np.ndarray) -> np.ndarray:
    """Positions in ascending order of non-negative keys (ties in any order).
    Keys that leave room for a position in 63 bits are sorted with it."""
    n = len(key)
    bits = max(1, (n - 1).bit_length())
    if n and int(key.max()) >> (63 - bits) == 0:
        return np.sort((key << bits) | np.arange(n)) & ((1 << bits) - 1)
    return np.argsort(key)


def suffix_array(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and LCP of several sequences laid end to end.

    ``ids``: word numbers; ``starts``: where each sequence begins, with the
    total length last.  Returns ``order`` (suffix starts, by sequence, then by
    content; an ended suffix comes before a longer one) and ``lcp`` (common
    words of ``order[k]`` and ``order[k - 1]``, 0 across sequences).

    Prefix doubling: after round k suffixes are ranked by their first 2^k
    words; only those that still share a rank are sorted again.  The ranks of
    all rounds stay, and the LCP of neighbours is read from them by descending
    powers of two.
    """
    n = len(ids)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    seq = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    end = starts[1:][seq]
    width = int(ids.max()) + 1
    key = seq * width + ids
    order = _sorted_by(key)
    rank = np.empty(n, np.int64)
    new = np.concatenate(([True], np.diff(key[order]) != 0))
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]  # a rank is the first place of its group
    levels = [rank]
    step = 1
    shared = ~(new & np.concatenate((new[1:], [True])))
    places = np.flatnonzero(shared)
    while len(places):
        at = order[places]
        nxt = at + step
        inside = nxt < end[at]
        follow = np.where(inside, rank[np.minimum(nxt, n - 1)] + 1, 0)
        own = rank[at]
        pair = own * (n + 1) + follow
        by = _sorted_by(pair)
        at, pair = at[by], pair[by]
        order[places] = at
        fresh = np.concatenate(([True], np.diff(pair) != 0))
        rank = rank.copy()
        rank[at] = places[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        levels.append(rank)
        step *= 2
        places = places[~(fresh & np.concatenate((fresh[1:], [True])))]
    lcp = np.zeros(n, np.int64)
    at = np.flatnonzero(seq[order[1:]] == seq[order[:-1]]) + 1
    a, b = order[at], order[at - 1]
    top = np.full(len(at), -1)  # the last round in which both still shared a rank
    same = np.arange(len(at))
    for k, level in enumerate(levels):
        same = same[level[a[same]] == level[b[same]]]
        top[same] = k
    got = np.zeros(len(at), np.int64)
    last = end[a]
    for k in range(len(levels) - 1, -1, -1):
        todo = np.flatnonzero(top >= k)
        x, y = a[todo] + got[todo], b[todo] + got[todo]
        inside = np.maximum(x, y) < last[todo]
        todo, x, y = todo[inside], x[inside], y[inside]
        # equal ranks of round k: the next 2^k words are equal, as two different suffixes
        # of one sequence never end together
        got[todo[levels[k][x] == levels[k][y]]] += 1 << k
    lcp[at] = got
    return order, lcp


def repeat_lengths(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest substring that begins there
    and occurs again in the same text: the deepest LCP interval it is in."""
    order, lcp = suffix_array(ids, starts)
    longest = np.zeros(len(ids), np.int64)
    if len(ids):
        longest[order] = np.maximum(lcp, np.concatenate((lcp[1:], [0])))
    return longest


def maximal_repeats(ids: np.ndarray, min_words: int = 1) -> list[tuple[int, list[int]]]:
    """Maximal repeated substrings of one sequence as (length, starts).

    Every LCP interval of value >= ``min_words`` is right-maximal; it is kept
    if its occurrences are not all preceded by the same word.  Output size is
    that of the intervals; meant for reports on single texts."""
    order, lcp = suffix_array(ids, np.array([0, len(ids)]))
    found, stack = [], []  # stack: (value, left bound)
    bounds = [*lcp[1:].tolist(), 0] if len(ids) else []
    for k, value in enumerate(bounds):
        left = k
        while stack and stack[-1][0] > value:
            depth, left = stack.pop()
            if depth >= min_words:
                at = sorted(order[left : k + 1].tolist())
                before = {int(ids[i - 1]) if i else -1 for i in at}
                if len(before) > 1:
                    found.append((depth, at))
        if value and (not stack or stack[-1][0] < value):
            stack.append((value, left))
    return found


def covered(longest: np.ndarray, least: int, window: int | None = None) -> np.ndarray:
    """Which words lie in the union of repeats of at least ``least`` words;
    ``window``: count only the first so many words of each repeat."""
    n = len(longest)
    on = np.flatnonzero(longest >= least)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, on, 1)
    np.add.at(edge, on + (window if window else longest[on]), -1)
    return np.cumsum(edge[:n]) > 0


def spans(cover: np.ndarray) -> list[tuple[int, int]]:
    """Runs of covered words as (first, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], cover.astype(np.int8), [0]))))
    return [(int(a), int(b)) for a, b in edge.reshape(-1, 2)]


def _word_ids(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of several texts laid end to end, and where each begins."""
    seen: dict[bytes, int] = {}
    give, parts, starts = seen.setdefault, [], [0]
    tick = count()
    for t in texts:
        words = t.split()
        parts.append(np.fromiter(map(give, words, tick), np.int64, len(words)))
        starts.append(starts[-1] + len(words))
    return (np.concatenate(parts) if parts else np.empty(0, np.int64)), np.array(starts, np.int64)


def _line_counts(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()] if b"\n" in text else []
    return len(lines) - len(set(lines))


MEASURES = pa.schema(
    [
        ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
        ("covered_words", pa.int64()), ("longest_repeat", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
        ("repeat_spans", pa.list_(pa.list_(pa.int64()))),
    ]
)


def measure(texts: list[bytes], rules: RepetitionRules, with_spans: bool = True) -> dict[str, list]:
    """Counts and verdict of each text, see MEASURES."""
    ids, starts = _word_ids(texts)
    longest = repeat_lengths(ids, starts)
    windows = covered(longest, rules.base_window, rules.base_window)
    union = covered(longest, rules.min_words)
    sums = [np.concatenate(([0], np.cumsum(x)))[starts] for x in (windows, union)]
    n_words, n_repeat, n_cover = np.diff(starts), np.diff(sums[0]), np.diff(sums[1])
    out: dict[str, list] = {f.name: [] for f in MEASURES}
    for k, t in enumerate(texts):
        a, b = int(starts[k]), int(starts[k + 1])
        n, rep, cov = int(n_words[k]), int(n_repeat[k]), int(n_cover[k])
        most = int(longest[a:b].max()) if b > a else 0
        most = most if most >= rules.min_words else 0
        failed = n < rules.base_min_words or 100 * rep > rules.base_percent * n
        row = (
            n, len(t.translate(None, _NOT_WORD_CHARS)), len(t) - len(t.translate(None, SYMBOLS)), _line_counts(t), rep, cov, most, failed,
            not failed and cov <= rules.max_fraction * n and most <= rules.max_longest,
            [list(s) for s in spans(union[a:b])] if with_spans and cov else [],
        )
        for name, value in zip(out, row, strict=True):
            out[name].append(value)
    return out


def repetition_quality(docs: DataFrame, text: str = "text", rules: RepetitionRules = RepetitionRules(), spans_too: bool = True, only_kept: bool = False) -> DataFrame:
    """All columns of ``docs`` with MEASURES behind them; ``only_kept``: the
    rows that pass with their own columns alone, the others never leave the task.

    Columns of ``docs`` that bear one of those names come first under their
    own name with ``in_`` before it.  Null and empty texts have no words and
    fail the base rule; every row, repeated ones too, is measured by itself;
    an empty table gives an empty result.  No shuffle: one pass, in batches of
    about 4 MB of text or one longer text.
    """
    src, at = renamed(docs)
    body = at[text]
    kept = [f for f in MEASURES if spans_too or f.name != "repeat_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, body):
            got = measure(text_bytes(b.column(b.schema.get_field_index(body))), rules, spans_too)
            if only_kept:
                yield b.filter(pa.array(got["kept"], pa.bool_()))
                continue
            arrays = [pa.array(got[f.name], f.type) for f in kept]
            yield pa.RecordBatch.from_arrays([*b.columns, *arrays], names=[*b.schema.names, *(f.name for f in kept)])

    ddl = {"int64": "long", "bool": "boolean"}
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields]
    if only_kept:
        return src.mapInArrow(run, ", ".join(fields)).toDF(*docs.columns)
    fields += [f"`{f.name}` {ddl.get(str(f.type), 'array<array<long>>')}" for f in kept]
    own = {f.name for f in kept}
    names = [f"in_{c}" if c in own else c for c in docs.columns]
    return src.mapInArrow(run, ", ".join(fields)).toDF(*names, *(f.name for f in kept))
