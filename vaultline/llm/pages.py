"""Main text of web pages by equivalence-class template deduction (operator 4).

A page is a sequence of tokens: elements, told apart by their path, and text
blocks, told apart by path and text.  Tokens of one host that occur equally
often on each of its pages (equal occurrence vectors) form an equivalence
class.  Classes that hold elements and occur on enough pages are valid; nested
by path they are the host's template, and what they leave open are slots.
Text of the template, slots made of links, and regions whose element names
say that they are not the article are taken away; the rest is the main text.
Words in a class or id are hints alone: an element that holds most of what is
left, or its main article, stays whatever its theme calls it.

An occurrence vector is kept as two sums of page hashes, so a host with a
third of all pages is a plain partial aggregate.  The template that comes back
holds only tokens that are on a fixed share of the host's pages, so it is
bounded by the size of a page.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import by_size

# fixed values: element names by what they mean for a text
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe object svg math canvas textarea title select audio video".split())
_OUTSIDE = frozenset("head nav header footer aside form menu button dialog fieldset".split())
_MAIN = frozenset(["article", "main"])
_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice notification alert popup modal overlay "
    "comment comments reply replies disqus sidebar aside widget widgets share sharing social related recommended breadcrumb breadcrumbs menu nav navbar navigation "
    "footer header masthead newsletter subscribe signup login search toolbar pagination pager skip legal disclaimer copyright".split()
)
#: of these words, those for what readers write, and what may stand beside them in a name for its place
_READERS = frozenset("comment comments reply replies disqus".split())
_HOLDERS = frozenset("area body box container content item list meta post section text thread user wrap wrapper".split())
#: elements that end an open one of the same group when they begin
_CLOSES = {n: frozenset(g) for g in (["p"], ["li"], ["dt", "dd"], ["tr"], ["td", "th"], ["option"], ["h1", "h2", "h3", "h4", "h5", "h6"]) for n in g}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul figure".split())
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_QUOTED = re.compile(r"""(?:[^"'>]|"[^"]*"|'[^']*')*>""")
_PARTS = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class TemplateRules:
    """When a class is valid: on at least ``least_pages`` pages and
    ``least_share`` of the host's; its texts are template only if there are at
    most ``texts_per_element`` for each of its elements.  A slot with at least
    ``link_share`` of its characters in links is no text."""

    least_pages: int = 8
    least_share: float = 0.3
    texts_per_element: int = 4
    link_share: float = 0.5
    broadcast_tokens: int = 1 << 20  # template tokens (8 bytes each) that may be broadcast together


@dataclass
class Block:
    path: int
    text: str
    links: int  # characters inside links
    main: bool  # inside an article or main element
    outside: bool  # inside a region that by its element or role is not the article
    hints: tuple[int, ...] = ()  # places in Page.hints of the elements around it


@dataclass
class Hint:
    """An element whose class or id has a word for what is no article."""

    strong: bool  # one of its names is made of such words alone
    reader: bool  # one of its names says that readers' comments are in it
    words: frozenset[str]
    level: int  # where it begins: outside (0) or inside (1) a main element, or in an article (2)
    articles: int = 0  # outermost article and main elements in it


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    elements: Counter = field(default_factory=Counter)  # path: occurrences
    hints: list[Hint] = field(default_factory=list)


def _hash(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _hinted(name: str, tag: str) -> tuple[str, bool, frozenset[str], bool, bool]:
    """Signature of an element for its path (digits dropped), whether its role
    says that it is no part of an article, the words of its class and id that
    hint at it, whether one of its names has no other words, and whether one
    names a place of readers' comments (``comments``, ``comment-list``)."""
    found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(tag)} if "=" in tag else {}
    names = [_PARTS.findall(n) for key in ("class", "id") for n in found.get(key, "").split()]
    words = [w for n in names for w in n]
    # an article, a main element and the body stay whatever their theme calls them
    role = found.get("role") in _ROLES and name not in ("article", "main", "body", "html")
    strong = any(n and _HINTS.issuperset(n) for n in names)
    reader = any(_READERS.intersection(n) and (_READERS | _HOLDERS).issuperset(n) for n in names)
    return f"{name}.{' '.join(words)}", role, _HINTS.intersection(words), strong, reader


def parse(source: str, cache: dict | None = None) -> Page:
    """Blocks and elements of a page, in one linear pass.

    Forgiving: stray end tags are dropped, open paragraphs, list items and the
    like end where HTML ends them, unclosed inline elements mean nothing.  An
    unclosed comment or raw element (script, style, ...) reaches to the end.
    Elements below the 400th level have the path and hints of that level."""
    page = Page()
    cache = {} if cache is None else cache
    # name, path, in a main (1) or article (2) element, outside, hints
    stack: list[tuple[str, int, int, bool, tuple[int, ...]]] = [("", 0, 0, False, ())]
    opened: Counter = Counter()  # names on the stack: a stray end tag need not search it
    text: list[str] = []
    links = depth = 0

    def flush() -> None:
        nonlocal links
        if text:
            whole = " ".join(_html.unescape("".join(text)).split())
            if whole:
                _, path, main, outside, hints = stack[-1]
                page.blocks.append(Block(path, whole, min(links, len(whole)), main > 0, outside, hints))
            text.clear()
        links = 0

    at, end = 0, len(source)
    lower = None
    while at < end:
        lt = source.find("<", at)
        if lt != at:
            piece = source[at : lt if lt >= 0 else end]
            text.append(piece)
            if depth:
                links += len(piece)
            if lt < 0:
                break
        nxt = source[lt + 1 : lt + 2]
        if nxt == "!" or nxt == "?":
            if source.startswith("<!--", lt):
                close = source.find("-->", lt + 4)
                at = close + 3 if close >= 0 else end
            else:
                close = source.find(">", lt)
                at = close + 1 if close >= 0 else end
            continue
        closing = nxt == "/"
        m = _NAME.match(source, lt + 2 if closing else lt + 1)
        if not m:
            if closing:  # a bogus comment
                close = source.find(">", lt)
                at = close + 1 if close >= 0 else end
            else:
                text.append("<")
                at = lt + 1
            continue
        name = m.group().lower()
        gt = source.find(">", m.end())
        if gt < 0:
            break  # an unfinished tag ends the page
        tag = source[m.end() : gt]
        if ('"' in tag or "'" in tag) and (tag.count('"') % 2 or tag.count("'") % 2):
            whole = _QUOTED.match(source, m.end())
            if whole:
                gt = whole.end() - 1
                tag = source[m.end() : gt]
        at = gt + 1
        if name in _INLINE:
            if name == "a":
                depth = 0 if closing else 1
            elif name == "br":
                text.append(" ")
            continue
        if name in _RAW:
            if not closing and not tag.endswith("/"):
                if lower is None:
                    lower = source.lower()
                    if len(lower) != end:  # rare letters change their length
                        lower = re.sub("[A-Z]", lambda c: c.group().lower(), source)
                close = lower.find(f"</{name}", at)
                if close < 0:
                    break
                gt = source.find(">", close)
                at = gt + 1 if gt >= 0 else end
            continue
        flush()
        depth = 0
        if name in _VOID:
            continue
        if closing:
            while opened[name]:
                last = stack.pop()[0]
                opened[last] -= 1
                if last == name:
                    break
            continue
        shut = _CLOSES.get(name, ())
        while len(stack) > 1 and (stack[-1][0] in shut or (stack[-1][0] == "p" and name in _ENDS_P)):
            opened[stack.pop()[0]] -= 1
        _, path, main, outside, hints = stack[-1]
        key = (path, name, tag)
        known = cache.get(key)
        if known is None:
            sign, out, words, strong, reader = _hinted(name, tag)
            known = cache[key] = (_hash(f"{path}/{sign}"), out or name in _OUTSIDE, words, strong, reader)
        deep = len(stack) >= 400
        if name in _MAIN:
            # a comment in a list of comments is no main article
            if not any(page.hints[h].words & known[2] for h in hints):
                if main < (2 if name == "article" else 1) and not outside:
                    for h in hints:  # those inside the same main element, if any
                        page.hints[h].articles += page.hints[h].level == main
                main = max(main, 2 if name == "article" else 1)
        elif known[2] and name not in ("body", "html") and not (outside or known[1] or deep):
            hints = (*hints, len(page.hints))
            page.hints.append(Hint(known[3], known[4], known[2], main))
        stack.append((name, path if deep else known[0], main, outside or known[1], hints))
        opened[name] += 1
        page.elements[known[0]] += 1
    flush()
    return page


def host_key(url: Column) -> Column:
    """Hash of a URL's host without its port, null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", F.xxhash64(host))


_TOKENS = pa.schema([("host", pa.int64()), ("token", pa.int64()), ("kind", pa.int8()), ("high", pa.int64()), ("low", pa.int64()), ("n", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())])
_ROOT, _ELEMENT, _TEXT, _SLOT = range(4)


def _text_token(path: int, text: str) -> int:
    return _hash(f"{path}\0{text}")


def page_tokens(pages: DataFrame, page_id: str, html: str, host: str) -> DataFrame:
    """One row for each distinct token of a page: host, token, kind, the two
    halves of the page's hash times its occurrences, occurrences, characters
    and those in links.  Text that is outside by its elements' names or roles
    is left out, its elements are not."""
    src = pages.select(F.col(host).alias("host"), F.xxhash64(F.col(page_id), F.col(html)).alias("page"), F.coalesce(F.col(html), F.lit("")).alias("html")).where("host is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for b in by_size(batches, "html", 2 << 20):
            rows: list[tuple] = []
            for h, key, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                got = parse(source, cache)
                if len(cache) > 100_000:
                    cache.clear()
                high, low = (key >> 32) & 0xFFFFFFFF, key & 0xFFFFFFFF
                rows.append((h, 0, _ROOT, high, low, 1, 0, 0))
                rows += [(h, t, _ELEMENT, high * n, low * n, n, 0, 0) for t, n in got.elements.items()]
                texts: Counter = Counter()
                slots: dict[int, list[int]] = {}
                for x in got.blocks:
                    if not x.outside:
                        texts[_text_token(x.path, x.text)] += 1
                        s = slots.setdefault(x.path, [0, 0, 0])
                        s[0] += 1
                        s[1] += len(x.text)
                        s[2] += x.links
                rows += [(h, t, _TEXT, high * n, low * n, n, 0, 0) for t, n in texts.items()]
                rows += [(h, t, _SLOT, high, low, s[0], s[1], s[2]) for t, s in slots.items()]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_TOKENS)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _TOKENS, strict=True)], schema=_TOKENS)

    return src.mapInArrow(run, "host long, token long, kind byte, high long, low long, n long, chars long, links long")


def deduce_templates(tokens: DataFrame, rules: TemplateRules = TemplateRules()) -> DataFrame:
    """(host, template): the text tokens and link slots to take away.

    A class is all tokens of a host with one occurrence vector.  It is valid
    if it holds an element and is on enough of the host's pages; its elements
    stand in each other's paths, which nests it into the template."""
    sums = [F.sum(c).alias(c) for c in ("high", "low", "n", "chars", "links")]
    per = tokens.groupBy("host", "kind", "token").agg(F.count("*").alias("pages"), *sums)
    enough = (F.col("pages") >= rules.least_pages) & (F.col("pages") >= F.col("all_pages") * rules.least_share)
    # read by three branches; what is left is bounded by the size of a page for each host
    per = per.where((F.col("pages") >= rules.least_pages) | (F.col("kind") == _ROOT)).checkpoint()
    sizes = per.where(F.col("kind") == _ROOT).select(F.col("host").alias("z_host"), F.col("pages").alias("all_pages"))
    per = per.where(F.col("pages") >= rules.least_pages).join(sizes, F.col("host") == F.col("z_host")).where(enough)
    is_text, is_element = F.col("kind") == _TEXT, F.col("kind") == _ELEMENT
    vector = ["host", "high", "low", "n", "pages"]
    classes = per.where(is_text | is_element).groupBy(*vector).agg(
        F.sum(is_element.cast("int")).alias("elements"), F.sum(is_text.cast("int")).alias("texts"), F.collect_list(F.when(is_text, F.col("token"))).alias("tokens")
    )
    valid = classes.where((F.col("elements") > 0) & (F.col("texts") > 0) & (F.col("texts") <= F.col("elements") * rules.texts_per_element))
    texts = valid.select("host", F.explode("tokens").alias("token"))
    slots = per.where((F.col("kind") == _SLOT) & (F.col("links") >= F.col("chars") * rules.link_share)).select("host", "token")
    return texts.unionByName(slots).groupBy("host").agg(F.collect_set("token").alias("template"))


#: share of the page's text from which a hinted element is a wrapper: by a name that is all hint, or that says more
_WRAPS = {True: 0.9, False: 0.5}


def _unhinted(page: Page, left: list[Block]) -> list[Block]:
    """The blocks without those in elements that hints take away: where the
    rest of the page is more than theirs, and no main article is in them.
    Readers' comments go whatever their share, if there is other text (not
    links) on the page."""
    size, main = [0] * len(page.hints), [0] * len(page.hints)
    for b in left:
        for h in b.hints:
            size[h] += len(b.text)
            main[h] += len(b.text) if b.main else 0
    whole, articles = sum(len(b.text) for b in left), sum(len(b.text) for b in left if b.main)
    other = any(2 * b.links < len(b.text) and not any(page.hints[h].reader for h in b.hints) for b in left)
    stays = [
        (size[k] >= whole * _WRAPS[h.strong] and not (h.reader and other)) or (h.articles == 1 and 2 * main[k] >= articles > 0) for k, h in enumerate(page.hints)
    ]
    return [b for b in left if all(stays[h] for h in b.hints)]


def main_text(page: Page, template: set[int]) -> str:
    """The blocks that remain, in page order, one on a line.  Where the page
    has an article or main element with any of them, the rest is left out."""
    left = [b for b in page.blocks if not b.outside and b.path not in template and (not template or _text_token(b.path, b.text) not in template)]
    if page.hints:
        left = _unhinted(page, left)
    inside = [b for b in left if b.main]
    return "\n".join(b.text for b in inside or left)


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", rules: TemplateRules = TemplateRules()) -> DataFrame:
    """(page_id, url, text, n_chars), one row for each row of ``pages``.

    Null and empty pages, and pages without main text, have the empty text.
    Pages without a host, or on hosts with too few pages, have no template and
    go by their elements alone.  Repeated rows are pages like any other; an
    empty table gives an empty result; further columns are not read."""
    src = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host_key(F.col(url)).alias("host"))
    templates = deduce_templates(page_tokens(src, "page_id", "html", "host"), rules).withColumnRenamed("host", "t_host").checkpoint()
    size = templates.agg(F.coalesce(F.sum(F.size("template") + 4), F.lit(0))).first()[0]
    if size <= rules.broadcast_tokens:  # else a shuffle join, whose hot hosts Spark splits
        templates = F.broadcast(templates)
    both = src.join(templates, src["host"] == templates["t_host"], "left").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for b in by_size(batches, "html", 2 << 20):
            out = []
            for source, template in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                out.append(main_text(parse(source, cache), set(template or ())))
                if len(cache) > 100_000:
                    cache.clear()
            n = pa.array(np.array([len(t) for t in out], np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), n], names=["page_id", "url", "text", "n_chars"])

    return both.mapInArrow(run, f"page_id {src.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
