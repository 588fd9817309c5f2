import random

from vaultline.llm.pages import TemplateRules, _text_token, deduce_templates, extract_pages, host_key, main_text, page_tokens, parse


def text_of(html):
    return main_text(parse(html), set())


def test_blocks_and_references():
    html = "<html><head><title>T</title></head><body><article><h1>A &amp; B</h1><p>one<br>two <b>three<p>four&nbsp;  five</p>loose</article></body></html>"
    assert text_of(html) == "A & B\none two three\nfour five\nloose"


def test_regions_that_are_no_article():
    parts = ["<nav><ul><li>menu</ul></nav>", "<header>head</header>", "<div class='ad'>buy</div>", "<aside>side</aside>", "<form><p>ask</form>",
             "<script>var a='</p><p>x';</script>", "<style>p{}</style>", "<!-- <p>no</p> -->", "<div id=comments-12><p>reader</div>", "<section role=banner>b</section>",
             "<noscript><p>n</p></noscript>", "<div class='cookie-notice'>c</div>", "<footer>foot</footer>"]
    for part in parts:
        assert text_of(f"<body>{part}<article><p>main</p>{part}</article>{part}</body>") == "main", part


def test_a_hint_takes_no_wrapper_away():
    body = "<p>The whole story of the page, told at length.</p>"
    for wrap in ("div class='layout with-sidebar'", "div class=no-sidebar", "div class='has-banner'", "div id='comments-enabled'", "section class='legal'", "div class='social-policy'", "div class='promo-2024 post'"):
        name, side = wrap.split()[0], "<div class='sidebar'>side</div>"
        for inner in (body, f"<article>{body}</article>", f"<main><article>{body}</article></main>"):
            got = text_of(f"<body><{wrap}>{inner}{side}</{name}><div>{'long list ' * 40}</div></body>" if "article" in inner else f"<body><{wrap}>{inner}{side}</{name}></body>")
            assert got == "The whole story of the page, told at length.", (wrap, inner)


def test_a_hint_takes_its_region_away():
    story = "<div><p>The whole story of the page, told at length, and more.</p></div>"
    for part in ("<div class='sidebar'>side</div>", "<ol class='comment-list'><li class=comment><article class='comment-body'><p>reader</p></article></ol>",
                 "<div class=related><article>one</article><article>two</article></div>"):
        assert text_of(f"<body>{part}{story}</body>") == "The whole story of the page, told at length, and more.", part
    assert text_of(f"<main><article>{story}</article><div class=related><article>one</article></div></main>") == "The whole story of the page, told at length, and more."


def test_readers_comments_go_whatever_their_share():
    story = "<div><p>A short story.</p></div>"
    said = "".join(f"<p>Reader {k} says a good deal more than the story does.</p>" for k in range(60))
    for name in ("class=comments", "id='comments'", "class='comment-list'", "class='post-comments wide'", "id=comments-section"):
        for page in (f"<body>{story}<div {name}>{said}</div></body>", f"<article>{story}<div {name}>{said}</div></article>", f"<div {name}>{said}</div><main>{story}</main>"):
            assert text_of(page) == "A short story.", (name, page[:60])
        # a wrapper: no other text beside it
        assert text_of(f"<body><div {name}>{story * 5}</div><ul><li><a href=/>home</a></ul></body>").startswith("A short story.")


def test_levels_past_the_last_are_counted():
    for n in (50, 450, 5000):
        page = f"<div><article><p>before</p>{'<div>' * n}<p>deep</p><nav>menu</nav>{'</div>' * n}<p>after</p></article></div><p>outside</p>"
        assert text_of(page) == "before\ndeep\nafter", n
    assert text_of("<div>" * 20_000 + "</p></span>" * 20_000 + "deep") == "deep"


def plain_classes(pages, rules):
    """Template texts of one host by occurrence vectors written out in full."""
    elements, texts = {}, {}
    for k, page in enumerate(pages):
        for t, n in page.elements.items():
            elements.setdefault(t, {})[k] = n
        for b in page.blocks:
            if not b.outside:
                at = texts.setdefault((b.path, b.text), {})
                at[k] = at.get(k, 0) + 1
    found = set()
    for mine in texts.values():
        alike = [t for t, v in elements.items() if v == mine]
        same = [t for t, v in texts.items() if v == mine]
        enough = len(mine) >= rules.least_pages and len(mine) >= rules.least_share * len(pages)
        if enough and alike and len(same) <= rules.texts_per_element * len(alike):
            found.update(same)
    return found


def test_templates_against_plain_occurrence_vectors(spark):
    rules = TemplateRules(link_share=2.0)  # classes alone
    rng = random.Random(8)
    parts = [f"<div class='c{chr(97 + i)}'><p>fixed {i}</p></div>" for i in range(6)]
    sources = []
    for k in range(60):
        own = "".join(f"<p>{rng.choice('uvw')} {rng.randrange(4)}</p>" for _ in range(rng.randrange(1, 5)))
        sources.append("<body>" + "".join(p * rng.choice((0, 1, 1, 2)) if i % 2 else p for i, p in enumerate(parts)) + own + "</body>")
    df = spark.createDataFrame([(k, "http://h.example/", t) for k, t in enumerate(sources)], "page_id long, url string, html string").repartition(3)
    df = df.withColumn("host", host_key(df["url"]))
    got = deduce_templates(page_tokens(df, "page_id", "html", "host"), rules).collect()
    want = plain_classes([parse(t) for t in sources], rules)
    assert len(got) == 1 and 3 <= len(want) and set(got[0]["template"]) == {_text_token(*t) for t in want}


def test_broken_markup_never_fails():
    rng = random.Random(2)
    bits = ["<p>", "</p>", "<div class=\"a>b\">", "</div>", "<", ">", "<!--", "-->", "<script>", "</script>", "&am", "&lt;", "x", "</", "<a href='", "'>", "<b", "\x00", "İ", "<li>"]
    for _ in range(500):
        text_of("".join(rng.choice(bits) for _ in range(rng.randrange(30))))
    assert text_of("<div>" * 3000 + "deep") == "deep" and text_of("<p>a" * 2000).count("\n") == 1999
    assert text_of("") == "" and text_of("plain") == "plain" and text_of("<a title='x>y'>z</a>") == "z"


def site(k, n):
    body = "".join(f"<p>Paragraph {k} {i} of the text.</p>" for i in range(2 + k % 3))
    links = "".join(f"<li><a href='/{k}{i}'>story {k} {i}</a></li>" for i in range(4))
    return f"<body><div class='top'><p>Welcome to the site</p><span>since 1999</span></div><div class='body'>{body}</div><div class='more'><ul>{links}</ul></div><div class='end'><p>All rights</p></div></body>"


def test_template_text_and_link_slots_go(spark):
    pages = [(k, f"http://h.example/{k}", site(k, k)) for k in range(40)] + [(100 + k, f"http://small.example/{k}", site(k, k)) for k in range(3)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    got = {r["page_id"]: r["text"] for r in extract_pages(df).collect()}
    for k in range(40):
        assert got[k] == "\n".join(f"Paragraph {k} {i} of the text." for i in range(2 + k % 3))
    assert "Welcome to the site" in got[100]  # three pages are no evidence


def test_a_line_shared_by_articles_stays(spark):
    pages = [(k, "http://h.example/x", f"<body><article><p>own {k}</p>{'<p>shared line</p>' if k % 3 == 0 else ''}</article></body>") for k in range(60)]
    got = extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert all(("shared line" in r["text"]) == (r["page_id"] % 3 == 0) for r in got)


def test_edge_rows(spark):
    rows = [(1, None, None, "t"), (2, "", "", "t"), (None, "http://h.example/a", "<p>x</p>", None), (3, "no url", "<p>" + "y " * 200_000, "t"), (3, "no url", "<p>" + "y " * 200_000, "t"), (4, "HTTP://H.example:80/", "<p>&#x41;</p>", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_pages(df).collect()
    assert len(got) == 6 and {(r["page_id"], r["n_chars"]) for r in got} == {(1, 0), (2, 0), (None, 1), (3, 399_999), (4, 1)}
    assert extract_pages(df.limit(0)).count() == 0
    assert extract_pages(df, rules=TemplateRules(least_pages=1)).count() == 6
