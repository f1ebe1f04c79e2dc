"""What the per-host counts and the tag rules delete from web pages."""

from pricelens.llm import html_template


def texts(spark, htmls):
    rows = [(i, f"http://a.b/{i}", h) for i, h in enumerate(htmls)]
    return {r.page_id: r for r in html_template.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_recurrence_is_independent_of_host_size(spark):
    htmls = [f"{'<div>Winter sale</div>' if i < 8 else ''}<div><p>Body {i}</p></div>" for i in range(100)]
    assert {i: r.text for i, r in texts(spark, htmls).items()} == {i: f"Body {i}" for i in range(100)}


def plain(html):
    return [t for t, _ in html_template.pieces(html)[0]]


def test_class_names_never_drop_the_main_prose():
    for name in ("content has-sidebar", "no-banner", "comments-open", "layout-menu-left", "sidebar", "menu content"):
        for body in ("<article><h2 class='banner-title'>Head</h2><p>Long text</p></article>",
                     "<div class='comment'><h2>Head</h2><p>Long text</p></div>"):
            assert plain(f"<body><div class='ad'>buy</div><div class='{name}'>{body}</div></body>") == ["Head", "Long text"], name
    assert plain("<article class='related'><p>Long text</p><div class='comments'><p>nice</p></div></article>") == ["Long text"]
    teaser = "<div class='related'><article><p>Teaser</p></article></div>"
    assert plain(f"<main><div><p>Much longer than the teaser</p></div>{teaser}</main>") == ["Much longer than the teaser"]


def test_counts_decide_on_pages_with_an_article(spark):
    menu = "<nav><ul><li>Home<li>News</ul></nav><div class='box'>Our shop</div>"
    htmls = [f"<body>{menu}<article><p>Post {i}</p><div class='x'>Read on</div></article><div><p>Legal text</p></div></body>"
             for i in range(6)]
    # An article decides, whatever lies outside it and however long that is.
    htmls += [f"<body>{menu}<article><p>Tip {i}</p></article><div><p>The long text of page {i} itself</p></div></body>"
              for i in range(6, 12)]
    got = texts(spark, htmls)
    assert {i: r.text for i, r in got.items()} == {i: f"Post {i}" for i in range(6)} | {i: f"Tip {i}" for i in range(6, 12)}
    for i, r in got.items():  # Home, News, Our shop; Read on, Legal text
        assert r.n_template_chars == 16 + (17 if i < 6 else 0) and (r.n_rule_chars > 0) == (i >= 6) and r.n_template_subtrees > 2


def test_same_pages_count_once_and_rules_take_the_rest(spark):
    page = "<body><footer>About</footer><div><p>Copy</p></div><div>note</div></body>"
    got = texts(spark, [page] * 9)
    assert {(r.text, r.n_template_chars, r.n_rule_chars) for r in got.values()} == {("Copy\nnote", 0, 5)}


def test_comments_longer_than_the_article_go():
    page = ("<body><article><p>Main</p></article><div class='comment-list'><p>a much longer comment than the article</p></div>"
            "<section id='comments-area'><p>me too, and at some length</p></section></body>")
    blocks, chains, _ = html_template.page_blocks(page)
    assert html_template.article(blocks, chains, set())[0] == "Main"


def test_wrapped_pages_keep_their_text():
    body = "<article><h1>Head</h1><p>Long text</p><form><p>mail</p></form></article>"
    for wrapper in ("<form action='/x'>{}</form>", "<div role='form'>{}</div>", "<form><div role='dialog'>{}</div></form>",
                    "<div role='banner' class='site-header'><form>{}</form></div>"):
        assert plain(f"<body><nav>menu</nav>{wrapper.format(body)}</body>") == ["Head", "Long text"], wrapper
        prose = "<div><h1>Head</h1><p>Long text</p></div>"
        assert plain(f"<body><nav>menu</nav>{wrapper.format(prose)}<search>find</search></body>") == ["Head", "Long text"], wrapper
    assert plain("<form hidden><article><p>Not shown</p></article></form><div><p>Shown</p></div>") == ["Shown"]


def test_names_put_together_drop_parts_of_an_article():
    for name in ("comment-list", "cookie-banner", "ad-slot", "social-links", "site-footer", "user_comments", "related-posts", "ad"):
        assert plain(f"<article><p>Text</p><div class='{name}'><p>part</p></div></article>") == ["Text"], name
    for name in ("share-price", "banner-title", "comments-open", "has-sidebar", "ad-hoc", "advertisers", "menu-left-open"):
        assert plain(f"<article><p>Text</p><div class='{name}'><p>part</p></div></article>") == ["Text", "part"], name


def test_counts_alone_decide(spark):
    """No name, role or tag tells these boxes from the text; only that they recur does."""
    boxes = "<div class='k1'>Try our bread</div><div><span>Open till nine</span></div>"
    htmls = [f"<body>{boxes}<div><p>Body {i} of a page</p></div><div>Kept once {i}</div></body>" for i in range(6)]
    got = texts(spark, htmls)
    assert {i: r.text for i, r in got.items()} == {i: f"Body {i} of a page\nKept once {i}" for i in range(6)}
    assert all(r.n_template_chars == 27 and r.n_rule_chars == 0 for r in got.values())


def test_deep_and_long_pages_take_linear_memory(spark):
    import tracemalloc
    deep = "<div>x" * 30_000
    tracemalloc.start()
    blocks, chains, marks = html_template.page_blocks(deep)
    assert html_template.article(blocks, chains, set())[0] == "\n".join(["x"] * 30_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20 and len(chains) <= 30_000
    long = "<p>" + "word " * 200_000
    got = texts(spark, [deep, long, deep])
    assert got[0].text == got[2].text and got[1].text == ("word " * 200_000).strip()
