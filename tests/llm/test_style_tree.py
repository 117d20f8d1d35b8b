from staylens.llm.style_tree import Page, main_text

ARTICLE = "<article><h1>{0} title</h1><p>Text  {0}\n of <b>the</b> page &amp; more<p>second {0}</article>"
PAGE = (
    '<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p>";</script></head><body>'
    '<nav><ul><li><a href="/">home</a></li></ul></nav><!-- x --><div class="ad">buy {0}</div>{1}<footer>&copy;</footer>'
)


def texts(page):
    return " ".join(t for _, t in Page(page).article())


def test_article_of_marked_pages():
    assert texts(PAGE.format(1, ARTICLE.format(7))) == "7 title Text 7 of the page & more second 7"


def test_what_is_not_the_article():
    page = (
        "<body class=has-sidebar><header><h1>Site</h1></header><div id=cookie-notice>cookies</div><div class=content>"
        "<h2>Title</h2><p hidden>no</p><p>a<script>if(a<b){'</p>'}</script>b<br>line</p><ul><li>one<li>two</ul>"
        "<section class='user-comments'><p>bad</p></section></div><aside>x</aside><form><p>f</p></form>"
    )
    assert texts(page) == "Title ab line one two"
    assert texts("<article><header><h1>Hi</h1></header><p>a</p><article class=comment>c</article></article><p>out") == "Hi a"
    assert texts("") == "" and texts("plain &lt;text&gt; \xa0 here") == "plain <text> here"
    assert texts("<p>a < b and \"c\" > d</p>") == 'a < b and "c" > d'


def test_site_template_is_cut(spark):
    """Blocks that all pages of a site share go, the pages' own stay."""
    body = "<html><body><div class=top><p>Welcome to our site</p></div><div class=text><p>Story {0} begins</p><p>and ends {0}</p></div>"
    rows = [(i, f"http://a.example/{i}", body.format(i), "x", "y") for i in range(8)]
    rows += [(100, "http://b.example/1", body.format(100), None, None)]  # too few pages to tell
    rows += [(200 + i, "http://c.example/", "<article><p>Same story</p></article>", None, None) for i in range(6)]
    rows += [(300, None, body.format(300), None, None), (301, "http://a.example/n", None, None, None), (0, "http://a.example/0", body.format(0), "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, blocks string")
    got = {}
    found = main_text(pages)
    assert found.columns == ["page_id", "url", "host", "blocks", "text", "n_chars"]
    for r in found.collect():
        got[r["page_id"]] = r["text"]
        assert r["n_chars"] == len(r["text"])
    assert all(got[i] == f"Story {i} begins and ends {i}" for i in range(8))
    assert got[100].startswith("Welcome") and got[300].startswith("Welcome") and got[301] == ""
    assert all(got[200 + i] == "Same story" for i in range(6))
    assert found.count() == len(rows)


def test_long_and_empty(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/1", "<article>" + "<p>word</p>" * 50_000 + "</article>")], "page_id long, url string, html string"
    )
    assert main_text(pages).first()["n_chars"] == 5 * 50_000 - 1
    assert main_text(pages.limit(0)).count() == 0


def test_slugs_in_articles_are_no_names():
    """Ids of headings and sections, and one word of a longer name, mute nothing."""
    body = (
        "<h1 id='search-algorithms'>Search</h1><section id=related-work><h2 id=recommendations>Related</h2><p>work</p></section>"
        "<div class=alert>Careful</div><p class='notice-period'>period</p><div class=ad>buy</div><div class='comments-area'>me too</div>"
        "<article class=comment>c</article><div role=navigation>menu</div>"
    )
    assert texts(f"<article class='post ad-hoc'>{body}</article>") == "Search Related work Careful period"
    assert texts(f"<main>{body}</main>") == "Search Related work Careful period"
    plain = "<body><div class=content><h2 id=search-algorithms>Search</h2><p class=notice-period>period</p><section id=related-work>work</section></div><div id=site-menu>x</div>"
    assert texts(plain) == "Search period work"


def test_names_in_articles_lower_importance(spark):
    """A named part of an article goes when the pages of its site share its text."""
    body = "<article><p>Story {0}</p><div class=alert>{1}</div></article>"
    rows = [(i, f"http://a.example/{i}", body.format(i, "Join us")) for i in range(8)]
    rows += [(10 + i, f"http://b.example/{i}", body.format(i, f"Careful with {i}")) for i in range(8)]
    got = {r["page_id"]: r["text"] for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Story {i}" and got[10 + i] == f"Story {i} Careful with {i}" for i in range(8))


def test_repeats_and_copies_are_no_template(spark):
    """Repeats inside a page, copies of a page and near copies of an article keep their text."""
    body = "<html><body><div class=top><p>Welcome</p></div><div class=text>{0}</div>"
    repeated = ["<ul>" + f"<li>item {i}</li>" * 6 + "</ul>" for i in range(6)]
    rows = [(i, "http://a.example/", body.format(repeated[i])) for i in range(6)]
    rows += [(10 + i, "http://b.example/", f"<article><h1>Head {i}</h1><p>One shared body</p></article>") for i in range(6)]
    # six copies of one page and five others
    rows += [(20 + i, "http://c.example/", body.format(f"<p>Story {max(i - 5, 0)}</p>")) for i in range(11)]
    found = main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    got = {r["page_id"]: r["text"] for r in found.collect()}
    assert all(got[i] == " ".join([f"item {i}"] * 6) for i in range(6))
    assert all(got[10 + i] == f"Head {i} One shared body" for i in range(6))
    assert all(got[20 + i] == f"Story {max(i - 5, 0)}" for i in range(11))


def test_tree_folds_copies(spark):
    """Many copies of one article beside others are one article to the tree."""
    from staylens.llm.style_tree import low_branches, parsed

    rows = [(f"<body><div><p>Story {max(i - 50, 0)}</p></div>", "h") for i in range(55)]
    pages = spark.createDataFrame(rows, "html string, host string").mapInArrow(
        parsed, "host string, blocks array<struct<paths:array<bigint>,hash:bigint,text:string>>, "
        "nodes array<struct<path:bigint,style:bigint,prior:double>>"
    )
    assert low_branches(pages, 0.85, 5).count() == 0
