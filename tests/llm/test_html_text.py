import html as references
import random
import re
import time

import pytest
from newsloom.llm import html_text as h

PAGES = "page_id long, url string, html string"
CASES = {
    "<p>a &amp; b<br>c<p>d&#233;&nbsp;&lt;i&gt;": "a & b c\n\ndé <i>",
    "<body><header><a href=x>Site</a></header><nav>m</nav><article><header><h1>T</h1></header><p>x\n  y</p></article><footer>f</footer>": "T\n\nx y",
    "<main><h1>T</h1><div class='ad-slot'>buy</div><p>one <b>tw</b>o</p><section id='comments'><p>no</p></section></main><div>other</div>": "T\n\none two",
    "<div class='cookie-notice'>c</div><div class='content'><p>x</p><form><p>q</p></form><aside>s</aside></div>": "x",
    "<script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><p>yes</p><noscript>n</noscript>": "yes",
    "<article><ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table><pre> a\n b </pre></article>": "one\n\ntwo\n\n1\n\n2\n\n3\n\na b",
    "<div role='navigation'>m</div><div hidden>h</div><div style='display: none'>h</div><p>t</p></div></p></b>": "t",
    "<div id='header'>h</div><ul><li><a>one</a><li><a>two</a><li><a>three</a></ul><div><p>A text with <a>a link</a></p></div>": "A text with a link",
    "<div class='post'><div class='post-header'><h1>T</h1></div><p aria-hidden='true'>x</p><div class='commentList'><p>no</p></div>y</div>": "T\n\ny",
    "<article><ul><li><a>one</a><li><a>two</a><li><a>three</a></ul></article>": "one\n\ntwo\n\nthree",
    "plain": "plain", "": "", "<": "<", "<p>cut of <b": "cut of", "&am &unknown; &copy": "&am &unknown; ©",
    "<p class='headline additional'>kept</p>": "kept", "<p>a</p>b<p>c": "a\n\nb\n\nc",
}


@pytest.mark.parametrize("page", CASES)
def test_main_text(page):
    assert h.main_text(page) == CASES[page]


@pytest.mark.parametrize("piece", ["<", "<!--", "<a ", "&", "<![CDATA[", "</", "<div><", "<a href='", '<a b="c', "<table><tr><td>", "<ul><li>", "<title>", "x <", "<textarea>x"])
def test_time_grows_with_the_page(piece):
    start = time.perf_counter()
    h.main_text(piece * 20_000)
    assert time.perf_counter() - start < 15


@pytest.mark.parametrize("seed", range(3))
def test_any_text_is_a_page(seed):
    draw = random.Random(seed)
    pieces = ["<p>", "</p>", "<div class='", "'>", '">', "<!--", "-->", "<![", "<![CDATA[", "]]>", "<!", "<?", "<script>", "</script>", "<", "&", "&#x", "&#xD800;", "x ", "\x00", "</", "<a href=", "<title>", "<article>", "</article>", "<br/>", "<li>", "<plaintext>", "="]
    for _ in range(3000):
        h.main_text("".join(draw.choice(pieces) for _ in range(draw.randrange(15))))


WRAPPERS = [
    "content-sidebar-wrap", "has-sidebar", "no-sidebar", "comments-open", "post social-science", "ad-free", "sidebar", "page widget",
]


@pytest.mark.parametrize("name", WRAPPERS)
@pytest.mark.parametrize("tag", ["main", "article", "div"])
def test_wrappers_of_the_article_stay(name, tag):
    page = f"<div class='{name}'><{tag}><p>The text of the page.</p><div class='share-buttons'>Tell</div></{tag}></div><div id='main-sidebar'>Other</div>"
    assert h.main_text(page) == "The text of the page."


def test_forms_around_pages_stay():
    page = "<body><form action=x><div><p>All of the page stands in a form.</p><form><p>q</p></form></div></form><div class='social'>s</div></body>"
    assert h.main_text(page).startswith("All of the page stands in a form.")
    assert h.main_text("<main><p>The text of the page.</p><form><fieldset>Search</fieldset></form></main>") == "The text of the page."


def test_long_boxes_beside_an_article_go():
    assert h.main_text("<div class='ad'>Much longer than the article of it all</div><article><h1>Title</h1></article>") == "Title"


def test_comments_as_articles_go():
    page = "<main><article><p>The text of the page.</p></article><div id='comments'><article><p>Nice!</p></article></div></main>"
    assert h.main_text(page) == "The text of the page."


BODY = "<div><h1>Title</h1><p>The text of the page stands in a plain box.</p><p>It goes on for some time.</p></div>"
TEXT = "Title\n\nThe text of the page stands in a plain box.\n\nIt goes on for some time."


def test_teaser_articles_are_not_the_page():
    cards = "".join(f"<article><a href=x>Read this next, number {k}, and more</a></article>" for k in range(4))
    assert TEXT in h.main_text(f"<body>{BODY}<div>{cards}</div></body>")
    cards = "<article><h3>Card</h3><p>A short teaser.</p></article>" * 3
    assert TEXT in h.main_text(f"<body>{BODY}<div>{cards}</div></body>")
    assert TEXT in h.main_text(f"<body>{BODY}<main><p>Beside.</p></main></body>")


def test_articles_and_mains_that_hold_the_page():
    cards = "<article><p>A short teaser.</p></article>"
    assert h.main_text(f"<article>{BODY}</article><div>{cards}</div><p>Other</p>") == TEXT
    assert h.main_text(f"<main><article>{BODY}</article><p>Below</p></main><p>Other</p>") == TEXT + "\n\nBelow"


def test_names_around_each_other_take_no_longer():
    start = time.perf_counter()
    assert h._read("<div class='sidebar'>x" * 20_000 + "<main>y").blocks
    assert h.main_text(f"<div class='{'left-' * 20_000}x'>y</div>") == "y"
    assert time.perf_counter() - start < 5


def test_long_and_deep_pages():
    assert h.main_text("<p>" + "word " * 300_000) == " ".join(["word"] * 300_000)
    assert h.main_text("<div>" * 20_000 + "x") == "x"
    assert h.main_text("<b>" * 20_000 + "x</i>" * 20_000) == "x" * 20_000


def test_generated_pages_agree_with_brute_force(spark):
    """All of these pages have one article of titles and paragraphs."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in h.extract_text(pages).collect()}
    assert len(found) == pages.count()
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article.replace("<br>", " ")))
        blocks = [" ".join(references.unescape(b).split()) for b in blocks]
        assert found[r.page_id] == "\n\n".join(b for b in blocks if b)


def _site(n, same=False):
    rows = []
    for i in range(n):
        body = "".join(f"<p>Text {0 if same else i} part {k} of the page</p>" for k in range(4))
        rows.append((i, f"http://Site.org/p{i}", f"<body><div><div>Our site <span>since 1990</span></div><div><p>Menu of all</p></div></div><div>{body}</div></body>"))
    return rows


def test_recurring_subtrees_go(spark):
    table = spark.createDataFrame(_site(20) + [(90, "http://other.org/", _site(1)[0][2]), (91, None, _site(1)[0][2])], PAGES)
    found = {r.page_id: r.text for r in h.extract_text(table.selectExpr("*", "1 AS template", "2 AS host")).collect()}
    article = "\n\n".join(f"Text {{0}} part {k} of the page" for k in range(4))
    for i in range(20):
        assert found[i] == article.format(i)
    assert found[90] == found[91] == "Our site since 1990\n\nMenu of all\n\n" + article.format(0)


NOISE = [
    "related-posts", "comments-wrapper", "ad-wrapper", "footer-navigation", "sidebar-posts", "reader-comments", "user-comments",
    "fb-comments", "comment-body", "google-ads", "adsbygoogle", "cookie-law", "siteFooter", "leftSidebar", "newsletterBox",
    "side-bar", "skip-link", "AdSlot", "promo-box", "login_form",
]
LONG = "<p>" + "Much more text than the page itself has to say of its matter. " * 9 + "</p>"


@pytest.mark.parametrize("attribute", ["class", "id"])
@pytest.mark.parametrize("name", NOISE)
def test_noise_goes_by_parts_of_its_name(name, attribute):
    box = f"<div {attribute}='x1 {name}'>{LONG}</div>" if attribute == "class" else f"<div id='{name}'>{LONG}</div>"
    for around in ("<main>{}</main>", "<article>{}</article>", "<div>{}</div>"):
        assert h.main_text(around.format("<h1>Title</h1><p>A short note.</p>" + box)) == "Title\n\nA short note."
        assert h.main_text(around.format("<p>A short note.</p>") + box) == "A short note."


@pytest.mark.parametrize("name", ["post social-science", "ad-free", "comments-open", "has-sidebar", "category-advertising", "share-price", "menu-of-the-day", "no-comments", "loading adding"])
def test_names_that_say_otherwise_stay(name):
    assert h.main_text(f"<div><p>One.</p><div class='{name}'><p>Two.</p></div></div>") == "One.\n\nTwo."


def test_comments_with_articles_of_their_own_are_not_the_page():
    comments = f"<div id='comments'><article>{LONG}</article><article>{LONG}</article></div>"
    assert h.main_text(f"<div><p>A short note.</p></div>{comments}") == "A short note."
    assert h.main_text(f"<div class='cookie-page'><main><p>A short note.</p></main></div>{comments}") == "A short note."


def test_lists_that_some_articles_share_stay(spark):
    shared = "<ul><li>200 g of flour</li><li>two eggs</li></ul>"
    rows = [(i, "http://a.org/x", f"<article><h1>Cake {i}</h1>{_own(i)}{shared if i < 3 else ''}</article>") for i in range(12)]
    found = {r.page_id: r.text for r in h.extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(("flour" in found[i]) == (i < 3) for i in range(12))


def _own(k):
    return "".join(f"<p>Own part {j} of text {k}, which is long enough to tell.</p>" for j in range(3))


@pytest.mark.parametrize("n, boxed", [(20, 6), (600, 110)])
def test_boxes_on_some_of_the_pages_go(spark, n, boxed):
    box = "<div><p>Our offer of the week</p></div>"
    rows = [(i, "http://a.org/x", f"<body><div>{_own(i)}</div>{box if i < boxed else ''}</body>") for i in range(n)]
    found = {r.page_id: r.text for r in h.extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert len(found) == n
    assert not any("offer" in t for t in found.values())
    assert all(t.count("Own part") == 3 for t in found.values())


def test_short_pages_lose_the_template_and_copied_articles_stay(spark):
    terms = "<div>" + "<p>Terms and conditions of this site apply to all.</p>" * 20 + "</div>"
    copied = "<div>" + "".join(f"<p>Sentence {j} of an article that several pages carry.</p>" for j in range(20)) + "</div>"
    rows = [(i, "http://a.org/x", f"<body><div>{_own(i) * 8}</div>{terms}</body>") for i in range(14)]
    rows += [(20, "http://a.org/n", f"<body><div><p>A short note.</p></div>{terms}</body>")]
    rows += [(30 + i, "http://a.org/c", f"<body><div><p>Day {i}</p>{copied}</div>{terms}</body>") for i in range(5)]
    found = {r.page_id: r.text for r in h.extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert found[20] == "A short note."
    assert all(f"Day {i}" in found[30 + i] and found[30 + i].count("Sentence") == 20 for i in range(5))
    assert not any("Terms" in t for t in found.values())


def test_copies_of_a_page_are_no_template(spark):
    table = spark.createDataFrame(_site(20, same=True), PAGES)
    assert all("Text 0 part 3" in r.text for r in h.extract_text(table).collect())


def test_passages_of_articles_are_no_template(spark):
    rows = [(i, "http://a.org/x", f"<article><p>Shared passage</p><p>own {i}</p><div>Read more here</div></article>") for i in range(9)]
    assert {r.text for r in h.extract_text(spark.createDataFrame(rows, PAGES)).collect()} == {f"Shared passage\n\nown {i}" for i in range(9)}


def test_nulls_repeats_and_no_rows(spark):
    table = spark.createDataFrame([(1, None, None), (1, None, None), (None, "http://a/", "<p>x"), (2, "", "")], PAGES)
    found = sorted([(r.page_id, r.url, r.text) for r in h.extract_text(table).collect()], key=repr)
    assert found == sorted([(1, None, ""), (1, None, ""), (None, "http://a/", "x"), (2, "", "")], key=repr)
    assert h.extract_text(table.limit(0)).count() == 0
