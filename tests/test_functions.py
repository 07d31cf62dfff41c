import textwrap

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions import scores, text, web
from newsloom.operators import baselines


def one(spark, column, **values):
    """The column's value on a row of the given strings."""
    row = spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def each(spark, column, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_hosts(spark):
    lines = [
        "https://www.site.es/tech", "  https://a.www.b.org", "http://", "http://plain.com/x",
        'https://x.com/p"', "see https://y.net/1 and https://z.net/2", None,
        "https://tab.org\t",
    ]
    assert each(spark, web.url_host(F.col("x")), lines) == [
        "site.es", "a.b.org", None, None, "x.com", "y.net", None, "tab.org",
    ]


def test_origins(spark):
    urls = ["https://a.com/b/c", "https://a.com", "a.com/b/c/d", "", "x", None, "https://a.com/"]
    want = ["/".join(u.split("/")[:3]) if u is not None else None for u in urls]
    assert each(spark, web.url_origin(F.col("x")), urls) == want


def test_source_names(spark):
    assert each(spark, text.normalize_source(F.col("x")), ["The Next  Web", None, ""]) == [
        "the_next__web", None, "",
    ]


def test_keys(spark):
    keys = ["R--t--a", "R--t--a--b", "R--t", "", None, "R--t--"]
    parts = each(spark, text.split_key(F.col("x")), keys)
    assert [tuple(p) if p else None for p in parts] == [
        ("R", "t", "a"), None, None, None, None, ("R", "t", ""),
    ]


def test_key_with_null_part_is_null(spark):
    key = text.composite_key(F.col("r"), F.lit("t"), F.col("i"))
    assert one(spark, key, r="R", i="7") == "R--t--7"
    assert one(spark, key, r="R", i=None) is None


def test_number_suffix(spark):
    names = ["RUNID_10", "RUNID_9", "R--t_v0_BATCHFILE_12.jsonl", "none", None]
    assert each(spark, text.number_suffix(F.col("x")), names) == [10, 9, 12, None, None]


def test_article_info(spark):
    info = text.article_info(F.col("s"), F.array(F.lit("a"), F.lit("b")), F.lit("body"))
    assert one(spark, info, s="jina") == "keywords: a, b\n"
    assert one(spark, info, s="ddgs") == "body"
    assert one(spark, info, s="rss") is None


def test_newlines_become_two_characters(spark):
    assert one(spark, text.escape_newlines(F.col("x")), x="a\nb\\n") == "a\\nb\\n"


def test_row_json_keeps_nulls(spark):
    assert one(spark, text.row_json("a", "b"), a="ñ", b=None) == '{"a":"ñ","b":null}'


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" ab\n", max_size=12), min_size=20, max_size=20))
def test_dedent(spark, texts):
    found = each(spark, text.strip(text.dedent(F.col("x"))), texts)
    assert found == [textwrap.dedent(t).strip() for t in texts]


PAGE = """<html><head><title> A &amp; B </title>
<meta property="article:published_time" content="2025-05-30T10:00:00Z"></head>
<body><header>top</header><nav><a href="/nav">nav</a></nav><article><p>One&nbsp;two.</p>
<script>x = "<p>no</p>"</script><p>Three <b>four</b></p></article><footer>end</footer></body></html>"""


def test_page(spark):
    x = F.col("x")
    assert one(spark, web.html_title(x), x=PAGE) == "A & B"
    assert one(spark, web.html_text(x), x=PAGE) == "One two.\nThree four"
    assert one(spark, web.html_published(x), x=PAGE) == "2025-05-30"
    assert one(spark, web.html_published(x), x="<time datetime='x'>") is None
    assert one(spark, web.html_published(x), x='<time class="d" datetime="2024-01-02T00:00">') == "2024-01-02"


def test_page_without_article_element(spark):
    page = "<head><title>t</title></head><header>H</header><p>a</p><footer>f</footer>"
    assert one(spark, web.html_text(F.col("x")), x=page) == "H\na"


def test_links(spark):
    page = (
        'Title: x\n[First <b>one</b>](https://a.com/1) text [two](https://a.com/2 "t") '
        '<a class="k" href="/three">Three &amp; <i>more</i></a> ![img](not a link)'
    )
    found = one(spark, web.page_links(F.col("x")), x=page)
    assert [tuple(r) for r in found] == [
        ("Three & more", "/three"), ("First one", "https://a.com/1"), ("two", "https://a.com/2"),
    ]


@pytest.mark.parametrize("page", ['{"data":null,"code":451,"name":"E","message":"[a](https://b.c)"}', None, "plain"])
def test_no_links(spark, page):
    assert one(spark, web.page_links(F.col("x")), x=page) == []


def test_any_relevant(spark):
    df = spark.createDataFrame(
        [(1, {"a": 0, "b": 2}), (2, {"a": 1}), (3, {}), (4, {"a": None}), (5, {"a": None, "b": 2}), (6, None)],
        "i int, m map<string,int>",
    )
    kept = df.where(scores.any_relevant(F.col("m"))).select("i").collect()
    assert sorted(r["i"] for r in kept) == [1, 5]


@pytest.mark.parametrize(
    "scored, language, problem",
    [
        ({"A": 0, "B": 2}, "es", None),
        ({"A": 0}, "es", "missing persona"),
        ({"A": 0, "B": 1, "C": 1}, "es", "unknown persona"),
        ({"A": 0, "B": 3}, "es", "score out of range"),
        ({"A": 0, "B": None}, "es", "score out of range"),
        ({"A": 0, "B": 1}, "de", "unknown language"),
        ({"A": 0, "B": 1}, None, "unknown language"),
        (None, "es", "no scores"),
    ],
)
def test_contract(spark, scored, language, problem):
    df = spark.createDataFrame([(scored, language)], "s map<string,int>, l string")
    found = df.select(scores.contract_error(F.col("s"), F.col("l"), ["A", "B"]).alias("p")).first()["p"]
    assert found == problem


def test_keyword_scores(spark):
    text_ = "La Inteligencia artificial, y los DATOS: ¡sostenibilidad!"
    words = {"X": ["inteligencia artificial", "datos"], "Y": ["sostenibilidad", "dato"], "Z": ["artificial intel"]}
    assert one(spark, baselines.keyword_scores(F.col("x"), words), x=text_) == {"X": 2, "Y": 1, "Z": 0}


def test_validity_rules(spark):
    sentence = "This is a sentence of an article that goes on for a while. "
    error = '{"data": null, "code": 451, "message": "' + sentence * 5 + '"}'
    texts = [error, sentence * 5, sentence, "a" * 300, sentence * 5 + "Subscribe to continue reading.", None, ""]
    found = each(spark, baselines.is_article(F.col("x")), texts)
    assert found == [False, True, False, False, False, None, False]


def test_lead_summary(spark):
    assert one(spark, baselines.lead_summary(F.col("x")), x="One. Two! Three? Four.") == "One. Two! Three?"
    assert one(spark, baselines.lead_summary(F.col("x")), x="no end") == "no end"
    assert one(spark, baselines.lead_summary(F.col("x")), x="At 1.252. 0") == "At 1. 252. 0"


@pytest.mark.parametrize(
    "page, links",
    [
        ("<a href='https://a.com/1'>A</a>", [("A", "https://a.com/1")]),
        ("<a class=x href=https://a.com/2 id=y>B &ntilde;</a>", [("B ñ", "https://a.com/2")]),
        ('<a href = "https://a.com/it\'s">C &#233;&#x1F600;&amp;lt;</a>', [("C é😀&lt;", "https://a.com/it's")]),
        ("<a href=''>D</a><a name=z>E</a>", [("D", "")]),
    ],
)
def test_links_of_all_forms(spark, page, links):
    found = spark.createDataFrame([(page,)], "p string").select(web.page_links(F.col("p")).alias("l")).first()["l"]
    assert [(x["title"], x["url"]) for x in found] == links


@pytest.mark.parametrize(
    "page, day",
    [
        ('<meta property="article:published_time" content="2025-01-02T03:04">', "2025-01-02"),
        ("<meta content='2025-01-02' property='article:published_time'>", "2025-01-02"),
        ("<time class=x datetime=2025-03-04>", "2025-03-04"),
        ('<meta property="other" content="2025-01-02">', None),
    ],
)
def test_publish_day_in_either_order(spark, page, day):
    assert spark.createDataFrame([(page,)], "p string").select(web.html_published(F.col("p"))).first()[0] == day


def test_references(spark):
    text = "&ntilde;&rsquo;&nbsp;&#233;&#xE9;&unknown;&#0;&#xD800;&#1114112;&amp;eacute;&lt;&copy"
    assert spark.createDataFrame([(text,)], "p string").select(web.decode_entities(F.col("p"))).first()[0] == (
        "ñ’ éé&unknown;&#0;&#xD800;&#1114112;&eacute;<&copy"
    )


def test_keywords_with_marks_match(spark):
    scores = baselines.keyword_scores(F.col("t"), {"p": ["e-commerce", "C++ code"], "q": ["com"]})
    found = spark.createDataFrame([("About E-Commerce and c code",)], "t string").select(scores.alias("s")).first()["s"]
    assert found == {"p": 2, "q": 0}


def test_keys_that_cannot_be_read_back_fail(spark):
    df = spark.createDataFrame([("a-b",), ("x--y",), ("-z",)], "i string")
    key = text.readable_key(F.lit("R1"), F.lit("t"), F.col("i"))
    for good in ("a-b", "-z"):
        made = df.where(F.col("i") == good).select(key.alias("k"))
        assert made.select(text.split_key(F.col("k"))["item_id"]).first()[0] == good
    with pytest.raises(Exception, match="may hold --"):
        df.where("i = 'x--y'").select(key).collect()
