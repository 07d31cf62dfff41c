"""Column expressions on URLs, pages and links."""

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import strip

# The address with either quotes or none: each reading starts behind its quote.
HTML_LINK = (
    r"""(?is)<a\s[^>]*?href\s*=\s*["']?((?<=")[^"]*|(?<=')[^']*|(?<!["'])[^\s"'>]+)[^>]*>(.*?)</a>"""
)
MARKDOWN_LINK = r"\[([^\[\]]+)\]\((https?://[^\s()]+)[^()]*\)"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
# Ways to write an ampersand.
AMPERSANDS = ("&amp;", "&AMP;", "&#38;", "&#x26;", "&#X26;")
# A page with its article element, whose content is the group; other pages do not match.
ARTICLE_PAGE = r"(?is)^.*?<article[^>]*>(.*)</article>.*$"
# Parts of a page that hold no article text.
FURNITURE = (
    r"(?is)<(?:!--.*?-->|script.*?</script>|style.*?</style>|nav.*?</nav>"
    r"|footer.*?</footer>|aside.*?</aside>|head\b.*?</head>)"
)
BLOCK_END = r"(?i)<(?:/(?:p|h[1-6]|li|div|tr|header|section|blockquote)|br\s*/?)>"
TAG = r"<[^>]*>"
# The attributes of the element may come in either order.
PUBLISHED = (
    r"""(?is)<(?:meta(?=[^>]*published_time)[^>]*?\bcontent|time\b[^>]*?\bdatetime)\s*=\s*["']?(\d{4}-\d{2}-\d{2})"""
)
# An error body in place of a page.
ERROR_BODY = r'(?s)^\s*\{.*"code"\s*:\s*\d+'

REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
# Character references by name, as HTML 5 has them; a hard space is a space in page text.
NAMED = {f"&{name}": char for name, char in html5.items() if name.endswith(";")} | {"&nbsp;": " "}


def url_origin(url: Column) -> Column:
    """Scheme and host: what stands before the third slash."""
    return F.substring_index(url, "/", 3)


def url_host(line: Column) -> Column:
    """Host named after the first https://, without any `www.`; null if there is none."""
    rest = F.get(F.split(line, "https://"), F.lit(1))
    return F.replace(strip(F.substring_index(rest, "/", 1)), F.lit("www."), F.lit(""))


def decode_entities(text: Column) -> Column:
    """Character references as their characters, by name or number; others stay.

    A text's different references are replaced one by one, the ampersand last, so that what
    it makes is not read again.
    """
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)))
    amps = F.array(*[F.lit(x) for x in AMPERSANDS])
    order = F.concat(F.array_except(found, amps), F.array_intersect(found, amps))
    names = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")

    def character(ref: Column) -> Column:
        digits = F.when(
            ref.rlike("^&#[xX]"), F.conv(F.regexp_extract(ref, "^&#[xX]([0-9a-fA-F]+)", 1), 16, 10)
        ).otherwise(F.regexp_extract(ref, "^&#([0-9]+)", 1))
        code = digits.try_cast("int")
        known = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        wide = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(ref.startswith("&#"), F.when(known, wide)).otherwise(F.try_element_at(names, ref))

    replaced = F.aggregate(order, text, lambda done, ref: F.replace(done, ref, F.coalesce(character(ref), ref)))
    # Most texts have none.
    return F.when(F.contains(text, F.lit("&")), replaced).otherwise(text)


def squeeze(text: Column) -> Column:
    """One space for each run of blanks, none around line feeds or at the ends."""
    # The patterns skip what is in order already, which most of a text is.
    text = F.regexp_replace(text, r"[ \t\r]{2,}|[\t\r]", " ")
    text = F.regexp_replace(text, r" \n[ \n]*|\n[ \n]+", "\n")
    return F.btrim(text, F.lit(" \n"))


def html_title(html: Column) -> Column:
    return squeeze(decode_entities(F.regexp_extract(html, TITLE, 1)))


def html_text(html: Column) -> Column:
    """Text of the article element, or of the whole page where there is none."""
    body = F.regexp_replace(html, ARTICLE_PAGE, "$1")
    body = F.regexp_replace(body, FURNITURE, " ")
    body = F.regexp_replace(body, BLOCK_END, "\n")
    return squeeze(decode_entities(F.regexp_replace(body, TAG, " ")))


def html_published(html: Column) -> Column:
    """Publish day as text, null where the page states none."""
    return F.nullif(F.regexp_extract(html, PUBLISHED, 1), F.lit(""))


def page_links(page: Column) -> Column:
    """array<struct<title, url>> of a page's HTML and Markdown links; empty for an error body."""

    def pairs(pattern: str, title_group: int, url_group: int) -> Column:
        return F.arrays_zip(
            F.regexp_extract_all(page, F.lit(pattern), F.lit(title_group)).alias("title"),
            F.regexp_extract_all(page, F.lit(pattern), F.lit(url_group)).alias("url"),
        )

    found = F.transform(
        F.concat(pairs(HTML_LINK, 2, 1), pairs(MARKDOWN_LINK, 1, 2)),
        lambda link: F.struct(
            squeeze(decode_entities(F.regexp_replace(link["title"], TAG, " "))).alias("title"),
            link["url"].alias("url"),
        ),
    )
    none = F.array().cast("array<struct<title: string, url: string>>")
    return F.when(page.rlike(ERROR_BODY), none).otherwise(F.coalesce(found, none))
