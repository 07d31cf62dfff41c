"""The main text of web pages, without the template of their site."""

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import one_per_key, row_keys, store
from newsloom.llm.url_filters import url_host

# A subtree recurs on a host if so many of its different pages have it that they count as many, or
# on small hosts this share of them and not fewer than MIN_PAGES.
MIN_PAGES = 3
MIN_SHARE = 0.2
MANY_PAGES = 100
# Inside main elements and articles it takes this share of the host's pages, however many they are:
# a list or table that some articles have in common is text.
INNER_SHARE = 0.5
# A page that would lose more than this share of its text is much like other pages. What recurs
# mostly on such pages is a copied article and no template.
MOST_LOST = 0.9

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead tr ul head title".split()
)
_MAIN = frozenset(("article", "main"))
# What may be part of a template inside an article; single paragraphs there are text.
_CONTAINERS = frozenset("details div dl fieldset figure hgroup menu ol section table ul".split())
_DROPPED = frozenset(
    "head script style noscript template nav footer aside button select textarea iframe object svg canvas "
    "audio video dialog menu math applet map".split()
)
# These go like elements with a name of _NAMES: unless they hold the main part of the page.
_FORMS = frozenset(("form", "fieldset"))
_CLOSES_P = _BLOCKS - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "html", "body", "option", "optgroup"}
# Start tags that end an open element of the same group, up to the element that holds the group.
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
# Names of a class or id are read in parts, cut at signs and capitals. A part of these says that the
# box is none of the text, whatever stands beside it,
_NOISE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adsbygoogle breadcrumb breadcrumbs "
    "comment comments commentlist commentform commentbox disqus consent cookie cookies cookiebar footer gdpr login "
    "masthead nav navbar navigation newsletter newsletters pager pagination popup popups replies sidebar sidebars "
    "signin signup skiplink skiplinks sponsor sponsored sponsors subscribe subscription topbar".split()
)
# unless one of these says otherwise: it is there or not, or names what the text is about.
_OTHERWISE = frozenset(
    "allowed category closed count disabled enabled format free has hidden hide no non off on open postid status tag "
    "toggled topic topics type with without".split()
)
# Boxes whose contents are no text even where there is no other.
_NEVER = frozenset(
    "ad ads advert adverts advertisement advertisements adsbygoogle comment comments commentlist consent cookie cookies "
    "cookiebar disqus footer gdpr login replies signin signup".split()
)
# Weaker words: all parts must be of these, of those above, or say where or what kind of box it is.
_WEAK = frozenset(
    "alert banner menu modal notice notices overlay promo promos promotion rail recommended related respond share "
    "sharing social toolbar widget widgets".split()
)
_BESIDE = frozenset(
    "article articles bar block bottom box button buttons container desktop floating form global icon icons inner item "
    "items left link links list lower main media mobile outer page panel post posts primary right row secondary "
    "section area site slot slots sticky stories top unit units upper wrap wrapper".split()
)
# A class such as content-sidebar-wrap holds both.
_WRAPPERS = frozenset("container inner layout wrap wrapper".split())
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
# Longer names are no words of their authors.
_MOST_NAME = 200


@lru_cache(maxsize=1 << 16)
def _noise(name: str) -> tuple[bool, bool]:
    """Whether one name of a class or id says that the box is none of the text, and whether it
    never is."""
    if len(name) > _MOST_NAME:
        return False, False
    parts = [x.lower() for x in _PART.findall(name) if not x.isdigit()]
    if not parts or not _OTHERWISE.isdisjoint(parts):
        return False, False
    if parts[0] in ("content", "main") and parts[-1] in _WRAPPERS:
        return False, False
    pairs = {f"{a}{b}" for a, b in zip(parts, parts[1:], strict=False)}
    own = pairs.union(parts)
    if not _NOISE.isdisjoint(own):
        return True, not _NEVER.isdisjoint(own)
    weak = not _WEAK.isdisjoint(parts) and all(x in _WEAK or x in _BESIDE for x in parts)
    return weak, False


_HEADERS = re.compile(r"(?:^|\s)(?:(?:site|page|top|main|global|blog)[_-]?)?header(?:$|\s)", re.IGNORECASE)
# Links in a list or box, and their share of its text, from which it is a menu.
MENU_LINKS = 3
MENU_SHARE = 0.8
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


# One tag: its name, and the rest with its attributes. Nothing in it is tried twice.
_TAG = re.compile(r"""<([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s/=]++)\s*+(?:=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
# Elements whose content is text up to their end tag.
_RAW = {
    tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE)
    for tag in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
}
# Deeper elements are part of the element at this depth.
_MOST_DEPTH = 512


class _Element:
    __slots__ = (
        "dropped", "gone", "hash", "held", "holds_main", "in_main", "inner", "linked", "links", "never", "number",
        "parent", "size", "tag",
    )

    def __init__(self, tag: str, dropped: bool, in_main: bool, parent: "_Element | None", gone: bool = False, number: int = 0):
        self.tag, self.dropped, self.in_main, self.parent = tag, dropped, in_main, parent
        # Dropped whatever it holds; and the place among all start tags.
        self.gone, self.number = gone, number
        # Dropped by a name that stands for no text at all.
        self.never = False
        # Characters that are not in links, in what is dropped by name too.
        self.held = 0
        self.holds_main = tag == "main" and not gone
        self.inner: list[bytes] = []
        # Characters of text, those in links, and links.
        self.size = self.linked = self.links = 0
        self.hash = 0

    def is_menu(self) -> bool:
        return self.links >= MENU_LINKS and self.linked >= MENU_SHARE * self.size

    def trail(self) -> list["_Element"]:
        """The blocks that it lies in, itself included, from the inside out."""
        found, element = [], self
        while element.parent is not None:
            if element.tag in _BLOCKS:
                found.append(element)
            element = element.parent
        return found


class _Page:
    """Blocks of text in page order, each with its innermost element. Takes time in proportion to
    the page, whatever is in it. Elements of the numbers in `spared` are not dropped by name."""

    def __init__(self, html: str, spared: frozenset[int] = frozenset()):
        self.spared, self.started = spared, 0
        self.named: list[_Element] = []
        self.largest: _Element | None = None
        self.main_held = 0
        # Characters that are neither in links nor in anything that is dropped.
        self.kept = 0
        root = _Element("", False, False, None)
        self.stack = [root]
        self.open: Counter[str] = Counter()
        self.too_deep: Counter[str] = Counter()
        self.parts: list[str] = []
        self.owner = root
        self.blocks: list[tuple[str, _Element]] = []
        # Characters of the block that is read, and of each block, that are not in links.
        self.plain = 0
        self.plains: list[int] = []
        self.read(html)
        self.close_to(1)

    def read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            sign = html.find("<", at)
            if sign != at:
                self.text(html[at : sign if sign >= 0 else end])
            if sign < 0:
                return
            after = html[sign + 1 : sign + 2]
            if after.isascii() and after.isalpha():
                tag = _TAG.match(html, sign)
                if tag is None:
                    # The page ends inside the tag.
                    return
                name, at = tag[1].lower(), tag.end()
                self.start(name, tag[2])
                if name == "plaintext":
                    return
                if name in _RAW:
                    close = _RAW[name].search(html, at)
                    # Nothing but the end tag is read there; all of these are dropped.
                    at = close.start() if close else end
            elif after in ("!", "?", "/"):
                if html.startswith("<!--", sign):
                    close = -1 if html.startswith(("<!-->", "<!--->"), sign) else html.find("-->", sign + 4)
                    at = close + 3 if close >= 0 else html.find(">", sign) + 1 if html.startswith(("<!-->", "<!--->"), sign) else end
                    continue
                close = html.find(">", sign)
                if close < 0:
                    return
                name = html[sign + 2 : sign + 3]
                if after == "/" and name.isascii() and name.isalpha():
                    self.finish(re.split(r"[\s/>]", html[sign + 2 : min(close, sign + 100)], maxsplit=1)[0].lower())
                at = close + 1
            else:
                self.text("<")
                at = sign + 1

    def wrongly_named(self) -> frozenset[int]:
        """The elements dropped by name that hold a main element, or the largest article, or, where
        all of the text is in such boxes, most of it. Boxes of comments, cookies, adverts,
        footers and logins are wrongly named only if they hold a main element."""
        inside, element = set(), self.largest
        while element is not None:
            inside.add(element.number)
            element = element.parent
        total = self.stack[0].held
        elsewhere = self.kept > 0 or self.main_held > 0 or (self.largest is not None and self.largest.held > 0)
        return frozenset(
            e.number for e in self.named
            if e.holds_main or (not e.never and (e.number in inside or (not elsewhere and 2 * e.held > total)))
        )

    def text(self, data: str) -> None:
        element = self.stack[-1]
        plain = sum(map(len, data.split())) if not element.gone and self.open["a"] <= 0 else 0
        element.held += plain
        if not element.dropped:
            self.owner = element
            self.kept += plain
            data = unescape(data) if "&" in data else data
            self.parts.append(data)
            self.plain += plain
            if self.open["a"] > 0:
                element.linked += len(data.strip())

    def flush(self) -> None:
        if not self.parts:
            return
        text = " ".join("".join(self.parts).split())
        self.parts, plain, self.plain = [], self.plain, 0
        if text:
            self.blocks.append((text, self.owner))
            self.plains.append(plain)
            self.owner.size += len(text)
            self.owner.inner.append(text.encode("utf-8", "surrogatepass"))

    def pop(self) -> None:
        element = self.stack.pop()
        self.open[element.tag] -= 1
        body = element.tag.encode("utf-8", "surrogatepass") + b"\0" + b"\0".join(element.inner)
        element.hash = xxhash.xxh64_intdigest(body, 1) >> 1
        parent = self.stack[-1]
        parent.held += element.held
        parent.holds_main |= element.holds_main
        if element.tag == "article" and not element.gone and (self.largest is None or element.held > self.largest.held):
            self.largest = element
        if element.tag == "main" and not element.gone:
            self.main_held = max(self.main_held, element.held)
        parent.linked += element.linked
        parent.links += element.links
        if element.size:
            parent.inner.append(element.hash.to_bytes(8, "little"))
            parent.size += element.size
        element.inner = []

    def close_to(self, depth: int) -> None:
        self.flush()
        while len(self.stack) > depth:
            self.pop()

    def close_sibling(self, tags: set[str], within: set[str]) -> None:
        if any(self.open[t] > 0 for t in tags):
            for depth in range(len(self.stack) - 1, 0, -1):
                if self.stack[depth].tag in tags:
                    self.close_to(depth)
                    return
                if self.stack[depth].tag in within:
                    return

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in _BLOCKS:
            self.flush()
        if tag in _CLOSES_P:
            self.close_sibling({"p"}, _BLOCKS - {"p"})
        if tag in _SIBLINGS:
            self.close_sibling(*_SIBLINGS[tag])
        if tag in _VOID:
            return
        if len(self.stack) > _MOST_DEPTH:
            self.too_deep[tag] += 1
            return
        parent = self.stack[-1]
        self.started += 1
        gone = parent.gone or tag in _DROPPED or (tag == "header" and not parent.in_main)
        named, never = tag in _FORMS, False
        if not gone and attributes and tag not in ("html", "body"):
            gone, by_name, never = _is_dropped(attributes, parent.in_main)
            named = named or by_name
        named = named and not gone
        dropped = gone or parent.dropped or (named and self.started not in self.spared)
        element = _Element(tag, dropped, parent.in_main or (tag in _MAIN and not gone), parent, gone, self.started)
        if named:
            element.never = never
            self.named.append(element)
        element.links = int(tag == "a")
        self.stack.append(element)
        self.open[tag] += 1
        self.owner = element

    def finish(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.flush()
        if self.too_deep[tag] > 0:
            self.too_deep[tag] -= 1
        elif self.open[tag] > 0:
            for depth in range(len(self.stack) - 1, 0, -1):
                if self.stack[depth].tag == tag:
                    if tag in _BLOCKS:
                        self.close_to(depth)
                    else:
                        while len(self.stack) > depth:
                            self.pop()
                        self.owner = self.stack[-1]
                    return
                if tag not in _BLOCKS and self.stack[depth].tag in _BLOCKS:
                    return


def _is_dropped(attributes: str, in_main: bool) -> tuple[bool, bool, bool]:
    """Whether an element's attributes say that it is no part of the text: hidden, by name, and by
    a name that never is."""
    values: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        values.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    names = [values[k] for k in ("class", "id") if k in values]
    hidden = (
        "hidden" in values or values.get("aria-hidden") == "true" or bool(_HIDDEN.search(values.get("style", "")))
    )
    said = [_noise(part) for name in names for part in name.split()]
    named = any(noise for noise, _ in said)
    return hidden, (
        values.get("role", "").lower() in _ROLES or named or (not in_main and any(_HEADERS.search(n) for n in names))
    ), any(never for _, never in said)


def _read(html: str) -> _Page:
    """The page, read again at most once if names would drop the main part of it."""
    page = _Page(html)
    spared = page.wrongly_named()
    return _Page(html, spared) if spared else page


def _main_blocks(page: _Page) -> list[bool] | None:
    """Which blocks lie in the main elements, else in the largest article, if these hold most of
    the text that is not in links; else None."""
    known: dict[int, tuple[bool, int]] = {0: (False, 0)}

    def place(element: _Element) -> tuple[bool, int]:
        """Whether it lies in a main element, and the number of its outermost article or 0."""
        path = []
        while element.number not in known:
            path.append(element)
            element = element.parent
        found = known[element.number]
        for e in reversed(path):
            found = (found[0] or e.tag == "main", found[1] or (e.number if e.tag == "article" else 0))
            known[e.number] = found
        return found

    outer = [place(element) for _, element in page.blocks]
    total = sum(page.plains)
    if any(m for m, _ in outer) and 2 * sum(n for (m, _), n in zip(outer, page.plains, strict=True) if m) >= total:
        return [m for m, _ in outer]
    articles: Counter[int] = Counter()
    for (_, article), n in zip(outer, page.plains, strict=True):
        if article:
            articles[article] += n
    if articles:
        largest, n = articles.most_common(1)[0]
        if 2 * n >= total:
            return [article == largest for _, article in outer]
    return None


def _candidates(page: _Page) -> list[tuple[str, list[_Element]]]:
    """The blocks of the main text, with the subtrees around each that may be a template."""
    chosen = _main_blocks(page)
    has_main = chosen is not None
    found = []
    for i, (text, element) in enumerate(page.blocks):
        if has_main and not chosen[i]:
            continue
        if has_main:
            trail = [e for e in element.trail() if e.in_main and e.tag in _CONTAINERS]
        else:
            trail = [e for e in element.trail() if e.tag not in ("html", "body")]
            if any(e.is_menu() for e in trail):
                continue
        found.append((text, trail))
    return found


def subtrees(html: str) -> tuple[int, int, dict[tuple[int, bool], int]]:
    """Hash of the whole page, its characters, and the hashes of the subtrees that may be a
    template, with whether they lie in a main element or article, and the characters of the
    blocks that have no such subtree further inside."""
    found = _candidates(_read(html))
    whole = xxhash.xxh64_intdigest("\n".join(t for t, _ in found).encode("utf-8", "surrogatepass")) >> 1
    trees: Counter[tuple[int, bool]] = Counter()
    for text, trail in found:
        for i, e in enumerate(trail):
            trees[e.hash, e.in_main] += 0 if i else len(text)
    return whole, sum(len(t) for t, _ in found), dict(trees)


def main_text(html: str, template: set[int] | frozenset[int] = frozenset()) -> str:
    """The blocks of the main text, joined by empty lines, without the subtrees in `template`."""
    return "\n\n".join(text for text, trail in _candidates(_read(html)) if not any(e.hash in template for e in trail))


def page_templates(
    pages: DataFrame, url: str = "url", html: str = "html", min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE, many_pages: int = MANY_PAGES,
) -> DataFrame:
    """(host, k1, k2, template: array<bigint>): per page, by the `row_keys` of its html, the hashes
    of those of its subtrees that belong to the template of its host.

    Pages with the same text count as one, so that copies of an article are no template. A
    subtree that recurs is none either if more than half of its pages would lose nearly all
    of their text, unless it stands on many pages and on more than half of the host's.
    """
    schema = "host string, k1 bigint, k2 bigint, whole bigint, size bigint, trees array<struct<tree: bigint, inner: boolean, own: bigint>>"
    trees_type = pa.list_(pa.struct([("tree", pa.int64()), ("inner", pa.bool_()), ("own", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [subtrees(body.as_py() or "") for body in batch.column(3)]
            trees = [[{"tree": t, "inner": m, "own": n} for (t, m), n in trees.items()] for _, _, trees in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3], pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()), pa.array(trees, trees_type),
                ],
                ["host", "k1", "k2", "whole", "size", "trees"],
            )

    keys = ["host", "k1", "k2"]
    body = F.col(html).cast("string")
    slim = pages.select(url_host(F.col(url)).alias("host"), *[k.alias(n) for k, n in zip(row_keys(body), keys[1:], strict=True)], body.alias("html")).where("host <> ''")
    found = store(one_per_key(slim.mapInArrow(run, schema), keys), "subtrees")
    different = found.groupBy("host").agg(F.countDistinct("whole").alias("pages"))
    trees = found.select(*keys, "whole", "size", F.explode("trees").alias("x")).select(*keys, "whole", "size", "x.*")
    counted = trees.groupBy("host", "tree").agg(F.countDistinct("whole").alias("n"), F.max("inner").alias("inner"))
    counted = counted.where(F.col("n") >= min_pages)
    enough = F.least(F.lit(float(many_pages)), min_share * F.col("pages"))
    enough = F.when(F.col("inner"), F.greatest(enough, INNER_SHARE * F.col("pages"))).otherwise(enough)
    recurring = store(counted.join(different, "host").where(F.col("n") >= enough).drop("inner"), "recurring")
    hits = store(trees.join(recurring, ["host", "tree"]), "hits")
    lost = hits.groupBy(*keys).agg((F.sum("own") > MOST_LOST * F.first("size")).alias("lost"))
    judged = hits.join(lost, keys).groupBy("host", "tree").agg(
        F.countDistinct(F.when(F.col("lost"), F.col("whole"))).alias("n_lost"), F.first("n").alias("n"), F.first("pages").alias("pages")
    )
    everywhere = (F.col("n") >= many_pages) & (2 * F.col("n") > F.col("pages"))
    template = judged.where((2 * F.col("n_lost") <= F.col("n")) | everywhere).select("host", "tree")
    own = hits.select(*keys, "tree").join(template, ["host", "tree"])
    return store(own.groupBy(*keys).agg(F.collect_list("tree").alias("template")), "templates")


def extract_text(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
    many_pages: int = MANY_PAGES,
) -> DataFrame:
    """(page_id, url, text) of every row: the main text of its html.

    Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and hidden
    parts go by tag, role and name, but nothing goes by role, name or as a form that holds a
    main element, the largest article or, on pages whose text is all in such boxes, most of it;
    comments, cookie notices, adverts, footers and logins go unless they hold a main element. Elements
    deeper than 512 are read as part of the one at that depth. Where main elements, or else the largest article,
    hold most of the text that is not in links, only that counts, elsewhere boxes of links go too. Element subtrees
    that recur over the pages of a host go too, whatever their name; see `page_templates`. Character references are decoded, white space in a block becomes one space, blocks
    are joined by an empty line. Null html and pages without text give an empty text; pages
    without a host have no template. Rows come out as often as they come in.
    """
    templates = page_templates(pages, url, html, min_pages, min_share, many_pages)
    slim = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")
    )
    k1, k2 = row_keys(F.col("html"))
    keyed = slim.withColumns({"on_host": url_host(F.col("url")), "on_k1": k1, "on_k2": k2})
    same = (F.col("on_host") == F.col("host")) & (F.col("on_k1") == F.col("k1")) & (F.col("on_k2") == F.col("k2"))
    joined = keyed.join(templates, same, "left").select("page_id", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(body.as_py() or "", frozenset(tree.as_py() or ()))
                for body, tree in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    return joined.mapInArrow(run, "page_id bigint, url string, text string")
