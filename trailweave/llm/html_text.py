"""Main text of web pages by wrappers that are inferred from pages of the same host.

A page becomes a tree of block elements and texts. The wrapper of a host is a union-free regular
expression over such trees: it starts as one page and is aligned with further pages of the host,
one after the other. Elements that stand in a row under the same name become a repeated group,
elements that one side lacks an optional one, texts that differ a slot; a text that stays the
same on every page is part of the template.

Extraction takes the wrapper's constants from all pages of the host: pages are aligned by the paths
of their elements, and a text that every page with its path has there is template, inside an article
as well as outside. The lists of tags and classes below hide what differs from page to page and
hosts with too few pages. infer() aligns pages part by part and writes the wrapper out.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import write_table

#: Pages, different ones, on which a text must be the same to be template.
MIN_TEMPLATE_PAGES = 3
#: Constants (8 bytes each) and hosts that are broadcast at most; beyond, pages and wrappers are shuffled by host.
MAX_BROADCAST_CONSTANTS, MAX_BROADCAST_HOSTS = 2_000_000, 100_000

# Names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
#: Start tags that end an open element of the named kinds.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"thead", "tbody", "tfoot"}, "tbody": {"thead", "tbody", "tfoot"},
    "tfoot": {"thead", "tbody", "tfoot"},
}
#: Elements that CLOSES and end tags do not look beyond.
WALLS = {"table", "ul", "ol", "dl", "select", "article", "section", "body", "main", "aside", "nav"}
HIDDEN = frozenset(
    "head title script style noscript template iframe object svg canvas math audio video button select option textarea "
    "input label dialog nav header footer aside form menu".split()
)
HIDDEN_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form toolbar".split())
#: Names (whole class tokens and ids) that mark what is not the article; as words of a class, only of texts that are constant.
HIDDEN_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices notification "
    "alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended comment "
    "comments disqus discussion reply replies respond widget toolbar skip form login search pagination pager".split()
)
ARTICLE = frozenset({"article", "main"})

#: Elements whose content is no markup; what they hold is left out.
RAW = frozenset("script style noscript template iframe textarea svg math title".split())
#: Elements of the article's own flow, which no class or id hides.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote table caption figcaption dl".split())
#: Words that begin names of boxes around comments, adverts and offers, as in comment-list or adsbygoogle.
BOXES = ("comment", "disqus", "newsletter", "related", "recommended", "advert", "adsby", "sponsor", "promo", "cookie", "breadcrumb")
#: Longer paths are folded to a hash.
LONG_PATH = 400

_NAME = re.compile(r"[a-zA-Z][^\s/><]*")
_ATTRIBUTES = re.compile(r"""(?:[^<>"']|"[^"]*"|'[^']*')*+""")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Element:
    """One element, or the root (tag ''); children are elements and texts (str)."""

    __slots__ = ("tag", "key", "hidden", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.children, self.key, self.hidden = tag, [], tag, tag in HIDDEN
        if attrs and "=" in attrs:
            names = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)}
            if "class" in names:
                self.key = f"{tag}.{names['class'].strip()}"
            if tag not in ("html", "body", "article", "main"):
                words = {w for k in ("class", "id") for w in html.unescape(names.get(k, "")).lower().split()}
                named = tag not in FLOW and (bool(words & HIDDEN_WORDS) or any(w.startswith(BOXES) for w in words))
                self.hidden |= named or names.get("role", "").lower() in HIDDEN_ROLES


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) from left to right; kinds are text, start and end.

    A tag ends at the first > outside of quotes. A < that no tag begins with, or whose tag meets
    another < before it ends, is text. The scanner only moves forward, so any page takes time in
    proportion to its length.
    """
    at, n = 0, len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            yield "text", page[at:], ""
            return
        if start > at:
            yield "text", page[at:start], ""
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        closing = page.startswith("/", start + 1)
        name = _NAME.match(page, start + 1 + closing)
        if name is None:
            end = page.find(">", start) if page[start + 1 : start + 2] in ("!", "?", "/") else -1
            if end < 0:
                yield "text", "<", ""
            at = start + 1 if end < 0 else end + 1
            continue
        end = _ATTRIBUTES.match(page, name.end()).end()
        if end < n and page[end] in "\"'":  # a quote that nothing closes
            end = min((k for k in (page.find(">", end), page.find("<", end)) if k >= 0), default=n)
        if end >= n or page[end] != ">":
            yield "text", "<", ""
            at = start + 1
            continue
        tag, at = name[0].lower(), end + 1
        if closing:
            yield "end", tag, ""
            continue
        yield "start", tag, page[name.end() : end]
        if tag in RAW:
            close = _RAW_END[tag].search(page, at)
            at = close.end() if close else n
            yield "end", tag, ""


class _Open:
    """The open elements, with counts of their names inside the innermost wall and altogether.

    What is looked for is known to be there before the stack is searched, and all that is searched
    is closed: the searches of a page take as many steps as it has elements.
    """

    def __init__(self, root: Element):
        self.stack, self.scopes, self.all = [root], [Counter()], Counter()

    def add(self, element: Element) -> None:
        self.stack.append(element)
        self.all[element.tag] += 1
        self.scopes[-1][element.tag] += 1
        if element.tag in WALLS:
            self.scopes.append(Counter())

    def close(self, names: Iterable[str], beyond: bool = False) -> None:
        """Close the innermost open element of the names, and what it holds; only `beyond` looks past walls."""
        names = [n for n in names if (self.all if beyond else self.scopes[-1])[n]]
        while names:
            gone = self.stack.pop()
            self.all[gone.tag] -= 1
            if gone.tag in WALLS:
                self.scopes.pop()
            self.scopes[-1][gone.tag] -= 1
            if gone.tag in names:
                return


def parse(page: str | None) -> Element:
    """The tree of a page; unclosed and stray tags are made up for, comments and scripts are left out."""
    root = Element("")
    here = _Open(root)
    for kind, tag, attrs in _tokens(page or ""):
        if kind == "text":
            here.stack[-1].children.append(html.unescape(tag) if "&" in tag else tag)
        elif kind == "end":
            if tag not in VOID:
                innermost = here.scopes[-1][tag]
                here.close([tag], beyond=not innermost and (tag in WALLS or tag in ("html", "form")))
        else:
            ends = CLOSES.get(tag) or ({"p"} if tag in BLOCK and tag != "br" else ())
            here.close(ends)
            element = Element(tag, attrs)
            here.stack[-1].children.append(element)
            if tag not in VOID:
                here.add(element)
    return root


def _below(path: str, key: str) -> str:
    """The path of an element below; a long one keeps its first part, whether a listed name is on it, and a hash."""
    path = f"{path}/{key}"
    if len(path) <= LONG_PATH:
        return path
    return f"{path.partition('/')[0]}/{xxhash.xxh64_hexdigest(path.encode('utf-8', 'surrogatepass'))}{'.comment' if _listed(path) else ''}"


def _blocks(element: Element, path: str = "") -> Iterator[tuple[str, str]]:
    """(path, text) of the shown blocks below `element` in page order, white space made single."""
    run: list[str] = []

    def flush(path: str) -> Iterator[tuple[str, str]]:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            yield path, text

    # children left to visit, path, whether a block ends with them
    stack = [(iter(element.children), path, True)]
    while stack:
        children, path, block = stack[-1]
        for child in children:
            if isinstance(child, str):
                run.append(child)
            elif child.hidden:
                if child.tag in BLOCK or child.key != child.tag:
                    yield from flush(path)
            elif child.tag in BLOCK:
                yield from flush(path)
                stack.append((iter(child.children), _below(path, child.key), True))
                break
            else:
                stack.append((iter(child.children), path, False))
                break
        else:
            stack.pop()
            if block:
                yield from flush(path)


class Part:
    """A piece of a wrapper: an element or, with an empty name, a text; constant is None for a slot."""

    __slots__ = ("name", "parts", "constant", "pages", "optional", "repeated")

    def __init__(self, name: str, constant: str | None = None, parts: list[Part] | None = None):
        self.name, self.constant, self.parts = name, constant, parts or []
        self.pages, self.optional, self.repeated = 1, False, False

    def expression(self) -> str:
        """As a regular expression over tags, # standing for a slot."""
        inner = "".join(p.expression() for p in self.parts)
        own = f"<{self.name}>{inner}</{self.name.split('.')[0]}>" if self.name else (self.constant or "#")
        sign = "*" if self.repeated and self.optional else "+" if self.repeated else "?" if self.optional else ""
        return f"({own}){sign}" if sign else own


def _parts(element: Element) -> list[Part]:
    """The block structure of a page; inline elements are part of the text."""
    found: list[Part] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            found.append(Part("", text))

    def walk(node: Element) -> None:
        for child in node.children:
            if isinstance(child, str):
                run.append(child)
            elif child.tag in BLOCK:
                flush()
                if child.tag != "br":
                    found.append(Part(child.key, parts=_parts(child)))
            else:
                walk(child)

    walk(element)
    flush()
    return _repeats(found)


def _repeats(parts: list[Part]) -> list[Part]:
    """Parts of one name in a row, as one repeated group."""
    out: list[Part] = []
    for part in parts:
        if out and out[-1].name == part.name:
            out[-1] = _aligned(out[-1], part, same_page=True)
            out[-1].repeated = True
        else:
            out.append(part)
    return out


def _aligned(a: Part, b: Part, same_page: bool = False) -> Part:
    both = Part(a.name, a.constant if a.constant == b.constant else None, _aligned_rows(a.parts, b.parts, same_page))
    both.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    both.optional, both.repeated = a.optional or b.optional, a.repeated or b.repeated
    return both


def _aligned_rows(a: list[Part], b: list[Part], same_page: bool = False) -> list[Part]:
    out: list[Part] = []
    matched = SequenceMatcher(None, [p.name for p in a], [p.name for p in b], autojunk=False)
    for kind, a1, a2, b1, b2 in matched.get_opcodes():
        if kind == "equal":
            out += [_aligned(x, y, same_page) for x, y in zip(a[a1:a2], b[b1:b2])]
            continue
        for part in [*a[a1:a2], *b[b1:b2]]:  # only one side has it
            part.optional = True
            out.append(part)
    return _repeats(out)


def infer(pages: list[str]) -> Part:
    """The wrapper of pages of one host."""
    wrapper = Part("page", parts=_parts(parse(pages[0])))
    for page in pages[1:]:
        wrapper = _aligned(wrapper, Part("page", parts=_parts(parse(page))))
    return wrapper


def _articles(node: Element, hidden: bool = False) -> Iterator[Element]:
    """Outermost articles, or the outermost main element; with `hidden` those in hidden elements, too."""
    stack = [iter(node.children)]
    while stack:
        for child in stack[-1]:
            if isinstance(child, Element) and (hidden or not child.hidden):
                if child.tag in ARTICLE:
                    yield child
                else:
                    stack.append(iter(child.children))
                    break
        else:
            stack.pop()


def _regions(root: Element) -> list[Element]:
    """The articles of a page, those in a main element before the element itself; none: no regions.

    Articles in hidden elements count if there are no others: comments and teasers are articles, too.
    """
    regions: list[Element] = []
    for region in list(_articles(root)) or list(_articles(root, hidden=True)):
        inner = list(_articles(region)) if region.tag == "main" else []
        if region.tag == "main" and not inner and not any(_blocks(region)):
            inner = list(_articles(region, hidden=True))
        regions += inner or [region]
    return regions


def _open_forms(root: Element) -> None:
    """Shows forms around a whole page, those with its main heading or article."""
    stack, forms = [(root, iter(root.children))], []
    while stack:
        node, children = stack[-1]
        child = next((c for c in children if isinstance(c, Element)), None)
        if child is None:
            stack.pop()
            if forms and forms[-1] is node:
                forms.pop()
            continue
        if child.tag == "h1" or child.tag in ARTICLE:
            for form in forms:
                form.hidden = False
            forms = []
        if child.tag == "form":
            forms.append(child)
        stack.append((child, iter(child.children)))


def _listed(path: str) -> bool:
    """Has a class on the path a word that marks what is not the article?"""
    return any(w.lower() in HIDDEN_WORDS for key in path.split("/") for w in _NAME_WORDS.findall(key.partition(".")[2]))


def blocks_of(page: str | None) -> list[tuple[str, str]]:
    """(path, text) of a page's blocks in page order: those of its articles, of the whole page if it has none.

    Paths begin at the article, or at the root with a slash.
    """
    root = parse(page)
    _open_forms(root)
    regions = _regions(root)
    return [b for r in regions for b in _blocks(r, r.tag)] if regions else list(_blocks(root))


def number(*values: str) -> int:
    """64 bits, signed."""
    return xxhash.xxh64_intdigest("\0".join(values).encode("utf-8", "surrogatepass")) - (1 << 63)


def extract(page: str | None, template: Iterable[int] = ()) -> str:
    """The text that is not template, in page order, joined by a space; `template` as of wrappers()."""
    known = set(template)
    return " ".join(text for path, text in blocks_of(page) if not known or number(path, text) not in known)


def host_of(url: Column) -> Column:
    """Lower-cased host of a URL; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, template): the constants of each host's wrapper, as number() of path and text.

    All pages of a host are read; pages with the same texts count once, as only pages that differ
    elsewhere tell what is constant. Pages without a host have no template: they may be of any. A
    text is a constant if each page that has its path has the text there, and MIN_TEMPLATE_PAGES
    pages at least; any other text fills a slot. On pages without an article, which have paths in
    common more often, it also is one if this holds among the pages of the same paths. Where constants are
    more than half of the text inside a host's articles, these are versions of one article: none
    of its text is template but what stands under a listed name.
    """

    @F.pandas_udf("page long, texts array<struct<kind: long, path: long, pair: long, inside: int>>")
    def found(pages: pd.Series) -> pd.DataFrame:
        def of(page: str) -> tuple[int, list[dict]]:
            blocks = blocks_of(page)
            rows, paths = [], {}
            for path, text in set(blocks):
                inside = 0 if path.startswith("/") or not path or _listed(path) else len(text)
                paths[path] = paths.get(path, 0) + inside
                rows.append({"kind": 0, "path": number(path), "pair": number(path, text), "inside": inside})
            # a null pair stands for the path itself
            rows += [{"kind": 0, "path": number(p), "pair": None, "inside": n} for p, n in paths.items()]
            if any(p.startswith("/") or not p for p in paths):
                kind = number(*sorted(paths))
                rows += [row | {"kind": kind} for row in rows]
            return number(*(v for b in blocks for v in b)), rows

        return pd.DataFrame([of(p) for p in pages], columns=["page", "texts"])

    own = pages.where(F.length("html") > 0).select(host_of(F.col("url")).alias("host"), "html").where("host <> ''")
    own = own.select("host", found("html").alias("found")).select("host", "found.*").dropDuplicates(["host", "page"])
    # counted within each task before the rows of a host meet
    counts = own.select("host", F.inline("texts")).groupBy("host", "kind", "path", "pair").agg(
        F.count("*").alias("pages"), F.sum("inside").alias("inside")
    )
    often = write_table(counts.where(F.col("pair").isNull() | (F.col("pages") >= MIN_TEMPLATE_PAGES)), "texts")
    paths = often.where("pair IS NULL").select("host", "kind", "path", "pages")
    constants = often.where("pair IS NOT NULL").join(paths, ["host", "kind", "path", "pages"])
    whole = often.where("pair IS NULL").groupBy("host").agg(F.sum("inside").alias("whole"))
    by_host = constants.groupBy("host").agg(
        F.sum("inside").alias("constant"),
        F.collect_set("pair").alias("template"),
        F.collect_set(F.when(F.col("inside") == 0, F.col("pair"))).alias("outside"),
    )
    template = F.when(2 * F.col("constant") <= F.col("whole"), F.col("template")).otherwise(F.col("outside"))
    return by_host.join(whole, "host").select("host", template.alias("template"))


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (empty if there is none), n_chars.

    Null html is empty; a page whose url is null or has no host has no template. Repeated rows
    are repeated in the result. Other columns of `pages` are not read. Empty table: no rows.
    """
    known = write_table(wrappers(pages), "wrappers")
    own = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))

    @F.pandas_udf("string")
    def text(pages: pd.Series, templates: pd.Series) -> pd.Series:
        return pd.Series([extract(p, () if t is None else t) for p, t in zip(pages, templates)], dtype=object)

    hosts, constants = known.agg(F.count("*"), F.coalesce(F.sum(F.size("template")), F.lit(0))).first()
    small = hosts <= MAX_BROADCAST_HOSTS and constants <= MAX_BROADCAST_CONSTANTS
    joined = own.join(F.broadcast(known) if small else known, "host", "left")
    out = joined.select("page_id", "url", text("html", "template").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
