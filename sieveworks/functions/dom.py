"""HTML as a tolerant tree, on the standard library's tokenizer, and the operators on it as Arrow-batched UDFs.

Recovery: void elements have no content; p, li, tr, td, option and dt/dd end where their like begins; an end tag closes up to
its match, and is ignored without one. What is removed takes its descendants with it.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import functions as F, types as T

# Fixed values.
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"})
UNWANTED = frozenset({
    "script", "style", "noscript", "iframe", "svg", "canvas", "video", "audio", "source", "track", "map", "area",
    "form", "input", "button", "select", "textarea", "option", "nav", "footer", "header", "aside",
})
#: Class of the box that holds place, reference and date of the newer layout.
INFO_BOX = "jobinfo"
HIDING_STYLES = ("display:none", "visibility:hidden", "opacity:0", "height:0", "width:0")
HIDING_CLASSES = ("hidden", "hide", "invisible", "d-none")
NOISE_CLASSES = (
    "hidden", "hide", "invisible", "offscreen", "sr-only", "screen-reader", "tracking", "analytics", "cookie", "consent", "popup", "modal",
    "advertisement", "ads", "sponsor", "promo", "banner", "social", "share", "sharing", "tweet", "facebook", "linkedin", "comment", "comments",
    "feedback", "sidebar", "related", "suggested", "recommended", "newsletter", "subscribe", "signup", "sign-up", "tooltip", "popover", "dropdown",
)
CARDS = ("job-card", "job-item", "job-listing", "position-card", "vacancy")
LINKS = re.compile(r"JobDetail|FolderDetail|/job/|/position/|/careers/Apply/", re.I)
_CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def walk(self):
        for k in self.kids:
            if isinstance(k, Node):
                yield k
                yield from k.walk()

    def strings(self):
        for k in self.kids:
            if isinstance(k, Node):
                yield from k.strings()
            else:
                yield k

    def text(self, sep: str = "", strip: bool = False) -> str:
        parts = [s.strip() for s in self.strings()] if strip else list(self.strings())
        return sep.join(p for p in parts if p) if strip else sep.join(parts)

    def markup(self) -> str:
        body = "".join(k.markup() if isinstance(k, Node) else k.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;") for k in self.kids)
        if self.tag == "#root":
            return body
        attrs = "".join(f' {k}="{(v or "").replace(chr(34), "&quot;")}"' for k, v in self.attrs.items())
        return f"<{self.tag}{attrs}/>" if self.tag in VOID else f"<{self.tag}{attrs}>{body}</{self.tag}>"


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        closes = _CLOSES.get(tag)
        if closes and self.stack[-1].tag in closes:
            self.stack.pop()
        node = Node(tag, dict(attrs))
        self.stack[-1].kids.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.stack[-1].kids.append(Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].kids.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def _drop(node: Node, bad) -> None:
    node.kids = [k for k in node.kids if not (isinstance(k, Node) and bad(k))]
    for k in node.kids:
        if isinstance(k, Node):
            _drop(k, bad)


def _class(n: Node) -> str:
    return (n.attrs.get("class") or "").lower()


def unwanted(n: Node) -> bool:
    return n.tag in UNWANTED


def hidden(n: Node) -> bool:
    style = re.sub(r"\s", "", (n.attrs.get("style") or "").lower())
    return any(s in style for s in HIDING_STYLES) or any(c in _class(n) for c in HIDING_CLASSES)


def noisy(n: Node) -> bool:
    c = _class(n)
    return bool(c) and any(p in c for p in NOISE_CLASSES)


def drop_empty(root: Node, passes: int = 3) -> None:
    for _ in range(passes):
        _drop(root, lambda n: n.tag not in VOID and not any(isinstance(k, Node) for k in n.kids) and not n.text(strip=True))


def _cleaned(root: Node, empties: bool) -> Node:
    _drop(root, lambda n: unwanted(n) or hidden(n) or noisy(n))
    if empties:
        drop_empty(root)
    return root


def cleaned(html: str, empties: bool = True) -> tuple[str, str]:
    """(text with a line per piece, markup) without unwanted, hidden, noisy and empty elements."""
    root = _cleaned(parse(html), empties)
    return root.text("\n", strip=True), root.markup()


def _copy(n: Node) -> Node:
    out = Node(n.tag, n.attrs)
    out.kids = [_copy(k) if isinstance(k, Node) else k for k in n.kids]
    return out


def _udf(kind: T.DataType, empty):
    """A pandas UDF over single values; NULL and '' give ``empty``, and so does a page that can't be read."""

    def wrap(fn):
        def batch(s: pd.Series) -> pd.Series:
            out = []
            for v in s:
                try:
                    out.append(fn(v) if isinstance(v, str) and v else empty)
                except (ValueError, AssertionError, RecursionError):
                    out.append(empty)
            return pd.Series(out, dtype=object)

        batch.__annotations__ = {"s": pd.Series, "return": pd.Series}
        return F.pandas_udf(batch, kind)

    return wrap


@F.pandas_udf(T.StructType([T.StructField(f, T.StringType()) for f in ("text", "html", "error")]))
def html_parts(s: pd.Series) -> pd.DataFrame:
    """(text, html, error) of each page in one pass of the tree; a page that can't be read has its error and no text."""
    rows = []
    for v in s:
        try:
            text, markup = cleaned(v) if isinstance(v, str) and v else ("", "")
            rows.append((text, re.sub(r">\s+<", "><", re.sub(r"\s+", " ", markup)).strip(), None))
        except (ValueError, AssertionError, RecursionError) as e:
            rows.append((None, None, type(e).__name__))
    return pd.DataFrame(rows, columns=["text", "html", "error"])


html_text = _udf(T.StringType(), "")(lambda v: cleaned(v)[0])
description_text = _udf(T.StringType(), "")(lambda v: cleaned(v, empties=False)[0])
html_markup = _udf(T.StringType(), "")(lambda v: re.sub(r">\s+<", "><", re.sub(r"\s+", " ", cleaned(v)[1])).strip())


def _plain(v: str) -> str:
    root = parse(v)
    _drop(root, lambda n: n.tag in ("script", "style"))
    return re.sub(r"\s+", " ", root.text(" ", strip=True)).strip()


text_only = _udf(T.StringType(), "")(_plain)


def _by(root: Node, tag: str, cls: tuple[str, ...]) -> str | None:
    for n in root.walk():
        if (not tag or n.tag == tag) and all(c in _class(n) for c in cls):
            t = n.text(" ", strip=True)
            if len(t) > 2:
                return t
    return None


# Selectors in order, as (tag or '', parts of the class).
TITLES = (("h2", ("banner__text__title",)), ("h2", ("banner", "title")), ("h1", ("title",)), ("h2", ("title",)), ("h3", ("title",)), ("h1", ()), ("h2", ()))
PLACES = (("div", ("article__content__view__field__value",)), ("div", ("field__value", "location")))
BODIES = (("article", ("article--details",)), ("div", ("article__content",)), ("div", ("main__content",)), ("div", ("section__content",)), ("article", ()))
STOCK_TITLES = ("careers", "jobs")


def _meta(root: Node, *names: str) -> str | None:
    for name in names:
        for n in root.walk():
            if n.tag == "meta" and name in (n.attrs.get("property"), n.attrs.get("name")) and (n.attrs.get("content") or "").strip():
                return n.attrs["content"].strip()
    return None


def raw_fields(html: str) -> dict:
    """Pieces of a page by selectors and meta tags, and its JSON-LD scripts."""
    root = parse(html)
    pick = lambda table: next((t for tag, cls in table if (t := _by(root, tag, cls))), None)
    title = pick(TITLES)
    if not title:
        m = _meta(root, "og:title", "title", "twitter:title")
        title = m if m and m.lower() not in STOCK_TITLES else None
    if not title:
        t = next((n.text().strip() for n in root.walk() if n.tag == "title"), "")
        title = (t.split(" - ")[0] if " - " in t else t.split(" | ")[0]).strip() or None
    desc = None
    for tag, cls in (*BODIES, ("main", ()), ("body", ())):
        for n in root.walk():
            if n.tag == tag and all(c in _class(n) for c in cls):
                part = Node("#root", {})
                part.kids = [_copy(n)]
                d = _cleaned(part, False).text("\n", strip=True)
                if len(d) > 100:
                    desc = d
                break
        if desc:
            break
    scripts = [n.text() for n in root.walk() if n.tag == "script" and (n.attrs.get("type") or "").lower() == "application/ld+json"]
    dept = next((t for c in ("department", "category", "team", "function") if (t := _by(root, "", (c,)))), None)
    date = next((t for tag, cls in (("", ("date",)), ("", ("posted",)), ("time", ())) if (t := _by(root, tag, cls))), None)
    info = next((n.text() for n in root.walk() if n.tag == "div" and INFO_BOX in _class(n).split()), None)
    return {"title": title, "description": desc or "", "info": info, "location": pick(PLACES), "department": dept, "date_text": date, "text": root.text(), "json_ld": scripts}


_S = T.StringType()
FIELDS_TYPE = T.StructType([*[T.StructField(f, _S) for f in ("title", "description", "info", "location", "department", "date_text", "text")], T.StructField("json_ld", T.ArrayType(_S))])
CARD_TYPE = T.ArrayType(T.StructType([T.StructField(f, _S) for f in ("title", "application_url", "location", "department")]))
FACETS_TYPE = T.MapType(_S, T.ArrayType(T.StructType([T.StructField("value", _S), T.StructField("text", _S)])))


@F.pandas_udf(FIELDS_TYPE)
def page_fields(s: pd.Series) -> pd.DataFrame:
    """One pass of the tree per page; all later inference is native."""
    empty = {"title": None, "description": "", "info": None, "location": None, "department": None, "date_text": None, "text": "", "json_ld": []}
    rows = []
    for v in s:
        try:
            rows.append(raw_fields(v) if isinstance(v, str) and v else empty)
        except (ValueError, AssertionError, RecursionError):
            rows.append(empty)
    return pd.DataFrame(rows, columns=list(empty))


def listing(html: str, base: str) -> list[dict]:
    """Openings of a listing page: cards by the first selector that hits, else links that look like details."""
    root = parse(html)
    nodes = list(root.walk())
    out: list[dict] = []
    tests = [lambda n, c=c: c in _class(n) for c in CARDS] + [lambda n: n.tag == "article" and "job" in _class(n)] + [lambda n, c=c: c in _class(n).split() for c in ("job-result", "search-result")]
    for test in tests:
        cards = [n for n in nodes if test(n)]
        if not cards:
            continue
        for card in cards:
            inner = list(card.walk())
            link = next((n for n in inner if n.tag == "a" and n.attrs.get("href") is not None), None)
            if link is None:
                continue
            head = next((n for n in inner if n.tag in ("h1", "h2", "h3", "h4")), link)
            loc = next((n.text(strip=True) for n in inner if "location" in _class(n)), None)
            dept = next((n.text(strip=True) for n in inner if any(t in _class(n) for t in ("department", "category", "team"))), None)
            out.append({"title": head.text(strip=True), "application_url": urljoin(base, link.attrs["href"] or ""), "location": loc, "department": dept})
        break
    if not out:
        for n in nodes:
            href = n.attrs.get("href") or ""
            if n.tag == "a" and href and LINKS.search(href) and len(t := n.text(strip=True)) > 3:
                out.append({"title": t, "application_url": urljoin(base, href), "location": None, "department": None})
    return out


@F.pandas_udf(CARD_TYPE)
def listing_jobs(html: pd.Series, base: pd.Series) -> pd.Series:
    out = []
    for h, b in zip(html, base):
        try:
            out.append(listing(h, b or "") if isinstance(h, str) and h else [])
        except (ValueError, AssertionError, RecursionError):
            out.append([])
    return pd.Series(out, dtype=object)


def facets(html: str) -> dict[str, list[dict]]:
    """Select boxes and facet containers of a page: name -> options."""
    root = parse(html)
    out: dict[str, list[dict]] = {}
    for n in root.walk():
        if n.tag == "select":
            name = n.attrs.get("name") or n.attrs.get("id")
            if name:
                out[name] = [{"value": o.attrs.get("value"), "text": o.text(strip=True)} for o in n.walk() if o.tag == "option"]
        elif "facet" in _class(n) or "filter" in _class(n):
            name = n.attrs.get("data-facet") or n.attrs.get("data-filter") or n.attrs.get("id")
            boxes = [{"value": i.attrs.get("value"), "text": i.attrs.get("value") or ""} for i in n.walk() if i.tag == "input" and i.attrs.get("value")]
            if name and boxes:
                out.setdefault(name, boxes)
    return out


page_facets = _udf(FACETS_TYPE, {})(facets)
