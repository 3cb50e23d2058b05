"""Page furniture around the main body, by consensus of each host's pages.

1. Every page is cut into containers, named by their generalised tag-class path. Each container's own text is scored (text in
   sentences or long lines, links, lines), and the page votes for the path that holds most of its prose.
2. The votes and counts are summed per host and path. A path within the host's winning path is furniture only if its text is
   mostly links; any path outside is furniture.
3. The pages are read again with the winning paths: a line is furniture if all its visible text is.

Plain-text captures have no containers. Their lines are read by the page's own markup where the row has it, and by the lines
that the pages of their host show in furniture paths: on at least ``HOST_SHARE`` of the host's pages and ``HOST_PAGES`` pages,
more often as furniture than in a body. Lines are known by a 64-bit hash of their letters, however long. What a trail or a
notice begins with (its frame: "Home >", "(c) 2024") is counted like a line, so that lines that no page repeats are known by it.
Besides, lines on at least ``LINE_SHARE`` of all pages count for every host: a short list that helps hosts with few pages.
A host's own list serves its rows only; if all of these are too many to be broadcast, they meet the rows by host.

Defined results
---------------
* NULL, blank and markup-only lines are no cases; a fragment without page structure is all body;
* a page whose host has no winning path on it is judged by its own votes; ties go to the shorter path, then by name;
* repeated rows get a result each; texts are read whole, however long; an empty table gives no rows.
"""

from __future__ import annotations

import html as _html
import re
from collections import ChainMap
from collections.abc import Callable, Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..runtime import BROADCAST_ROWS, broadcast_if_small, materialise

LINE_SHARE, LINE_PAGES = 0.0002, 3
HOST_SHARE, HOST_PAGES = 0.001, 2
#: Parts of a host's rows where lists meet them by host.
SALTS = 32
LINKED = 0.3

_TAG = re.compile(r"<!--.*?-->|<!\[CDATA\[.*?\]\]>|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<![^>]*>|<\?[^>]*>", re.S)
_ATTR = re.compile(r"(class|id|role|valign|align|width|colspan|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# Elements whose text isn't shown, elements without an end tag, and containers.
HIDDEN = frozenset({"script", "style", "noscript", "template", "head", "svg", "iframe", "object", "select", "textarea"})
CONTAINERS = frozenset("html body div nav main article section aside footer header table tbody thead tfoot tr td th ul ol dl form fieldset figure details dialog center".split())
_PAGE = re.compile(r"<\s*(?:!doctype|html|body|main|nav|footer|aside|article)\b", re.I)
_ITEMS = re.compile(r"\s+[|·/>›»•]\s+|\s{2,}|\t+")
_END = (".", "!", "?", "…", ":", ";")


#: What a trail begins with, up to its divider; what a notice begins with, up to its year.
_TRAIL = re.compile(r"([^>›»]{1,60}?)\s*([>›»])(?:\s|$)")
_NOTICE = re.compile(r"(\(c\)|[^\w\s])\s*\d{4}\b", re.I)
#: Signs of list items: posting texts use them in plain text, pages don't.
BULLETS = ("-", "•", "*", "–", "·")


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


_NO_LETTERS = bytes(i for i in range(128) if not chr(i).isalpha())
#: Bytes of a listed line's beginning by which the search for phrases passes over most words.
START = 6


def letters(text: str) -> bytes:
    """A line's letters, case aside, as UTF-8."""
    if text.isascii():
        return text.encode().translate(None, _NO_LETTERS).lower()
    return "".join(filter(str.isalpha, text)).lower().encode("utf-8", "surrogatepass")


def key(text: str) -> int:
    """Hash of a line's letters, case aside; 0 for a line without any."""
    k = letters(text)
    return _signed(xxhash.xxh64_intdigest(k)) if k else 0


def frame(text: str) -> int:
    """Hash of a line's frame; 0 for a line without one."""
    m = _TRAIL.match(text) if ">" in text or "›" in text or "»" in text else None
    if m is None:
        m = _NOTICE.match(text) if text[:1] not in BULLETS else None
        return _signed(xxhash.xxh64_intdigest(b"\1" + m[1].lower().encode())) if m else 0
    k = letters(m[1])
    return _signed(xxhash.xxh64_intdigest(b"\2" + k)) if k else 0


def _step(tag: str, attrs: str) -> str:
    """One step of a generalised path: tag, class and id with digits as 0, and the names of layout attributes."""
    if not attrs:
        return tag
    out = tag
    for m in _ATTR.finditer(attrs):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name == "class":
            out += "".join("." + c for c in sorted(value.lower().split()))
        elif name == "id":
            out += "#" + re.sub(r"\d{2,}", "0", value.lower())
        elif name == "role":
            out += "@" + value.lower()
        else:
            out += "~" + name
    return out


def pieces(page: str) -> list[tuple[int, str, str, bool]]:
    """Visible text of a page as (line number from 1, container path, text, inside a link or button) in order."""
    out: list[tuple[int, str, str, bool]] = []
    stack: list[tuple[str, str]] = []
    path, link, line, at, hidden = "", 0, 1, 0, ""
    steps: dict[tuple[str, str], str] = {}
    for m in _TAG.finditer(page):
        start = m.start()
        if start > at:
            text = page[at:start]
            if not hidden and not text.isspace():
                for k, part in enumerate(text.split("\n")):
                    if part and not part.isspace():
                        part = _html.unescape(part) if "&" in part else part
                        if part.strip():
                            out.append((line + k, path, part.strip(), link > 0))
            line += text.count("\n")
        whole = m.group()
        at = m.end()
        tag = (m[2] or "").lower()
        if tag:
            if hidden:
                if m[1] and tag == hidden:
                    hidden = ""
            elif m[1]:
                if tag in CONTAINERS:
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] == tag:
                            path = stack[i][1]
                            del stack[i:]
                            link = 0
                            break
                elif tag in ("a", "button"):
                    link = max(0, link - 1)
            elif tag in HIDDEN:
                if not whole.endswith("/>"):
                    hidden = tag
            elif tag in CONTAINERS:
                got = steps.get((tag, m[3]))
                if got is None:
                    got = steps[tag, m[3]] = _step(tag, m[3])
                stack.append((tag, path))
                if got != "div":  # a bare div divides lines, not parts of the page
                    path = f"{path}>{got}" if path else got
                link = 0
            elif tag == "button" or tag == "a" and "href" in m[3].lower():
                link = 1
        line += whole.count("\n")
    text = page[at:]
    if not hidden:
        for k, part in enumerate(text.split("\n")):
            part = _html.unescape(part).strip()
            if part and "<" not in part[:1]:
                out.append((line + k, path, part, link > 0))
    return out


def is_page(page: str) -> bool:
    return _PAGE.search(page) is not None


def _prose(text: str) -> int:
    """Characters of a piece that read as prose."""
    n = len(text)
    return n if n > 40 and (text.endswith(_END) or text.count(" ") >= 6) else 0


def container_stats(parts: list[tuple[int, str, str, bool]]) -> dict[str, list[int]]:
    """Path -> [pages, prose, characters, characters in links, pieces], by the text that isn't in an inner container."""
    out: dict[str, list[int]] = {}
    for _, path, text, link in parts:
        s = out.setdefault(path, [1, 0, 0, 0, 0])
        n = len(text)
        s[2] += n
        s[4] += 1
        if link:
            s[3] += n
        else:
            s[1] += _prose(text)
    return out


def _winner(score: dict[str, int]) -> str:
    return min(score, key=lambda p: (-score[p], len(p), p)) if score else ""


def judge(stats: dict[str, list[int]], winner: str) -> dict[str, bool]:
    """Path -> whether it is furniture, given the winning path."""
    out = {}
    for path, (_, prose, chars, linked, _n) in stats.items():
        inside = path == winner or path.startswith(winner + ">")
        out[path] = path != winner and (not inside or linked > LINKED * max(chars, 1))
    return out


def _host(url: str | None) -> str:
    m = re.match(r"[a-z][a-z0-9+.-]*://([^/?#]*)", url.strip().lower()) if isinstance(url, str) else None
    return m[1] if m else ""


def survey(df: DataFrame, html: str, url: str) -> DataFrame:
    """(kind, host, name, code, n0..n4) over all pages: kind 0 containers by host and path, kind 1 lines and frames by host and code.

    Lines: n0 pages that show the line as furniture, n1 in the body, n2 as first line of a container of links, n3 the first
    ``START`` bytes of its letters as a number, n4 its length.
    Sums are made in the task and again by the shuffle's map side.
    """

    def scan(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paths: dict[tuple[str, str], list[int]] = {}
        lines: dict[tuple[str, int], list[int]] = {}

        def flush() -> pd.DataFrame:
            rows = [(0, h, p, 0, *s) for (h, p), s in paths.items()] + [(1, h, None, k, *s) for (h, k), s in lines.items()]
            paths.clear()
            lines.clear()
            return pd.DataFrame(rows, columns=["kind", "host", "name", "code", "n0", "n1", "n2", "n3", "n4"])

        for pdf in it:
            for page, where in zip(pdf["page"], pdf["url"]):
                if not isinstance(page, str) or not is_page(page):
                    continue
                parts = pieces(page)
                stats = container_stats(parts)
                win = _winner({p: s[1] for p, s in stats.items() if s[1]})
                if not win:
                    continue
                h = _host(where)
                for p, s in stats.items():
                    t = paths.setdefault((h, p), [0, 0, 0, 0, 0])
                    for i in range(5):
                        t[i] += s[i] if i != 1 else (1 if p == win else 0)  # one vote a page
                fur = judge(stats, win)
                first: set[str] = set()
                seen: set[tuple[int, bool]] = set()
                before = ""
                for _, p, text, _link in parts:
                    f = fur[p]
                    head = f and p not in first and stats[p][3] > 0
                    first.add(p)
                    k = key(text)
                    # a trail may be cut by its links: its first part, then the divider
                    g = frame(f"{before} {text[0]} " if text[0] in ">›»" and before else text)
                    before = text if k else before
                    for code in (k, g):
                        if code and (code, f) not in seen:
                            seen.add((code, f))
                            t = lines.get((h, code))
                            if t is None:
                                t = lines[h, code] = [0, 0, 0, int.from_bytes(letters(text)[:START]) if code == k else 0, len(text)]
                            t[0 if f else 1] += 1
                            t[2] += head and code == k
                if len(lines) + len(paths) > 200_000:
                    yield flush()
        yield flush()

    sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(3)]
    sums += [F.when(F.col("kind") == 0, F.sum("n3")).otherwise(F.max("n3")).alias("n3"), F.max("n4").alias("n4")]
    got = df.select(F.col(html).alias("page"), F.col(url).alias("url")).filter(F.col("page").isNotNull()).mapInPandas(
        scan, "kind int, host string, name string, code long, n0 long, n1 long, n2 long, n3 long, n4 long"
    )
    return got.groupBy("kind", "host", "name", "code").agg(*sums)


def host_rules(sums: DataFrame) -> DataFrame:
    """(host, winner, furniture): the winning path of each host and its furniture paths.

    A path that is on fewer than a thousandth of the host's pages isn't listed, so a host's list is bounded; a page judges such
    a path by its place within or outside the winning path.
    """
    paths = sums.filter("kind = 0")
    top = paths.groupBy("host").agg(F.max(F.struct("n1", (-F.length("name")).alias("l"), "name")).alias("x"), F.max("n0").alias("most")).select(F.col("host").alias("h"), F.col("x.name").alias("winner"), "most")
    seen = paths.join(top, F.col("host") == F.col("h")).filter(F.col("n0") * 1000 >= F.col("most"))
    inside = (F.col("name") == F.col("winner")) | F.startswith(F.col("name"), F.concat("winner", F.lit(">")))
    # a step with a class, id or attribute means the same wherever it stands on a host: its places are counted together
    last = F.element_at(F.split("name", ">"), -1)
    step = F.when(last.rlike("[.#@~]"), last).otherwise(F.col("name"))
    seen = seen.select("host", "winner", "name", inside.alias("inside"), step.alias("step"), "n0", "n2", "n3")
    steps = seen.groupBy(F.col("host").alias("h2"), F.col("step").alias("s2")).agg(
        F.sum("n2").alias("chars"), F.sum("n3").alias("linked"), F.sum(F.when(~F.col("inside"), F.col("n0")).otherwise(0)).alias("out"), F.sum("n0").alias("all")
    )
    seen = seen.join(steps, (F.col("host") == F.col("h2")) & (F.col("step") == F.col("s2")))
    bad = (F.col("name") != F.col("winner")) & (~F.col("inside") | (F.col("linked") > LINKED * F.col("chars")) | (F.col("out") > 0.3 * F.col("all")))
    return seen.groupBy("host", "winner").agg(F.collect_list(F.when(bad, F.col("name"))).alias("furniture"), F.collect_list(F.when(~bad, F.col("name"))).alias("body"))


_FURNITURE = "n0 > 4 * n1"


def _often(sums: DataFrame) -> DataFrame:
    lines = sums.filter("kind = 1").groupBy("code").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "n2")], *[F.max(c).alias(c) for c in ("n3", "n4")])
    pages = sums.filter("kind = 0").agg(F.coalesce(F.sum("n1"), F.lit(0))).first()[0]
    return lines.filter((F.col("n0") >= max(LINE_PAGES, int(LINE_SHARE * pages))) & F.expr(_FURNITURE))


#: What a list holds of a line: its code, whether it heads a list of links, its beginning and its length.
LISTED = ["code", "n2 * 2 > n0 AS head", "n3 AS start", "n4 AS size"]


class Lines:
    """A list of furniture lines."""

    def __init__(self):
        self.heads: dict[int, bool] = {}
        self.starts: set[int] = set()
        self.longest = 0

    def add(self, code: int, head: bool, start: int, size: int) -> None:
        self.heads[code] = head
        self.starts.add(start)
        self.longest = max(self.longest, size)


def furniture_lines(sums: DataFrame) -> Lines:
    """The lines that all pages show as furniture: at most (lines a page) / LINE_SHARE, whatever the number of pages."""
    out = Lines()
    for r in _often(sums).selectExpr(*LISTED).toArrow().to_pylist():
        out.add(**r)
    return out


def host_lines(sums: DataFrame) -> DataFrame:
    """(host, code, head, start, size): the lines that a host's pages show as furniture, besides those of all hosts."""
    pages = sums.filter("kind = 0").groupBy(F.col("host").alias("h")).agg(F.sum("n1").alias("pages"))
    lines = sums.filter("kind = 1").filter((F.col("n0") >= HOST_PAGES) & F.expr(_FURNITURE)).join(_often(sums).select("code"), "code", "left_anti")
    lines = lines.join(pages, F.col("host") == F.col("h")).filter(F.col("n0") >= F.floor(HOST_SHARE * F.col("pages")))
    return lines.selectExpr("host", *LISTED)


class Reader:
    """Classifies the lines of captures."""

    def __init__(self, lines: Lines, own: dict[str, Lines] | None = None):
        self.all = lines
        self.own = own or {}  # lists by host
        self.host = None
        self.cache: dict[str, bool] = {}
        self.rules: dict[str, tuple] = {}
        self._use(None)

    def _use(self, mine: Lines | None) -> None:
        self.lines = ChainMap(mine.heads, self.all.heads) if mine else self.all.heads
        self.starts = self.all.starts | mine.starts if mine else self.all.starts
        self.longest = max(self.all.longest, mine.longest) if mine else self.all.longest

    def at(self, host) -> None:
        """The lists of ``host`` hold from here on."""
        if host != self.host:
            mine = self.own.get(host)
            if mine or self.lines is not self.all.heads:
                self.cache = {}
                self._use(mine)
            self.host = host

    def learn(self, pdf: pd.DataFrame) -> pd.DataFrame:
        """Takes the rows of hosts' lists out of a batch sorted by host; lists of earlier hosts are dropped."""
        if not len(pdf):
            return pdf
        self.own = {h: x for h, x in self.own.items() if h == self.host}
        is_list = pdf["code"].notna()
        for h, code, head, start, size in zip(*[pdf.loc[is_list, c] for c in ("host", "code", "head", "start", "size")]):
            self.own.setdefault(h, Lines()).add(int(code), bool(head), int(start), int(size))
        self.host = None
        return pdf[~is_list]

    def item(self, text: str, k: int) -> bool:
        """Whether a line is furniture by the lists: the whole, its frame, or all of its phrases."""
        if k in self.lines:
            return True
        got = self.cache.get(text)
        if got is None:
            if len(self.cache) > 100_000:
                self.cache.clear()
            got = self.cache[text] = self._item(text, k)
        return got

    def _item(self, text: str, k: int) -> bool:
        if not k:
            return False
        g = frame(text)
        if g and g in self.lines:
            return True
        parts = [p for p in _ITEMS.split(text.strip()) if p]
        if len(parts) > 1:
            known = sum(key(p) in self.lines for p in parts)
            if known == len(parts) or known >= 3 and known >= 0.75 * len(parts):
                return True
        return self._covered(text.split())

    def _covered(self, words: list[str]) -> bool:
        """Whether the words divide into listed phrases. A search starts only where some listed line starts so, and goes no
        further than the longest one."""
        n, reach, done, keys = len(words), [0], {0}, {}
        if n < 2:
            return False

        def at(j: int) -> bytes:
            if j not in keys:
                keys[j] = letters(words[j])
            return keys[j]

        def starts(i: int) -> bool:
            head, j = at(i), i + 1
            while len(head) < START and j < n:
                head += at(j)
                j += 1
            return any(int.from_bytes(head[:m]) in self.starts for m in range(1, min(len(head), START) + 1))

        for i in reach:  # grows
            ends = [i + 1] if i and not at(i) else []
            if starts(i):
                h, size = xxhash.xxh64(), 0
                for j in range(i, n):
                    size += len(at(j))
                    if size > 4 * self.longest:  # bytes
                        break
                    h.update(at(j))
                    if size and _signed(h.intdigest()) in self.lines:
                        ends.append(j + 1)
            for j in ends:
                if j == n:
                    return True
                if j not in done:
                    done.add(j)
                    reach.append(j)
        return False

    def page(self, page: str, winner: str | None, bad: frozenset, good: frozenset) -> tuple[list[int], dict[int, bool]]:
        """Numbers of the furniture lines of a page, and its visible texts' keys with whether they are furniture."""
        if not is_page(page):
            return [], {}
        parts = pieces(page)
        stats = container_stats(parts)
        own = _winner({p: s[1] for p, s in stats.items() if s[1]})
        if winner and winner in stats:
            fur = judge(stats, winner)
            for p in fur:
                if p in bad:
                    fur[p] = True
                elif p in good:
                    fur[p] = False
        elif own and stats[own][1] >= 120:
            fur = judge(stats, own)
        else:
            fur = dict.fromkeys(stats, False)
        lines: dict[int, bool] = {}
        texts: dict[int, bool] = {}
        for no, p, text, _ in parts:
            if not any(map(str.isalnum, text)) and len(text) < 3:
                continue
            f = fur[p]
            lines[no] = lines.get(no, True) and f
            k = key(text)
            if k:
                texts[k] = texts.get(k, True) and f
        return [no for no, f in lines.items() if f], texts

    def plain(self, text: str, own: dict[int, bool]) -> list[int]:
        """Numbers of the furniture lines of a plain-text capture; ``own``: the texts of the same row's page."""
        out = []
        after = False  # within the links after a heading such as "similar jobs"
        for no, line in enumerate(text.split("\n"), 1):
            s = line.strip()
            if not s:
                continue
            k = key(s)
            f = own.get(k) if own else None
            if f is None:
                f = self.item(s, k)
                if not f and after and not s.startswith(BULLETS) and not s.endswith(_END) and _TITLED.search(s):
                    out.append(no)
                    continue
            if f:
                out.append(no)
                after = self.lines.get(k, False) or after and k not in self.lines
            else:
                after = False
        return out

    def row(self, page, text, host, winner, bad, good) -> tuple[list[int], list[int]]:
        """Numbers of the furniture lines of a row's page and of its text, which is read by that page where there is one."""
        found: list[int] = []
        own: dict[int, bool] = {}
        if isinstance(page, str) and page:
            if host not in self.rules:
                self.rules[host] = (winner, frozenset(bad), frozenset(good)) if isinstance(winner, str) else (None, frozenset(), frozenset())
            found, own = self.page(page, *self.rules[host])
        self.at(host)
        return found, self.plain(text, own) if isinstance(text, str) and text else []


#: The columns that ``Reader.row`` takes.
READ = ["page", "text", "host", "winner", "furniture", "body"]
#: A linked opening: a title, then its place.
_TITLED = re.compile(r"^[^\W\d_].*(?: - |, )[^\W\d_]", re.U)


def with_rules(rows: DataFrame, sums: DataFrame, url: str) -> DataFrame:
    """``rows`` with their host's rules: host, winner, furniture and body, NULL where it has none."""
    chars = F.length(F.array_join("furniture", "")) + F.length(F.array_join("body", "")) + 100
    rules = broadcast_if_small(materialise(host_rules(sums)), width=chars)
    host = F.coalesce(F.regexp_extract(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    return rows.join(rules, host == F.col("host"), "left")


def with_lists(rows: DataFrame, own: DataFrame) -> DataFrame:
    """``rows`` and the lists of their hosts (code, head, start, size), by host and salt: a list comes before the rows it serves."""
    data = rows.withColumns({"code": F.lit(None).cast("string"), "head": F.lit(None).cast("boolean"), "start": F.lit(None).cast("long"), "size": F.lit(None).cast("long"), "salt": F.pmod(F.xxhash64("row_id"), F.lit(SALTS))})
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    lists = own.select("host", F.col("code").cast("string").alias("code"), "head", "start", "size", salts.alias("salt"))  # text: a number with NULLs would lose digits
    return data.unionByName(lists, allowMissingColumns=True).repartition("host", "salt").sortWithinPartitions("host", "salt", F.col("code").isNull())


def read_rows(rows: DataFrame, sums: DataFrame, use: Callable, schema: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """``use(reader, batches)`` over ``rows`` (row_id, page, text, url), with the rules and lists of their hosts.

    The hosts' own lists are broadcast up to ``most`` lines.
    """
    listed = furniture_lines(sums)
    own = materialise(host_lines(sums))
    rows = with_rules(rows, sums, "url").select("row_id", *READ)
    few = own.limit(most + 1).count() <= most
    mine: dict[str, Lines] = {}
    if few:
        for r in own.toArrow().to_pylist():
            mine.setdefault(r.pop("host"), Lines()).add(**r)
    else:
        rows = with_lists(rows, own)
    shared = rows.sparkSession.sparkContext.broadcast((listed, mine))

    def scan(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(*shared.value)
        yield from use(reader, it if few else map(reader.learn, it))

    return rows.mapInPandas(scan, schema)


def find_furniture(df: DataFrame, row_id: str, html: str, text: str, url: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """(row_id, field, line_no) of each line of ``html`` or ``text`` that is only furniture."""
    sums = materialise(survey(df, html, url))
    rows = df.select(F.col(row_id).alias("row_id"), F.col(html).alias("page"), F.col(text).alias("text"), F.col(url).alias("url"))

    def use(reader: Reader, it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            ids, names, nos = [], [], []
            for i, *row in zip(pdf["row_id"], *[pdf[c] for c in READ]):
                for name, found in zip((html, text), reader.row(*row)):
                    ids += [i] * len(found)
                    names += [name] * len(found)
                    nos += found
            yield pd.DataFrame({"row_id": pd.Series(ids, dtype="int64"), "field": pd.Series(names, dtype="object"), "line_no": pd.Series(nos, dtype="int64")})

    return read_rows(rows.filter(F.col("page").isNotNull() | F.col("text").isNotNull()), sums, use, "row_id long, field string, line_no long", most)
