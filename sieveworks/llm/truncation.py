"""Texts that stop before their own end.

A backward character n-gram model tells, for the characters before a position, how often the text or its line ends there
and how often it goes on. It is counted over all texts: every position of every line is an event. A text's last characters
are then scored: the log-odds that text goes on after them. The text's own end is taken out of the counts first, and copies
of one ending count once, so that copies of a cut text don't vouch for each other.

More evidence adds its own log-odds, as counted on these texts: a mark of omission, a broken character or address at the end
(its share among the ends of texts against that among the ends of lines within texts), a bracket or quote that is still open
(its share among all places against that among the ends of lines), and a length at which many
texts of one source end (the field's limit; against the lengths beside it). The threshold of a language is the least log-odds
at which the ends of complete texts, taken to score as the ends of lines within texts do, make up at most ``FALSE_SHARE`` of
the texts found. Thresholds belong to the column that the call names, as all counts do.

Contexts are known by 64-bit hashes and counted exactly, in joins: no context shares its counts with another, whatever the
corpus. Only contexts that end a text or a line are ever asked for; a bitmap of them, of fixed size, keeps most others out of
the shuffle, and those that it lets pass by chance meet no question.

Defined results
---------------
* NULL and blank texts are no cases and don't count in a source's rate; trailing white space is no part of the ending;
* a missing language is a language of its own, a missing source a source of its own (NULL);
* repeated rows get a result each; texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import broadcast_if_small, materialise, missing

ORDERS = (2, 4, 7, 11, 16)
#: log2 of the bits of the bitmap of endings; it decides what is shuffled, not what is counted.
BITS = 27
PRIOR = 3.0
#: Texts that end in the same so many characters are copies of one ending.
TAIL = 120
#: Share of complete texts among those found that the threshold aims at.
FALSE_SHARE = 0.02
LIMIT_ROWS, LIMIT_SHARE, LIMIT_EXCESS = 5, 0.015, 8
#: Bins of a log-odds unit, and the range, of the histograms that thresholds are taken from.
BINS, RANGE = 10, 30

_MARK = re.compile(r"\s*(?:(?:\.\.\.|…) ?(?:more|read more|weiter|mehr|suite|lire la suite|más|sigue)|\[(?:more|truncated|…|\.\.\.|cut|gekürzt|suite|continued|mehr|más)\]|(?:…|\.\.\.)? ?\((?:more|truncated|continued|cont\.?|suite|à suivre|fortsetzung[^)]*|continúa|sigue|…|\.\.\.)\)|…|(?<!\.)\.\.\.|�+|&[a-zA-Z#]\w{0,7}|</?[a-zA-Z][^<>]*|<)$", re.I)
#: An address that breaks off within its host.
_HOST = re.compile(r"https?:/{0,2}[\w-]*$", re.I)
_SIGNS = re.compile(r'[()\[\]"«»]')
#: White space of all kinds, as a set to trim.
SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_MULT = np.uint64(0x9E3779B97F4A7C15)
KEYS = [f"k{i}" for i in range(len(ORDERS))]
_KEY_TYPES = ", ".join(f"{c} long" for c in KEYS)


def trimmed(c: Column) -> Column:
    """Without white space at the end."""
    return F.rtrim(c, F.lit(SPACE))


def _split_mark(text: str) -> tuple[str, bool]:
    """The text before a mark of omission, a broken character or an address cut within its host at the end, and whether there is one."""
    m = _MARK.search(text, max(0, text.rfind("\n", 0, -1), text.rfind("<") - 1 if "<" in text[-2000:] else len(text) - 60))
    m = m or _HOST.search(text, max(0, len(text) - 300))
    return (text[: m.start()].rstrip() if m and m.start() else text), m is not None


def open_at(line: str) -> tuple[int, bool]:
    """Positions of a line within brackets or quotes, and whether its end is one."""
    if not _SIGNS.search(line):
        return 0, False
    n, depth, since = 0, {"(": 0, "[": 0, '"': 0, "«": 0}, 0
    pair = {")": "(", "]": "[", "»": "«"}
    for m in _SIGNS.finditer(line):
        sign = m[0]
        inside = any(depth.values())
        if sign == '"':
            depth['"'] ^= 1
        elif sign in pair:
            depth[pair[sign]] = max(0, depth[pair[sign]] - 1)
        else:
            depth[sign] += 1
        if inside:
            n += m.start() - since
        since = m.end()
    inside = any(depth.values())
    if inside:
        n += len(line) - since
    return n, inside


def language(c: Column) -> Column:
    """Two letters: en-GB, EN and en are one language; '' if missing."""
    return F.coalesce(F.lower(F.regexp_extract(c, r"^\s*([A-Za-z]{2})", 1)), F.lit(""))


def _codes(texts: list[str]) -> np.ndarray:
    """Code points in lower case with digits as 0; each text starts with zeros and ends with a line end."""
    pad = "\0" * max(ORDERS)
    codes = np.frombuffer("".join(pad + t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    codes[(codes >= 48) & (codes <= 57)] = 48
    return codes


def _ends(texts: list[str]) -> np.ndarray:
    """Position of each text's last character in its codes."""
    return np.cumsum(np.array([len(t) for t in texts], dtype=np.int64) + (max(ORDERS) + 1)) - 2


def _keys(codes: np.ndarray, at: np.ndarray, seen: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the hash of the last so many characters at the positions ``at``, and which of them these are.

    The hash grows from the position backward, so one pass serves all orders. A position whose context isn't in the bitmap
    ``seen`` is left out from there on: no longer context of it can be an ending's.
    """
    h, which = np.zeros(len(at), dtype=np.uint64), np.arange(len(at))
    for k in range(max(ORDERS)):
        h = (h ^ (codes[at - k].astype(np.uint64) + np.uint64(k + 1))) * _MULT
        h ^= h >> np.uint64(29)
        if k + 1 in ORDERS:
            if seen is not None:
                slot = h >> np.uint64(64 - BITS)
                keep = (seen[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
                h, at, which = h[keep], at[keep], which[keep]
            yield h.view(np.int64), which


def _contexts(texts: list[str]) -> dict[str, np.ndarray]:
    """The keys of the contexts at the ends of (lower-case) texts."""
    with np.errstate(over="ignore"):
        return {c: h for c, (h, _) in zip(KEYS, _keys(_codes(texts), _ends(texts)))}


def _batches(it: Iterator[pd.DataFrame], chars: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """Pieces of about ``chars`` characters; a longer text is a piece of its own."""
    for pdf in it:
        size = np.cumsum([len(t) for t in pdf["text"]]) // chars
        for _, part in pdf.groupby(size, sort=False):
            yield part


def line_ends(rows: DataFrame) -> DataFrame:
    """(lang, k0.., n, ...): the contexts before the line ends within the texts, in ``n`` places, of which some follow a mark
    or an open bracket; and, for these lines, their characters and those within brackets."""

    def scan(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = max(ORDERS)
        for pdf in it:
            found: dict[tuple[str, str], list[int]] = {}
            for text, lang in zip(pdf["text"], pdf["lang"]):
                low, at = text.rstrip().lower(), 0
                while (end := low.find("\n", at)) >= 0:
                    line, at, start = low[at:end], end + 1, at
                    line = line.rstrip()
                    if not line:
                        continue
                    marked = (line[-1] in "….])>�" or "http" in line) and _split_mark(line)[1]
                    n_open, is_open = open_at(line)
                    t = found.setdefault((lang, low[max(0, start + len(line) - width) : start + len(line)]), [0] * len(ENDS))
                    for i, x in enumerate((1, marked, is_open, len(line), n_open)):
                        t[i] += x
            if found:
                ends = [e for _, e in found]
                counts = np.array(list(found.values()), dtype=np.int64)
                yield pd.DataFrame({"lang": [x for x, _ in found], **_contexts(ends), **{c: counts[:, i] for i, c in enumerate(ENDS)}})

    got = rows.mapInPandas(scan, f"lang string, {_KEY_TYPES}, " + ", ".join(f"{c} long" for c in ENDS))
    return got.groupBy("lang", *KEYS).agg(*[F.sum(c).alias(c) for c in ENDS])


#: What is counted of the ends of lines.
ENDS = ["n", "marked", "ends_open", "chars", "chars_open"]


def _bitmap(contexts: DataFrame) -> np.ndarray:
    """A bit for each key, at its first ``BITS`` bits; what is collected is at most the bitmap's words."""
    slot = contexts.select(F.explode(F.array(*KEYS)).alias("k")).select(F.shiftrightunsigned("k", 64 - BITS).alias("s"))
    words = slot.groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("b")).toArrow()
    out = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    out[words["w"].to_numpy()] = words["b"].to_numpy().view(np.uint64)
    return out


def context_counts(rows: DataFrame, seen: np.ndarray) -> DataFrame:
    """(k, stop, go): how often text or its line ends after a context and how often it goes on, over all texts; at NULL all
    contexts together. Complete for the keys in ``seen``."""
    shared = rows.sparkSession.sparkContext.broadcast(seen)

    def events(codes: np.ndarray, at: np.ndarray, go: np.ndarray) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"k": pd.array([None], dtype="Int64"), "stop": [int((~go).sum())], "go": [int(go.sum())]})
        with np.errstate(over="ignore"):
            for h, which in _keys(codes, at, shared.value):
                slot, keys = pd.factorize(h)
                n, on = np.bincount(slot, minlength=len(keys)), np.bincount(slot[go[which]], minlength=len(keys))
                yield pd.DataFrame({"k": pd.array(keys, dtype="Int64"), "stop": n - on, "go": on})

    def interior(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _batches(it):
            texts = [t.rstrip().lower() for t in pdf["text"]]
            codes = _codes(texts)
            what = (codes != 0) & (codes != 10) & (codes != 32)
            what[_ends(texts)] = False  # the ends of the texts themselves
            at = np.nonzero(what)[0]
            yield from events(codes, at, codes[at + 1] != 10)

    def ends(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _batches(it):
            texts = [t.lower() for t in pdf["text"]]
            last = _ends(texts)
            yield from events(_codes(texts), last, np.zeros(len(last), dtype=bool))

    tails = rows.select(F.substring(trimmed(F.col("text")), -TAIL, TAIL).alias("text"), "lang").distinct()
    kind = "k long, stop long, go long"
    return rows.mapInPandas(interior, kind).union(tails.mapInPandas(ends, kind)).groupBy("k").agg(F.sum("stop").alias("stop"), F.sum("go").alias("go"))


def counted(contexts: DataFrame, counts: DataFrame) -> DataFrame:
    """(id, stop0, go0..): the counts of all orders of each context; ``id`` is its key of the highest order."""
    last = KEYS[-1]
    long = contexts.select(*KEYS).dropDuplicates([last]).select(F.col(last).alias("id"), F.posexplode(F.array(*KEYS)).alias("o", "key"))
    both = long.join(counts.filter("k is not null"), F.col("key") == F.col("k"))
    of = lambda c, i: F.coalesce(F.max(F.when(F.col("o") == i, F.col(c))), F.lit(0)).alias(f"{c}{i}")
    return both.groupBy("id").agg(*[of(c, i) for i in range(len(ORDERS)) for c in ("stop", "go")])


def log_odds(base: tuple[int, int], own_stop: Column) -> Column:
    """Log-odds that text goes on after a context, backed off from short to long ones; ``own_stop``: its own event, 0 or 1."""
    p = F.lit((base[0] + 1) / (sum(base) + 2))
    for i in range(len(ORDERS)):
        stop = F.greatest(F.coalesce(F.col(f"stop{i}"), F.lit(0)) - own_stop, F.lit(0))
        p = (stop + PRIOR * p) / (stop + F.coalesce(F.col(f"go{i}"), F.lit(0)) + PRIOR)
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log((1 - p) / p)


def _bin(c: Column) -> Column:
    """A log-odds' bin, its lower end included."""
    return F.floor(F.least(F.greatest(c, F.lit(-RANGE)), F.lit(RANGE)) * BINS)


def thresholds(natural: dict[str, dict[int, int]], texts: dict[str, dict[int, int]]) -> dict[str, float]:
    """Per language: the least log-odds above which complete texts are at most FALSE_SHARE of what is found.

    From the bins of the ends of lines within texts, which are complete, and of the ends of texts. A language in which no
    log-odds reaches that takes the one of all languages together.
    """

    def least(ends: dict[int, int], found: dict[int, int]) -> float | None:
        of_ends, of_texts, e, t, at = sum(ends.values()), sum(found.values()), 0, 0, None
        for b in range(RANGE * BINS, -RANGE * BINS - 1, -1):
            e += ends.get(b, 0)
            t += found.get(b, 0)
            if e * of_texts > FALSE_SHARE * t * max(of_ends, 1):
                break
            at = b
        return None if at is None or not t else at / BINS

    total = [{}, {}]
    for out, hists in zip(total, (natural, texts)):
        for h in hists.values():
            for b, n in h.items():
                out[b] = out.get(b, 0) + n
    every = least(*total)
    return {x: least(natural.get(x, {}), h) or every or float(RANGE) for x, h in texts.items()}


def field_limits(df: DataFrame, text: str, source: str) -> DataFrame:
    """(s, size, excess): lengths at which an unlikely number of a source's texts end, with how many times as many as at the
    lengths beside it; few per source, as each takes a share."""
    n = df.filter(~missing(text)).groupBy(F.col(source).alias("s"), F.length(text).alias("size")).agg(F.count(F.lit(1)).alias("n"))
    n = materialise(n)
    total = n.groupBy(F.col("s").alias("s2")).agg(F.sum("n").alias("total"))
    near = n.select("s", F.explode(F.array([F.col("size") + F.lit(d) for d in range(-10, 11) if d])).alias("at"), F.col("n").alias("m")).groupBy(F.col("s").alias("s3"), "at").agg(F.sum("m").alias("near"))
    top = n.filter(F.col("n") >= LIMIT_ROWS).join(total, F.col("s").eqNullSafe(F.col("s2"))).filter(F.col("n") >= LIMIT_SHARE * F.col("total"))
    both = top.join(near, F.col("s").eqNullSafe(F.col("s3")) & (F.col("size") == F.col("at")), "left")
    return both.select("s", "size", (F.col("n") / (F.coalesce("near", F.lit(0)) / 20 + 0.25)).alias("excess")).filter(F.col("excess") > LIMIT_EXCESS)


def _hist(df: DataFrame, weight: str) -> dict[str, dict[int, int]]:
    """Language -> bin -> weight; at most 2 * RANGE * BINS bins a language."""
    out: dict[str, dict[int, int]] = {}
    for r in df.groupBy("lang", "bin").agg(F.sum(weight).alias("n")).toArrow().to_pylist():
        out.setdefault(r["lang"], {})[r["bin"]] = r["n"]
    return out


def scores(df: DataFrame, row_id: str, text: str, lang: str, source: str) -> DataFrame:
    """(row_id, source, lang, score, cut) of each text that isn't blank."""
    limits = broadcast_if_small(materialise(field_limits(df, text, source)))
    rows = df.filter(~missing(text)).select(F.col(row_id).alias("row_id"), F.col(text).alias("text"), language(F.col(lang)).alias("lang"), F.col(source).alias("source"), F.length(text).alias("len"))
    whole = rows.select("text", "lang")
    rows = rows.join(limits, F.col("source").eqNullSafe(F.col("s")) & (F.col("len") == F.col("size")), "left")
    # only the last line and the characters before the end travel to Python: the rest is read by the model
    end = trimmed(F.col("text"))
    line, tail = F.substring_index(end, "\n", -1), F.substring(end, -TAIL, TAIL)
    rows = rows.select("row_id", "source", "lang", F.when(F.length(line) > F.length(tail), line).otherwise(tail).alias("text"), F.coalesce("excess", F.lit(0.0)).alias("excess"))

    def read(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            if not len(pdf):
                continue
            got = [_split_mark(t.rstrip()) for t in pdf["text"]]
            is_open = [open_at(e[e.rfind("\n") + 1 :])[1] for e, _ in got]
            yield pdf.drop(columns="text").assign(marked=[m for _, m in got], is_open=is_open, **_contexts([e.lower() for e, _ in got]))

    texts = materialise(rows.mapInPandas(read, f"row_id long, source string, lang string, excess double, marked boolean, is_open boolean, {_KEY_TYPES}"))
    lines = materialise(line_ends(whole))
    contexts = texts.select(*KEYS).union(lines.select(*KEYS))
    counts = materialise(context_counts(whole, _bitmap(contexts)))
    known = materialise(counted(contexts, counts))
    base = next(((r.stop, r.go) for r in counts.filter("k is null").collect()), (0, 0))
    # evidence beside the model, as log-odds from counts: marks at the ends of texts and of lines; brackets open within and at the end of lines
    e = lines.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ENDS]).first()
    t = texts.agg(F.count(F.lit(1)).alias("n"), F.count_if("marked").alias("marked")).first()
    share = lambda a, n: (a + 0.5) / (n + 1)
    weights = {"marked": share(t.marked, t.n) / share(e.marked, e.n), "is_open": share(e.chars_open, e.chars) / share(e.ends_open, e.n)}
    more = sum((F.when(F.col(c), max(math.log(w), 0.0)).otherwise(0.0) for c, w in weights.items()), F.lit(0.0))
    scored = texts.join(known, F.col(KEYS[-1]) == F.col("id"), "left")
    plain = log_odds(base, F.when(F.col("marked"), 0).otherwise(1)) + more
    scored = materialise(scored.select("row_id", "source", "lang", "excess", plain.alias("score")))
    natural = lines.join(known, F.col(KEYS[-1]) == F.col("id"), "left").select("lang", "n", _bin(log_odds(base, F.lit(1))).alias("bin"))
    least = thresholds(_hist(natural, "n"), _hist(scored.select("lang", F.lit(1).alias("n"), _bin(F.col("score")).alias("bin")), "n"))
    # what any place within a line scores without being known is no evidence
    any_place = math.log((base[1] + 1) / (base[0] + 1))
    least = {x: max(v, any_place) for x, v in least.items()}
    limit = df.sparkSession.createDataFrame(list(least.items()), "x string, least double")
    got = scored.join(F.broadcast(limit), F.col("lang") == F.col("x"))
    # at a field's limit the odds of a cut text are the excess itself; over the odds of all texts, they are evidence like the other
    share_cut = got.agg(F.coalesce(F.avg(F.when(F.col("score") >= F.col("least"), 1.0).otherwise(0.0)), F.lit(0.5))).first()[0]
    prior = math.log((share_cut + 1e-4) / (1 - share_cut + 1e-4))
    got = got.withColumn("score", F.col("score") + F.when(F.col("excess") > 0, F.greatest(F.log(F.col("excess") - 1) - prior, F.lit(0.0))).otherwise(0.0))
    return got.select("row_id", "source", "lang", "score", (F.col("score") >= F.col("least")).alias("cut"))
