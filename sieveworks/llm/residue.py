"""Template residue, filler and error-page text.

Labelled exemplars ("residue" and, for look-alikes, "mention") are held in an inverted index from token to exemplars. A
record is cut into passage windows: its lines, their sentences, and each template mark by itself. A window's tokens retrieve
exemplars; each is scored by TF-IDF containment (how much of the exemplar's weight the window holds) and coverage (how much
of the window's weight the exemplar explains). High values of both make the window residue, unless a "mention" exemplar
is held by the sentence. Words of one meaning ("enable", "turn on") are one token. Weights come from the document frequencies
of all words of the corpus; a word on fewer than ``RARE`` of the texts weighs as one on just so many, so the table that the
tasks hold is bounded by words a text / RARE.

Defined results
---------------
* NULL and blank texts are no residue; texts of any length are processed whole; repeated rows each get their own result;
* an empty table gives no rows; ties between exemplars go to "mention".
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..runtime import materialise

CONTAINMENT, COVERAGE = 0.65, 0.6
#: Filler is drawn from a word list at random: no window holds much of it, but it explains nearly all of a window of some words.
FILLER_WORDS, FILLER_COVERAGE = 4, 0.8
#: Share of a mention's words, little ones included, that a sentence must hold.
MENTION_CONTAINMENT = 0.8
#: Share of the texts below which a word's frequency isn't told apart.
RARE = 0.0005

# Words of one meaning, the first names the token.
SYNONYMS = (
    ("enable", "activate", "activated", "enabled", "switch", "turn", "turned", "allow", "allowed"),
    ("script", "scripts", "scripting", "javascript", "js"),
    ("page", "site", "website", "app", "application", "view"),
    ("posting", "job", "opening", "vacancy", "position", "offer", "role", "post"),
    ("please", "kindly", "must", "need"),
    ("use", "run", "runs", "see", "display", "continue", "proceed", "shown", "show", "access"),
    ("support", "supports", "works", "work", "requires", "require", "required", "relies", "needs"),
    ("enter", "insert", "add", "write", "type", "put"),
    ("here", "below", "box"),
    ("description", "text", "copy", "content", "duties", "details"),
    ("dummy", "sample", "placeholder", "filler"),
    ("replace", "replaced"),
    ("fault", "error", "exception", "failure"),
    ("seconds", "second", "minutes", "moments", "moment"),
    ("again", "retry", "later"),
    ("missing", "gone", "unavailable", "exist"),
    ("human", "robot", "captcha"),
    ("fields", "placeholders", "variables", "merges", "templates"),
)
# The labelled exemplars. Tokens in angle brackets are the marks that `tokens` makes of template syntax.
RESIDUE = (
    "<field>", "<object>", "<runs>", "<runs> <runs> <runs>", "<todo>", "undefined", "null",
    "please enable script to use this page", "please enable script in your browser", "enable script in your browser to continue", "you must enable script to see the posting",
    "this page support script", "this page support active script", "this page will not support without script", "script required", "script is disabled", "script is disabled in your browser",
    "your browser does not support script", "your browser does not run script so the posting cannot be shown", "noscript", "noscript content is hidden until script is enabled",
    "bitte aktivieren sie script", "bitte schalten sie script ein", "bitte aktivieren sie script um diese stelle zu sehen", "bitte schalten sie script ein um fortzufahren",
    "veuillez activer script", "veuillez activer script pour afficher l'offre", "active script para ver la oferta", "habilite script para continuar",
    "loading", "loading please wait", "loading posting details please wait", "please wait", "please wait while the page is loading", "wird geladen", "bitte warten", "chargement en cours", "veuillez patienter", "cargando", "espere por favor",
    "checking that you are human", "checking if you are human this may take a few seconds", "checking your browser before you continue", "verify that you are human", "please complete the human check to continue",
    "access denied", "you are not allowed to use this resource reference <number>", "you do not have permission to view this page", "forbidden", "<number> forbidden", "unauthorized",
    "page not found", "<number> not found", "<number> page missing", "<number> page not found", "this posting does not exist", "this posting is no longer available", "the address is not on this server", "the requested address was not found on this server",
    "the page you requested could not be found", "we could not find the page you were looking for", "we could not find the posting", "this posting could not be found",
    "seite nicht gefunden", "die seite wurde nicht gefunden", "die seite wurde nicht gefunden bitte prüfen sie die adresse", "página no encontrada", "página no encontrada compruebe la dirección", "page introuvable", "page introuvable vérifiez l'adresse",
    "erreur interne du serveur", "erreur interne du serveur merci de réessayer plus tard", "interner serverfehler", "interner serverfehler bitte versuchen sie es später", "error interno del servidor", "error interno del servidor inténtelo más tarde",
    "oops something went wrong", "something went wrong on our side", "try again in a few minutes", "please go back to the start page", "an unexpected fault occurred please try again later", "unexpected fault incident <number> has been logged", "fault <number>",
    "http <number>", "http <number> service unavailable", "http <number> gateway timeout", "http <number> bad gateway", "http <number> internal server fault", "http <number> not found", "http <number> forbidden", "http <number> unauthorized", "http <number> too many requests",
    "<number> internal server fault", "<number> service unavailable", "<number> bad gateway", "<number> gateway timeout", "service unavailable", "internal server fault", "bad gateway", "gateway timeout", "too many requests", "slow down and retry after <number> seconds",
    "your session has expired", "session expired please log in again", "your session has expired sign in again to continue", "the page is down for maintenance", "we will be back shortly", "this page is under maintenance",
    "traceback most recent call last", "file py line <number> in", "keyerror", "<code>", "<code> no posting for key <number>", "at <code> <number>", "at <code> posting <number>", "sql fault near where posting id state <number>", "sql syntax fault",
    "enter your posting description here", "description goes here", "posting title here", "your text here", "enter text here", "enter the duties of the posting here", "enter your title here",
    "sample text to be replaced", "replace this text", "dummy text", "dummy copy for layout only do not publish", "do not publish", "text text text", "texte à remplacer avant publication", "texto de relleno", "texto de relleno para la maqueta", "platzhaltertext", "platzhaltertext bitte ersetzen", "blindtext",
    "test", "test test", "test test test", "test test please ignore", "test posting do not apply", "this is a test please ignore", "new posting template", "new posting template v <number>", "lorem ipsum", "lorem ipsum dolor", "untitled", "untitled posting", "untitled posting copy", "<mash>",
)
# Beginnings of the words of the customary Latin filler text, by which its made-up relatives are known as well.
FILLER = (
    "lore ipsu dolo sit amet cons adip elit sed eius temp inci labo magn aliq enim mini veni quis nost exer ulla nisi aliq comm duis aute irur repr volu veli esse cill fugi null pari exce sint occa cupi non proi sunt culp qui offi dese moll anim est "
    "urna fauc port riti ridi soda vest viva done nunc maec curs dict dui eget eros erat faci feli ferm feug frin hend iacu impe inte just lacu laor lect leo libe lobo luct maur metu moles morb ornare orci pell phar plac pulv rhon rutr sagi sapi scel semp suscip "
    "tell torto tris turp ultr vari vehi vene vita vulp vel serat vost quand massa nibh purus tinc ante posu cong cras dapi grav habi matt moll neque potenti praes soci tris ut et"
)
MENTION = (
    "fields such as <field>", "fields with <field>", "fields such as <index>", "fields with <index>", "from <index> to <index>", "follow the form <index>", "the form <index>", "the pattern <index>",
    "undefined parts define", "null and undefined values", "null values", "undefined values are handled", "access denied desk", "every fault and every warning", "every fault <number> and every warning", "<number> and <number> pages of our shop",
    "answer calls when a page is not found", "page is not found or a session expires", "script is required to work on", "script must run without fault", "please wait at the gate", "loading and unloading", "maintenance is announced", "test test and test again until",
    "replace lorem ipsum drafts", "lorem ipsum drafts", "read a traceback and tell",
)

_FIELD = r"[A-Za-z][\w. \-]{0,40}"
_MARK = re.compile(
    r"(?P<field>\{\{\s*" + _FIELD + r"\s*\}\}|\{%\s*" + _FIELD + r"\s*%\}|<%=?\s*" + _FIELD + r"\s*%>|<<" + _FIELD + r">>|[$#]\{\s*" + _FIELD + r"\s*\}"
    r"|\$\$" + _FIELD + r"\$\$|\|\|" + _FIELD + r"\|\||@@" + _FIELD + r"@@|(?<!\w)__[A-Za-z][A-Za-z0-9_]*?__(?!\w)|%[A-Z][A-Z0-9_]*%|%%" + _FIELD + r"%%"
    r"|\[(?:Insert|INSERT|insert|Enter|Your|YOUR|Add)\b[^\]\n]{0,40}\]|\[[A-Z][A-Z_ ]{2,30}\]|\{\d+\})"
    r"|(?P<object>\[object \w+\])|(?P<index>\{[A-Z]\}|\[[A-Z]-[A-Z]\]\{\d+\}\S*)"
    r"|(?P<code>\b[a-z]\w*(?:\.[A-Za-z]\w+){2,})|(?P<runs>\b[xX]{2,}\b)|(?P<todo>\bTODO\b|\bFIXME\b|\bTBD_\w+)|(?P<number>(?<![^\W\d_])[A-Z]?\d+(?:[/.:,-]\d+)*\b)|(?P<word>[^\W\d]+(?:['’][^\W\d]+)?|(?<=v)\d+)"
)
#: A line without any of these holds no mark.
_HINTS = ("{", "<", "[", "||", "$$", "@@", "__", "%", "xx", "XX", "Xx", "TODO", "FIXME", "undefined", "null")
_EDGES = ".,;:!?…()[]\"'”“»«*-–"
_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "azertyuiop")
_CANON = {w: names[0] for names in SYNONYMS for w in names}
_STEMS = frozenset(FILLER.split())
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
#: Words that stand where a value should have been.
_VALUES = frozenset({"undefined", "null"})


def _mash(w: str) -> bool:
    """A run along a row of the keyboard."""
    return 3 <= len(w) and any(w in r for r in _ROWS) and w not in ("were", "rope", "ope", "pop", "try", "tree", "power", "port", "wert")


def tokens(text: str) -> list[str]:
    """Words in lower case with synonyms as one, template syntax, numbers, runs of x and of keys as marks."""
    out = []
    for m in _MARK.finditer(text):
        kind = m.lastgroup
        if kind == "word":
            w = m.group().lower().replace("’", "'")
            out.append("<mash>" if _mash(w) else _CANON.get(w, w))
        else:
            if kind == "runs" and m.group().isupper() and len(m.group()) >= 4:
                kind = "todo"
            out.append(f"<{kind}>")
    return out


def latin(w: str) -> bool:
    """Whether a word begins like one of the filler text."""
    return any(w[:n] in _STEMS for n in (3, 4, 5)) and (len(w) > 3 or w in _STEMS)


def _exemplars() -> list[tuple[str, Counter]]:
    parse = re.compile(r"<\w+>|[^\s<>]+")
    one = lambda x: Counter(_CANON.get(t, t) for t in parse.findall(x))
    return [("residue", one(x)) for x in RESIDUE] + [("mention", one(x)) for x in MENTION]


class Index:
    """Inverted index over the exemplars, with weights from the corpus' document frequencies."""

    def __init__(self, df: dict[str, int], docs: int):
        self.docs = docs
        self.df = df
        self.least = max(1.0, RARE * docs)
        self.items = _exemplars()
        self.cached: dict[str, float] = {}
        self.weight = [sum(self.idf(t) * n for t, n in c.items()) for _, c in self.items]
        self.post = defaultdict(list)
        for i, (_, c) in enumerate(self.items):
            for t in c:
                self.post[t].append(i)
        self.rarest = self.idf("\0")
        self.known: dict[str, bool] = {}
        self.seen: dict[str, float] = {}

    def idf(self, t: str) -> float:
        got = self.cached.get(t)
        if got is None:
            if len(self.cached) > 200_000:
                self.cached.clear()
            got = self.cached[t] = math.log((self.docs + 1) / (max(self.df.get(t, 0), self.least) + 0.5)) + 0.1
        return got

    def best(self, window: list[str], mention: bool = True) -> str:
        """Kind of the exemplar that explains the window best; '' if none reaches the thresholds."""
        have = Counter(window)
        weights = {t: self.idf(t) for t in have}
        whole = sum(weights[t] * n for t, n in have.items())
        filler = sum(weights[t] * n for t, n in have.items() if t == "<mash>" or latin(t)) if len(window) >= FILLER_WORDS else 0.0
        held: dict[int, float] = defaultdict(float)  # weight of the exemplar's tokens that the window holds
        explained: dict[int, float] = defaultdict(float)  # weight of the window's tokens that the exemplar has
        words: Counter = Counter()
        for t, n in have.items():
            for i in self.post.get(t, ()):
                held[i] += weights[t] * min(n, self.items[i][1][t])
                explained[i] += weights[t] * n
                words[i] += 1
        top = (FILLER_COVERAGE, "filler") if len(window) >= FILLER_WORDS and filler >= FILLER_COVERAGE * whole else (0.0, "")
        for i, s in held.items():
            kind, cover = self.items[i][0], explained[i] / whole
            if kind == "mention":
                if mention and words[i] >= MENTION_CONTAINMENT * len(self.items[i][1]):
                    return kind
            elif s >= CONTAINMENT * self.weight[i] and words[i] * 3 >= 2 * len(self.items[i][1]) and cover >= COVERAGE:
                top = max(top, (cover, kind))
        return top[1]

    def residue(self, text: str) -> bool:
        """Whether a window of the text is residue."""
        self.marked = any(h in text for h in _HINTS)
        for line in text.split("\n"):
            got = self.known.get(line)
            if got is None:
                if len(self.known) > 100_000:
                    self.known.clear()
                got = self.known[line] = self._line(line)
            if got:
                return True
        return False

    def _reachable(self, window: str) -> bool:
        """Upper bound: whether the words that no exemplar has leave room for the least coverage. What isn't a plain word counts for it."""
        inside = outside = 0.0
        for w in window.split():
            got = self.seen.get(w)
            if got is None:
                if len(self.seen) > 300_000:
                    self.seen.clear()
                got = self.seen[w] = self._side(w.strip(_EDGES))
            if got > 0:
                inside += got
            else:
                outside -= got
        return inside > 0 and inside >= COVERAGE * (inside + outside)

    def _side(self, w: str) -> float:
        """Weight of a word that an exemplar may explain, or the negative weight of one that none does."""
        t = _CANON.get(w, w)
        if not w or t in self.post:
            return self.idf(t) if w else 0.0
        return -self.idf(w) if w.isalpha() and not latin(w) and not _mash(w) else self.rarest

    def _line(self, line: str) -> bool:
        marks = self.marked and any(h in line for h in _HINTS)
        low = line if marks else line.lower()
        parts = _SENTENCE.split(low) if ". " in low or "! " in low or "? " in low or "… " in low else []
        for part in (low, *parts):
            if not marks and not self._reachable(part):
                continue
            toks = tokens(part)
            if toks and self.best(toks) in ("residue", "filler"):
                return True
            # each mark is a window of its own, unless its sentence mentions such marks
            if marks and (part is not low or not parts):
                alone = [t for t in toks if t in ("<field>", "<object>", "<todo>") or t in _VALUES]
                if alone and self.best(toks) != "mention" and any(self.best([t], mention=False) == "residue" for t in alone):
                    return True
        return False


def frequencies(df: DataFrame, fields: list[str]) -> tuple[dict[str, int], int]:
    """Document frequencies over all texts of the words on at least RARE of them, and the number of texts."""

    def tally(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n: Counter = Counter()

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"token": pd.Series(list(n), dtype="object"), "docs": pd.Series(list(n.values()), dtype="int64")})
            n.clear()
            return out

        for pdf in it:
            for f in fields:
                for text in pdf[f]:
                    if isinstance(text, str) and text:
                        found = {w.strip(_EDGES) for w in text.lower().split()}
                        found = {_CANON.get(w, w) for w in found}
                        if any(map(str.isdigit, found)):
                            found.add("<number>")
                        found.discard("")
                        n.update(found)
                        n[""] += 1
            if len(n) > 300_000:
                yield flush()
        yield flush()

    sums = materialise(df.select(*fields).mapInPandas(tally, "token string, docs long").groupBy("token").agg(F.sum("docs").alias("docs")))
    docs = next((r.docs for r in sums.filter("token = ''").collect()), 0)
    often = sums.filter((F.col("token") != "") & (F.col("docs") > RARE * docs)).toArrow()  # at most words a text / RARE
    return dict(zip(often["token"].to_pylist(), often["docs"].to_pylist())), docs


def find_residue(df: DataFrame, row_id: str, fields: list[str]) -> DataFrame:
    """(row_id, field) of each value that is, or contains, residue."""
    docs, n = frequencies(df, fields)
    shared = df.sparkSession.sparkContext.broadcast(docs)

    def scan(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(shared.value, n)
        for pdf in it:
            ids, names = [], []
            for f in fields:
                for i, text in zip(pdf["row_id"], pdf[f]):
                    if isinstance(text, str) and text and index.residue(text):
                        ids.append(i)
                        names.append(f)
            yield pd.DataFrame({"row_id": pd.Series(ids, dtype="int64"), "field": pd.Series(names, dtype="object")})

    return df.select(F.col(row_id).alias("row_id"), *fields).mapInPandas(scan, "row_id long, field string")
