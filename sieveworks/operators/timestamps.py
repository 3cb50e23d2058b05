"""Timestamps of mixed formats and zones as one UTC instant.

Every value becomes the array of its valid interpretations: day and month either way round, both offsets of a wall time that
occurs twice, rival zones of an abbreviation. A Viterbi pass over each source's records in their order of arrival picks one
per value. Its states are the interpretations together with the day/month order in force, which values without such an order
hand on. A path pays for contradicting the source's declared order or the usual meaning of a time that occurs twice or of an
abbreviation, for switching the order, and for jumping back in time. So a date that can be read only one way settles those
around it that can be read two ways, and a declared order is evidence like the rest, only stronger.

The pass runs in blocks of arrival order. A block first yields its cost from each state of its first record to each of its
last one (a few numbers); these chain over the blocks of a source, and each block is then decoded from its entry state. So
the outcome is that of one pass over the whole source, while no task holds more than a block of it. Of a block only the
values take part that can tell something: those with an order or with several readings, and their neighbours; all others have
one reading, and steps between them cost the same on every path. Blocks are ranges of a source's row ids, as many as its rows
ask for; a block is as even as the ids are spread.

Defined results
---------------
* missing, relative or impossible values ("3 days ago", 31 February) have no interpretation and no instant;
* no zone in the value: wall time of the source's zone; no zone there either: UTC;
* a wall time that occurs twice means the first; one that is skipped takes the offset in force before the change;
* a bare day means its midnight; digits finer than microseconds are dropped;
* an abbreviation that several zones use (IST, CST) is read by the source's zone if that zone uses it, else by ``ABBREVIATIONS``;
* repeated rows are kept, each with its own result; row ids may repeat.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..runtime import broadcast_if_small, materialise

BLOCK_ROWS = 50_000
#: Costs on a path: a declared order counts as much as three changes of order.
AGAINST_DECLARED, UNUSUAL, SWITCH, BACKWARD = 6.0, 6.0, 2.0, 1.0
#: A jump back of more than this is one (microseconds): captures arrive late by days.
SLACK_US = 45 * 86_400_000_000
ANY, DMY, MDY = 0, 1, 2

# Offsets of zone abbreviations in minutes.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "Z": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "IST": 330, "NPT": 345, "JST": 540, "KST": 540, "AEST": 600, "AEDT": 660, "ACST": 570, "ACDT": 630, "AWST": 480, "NZST": 720, "NZDT": 780,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600,
}
# Month names of the four languages, by their first letters.
MONTHS = {
    "jan": 1, "ene": 1, "feb": 2, "fev": 2, "fév": 2, "mar": 3, "mär": 3, "mrz": 3, "apr": 4, "avr": 4, "abr": 4, "may": 5, "mai": 5, "jun": 6, "juin": 6, "jul": 7, "juil": 7,
    "aug": 8, "aou": 8, "aoû": 8, "ago": 8, "sep": 9, "oct": 10, "okt": 10, "nov": 11, "dec": 12, "déc": 12, "dez": 12, "dic": 12,
}

_TIME = r"(?:[Tt ,]+(?:at |à |a las |um )?(?P<h>\d{1,2})[:h](?P<i>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<f>\d+))?)? ?(?P<ap>[AaPp]\.?[Mm]\.?)?(?: Uhr)?)?"
_ZONE = r" ?(?P<z>Z|z|(?:UTC|GMT)?[+-]\d{1,2}(?::?\d{2})?(?::?\d{2})?|[A-Z]{2,5}|[A-Z][A-Za-z_]+/[A-Za-z_/+-]+)? ?(?:\[(?P<r>[A-Za-z_/+-]+)\]|\([A-Za-z ]+\))?"
_DAY = r"(?:[^\W\d_]{2,9}\.?,? )?"
_MON = r"(?P<mon>[^\W\d_]{3,10})\.?"
_FORMS = [
    re.compile(rf"(?P<y>\d{{4}})(?P<sep>[-/.])(?P<m>\d{{1,2}})(?P=sep)(?P<d>\d{{1,2}}){_TIME}{_ZONE}"),
    re.compile(r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})(?:[Tt ]?(?P<h>\d{2})(?P<i>\d{2})(?P<s>\d{2})?(?:[.,](?P<f>\d+))?)?" + _ZONE),
    re.compile(rf"{_DAY}(?P<d>\d{{1,2}})(?:st|nd|rd|th|er|\.|º)?[- ](?:de )?{_MON}(?:,? de|,)?[- ](?P<y>\d{{4}}|\d{{2}}){_TIME}{_ZONE}"),
    re.compile(rf"{_DAY}{_MON}[- ](?P<d>\d{{1,2}})(?:st|nd|rd|th)?,? (?P<y>\d{{4}}){_TIME}{_ZONE}"),
    re.compile(rf"(?P<a>\d{{1,2}})(?P<sep>[-/.])(?P<b>\d{{1,2}})(?P=sep)(?P<y>\d{{4}}|\d{{2}}){_TIME}{_ZONE}"),
]
_SPACE = re.compile(r"\s+")
_CANONICAL = re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}Z")
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_US = timedelta(microseconds=1)


@lru_cache(maxsize=1024)
def _zone(name: str | None) -> ZoneInfo | None:
    try:
        return ZoneInfo(name) if name else None
    except (ValueError, OSError, KeyError):
        return None


def _instants(wall: datetime, z: str | None, region: str | None, home: str | None) -> list[int]:
    """Microseconds since the epoch, the usual meaning first; none for a zone that isn't known."""
    at_utc = (wall.replace(tzinfo=timezone.utc) - _EPOCH) // _US
    if z:
        m = re.fullmatch(r"(?:UTC|GMT)?([+-])(\d{1,2}):?(\d{2})?:?(\d{2})?", z)
        if m:
            off = int(m[2]) * 60 + int(m[3] or 0)
            return [] if off > 18 * 60 or int(m[3] or 0) > 59 else [at_utc - (off if m[1] == "+" else -off) * 60_000_000]
        if "/" not in z:
            key, out = z.upper(), []
            at = _zone(home)
            if at is not None and key not in ("UTC", "GMT", "Z", "UT"):
                for fold in (0, 1):
                    local = wall.replace(tzinfo=at, fold=fold)
                    if local.tzname() == key:
                        out.append((local - _EPOCH) // _US)
            if key in ABBREVIATIONS:
                out.append(at_utc - ABBREVIATIONS[key] * 60_000_000)
            return list(dict.fromkeys(out))
        region = z
    at = _zone(region) if region else (_zone(home) or timezone.utc)
    if at is None:
        return []
    first, second = ((wall.replace(tzinfo=at, fold=f).astimezone(timezone.utc) - _EPOCH) // _US for f in (0, 1))
    return [first] if second <= first else [first, second]  # a skipped time has its later reading first


def _wall(g: dict, y: int, m: int, d: int) -> datetime | None:
    h, i, s = int(g.get("h") or 0), int(g.get("i") or 0), int(g.get("s") or 0)
    if ap := g.get("ap"):
        if not 1 <= h <= 12:
            return None
        h = h % 12 + (12 if ap[0] in "Pp" else 0)
    try:
        return datetime(y, m, d, h, i, s, int((g.get("f") or "0")[:6].ljust(6, "0")))
    except ValueError:
        return None


def interpretations(value: str | None, home: str | None) -> list[tuple[int, int, int]]:
    """All valid readings of a value as (order class, microseconds, 0 for the usual meaning or 1)."""
    v = _SPACE.sub(" ", value or "").strip()
    if not v or not any(c.isdigit() for c in v):
        return []
    if v.isdecimal() and len(v) in (10, 13, 16, 19):
        return [(ANY, int(v) * 10 ** (16 - len(v)) if len(v) <= 16 else int(v) // 1000, 0)]
    for k, form in enumerate(_FORMS):
        m = form.fullmatch(v)
        if not m:
            continue
        g = m.groupdict()
        y = int(g["y"])
        if len(g["y"]) == 2:
            y += 2000 if y < 70 else 1900
        if k == 4:
            a, b = int(g["a"]), int(g["b"])
            tries = [(DMY, b, a), (MDY, a, b)]
        elif g.get("mon"):
            low = g["mon"].lower()
            mon = MONTHS.get(low[:4]) or MONTHS.get(low[:3])
            tries = [(ANY, mon, int(g["d"]))] if mon else []
        else:
            tries = [(ANY, int(g["m"]), int(g["d"]))]
        out = []
        for order, mo, d in tries:
            wall = _wall(g, y, mo, d)
            got = [] if wall is None else _instants(wall, g.get("z"), g.get("r") if not g.get("z") else None, home)
            out += [(order, us, int(k > 0)) for k, us in enumerate(got)]
        return out
    return []


_ORDER = {"DMY": DMY, "MDY": MDY}
_STATE = "array<struct<pick:int,us:bigint,order:int,cost:double>>"


def _states(cands: list, declared: int) -> list[tuple[int, int, int, float]]:
    """(reading, microseconds, order in force, cost) of each state of a value."""
    out = []
    for i, c in enumerate(cands):
        cost = UNUSUAL * c["alt"] + (AGAINST_DECLARED if c["fmt"] != ANY and declared and c["fmt"] != declared else 0.0)
        out += [(i, c["us"], o, cost) for o in ((DMY, MDY) if c["fmt"] == ANY else (c["fmt"],))]
    return out


def _step(p: tuple, c: tuple) -> float:
    """Cost of going from state p to state c."""
    return (SWITCH if p[2] != c[2] else 0.0) + (BACKWARD if c[1] < p[1] - SLACK_US else 0.0) + c[3]


def _run(lists: list, start: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(min,+) Viterbi: costs to the last value's states from each row of ``start``, and back pointers."""
    cost, prev, back = start, lists[0], []
    for states in lists[1:]:
        all_ = cost[:, :, None] + np.array([[_step(p, c) for c in states] for p in prev])[None]
        back.append(all_.argmin(axis=1).astype(np.int8))
        cost = all_.min(axis=1)
        prev = states
    return cost, back


def _lists(pdf: pd.DataFrame) -> tuple[pd.DataFrame, list]:
    pdf = pdf.sort_values(["row_id", "raw"], kind="stable")
    declared = _ORDER.get(pdf["date_order"].iloc[0], ANY)
    return pdf, [_states(c, declared) for c in pdf["cands"]]


def _summary(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf, lists = _lists(pdf)
    start = np.full((len(lists[0]),) * 2, np.inf)
    np.fill_diagonal(start, [s[3] for s in lists[0]])
    cost, _ = _run(lists, start)
    row = pdf.iloc[0]
    named = lambda states: [dict(zip(("pick", "us", "order", "cost"), s)) for s in states]
    return pd.DataFrame({"source": [row["source"]], "field": [row["field"]], "block": [row["block"]], "first": [named(lists[0])], "last": [named(lists[-1])], "costs": [cost.ravel().tolist()]})


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit state of each block of a source."""
    pdf = pdf.sort_values("block")
    plain = lambda states: [(s["pick"], s["us"], s["order"], s["cost"]) for s in states]
    total, back = None, []
    for first, last, cost in zip(pdf["first"].map(plain), pdf["last"].map(plain), pdf["costs"]):
        inner = np.asarray(cost).reshape(len(first), len(last))  # holds the first state's own cost
        if total is None:
            into, frm = np.zeros(len(first)), np.zeros(len(first), dtype=int)
        else:
            step = total[:, None] + np.array([[_step(p, c) - c[3] for c in first] for p in before])
            into, frm = step.min(axis=0), step.argmin(axis=0)
        all_ = into[:, None] + inner
        total, entry = all_.min(axis=0), all_.argmin(axis=0)
        back.append((frm, entry))
        before = last
    at, picks = int(np.argmin(total)), []
    for frm, entry in reversed(back):
        enter = int(entry[at])
        picks.append((enter, at))
        at = int(frm[enter])
    picks.reverse()
    return pd.DataFrame({"source": pdf["source"], "field": pdf["field"], "block": pdf["block"], "enter": [p[0] for p in picks], "leave": [p[1] for p in picks]})


def _decode(pdf: pd.DataFrame) -> pd.DataFrame:
    """The chosen reading of the values that have several."""
    pdf, lists = _lists(pdf)
    start = np.full((1, len(lists[0])), np.inf)
    start[0, int(pdf["enter"].iloc[0])] = 0.0
    _, back = _run(lists, start)
    at, picks = int(pdf["leave"].iloc[0]), []
    for i in range(len(lists) - 1, -1, -1):
        picks.append(at)
        if i:
            at = int(back[i - 1][0, at])
    picks.reverse()
    us = [states[p][1] for states, p in zip(lists, picks)]
    out = pd.DataFrame({"row_id": pdf["row_id"], "field": pdf["field"], "raw": pdf["raw"], "utc_us": us})
    return out[pdf["cands"].map(len) > 1]


def candidates(df: DataFrame, row_id: str, source: str, fields: list[str], sources: DataFrame, zone: str, order: str) -> DataFrame:
    """(row_id, source, field, raw, date_order, cands) of each value with a reading; ``sources`` has a row per source.

    The source table is joined by size: broadcast only if it is small.
    """
    long = df.select(
        F.col(row_id).alias("row_id"), F.col(source).alias("source"),
        F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("raw")) for f in fields])).alias("x"),
    ).select("row_id", "source", "x.field", "x.raw").filter(F.col("raw").isNotNull())
    known = broadcast_if_small(sources.select(F.col(source).alias("__s"), F.col(zone).alias("tz"), F.col(order).alias("date_order")))
    rows = long.join(known, F.col("source") == F.col("__s"), "left").select("row_id", "source", "field", "raw", "tz", "date_order")

    def read(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            one = {}
            cands = []
            for v, z in zip(pdf["raw"], pdf["tz"]):
                z = z if isinstance(z, str) else None
                if (v, z) not in one:
                    one[v, z] = [{"fmt": a, "us": b, "alt": c} for a, b, c in interpretations(v, z)]
                cands.append(one[v, z])
            pdf = pdf.drop(columns="tz").assign(cands=pd.Series(cands, index=pdf.index, dtype=object))
            yield pdf[pdf["cands"].map(len) > 0]

    out = "row_id long, source string, field string, raw string, date_order string, cands array<struct<fmt:int,us:long,alt:int>>"
    return rows.mapInPandas(read, out)


def normalise_timestamps(df: DataFrame, row_id: str, source: str, fields: list[str], sources: DataFrame, zone: str = "time_zone", order: str = "date_order") -> DataFrame:
    """(row_id, field, raw, utc_us): the chosen instant of each value that has one, in microseconds since 1970 UTC."""
    cands = materialise(candidates(df, row_id, source, fields, sources, zone, order))
    spans = cands.groupBy(F.col("source").alias("s1"), F.col("field").alias("f1")).agg(F.min("row_id").alias("lo"), F.max("row_id").alias("hi"), F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("parts"))
    where = (F.col("row_id").cast("double") - F.col("lo")) / (F.col("hi").cast("double") - F.col("lo") + 1) * F.col("parts")
    on = F.col("source").eqNullSafe(F.col("s1")) & (F.col("field") == F.col("f1"))
    rows = cands.join(broadcast_if_small(materialise(spans)), on).withColumn("block", F.floor(where)).drop("s1", "f1", "lo", "hi", "parts")
    by = ["source", "field", "block"]
    w = W.partitionBy(*by).orderBy("row_id", "raw")
    several = F.size("cands") > 1
    near = F.coalesce(F.lag(several).over(w), F.lit(True)) | F.coalesce(F.lead(several).over(w), F.lit(True))  # the ends of a block count
    path = materialise(rows.withColumn("near", near).filter(F.col("near") | several | (F.col("cands")[0]["fmt"] != ANY)).drop("near"))
    summary = path.groupBy(*by).applyInPandas(_summary, f"source string, field string, block long, first {_STATE}, last {_STATE}, costs array<double>")
    states = materialise(summary.groupBy("source", "field").applyInPandas(_chain, "source string, field string, block long, enter int, leave int"))
    states = states.select(F.col("source").alias("s2"), F.col("field").alias("f2"), F.col("block").alias("b2"), "enter", "leave")
    on = F.col("source").eqNullSafe(F.col("s2")) & (F.col("field") == F.col("f2")) & (F.col("block") == F.col("b2"))
    chosen = path.join(broadcast_if_small(states), on).drop("s2", "f2", "b2").groupBy(*by).applyInPandas(_decode, "row_id long, field string, raw string, utc_us long")
    plain = cands.filter(F.size("cands") == 1).select("row_id", "field", "raw", F.col("cands")[0]["us"].alias("utc_us"))
    return plain.union(chosen)


def utc_text(us) -> "F.Column":
    """Microseconds as YYYY-MM-DDTHH:MM:SS.ffffffZ, whatever the session's zone."""
    wall = F.timestamp_micros(us)
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), wall.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def rewritten(found: DataFrame) -> DataFrame:
    """(row_id, field, utc_value) of the values that aren't written in the canonical form already."""
    return found.filter(~F.col("raw").rlike(rf"^{_CANONICAL.pattern}$")).select("row_id", "field", utc_text(F.col("utc_us")).alias("utc_value"))
