"""One surviving record per group of duplicates, field by field.

Rows belong together when they share a key, also through other rows. The graph is that of the keys, not of the rows: copies
with the same keys are one edge, so a group of any size costs one edge per distinct pair of keys. Pairs of keys that occur
with each other only are components as they stand; the rest is contracted by alternating large and small stars.

Each field's survivor is the maximum of a composite struct (can supply, quality, source priority, instant, smallest row id)
in a single aggregation over the group, which the map side combines; a hot group reaches the shuffle as one row a task. Only
then the values are fetched, by row id.

Defined results
---------------
* a missing or empty key connects nothing; rows without any key, and groups of one row, have no result;
* a field that no row can supply has no line; an unreadable instant comes last; the smallest row id decides ties;
* repeated row ids count as one row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.timestamps import normalise_timestamps
from ..runtime import broadcast_if_small, materialise, missing
from . import boilerplate, canonical, residue
from .graph import components


def url_key(c: Column) -> Column:
    """Scheme, case, outer spaces, query, fragment and final slash aside; NULL if nothing is left."""
    k = F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    k = F.regexp_replace(F.regexp_replace(F.regexp_replace(k, r"^[a-z][a-z0-9+.-]*://", ""), r"[?#](?s:.*)$", ""), r"/+$", "")
    return F.when(k != "", k)


def name_key(c: Column) -> Column:
    """Letters and digits, case aside; NULL if there are none."""
    k = F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", ""))
    return F.when(k != "", k)


def record_keys(url: str, company: str, number: str) -> list[Column]:
    """Hashes of the address and of company and number, which captures of one opening share; NULL where missing.

    96 bits each, so that strangers don't meet even among 10^11 keys.
    """
    hash_ = lambda kind, *c: F.unhex(F.concat(F.lit(kind), F.substring(F.sha2(F.concat_ws("\0", *c), 256), 1, 24)))
    u, c, n = url_key(F.col(url)), name_key(F.col(company)), name_key(F.col(number))
    return [F.when(u.isNotNull(), hash_("00", u)), F.when(c.isNotNull() & n.isNotNull(), hash_("01", c, n))]


def grouped_rows(df: DataFrame, row_id: str, url: str, company: str, number: str) -> DataFrame:
    """(row_id, comp) of the rows in groups of two or more."""
    link, job = record_keys(url, company, number)
    keys = materialise(df.select(F.col(row_id).alias("row_id"), link.alias("u"), job.alias("j")).filter("u is not null or j is not null").distinct())
    pairs = keys.filter("u is not null and j is not null").select("u", "j").distinct()
    du = pairs.groupBy(F.col("u").alias("u1")).agg(F.count(F.lit(1)).alias("cu"), F.min("j").alias("ju"))
    dj = pairs.groupBy(F.col("j").alias("j1")).agg(F.count(F.lit(1)).alias("cj"))
    deg = materialise(pairs.join(du, F.col("u") == F.col("u1")).join(dj, F.col("j") == F.col("j1")).select("u", "j", "cu", "cj"))
    hard = components(deg.filter("cu > 1 or cj > 1").select(F.col("u").alias("a"), F.col("j").alias("b")))
    plain = deg.filter("cu = 1 and cj = 1").select(F.explode(F.array("u", "j")).alias("node"), F.least("u", "j").alias("component"))
    node = F.coalesce("u", "j")
    rows = keys.select("row_id", node.alias("n")).join(plain.union(hard), F.col("n") == F.col("node"), "left").select("row_id", F.coalesce("component", "n").alias("comp"))
    # two rows of one id with different keys are still one row
    rows = materialise(rows.groupBy("row_id").agg(F.min("comp").alias("comp")))
    big = rows.groupBy(F.col("comp").alias("c")).agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("c")
    return rows.join(big, F.col("comp") == F.col("c"), "left_semi")


def letters_of(df: DataFrame, job: DataFrame, html: str, text: str, url: str, fields: list[str]) -> DataFrame:
    """(row_id, letters) of ``df`` (row_id, page, text, url): letters outside furniture lines; 0 for residue.

    Lines are read as p6 reads them, with the row's own page. The rules of the hosts, the furniture list and the weights of
    the residue index come from all rows of ``job``.
    """
    sums = materialise(boilerplate.survey(job, html, url))
    docs, n = residue.frequencies(job, fields)

    def use(reader: boilerplate.Reader, it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = residue.Index(docs, n)
        for pdf in it:
            out = []
            for page, value, *rules in zip(*[pdf[c] for c in boilerplate.READ]):
                if index.residue(value):
                    out.append(0)
                    continue
                drop = set(reader.row(page, value, *rules)[1])
                kept = "".join(x for i, x in enumerate(value.split("\n"), 1) if i not in drop) if drop else value
                out.append(sum(map(str.isalpha, kept)))
            yield pd.DataFrame({"row_id": pdf["row_id"], "letters": out})

    return boilerplate.read_rows(df.filter(F.col("text") != ""), sums, use, "row_id long, letters long")


#: The fields with rules of their own; any other is supplied by the latest row that has a value.
RULED = ["description", "location", "date_scraped", "salary_range"]


def best_rows(job: DataFrame, portal: DataFrame, place_ref: DataFrame, others: Sequence[str] = (), priority: Column | None = None) -> DataFrame:
    """(group_id, field, row_id): which row supplies each field of each opening of two or more rows.

    ``others``: further fields, each from the latest row that has it. ``priority``: of ``job``'s rows, as a number; among
    rows of the same quality the higher one wins, before the instant. Without it all sources are trusted alike.
    """
    rows = materialise(grouped_rows(job, "row_id", "application_url", "company_name", "job_id"))
    times = normalise_timestamps(job.select("row_id", "portal_url", "date_scraped"), "row_id", "portal_url", ["date_scraped"], portal)
    times = times.groupBy(F.col("row_id").alias("r1")).agg(F.max("utc_us").alias("us"))
    rank = F.lit(0) if priority is None else F.coalesce(priority, F.lit(0))
    has = [(~missing(f)).alias(f"has_{f}") for f in others]
    thin = job.select(F.col("row_id").alias("r0"), rank.alias("rank"), *has, "location", "salary_range", "description", "description_html", "portal_url")
    mine = thin.join(rows, F.col("r0") == F.col("row_id"))
    texts = mine.filter(F.col("description").isNotNull()).select("row_id", F.col("description_html").alias("page"), F.col("description").alias("text"), F.col("portal_url").alias("url"))
    letters = letters_of(texts, job, "description_html", "description", "portal_url", ["title", "description"])
    letters = letters.groupBy(F.col("row_id").alias("r2")).agg(F.max("letters").alias("letters"))
    light = materialise(mine.select("row_id", "comp", "rank", *[f"has_{f}" for f in others], "location", F.col("salary_range").rlike(r"\p{Nd}").alias("pay")))
    placed = canonical.map_places(light, "row_id", "location", place_ref).filter("ref_id > 0").select(F.col("row_id").alias("r3")).distinct()
    label = broadcast_if_small(place_ref.select(F.col("label").alias("l")).distinct())
    exact = light.filter(~missing("location")).join(label, F.col("location") == F.col("l"), "left_semi").select(F.col("row_id").alias("r3")).distinct()
    all_ = (
        light.join(times, F.col("row_id") == F.col("r1"), "left").join(letters, F.col("row_id") == F.col("r2"), "left")
        .join(placed.union(exact).withColumn("named", F.lit(True)), F.col("row_id") == F.col("r3"), "left")
    )
    us = F.coalesce("us", F.lit(-(2**62)))

    def pick(can: Column, quality: Column) -> Column:
        return F.max(F.when(can, F.struct(quality.cast("long").alias("q"), F.col("rank"), us.alias("t"), (-F.col("row_id")).alias("r")))).getField("r")

    best = all_.groupBy("comp").agg(
        F.min("row_id").alias("group_id"),
        (-pick(F.col("letters") > 0, F.col("letters"))).alias("description"),
        (-pick(F.col("named"), F.lit(0))).alias("location"),
        (-pick(F.col("us").isNotNull(), F.lit(0))).alias("date_scraped"),
        (-pick(F.col("pay"), F.lit(0))).alias("salary_range"),
        *[(-pick(F.col(f"has_{f}"), F.lit(0))).alias(f) for f in others],
    )
    fields = [*RULED, *others]
    long = best.select("group_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("row_id")) for f in fields])).alias("x"))
    return long.select("group_id", "x.field", "x.row_id").filter("row_id is not null")


def surviving_records(job: DataFrame, portal: DataFrame, place_ref: DataFrame, fields: Sequence[str], priority: Column | None = None) -> DataFrame:
    """(group_id, n_rows, *fields): one record per opening, those of one row included; a row without any key is an opening.

    The values of an opening of several rows are fetched from the rows that supply them; NULL where none can. ``fields`` hold
    those of ``RULED`` in any order.
    """
    found = materialise(best_rows(job, portal, place_ref, [f for f in fields if f not in RULED], priority))
    rows = materialise(grouped_rows(job, "row_id", "application_url", "company_name", "job_id"))
    sizes = rows.groupBy("comp").agg(F.min("row_id").alias("g"), F.count(F.lit(1)).alias("n_rows")).select("g", "n_rows")
    src = job.select(F.col("row_id").alias("r"), *fields)
    value = F.coalesce(*[F.when(F.col("field") == f, F.col(f)) for f in fields])
    one = found.join(src, F.col("row_id") == F.col("r")).select("group_id", "field", value.alias("value")).groupBy("group_id").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])
    merged = sizes.join(one, F.col("g") == F.col("group_id"), "left").select(F.col("g").alias("group_id"), "n_rows", *fields)
    alone = src.join(rows.select("row_id"), F.col("r") == F.col("row_id"), "left_anti").select(F.col("r").alias("group_id"), F.lit(1).cast("long").alias("n_rows"), *fields)
    return merged.union(alone)
