import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveworks.operators import timestamps as T

CASES = [
    ("2024-01-05", "Europe/Berlin", "DMY", "2024-01-04T23:00:00.000000Z"),
    ("05/01/2024", "UTC", "DMY", "2024-01-05T00:00:00.000000Z"),
    ("05/01/2024", "UTC", "MDY", "2024-05-01T00:00:00.000000Z"),
    ("1.2.24 13:05", "UTC", "DMY", "2024-02-01T13:05:00.000000Z"),
    ("1704164488284", "Asia/Tokyo", "DMY", "2024-01-02T03:01:28.284000Z"),
    ("1704164488", "Asia/Tokyo", "DMY", "2024-01-02T03:01:28.000000Z"),
    ("20240105T174628", "UTC", "DMY", "2024-01-05T17:46:28.000000Z"),
    ("Mon, 08 Jan 2024 04:01:26 -0500", "UTC", "DMY", "2024-01-08T09:01:26.000000Z"),
    ("2024-01-17T07:46:39+00:00[UTC]", "UTC", "DMY", "2024-01-17T07:46:39.000000Z"),
    ("2024-01-25 01:11:41.598983221+0530", "UTC", "DMY", "2024-01-24T19:41:41.598983Z"),
    ("January 22, 2024 4:32 PM", "UTC", "DMY", "2024-01-22T16:32:00.000000Z"),
    ("13. Mai 2024", "UTC", "DMY", "2024-05-13T00:00:00.000000Z"),
    ("2024-10-27 02:30", "Europe/Berlin", "DMY", "2024-10-27T00:30:00.000000Z"),  # twice: the first
    ("2024-03-31 02:30", "Europe/Berlin", "DMY", "2024-03-31T01:30:00.000000Z"),  # skipped: the offset before
    ("2024-03-21 02:46 EDT", "UTC", "DMY", "2024-03-21T06:46:00.000000Z"),
    ("2024-02-30", "UTC", "DMY", None), ("31/31/2024", "UTC", "DMY", None), ("3 days ago", "UTC", "DMY", None), ("", "UTC", "DMY", None), (None, "UTC", "DMY", None), ("0000-00-00", "UTC", "DMY", None),
    ("2024-01-15T00:00:40.404010Z", "UTC", "DMY", None),  # canonical already
]


def test_cases(spark):
    zones = sorted({(z, o) for _, z, o, _ in CASES})
    portal = spark.createDataFrame([(f"{z}{o}", z, o) for z, o in zones], "portal_url string, time_zone string, date_order string")
    job = spark.createDataFrame([(i, f"{z}{o}", v, 7) for i, (v, z, o, _) in enumerate(CASES)], "row_id long, portal_url string, date_posted string, field long")
    got = {r.row_id: r.utc_value for r in T.rewritten(T.normalise_timestamps(job, "row_id", "portal_url", ["date_posted"], portal)).collect()}
    assert got == {i: w for i, (*_, w) in enumerate(CASES) if w}


def test_unknown_source_is_utc_and_empty_table(spark):
    portal = spark.createDataFrame([], "portal_url string, time_zone string, date_order string")
    job = spark.createDataFrame([(1, None, "2024-01-05 10:00"), (1, None, "2024-01-05 10:00")], "row_id long, portal_url string, date_posted string")
    assert [r.utc_value for r in T.rewritten(T.normalise_timestamps(job, "row_id", "portal_url", ["date_posted"], portal)).collect()] == ["2024-01-05T10:00:00.000000Z"] * 2
    assert T.normalise_timestamps(job.filter("row_id > 5"), "row_id", "portal_url", ["date_posted"], portal).collect() == []


def test_viterbi_follows_order_without_declaration(spark):
    """Unambiguous neighbours pull an ambiguous value to their order; blocks give the outcome of one pass."""
    values = ["25/01/2024", "02/03/2024", "26/01/2024", "03/04/2024"]
    portal = spark.createDataFrame([("p", "UTC", None)], "portal_url string, time_zone string, date_order string")
    job = spark.createDataFrame([(i, "p", v) for i, v in enumerate(values)], "row_id long, portal_url string, d string")
    got = [r.utc_us for r in T.normalise_timestamps(job, "row_id", "portal_url", ["d"], portal).orderBy("row_id").collect()]
    assert [np.datetime64(u, "us").astype("datetime64[D]").astype(str) for u in got] == ["2024-01-25", "2024-03-02", "2024-01-26", "2024-04-03"]


@pytest.mark.parametrize("block", [1, 2, 3, 50])
def test_blocks_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(T, "BLOCK_ROWS", block)
    values = ["01/02/2024", "03/02/2024", "25/02/2024", "04/03/2024", "2024-03-05", "05/06/2024", "06/30/2024", "07/01/2024"]
    cands = [[{"fmt": a, "us": b, "alt": c} for a, b, c in T.interpretations(v, None)] for v in values]
    lists = [T._states(c, T.ANY) for c in cands]
    cost = lambda path: path[0][3] + sum(T._step(p, c) for p, c in zip(path, path[1:]))
    best = min(cost(p) for p in itertools.product(*lists))
    portal = spark.createDataFrame([("p", "UTC", None)], "portal_url string, time_zone string, date_order string")
    job = spark.createDataFrame([(i, "p", v) for i, v in enumerate(values)], "row_id long, portal_url string, d string")
    got = [r.utc_us for r in T.normalise_timestamps(job, "row_id", "portal_url", ["d"], portal).orderBy("row_id").collect()]
    mine = [[x for x in states if x[1] == u] for states, u in zip(lists, got)]
    assert min(cost(p) for p in itertools.product(*mine)) == best


def test_all_readings():
    assert [a for *_, a in T.interpretations("2024-10-27 02:30", "Europe/Berlin")] == [0, 1]  # twice
    assert len(T.interpretations("2024-03-31 02:30", "Europe/Berlin")) == 1  # skipped
    assert len(T.interpretations("2024-10-27 02:30 IST", "Asia/Kolkata")) == 1 and len(T.interpretations("2024-07-27 02:30 IST", "Europe/Dublin")) == 2
    assert len(T.interpretations("01/02/2024", "UTC")) == 2 and len(T.interpretations("13/02/2024", "UTC")) == 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_orders_are_found_without_declaration(spark):
    """With the declared order hidden for a tenth of the portals, nearly all of their ambiguous dates come out the same."""
    job, portal = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("job", "portal"))
    hidden = portal.withColumn("date_order", F.when(F.expr("pmod(hash(portal_url), 10) < 2"), None).otherwise(F.col("date_order")))
    names = {r.portal_url for r in hidden.filter("date_order is null").collect()}
    assert len(names) >= 5
    job = job.select("row_id", "portal_url", "date_posted", "date_scraped").filter(F.col("portal_url").isin(*names))
    key = lambda p: {(r.row_id, r.field): r.utc_us for r in T.normalise_timestamps(job, "row_id", "portal_url", ["date_posted", "date_scraped"], p).collect()}
    told, alone = key(portal), key(hidden)
    cands = T.candidates(job, "row_id", "portal_url", ["date_posted", "date_scraped"], portal, "time_zone", "date_order")
    two = [(r.row_id, r.field) for r in cands.filter("size(cands) > 1 and cands[0].fmt <> 0").collect()]
    assert set(told) == set(alone) and len(two) >= 10
    assert sum(told[k] == alone[k] for k in two) >= 0.95 * len(two)
