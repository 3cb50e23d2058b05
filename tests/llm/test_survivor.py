import random

from pyspark.sql import functions as F

from sieveworks.llm import graph, survivor


def test_components_equal_union_find(spark):
    rnd = random.Random(2)
    edges = [(rnd.randint(1, 60), 100 + rnd.randint(1, 60)) for _ in range(55)] + [(200 + i, 201 + i) for i in range(40)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        up[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges for x in e}


JOB = "row_id long, job_id string, title string, description string, description_html string, application_url string, company_name string, location string, salary_range string, date_scraped string, portal_url string"


def test_best_rows(spark):
    rows = [
        (1, "R-1", "Clerk", "short text", None, "https://a.b/x/", "Acme", "Remote", None, "2024-01-01", "p"),
        (2, "r1", "Clerk", "a much longer text of the posting", None, None, "ACME", "Eskaport, DI, Norvania", "DOE", "2024-01-03", "p"),
        (3, None, "Clerk", "Loading…", None, "HTTP://A.B/X?u=1", None, "Eskaport", "$10 - $20", "no day", "p"),
        (4, None, "Other", "alone", None, "https://a.b/y", None, None, None, None, "p"),
        (5, None, None, None, None, None, None, None, None, None, None),
    ]
    job = spark.createDataFrame(rows, JOB)
    portal = spark.createDataFrame([("p", "UTC", "DMY")], "portal_url string, time_zone string, date_order string")
    ref = spark.createDataFrame([(1, "Eskaport", "Doria", "DI", "Norvania", "NV", "Eskaport, DI, Norvania", None)], "place_id long, city string, state string, state_code string, country string, country_code string, label string, other_names array<string>")
    got = {(r.group_id, r.field): r.row_id for r in survivor.best_rows(job, portal, ref).collect()}
    assert got == {(1, "description"): 2, (1, "location"): 2, (1, "date_scraped"): 2, (1, "salary_range"): 3}
    assert survivor.best_rows(job.filter("row_id < 0"), portal, ref).collect() == []
    fields = ["title", "description", "job_id", "location", "salary_range", "date_scraped", "application_url"]
    full = {r.group_id: r for r in survivor.surviving_records(job, portal, ref, fields).collect()}
    assert {g: r.n_rows for g, r in full.items()} == {1: 3, 4: 1, 5: 1}
    assert full[1].description == rows[1][3] and full[1].job_id == "r1" and full[1].salary_range == "$10 - $20" and full[1].application_url == "https://a.b/x/"
    assert full[4].description == "alone" and full[5].title is None
    trusted = survivor.best_rows(job, portal, ref, ["job_id"], priority=F.when(F.col("row_id") == 1, 1))
    got = {(r.group_id, r.field): r.row_id for r in trusted.collect()}
    assert got[1, "job_id"] == 1 and got[1, "description"] == 2 and got[1, "date_scraped"] == 1


def test_letters_are_counted_by_the_rows_own_page(spark):
    body = "You will sort the seed orders of the northern crew and repair their test rigs with the data group every week of the season."
    side = ["Rare keeper of the old harbour lights and of the northern ferry landing", "Seldom seen buyer of menu cards and other printed goods for the islands"]
    page = f"<!doctype html><html><body><div class='m'><p>{body}</p></div><div class='s'>{''.join(f'<a href=#>{x}</a>' for x in side)}</div></body></html>"
    rows = [
        (1, "R-1", "Clerk", "\n".join([body, *side]), page, None, "Acme", None, None, None, "https://h.example/jobs"),
        (2, "R-1", "Clerk", body + " It is a post for two years.", None, None, "Acme", None, None, None, "https://h.example/jobs"),
    ]
    job = spark.createDataFrame(rows, JOB)
    portal = spark.createDataFrame([("https://h.example/jobs", "UTC", "DMY")], "portal_url string, time_zone string, date_order string")
    ref = spark.createDataFrame([(1, "Eskaport", "Doria", "DI", "Norvania", "NV", "Eskaport, DI, Norvania", None)], "place_id long, city string, state string, state_code string, country string, country_code string, label string, other_names array<string>")
    assert [(r.field, r.row_id) for r in survivor.best_rows(job, portal, ref).collect()] == [("description", 2)]
