"""Unit cases of the record operators; the queries are held against SQL by test_entry.py."""

import json

import pytest
from pyspark.sql import functions as F

from sieveworks.functions import dom, jsonapi, text as X, url as U
from sieveworks.operators import dedup, detect, extract, quality, report
from sieveworks.plans import pipeline
from sieveworks.schema import FIELDS
from sieveworks.sources import io
from sieveworks.streaming import incremental


def one(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(col(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(("url", "name"), [("https://careers.two-sigma.com/y", "Two Sigma"), ("https://jobs.auspost.com.au", "Auspost"), ("https://ea.com", "EA"), ("https://t.co/x", "Unknown"), (None, "")])
def test_company(spark, url, name):
    assert one(spark, U.company, url) == name


@pytest.mark.parametrize(("text", "out"), [("work for us", "wk f us"), (None, ""), ("Apply now", "")])
def test_noise_compat(spark, text, out):
    assert one(spark, X.noise_removed, text) == out


def test_noise_fixed_keeps_words(spark):
    assert one(spark, lambda c: X.noise_removed(c, compat=False), "work for us\n 12 views \nend") == "work for us\n\nend"


HTML = """<html><head><title>T - Acme</title><script type="application/ld+json">{"@type":"JobPosting","title":"LD Clerk","hiringOrganization":"Acme"}</script></head>
<body><nav>Menu</nav><!-- c --><h1 class="job-title">Clerk</h1><p>one<p>two &amp; three<br>four<div style="opacity: 0.9">gone</div><div class="ads-top"><b>ad</b></div><div><span></span></div></body>"""


def test_clean_html(spark):
    text, html = dom.cleaned(HTML)
    assert text.split("\n")[-3:] == ["one", "two & three", "four"] and "Menu" not in text and "gone" not in text and "<span>" not in html


def test_page_record(spark):
    df = spark.createDataFrame([(1, "https://careers.acme.com/JobDetail/x/12345", HTML), (2, None, None), (3, "https://careers.acme.com/2222", "<<<")], "row_id long, u string, h string")
    rows = {r.row_id: r for r in extract.job_data(df, "u", "h", ["row_id"]).collect()}
    assert rows[1].title == "LD Clerk" and rows[1].company_name == "Acme" and rows[1].job_id == "12345" and rows[1].employment_type is None
    assert rows[2].title == "" and rows[3].job_id == "2222"


def test_listing(spark):
    page = '<div class="job-card"><a href="/JobDetail/A/1234">Go</a><h3>Clerk</h3><i class="loc-location">Oslo</i></div><div class="job-card">no link</div>'
    df = spark.createDataFrame([("https://a.b/x", page), ("https://a.b/y", '<a href="/job/7777">Clerk two</a><a href="/job/1">abc</a>')], "u string, h string")
    rows = sorted((r.title, r.application_url, r.job_id, r.location) for r in extract.listing_rows(df, "u", "h", []).collect())
    assert rows == [("Clerk", "https://a.b/JobDetail/A/1234", "1234", "Oslo"), ("Clerk two", "https://a.b/job/7777", "7777", "")]


def test_json_records(spark):
    body = json.dumps({"jobs": [{"title": "No id", "url": "https://a.b/1"}, {"id": 7, "title": " A ", "company": {"name": "Acme"}}, 5, {"id": 8}]})
    df = spark.createDataFrame([(1, body), (2, "bad"), (3, None)], "n long, body string")
    rows = {r.title: r for r in jsonapi.records(df, "body", ["n"]).collect()}
    assert set(rows) == {"No id", "A"} and rows["No id"].application_url is None and rows["A"].application_url == "/JobDetail/7" and rows["A"].company_name == "Acme"
    assert {r.title: r.application_url for r in jsonapi.records(df, "body", ["n"], compat=False).collect()}["No id"] == "https://a.b/1"


def test_json_ld_salary_text_is_null(spark):
    ld = '{"@type":"JobPosting","title":"A","baseSalary":{"value":{"minValue":"10","maxValue":"20"}}}'
    df = spark.createDataFrame([(ld,)], "s string").select(jsonapi.posting(jsonapi.json_ld(F.array("s"))).alias("p"))
    assert df.first().p.salary_range is None


def jobs(spark, rows):
    base = dict.fromkeys(FIELDS)
    return spark.createDataFrame([(i, *[(base | r)[f] for f in FIELDS]) for i, r in enumerate(rows)], "row_id long, " + ", ".join(f"{f} string" for f in FIELDS))


def test_dedup_properties(spark):
    df = jobs(spark, [{"title": "A", "application_url": "https://x/1"}, {"title": "A", "application_url": " HTTPS://X/1 "}, {"title": "B"}, {"title": "C"}, {"title": "A", "application_url": "https://x/2"}])
    assert [r.row_id for r in dedup.deduplicated(df).orderBy("row_id").collect()] == [0, 2]
    assert [r.row_id for r in dedup.deduplicated(df, keep_missing_urls=True).orderBy("row_id").collect()] == [0, 2, 3]
    again = dedup.deduplicated(dedup.deduplicated(df, "content"), "content")
    assert again.count() == dedup.deduplicated(df, "content").count() == 3
    assert dedup.deduplicated(df.filter("row_id < 0")).collect() == []


def test_pipeline_and_sinks(spark, tmp_path):
    df = jobs(spark, [{"title": "Clerk", "application_url": "https://x/1", "description": "d" * 60}, {"title": "Clerk", "application_url": "ftp://x/2"}, {"title": "null", "application_url": "https://x/3"}])
    r = pipeline.run(df)
    assert r.valid.count() + r.invalid.count() == r.checked.count() == 3 and r.valid.count() == 1
    assert r.coverage.first().raw_jobs == 3 and r.quality.first().jobs == 1
    pipeline.write(r, str(tmp_path / "out"))
    assert io.read_jsonl(spark, str(tmp_path / "out/jobs/jsonl")).count() == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "out/jobs/csv")).columns == sorted(spark.read.option("header", True).csv(str(tmp_path / "out/jobs/csv")).columns)
    assert io.read_json(spark, str(tmp_path / "out/jobs/json")).count() == 1


def test_sources(spark, tmp_path):
    (tmp_path / "d.txt").write_text("# c\n\nacme.com\n https://b.c/x \n")
    assert [r.url for r in io.read_domains(spark, str(tmp_path / "d.txt")).collect()] == ["https://acme.com/careers", "https://b.c/x"]
    done = spark.createDataFrame([("a",), ("b",)], "url string")
    for more in (done, done.union(spark.createDataFrame([("c",), ("c",)], "url string"))):
        io.append_checkpoint(more, str(tmp_path / "cp"))
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "cp")).collect()) == ["a", "b", "c"]
    assert io.write_csv(done.filter("url = 'z'"), str(tmp_path / "no")) is False


def test_captured_source(spark, tmp_path):
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "page_2.json").write_text('{"jobs":[]}')
    (tmp_path / "s1" / "start.html").write_text("<p>\n</p>")
    (tmp_path / "s1" / "notes.txt").write_text("no capture")
    rows = io.read_captured(spark, str(tmp_path)).collect()
    assert sorted((r.site, r.page_no, r.kind, r.body) for r in rows) == [("s1", 0, "html", "<p>\n</p>"), ("s1", 2, "json", '{"jobs":[]}')]


def test_paging_stop_and_chunks(spark):
    pages = spark.createDataFrame([("s", 1, "a"), ("s", 2, "b"), ("s", 3, "a"), ("s", 4, "c"), ("t", 1, "a")], "site string, page int, url string")
    assert sorted((r.site, r.page) for r in report.paging_stop(pages, "site", "page", "url").collect()) == [("s", 1), ("s", 2), ("t", 1)]
    assert [r["count"] for r in report.chunked(spark.range(10), "id", 4).groupBy("chunk").count().orderBy("chunk").collect()] == [4, 4, 2]


def test_facets(spark):
    page = '<select name="filter_city"><option value="">All</option><option value="1">Oslo</option></select><select name="sort"><option value="a">A</option></select>'
    got = spark.createDataFrame([(page,)], "h string").select(dom.page_facets("h").alias("m")).select(detect.facet_options(F.col("m")).alias("f")).first().f
    assert list(got) == ["city"] and len(got["city"]) == 1


def test_completeness_of_empty_table(spark):
    assert quality.completeness(jobs(spark, [{}]).filter("row_id < 0")).collect() == []


def test_stream_matches_batch(spark, tmp_path):
    rows = [(1, "https://x/1", "2024-01-01 00:00:00"), (2, "https://x/1", "2024-01-01 01:00:00"), (3, "https://x/2", "2024-01-01 02:00:00")]
    df = spark.createDataFrame(rows, "row_id long, application_url string, at string").withColumn("captured_at", F.to_timestamp("at"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = incremental.new_records(stream).writeStream.format("memory").queryName("new_records").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.sql("select * from new_records").groupBy("url_hash").count().collect()
    assert len(got) == dedup.deduplicated(df, "url").count() == 2 and all(r["count"] == 1 for r in got)


def test_each_row_leads_to_its_similar_titles(spark):
    titles = ["Senior Data Clerk North Office", "office north CLERK data senior", "Senior Senior data clerk north office", "Junior Senior Data Clerk North Office", "Cook", None, "  "]
    df = spark.createDataFrame(list(enumerate(titles, 1)), "row_id long, title string")
    groups = dedup.title_groups(df).collect()
    assert sorted((r.row_id, r.class_id) for r in groups) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 5)]
    named = {r.words: r.class_id for r in groups}
    assert [{named[r.title_a], named[r.title_b]} for r in dedup.similar_titles(df).collect()] == [{1, 4}]
