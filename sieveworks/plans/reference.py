"""Queries of the record operators over the driver's tables, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import dom, infer, jsonapi, register, text as X, url as U
from ..operators import dedup, detect, extract, quality, report
from ..runtime import scratch, table
from ..sources import io
from ..streaming import incremental
from ..schema import FIELDS
from . import cases, pipeline

AS_OF = "2024-06-30 00:00:00"
URLS = (
    "acme.example/jobs/", "  https://Jobs.Acme.com//  ", "HTTP://X.com/a", "https://u@H.com:8080/a?x=1#f", "ftp://h.com/x", "mailto:a@b.com?body=see https://real.example/1",
    "", "https://acme.hirewell.example/x", "https://jobs.acme.hirewell.example/x", "https://team.jobs.hirewell.example/", "https://careers.two-sigma.com/y", "https://jobs.auspost.com.au/z",
    "https://auspost.com.au", "https://ea.com", "https://jobs.com", "https://bit.ly/abc", "https://a.b/JobDetail/T/123", "https://a.b/JobDetail/T/1234", "https://a.b/JobDetail/T/12345/",
    "https://a.b/98765?x=1", "https://a.b/p/98765#top", "https://a.b/p?jobId=42", "https://a.b/p?x=1&ID=43", "https://a.b/en_US/jobs", "https://", "http:///p",
)
TEXTS = (
    "We need a full-time clerk", "ft or pt", "Permanent post", "part time, contract", "Freelance consultant", "seasonal temp", "student co-op", "éft ptà", "work from home", "WFH days", "hybrid model",
    "flexible hours at work", "work that is flexible", "on-site only", "in office", "junior clerk", "0-2 years", "02 years", "2 – 5 years", "25 years", "senior", "sr. clerk", "5+ years", "lead", "vp of sales", "c-level",
    "$50,000 - $70,000", "$50k", "50,000–70,000 EUR", "Salary: $50,000", "pay: 12", "Date published: 3-Mar-2017", "Posted Date: 01/27/2026", "Date Posted 2024-01-05", "Posted\n1/2/2024", "Location: Berlin, USA", "Work Location:\nOslo, Norway", "nothing", "",
)
DATES = ("2024-01-05", "2024-01-05T10:11:12", "2024-01-05T10:11:12.345Z", "2024-02-30", "3-Mar-2017", "01/27/2026", "soon", "")
TITLES = ("Job: Clerk", "position: Clerk - Apply Now", "Clerk (NEW)", "Clerk [new] ", "ab", "abc", "x" * 500, "x" * 501, "12 - 34", "N/A", "Loading…", "Error Analyst", " Error", "", "<b>Clerk</b>  of\tworks")
COMPANIES = ("Acme Inc.", "Acme careers", "Acme LLC jobs", "Acme Corporation", "Limited", "Acme Ltd careers jobs", "Acme", "")
LONG = ("", "x" * 49, "x" * 50, "x" * 199, "x" * 200, "x" * 499, "x" * 500, "x" * 50_000, "x" * 50_001, "please wait for it " * 4, "   ", "Loading " * 10)
SECONDS = (0.0, 0.4, 1.0, 59.9, 60.0, 61.0, 3599.0, 3600.0, 3661.5, 86_400.0, 7200.0)
BODIES = (
    '{"jobs":[{"id":7,"title":" A ","company":{"name":"Acme"},"location":"Oslo"},{"title":"No id","url":"https://a.b/1"},{"id":0,"title":"Zero"},5]}', '{"data":[{"jobId":"x1","jobTitle":"B","city":""}]}',
    '{"requisitionList":[]}', '[{"id":9,"positionTitle":"C","salary":{"value":"10k"}}]', '{"id":3,"title":"Single"}', '{"results":{"id":1}}', "not json", "{}", '{"jobs":[{"id":1}]}',
)
LD = (
    '{"@type":"JobPosting","title":"A","jobLocation":{"address":{"addressLocality":"Oslo","addressCountry":"NO"}},"baseSalary":{"currency":"EUR","value":{"minValue":50000,"maxValue":70000,"unitText":"YEAR"}},"hiringOrganization":{"name":"Acme"},"employmentType":["FULL_TIME","TEMP"]}',
    '[{"@type":"Thing"},{"@type":"JobPosting","name":"B","jobLocation":[{"address":{"addressLocality":"X","addressRegion":"Y"}},{"address":{"addressLocality":"Z"}}],"baseSalary":{"value":1200},"jobLocationType":"TELECOMMUTE"}]',
    '{"@graph":[{"@type":"WebPage"},{"@type":"JobPosting","title":"C","jobLocation":{"address":"Main St"},"baseSalary":{"value":{"minValue":10}},"hiringOrganization":"Beta","industry":"Food"}]}', "{bad", '{"@type":"Thing"}',
)


def _values(spark: SparkSession, values, name: str, kind: str = "string") -> DataFrame:
    """Literal cases as a table (n, name); n from 1."""
    return spark.createDataFrame(list(enumerate(values, 1)), f"n long, {name} {kind}")


def _job(spark, d):
    return table(spark, d, "job")


def _urls(spark, d):
    return _job(spark, d).select("row_id", F.col("application_url").alias("u")).union(_values(spark, URLS, "u").select((-F.col("n")).alias("row_id"), "u"))


def _texts(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text").union(_values(spark, TEXTS, "text").select((-F.col("n")).alias("id"), "text"))


def url_normalize(spark, d):
    return _urls(spark, d).select("row_id", U.normalised(F.col("u")).alias("url"))


def url_domain(spark, d):
    return _urls(spark, d).select("row_id", U.domain(F.col("u")).alias("domain"))


def url_company(spark, d):
    return _urls(spark, d).select("row_id", U.company(F.col("u")).alias("company"))


def url_job_id(spark, d):
    return _urls(spark, d).select("row_id", U.job_id(F.col("u")).alias("job_id"))


def url_vendor(spark, d):
    return _urls(spark, d).select("row_id", U.is_vendor(F.col("u")).alias("is_vendor"))


def url_repair(spark, d):
    return _urls(spark, d).select("row_id", U.repaired_mailto(F.col("u")).alias("url"), U.locale_prefix(F.col("u")).alias("locale"), U.remedied(F.col("u")).alias("remedied"))


def url_absolute(spark, d):
    return _urls(spark, d).select("row_id", U.absolute(F.lit("https://base.example/a/b/"), F.col("u")).alias("url"))


def url_validate_reasons(spark, d):
    return _urls(spark, d).select("row_id", quality.url_error(F.col("u")).alias("reason"))


def text_clean(spark, d):
    return _texts(spark, d).select("id", X.squeeze(F.col("text")).alias("clean"))


def text_truncate(spark, d):
    return _texts(spark, d).select("id", X.truncate(F.col("text"), 80).alias("short"))


def whitespace_clean(spark, d):
    return _texts(spark, d).select("id", X.whitespace_cleaned(F.col("text")).alias("clean"))


def list_normalize(spark, d):
    return _texts(spark, d).select("id", X.lists_normalised(F.col("text")).alias("clean"))


def noise_text_compat(spark, d):
    return _texts(spark, d).select("id", X.noise_removed(F.col("text")).alias("clean"))


def noise_text_fixed(spark, d):
    return _texts(spark, d).select("id", X.noise_removed(F.col("text"), compat=False).alias("clean"))


def title_clean(spark, d):
    return _job(spark, d).select("row_id", "title").union(_values(spark, TITLES, "title").select(-F.col("n"), "title")).select("row_id", X.title_cleaned(F.col("title")).alias("clean"))


def location_clean(spark, d):
    return _job(spark, d).select("row_id", X.location_cleaned(F.col("location")).alias("clean"))


def company_clean(spark, d):
    return _job(spark, d).select("row_id", "company_name").union(_values(spark, COMPANIES, "c").select(-F.col("n"), "c")).select("row_id", X.company_cleaned(F.col("company_name")).alias("clean"))


def duration_text(spark, d):
    return _values(spark, SECONDS, "s", "double").select("n", X.duration(F.col("s")).alias("text"))


def timestamp_iso(spark, d):
    return table(spark, d, "documents").select("doc_id", X.timestamp_text(F.col("captured_at")).alias("at"))


def infer_employment(spark, d):
    return _texts(spark, d).select("id", infer.employment_type(F.col("text")).alias("label"))


def infer_remote(spark, d):
    return _texts(spark, d).select("id", infer.remote_type(F.col("text")).alias("label"))


def infer_experience(spark, d):
    return _texts(spark, d).select("id", infer.experience_level(F.col("text")).alias("label"))


def extract_salary(spark, d):
    return _texts(spark, d).select("id", infer.salary(F.col("text")).alias("salary"))


def extract_date(spark, d):
    return _texts(spark, d).select("id", infer.date_text(F.col("text")).alias("date"))


def extract_location(spark, d):
    return _texts(spark, d).select("id", infer.location_text(F.col("text")).alias("location"))


def parse_dates(spark, d):
    rows = _job(spark, d).select("row_id", "date_posted").union(_values(spark, DATES, "v").select(-F.col("n"), "v"))
    return rows.select("row_id", F.date_format(infer.parsed_date(F.col("date_posted")), "yyyy-MM-dd HH:mm:ss").alias("at"))


def normalise_job_fields(spark, d):
    return quality.normalised(_job(spark, d)).select("row_id", *FIELDS)


def quality_score(spark, d):
    return _job(spark, d).select("row_id", quality.score().alias("score"))


def quality_bands(spark, d):
    return quality.batch_quality(_job(spark, d))


def field_completeness(spark, d):
    return quality.completeness(_job(spark, d))


def _checked(spark, d):
    base = _job(spark, d).select("row_id", *FIELDS)
    lit = lambda name, vals, k: _values(spark, vals, name).select((-F.col("n") - k).alias("row_id"), *[F.col(f) if f == name else F.lit(None).cast("string").alias(f) for f in FIELDS])
    return quality.validated(base.union(lit("title", TITLES, 1000)).union(lit("description", LONG, 2000)).union(lit("application_url", URLS, 3000)))


def validation_split(spark, d):
    return _checked(spark, d).select("row_id", "is_valid", F.array_join("validation_errors", "|").alias("errors"), F.array_join("validation_warnings", "|").alias("warnings"))


def error_histogram(spark, d):
    return quality.histogram(_checked(spark, d), "validation_errors")


def warning_histogram(spark, d):
    return quality.histogram(_checked(spark, d), "validation_warnings")


def hash_keys(spark, d):
    return _job(spark, d).select("row_id", dedup.url_hash().alias("url_hash"), dedup.content_hash().alias("content_hash"), dedup.title_hash().alias("title_hash"))


def dedup_content(spark, d):
    return dedup.deduplicated(_job(spark, d), "content").select("row_id")


def dedup_title(spark, d):
    return dedup.deduplicated(_job(spark, d), "title").select("row_id")


def dedup_url(spark, d):
    return dedup.deduplicated(_job(spark, d), "url").select("row_id")


def dedup_hybrid(spark, d):
    return dedup.deduplicated(_job(spark, d), "hybrid").select("row_id", "has_title_duplicate")


def dedup_hybrid_keep_missing(spark, d):
    return dedup.deduplicated(_job(spark, d), "hybrid", keep_missing_urls=True).select("row_id", "has_title_duplicate")


def dedup_identifier(spark, d):
    return dedup.deduplicated(_job(spark, d), "identifier").select("row_id")


def dedup_stats(spark, d):
    return dedup.dedup_stats(_job(spark, d))


def dup_analysis(spark, d):
    return dedup.duplicate_analysis(_job(spark, d))


def dup_by_company(spark, d):
    return dedup.duplicates_by_company(_job(spark, d))


def similar_titles(spark, d):
    return dedup.similar_titles(_job(spark, d))


def title_groups(spark, d):
    return dedup.title_groups(_job(spark, d))


def similar_titles_capped(spark, d):
    """The comparison of pairs cut to the first 500 records, as a trial run has it."""
    return dedup.similar_titles(_job(spark, d), cap=500)


def similar_titles_top(spark, d):
    return dedup.top_similar(dedup.similar_titles(_job(spark, d)))


def listing_detail_merge(spark, d):
    job = _job(spark, d)
    listing = job.filter("extraction_method = 'http'").select("row_id", "application_url", "title", "location", "department")
    firsts = dedup.keep_first(job.filter("extraction_method <> 'http' and application_url <> ''"), F.col("application_url"), "row_id")
    return report.merged_details(listing.filter("application_url <> ''"), firsts.select("application_url", "title", "location", "department", "description"), "application_url", ["title", "location", "department"])


def resume_anti(spark, d):
    sites = table(spark, d, "site_result")
    return report.pending(table(spark, d, "portal").select(F.col("portal_url").alias("url")), sites.filter("success"), "url")


def resume_semi(spark, d):
    sites = table(spark, d, "site_result")
    return report.known(table(spark, d, "portal").select(F.col("portal_url").alias("url")), sites.filter("success"), "url")


def snapshot_diff(spark, d):
    job = _job(spark, d).filter("application_url <> ''").select("application_url", "extraction_method")
    return job.filter("extraction_method = 'api'").select("application_url").exceptAll(job.filter("extraction_method = 'http'").select("application_url"))


def union_batches(spark, d):
    job = _job(spark, d)
    got = report.union_batches(job.filter("extraction_method = 'api'").select("row_id", "title"), job.filter("extraction_method = 'http'").select("row_id", "location"))
    return got.select("row_id", "title", "location")


def paging_stop(spark, d):
    pages = table(spark, d, "events").select(F.col("event_type").alias("site"), F.floor(F.col("event_id") / 50).cast("long").alias("page_no"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"))
    return report.paging_stop(pages, "site", "page_no", "url").groupBy("site").agg(F.count(F.lit(1)).alias("n_rows"), F.max("page_no").alias("last_page"))


def chunks(spark, d):
    return report.chunked(table(spark, d, "site_result").select("result_id"), "result_id", 25).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("result_id").alias("first_id"))


def method_cascade(spark, d):
    return report.cascade(table(spark, d, "site_result"), F.coalesce("success", F.lit(False)) & (F.col("pages_scraped") > 0))


def run_stats(spark, d):
    return report.run_stats(table(spark, d, "site_result"))


def method_pivot(spark, d):
    return report.method_pivot(table(spark, d, "site_result"))


def failed_sites(spark, d):
    return report.failed_sites(table(spark, d, "site_result"))


def site_categories(spark, d):
    return report.categories(table(spark, d, "site_result"), _job(spark, d), AS_OF)


def category_summary(spark, d):
    return report.category_summary(site_categories(spark, d))


def coverage_rollup(spark, d):
    job = _job(spark, d)
    unique = dedup.deduplicated(job, "hybrid")
    return report.coverage(job, unique, quality.validated(unique).filter("is_valid"))


def junk_filter(spark, d):
    cases = spark.createDataFrame([(-1, "Email", "https://a.b/1"), (-2, "Clerk", "mailto:x@y.z"), (-3, "Clerk", "https://WA.me/1"), (-4, "Emailer", "https://a.b/2")], "row_id long, title string, application_url string")
    return report.junk_removed(_job(spark, d).select("row_id", "title", "application_url").union(cases)).select("row_id")


def fingerprint_summary(spark, d):
    return report.fingerprint_summary(table(spark, d, "fingerprint"))


def fingerprint_rank(spark, d):
    return report.ranked_fingerprints(table(spark, d, "fingerprint"))


def signal_counts(spark, d):
    return report.signal_counts(table(spark, d, "fingerprint")).select("signal", "n", "pages")


def fingerprint_score(spark, d):
    fp = detect.fingerprint(F.col("description_html"), F.lit(None).cast("string"))
    return _job(spark, d).filter("description_html is not null").select("row_id", fp.alias("f")).select("row_id", "f.is_match", "f.confidence_score", F.array_join("f.signals", "|").alias("signals"))


def site_detect(spark, d):
    s = detect.site_signals(F.col("portal_url"), F.col("description_html"))
    return _job(spark, d).select("row_id", F.array_join(s, "|").alias("signals"), (F.size(s) >= 2).alias("is_match"))


def page_endpoints(spark, d):
    """Endpoint-like strings of every page, found or not."""
    pages = _job(spark, d).filter("description_html is not null").select("row_id", "portal_url", "description_html")
    case = "<script>var a = '/api/v1/x', b = \"/SearchJobs/2\";</script><a href=\"/api/job/3\">'PublicReports/4' 'https://o.example/api/jobs/5'"
    pages = pages.union(spark.createDataFrame([(-1, "https://h.example/x/y", case)], pages.schema))
    found, scripts = detect.endpoints(F.col("portal_url"), F.col("description_html")), detect.script_endpoints(F.col("description_html"))
    return pages.select("row_id", F.array_join(found, "|").alias("endpoints"), F.array_join(F.array_sort(scripts), "|").alias("scripts"))


def hidden_params(spark, d):
    return detect.parameters(table(spark, d, "request_log"), "request_id", "url")


def api_requests(spark, d):
    return detect.api_requests(table(spark, d, "request_log"))


def requests_by_host(spark, d):
    return detect.requests_by_host(table(spark, d, "request_log"))


def recommendations(spark, d):
    fp = table(spark, d, "fingerprint").select(F.col("fingerprint_id").alias("url"), F.col("api_endpoints").alias("apis"), F.filter("api_endpoints", lambda x: F.contains(x, F.lit("json"))).alias("exports"), F.lit(False).alias("graphql"), F.array().cast("array<string>").alias("params"))
    return report.recommendations(fp).select("url", F.array_join("messages", "|").alias("messages"))


def _facets(spark, d):
    """The facets of the hand-made pages and of all captured ones (these have negative numbers)."""
    pages = _values(spark, cases.FACETS, "html").union(_job(spark, d).filter("description_html is not null").select((-F.col("row_id") - 1).alias("n"), "description_html"))
    return pages.select("n", dom.page_facets(F.col("html")).alias("m"))


def facet_options(spark, d):
    found = _facets(spark, d).select("n", detect.facet_options(F.col("m")).alias("facets"))
    return found.select("n", F.explode("facets").alias("facet", "options")).select("n", "facet", F.array_join(F.transform("options", lambda o: o["text"]), "|").alias("texts"))


def facet_rank(spark, d):
    return detect.ranked_facets(_facets(spark, d).select("n", F.col("m").alias("facets")), "n")


def facet_summary(spark, d):
    pages = _job(spark, d).filter("description_html is not null").select(dom.page_facets(F.col("description_html")).alias("facets"), detect.total_visible(F.col("description")).alias("total"))
    return detect.facet_summary(pages)


def url_candidates(spark, d):
    return detect.url_candidates(table(spark, d, "supplier").select("s_name"), "s_name")


def html_text_only(spark, d):
    return _job(spark, d).filter("description_html is not null").select("row_id", dom.text_only(F.col("description_html")).alias("text"))


def html_clean(spark, d):
    pages = _job(spark, d).filter("description_html is not null").select("row_id", dom.html_parts(F.col("description_html")).alias("p"))
    return pages.select("row_id", extract.tidy(F.col("p.text")).alias("text"), "p.html", "p.error")


def html_description(spark, d):
    return _job(spark, d).filter("description_html is not null").select("row_id", extract.tidy(dom.description_text(F.col("description_html"))).alias("text"))


def html_links(spark, d):
    return extract.anchors(_job(spark, d), "description_html", ["row_id"], pattern=r"^/[a-z]")


def listing_jobs(spark, d):
    """Openings of the hand-made listing pages and of all captured pages, whichever of them are listings."""
    made = _values(spark, cases.LISTINGS, "html").select("n", F.lit("https://base.example/a/b/").alias("u"), "html")
    pages = _job(spark, d).filter("description_html is not null").select((-F.col("row_id") - 1).alias("n"), "portal_url", "description_html")
    return extract.listing_rows(made.union(pages), "u", "html", ["n"])


def page_cases(spark, d):
    """What the rules of a detail page give on hand-made pages."""
    pages = _values(spark, cases.DETAILS, "html").withColumn("u", F.concat(F.lit("https://jobs.acme.example/JobDetail/"), F.col("n") + 1000))
    return extract.job_data(pages, "u", "html", ["n"]).select("n", "job_id", "title", "location", "date_posted", "employment_type", "department", "company_name", (F.length("description") > 100).alias("described"))


def html_cases(spark, d):
    pages = _values(spark, cases.MARKUP, "html").select("n", dom.html_parts(F.col("html")).alias("p"), dom.text_only(F.col("html")).alias("plain"), dom.description_text(F.col("html")).alias("description"))
    return pages.select("n", "p.text", "p.html", "p.error", "plain", "description")


def sql_functions(spark, d):
    """The registered functions, called by name."""
    register.register(spark)
    _values(spark, cases.LISTINGS, "html").createOrReplaceTempView("sw_listings")
    return spark.sql("SELECT l.n, j.title, j.application_url, sw_text_only(l.html) AS text FROM sw_listings l, LATERAL sw_listed_jobs(l.html, 'https://base.example/a/b/') j")


def _api_pages(spark):
    return spark.createDataFrame(list(cases.API_PAGES), "site string, page long, n long, total long")


def api_paging_total(spark, d):
    return report.pages_by_total(_api_pages(spark), "site", "page", "total", 10)


def api_paging_empty(spark, d):
    return report.pages_until_empty(_api_pages(spark), "site", "page")


def input_cap(spark, d):
    return report.first_rows(table(spark, d, "site_result").select("result_id", "url"), "result_id", 25)


def recon_summary(spark, d):
    named = detect.parameters(table(spark, d, "request_log"), "url", "url").groupBy("url", "kind").agg(F.collect_set("parameter").alias("names"))
    params = named.groupBy(F.col("url").alias("u")).agg(F.map_from_entries(F.collect_list(F.struct("kind", "names"))).alias("params"))
    fp = table(spark, d, "fingerprint").select("url", F.col("api_endpoints").alias("apis")).withColumn("params", F.lit(None).cast("map<string,array<string>>"))
    return report.recon_summary(fp.union(params.select("u", F.array().cast("array<string>"), "params")))


def io_round_trip(spark, d):
    """All records through JSON lines, a JSON array and CSV and back: (format, row_id, hash of the fields)."""
    job = _job(spark, d).select("row_id", *FIELDS)
    plain = job.select("row_id", *[F.regexp_replace(f, r"[\r\n]", " ").alias(f) for f in FIELDS])  # CSV lines
    at = scratch(spark)
    io.write_jsonl(job, f"{at}/jsonl")
    io.write_json(job, f"{at}/json")
    io.write_csv(plain.filter("row_id % 2 = 0"), f"{at}/csv", plain.filter("row_id % 2 = 1").drop("department").withColumn("extra", F.lit("x")))
    kinds = ", ".join(["row_id long", *[f"{f} string" for f in FIELDS]])
    back = spark.read.option("header", True).option("escape", '"').option("emptyValue", "").csv(f"{at}/csv")
    size = lambda df: df.select("row_id", *[F.coalesce(F.length(f), F.lit(0)).alias(f) for f in FIELDS]).select("row_id", sum((F.col(f) for f in FIELDS), F.lit(0)).cast("long").alias("chars"))
    out = [size(io.read_jsonl(spark, f"{at}/jsonl", kinds)).withColumn("format", F.lit("jsonl")), size(io.read_json(spark, f"{at}/json", kinds)).withColumn("format", F.lit("json"))]
    csv = back.select(F.col("row_id").cast("long").alias("row_id"), F.col("title"), F.col("department"), F.col("extra"))
    return out[0].union(out[1]).union(csv.select("row_id", (F.coalesce(F.length("title"), F.lit(0)) + F.coalesce(F.length("department"), F.lit(0)) + F.coalesce(F.length("extra"), F.lit(0))).cast("long"), F.lit("csv")))


def stream_new_records(spark, d):
    """The records as a stream, in one run to its end: the first of each address; the watermark is wider than the table's span."""
    src = scratch(spark)
    job = _job(spark, d).select("row_id", "application_url").withColumn("captured_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("row_id")))
    job.coalesce(1).write.parquet(f"{src}/in")
    stream = spark.readStream.schema("row_id long, application_url string, captured_at timestamp").parquet(f"{src}/in")
    got = incremental.new_records(stream, delay="36500 days")
    got.writeStream.format("parquet").option("path", f"{src}/out").option("checkpointLocation", f"{src}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("url_hash string").parquet(f"{src}/out").select("url_hash")


def stream_windows(spark, d):
    src = scratch(spark)
    rows = table(spark, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    rows.write.parquet(f"{src}/in")
    stream = spark.readStream.schema("event_type string, ts timestamp").parquet(f"{src}/in")
    got = incremental.windowed_counts(stream, "ts", "event_type", delay="36500 days")
    name = "sw_" + src.rpartition("/")[2].replace("-", "_")
    got.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", f"{src}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def page_records(spark, d):
    return extract.job_data(_job(spark, d).filter("description_html is not null"), "application_url", "description_html", ["row_id"])


def api_json_parse(spark, d):
    return jsonapi.records(_values(spark, BODIES, "body"), "body", ["n"])


def api_json_parse_fixed(spark, d):
    return jsonapi.records(_values(spark, BODIES, "body"), "body", ["n"], compat=False)


def api_json_second(spark, d):
    return jsonapi.second_records(_values(spark, BODIES, "body").withColumn("base", F.lit("https://b.example/x")), "body", "base", ["n"])


def event_props(spark, d):
    v = jsonapi.parsed(F.col("props"))
    return table(spark, d, "events").select("event_id", jsonapi.get(v, "$.k", "bigint").alias("k"))


def jsonld_parse(spark, d):
    rows = _values(spark, LD, "s").withColumn("v", jsonapi.json_ld(F.array("s"))).filter("v is not null")
    return rows.select("n", jsonapi.posting(F.col("v")).alias("p")).select("n", "p.*")


def pipeline_flagship(spark, d):
    """The whole batch: the checked rows with their score."""
    return pipeline.run(_job(spark, d)).checked.select("row_id", "is_valid", "quality_score", "has_title_duplicate")


def _public() -> dict:
    skip = {"annotations"}
    return {k: v for k, v in globals().items() if callable(v) and not k.startswith("_") and getattr(v, "__module__", "") == __name__ and k not in skip}


def queries() -> dict:
    return {k: v for k, v in _public().items() if k not in ("queries",)}
