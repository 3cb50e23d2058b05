"""Detection of a vendor's sites and mining of captured pages: scores, endpoints, parameters, facets, requests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import text
from ..functions.url import part


@dataclass(frozen=True)
class Vendor:
    """What tells a vendor's pages: its name in scripts and its hosts."""

    name: str = "hirewell"
    host: str = "hirewell.example"

    def site_patterns(self) -> dict[str, str]:
        """Signal -> pattern, in the order of evaluation, on lower-case text."""
        n, h = self.name, self.host.replace(".", r"\.")
        return {
            "js_namespace": rf"window\.{n}\s*=|{n}\.careerportal|{n}config|{n}careerportal",
            "form_patterns": rf"joboffset|jobsearchinterval|__{n}_redirect_|jobrecordsperpage",
            "data_attributes": rf"data-{n}-",
            "cdn_references": rf"{h}/(?:scripts|content|css)/",
            "css_classes": rf"{n}-|jobinfo|jobdescription|banner__text__title",
            "api_endpoints": r"/publicreports/|/api/jobsearch|/services/careerportal|/searchjobsdata",
        }


def site_signals(url: Column, html: Column, vendor: Vendor = Vendor()) -> Column:
    """Array of the signals found, in order; two or more make a match."""
    low = F.lower(text(html))
    checks = [F.when(F.contains(F.lower(text(url)), F.lit(vendor.host)), F.lit("explicit_url"))]
    checks += [F.when(low.rlike(p), F.lit(k)) for k, p in vendor.site_patterns().items()]
    return F.array_compact(F.array(*checks))


def fingerprint(html: Column, cookies: Column, vendor: Vendor = Vendor()) -> Column:
    """STRUCT<is_match, confidence_score, signals>: weighted signals, match at 40, capped at 100. The form signal is case-sensitive."""
    h, low, n, host = text(html), F.lower(text(html)), vendor.name, vendor.host
    e = host.replace(".", r"\.")
    rules = [
        ("js_global", 40, h.rlike(rf"window\.{n}|var\s+{n}\s*=")),
        ("cdn_host", 35, F.contains(h, F.lit(host)) | F.contains(h, F.lit(f"{n}cdn."))),
        ("api_pattern", 30, low.rlike(rf"/publicreports/\d+/json|/searchjobsdata|/careerportal/searchjobs|{e}.*api")),
        ("paging", 25, F.contains(h, F.lit("jobOffset")) & (F.contains(h, F.lit("jobRecordsCount")) | F.contains(h, F.lit("jobSearchInterval")))),
        ("cookie", 20, F.lower(text(cookies)).rlike(rf"avsession|{n}")),
        ("form", 15, F.contains(h, F.lit("__eventtarget")) & F.contains(h, F.lit("__eventargument")) & F.contains(low, F.lit("asp.net"))),
        ("data_attribute", 10, h.rlike(rf"data-job-id|data-requisition-id|data-{n}")),
        ("css_class", 5, h.rlike(rf"{n}-container|{n}-job|career-portal")),
    ]
    score = sum((F.when(c, w).otherwise(0) for _, w, c in rules[1:]), F.when(rules[0][2], rules[0][1]).otherwise(0))
    return F.struct((score >= 40).alias("is_match"), F.least(F.lit(100), score).alias("confidence_score"), F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, _, c in rules])).alias("signals"))


def endpoints(url: Column, html: Column, most: int = 5) -> Column:
    """Quoted endpoint-like strings: of the first ``most`` the absolute ones, relative to the page's host."""
    base = F.concat(part(url, 1), F.lit("://"), part(url, 2))
    found = F.slice(F.regexp_extract_all(text(html), F.lit(r"""["']([^"']*(?:SearchJobs|PublicReports|api/job)[^"']*)["']"""), F.lit(1)), 1, most)
    full = F.transform(found, lambda x: F.when(F.startswith(x, F.lit("/")), F.concat(base, x)).when(F.startswith(x, F.lit("http")), x))
    return F.slice(F.array_compact(full), 1, 10)


def script_endpoints(html: Column) -> Column:
    """Distinct quoted /api/ strings within scripts."""
    scripts = F.regexp_extract_all(text(html), F.lit(r"(?is)<script[^>]*>(.*?)</script>"), F.lit(1))
    each = F.transform(scripts, lambda s: F.regexp_extract_all(s, F.lit(r"""["'`]([^"'`\s]*/api/[^"'`\s]*)["'`]"""), F.lit(1)))
    return F.array_distinct(F.flatten(each))


# Words in a parameter's name -> its kind, in order.
PARAMETER_KINDS = {
    "filters": r"location|department|type|category|filter",
    "sorting": r"sort|order|orderby",
    "pagination": r"offset|limit|page|size",
    "query": r"search|query|q|keyword",
}


def parameters(df: DataFrame, key: str, body: str) -> DataFrame:
    """(key, kind, parameter): distinct query parameters named in a text, by kind; unknown kinds are left out."""
    names = df.select(key, F.explode(F.array_distinct(F.regexp_extract_all(text(F.col(body)), F.lit(r"[?&]([a-zA-Z_]+)="), F.lit(1)))).alias("parameter"))
    kind = None
    for k, p in PARAMETER_KINDS.items():
        hit = F.lower("parameter").rlike(p)
        kind = F.when(hit, k) if kind is None else kind.when(hit, k)
    return names.withColumn("kind", kind).filter("kind is not null").select(key, "kind", "parameter")


def api_requests(log: DataFrame) -> DataFrame:
    """Captured requests to interfaces, by address."""
    return log.filter(F.lower("url").rlike(r"/api/|/services/|/rest/|/graphql")).select("request_id", "url", F.upper("method").alias("method"))


def requests_by_host(log: DataFrame) -> DataFrame:
    """(host, kind, n): requests by host and whether they go to an interface; partial sums on the map side take the skew."""
    kind = F.when(F.lower("url").rlike(r"/api/|/services/|/rest/|/graphql"), "api").otherwise("other")
    return log.groupBy(F.lower(part(F.col("url"), 2)).alias("host"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def facet_options(facets: Column) -> Column:
    """MAP name -> options without the neutral ones; names without 'filter' and underscores, technical names dropped."""
    name = lambda k: F.trim(F.replace(F.replace(F.lower(k), F.lit("filter"), F.lit("")), F.lit("_"), F.lit(" ")))
    good = lambda v: F.filter(v, lambda o: ~F.lower(F.coalesce(o["value"], F.lit(""))).isin("", "all", "*", "-1") & (F.coalesce(o["text"], F.lit("")) != ""))
    entries = F.transform(F.map_entries(facets), lambda e: F.struct(name(e["key"]).alias("key"), good(e["value"]).alias("value")))
    kept = F.filter(entries, lambda e: ~e["key"].isin("search", "sort", "pagesize", "page", "") & (F.size(e["value"]) > 0))
    return F.map_from_entries(F.filter(kept, lambda e: F.size(F.filter(kept, lambda x: x["key"] == e["key"])) == 1))


def total_visible(c: Column) -> Column:
    """The first stated number of openings between 1 and 99,999."""
    pats = (r"(\d+)\s+(?:jobs?|positions?|openings?)", r"showing\s+\d+\s+of\s+(\d+)", r"(\d+)\s+results?", r"total.*?(\d+)")
    n = [F.regexp_extract(text(c), f"(?i){p}", 1).try_cast("int") for p in pats]
    return F.coalesce(*[F.when((x > 0) & (x < 100_000), x) for x in n])


def facet_summary(pages: DataFrame, facets: str = "facets", total: str = "total") -> DataFrame:
    n = F.coalesce(F.size(facets), F.lit(0))
    return pages.agg(F.sum(n.cast("long")).alias("facets"), F.sum(F.coalesce(total, F.lit(0)).cast("long")).alias("jobs_visible"), F.count_if(n > 0).alias("sites_with_facets"))


def ranked_facets(pages: DataFrame, key: str, facets: str = "facets", k: int = 5, shown: int = 3) -> DataFrame:
    """(key, n_facets, facet, n_options): the k pages with most facets, ties by key, and the first ``shown`` facets of each by name."""
    top = pages.filter(F.size(facets) > 0).orderBy(F.desc(F.size(facets)), key).limit(k)
    entries = F.slice(F.array_sort(F.transform(F.map_entries(facets), lambda e: F.struct(e["key"].alias("facet"), F.size(e["value"]).alias("n_options")))), 1, shown)
    return top.select(key, F.size(facets).alias("n_facets"), F.explode(entries).alias("e")).select(key, "n_facets", "e.facet", "e.n_options")


# Places of a career page, by a company's name.
URL_TEMPLATES = ("https://careers.{0}.com", "https://jobs.{0}.com", "https://www.{0}.com/careers", "https://{0}.com/careers", "https://recruiting.{0}.com", "https://us-talentcommunity.{0}.com")


def url_candidates(names: DataFrame, column: str) -> DataFrame:
    """Each name with each template: an array per row, no join."""
    slug = F.regexp_replace(F.lower(F.col(column)), r"[^a-z0-9\-]+", "")
    return names.select(F.col(column), F.explode(F.array(*[F.replace(F.lit(t), F.lit("{0}"), slug) for t in URL_TEMPLATES])).alias("url"))
