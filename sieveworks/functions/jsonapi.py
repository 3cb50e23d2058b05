"""Records from JSON bodies and JSON-LD as VARIANT expressions; no UDF. Malformed JSON gives no record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import strip

# Under which keys the list of records stands, and field aliases, first match wins.
LIST_KEYS = ("jobs", "data", "requisitionList", "jobPostings", "results")
ID_KEYS = ("id", "jobId", "requisitionId", "job_id", "Id")
TITLE_KEYS = ("title", "jobTitle", "positionTitle", "Title")
URL_KEYS = ("url", "applyUrl", "jobUrl", "link")
ALIASES = {
    "company_name": ("company", "companyName", "employer"),
    "location": ("location", "jobLocation", "city", "primaryLocation"),
    "description": ("description", "jobDescription", "summary"),
    "date_posted": ("datePosted", "postedDate", "date", "postingDate"),
    "employment_type": ("employmentType", "jobType", "type"),
    "experience_level": ("experienceLevel", "level", "seniorityLevel"),
    "remote_type": ("remote", "remoteType", "workLocation"),
    "department": ("department", "team", "category"),
    "salary_range": ("salary", "salaryRange", "compensation"),
}
SECOND_LIST_KEYS = ("jobs", "results", "items")
SECOND_ALIASES = {
    "job_id": ("id", "jobId", "job_id"),
    "title": ("title", "jobTitle", "name"),
    "description": ("description", "jobDescription"),
    "description_html": ("descriptionHtml", "description_html"),
    "location": ("location", "city", "office"),
    "department": ("department", "category", "team"),
    "employment_type": ("employmentType", "type"),
    "remote_type": ("remoteType", "workType"),
    "date_posted": ("postedDate", "datePosted", "created"),
    "company_name": ("company",),
}


def parsed(c: Column) -> Column:
    return F.try_parse_json(c)


def get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def kind(v: Column, path: str = "$") -> Column:
    """First word of the type at a path: OBJECT, ARRAY, STRING, BIGINT, ...; NULL where absent."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, path, "variant")), r"^(\w+)", 1)


def truthy(v: Column, path: str) -> Column:
    """A scalar at a path as text; NULL for absent, null, '', false, 0 and containers."""
    s = get(v, path)
    ok = ~kind(v, path).isin("OBJECT", "ARRAY", "VOID") & (s != "") & ~(kind(v, path).isin("BOOLEAN") & (s == "false")) & ~(kind(v, path).isin("BIGINT", "DECIMAL", "DOUBLE") & s.rlike(r"^-?0(\.0+)?$"))
    return F.when(ok, s)


def alias(v: Column, names: tuple[str, ...]) -> Column:
    """The first alias that is a non-empty string, or an object's name, value or text; other scalars are passed over."""
    out = []
    for n in names:
        own = F.when(kind(v, f"$.{n}") == "STRING", get(v, f"$.{n}"))
        inner = F.when(kind(v, f"$.{n}") == "OBJECT", F.coalesce(*[F.when(kind(v, f"$.{n}.{k}") == "STRING", F.nullif(get(v, f"$.{n}.{k}"), F.lit(""))) for k in ("name", "value", "text")]))
        out.append(F.nullif(F.coalesce(own, inner), F.lit("")))
    return strip(F.coalesce(*out))


def items(v: Column, keys: tuple[str, ...] = LIST_KEYS) -> Column:
    """ARRAY<VARIANT> of the records: the first list-valued key, a bare array, or a single object with an id or title."""
    lists = [F.when(kind(v, f"$.{k}") == "ARRAY", F.try_variant_get(v, f"$.{k}", "array<variant>")) for k in keys]
    bare = F.when(kind(v) == "ARRAY", F.try_variant_get(v, "$", "array<variant>"))
    single = F.when((kind(v) == "OBJECT") & F.coalesce(*[get(v, f"$.{k}") for k in ("id", "jobId", "title")]).isNotNull(), F.array(v))
    return F.coalesce(*lists, bare, single)


def records(df: DataFrame, body: str, keep: list[str], compat: bool = True) -> DataFrame:
    """A row per record of each body with a title. compat: without an id there is no address either, as the original behaves."""
    rows = df.select(*keep, F.explode(items(parsed(F.col(body)))).alias("v")).filter(kind(F.col("v")) == "OBJECT")
    v = F.col("v")
    jid = F.coalesce(*[truthy(v, f"$.{k}") for k in ID_KEYS])
    url = F.coalesce(*[truthy(v, f"$.{k}") for k in URL_KEYS], F.when(jid.isNotNull(), F.concat(F.lit("/JobDetail/"), jid)))
    title = F.coalesce(*[truthy(v, f"$.{k}") for k in TITLE_KEYS])
    out = rows.select(*keep, strip(title).alias("title"), jid.alias("job_id"), *[alias(v, n).alias(f) for f, n in ALIASES.items()], (F.when(jid.isNotNull(), url) if compat else url).alias("application_url"))
    return out.filter(F.col("title") != "")


def second_records(df: DataFrame, body: str, base: str, keep: list[str]) -> DataFrame:
    """The other interface's shape: address built from the id under the base, else url or applyUrl."""
    rows = df.select(*keep, F.col(base).alias("base"), F.explode(items(parsed(F.col(body)), SECOND_LIST_KEYS)).alias("v")).filter(kind(F.col("v")) == "OBJECT")
    v = F.col("v")
    cols = {f: F.coalesce(*[truthy(v, f"$.{n}") for n in names]) for f, names in SECOND_ALIASES.items()}
    root = F.regexp_extract("base", r"^([a-zA-Z][\w+.\-]*://[^/?#]*)", 1)
    url = F.when(cols["job_id"].isNotNull(), F.concat(root, F.lit("/JobDetail/"), cols["job_id"])).otherwise(F.coalesce(truthy(v, "$.url"), truthy(v, "$.applyUrl")))
    return rows.select(*keep, *[c.alias(f) for f, c in cols.items()], url.alias("application_url")).filter(F.col("title") != "")


def total_rows(v: Column) -> Column:
    """Stated number of rows; 0 where absent, which ends paging after one page."""
    return F.coalesce(*[get(v, f"$.{k}", "bigint") for k in ("totalJobs", "total", "count")], F.lit(0))


def json_ld(scripts: Column) -> Column:
    """VARIANT of the first JobPosting among JSON-LD scripts: object, array or @graph; malformed scripts are passed over."""
    each = F.transform(scripts, lambda s: F.try_parse_json(s))
    flat = F.flatten(F.transform(F.filter(each, lambda v: v.isNotNull()), lambda v: F.coalesce(F.when(kind(v) == "ARRAY", F.try_variant_get(v, "$", "array<variant>")), F.array(v))))
    graph = F.flatten(F.transform(flat, lambda v: F.concat(F.array(v), F.coalesce(F.when(kind(v, "$.@graph") == "ARRAY", F.try_variant_get(v, "$.@graph", "array<variant>")), F.array().cast("array<variant>")))))
    return F.try_element_at(F.filter(graph, lambda v: get(v, "$.@type") == "JobPosting"), F.lit(1))


def _amount(v: Column, path: str) -> Column:
    """A number with thousands separators; NULL for text and absent values."""
    whole = F.when(kind(v, path).isin("BIGINT", "INT"), F.format_number(get(v, path, "bigint"), 0))
    return F.coalesce(whole, F.when(kind(v, path).isin("DECIMAL", "DOUBLE"), F.format_number(get(v, path, "double"), 2)))


def posting(v: Column) -> Column:
    """STRUCT of the fields of a JobPosting. Several places: locality and region only, joined by a bar."""
    join = lambda cols: F.nullif(F.array_join(F.filter(F.array(*cols), lambda x: x != ""), ", "), F.lit(""))
    a = "$.jobLocation.address"
    one = F.coalesce(F.when(kind(v, a) == "OBJECT", join([get(v, f"{a}.{k}") for k in ("addressLocality", "addressRegion", "addressCountry")])), F.when(kind(v, a) == "STRING", get(v, a)))
    many = F.transform(F.try_variant_get(v, "$.jobLocation", "array<variant>"), lambda x: join([get(x, f"$.address.{k}") for k in ("addressLocality", "addressRegion")]))
    place = F.when(kind(v, "$.jobLocation") == "OBJECT", one).when(kind(v, "$.jobLocation") == "ARRAY", F.array_join(F.array_compact(many), " | "))
    emp = F.when(kind(v, "$.employmentType") == "ARRAY", F.array_join(F.try_variant_get(v, "$.employmentType", "array<string>"), ", ")).otherwise(get(v, "$.employmentType"))
    cur = F.coalesce(get(v, "$.baseSalary.currency"), F.lit("$"))
    low, high, flat = _amount(v, "$.baseSalary.value.minValue"), _amount(v, "$.baseSalary.value.maxValue"), _amount(v, "$.baseSalary.value")
    unit = F.coalesce(get(v, "$.baseSalary.value.unitText"), F.lit(""))
    pay = F.when(low.isNotNull() & high.isNotNull(), F.trim(F.concat(cur, low, F.lit(" - "), cur, high, F.lit(" "), unit))).when(low.isNotNull(), F.trim(F.concat(cur, low, F.lit("+ "), unit))).when(flat.isNotNull(), F.concat(cur, flat))
    named = lambda p: F.when(kind(v, p) == "OBJECT", get(v, f"{p}.name")).when(kind(v, p) == "STRING", get(v, p))
    return F.struct(
        F.coalesce(F.nullif(get(v, "$.title"), F.lit("")), get(v, "$.name")).alias("title"), get(v, "$.description").alias("description"), get(v, "$.datePosted").alias("date_posted"),
        get(v, "$.validThrough").alias("valid_through"), emp.alias("employment_type"), F.nullif(place, F.lit("")).alias("location"),
        F.when(get(v, "$.jobLocationType") == "TELECOMMUTE", "Remote").alias("remote_type"), pay.alias("salary_range"), named("$.hiringOrganization").alias("company_name"),
        named("$.experienceRequirements").alias("experience_level"), F.coalesce(F.nullif(get(v, "$.industry"), F.lit("")), get(v, "$.occupationalCategory")).alias("department"),
    )
