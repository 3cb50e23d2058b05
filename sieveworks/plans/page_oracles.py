"""SQL for the queries on markup, JSON, streams and files: expressions where SQL has them, tables of expected rows where it can't read markup."""

from __future__ import annotations

from . import cases, oracles as O

_BASE = "'https://base.example/a/b/'"


def rows(columns: dict[str, str], *items: tuple) -> str:
    """Expected rows, written out by hand from the rules."""
    cell = lambda v: "NULL" if v is None else O.q(v) if isinstance(v, str) else repr(v).lower()
    body = ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in items)
    return f"SELECT {', '.join(f'CAST({c} AS {t}) AS {c}' for c, t in columns.items())} FROM (VALUES {body}) t({', '.join(columns)})"


def _text(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "VARCHAR")


_N = {"n": "BIGINT"}
_DETAIL = _N | _text("job_id", "title", "location", "date_posted", "employment_type", "department", "company_name") | {"described": "BOOLEAN"}
_LISTED = _N | _text("title", "application_url", "job_id", "location", "department")
_API = _N | _text("title", "job_id", "company_name", "location", "description", "date_posted", "employment_type", "experience_level", "remote_type", "department", "salary_range", "application_url")
_SECOND = _N | _text("job_id", "title", "description", "description_html", "location", "department", "employment_type", "remote_type", "date_posted", "company_name", "application_url")
_LD = _N | _text("title", "description", "date_posted", "valid_through", "employment_type", "location", "remote_type", "salary_range", "company_name", "experience_level", "department")


def _row(columns: dict[str, str], **values) -> tuple:
    return tuple(values.get(c) for c in columns)


def _api(n: int, title: str, job_id: str | None, url: str | None, **more) -> tuple:
    return _row(_API, n=n, title=title, job_id=job_id, application_url=url, **more)


def _second(n: int, job_id: str | None, title: str, url: str | None, **more) -> tuple:
    return _row(_SECOND, n=n, title=title, job_id=job_id, application_url=url, **more)


def _ld(n: int, title: str, **more) -> tuple:
    return _row(_LD, n=n, title=title, **more)


def _plain_text() -> str:
    """Scripts, styles and comments out, each tag a space, entities read, white space squeezed."""
    t = "regexp_replace(description_html, '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<![^>]*>', ' ', 'g')"
    t = f"regexp_replace({t}, '<[^<>]*>', ' ', 'g')"
    signs = (("nbsp", "chr(160)"), ("lt", "'<'"), ("gt", "'>'"), ("quot", "chr(34)"), ("copy", "'©'"), ("middot", "'·'"), ("raquo", "'»'"), ("rsaquo", "'›'"), ("#39", "chr(39)"), ("amp", "'&'"))
    for name, sign in signs:
        t = f"replace({t}, '&{name};', {sign})"
    return f"SELECT row_id, {O.squeeze(t)} AS text FROM job WHERE description_html IS NOT NULL"


def _links() -> str:
    tag = O.q(r"""(?is)<a\s[^>]*?href\s*=\s*["']?[^"'>\s]+["']?[^>]*>.*?</a>""")
    href = O.q(r"""(?i)href\s*=\s*["']?([^"'>\s]+)""")
    label = r"trim(regexp_replace(regexp_replace(a, '<[^>]*>', '', 'g'), '\s+', ' ', 'g'))"
    each = f"SELECT row_id, unnest(regexp_extract_all(coalesce(description_html, ''), {tag})) AS a FROM job"
    return f"SELECT row_id, href, label FROM (SELECT row_id, regexp_extract(a, {href}, 1) AS href, {label} AS label FROM ({each})) WHERE regexp_matches(href, '(?i)^/[a-z]') AND length(label) > 3"


def _endpoints() -> str:
    case = O.q("""<script>var a = '/api/v1/x', b = "/SearchJobs/2";</script><a href="/api/job/3">'PublicReports/4' 'https://o.example/api/jobs/5'""")
    pages = f"(SELECT row_id, portal_url AS u, description_html AS h FROM job WHERE description_html IS NOT NULL UNION ALL SELECT -1, 'https://h.example/x/y', {case})"
    quoted = O.q("""["']([^"']*(?:SearchJobs|PublicReports|api/job)[^"']*)["']""")
    inner = O.q("""["'`]([^"'`\\s]*/api/[^"'`\\s]*)["'`]""")
    full = f"list_filter(list_transform(list_slice(regexp_extract_all(h, {quoted}, 1), 1, 5), lambda x: CASE WHEN starts_with(x, '/') THEN base || x WHEN starts_with(x, 'http') THEN x END), lambda x: x IS NOT NULL)"
    scripts = f"list_sort(list_distinct(flatten(list_transform(regexp_extract_all(h, '(?is)<script[^>]*>(.*?)</script>', 1), lambda s: regexp_extract_all(s, {inner}, 1)))))"
    return f"SELECT row_id, array_to_string({full}, '|') AS endpoints, array_to_string({scripts}, '|') AS scripts FROM (SELECT *, {O.part('u', 1)} || '://' || {O.part('u', 2)} AS base FROM {pages})"


def _absolute() -> str:
    """The values are absolute, bare paths, or the literal cases; a path's dot segments don't occur."""
    v = "ltrim(coalesce(u, ''), ' ')"
    return rf"""SELECT row_id, CASE WHEN {v} = '' THEN {_BASE} WHEN {v} = 'https://' THEN {_BASE} WHEN regexp_matches({v}, '^(?i)https:') THEN 'https:' || {v}[7:] WHEN regexp_matches({v}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {v}
        WHEN starts_with({v}, '//') THEN 'https:' || {v} WHEN starts_with({v}, '/') THEN 'https://base.example' || {v} ELSE {_BASE} || {v} END AS url FROM {O._URLS}"""


def _repair() -> str:
    inner = "regexp_extract(url_decode(u), " + O.q(r"""(?i)^mailto:.*?(https?://[^\s&"'<>]+)""") + ", 1)"
    s = O.strip("coalesce(u, '')")
    return rf"""SELECT row_id, CASE WHEN starts_with(lower(u), 'mailto:') AND {inner} <> '' THEN {inner} ELSE u END AS url, nullif(regexp_extract({O.part('u', 3)}, '/([a-z]{{2}}_[A-Z]{{2}})(?:/|$)', 1), '') AS locale,
        CASE WHEN starts_with({s}, 'http') THEN {s} WHEN {s} <> '' THEN 'https://' || {s} || '/careers' ELSE '' END AS remedied FROM {O._URLS}"""


def _pipeline() -> str:
    hybrid = O._keep(O._CONTENT, O._keep(O._URL, f"({O._normalised()})"))
    ok = f"{O.present('title')} AND {O.present('application_url')} AND {O._url_error('application_url')} IS NULL"
    return f"SELECT row_id, {ok} AS is_valid, {O._SCORE} AS quality_score, count(*) OVER (PARTITION BY {O._TITLE}) > 1 AS has_title_duplicate FROM {hybrid}"


def _round_trip() -> str:
    chars = " + ".join(f"coalesce(length({f}), 0)" for f in O.FIELDS)
    csv = "coalesce(length(title), 0) + CASE WHEN row_id % 2 = 0 THEN coalesce(length(department), 0) ELSE 1 END"
    return " UNION ALL ".join(f"SELECT row_id, CAST({c} AS BIGINT) AS chars, '{k}' AS format FROM job" for k, c in (("jsonl", chars), ("json", chars), ("csv", csv)))


def _facet_summary() -> str:
    patterns = (r"(\d+)\s+(?:jobs?|positions?|openings?)", r"showing\s+\d+\s+of\s+(\d+)", r"(\d+)\s+results?", r"total.*?(\d+)")
    found = ", ".join(f"TRY_CAST(nullif(regexp_extract(coalesce(description, ''), '(?i){p}', 1), '') AS INTEGER) AS x{i}" for i, p in enumerate(patterns))
    visible = "coalesce(" + ", ".join(f"CASE WHEN x{i} > 0 AND x{i} < 100000 THEN x{i} END" for i in range(len(patterns))) + ")"
    boxes = r"len(regexp_extract_all(description_html, '(?i)<select[^>]*\s(?:name|id)\s*=|data-(?:facet|filter)\s*='))"
    return f"SELECT CAST(sum(f) AS BIGINT) AS facets, CAST(sum(coalesce({visible}, 0)) AS BIGINT) AS jobs_visible, count(*) FILTER (f > 0) AS sites_with_facets FROM (SELECT {boxes} AS f, {found} FROM job WHERE description_html IS NOT NULL)"


def oracle_sql() -> dict[str, str]:
    pages = "(VALUES " + ", ".join(f"('{s}', {p}, {n}, {'NULL' if t is None else t})" for s, p, n, t in cases.API_PAGES) + ") p(site, page, n, total)"
    pages = f"SELECT site, CAST(page AS BIGINT) AS page, CAST(n AS BIGINT) AS n, CAST(total AS BIGINT) AS total FROM {pages}"
    listed = "Harbour Clerk Oslo Ops no link Buyer - Apply Now"
    linked = "Night clerk About us all abc Day buyer"
    api = [_api(1, "Zero", None, None), _api(2, "B", "x1", "/JobDetail/x1"), _api(4, "C", "9", "/JobDetail/9", salary_range="10k"), _api(5, "Single", "3", "/JobDetail/3"), _api(1, "A", "7", "/JobDetail/7", company_name="Acme", location="Oslo")]
    return {
        "html_text_only": _plain_text(), "html_links": _links(), "page_endpoints": _endpoints(), "url_absolute": _absolute(), "url_repair": _repair(), "pipeline_flagship": _pipeline(), "io_round_trip": _round_trip(), "facet_summary": _facet_summary(),
        "page_cases": rows(
            _DETAIL, (1, "1001", "Harbour Clerk", "Oslo, Norway", "3-Mar-2017", "Full Time", None, "Acme", True), (2, "1002", "Night Buyer", "Bergen", "01/27/2026", None, None, "Acme", False),
            (3, "1003", "Planner", "Lyon, France", "2024-02-01", None, "Fleet", "Acme", False), (4, "1004", "Welder", "Kiel, DE", "2024-05-06", None, None, "Acme", False), (5, "1005", "Tram Driver", "", None, None, None, "Acme", False),
            (6, "1006", "Cook", "", None, None, None, "Acme", False), (7, "1007", "Porter", "", None, None, None, "Acme", False), (8, "1008", "", "", None, None, None, "Acme", False),
        ),
        "listing_jobs": rows(
            _LISTED, (1, "Harbour Clerk", "https://base.example/job/1", None, "Oslo", "Ops"), (1, "Buyer", "https://base.example/a/b/b/2?x=1", None, "", None), (2, "Night clerk", "https://base.example/careers/JobDetail/Clerk/12345", "12345", "", None),
            (2, "Daybuyer", "https://o.example/position/8", None, "", None), (3, "Cook", "https://base.example/a/3", None, "", None), (4, "Porter", "https://base.example/a/b/4", None, "", None),
        ),
        "html_cases": rows(
            _N | _text("text", "html", "error", "plain", "description"),
            (1, "One\nTwo\nlines", "<div><p>One</p><p>Two<br/>lines</p></div>", None, "Menu One Two lines Foot", "One\nTwo\nlines"), (2, "C", '<p style="color:red">C</p>', None, "A B C", "C"), (3, "B", '<div class="main">B</div>', None, "A B S", "B"),
            (4, "one\ntwo & three", "<ul><li>one</li><li>two &amp; three</li></ul>", None, "one two & three", "one\ntwo & three"), (5, "x", "<p>x</p>", None, "x", "x"), (6, "a\ntail", "<p>a</p>tail", None, "a tail", "a\ntail"),
            (7, "a   b\n c", '<p>a b c</p><hr/><img src="x"/>', None, "a b c", "a   b\n c"), (8, "", "", None, "", ""),
        ),
        "facet_options": rows(_N | _text("facet", "texts"), (1, "city", "Oslo|Kiel"), (2, "team", "ops|fleet"), (2, "kind", "Full")),
        "facet_rank": rows(_N | {"n_facets": "INTEGER", "facet": "VARCHAR", "n_options": "INTEGER"}, (1, 2, "filter_city", 3), (1, 2, "sort", 1), (2, 2, "kind", 1), (2, 2, "team", 2), (3, 1, "page", 1)),
        "sql_functions": rows(
            _N | _text("title", "application_url", "text"), (1, "Harbour Clerk", "https://base.example/job/1", listed), (1, "Buyer - Apply Now", "https://base.example/a/b/b/2?x=1", listed), (2, "Night clerk", "https://base.example/careers/JobDetail/Clerk/12345", linked),
            (2, "Daybuyer", "https://o.example/position/8", linked), (3, "Cook", "https://base.example/a/3", "Cook more"), (4, "Porter", "https://base.example/a/b/4", "Porter No"),
        ),
        "api_paging_total": f"WITH p AS ({pages}), e AS (SELECT site, max(coalesce(total, 0)) AS t, min(page) FILTER (n = 0) AS stop FROM p GROUP BY 1) SELECT p.* FROM p JOIN e USING (site) WHERE (page = 1 OR (page - 1) * 10 < t) AND (stop IS NULL OR page < stop)",
        "api_paging_empty": f"WITH p AS ({pages}), x AS (SELECT *, n = 0 AND lead(n) OVER (PARTITION BY site ORDER BY page) = 0 AS dry FROM p), s AS (SELECT site, min(page) FILTER (dry) AS stop FROM x GROUP BY 1) SELECT p.* FROM p JOIN s USING (site) WHERE n > 0 AND (stop IS NULL OR page < stop)",
        "input_cap": "SELECT result_id, url FROM site_result ORDER BY result_id LIMIT 25",
        "recon_summary": f"""SELECT (SELECT count(*) FROM fingerprint) + count(DISTINCT url) AS sites, CAST(coalesce((SELECT sum(len(api_endpoints)) FROM fingerprint), 0) AS BIGINT) AS apis, CAST(count(DISTINCT (url, parameter)) AS BIGINT) AS parameters
            FROM (SELECT r.url, x.parameter FROM ({O._params()}) x JOIN request_log r USING (request_id))""",
        "title_groups": r"""WITH s AS (SELECT row_id, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(lower(title), '[\s\p{Z}]+'), lambda w: w <> ''))), ' ') AS words FROM job WHERE title IS NOT NULL)
            SELECT row_id, min(row_id) OVER (PARTITION BY words) AS class_id, words FROM s WHERE words <> ''""",
        "similar_titles_capped": O._SIMILAR.replace("FROM job WHERE title IS NOT NULL", "FROM (SELECT * FROM job WHERE title IS NOT NULL ORDER BY row_id LIMIT 500)"),
        "api_json_parse": rows(_API, _api(1, "No id", None, None), *api),
        "api_json_parse_fixed": rows(_API, _api(1, "No id", None, "https://a.b/1"), *api),
        "api_json_second": rows(_SECOND, _second(1, "7", " A ", "https://b.example/JobDetail/7", location="Oslo"), _second(1, None, "No id", "https://a.b/1"), _second(1, None, "Zero", None), _second(5, "3", "Single", "https://b.example/JobDetail/3")),
        "jsonld_parse": rows(
            _LD, _ld(1, "A", employment_type="FULL_TIME, TEMP", location="Oslo, NO", salary_range="EUR50,000 - EUR70,000 YEAR", company_name="Acme"),
            _ld(2, "B", location="X, Y | Z", remote_type="Remote", salary_range="$1,200"), _ld(3, "C", location="Main St", salary_range="$10+", company_name="Beta", department="Food"),
        ),
        "stream_new_records": f"SELECT DISTINCT {O._URL} AS url_hash FROM job",
        "stream_windows": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    }
