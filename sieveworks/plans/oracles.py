"""The same results as SQL, where SQL can express them, over the driver's tables and the queries' literal cases."""

from __future__ import annotations

import re

from ..functions import infer, text as X, url as U
from ..operators import detect
from ..schema import DESCRIPTION_LENGTH, FIELDS, IMPORTANT, METADATA, NULL_WORDS, REQUIRED, TITLE_LENGTH
from . import reference as R

#: White space of any kind, as the inside of a class.
_WS = r"\s\p{Z}\x0b\x1c-\x1f\x85"
_N, _L = r"[^\p{L}\p{N}_]", r"\p{L}\p{N}_"


def q(s: str) -> str:
    """A string as an SQL literal; control characters by chr()."""
    parts = re.split(r"([\n\t])", s)
    out = [f"chr({ord(p)})" if p in "\n\t" and p else "'" + p.replace("'", "''") + "'" for p in parts if p]
    return "(" + " || ".join(out) + ")" if len(out) > 1 else (out[0] if out else "''")


def values(items, name: str, sign: str = "") -> str:
    """Literal cases as a subquery (n, name)."""
    def cell(v):
        # long runs of one phrase are built, not spelled
        if isinstance(v, str) and len(v) > 200:
            for k in range(1, 60):
                unit = v[:k]
                if unit * (len(v) // k) == v:
                    return f"repeat({q(unit)}, {len(v) // k})"
        return q(v) if isinstance(v, str) else repr(v)

    return f"(SELECT {sign}n AS n, {name} FROM (VALUES {', '.join(f'({i}, {cell(v)})' for i, v in enumerate(items, 1))}) t(n, {name}))"


def sub(c: str, pattern: str, to: str = "''", flags: str = "g") -> str:
    return f"regexp_replace({c}, {q(pattern)}, {to}, '{flags}')"


def strip(c: str) -> str:
    return sub(c, f"^[{_WS}]+|[{_WS}]+$")


def squeeze(c: str) -> str:
    return strip(sub(f"coalesce({c}, '')", f"[{_WS}]+", "' '"))


def re2(p: str) -> str:
    """Word edges and white space of a pattern in terms that don't depend on ASCII."""
    edge = p.replace(r"\b.*\b", f"(?:{_N}.*)?{_N}")
    classes = {r"[-\s]": f"[-{_WS}]", r"[:\s]": f"[:{_WS}]", r"\s": f"[{_WS}]", r"\w": f"[{_L}]"}
    p = re.sub(r"\[[-:]\\s\]|\\[sw]", lambda m: classes[m[0]], edge)
    out, start = "", True
    for k, part in enumerate(p.split(r"\b")):
        out += part if not k else (f"(?:^|{_N})" if start else f"(?:$|{_N})") + part
        if k:
            start = not start
    return out


def found(c: str, p: str, group: int = 0, flags: str = "i") -> str:
    return f"nullif(regexp_extract(coalesce({c}, ''), {q(re2(p))}, {group}, '{flags}'), '')"


def _first(c: str, patterns, group: int) -> str:
    return "coalesce(" + ", ".join(found(c, p, group) for p in patterns) + ")"


def _label(c: str, table: dict[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(lower(coalesce({c}, '')), {q(re2(p))}) THEN '{k}'" for k, p in table.items()) + " END"


def part(c: str, n: int) -> str:
    return f"regexp_extract(coalesce({c}, ''), {q(U._SPLIT.replace('^(?s)', '(?s)^'))}, {n})"


def domain(c: str) -> str:
    return f"lower({part(c, 2)})"


def present(c: str) -> str:
    return f"({c} IS NOT NULL AND {c} <> '')"


_URLS = f"(SELECT row_id, application_url AS u FROM job UNION ALL SELECT n, u FROM {values(R.URLS, 'u', '-')})"
_TEXTS = f"(SELECT doc_id AS id, text FROM documents UNION ALL SELECT n, text FROM {values(R.TEXTS, 'text', '-')})"


def _company(u: str) -> str:
    d = domain(u)
    country = " OR ".join(f"ends_with(d, '{s}')" for s in U.COUNTRY_SUFFIXES)
    prefixes = ", ".join(f"'{p}'" for p in U.PREFIX_LABELS)
    short = ", ".join(f"'{s}'" for s in U.SHORTENERS)
    acr = " ".join(f"WHEN lower(label) = '{k}' THEN '{v}'" for k, v in U.ACRONYMS.items())
    return f"""
    WITH a AS (SELECT row_id, {d} AS d FROM {_URLS}),
    b AS (SELECT row_id, d, string_split(d, '.') AS l, string_split(replace(d, '{U.VENDOR}', ''), '.') AS s, ({country}) AS cc FROM a),
    c AS (SELECT row_id, d, CASE
        WHEN contains(d, '{U.VENDOR}') THEN CASE WHEN len(s) > 1 THEN CASE WHEN s[-1] <> 'jobs' THEN s[-1] ELSE s[-2] END ELSE s[-1] END
        WHEN len(l) < 2 THEN coalesce(l[1], '')
        WHEN l[1] IN ({prefixes}) THEN CASE WHEN cc AND len(l) >= 4 THEN l[-3] ELSE l[-2] END
        WHEN cc AND len(l) >= 3 THEN l[-3] WHEN len(l) > 2 THEN l[-2] ELSE l[1] END AS label FROM b)
    SELECT row_id, CASE WHEN d IN ({short}) THEN 'Unknown' {acr}
        ELSE array_to_string(list_transform(list_filter(string_split_regex(replace(replace(label, '-', ' '), '_', ' '), ' +'), lambda w: w <> ''), lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS company FROM c"""


def _noise(compat: bool) -> str:
    c = "coalesce(text, '')"
    for phrase in X.NOISE_TEXT:
        if compat or phrase != "or":
            c = f"replace({c}, {q(phrase)}, '')"
    for p in X.NOISE_PATTERNS:
        # RE2's edges are ASCII: only used here where letters are
        c = f"regexp_replace({c}, {q(p.replace(chr(92) + 's', '[' + _WS + ']'))}, '', '{'gi' if compat else 'gim'}')"
    return f"SELECT id, {c} AS clean FROM {_TEXTS}"


def _without(c: str, patterns) -> str:
    out = squeeze(sub(f"coalesce({c}, '')", "<[^<>]*>"))
    for p in patterns:
        out = sub(out, p, flags="gi")
    return strip(out)


def _norm(c: str) -> str:
    return f"lower({strip(f'''coalesce({c}, '')''')})"


_CONTENT = f"sha256({_norm('title')} || '|' || {_norm('description')} || '|' || {_norm('location')})"
_TITLE = f"sha256({_norm('company_name')} || '|' || {_norm('title')})"
_URL = f"sha256({_norm('application_url')})"


def _keep(key: str, src: str) -> str:
    return f"(SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY row_id) AS rn FROM {src}) WHERE rn = 1)"


_MISSING_URL = f"CASE WHEN {_norm('application_url')} <> '' THEN {_URL} ELSE 'row ' || row_id END"
_HYBRID = _keep(_CONTENT, _keep(_URL, "job"))


def _own(c: str, k: str) -> str:
    return f"CASE WHEN {c} <> '' THEN sha256({c}) ELSE '{k} ' || row_id END"


_IDENT = _keep(f"sha256({_norm('company_name')} || '|' || {_norm('title')} || '|' || {_norm('location')})", _keep(_own(_norm("application_url"), "url"), _keep(_own(_norm("job_id"), "id"), "job")))


def _filled(fields) -> str:
    return "(" + " + ".join(f"CAST({present(f)} AS INT)" for f in fields) + ")"


_SCORE = (
    f"round({_filled(REQUIRED)} / {len(REQUIRED)}.0::DOUBLE * 40 + {_filled(IMPORTANT)} / {len(IMPORTANT)}.0::DOUBLE * 30 + CASE WHEN NOT {present('description')} THEN 0 WHEN length(description) >= 500 THEN 20 "
    f"WHEN length(description) >= 200 THEN 15 WHEN length(description) >= 50 THEN 10 ELSE 5 END + {_filled(METADATA)} / {len(METADATA)}.0::DOUBLE * 10, 1)"
)


def _url_error(u: str) -> str:
    s = f"lower({part(u, 1)})"
    return f"CASE WHEN NOT {present(u)} THEN 'URL is empty' WHEN {s} = '' THEN 'URL missing scheme (http/https)' WHEN {s} NOT IN ('http', 'https') THEN 'Invalid URL scheme: ' || {s} WHEN {part(u, 2)} = '' THEN 'URL missing domain' END"


def _checked() -> str:
    lo, hi = TITLE_LENGTH
    dlo, dhi = DESCRIPTION_LENGTH
    cols = ", ".join(FIELDS)

    def lit(name, items, k):
        return f"SELECT n - {k} AS row_id, {', '.join(f if f == name else f'NULL AS {f}' for f in FIELDS)} FROM {values(items, name, '-')}"

    base = f"(SELECT row_id, {cols} FROM job UNION ALL {lit('title', R.TITLES, 1000)} UNION ALL {lit('description', R.LONG, 2000)} UNION ALL {lit('application_url', R.URLS, 3000)})"
    terr = rf"""CASE WHEN NOT {present('title')} THEN NULL WHEN length(title) < {lo} THEN 'Title too short (min {lo} chars)' WHEN length(title) > {hi} THEN 'Title too long (max {hi} chars)'
        WHEN regexp_matches(lower({strip('title')}), '^[\d\s\-_.]+$|^(null|undefined|none|n/a)$|^loading|^error') THEN 'Title appears to be garbage: ' || title[1:50] END"""
    derr = rf"""CASE WHEN length(description) < {dlo} THEN 'Description too short (min {dlo} chars)' WHEN length(description) > {dhi} THEN 'Description too long (max {dhi} chars)'
        WHEN regexp_matches(lower({strip('description')}), '^(loading|please wait|error)') THEN 'Description appears to be garbage' END"""
    errors = [f"CASE WHEN NOT {present(f)} THEN 'Missing required field: {f}' END" for f in REQUIRED] + [f"CASE WHEN {present('application_url')} THEN 'Invalid application_url: ' || {_url_error('application_url')} END"]
    warns = [f"'Title validation: ' || ({terr})", f"CASE WHEN NOT {present('description')} THEN 'Missing description' ELSE 'Description validation: ' || ({derr}) END"]
    warns += [f"CASE WHEN NOT {present(f)} THEN 'Missing important field: {f}' END" for f in IMPORTANT]
    warns.append(f"CASE WHEN {_filled(FIELDS)} < 5 THEN 'Low field completeness: only ' || {_filled(FIELDS)} || '/{len(FIELDS)} fields' END")
    no_null = lambda xs: f"list_filter([{', '.join(xs)}], lambda x: x IS NOT NULL)"
    return f"(SELECT row_id, {no_null(errors)} AS e, {no_null(warns)} AS w FROM {base})"


def _hist(col: str) -> str:
    return f"SELECT split_part(m, ':', 1) AS reason, count(*) AS n FROM (SELECT unnest({col}) AS m FROM {_checked()}) GROUP BY 1"


def _normalised() -> str:
    words = ", ".join(q(w) for w in NULL_WORDS)
    clean = ", ".join(f"CASE WHEN lower({strip(f)}) NOT IN ({words}) THEN {strip(f)} END AS {f}" for f in FIELDS)
    has = lambda f, w: f"contains(lower({f}), '{w}')"
    e, r, x = "employment_type", "remote_type", "experience_level"
    rules = {
        e: f"CASE WHEN {has(e, 'full')} AND {has(e, 'time')} THEN 'Full-time' WHEN {has(e, 'part')} AND {has(e, 'time')} THEN 'Part-time' WHEN {has(e, 'contract')} THEN 'Contract' WHEN {has(e, 'intern')} THEN 'Internship' ELSE {e} END",
        r: f"CASE WHEN {has(r, 'remote')} THEN 'Remote' WHEN {has(r, 'hybrid')} THEN 'Hybrid' WHEN {has(r, 'on')} AND {has(r, 'site')} THEN 'Onsite' ELSE {r} END",
        x: f"CASE WHEN {has(x, 'entry')} OR {has(x, 'junior')} THEN 'Entry' WHEN {has(x, 'senior')} OR {has(x, 'sr')} THEN 'Senior' WHEN {has(x, 'mid')} OR {has(x, 'intermediate')} THEN 'Mid' WHEN {has(x, 'executive')} OR {has(x, 'director')} THEN 'Executive' ELSE {x} END",
    }
    return f"SELECT row_id, {', '.join(f'{rules[f]} AS {f}' if f in rules else f for f in FIELDS)} FROM (SELECT row_id, {clean} FROM job)"


_SIMILAR = """
WITH s AS (SELECT DISTINCT list_sort(list_distinct(list_filter(regexp_split_to_array(lower(title), '[\\s\\p{Z}]+'), lambda w: w <> ''))) AS w FROM job WHERE title IS NOT NULL),
t AS (SELECT w FROM s WHERE len(w) > 0),
p AS (SELECT a.w AS a, b.w AS b, len(list_intersect(a.w, b.w)) AS c FROM t a JOIN t b ON a.w < b.w AND len(a.w) >= 0.8 * len(b.w) AND len(b.w) >= 0.8 * len(a.w))
SELECT array_to_string(a, ' ') AS title_a, array_to_string(b, ' ') AS title_b, round(c / (len(a) + len(b) - c), 6) AS similarity FROM p WHERE c / (len(a) + len(b) - c) >= 0.8 AND c / (len(a) + len(b) - c) < 1"""

_VENDOR = detect.Vendor()
_DATE = "CASE WHEN regexp_matches(left(date_posted, 19), '^\\d{4}-\\d{1,2}-\\d{1,2}$') THEN try_strptime(left(date_posted, 19), '%Y-%m-%d') WHEN regexp_matches(left(date_posted, 19), '^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}$') THEN try_strptime(left(date_posted, 19), '%Y-%m-%dT%H:%M:%S') END"

_CATS = f"""
(SELECT s.url, CASE WHEN NOT s.ok OR n.jobs IS NULL THEN 'broken' WHEN n.latest IS NULL OR n.latest >= TIMESTAMP '{R.AS_OF}' - INTERVAL 60 DAY THEN 'working' ELSE 'stale' END AS category,
  coalesce(n.jobs, 0) AS jobs, strftime(n.latest, '%Y-%m-%d %H:%M:%S') AS latest
FROM (SELECT url, bool_or(coalesce(success, false)) AS ok FROM site_result GROUP BY 1) s
LEFT JOIN (SELECT portal_url, count(*) AS jobs, max({_DATE}) AS latest FROM job GROUP BY 1) n ON s.url = n.portal_url)"""

_SITE_SIGNALS = "list_filter([CASE WHEN contains(lower(coalesce(portal_url, '')), '" + _VENDOR.host + "') THEN 'explicit_url' END, " + ", ".join(
    f"CASE WHEN regexp_matches(lower(coalesce(description_html, '')), {q(p.replace(chr(92) + 's', '[' + _WS + ']'))}) THEN '{k}' END" for k, p in _VENDOR.site_patterns().items()
) + "], lambda x: x IS NOT NULL)"


def _fingerprint() -> str:
    n, h, e = _VENDOR.name, _VENDOR.host, _VENDOR.host.replace(".", r"\.")
    html, low = "description_html", "lower(description_html)"
    rules = [
        ("js_global", 40, rf"regexp_matches({html}, 'window\.{n}|var\s+{n}\s*=')"),
        ("cdn_host", 35, f"(contains({html}, '{h}') OR contains({html}, '{n}cdn.'))"),
        ("api_pattern", 30, rf"regexp_matches({low}, '/publicreports/\d+/json|/searchjobsdata|/careerportal/searchjobs|{e}.*api')"),
        ("paging", 25, f"(contains({html}, 'jobOffset') AND (contains({html}, 'jobRecordsCount') OR contains({html}, 'jobSearchInterval')))"),
        ("form", 15, f"(contains({html}, '__eventtarget') AND contains({html}, '__eventargument') AND contains({low}, 'asp.net'))"),
        ("data_attribute", 10, f"regexp_matches({html}, 'data-job-id|data-requisition-id|data-{n}')"),
        ("css_class", 5, f"regexp_matches({html}, '{n}-container|{n}-job|career-portal')"),
    ]
    score = " + ".join(f"CASE WHEN {c} THEN {w} ELSE 0 END" for _, w, c in rules)
    sig = ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, _, c in rules)
    return f"SELECT row_id, ({score}) >= 40 AS is_match, least(100, {score}) AS confidence_score, array_to_string(list_filter([{sig}], lambda x: x IS NOT NULL), '|') AS signals FROM job WHERE description_html IS NOT NULL"


def _params() -> str:
    kind = "CASE " + " ".join(f"WHEN regexp_matches(lower(parameter), '{p}') THEN '{k}'" for k, p in detect.PARAMETER_KINDS.items()) + " END"
    return f"SELECT * FROM (SELECT request_id, {kind} AS kind, parameter FROM (SELECT request_id, unnest(list_distinct(regexp_extract_all(coalesce(url, ''), '[?&]([a-zA-Z_]+)=', 1))) AS parameter FROM request_log)) WHERE kind IS NOT NULL"


_API = "regexp_matches(lower(url), '/api/|/services/|/rest/|/graphql')"


def oracle_sql() -> dict[str, str]:
    u0 = f"regexp_replace({strip('''coalesce(u, '')''')}, '/+$', '')"
    norm = f"(SELECT row_id, u, CASE WHEN starts_with({u0}, 'http://') OR starts_with({u0}, 'https://') THEN {u0} ELSE 'https://' || {u0} END AS v FROM {_URLS})"
    jid = ", ".join([r"nullif(regexp_extract(regexp_replace(coalesce(u, ''), '/+$', ''), '(?:^|/)(\d{4,})$', 1), '')", r"nullif(regexp_extract(coalesce(u, ''), '/(\d{4,})(?:[/?#]|$)', 1), '')", r"nullif(regexp_extract(coalesce(u, ''), '[?&]jobId=(\d+)', 1, 'i'), '')", r"nullif(regexp_extract(coalesce(u, ''), '[?&]id=(\d+)', 1, 'i'), '')"])
    one = sub(sub("coalesce(text, '')", r"[ \t]+", "' '"), rf"\n[{_WS}]*\n+", "chr(10) || chr(10)")
    ws = strip(f"array_to_string(list_transform(string_split({one}, chr(10)), lambda x: {strip('x')}), chr(10))")
    bullets = sub(sub("x", rf"^[{_WS}]*[•●○◦▪▫–—][{_WS}]*", "'• '"), rf"^[{_WS}]*[*\-][{_WS}]+", "'• '")
    titles = f"(SELECT row_id, title FROM job UNION ALL SELECT n, title FROM {values(R.TITLES, 'title', '-')})"
    companies = f"(SELECT row_id, company_name FROM job UNION ALL SELECT n, c FROM {values(R.COMPANIES, 'c', '-')})"
    trim_c = lambda v: rf"CASE WHEN length({v}) > 3 AND length({v}) < 100 THEN {v} END"
    place = "coalesce(" + ", ".join(trim_c(rf"regexp_replace(trim(coalesce({found('text', p, 1)}, '')), ',?\s+(USA|United States|US)$', '')") for p in infer.LOCATIONS) + ")"
    dates = f"(SELECT row_id, date_posted FROM job UNION ALL SELECT n, v FROM {values(R.DATES, 'v', '-')})"
    flag = lambda src: f"SELECT row_id, count(*) OVER (PARTITION BY {_TITLE}) > 1 AS has_title_duplicate FROM {src}"
    kinds = " UNION ALL ".join(f"SELECT '{k}' AS kind, {h} AS h FROM job" for k, h in (("content", _CONTENT), ("title", _TITLE), ("url", _URL)))
    share = " UNION ALL ".join(f"SELECT '{f}' AS field, round(avg(CAST({present(f)} AS DOUBLE)), 6) AS share FROM job HAVING count(*) > 0" for f in FIELDS)
    s = f"(SELECT {_SCORE} AS s, {_filled(FIELDS)} / {len(FIELDS)}.0::DOUBLE AS c FROM job)"
    first_detail = _keep("application_url", "(SELECT * FROM job WHERE extraction_method <> 'http' AND application_url <> '')")
    templates = " UNION ALL ".join(f"SELECT s_name, replace('{t}', '{{0}}', regexp_replace(lower(s_name), '[^a-z0-9\\-]+', '', 'g')) AS url FROM supplier" for t in detect.URL_TEMPLATES)
    out = {
        "url_normalize": f"SELECT row_id, CASE WHEN {present('u')} THEN lower({part('v', 1)}) || '://' || lower({part('v', 2)}) || {part('v', 3)} ELSE '' END AS url FROM {norm}",
        "url_domain": f"SELECT row_id, {domain('u')} AS domain FROM {_URLS}",
        "url_company": _company("u"),
        "url_job_id": f"SELECT row_id, coalesce({jid}) AS job_id FROM {_URLS}",
        "url_vendor": f"SELECT row_id, contains({domain('u')}, '{U.VENDOR.lstrip('.')}') AS is_vendor FROM {_URLS}",
        "url_validate_reasons": f"SELECT row_id, {_url_error('u')} AS reason FROM {_URLS}",
        "text_clean": f"SELECT id, {squeeze('text')} AS clean FROM {_TEXTS}",
        "text_truncate": f"SELECT id, CASE WHEN length(text) > 80 THEN text[1:77] || '...' ELSE coalesce(text, '') END AS short FROM {_TEXTS}",
        "whitespace_clean": f"SELECT id, {ws} AS clean FROM {_TEXTS}",
        "list_normalize": f"SELECT id, array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {bullets}), chr(10)) AS clean FROM {_TEXTS}",
        "noise_text_compat": _noise(True),
        "noise_text_fixed": _noise(False),
        "title_clean": f"SELECT row_id, {_without('title', (r'^job:\s*', r'^position:\s*', r'\s*-\s*apply\s*now\s*$', r'\s*\(new\)\s*$', r'\s*\[new\]\s*$'))} AS clean FROM {titles}",
        "location_clean": f"SELECT row_id, {_without('location', (r'^location:\s*', r'^loc:\s*', r'^office:\s*'))} AS clean FROM job",
        "company_clean": f"SELECT row_id, {_without('company_name', (r'\s+(inc\.?|llc\.?|corp\.?|ltd\.?|limited|incorporated|corporation)$', r'\s+careers$', r'\s+jobs$'))} AS clean FROM {companies}",
        "duration_text": f"""SELECT n, concat_ws(' ', CASE WHEN s >= 3600 THEN s // 3600 || 'h' END, CASE WHEN s % 3600 >= 60 THEN s % 3600 // 60 || 'm' END,
            CASE WHEN s % 60 > 0 OR s < 60 THEN s % 60 || 's' END) AS text FROM (SELECT n, CAST(floor(s) AS BIGINT) AS s FROM {values(R.SECONDS, 's')})""",
        "timestamp_iso": "SELECT doc_id, strftime(captured_at AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS at FROM documents",
        "infer_employment": f"SELECT id, {_label('text', infer.EMPLOYMENT)} AS label FROM {_TEXTS}",
        "infer_remote": f"SELECT id, {_label('text', infer.REMOTE)} AS label FROM {_TEXTS}",
        "infer_experience": f"SELECT id, {_label('text', infer.EXPERIENCE)} AS label FROM {_TEXTS}",
        "extract_salary": f"SELECT id, {_first('text', infer.SALARY, 0)} AS salary FROM {_TEXTS}",
        "extract_date": f"SELECT id, {_first('text', infer.DATES, 1)} AS date FROM {_TEXTS}",
        "extract_location": f"SELECT id, {place} AS location FROM {_TEXTS}",
        "parse_dates": f"SELECT row_id, strftime({_DATE}, '%Y-%m-%d %H:%M:%S') AS at FROM {dates}",
        "normalise_job_fields": _normalised(),
        "quality_score": f"SELECT row_id, {_SCORE} AS score FROM job",
        "quality_bands": f"""SELECT count(*) AS jobs, round(avg(s), 1) AS avg_score, min(s) AS min_score, max(s) AS max_score, count(*) FILTER (s >= 90) AS excellent, count(*) FILTER (s >= 70 AND s < 90) AS good,
            count(*) FILTER (s >= 50 AND s < 70) AS fair, count(*) FILTER (s < 50) AS poor, count(*) FILTER (c > 0.8) AS complete, count(*) FILTER (c >= 0.5 AND c <= 0.8) AS partial, count(*) FILTER (c < 0.5) AS sparse FROM {s}""",
        "field_completeness": share,
        "validation_split": f"SELECT row_id, len(e) = 0 AS is_valid, array_to_string(e, '|') AS errors, array_to_string(w, '|') AS warnings FROM {_checked()}",
        "error_histogram": _hist("e"),
        "warning_histogram": _hist("w"),
        "hash_keys": f"SELECT row_id, {_URL} AS url_hash, {_CONTENT} AS content_hash, {_TITLE} AS title_hash FROM job",
        "dedup_content": f"SELECT row_id FROM {_keep(_CONTENT, 'job')}",
        "dedup_title": f"SELECT row_id FROM {_keep(_TITLE, 'job')}",
        "dedup_url": f"SELECT row_id FROM {_keep(_URL, 'job')}",
        "dedup_hybrid": flag(_HYBRID),
        "dedup_hybrid_keep_missing": flag(_keep(_CONTENT, _keep(_MISSING_URL, "job"))),
        "dedup_identifier": f"SELECT row_id FROM {_IDENT}",
        "dedup_stats": f"""WITH u AS (SELECT * FROM {_keep(_URL, 'job')}), c AS (SELECT * FROM {_keep(_CONTENT, 'u')}), n AS (SELECT (SELECT count(*) FROM job) AS a, (SELECT count(*) FROM u) AS b, (SELECT count(*) FROM c) AS c)
            SELECT a AS total_input, c AS total_output, a - c AS duplicates_removed, a - b AS url_duplicates, b - c AS content_duplicates, (SELECT count(*) FROM (SELECT 1 FROM c GROUP BY {_TITLE} HAVING count(*) > 1)) AS title_duplicates_flagged FROM n""",
        "dup_analysis": f"SELECT kind, count(*) FILTER (n > 1) AS duplicate_groups, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS total_affected FROM (SELECT kind, h, count(*) AS n FROM ({kinds}) GROUP BY 1, 2) GROUP BY 1",
        "dup_by_company": f"""SELECT company, duplicates FROM (SELECT company, CAST(sum(n - 1) AS BIGINT) AS duplicates, min(o) AS o FROM (SELECT count(*) AS n, arg_min(coalesce(company_name, 'Unknown'), row_id) AS company, min(row_id) AS o FROM job GROUP BY {_CONTENT} HAVING count(*) > 1) GROUP BY 1) ORDER BY duplicates DESC, o LIMIT 20""",
        "similar_titles": _SIMILAR,
        "similar_titles_top": f"SELECT * FROM ({_SIMILAR}) ORDER BY similarity DESC, title_a, title_b LIMIT 100",
        "listing_detail_merge": f"""SELECT l.application_url, coalesce(nullif(d.title, ''), nullif(l.title, '')) AS title, coalesce(nullif(d.location, ''), nullif(l.location, '')) AS location, coalesce(nullif(d.department, ''), nullif(l.department, '')) AS department
            FROM (SELECT * FROM job WHERE extraction_method = 'http' AND application_url <> '') l LEFT JOIN (SELECT * FROM {first_detail} WHERE length(description) > 50) d ON l.application_url = d.application_url""",
        "resume_anti": "SELECT portal_url AS url FROM portal WHERE portal_url NOT IN (SELECT url FROM site_result WHERE success AND url IS NOT NULL)",
        "resume_semi": "SELECT portal_url AS url FROM portal WHERE portal_url IN (SELECT url FROM site_result WHERE success)",
        "snapshot_diff": "SELECT application_url FROM job WHERE application_url <> '' AND extraction_method = 'api' EXCEPT ALL SELECT application_url FROM job WHERE application_url <> '' AND extraction_method = 'http'",
        "union_batches": "SELECT row_id, title, NULL AS location FROM job WHERE extraction_method = 'api' UNION ALL SELECT row_id, NULL, location FROM job WHERE extraction_method = 'http'",
        "paging_stop": """WITH p AS (SELECT event_type AS site, event_id // 50 AS page_no, 'u' || user_id AS url FROM events), f AS (SELECT site, url, min(page_no) AS first FROM p GROUP BY 1, 2),
            x AS (SELECT p.site, p.page_no, bool_or(f.first = p.page_no) AS fresh FROM p JOIN f ON p.site = f.site AND p.url = f.url GROUP BY 1, 2), s AS (SELECT site, min(page_no) FILTER (NOT fresh) AS stop FROM x GROUP BY 1)
            SELECT p.site, count(*) AS n_rows, max(p.page_no) AS last_page FROM p JOIN s ON p.site = s.site WHERE s.stop IS NULL OR p.page_no < s.stop GROUP BY 1""",
        "chunks": "SELECT CAST((rn - 1) // 25 AS BIGINT) AS chunk, count(*) AS n, min(result_id) AS first_id FROM (SELECT result_id, row_number() OVER (ORDER BY result_id) AS rn FROM site_result) GROUP BY 1",
        "method_cascade": """SELECT url, method, result_id FROM (SELECT url, method, result_id, row_number() OVER (PARTITION BY url ORDER BY CASE method WHEN 'api' THEN 1 WHEN 'http' THEN 2 ELSE 3 END, result_id) AS rn
            FROM site_result WHERE coalesce(success, false) AND pages_scraped > 0 AND method IN ('api', 'http', 'playwright')) WHERE rn = 1""",
        "run_stats": """SELECT count(*) AS total_sites, count(*) FILTER (coalesce(success, false)) AS successful, count(*) FILTER (NOT coalesce(success, false)) AS failed, round(avg(CAST(coalesce(success, false) AS DOUBLE)), 6) AS success_rate,
            count(*) FILTER (success AND method = 'api') AS api_sites, count(*) FILTER (success AND method = 'http') AS http_sites, count(*) FILTER (success AND method = 'playwright') AS playwright_sites,
            round(avg(duration_seconds), 6) AS avg_duration, CAST(coalesce(sum(pages_scraped), 0) AS BIGINT) AS pages FROM site_result""",
        "method_pivot": "SELECT url, count(*) FILTER (method = 'api') AS api, count(*) FILTER (method = 'http') AS http, count(*) FILTER (method = 'playwright') AS playwright FROM site_result GROUP BY 1",
        "failed_sites": "SELECT url, coalesce(nullif(error, ''), 'Unknown error') AS error FROM site_result WHERE NOT coalesce(success, false)",
        "site_categories": f"SELECT * FROM {_CATS}",
        "category_summary": f"SELECT count(*) FILTER (category = 'working') AS working, count(*) FILTER (category = 'stale') AS stale, count(*) FILTER (category = 'broken') AS broken, coalesce(round(sum(jobs) / nullif(count(*) FILTER (category = 'working'), 0), 6), 0.0) AS avg_jobs_per_working_site FROM {_CATS}",
        "coverage_rollup": f"""WITH u AS (SELECT * FROM {_HYBRID}), n AS (SELECT (SELECT count(*) FROM job) AS a, (SELECT count(*) FROM u) AS b, (SELECT count(*) FROM u WHERE {present('title')} AND {present('application_url')} AND {_url_error('application_url')} IS NULL) AS c)
            SELECT a AS raw_jobs, b AS unique_jobs, c AS valid_jobs, coalesce(round((a - b) / nullif(a, 0), 6), 0.0) AS dedup_rate FROM n""",
        "junk_filter": r"""SELECT row_id FROM (SELECT row_id, title, application_url FROM job UNION ALL VALUES (-1, 'Email', 'https://a.b/1'), (-2, 'Clerk', 'mailto:x@y.z'), (-3, 'Clerk', 'https://WA.me/1'), (-4, 'Emailer', 'https://a.b/2'))
            WHERE NOT (lower(trim(coalesce(title, ''))) IN ('email', 'linkedin', 'facebook', 'twitter', 'share', 'print') OR regexp_matches(lower(coalesce(application_url, '')), 'mailto:|wa\.me|linkedin\.com/share|facebook\.com/sharer|twitter\.com/intent'))""",
        "fingerprint_summary": "SELECT count(*) AS tested, count(*) FILTER (is_match) AS matched, round(coalesce(count(*) FILTER (is_match) / nullif(count(*), 0), 0.0), 6) AS match_rate, count(*) FILTER (is_match) * 150 AS estimated_yield FROM fingerprint",
        "fingerprint_rank": "SELECT fingerprint_id, url, confidence_score, array_to_string(list_slice(coalesce(signals, []), 1, 3), '; ') AS top_signals FROM fingerprint WHERE is_match ORDER BY confidence_score DESC NULLS LAST, fingerprint_id LIMIT 20",
        "signal_counts": "SELECT signal, count(*) AS n, count(DISTINCT fingerprint_id) AS pages FROM (SELECT fingerprint_id, unnest(signals) AS signal FROM fingerprint) GROUP BY 1",
        "fingerprint_score": _fingerprint(),
        "site_detect": f"SELECT row_id, array_to_string({_SITE_SIGNALS}, '|') AS signals, len({_SITE_SIGNALS}) >= 2 AS is_match FROM job",
        "hidden_params": _params(),
        "api_requests": f"SELECT request_id, url, upper(method) AS method FROM request_log WHERE {_API}",
        "requests_by_host": f"SELECT lower({part('url', 2)}) AS host, CASE WHEN {_API} THEN 'api' ELSE 'other' END AS kind, count(*) AS n FROM request_log GROUP BY 1, 2",
        "recommendations": """SELECT fingerprint_id AS url, CASE WHEN coalesce(len(api_endpoints), 0) = 0 THEN 'little found: a rendered capture may be needed' ELSE concat_ws('|', 'endpoints for direct extraction: ' || len(api_endpoints),
            CASE WHEN len(list_filter(api_endpoints, lambda x: contains(x, 'json'))) > 0 THEN 'bulk exports to try first: ' || len(list_filter(api_endpoints, lambda x: contains(x, 'json'))) END) END AS messages FROM fingerprint""",
        "url_candidates": templates,
        "event_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    }
    return out | _P1


_P1 = {
    "p1_found": "SELECT company_name FROM job WHERE trim(company_name) <> '' GROUP BY 1 HAVING count(*) > 0.02 * (SELECT count(*) FROM job)",
    "p1_company_index": """
        SELECT company_name AS company, count(*) AS job_count,
               coalesce(list_slice(list(title ORDER BY row_id, title) FILTER (WHERE title <> ''), 1, 3), []) AS sample_titles
        FROM job WHERE trim(company_name) <> '' GROUP BY 1""",
    "p1_company_profile": """
        SELECT company_name, count(*) AS job_count, count(*) FILTER (WHERE trim(description, ' ' || chr(9) || chr(10) || chr(13)) <> '') AS described,
               CAST(sum(coalesce(length(description), 0)) AS BIGINT) AS description_chars, min(row_id) AS first_row, max(row_id) AS last_row,
               round(avg(CAST(length(title) AS DOUBLE)), 6) AS mean_title_chars
        FROM job WHERE trim(company_name) <> '' GROUP BY 1""",
}
