"""String scalars as native columns. NULL and '' give '' unless said otherwise."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Text that is deleted wherever it stands, in this order, and the patterns that follow.
NOISE_TEXT = (
    "Share this job", "Share job", "Apply now", "Apply Now", "Save job", "Save Job", "Print job", "Print Job", "Email this job", "Email job",
    "Back to search", "Back to results", "View all jobs", "View all positions", "Similar jobs", "Related jobs", "More positions", "Follow us",
    "Connect with us", "Join our team", "We are hiring", "Loading...", "Please wait...", "Cookie Policy", "Privacy Policy", "Terms of Use",
    "Terms and Conditions", "© ", "Copyright ", "All rights reserved", "Welcome!", "Sign in", "Register", "< Back to job list",
    "Back to job list", "Ref#:", "Date published:", "or",
)
NOISE_PATTERNS = (
    r"\b(tweet|share|pin|post)\s+(this|it)\b",
    r"\b(click|tap)\s+here\b",
    r"\b(read|learn)\s+more\b$",
    r"^\s*(loading|please wait)\s*\.{0,3}\s*$",
    r"^\s*\d+\s*(views?|clicks?)\s*$",
    r"^\s*posted\s+\d+\s+(days?|hours?|minutes?)\s+ago\s*$",
    r"^\s*Date published:\s*\d{1,2}-\w{3}-\d{4}\s*$",
    r"^\s*Ref#:\s*\w*\s*$",
    r"^<\s*Back to job list\s*$",
)


def present(c: Column | str) -> Column:
    """Neither NULL nor empty; a space is present."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != "")


def first_present(*cols: Column) -> Column:
    """The first that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def text(c: Column | str) -> Column:
    """NULL as ''."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column) -> Column:
    """All Unicode white space off both ends."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space to one space, ends stripped."""
    return strip(F.regexp_replace(text(c), r"(?U)[\s\x1c-\x1f]+", " "))


def truncate(c: Column, n: int, suffix: str = "...") -> Column:
    """Texts longer than n are cut to n characters including the suffix."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, max(0, n - len(suffix))), F.lit(suffix))).otherwise(text(c))


def duration(seconds: Column) -> Column:
    """Hours, minutes and seconds without zero parts, never empty."""
    s = F.floor(seconds).cast("long")
    h, m, rest = F.floor(s / 3600).cast("long"), F.floor(F.pmod(s, F.lit(3600)) / 60).cast("long"), F.pmod(s, F.lit(60))
    part = lambda v, u: F.when(v > 0, F.concat(v.cast("string"), F.lit(u)))
    return F.concat_ws(" ", part(h, "h"), part(m, "m"), F.when((rest > 0) | ((h == 0) & (m == 0)), F.concat(rest.cast("string"), F.lit("s"))))


def timestamp_text(c: Column | None = None) -> Column:
    """UTC in ISO form with Z; of the current moment where no column is given."""
    at = F.current_timestamp() if c is None else c
    return F.concat(F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def noise_removed(c: Column, compat: bool = True, extra: tuple[str, ...] = ()) -> Column:
    """Noise phrases deleted. compat: also inside words and over the whole text, as the original behaves.

    Otherwise the word "or" stays, and anchored patterns apply to each line.
    """
    out = text(c)
    for phrase in (*extra, *NOISE_TEXT):
        if compat or phrase != "or":
            out = F.replace(out, F.lit(phrase), F.lit(""))
    for p in NOISE_PATTERNS:
        out = F.regexp_replace(out, f"(?iU{'' if compat else 'm'}){p}", "")
    return out


def whitespace_cleaned(c: Column) -> Column:
    """Spaces and tabs to one space, blank-line runs to one blank line, every line stripped."""
    one = F.regexp_replace(F.regexp_replace(text(c), r"[ \t]+", " "), r"(?U)\n\s*\n+", "\n\n")
    return strip(F.array_join(F.transform(F.split(one, "\n", -1), strip), "\n"))


def lists_normalised(c: Column) -> Column:
    """A line's bullet glyph, or asterisk or hyphen with a space, to one bullet; numbers stay."""
    line = lambda x: F.regexp_replace(F.regexp_replace(x, r"(?U)^\s*[•●○◦▪▫–—]\s*", "• "), r"(?U)^\s*[*\-]\s+", "• ")
    return F.array_join(F.transform(F.split(text(c), "\n", -1), line), "\n")


def _without(c: Column, patterns: tuple[str, ...]) -> Column:
    out = squeeze(F.regexp_replace(text(c), r"<[^<>]*>", ""))
    for p in patterns:
        out = F.regexp_replace(out, f"(?i){p}", "")
    return strip(out)


def title_cleaned(c: Column) -> Column:
    return _without(c, (r"^job:\s*", r"^position:\s*", r"\s*-\s*apply\s*now\s*$", r"\s*\(new\)\s*$", r"\s*\[new\]\s*$"))


def location_cleaned(c: Column) -> Column:
    return _without(c, (r"^location:\s*", r"^loc:\s*", r"^office:\s*"))


def company_cleaned(c: Column) -> Column:
    return _without(c, (r"\s+(inc\.?|llc\.?|corp\.?|ltd\.?|limited|incorporated|corporation)$", r"\s+careers$", r"\s+jobs$"))


def sql_regex(p: str) -> str:
    """A pattern as the body of an SQL string."""
    return re.sub("'", "''", p)
