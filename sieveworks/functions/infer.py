"""Attributes inferred from text by ordered patterns; the first label that matches wins."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import first_present, text

# Label -> patterns, on lower-case text.
EMPLOYMENT = {
    "Full Time": r"\bfull[-\s]?time\b|\bft\b|\bpermanent\b",
    "Part Time": r"\bpart[-\s]?time\b|\bpt\b",
    "Contract": r"\bcontract\b|\bcontractor\b|\bfreelance\b|\bconsultant\b",
    "Temporary": r"\btemporary\b|\btemp\b|\bseasonal\b",
    "Internship": r"\bintern\b|\binternship\b|\bstudent\b|\bco-?op\b",
}
REMOTE = {
    "Remote": r"\bremote\b|\bwork from home\b|\bwfh\b|\btelecommute\b|\btelework\b",
    "Hybrid": r"\bhybrid\b|\bflexible\b.*\b(location|work)\b|\b(location|work)\b.*\bflexible\b",
    "Onsite": r"\bon[-\s]?site\b|\bin[-\s]?office\b|\bin[-\s]?person\b",
}
EXPERIENCE = {
    "Entry": r"\bentry[-\s]?level\b|\bjunior\b|\bgraduate\b|\b0[-\s]?[–-]?[-\s]?2\s*years?\b",
    "Mid": r"\bmid[-\s]?level\b|\b2[-\s]?[–-]?[-\s]?5\s*years?\b|\bintermediate\b",
    "Senior": r"\bsenior\b|\bsr\.?\b|\b5[-\s]?\+?\s*years?\b|\blead\b|\bprincipal\b",
    "Executive": r"\bexecutive\b|\bdirector\b|\bvp\b|\bc[-\s]?level\b|\bchief\b",
}
SALARY = (
    r"\$[\d,]+\s*[-–]\s*\$[\d,]+",
    r"\$[\d,]+\s*(?:k|K)",
    r"[\d,]+\s*[-–]\s*[\d,]+\s*(?:USD|EUR|GBP)",
    r"(?:salary|pay|compensation):\s*\$?[\d,]+",
)
DATES = (
    r"Date published[:\s]+(\d{1,2}-\w{3}-\d{4})",
    r"Posted Date[:\s]+(\d{1,2}/\d{1,2}/\d{4})",
    r"Date Posted[:\s]+(\d{1,2}/\d{1,2}/\d{4})",
    r"Posted[:\s]+(\d{1,2}/\d{1,2}/\d{4})",
    r"Posted Date[:\s]+(\d{4}-\d{2}-\d{2})",
    r"Date Posted[:\s]+(\d{4}-\d{2}-\d{2})",
)
LOCATIONS = (r"Work Location:\s*([^\n]+)", r"Location:\s*([^\n]+)", r"Job Location:\s*([^\n]+)", r"Office Location:\s*([^\n]+)")


def _label(c: Column, table: dict[str, str]) -> Column:
    low = F.lower(text(c))
    out = None
    for label, p in table.items():
        hit = low.rlike(f"(?U){p}")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def employment_type(c: Column) -> Column:
    return _label(c, EMPLOYMENT)


def remote_type(c: Column, stated: Column | None = None) -> Column:
    return _label(c, REMOTE) if stated is None else first_present(stated, _label(c, REMOTE))


def experience_level(c: Column, stated: Column | None = None) -> Column:
    return _label(c, EXPERIENCE) if stated is None else first_present(stated, _label(c, EXPERIENCE))


def _first(c: Column, patterns: tuple[str, ...], group: int) -> Column:
    return F.coalesce(*[F.nullif(F.regexp_extract(text(c), f"(?iU){p}", group), F.lit("")) for p in patterns])


def salary(c: Column, stated: Column | None = None) -> Column:
    return _first(c, SALARY, 0) if stated is None else first_present(stated, _first(c, SALARY, 0))


def date_text(c: Column) -> Column:
    return _first(c, DATES, 1)


def location_text(c: Column) -> Column:
    """The first pattern's value of 4 to 99 characters, without a final country."""
    out = []
    for p in LOCATIONS:
        v = F.regexp_replace(F.trim(F.regexp_extract(text(c), f"(?iU){p}", 1)), r",?\s+(USA|United States|US)$", "")
        out.append(F.when((F.length(v) > 3) & (F.length(v) < 100), v))
    return F.coalesce(*out)


def parsed_date(c: Column, extended: bool = False) -> Column:
    """ISO day or second by the first 19 characters, NULL otherwise; extended: also d-MMM-yyyy and M/d/yyyy."""
    head = F.substring(c, 1, 19)
    iso = F.when(head.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_timestamp(head, F.lit("yyyy-M-d"))).when(head.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"), F.try_to_timestamp(head, F.lit("yyyy-MM-dd'T'HH:mm:ss")))
    if not extended:
        return iso
    return F.coalesce(iso, F.when(c.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"), F.try_to_timestamp(c, F.lit("d-MMM-yyyy"))), F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(c, F.lit("M/d/yyyy"))))
