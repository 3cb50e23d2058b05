"""Records from captured pages: JSON-LD first, then selectors, then inference from text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import dom, infer, jsonapi, url as U
from ..functions.text import first_present, lists_normalised, location_cleaned, noise_removed, strip, title_cleaned, whitespace_cleaned

# Words by which a line reads as a place.
PLACE_WORDS = ("city", "state", "remote", "usa", "united")


def tidy(c):
    """The native tail after the tree: noise, white space, lists."""
    return lists_normalised(whitespace_cleaned(noise_removed(c)))


def job_data(pages: DataFrame, url: str, html: str, keep: list[str]) -> DataFrame:
    """One record per page. With JSON-LD that states no employment type, none is inferred."""
    raw = pages.select(*keep, F.col(url).alias("__url"), dom.page_fields(F.col(html)).alias("p"))
    ld = raw.withColumn("v", jsonapi.json_ld(F.col("p.json_ld"))).withColumn("ld", F.when(F.col("v").isNotNull(), jsonapi.posting(F.col("v"))))
    title = title_cleaned(first_present(F.col("ld.title"), F.col("p.title")))
    desc = F.coalesce(F.when(F.col("ld.description").isNotNull(), tidy(F.regexp_replace("ld.description", r"<[^<>]*>", "\n"))), tidy(F.col("p.description")))
    full = F.concat_ws(" ", F.col("title"), F.col("description"))
    # the info box: its first line is the place, unless it is the reference; it must read as a place
    line = F.try_element_at(F.filter(F.transform(F.split("p.info", "\n"), strip), lambda x: x != ""), F.lit(1))
    boxed = F.when(~line.startswith("Ref") & (F.contains(line, F.lit(",")) | F.lower(line).rlike("|".join(PLACE_WORDS))), line)
    dated = F.nullif(F.regexp_extract("p.info", r"(?i)Date published:\s*(\d{1,2}-\w{3}-\d{4})", 1), F.lit(""))
    out = ld.withColumns({"title": title, "description": desc})
    return out.select(
        *keep, U.job_id(F.col("__url")).alias("job_id"), "title", "description", F.col("__url").alias("application_url"),
        first_present(F.col("ld.company_name"), U.company(F.col("__url"))).alias("company_name"),
        location_cleaned(first_present(F.col("ld.location"), boxed, F.col("p.location"), infer.location_text(F.col("p.text")))).alias("location"),
        infer.remote_type(full, F.col("ld.remote_type")).alias("remote_type"),
        F.when(F.col("ld").isNotNull(), F.col("ld.employment_type")).otherwise(infer.employment_type(full)).alias("employment_type"),
        first_present(F.col("ld.department"), F.col("p.department")).alias("department"),
        infer.experience_level(full, F.col("ld.experience_level")).alias("experience_level"),
        infer.salary(full, F.col("ld.salary_range")).alias("salary_range"),
        first_present(F.col("ld.date_posted"), dated, F.col("p.date_text"), infer.date_text(F.col("p.text"))).alias("date_posted"),
    )


def listing_rows(pages: DataFrame, url: str, html: str, keep: list[str]) -> DataFrame:
    """A row per opening on each listing page."""
    rows = pages.select(*keep, F.explode(dom.listing_jobs(F.col(html), F.col(url))).alias("j"))
    return rows.select(*keep, title_cleaned(F.col("j.title")).alias("title"), F.col("j.application_url").alias("application_url"), U.job_id(F.col("j.application_url")).alias("job_id"), location_cleaned(F.col("j.location")).alias("location"), F.col("j.department").alias("department"))


def anchors(pages: DataFrame, html: str, keep: list[str], pattern: str = r"JobDetail|FolderDetail|/job/|/position/|/careers/Apply/", least: int = 3) -> DataFrame:
    """(keep, href, label): links whose address looks like a detail page and whose text is longer than ``least``."""
    tag = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"']?[^\"'>\s]+[\"']?[^>]*>.*?</a>"), F.lit(0))
    rows = pages.select(*keep, F.explode(tag).alias("a"))
    label = F.trim(F.regexp_replace(F.regexp_replace("a", r"<[^>]*>", ""), r"\s+", " "))
    out = rows.select(*keep, F.regexp_extract("a", r"(?i)href\s*=\s*[\"']?([^\"'>\s]+)", 1).alias("href"), label.alias("label"))
    return out.filter(F.col("href").rlike(f"(?i){pattern}") & (F.length("label") > least))
