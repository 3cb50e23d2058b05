"""The record's fields and the rules that refer to them."""

from pyspark.sql import types as T

# The fields of a record and the groups that rules and scores use.
FIELDS = (
    "job_id", "title", "description", "description_html", "application_url", "company_name", "location", "remote_type",
    "employment_type", "department", "experience_level", "salary_range", "date_posted", "date_scraped",
)
REQUIRED = ("title", "application_url")
IMPORTANT = ("description", "job_id", "company_name", "location")
METADATA = ("remote_type", "employment_type", "department", "experience_level", "salary_range", "date_posted")
NULL_WORDS = ("null", "undefined", "none", "n/a", "")
TITLE_LENGTH, DESCRIPTION_LENGTH = (3, 500), (50, 50_000)

RECORD = T.StructType([T.StructField(f, T.StringType()) for f in FIELDS])
PROVENANCE = ("portal_url", "extraction_method")
METHOD_PRIORITY = {"api": 1, "http": 2, "playwright": 3}
