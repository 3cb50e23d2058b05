"""Queries of the general operators, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import skew, timestamps
from ..runtime import missing, table
from . import reference


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return skew.dominant_keys(table(spark, d, "job"), "company_name", 0.02, spread=F.col("row_id"))


def p1_company_index(spark: SparkSession, d: str) -> DataFrame:
    """Rows and up to three sample titles per company."""
    return skew.company_index(table(spark, d, "job"))


def p1_company_profile(spark: SparkSession, d: str) -> DataFrame:
    """Per company: rows, rows with a description, characters of descriptions, first and last row, mean title length."""
    job = table(spark, d, "job")
    return skew.salted_aggregate(
        job,
        "company_name",
        [
            skew.count("job_count"),
            skew.count_if(~missing("description"), "described"),
            skew.total(F.coalesce(F.length("description"), F.lit(0)), "description_chars"),
            skew.least(F.col("row_id"), "first_row"),
            skew.most(F.col("row_id"), "last_row"),
            skew.mean(F.length("title").cast("double"), "mean_title_chars"),
        ],
        spread=F.col("row_id"),
    ).withColumn("mean_title_chars", F.round("mean_title_chars", 6))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    job, portal = table(spark, d, "job"), table(spark, d, "portal")
    return timestamps.rewritten(timestamps.normalise_timestamps(job, "row_id", "portal_url", ["date_posted", "date_scraped"], portal))


def queries() -> dict:
    return reference.queries() | {f.__name__: f for f in (p1_found, p1_company_index, p1_company_profile, p5_found)}
