"""The batch pipeline: clean, remove duplicates, validate, score, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators import dedup, quality, report
from ..runtime import materialise
from ..sources import io


@dataclass(frozen=True)
class Config:
    strategy: str = "hybrid"
    order: str = "row_id"
    compat: bool = True
    junk_filter: bool = False
    formats: tuple[str, ...] = ("json", "csv", "jsonl")


@dataclass(frozen=True)
class Result:
    checked: DataFrame
    valid: DataFrame
    invalid: DataFrame
    coverage: DataFrame
    quality: DataFrame


def run(jobs: DataFrame, config: Config = Config()) -> Result:
    """Cleaning comes before hashing; the checked rows are written once and split from there."""
    raw = report.junk_removed(jobs) if config.junk_filter else jobs
    clean = quality.normalised(raw)
    unique = dedup.deduplicated(clean, config.strategy, config.order, keep_missing_urls=not config.compat)
    checked = materialise(quality.validated(unique).withColumn("quality_score", quality.score()))
    valid, invalid = checked.filter("is_valid"), checked.filter("not is_valid")
    return Result(checked, valid, invalid, report.coverage(jobs, checked, valid), quality.batch_quality(valid))


def write(result: Result, path: str, sites: DataFrame | None = None, config: Config = Config()) -> None:
    """Valid rows in all formats, failed sites and the one-row reports."""
    flat = result.valid.drop("validation_errors", "validation_warnings")
    io.write_all(flat, f"{path}/jobs", config.formats)
    if sites is not None:
        io.write_jsonl(report.failed_sites(sites), f"{path}/failed_sites")
    io.write_jsonl(result.coverage.select("*", F.lit("coverage").alias("report")), f"{path}/coverage")
    io.write_jsonl(result.quality, f"{path}/quality")
