"""Queries of the text operators, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..runtime import materialise, table
from ..schema import FIELDS
from . import boilerplate, canonical, lines, mixture, packing, residue, survivor, truncation

def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return lines.repeated_lines(table(spark, d, "job"), "row_id", "description", "company_name").select("row_id", "line_no")


def p2_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The blocks: number of lines, documents, places, and where each stands first."""
    blocks = lines.find_blocks(table(spark, d, "job"), "row_id", "description", "company_name")[1]
    return blocks.select(F.col("source").alias("company_name"), "n_lines", "docs", "occurrences", "first_row", "first_line")


def p2_cleaned(spark: SparkSession, d: str) -> DataFrame:
    job = table(spark, d, "job")
    return lines.without_lines(job, "row_id", "description", p2_found(spark, d), "description")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.find_residue(table(spark, d, "job"), "row_id", ["title", "description"])


def p3_kept(spark: SparkSession, d: str) -> DataFrame:
    """The records without residue, with all their columns."""
    job = table(spark, d, "job")
    bad = p3_found(spark, d).select(F.col("row_id").alias("r")).distinct()
    return job.join(bad, F.col("row_id") == F.col("r"), "left_anti")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    job = table(spark, d, "job")
    places = canonical.map_places(job, "row_id", "location", table(spark, d, "place_ref"))
    kinds = canonical.map_employment(job, "row_id", "employment_type", table(spark, d, "employment_ref"), survivor.record_keys("application_url", "company_name", "job_id"))
    return places.select("row_id", F.lit("location").alias("field"), "ref_id").union(kinds.select("row_id", F.lit("employment_type").alias("field"), "ref_id"))


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that name no entry, with their number of rows."""
    job = table(spark, d, "job").select(F.col("row_id").alias("r"), "location", "employment_type")
    none = p4_found(spark, d).filter("ref_id = 0").join(job, F.col("row_id") == F.col("r"))
    value = F.when(F.col("field") == "location", F.col("location")).otherwise(F.col("employment_type"))
    return none.groupBy("field", value.alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.find_furniture(table(spark, d, "job"), "row_id", "description_html", "description", "portal_url")


def p6_body(spark: SparkSession, d: str) -> DataFrame:
    """Each captured description without the page's furniture."""
    job = table(spark, d, "job")
    found = p6_found(spark, d).filter("field = 'description'").select("row_id", "line_no")
    return lines.without_lines(job, "row_id", "description", found, "body")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.best_rows(table(spark, d, "job"), table(spark, d, "portal"), table(spark, d, "place_ref"))


def p7_records(spark: SparkSession, d: str) -> DataFrame:
    """The deduplicated table: one record per opening with all its fields."""
    return survivor.surviving_records(table(spark, d, "job"), table(spark, d, "portal"), table(spark, d, "place_ref"), FIELDS)


def _sizes(spark: SparkSession, d: str, tokenizer: str = packing.TOKENIZER) -> DataFrame:
    return materialise(packing.token_counts(table(spark, d, "documents"), "doc_id", "text", ["source"], tokenizer))


def _packed(spark: SparkSession, d: str, tokenizer: str = packing.TOKENIZER) -> DataFrame:
    sizes = materialise(packing.sized_texts(table(spark, d, "documents"), "doc_id", "text", "source", tokenizer))
    return packing.pack(sizes, table(spark, d, "pack_spec"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d).drop("cluster").withColumnRenamed("row_id", "doc_id")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Per container size: the fill, and how many containers hold two copies of a text (none)."""
    return packing.fill_report(_packed(spark, d))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixture.shuffled(materialise(mixture.draw(_sizes(spark, d), table(spark, d, "mix_target")))).withColumnRenamed("row_id", "doc_id")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    sizes, targets = _sizes(spark, d), table(spark, d, "mix_target")
    return mixture.share_report(materialise(mixture.draw(sizes, targets)), sizes, targets)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    got = truncation.scores(table(spark, d, "documents"), "doc_id", "text", "lang", "source")
    return got.filter("cut").select(F.col("row_id").alias("doc_id"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    """Per source: texts, cut texts and their share."""
    got = truncation.scores(table(spark, d, "documents"), "doc_id", "text", "lang", "source")
    return got.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count_if("cut").alias("cut"), F.avg(F.col("cut").cast("double")).alias("cut_share"))


def queries() -> dict:
    return {
        f.__name__: f
        for f in (p2_found, p2_blocks, p2_cleaned, p3_found, p3_kept, p4_found, p4_unmatched, p6_found, p6_body, p7_found, p7_records, p8_containers, p8_fill, p9_mixture, p9_shares, p10_found, p10_rates)
    }
