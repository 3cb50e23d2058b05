"""Validation, normalisation, scores and completeness, all as native expressions in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import present, strip
from ..functions.url import part
from ..schema import DESCRIPTION_LENGTH, FIELDS, IMPORTANT, METADATA, NULL_WORDS, REQUIRED, TITLE_LENGTH


def url_error(c: Column) -> Column:
    """The first rule that an address breaks, NULL if none."""
    scheme = F.lower(part(c, 1))
    return (
        F.when(~present(c), "URL is empty").when(scheme == "", "URL missing scheme (http/https)")
        .when(~scheme.isin("http", "https"), F.concat(F.lit("Invalid URL scheme: "), scheme)).when(part(c, 2) == "", "URL missing domain")
    )


def title_error(c: Column) -> Column:
    lo, hi = TITLE_LENGTH
    bad = F.lower(strip(c)).rlike(r"^[\d\s\-_.]+$|^(null|undefined|none|n/a)$|^loading|^error")
    return (
        F.when(~present(c), "Title is empty").when(F.length(c) < lo, f"Title too short (min {lo} chars)").when(F.length(c) > hi, f"Title too long (max {hi} chars)")
        .when(bad, F.concat(F.lit("Title appears to be garbage: "), F.substring(c, 1, 50)))
    )


def description_error(c: Column) -> Column:
    lo, hi = DESCRIPTION_LENGTH
    return (
        F.when(~present(c), "Description is empty").when(F.length(c) < lo, f"Description too short (min {lo} chars)")
        .when(F.length(c) > hi, f"Description too long (max {hi} chars)").when(F.lower(strip(c)).rlike(r"^(loading|please wait|error)"), "Description appears to be garbage")
    )


def filled(fields: tuple[str, ...] = FIELDS) -> Column:
    return sum((present(f).cast("int") for f in fields[1:]), present(fields[0]).cast("int"))


def validated(df: DataFrame) -> DataFrame:
    """Adds is_valid, errors and warnings. A missing description warns twice, as the rules have it."""
    url, title, desc = F.col("application_url"), F.col("title"), F.col("description")
    errors = [F.when(~present(f), F.lit(f"Missing required field: {f}")) for f in REQUIRED]
    errors.append(F.when(present(url) & url_error(url).isNotNull(), F.concat(F.lit("Invalid application_url: "), url_error(url))))
    warnings = [
        F.when(present(title) & title_error(title).isNotNull(), F.concat(F.lit("Title validation: "), title_error(title))),
        F.when(~present(desc), F.lit("Missing description")).when(description_error(desc).isNotNull(), F.concat(F.lit("Description validation: "), description_error(desc))),
        *[F.when(~present(f), F.lit(f"Missing important field: {f}")) for f in IMPORTANT],
        F.when(filled() < 5, F.concat(F.lit("Low field completeness: only "), filled().cast("string"), F.lit(f"/{len(FIELDS)} fields"))),
    ]
    out = df.withColumns({"validation_errors": F.array_compact(F.array(*errors)), "validation_warnings": F.array_compact(F.array(*warnings))})
    return out.withColumn("is_valid", F.size("validation_errors") == 0)


def histogram(df: DataFrame, column: str) -> DataFrame:
    """(reason, n): messages by their text before the first colon."""
    return df.select(F.explode(column).alias("m")).groupBy(F.substring_index("m", ":", 1).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def normalised(df: DataFrame) -> DataFrame:
    """Fields stripped, null words to NULL, employment, remote and experience values to their standard names."""
    clean = {f: F.when(~F.lower(strip(F.col(f))).isin(*NULL_WORDS), strip(F.col(f))) for f in FIELDS if f in df.columns}
    out = df.withColumns(clean)
    has = lambda f, *w: F.lower(F.col(f)).contains(w[0]) if len(w) == 1 else F.lower(F.col(f)).contains(w[0]) & F.lower(F.col(f)).contains(w[1])
    e, r, x = "employment_type", "remote_type", "experience_level"
    return out.withColumns(
        {
            e: F.when(has(e, "full", "time"), "Full-time").when(has(e, "part", "time"), "Part-time").when(has(e, "contract"), "Contract").when(has(e, "intern"), "Internship").otherwise(F.col(e)),
            r: F.when(has(r, "remote"), "Remote").when(has(r, "hybrid"), "Hybrid").when(has(r, "on", "site"), "Onsite").otherwise(F.col(r)),
            x: F.when(has(x, "entry") | has(x, "junior"), "Entry").when(has(x, "senior") | has(x, "sr"), "Senior").when(has(x, "mid") | has(x, "intermediate"), "Mid")
            .when(has(x, "executive") | has(x, "director"), "Executive").otherwise(F.col(x)),
        }
    )


def score() -> Column:
    """Quality from 0 to 100: required 40, important 30, length of the description 20, metadata 10."""
    n = F.length("description")
    text = F.when(~present("description"), 0).when(n >= 500, 20).when(n >= 200, 15).when(n >= 50, 10).otherwise(5)
    return F.round(filled(REQUIRED) / len(REQUIRED) * 40 + filled(IMPORTANT) / len(IMPORTANT) * 30 + text + filled(METADATA) / len(METADATA) * 10, 1)


def completeness(df: DataFrame) -> DataFrame:
    """(field, share): share of rows with a value, one scan and one aggregation; no rows for an empty table."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(present(f)).alias(f) for f in FIELDS]).filter("n > 0")
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), (F.col(f) / F.col("n")).alias("share")) for f in FIELDS])
    return one.select(F.explode(pairs).alias("x")).select("x.field", F.round("x.share", 6).alias("share"))


def batch_quality(df: DataFrame) -> DataFrame:
    """One row: mean, least and greatest score, score bands and completeness bands."""
    s = df.select(score().alias("s"), (filled() / len(FIELDS)).alias("c"))
    return s.agg(
        F.count(F.lit(1)).alias("jobs"), F.round(F.avg("s"), 1).alias("avg_score"), F.min("s").alias("min_score"), F.max("s").alias("max_score"),
        F.count_if(F.col("s") >= 90).alias("excellent"), F.count_if((F.col("s") >= 70) & (F.col("s") < 90)).alias("good"),
        F.count_if((F.col("s") >= 50) & (F.col("s") < 70)).alias("fair"), F.count_if(F.col("s") < 50).alias("poor"),
        F.count_if(F.col("c") > 0.8).alias("complete"), F.count_if((F.col("c") >= 0.5) & (F.col("c") <= 0.8)).alias("partial"), F.count_if(F.col("c") < 0.5).alias("sparse"),
    )
