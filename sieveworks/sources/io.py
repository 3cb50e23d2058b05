"""Readers and writers of the formats that captures come and go in."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.text import strip


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Whole-file JSON documents; a schema spares the inference scan."""
    r = spark.read.option("multiLine", True)
    return (r.schema(schema) if schema else r).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """One object per line; blank lines are skipped."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """(url): stripped non-empty lines."""
    return spark.read.text(path).select(strip(F.col("value")).alias("url")).filter(F.col("url") != "")


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    """(url): addresses as they stand, bare domains as https addresses of their careers page; blank and # lines skipped."""
    v = read_urls(spark, path).filter(~F.startswith("url", F.lit("#")))
    return v.select(F.when(F.startswith("url", F.lit("http")), F.col("url")).otherwise(F.concat(F.lit("https://"), F.col("url"), F.lit("/careers"))).alias("url"))


def read_page_size(spark: SparkSession, path: str, default: int = 10) -> int:
    """The most common page size of a pattern file, or the default."""
    schema = "pagination struct<jobRecordsPerPage_analysis: struct<most_common: array<array<int>>>>"
    row = read_json(spark, path, schema).select(F.col("pagination.jobRecordsPerPage_analysis.most_common")[0][0].alias("n")).first()
    return default if row is None or row.n is None else int(row.n)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON array documents, indented: one per partition, so no task holds the table."""
    doc = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false", "pretty": "true"}).alias("value"))

    def join(it):
        import pandas as pd

        first = True
        for pdf in it:
            if len(pdf):
                yield pd.DataFrame({"value": (["["] if first else [","]) + [",\n".join(pdf["value"])]})
                first = False
        if not first:
            yield pd.DataFrame({"value": ["]"]})

    doc.mapInPandas(join, "value string").write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, *more: DataFrame) -> bool:
    """Header and the union of all tables' columns in sorted order; nothing is written where all are empty."""
    for d in more:
        df = df.unionByName(d, allowMissingColumns=True)
    if df.isEmpty():
        return False
    df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)]).write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return True


def write_urls(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).filter("value is not null").write.mode("overwrite").text(path)


def write_categories(cats: DataFrame, path: str) -> None:
    """A folder of addresses per category."""
    cats.select(F.col("url").alias("value"), "category").write.mode("overwrite").partitionBy("category").text(path)


def write_all(df: DataFrame, path: str, formats: tuple[str, ...] = ("json", "csv", "jsonl")) -> None:
    """The same rows in several formats."""
    for f in formats:
        {"json": write_json, "csv": write_csv, "jsonl": write_jsonl}[f](df, f"{path}/{f}")


def append_checkpoint(df: DataFrame, path: str, key: str = "url") -> None:
    """Appends a row for each key that isn't in the checkpoint yet; resuming is by key, so order and counts don't matter."""
    new = df.dropDuplicates([key])
    try:
        done = df.sparkSession.read.parquet(path).select(F.col(key).alias("__k"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # there is a checkpoint, but it can't be read
            raise
    else:
        new = new.join(done, F.col(key) == F.col("__k"), "left_anti")
    new.write.mode("append").parquet(path)


def read_captured(spark: SparkSession, path: str) -> DataFrame:
    """(site, page_no, kind, body) of captured .html and .json files under a folder of any store: the site is the file's folder,
    the page number the digits after the last underscore of its name, 0 without any."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{html,json}").text(path, wholetext=True)
    name = F.try_url_decode(F.input_file_name())
    site, last = F.regexp_extract(name, r"([^/]*)/[^/]*$", 1), F.regexp_extract(name, r"([^/_]*)\.(?:html|json)$", 1)
    page = F.coalesce(F.regexp_replace(last, r"\D+", "").try_cast("int"), F.lit(0))
    return files.select(site.alias("site"), page.alias("page_no"), F.regexp_extract(name, r"\.(\w+)$", 1).alias("kind"), F.col("value").alias("body"))
