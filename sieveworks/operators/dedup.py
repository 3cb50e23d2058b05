"""Hash keys, keep-first strategies, duplicate analysis and similar titles.

Keep-first needs an order: every operator takes the column that gives it. A hot key is no hot task: the first row per key is
an aggregated minimum, and the rows meet it again by a join that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip, text


def _norm(c: str) -> Column:
    return F.lower(strip(text(c)))


def content_hash() -> Column:
    return F.sha2(F.concat_ws("|", _norm("title"), _norm("description"), _norm("location")), 256)


def title_hash() -> Column:
    return F.sha2(F.concat_ws("|", _norm("company_name"), _norm("title")), 256)


def url_hash() -> Column:
    return F.sha2(_norm("application_url"), 256)


def keep_first(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key by ``order``; missing keys are one key. ``order`` must be unique."""
    firsts = df.groupBy(key.alias("__k")).agg(F.min(order).alias("__first")).select("__first")
    return df.join(firsts, F.col(order) == F.col("__first"), "left_semi")


STRATEGIES = {"content": content_hash, "title": title_hash, "url": url_hash}


def deduplicated(df: DataFrame, strategy: str = "hybrid", order: str = "row_id", keep_missing_urls: bool = False) -> DataFrame:
    """content, title, url, identifier or hybrid; an unknown name means content.

    hybrid: first by address, then by content, then repeated titles of a company are flagged. Rows without an address count
    as one address, unless ``keep_missing_urls``. identifier: by id, then address, then company, title and place.
    """
    if strategy == "hybrid":
        key = url_hash()
        if keep_missing_urls:
            key = F.when(_norm("application_url") != "", url_hash()).otherwise(F.concat(F.lit("row "), F.col(order).cast("string")))
        out = keep_first(keep_first(df, key, order), content_hash(), order)
        return flagged_titles(out, order)
    if strategy == "identifier":
        own = lambda c, k: F.when(c != "", F.sha2(c, 256)).otherwise(F.concat(F.lit(f"{k} "), F.col(order).cast("string")))
        out = keep_first(df, own(_norm("job_id"), "id"), order)
        out = keep_first(out, own(_norm("application_url"), "url"), order)
        return keep_first(out, F.sha2(F.concat_ws("|", _norm("company_name"), _norm("title"), _norm("location")), 256), order)
    return keep_first(df, STRATEGIES.get(strategy, content_hash)(), order)


def flagged_titles(df: DataFrame, order: str = "row_id") -> DataFrame:
    """Adds has_title_duplicate: whether another row has the same company and title."""
    rows = df.withColumn("title_hash", title_hash())
    often = rows.groupBy(F.col("title_hash").alias("__t")).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__t")
    return rows.join(often, F.col("title_hash") == F.col("__t"), "left").withColumn("has_title_duplicate", F.col("__t").isNotNull()).drop("__t")


def dedup_stats(df: DataFrame, order: str = "row_id") -> DataFrame:
    """One row: rows before and after the hybrid strategy, what each step removed, and flagged title groups."""
    by_url = keep_first(df, url_hash(), order)
    by_content = keep_first(by_url, content_hash(), order)
    groups = by_content.groupBy(title_hash().alias("t")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.count(F.lit(1))).scalar()
    n0, n1, n2 = (d.agg(F.count(F.lit(1))).scalar() for d in (df, by_url, by_content))
    return df.sparkSession.range(1).select(
        n0.alias("total_input"), n2.alias("total_output"), (n0 - n2).alias("duplicates_removed"), (n0 - n1).alias("url_duplicates"), (n1 - n2).alias("content_duplicates"), groups.alias("title_duplicates_flagged")
    )


def duplicate_analysis(df: DataFrame) -> DataFrame:
    """(kind, duplicate_groups, total_affected) for the three hashes, from one scan."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), f().alias("h")) for k, f in STRATEGIES.items()])
    n = df.select(F.explode(kinds).alias("x")).groupBy("x.kind", "x.h").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("kind").agg(F.count_if(F.col("n") > 1).alias("duplicate_groups"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("total_affected"))


def duplicates_by_company(df: DataFrame, order: str = "row_id", k: int = 20) -> DataFrame:
    """The k companies with most surplus copies, a group's company being that of its first row."""
    groups = df.groupBy(content_hash().alias("h")).agg(F.count(F.lit(1)).alias("n"), F.min_by(F.coalesce("company_name", F.lit("Unknown")), order).alias("company"), F.min(order).alias("o")).filter("n > 1")
    sums = groups.groupBy("company").agg(F.sum(F.col("n") - 1).alias("duplicates"), F.min("o").alias("o"))
    return sums.orderBy(F.desc("duplicates"), "o").limit(k).select("company", "duplicates")


def _word_sets(df: DataFrame, order: str, cap: int | None) -> DataFrame:
    """(row_id, w): each row's title as its sorted distinct words; titles without words are left out."""
    rows = df.filter(F.col("title").isNotNull())
    if cap is not None:
        rows = rows.orderBy(order).limit(cap)
    words = F.array_sort(F.array_distinct(F.filter(F.split(F.lower("title"), r"(?U)\s+"), lambda w: w != "")))
    return rows.select(F.col(order).alias("row_id"), words.alias("w")).filter(F.size("w") > 0)


def title_groups(df: DataFrame, order: str = "row_id", cap: int | None = None) -> DataFrame:
    """(row_id, class_id, words) of each row whose title has words: rows of one word set are a class, named by its first row.

    ``words`` is what ``similar_titles`` calls the class in title_a and title_b.
    """
    rows = _word_sets(df, order, cap).select("row_id", F.array_join("w", " ").alias("words"))
    firsts = rows.groupBy(F.col("words").alias("__w")).agg(F.min("row_id").alias("class_id"))
    return rows.join(firsts, F.col("words") == F.col("__w")).select("row_id", "class_id", "words")


def similar_titles(df: DataFrame, order: str = "row_id", threshold: float = 0.8, cap: int | None = None) -> DataFrame:
    """(title_a, title_b, similarity) of the distinct titles whose word sets have Jaccard in [threshold, 1).

    Words are ordered by rarity and only prefixes are joined, so no pair without a rare word in common is ever made; pairs whose
    lengths, or the words after the common one, rule the threshold out go no further. Titles of one word set are one;
    ``title_groups`` gives the rows of each. ``cap``: only the first rows, as an option.
    """
    sets = _word_sets(df, order, cap).select("w").distinct()
    freq = sets.select(F.explode("w").alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    long = sets.select("w", F.explode("w").alias("tok")).join(freq, "tok")
    ordered = long.groupBy("w").agg(F.array_sort(F.collect_list(F.struct("df", "tok"))).alias("o"))
    n = F.size("w")
    pre = ordered.select("w", F.posexplode(F.slice("o", F.lit(1), n - F.ceil(F.lit(threshold) * n).cast("int") + 1)).alias("pos", "x")).select("w", "pos", F.col("x.tok").alias("tok"))
    a, b = pre.select(F.col("w").alias("a"), F.col("pos").alias("i"), "tok"), pre.select(F.col("w").alias("b"), F.col("pos").alias("j"), "tok")
    na, nb = F.size("a"), F.size("b")
    need = F.ceil(F.lit(threshold / (1 + threshold)) * (na + nb) - F.lit(1e-9))
    reach = 1 + F.least(F.col("i"), F.col("j")) + F.least(na - F.col("i"), nb - F.col("j")) - 1
    pairs = a.join(b, "tok").filter((F.col("a") < F.col("b")) & (na >= F.lit(threshold) * nb) & (nb >= F.lit(threshold) * na) & (reach >= need)).select("a", "b").distinct()
    both = F.size(F.array_intersect("a", "b"))
    out = pairs.withColumn("similarity", both / (na + nb - both)).filter((F.col("similarity") >= threshold) & (F.col("similarity") < 1))
    return out.select(F.array_join("a", " ").alias("title_a"), F.array_join("b", " ").alias("title_b"), F.round("similarity", 6).alias("similarity"))


def top_similar(df: DataFrame, k: int = 100) -> DataFrame:
    """The k most similar pairs."""
    return df.orderBy(F.desc("similarity"), "title_a", "title_b").limit(k)
