"""Rollups over sites, fingerprints, facets and runs; joins and set operations between captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.infer import parsed_date
from ..functions.text import first_present
from ..runtime import materialise
from ..schema import METHOD_PRIORITY


def run_stats(sites: DataFrame) -> DataFrame:
    """One row: sites, successes, failures, success rate, sites by method, mean duration and pages."""
    ok = F.coalesce(F.col("success"), F.lit(False))
    return sites.agg(
        F.count(F.lit(1)).alias("total_sites"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"),
        F.round(F.try_divide(F.count_if(ok), F.count(F.lit(1))), 6).alias("success_rate"),
        *[F.count_if(ok & (F.col("method") == m)).alias(f"{m}_sites") for m in METHOD_PRIORITY],
        F.round(F.avg("duration_seconds"), 6).alias("avg_duration"), F.coalesce(F.sum(F.col("pages_scraped").cast("long")), F.lit(0)).alias("pages"),
    )


def method_pivot(sites: DataFrame) -> DataFrame:
    """(url, api, http, playwright): results per site and method."""
    return sites.groupBy("url").pivot("method", list(METHOD_PRIORITY)).agg(F.count(F.lit(1))).na.fill(0)


def failed_sites(sites: DataFrame) -> DataFrame:
    """(url, error) of each failed result; a failure without a text is 'Unknown error'."""
    return sites.filter(~F.coalesce("success", F.lit(False))).select("url", first_present(F.col("error"), F.lit("Unknown error")).alias("error"))


def cascade(sites: DataFrame, has_rows: Column) -> DataFrame:
    """The first method by priority whose result has rows, per site; the aggregation's minimum, so no window over a hot site."""
    rank = F.create_map(*[F.lit(x) for k, v in METHOD_PRIORITY.items() for x in (k, v)])
    used = sites.filter(has_rows & F.col("method").isin(*METHOD_PRIORITY))
    return used.groupBy("url").agg(F.min(F.struct(F.try_element_at(rank, "method").alias("p"), F.col("result_id").alias("id"), F.col("method").alias("m"))).alias("x")).select("url", F.col("x.m").alias("method"), F.col("x.id").alias("result_id"))


def categories(sites: DataFrame, jobs: DataFrame, as_of: str, days: int = 60) -> DataFrame:
    """(url, category, jobs, latest): broken without success or rows; stale if the latest readable day is older; else working."""
    n = jobs.groupBy(F.col("portal_url").alias("p")).agg(F.count(F.lit(1)).alias("jobs"), F.max(parsed_date(F.col("date_posted"))).alias("latest"))
    ok = sites.groupBy("url").agg(F.max(F.coalesce("success", F.lit(False))).alias("ok"))
    both = ok.join(n, F.col("url") == F.col("p"), "left")
    edge = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS")
    return both.select(
        "url", F.when(~F.col("ok") | F.col("jobs").isNull(), "broken").when(F.col("latest").isNull() | (F.col("latest") >= edge), "working").otherwise("stale").alias("category"),
        F.coalesce("jobs", F.lit(0)).alias("jobs"), F.date_format("latest", "yyyy-MM-dd HH:mm:ss").alias("latest"),
    )


def category_summary(cats: DataFrame) -> DataFrame:
    """One row: sites by category and the mean of all jobs over the working sites."""
    working = F.count_if(F.col("category") == "working")
    return cats.agg(
        working.alias("working"), F.count_if(F.col("category") == "stale").alias("stale"), F.count_if(F.col("category") == "broken").alias("broken"),
        F.coalesce(F.round(F.try_divide(F.sum("jobs"), working), 6), F.lit(0.0)).alias("avg_jobs_per_working_site"),
    )


def coverage(raw: DataFrame, unique: DataFrame, valid: DataFrame) -> DataFrame:
    """One row: raw, unique and valid rows, and the share that dedup removed (0 for no rows)."""
    n = [d.agg(F.count(F.lit(1))).scalar() for d in (raw, unique, valid)]
    return raw.sparkSession.range(1).select(
        n[0].alias("raw_jobs"), n[1].alias("unique_jobs"), n[2].alias("valid_jobs"), F.coalesce(F.round(F.try_divide(n[0] - n[1], n[0]), 6), F.lit(0.0)).alias("dedup_rate")
    )


def fingerprint_summary(fp: DataFrame, yield_per_site: int = 150) -> DataFrame:
    match = F.coalesce(F.col("is_match"), F.lit(False))
    return fp.agg(
        F.count(F.lit(1)).alias("tested"), F.count_if(match).alias("matched"), F.round(F.coalesce(F.try_divide(F.count_if(match), F.count(F.lit(1))), F.lit(0.0)), 6).alias("match_rate"),
        (F.count_if(match) * yield_per_site).alias("estimated_yield"),
    )


def ranked_fingerprints(fp: DataFrame, k: int = 20, signals: int = 3) -> DataFrame:
    """The k matches of highest confidence, with their first signals."""
    top = fp.filter("is_match").orderBy(F.desc("confidence_score"), "fingerprint_id").limit(k)
    return top.select("fingerprint_id", "url", "confidence_score", F.array_join(F.slice(F.coalesce("signals", F.array().cast("array<string>")), 1, signals), "; ").alias("top_signals"))


def signal_counts(fp: DataFrame) -> DataFrame:
    """(signal, n, endpoints): rows per signal and the distinct endpoints seen with it."""
    return fp.select(F.explode("signals").alias("signal"), "fingerprint_id").groupBy("signal").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("fingerprint_id").alias("pages"))


def merged_details(listing: DataFrame, detail: DataFrame, key: str, fields: list[str], least: int = 50) -> DataFrame:
    """Listing rows with each field from the detail row unless missing there; a detail counts only with a description over ``least``."""
    good = detail.filter(F.length("description") > least).select(F.col(key).alias("__k"), *[F.col(f).alias(f"__{f}") for f in fields])
    return listing.join(good, F.col(key) == F.col("__k"), "left").select(key, *[first_present(F.col(f"__{f}"), F.col(f)).alias(f) for f in fields])


def pending(urls: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose key isn't done yet: resuming by key, not by count."""
    return urls.join(done.select(F.col(key).alias("__d")).distinct(), F.col(key) == F.col("__d"), "left_anti")


def known(urls: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    return urls.join(done.select(F.col(key).alias("__d")).distinct(), F.col(key) == F.col("__d"), "left_semi")


def union_batches(*batches: DataFrame) -> DataFrame:
    """Bag union by name over the union of the columns."""
    out = batches[0]
    for b in batches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def paging_stop(pages: DataFrame, site: str, page: str, url: str) -> DataFrame:
    """Rows of the pages before each site's first page that adds no new address.

    A page's new addresses are those whose first page it is: a minimum per (site, url), no window over a site.
    """
    first = pages.groupBy(F.col(site).alias("__s"), F.col(url).alias("__u")).agg(F.min(page).alias("__p"))
    fresh = first.groupBy("__s", "__p").agg(F.count(F.lit(1)).alias("__new"))
    seen = pages.select(F.col(site).alias("s2"), F.col(page).alias("p2")).distinct()
    dry = seen.join(fresh, (F.col("s2") == F.col("__s")) & (F.col("p2") == F.col("__p")), "left_anti").groupBy("s2").agg(F.min("p2").alias("stop"))
    return pages.join(dry, F.col(site) == F.col("s2"), "left").filter(F.col("stop").isNull() | (F.col(page) < F.col("stop"))).drop("s2", "stop")


def pages_by_total(pages: DataFrame, site: str, page: str, total: str, per_page: int) -> DataFrame:
    """Pages of an interface that states its total: those whose offset lies below it, up to the first page without records.

    ``pages``: a row per page, from 1, with its number of records ``n`` and the stated ``total``. Where no page states one it
    is 0, which ends after the first page. A site's pages are looked up by their first empty one, without a window.
    """
    ends = pages.groupBy(F.col(site).alias("__s")).agg(F.max(F.coalesce(total, F.lit(0))).alias("__t"), F.min(F.when(F.col("n") == 0, F.col(page))).alias("__e"))
    got = pages.join(ends, F.col(site) == F.col("__s"))
    return got.filter(((F.col(page) == 1) | ((F.col(page) - 1) * per_page < F.col("__t"))) & (F.col("__e").isNull() | (F.col(page) < F.col("__e")))).drop("__s", "__t", "__e")


def pages_until_empty(pages: DataFrame, site: str, page: str, empties: int = 2, most: int = 200) -> DataFrame:
    """Pages with records before the first run of ``empties`` pages without any; ``most`` is the interface's own limit of pages."""
    dry = pages.filter((F.col("n") == 0) & (F.col(page) <= most)).select(F.col(site).alias("__s"), F.col(page).alias("__p"))
    # a run starts where as many empty pages follow one another: page - 0, page - 1, ... all vote for their start
    starts = dry.select("__s", F.explode(F.array(*[F.col("__p") - i for i in range(empties)])).alias("__a")).groupBy("__s", "__a").agg(F.count(F.lit(1)).alias("c"))
    stop = starts.filter(F.col("c") == empties).groupBy("__s").agg(F.min("__a").alias("__stop"))
    got = pages.filter((F.col("n") > 0) & (F.col(page) <= most)).join(stop, F.col(site) == F.col("__s"), "left")
    return got.filter(F.col("__stop").isNull() | (F.col(page) < F.col("__stop"))).drop("__s", "__stop")


def first_rows(df: DataFrame, order: str, n: int | None) -> DataFrame:
    """The first ``n`` rows in the order of a column, for a trial run; all without ``n`` or with one below 1."""
    return df if not n or n < 1 else df.orderBy(order).limit(n)


def recon_summary(recon: DataFrame) -> DataFrame:
    """One row: sites analysed, interfaces found (array ``apis``) and hidden parameters (map ``params``: kind -> names) in all."""
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    named = F.coalesce(F.aggregate(F.map_values("params"), F.lit(0).cast("long"), lambda acc, x: acc + size(x)), F.lit(0).cast("long"))
    return recon.agg(F.count(F.lit(1)).alias("sites"), F.coalesce(F.sum(size("apis")), F.lit(0)).alias("apis"), F.coalesce(F.sum(named), F.lit(0)).alias("parameters"))


def chunked(df: DataFrame, order: str, n: int) -> DataFrame:
    """Adds chunk: fixed-size groups in the order of a column, by range partitions and their row counts instead of one global window."""
    spark = df.sparkSession
    parts = df.repartitionByRange(order).sortWithinPartitions(order).withColumn("__p", F.spark_partition_id())
    parts = materialise(parts)
    before = parts.groupBy("__p").agg(F.count(F.lit(1)).alias("c")).orderBy("__p").collect()  # a row per partition
    at, rows = 0, []
    for r in before:
        rows.append((r["__p"], at))
        at += r.c
    off = F.broadcast(spark.createDataFrame(rows, "__q int, __off long"))
    ranked = parts.withColumn("__r", F.row_number().over(W.partitionBy("__p").orderBy(order)))
    return ranked.join(off, F.col("__p") == F.col("__q")).withColumn("chunk", F.floor((F.col("__off") + F.col("__r") - 1) / n).cast("long")).drop("__p", "__q", "__r", "__off")


def junk_removed(df: DataFrame, titles: tuple[str, ...] = ("email", "linkedin", "facebook", "twitter", "share", "print"), marks: str = r"mailto:|wa\.me|linkedin\.com/share|facebook\.com/sharer|twitter\.com/intent") -> DataFrame:
    """Rows that are neither share links by title nor by address; off in the default pipeline."""
    bad = F.lower(F.trim(F.coalesce("title", F.lit("")))).isin(*titles) | F.lower(F.coalesce("application_url", F.lit(""))).rlike(marks)
    return df.filter(~bad)


def recommendations(recon: DataFrame) -> DataFrame:
    """(url, messages): ordered advice by what was found; a default where nothing was."""
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    say = F.array_compact(F.array(
        F.when(n("apis") > 0, F.concat(F.lit("endpoints for direct extraction: "), n("apis").cast("string"))),
        F.when(n("exports") > 0, F.concat(F.lit("bulk exports to try first: "), n("exports").cast("string"))),
        F.when(F.coalesce("graphql", F.lit(False)), F.lit("query language available: read its schema")),
        F.when(n("params") > 0, F.concat(F.lit("hidden parameters for filtering: "), n("params").cast("string"))),
    ))
    return recon.select("url", F.when(F.size(say) > 0, say).otherwise(F.array(F.lit("little found: a rendered capture may be needed"))).alias("messages"))

