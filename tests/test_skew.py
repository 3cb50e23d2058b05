from collections import Counter

from pyspark.sql import functions as F

from sieveworks.operators import skew

ROWS = [(i, "hot" if i % 3 else (f"c{i % 7}" if i % 2 else None), f"t{i}" if i % 5 else None) for i in range(300)] + [(1000, "  ", "x"), (1001, "", "y"), (1001, "", "y")]


def jobs(spark):
    return spark.createDataFrame(ROWS, "row_id long, company_name string, title string").withColumn("__key", F.lit(1)).withColumn("n", F.lit(2))


def named():
    return [r for r in ROWS if r[1] and r[1].strip()]


def test_counts_match_plain_grouping(spark):
    got = {r.company_name: r.n for r in skew.salted_aggregate(jobs(spark).drop("n", "__key"), "company_name", [skew.count()], spread=F.col("row_id"), min_share=0.1).collect()}
    assert got == Counter(r[1] for r in named())


def test_dominant_keys_and_clashing_columns(spark):
    assert [r.company_name for r in skew.dominant_keys(jobs(spark), "company_name", 0.02 * 10).collect()] == ["hot"]


def test_company_index_keeps_first_titles(spark):
    got = {r.company: (r.job_count, r.sample_titles) for r in skew.company_index(jobs(spark)).collect()}
    titles = [t for _, c, t in sorted(named(), key=lambda r: r[0]) if c == "hot" and t][:3]
    assert got["hot"] == (sum(r[1] == "hot" for r in named()), titles)


def test_mean_min_max(spark):
    r = skew.salted_aggregate(jobs(spark), "company_name", [skew.mean(F.col("row_id"), "m"), skew.least(F.col("row_id"), "lo"), skew.most(F.col("row_id"), "hi")]).filter("company_name = 'hot'").first()
    ids = [x[0] for x in named() if x[1] == "hot"]
    assert (r.lo, r.hi) == (min(ids), max(ids)) and abs(r.m - sum(ids) / len(ids)) < 1e-9


def test_empty_table(spark):
    empty = jobs(spark).filter("row_id < 0")
    assert skew.company_index(empty).collect() == [] and skew.dominant_keys(empty, "company_name", 0.02).collect() == []
