"""Per-key results when a few keys hold most rows: two-stage salted aggregation.

Stage one groups by (key, salt), with a salt only on heavy keys; stage two merges the partial results by key.
Every aggregate has a partial form and a merge form, so no task ever holds a whole heavy key.

Defined results
---------------
* rows whose key is missing (NULL, empty, white space) take no part, but count in the total that shares refer to;
* an empty table gives no rows;
* repeated rows count as often as they occur; ties in ``first_k`` go by the order column, then by the value;
* columns of the input that aren't named in the call are pruned, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..runtime import missing

_KEY, _SALT = "__key", "__salt"
#: Rows of a heavy key for each of its salts, beyond the least number of salts.
SALT_ROWS = 5_000_000


@dataclass(frozen=True)
class Agg:
    """An aggregate that can be merged: ``partial`` per (key, salt), ``merge`` over partials, ``final`` at last."""

    name: str
    partial: tuple[Column, ...]
    merge: tuple[str, ...]
    final: str = ""


def count(name: str = "n") -> Agg:
    return Agg(name, (F.count(F.lit(1)),), ("sum",))


def count_if(cond: Column, name: str) -> Agg:
    return Agg(name, (F.count_if(cond),), ("sum",))


def total(c: Column, name: str) -> Agg:
    return Agg(name, (F.sum(c),), ("sum",))


def least(c: Column, name: str) -> Agg:
    return Agg(name, (F.min(c),), ("min",))


def most(c: Column, name: str) -> Agg:
    return Agg(name, (F.max(c),), ("max",))


def mean(c: Column, name: str) -> Agg:
    return Agg(name, (F.sum(c), F.count(c)), ("sum", "sum"), "try_divide({0}, {1})")


def heavy_keys(df: DataFrame, key: str, min_share: float = 0.005) -> DataFrame:
    """Keys with more than ``min_share`` of all rows, with their row counts: fewer than 1 / min_share rows.

    The counting aggregates on the map side, so a hot key reaches the shuffle as one row per task.
    """
    counts = df.groupBy(F.col(key).alias(_KEY)).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter(F.col("rows") > min_share * df.agg(F.count(F.lit(1))).scalar()).filter(~missing(_KEY))


def salted(df: DataFrame, key: str, salts: int, min_share: float, spread: Column) -> DataFrame:
    """Rows with a non-missing key as columns ``__key`` and ``__salt``; the salt is 0 on keys that aren't heavy.

    A heavy key has as many salts as its rows ask for, ``salts`` at least. The heavy keys are broadcast: 1 / min_share of them at most.
    """
    hot = F.broadcast(heavy_keys(df, key, min_share).select(F.col(_KEY).alias("__hot"), F.greatest(F.lit(salts), F.ceil(F.col("rows") / SALT_ROWS)).alias("__salts")))
    rows = df.filter(~missing(key)).withColumn(_KEY, F.col(key))
    return rows.join(hot, F.col(_KEY) == F.col("__hot"), "left").withColumn(
        _SALT, F.when(F.col("__hot").isNotNull(), F.pmod(F.xxhash64(spread), F.col("__salts"))).otherwise(F.lit(0)).cast("int")
    )


def salted_aggregate(
    df: DataFrame, key: str, aggs: Sequence[Agg], spread: Column | None = None, salts: int = 32, min_share: float = 0.005
) -> DataFrame:
    """One row per non-missing key with the given aggregates, in two stages.

    ``spread`` gives the salt of a row (a row id, say) and is random where absent.
    """
    rows = salted(df, key, salts, min_share, F.rand(7) if spread is None else spread)
    part = rows.groupBy(_KEY, _SALT).agg(*[p.alias(f"p{i}_{j}") for i, a in enumerate(aggs) for j, p in enumerate(a.partial)])
    merged = part.groupBy(_KEY).agg(
        *[getattr(F, m)(f"p{i}_{j}").alias(f"p{i}_{j}") for i, a in enumerate(aggs) for j, m in enumerate(a.merge)]
    )
    out = [
        (F.expr(a.final.format(*[f"p{i}_{j}" for j in range(len(a.merge))])) if a.final else F.col(f"p{i}_0")).alias(a.name)
        for i, a in enumerate(aggs)
    ]
    return merged.select(F.col(_KEY).alias(key), *out)


def salted_first_k(
    df: DataFrame, key: str, order: str, value: str, k: int, name: str, salts: int = 32, min_share: float = 0.005
) -> DataFrame:
    """The ``value`` of each key's first ``k`` rows by ``order`` as an array: first k per salt, then first k of those.

    Missing values (NULL, empty) are passed over. No list longer than k times ``salts`` is ever built.
    """
    rows = salted(df.filter(F.col(value).isNotNull() & (F.col(value) != "")), key, salts, min_share, F.col(order))
    some = rows.select(_KEY, _SALT, F.col(order).alias("__o"), F.col(value).alias("__v")).withColumn(
        "__r", F.row_number().over(W.partitionBy(_KEY, _SALT).orderBy("__o", "__v"))
    )
    lists = some.filter(F.col("__r") <= k).groupBy(_KEY).agg(F.sort_array(F.collect_list(F.struct("__o", "__v"))).alias("l"))
    return lists.select(F.col(_KEY).alias(key), F.transform(F.slice("l", 1, k), lambda x: x["__v"]).alias(name))


def dominant_keys(df: DataFrame, key: str, share: float, spread: Column | None = None) -> DataFrame:
    """Keys that hold more than ``share`` of all rows of ``df``."""
    sums = salted_aggregate(df, key, [count("__n")], spread=spread, min_share=min(share, 0.005))
    return sums.filter(F.col("__n") > share * df.agg(F.count(F.lit(1))).scalar()).select(key)


def company_index(df: DataFrame, key: str = "company_name", order: str = "row_id", title: str = "title", k: int = 3) -> DataFrame:
    """Rows per company and up to ``k`` sample titles in the order of arrival; companies without any title get an empty array."""
    sums = salted_aggregate(df, key, [count("job_count")], spread=F.col(order))
    samples = salted_first_k(df, key, order, title, k, "sample_titles")
    return sums.join(samples.withColumnRenamed(key, "__k"), F.col(key) == F.col("__k"), "left").select(
        F.col(key).alias("company"), "job_count", F.coalesce("sample_titles", F.array().cast("array<string>")).alias("sample_titles")
    )
