"""Mixing sources to target weights.

Documents fall into blocks by a hash; a block is some ``BLOCK_DOCS`` documents of one source. Only the blocks' token sums are
ordered and summed up: within runs of ``RUN_BLOCKS`` blocks, then over a source's runs. Of a source's last block the documents
are looked at. So neither a source's documents nor its blocks pass through one task.

The total is the largest at which every source can give its share: the least of tokens * max_repeats / share over the listed
sources that have documents. A source then contributes whole passes over its documents and a part of one more.

The drawn blocks go to output shards by a splitting tree: at each node a multivariate hypergeometric draw divides the node's
blocks of every source exactly between its two halves, down to single shards. A source's blocks stand in random order and
each shard takes the next run of them, so the draws are disjoint; a shard's documents are then shuffled within the shard.

Defined results
---------------
* NULL and blank texts have no tokens and are never drawn; rows of unlisted or missing sources aren't drawn;
* a listed source without documents contributes nothing and is reported with 0; the other shares keep their proportions;
* negative or missing shares count as 0, ``max_repeats`` below 1 as 0; repeated rows are documents each;
* of the last block the documents are drawn that fit into the rest, larger ones first; an empty table gives an empty mixture.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..runtime import broadcast_if_small, materialise

BLOCK_DOCS = 200
#: Tokens of an output shard (about a gigabyte of text), and the least number of shards.
SHARD_TOKENS, SHARDS = 1 << 28, 16
#: Blocks of a run whose token sums are added up in one place; the runs' sums are added up in turn.
RUN_BLOCKS = 10_000
SEED = 20_240_101


def split_tree(counts: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources) block counts: the rows sum to ``counts``, each shard gets its part of all blocks, to a block."""
    out = np.zeros((shards, len(counts)), dtype=np.int64)
    todo = [(0, shards, counts.astype(np.int64))]
    while todo:
        lo, hi, have = todo.pop()
        if hi - lo == 1:
            out[lo] = have
            continue
        mid = (lo + hi) // 2
        total = int(have.sum())
        take = round(total * (mid - lo) / (hi - lo))
        left = _hypergeometric(have, take, rng)
        todo += [(lo, mid, left), (mid, hi, have - left)]
    return out


def _hypergeometric(have: np.ndarray, take: int, rng: np.random.Generator) -> np.ndarray:
    """A draw of ``take`` blocks without replacement; by conditional draws where the counts are too large for one."""
    if take <= 0:
        return np.zeros_like(have)
    if have.sum() < 1_000_000_000:
        return rng.multivariate_hypergeometric(have, take, method="marginals")
    left, out = int(have.sum()), np.zeros_like(have)
    for i, n in enumerate(have):  # normal approximation, kept within what is possible
        n, rest = int(n), left - int(have[i])
        mean = take * n / left if left else 0.0
        var = mean * (1 - n / left) * (left - take) / max(left - 1, 1) if left else 0.0
        out[i] = int(min(max(round(rng.normal(mean, max(var, 0.0) ** 0.5)), take - rest, 0), n, take))
        take -= int(out[i])
        left = rest
    return out


def plan(sums: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> list[dict]:
    """Per listed source: share, repeats, tokens held, quota, whole passes and rest. As many rows as the target table has."""
    held = {r.source: r.tokens for r in sums.groupBy("source").agg(F.sum("tokens").alias("tokens")).join(F.broadcast(targets.select(F.col("source").alias("t")).distinct()), F.col("source") == F.col("t"), "left_semi").collect()}
    rows = [
        {"source": r.source, "share": max(r.target_share or 0.0, 0.0), "repeats": max(r.max_repeats or 0, 0), "held": int(held.get(r.source, 0))}
        for r in targets.select("source", "target_share", "max_repeats").filter("source is not null").collect()
    ]
    can = [r for r in rows if r["held"] * r["repeats"] > 0 and r["share"] > 0]
    scale = sum(r["share"] for r in can)
    most = min((r["held"] * r["repeats"] * scale / r["share"] for r in can), default=0.0)
    total = most if total_tokens is None else float(total_tokens)
    for r in rows:
        ok = r in can
        r["quota"] = min(total * r["share"] / scale, r["held"] * r["repeats"]) if ok else 0.0
        r["passes"] = int(r["quota"] // r["held"]) if ok else 0
        r["rest"] = r["quota"] - r["passes"] * r["held"] if ok else 0.0
        if ok and r["passes"] >= r["repeats"]:
            r["passes"], r["rest"] = r["repeats"], 0.0
    return rows


def draw(sizes: DataFrame, targets: DataFrame, shards: int | None = None, seed: int = SEED, total_tokens: int | None = None) -> DataFrame:
    """(row_id, source, copy, tokens, shard, position): the mixture. ``sizes``: row_id, source, tokens.

    ``shards``: number of output shards; by the mixture's tokens where not given.
    """
    spark = sizes.sparkSession
    if targets.limit(10_001).count() > 10_000:
        raise ValueError("more than 10000 sources in the target table")
    docs = sizes.filter("tokens > 0 and source is not null").select("row_id", "source", "tokens")
    counts = materialise(docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens")))
    rows = plan(counts, targets, total_tokens)
    if shards is None:
        shards = max(SHARDS, -(-int(sum(r["quota"] for r in rows)) // SHARD_TOKENS))
    quota = spark.createDataFrame([(r["source"], r["passes"], float(r["rest"])) for r in rows], "q_source string, passes int, rest double")
    size = counts.select(F.col("source").alias("c_source"), F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK_DOCS)).alias("blocks"))
    facts = F.broadcast(size.join(F.broadcast(quota), F.col("c_source") == F.col("q_source")).drop("c_source"))
    blocked = docs.join(facts, F.col("source") == F.col("q_source")).select(
        "row_id", "source", "tokens", "passes", "rest", F.pmod(F.xxhash64("row_id", F.lit(seed)), F.col("blocks")).alias("block")
    )
    blocked = materialise(blocked)
    # blocks in random order with the tokens before each: sums within runs of blocks, then over a source's runs
    h = F.xxhash64("block", F.lit(seed + 1))
    sums = blocked.groupBy("source", "block", "passes", "rest").agg(F.sum("tokens").alias("t")).withColumn("h", h)
    runs = size.select(F.col("c_source").alias("r_source"), F.ceil(F.col("blocks") / RUN_BLOCKS).alias("runs"))
    # a run is a range of the order, so order within a run after the order of runs is the whole order
    run = F.floor((F.col("h").cast("double") / F.lit(2.0**64) + 0.5) * F.col("runs"))
    sums = materialise(sums.join(F.broadcast(runs), F.col("source") == F.col("r_source")).withColumn("run", F.least(run, F.col("runs") - 1)).drop("r_source", "runs"))
    of_run = sums.groupBy(F.col("source").alias("s2"), F.col("run").alias("run2")).agg(F.sum("t").alias("run_t"), F.count(F.lit(1)).alias("run_n"))
    earlier = W.partitionBy("s2").orderBy("run2").rowsBetween(W.unboundedPreceding, -1)
    of_run = of_run.select("s2", "run2", F.coalesce(F.sum("run_t").over(earlier), F.lit(0)).alias("t0"), F.coalesce(F.sum("run_n").over(earlier), F.lit(0)).alias("n0"))
    order = W.partitionBy("source", "run").orderBy("h", "block")
    ordered = sums.withColumns({"inner": F.coalesce(F.sum("t").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)), "no": F.row_number().over(order)})
    ordered = ordered.join(broadcast_if_small(materialise(of_run)), (F.col("source") == F.col("s2")) & (F.col("run") == F.col("run2")))
    ordered = materialise(ordered.select("source", "block", "passes", "rest", "t", (F.col("t0") + F.col("inner")).alias("before"), (F.col("n0") + F.col("no")).alias("rank")))
    # copies of each block: the passes, and one more where the rest reaches it
    copies = F.when(F.col("rest") > F.col("before"), F.col("passes") + 1).otherwise(F.col("passes"))
    taken = ordered.withColumn("copies", copies).filter("copies > 0").select("source", "block", "before", "rest", "passes", "rank", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    # a source's drawn blocks, pass by pass, in one order
    n_blocks = {(r.source, r.copy): r.n for r in taken.groupBy("source", "copy").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted({s for s, _ in n_blocks})
    per = np.array([sum(n for (s, _), n in n_blocks.items() if s == x) for x in names], dtype=np.int64)
    tree = split_tree(per, shards, np.random.default_rng(seed)) if names else np.zeros((shards, 0), dtype=np.int64)
    ends = np.cumsum(tree, axis=0)
    offsets = []
    for x in names:
        at = 0
        for c in sorted(c for s, c in n_blocks if s == x):
            offsets.append((x, c, at))
            at += n_blocks[x, c]
    off = F.broadcast(spark.createDataFrame(offsets, "o_source string, o_copy int, offset long"))
    placed = taken.join(off, (F.col("source") == F.col("o_source")) & (F.col("copy") == F.col("o_copy")))
    index = F.col("offset") + F.col("rank") - 1
    placed = placed.select(
        F.col("source").alias("p_source"), F.col("block").alias("p_block"), "copy", F.when(F.col("copy") > F.col("passes"), F.col("rest") - F.col("before")).alias("room"), index.alias("at")
    )
    shared = spark.sparkContext.broadcast({x: ends[:, i].copy() for i, x in enumerate(names)})  # shards x listed sources

    def shard_of(it):
        for pdf in it:
            shard = pd.Series(0, index=pdf.index, dtype="int64")
            for x, part in pdf.groupby("p_source"):
                shard[part.index] = np.searchsorted(shared.value[x], part["at"], side="right")
            yield pdf.drop(columns="at").assign(shard=shard)

    placed = placed.mapInPandas(shard_of, "p_source string, p_block long, copy int, room double, shard long")
    got = blocked.select("row_id", "source", "tokens", "block").join(placed, (F.col("source") == F.col("p_source")) & (F.col("block") == F.col("p_block")))
    # the last block of the rest: largest documents first, each that still fits; a block is a few hundred documents
    block = got.filter("room is not null").groupBy("source", "block", "copy").agg(
        F.max("room").alias("room"), F.first("shard").alias("shard"), F.reverse(F.array_sort(F.collect_list(F.struct("tokens", F.xxhash64("row_id", F.lit(seed + 2)).alias("h"), "row_id")))).alias("docs"), F.sum("tokens").alias("t")
    )
    fit = F.aggregate(
        "docs", F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<struct<tokens:bigint,h:bigint,row_id:bigint>>").alias("in")),
        lambda acc, d: F.when(acc["sum"] + d["tokens"] <= F.col("room"), F.struct((acc["sum"] + d["tokens"]).alias("sum"), F.concat(acc["in"], F.array(d)).alias("in"))).otherwise(acc),
    )["in"]
    part = block.select("source", "copy", "shard", F.explode(F.when(F.col("t") <= F.col("room"), F.col("docs")).otherwise(fit)).alias("d")).select(F.col("d.row_id").alias("row_id"), "source", "copy", F.col("d.tokens").alias("tokens"), "shard")
    every = got.filter("room is null").select("row_id", "source", "copy", "tokens", "shard").union(part)
    return every.withColumn("position", F.xxhash64("row_id", "copy", F.lit(seed + 3)))


def share_report(drawn: DataFrame, sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per listed source: target and actual share, tokens and documents drawn, and the most times a document is used."""
    used = drawn.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("copy").alias("most_uses"))
    total = drawn.agg(F.sum("tokens")).scalar()
    t = targets.select(F.col("source").alias("s"), "target_share", "max_repeats")
    return t.join(used, F.col("s") == F.col("source"), "left").select(
        F.col("s").alias("source"), "target_share", F.coalesce(F.try_divide(F.col("tokens"), total), F.lit(0.0)).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"), "max_repeats",
    )


def shuffled(drawn: DataFrame) -> DataFrame:
    """The mixture (materialised) with every shard's documents in their shuffled order: a task sorts a range about a shard long."""
    shards = drawn.agg(F.max("shard")).first()[0]
    return drawn.repartitionByRange((shards or 0) + 1, "shard", "position").sortWithinPartitions("shard", "position")
