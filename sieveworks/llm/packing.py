"""Filling containers of fixed capacity with texts.

Sizes are tokens of a public tokenizer. Texts are cut into pieces only where they exceed the capacity. Pieces are divided at
random into shards of bounded size; a shard is packed by best fit in decreasing order. Its open bins are ordered by residual
and carry bitmaps of the duplicate clusters and the sources they hold. The search for a piece starts at the first residual
that fits and goes on to its successors until the tightest compatible bin is found: one without the piece's cluster and not
mostly filled by its source. Where every bin with room is mostly of the piece's source, the tightest one without its cluster
is taken; where all hold its cluster, a new bin is opened. So two texts of a cluster never share a container.

The bins of a shard that stay well below capacity are emptied, and their pieces are packed once more with those of other
shards, in rounds of new shards of the same bounded size, as long as a round leaves at most half of what it took.

Defined results
---------------
* NULL, empty and blank texts have no tokens and go nowhere; a text of exactly the capacity fills a container alone;
* a longer text is divided into full containers and a rest, the rest is packed like any text; the rest of a text and that of
  its copy are of one cluster;
* repeated rows are packed each; ties go by size, then by id; an empty table gives no containers;
* a missing source is a source of its own; capacities below 1 have no result.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..runtime import materialise, missing
from .copies import copy_classes

#: Read on the driver and sent to the executors; any path of this machine will do.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern that belongs to the vocabulary file.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces of a shard.
SHARD = 20_000
#: Bins filled less than this are opened again in the next round.
WELL_FILLED = 0.98
#: Most of a bin that one source may hold while other bins have room.
SOURCE_SHARE = 0.75
ROUNDS = 6


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, row_id: str, text: str, keep: list[str], tokenizer: str = TOKENIZER) -> DataFrame:
    """(row_id, *keep, tokens) of each text that isn't blank."""
    with open(tokenizer, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: its size doesn't depend on the data

    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoding(shared.value)
        for pdf in it:
            pdf["tokens"] = [len(enc.encode_ordinary(t)) for t in pdf["text"]]
            yield pdf.drop(columns="text")

    rows = df.filter(~missing(text)).select(F.col(row_id).alias("row_id"), *keep, F.col(text).alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInPandas(count, f"{kinds}, tokens long")


def sized_texts(df: DataFrame, row_id: str, text: str, source: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(row_id, source, tokens, cluster): sizes and classes of copies and near copies, from one pass over the texts."""
    with open(tokenizer, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def counter() -> Callable[[str], int]:
        enc = _encoding(shared.value)
        return lambda t: len(enc.encode_ordinary(t))

    return copy_classes(df, row_id, text, [source], {"tokens": counter}).withColumnRenamed(source, "source")


class Bins:
    """Open bins of one shard. Bitmaps number the bins: per residual, per cluster (bins that hold it), per source (mostly its)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.residuals: list[int] = []  # in order, each once
        self.at: dict[int, int] = {}  # residual -> bitmap of the open bins
        self.fill: list[int] = []
        self.holds: dict[int, int] = {}
        self.mostly: dict[str, int] = {}
        self.of_source: dict[tuple[int, str], int] = {}

    def _find(self, size: int, barred: int) -> tuple[int, int]:
        """(residual, bin) of the tightest bin that isn't barred; (-1, -1) if none has room."""
        for i in range(bisect_left(self.residuals, size), len(self.residuals)):
            free = self.at[self.residuals[i]] & ~barred
            if free:
                return self.residuals[i], (free & -free).bit_length() - 1
        return -1, -1

    def add(self, size: int, cluster: int | None, source: str) -> int:
        """``cluster``: None for a piece whose cluster has no other piece here."""
        held = self.holds.get(cluster, 0) if cluster is not None else 0
        mostly = self.mostly.get(source, 0)
        residual, b = self._find(size, held | mostly)
        if b < 0 and mostly:
            residual, b = self._find(size, held)
        if b < 0:
            residual, b = self.capacity, len(self.fill)
            self.fill.append(0)
        else:
            rest = self.at[residual] & ~(1 << b)
            if rest:
                self.at[residual] = rest
            else:
                del self.at[residual]
                self.residuals.pop(bisect_left(self.residuals, residual))
        self.fill[b] += size
        if cluster is not None:
            self.holds[cluster] = held | 1 << b
        mine = self.of_source[b, source] = self.of_source.get((b, source), 0) + size
        if mine >= SOURCE_SHARE * self.capacity:
            self.mostly[source] = mostly | 1 << b
        residual -= size
        if residual:
            if residual not in self.at:
                insort(self.residuals, residual)
            self.at[residual] = self.at.get(residual, 0) | 1 << b
        return b


_OUT = "spec_id long, capacity int, shard long, bin long, row_id long, piece int, size long, cluster long, source string, fill long"


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["size", "row_id", "piece"], ascending=[False, True, True], kind="stable")
    bins = Bins(int(pdf["capacity"].iloc[0]))
    shared = pdf["cluster"].duplicated(keep=False)
    pdf["bin"] = [bins.add(n, c if two else None, s or "") for n, c, two, s in zip(pdf["size"], pdf["cluster"], shared, pdf["source"])]
    pdf["fill"] = [bins.fill[b] for b in pdf["bin"]]
    return pdf[["spec_id", "capacity", "shard", "bin", "row_id", "piece", "size", "cluster", "source", "fill"]]


def pack(sizes: DataFrame, specs: DataFrame) -> DataFrame:
    """(spec_id, container, row_id, piece, size, fill, capacity, cluster) for each piece; container names are unique within a spec.

    ``sizes``: row_id, tokens, cluster, source, materialised; ``specs``: spec_id, capacity_tokens (a few rows).
    """
    specs = specs.select("spec_id", F.col("capacity_tokens").alias("capacity")).filter("capacity > 0")
    listed = specs.limit(1001).collect()
    if len(listed) > 1000:
        raise ValueError("more than 1000 container sizes")
    rows = sizes.filter("tokens > 0").select("row_id", "tokens", "cluster", "source")
    kinds = F.array(*[F.struct(F.lit(r.spec_id).cast("long").alias("spec_id"), F.lit(r.capacity).cast("int").alias("capacity")) for r in listed])
    each = rows.select("*", F.explode(kinds.cast("array<struct<spec_id:bigint,capacity:int>>")).alias("k")).select("row_id", "tokens", "cluster", "source", "k.spec_id", "k.capacity")
    whole = F.floor(F.col("tokens") / F.col("capacity")).cast("int")
    rest = (F.col("tokens") % F.col("capacity")).cast("long")
    # full pieces of long texts need no packing
    full = each.filter("tokens >= capacity").select("spec_id", "capacity", "row_id", "cluster", F.explode(F.sequence(F.lit(1), whole)).alias("piece"))
    full = full.select(
        "spec_id", F.concat_ws("-", F.lit("f"), F.col("row_id").cast("string"), F.col("piece").cast("string")).alias("container"), "row_id", "piece",
        F.col("capacity").cast("long").alias("size"), F.col("capacity").cast("long").alias("fill"), "capacity", "cluster",
    )
    state = each.filter(rest > 0).select("spec_id", "capacity", "row_id", (whole + 1).alias("piece"), rest.alias("size"), "cluster", "source")
    most, done = sizes.count(), []
    for k in range(ROUNDS):
        # shards by what is left: a shard never holds more than some SHARD pieces of one spec
        shards = max(1, -(-most // SHARD))
        state = state.withColumn("shard", F.pmod(F.xxhash64("row_id", F.lit(17 + k)), F.lit(shards)))
        packed = materialise(state.groupBy("spec_id", "shard").applyInPandas(_pack, _OUT))
        name = F.concat_ws("-", F.lit(f"r{k}"), F.col("shard").cast("string"), F.col("bin").cast("string"))
        left = packed.filter(F.col("fill") < WELL_FILLED * F.col("capacity"))
        n_left = {r.spec_id: r.n for r in left.groupBy("spec_id").agg(F.count(F.lit(1)).alias("n")).collect()}
        n_had = {r.spec_id: r.n for r in packed.groupBy("spec_id").agg(F.count(F.lit(1)).alias("n")).collect()} if n_left else {}
        # a spec whose pieces fit no better than this is done
        again = [s for s, n in n_left.items() if n * 2 <= n_had[s]] if shards > 1 and k < ROUNDS - 1 else []
        reopened = (F.col("fill") < WELL_FILLED * F.col("capacity")) & F.col("spec_id").isin(again)
        done.append(packed.filter(~reopened).withColumn("container", name))
        if not again:
            break
        most = max(n_left[s] for s in again)
        state = packed.filter(reopened).drop("bin", "fill", "shard")
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out.select("spec_id", "container", "row_id", "piece", "size", "fill", "capacity", "cluster").union(full)


def fill_report(packed: DataFrame) -> DataFrame:
    """Per spec: pieces, containers, tokens, the used share of the containers' space, and the containers with two texts of a cluster."""
    twice = packed.groupBy("spec_id", "container", "cluster").agg((F.count(F.lit(1)) > 1).alias("twice"), F.max("fill").alias("fill"), F.max("capacity").alias("capacity"), F.count(F.lit(1)).alias("pieces"))
    n = twice.groupBy("spec_id", "container").agg(F.max("fill").alias("fill"), F.max("capacity").alias("capacity"), F.sum("pieces").alias("pieces"), F.max("twice").alias("twice"))
    return n.groupBy("spec_id", "capacity").agg(
        F.sum("pieces").alias("pieces"), F.count(F.lit(1)).alias("containers"), F.sum("fill").alias("tokens"),
        (F.sum("fill") / F.sum(F.col("capacity").cast("long"))).alias("used_share"), F.count_if("twice").alias("conflicts"),
    )
