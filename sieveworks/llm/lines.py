"""Blocks of lines that one source puts into a great many of its documents.

Each source's documents are sequences of line identifiers (64-bit hashes of a line's letters, case aside). They are divided
into chunks of bounded size by a hash of the row id, a hot source into many, small sources together into one. A chunk builds
the suffix array over its concatenated identifiers, with a divider after each document, and the common prefixes of
neighbouring suffixes. The intervals of suffixes that share a prefix, from the widest down, are the repeated blocks of one or
more lines; those that no further line before or after them could lengthen without losing a place are closed, and the closed
blocks that span enough of the chunk's documents are its proposals.

A block that spans a share s of a source's documents spans at least that share of them in one chunk, so proposals at the
chunk's part of the threshold lose nothing. In a source of several chunks, blocks may be closed in a chunk but not in all:
there each repeated line is proposed as well. The places of the proposed blocks in all documents are then looked up and
counted exactly; blocks that span enough documents are deleted place by place, and their lines are the lines found.

Defined results
---------------
* lines without letters and rows without a source have no cases; blank lines count in the numbering, and don't part a block;
* a block that occurs twice in a document counts once for the document, and both places are found;
* repeated rows count each, under their own row ids; rows that repeat a row id are one document;
* NULL and empty texts count among the source's rows and hold no lines; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import broadcast_if_small, materialise, missing

MIN_ROWS, MIN_SHARE = 8, 0.1
#: Documents of a chunk on average; the chunk's arrays are some 100 bytes a line.
CHUNK_ROWS = 8_000


def letters(line: Column) -> Column:
    """The letters of a line, case aside."""
    return F.lower(F.regexp_replace(line, r"[^\p{L}]+", ""))


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes, and each suffix' common prefix with the one before it.

    Prefix doubling: ranks by the first 2^k identifiers give those by 2^(k+1), until all suffixes differ.
    """
    n = len(ids)
    _, rank = np.unique(ids, return_inverse=True)
    ranks, width = [rank], 1
    while rank.max(initial=0) < n - 1:
        after = np.full(n, -1, dtype=np.int64)
        after[: n - width] = rank[width:]
        pair = rank.astype(np.int64) * (n + 1) + after + 1
        _, rank = np.unique(pair, return_inverse=True)
        ranks.append(rank)
        width *= 2
    order = np.argsort(rank, kind="stable")
    lcp = np.zeros(n, dtype=np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    alive = np.ones(max(n - 1, 0), dtype=bool)
    for k in range(len(ranks) - 1, -1, -1):  # binary descent over the doubled ranks
        w = 1 << k
        ok = (a < n) & (b < n)
        same = np.zeros(len(a), dtype=bool)
        same[ok] = ranks[k][a[ok]] == ranks[k][b[ok]]
        same &= alive
        lcp[1:][same] += w
        a[same] += w
        b[same] += w
    return order, lcp


def closed_blocks(ids: np.ndarray, doc: np.ndarray, need: np.ndarray) -> list[tuple[int, int]]:
    """(start, number of lines) of one place of each closed block that spans at least ``need`` documents, two at least.

    ids: line identifiers, a different negative number after each document; doc: document of each position; need: least
    number of documents by position. An interval of the suffix array whose suffixes share just w lines is a block that no
    line after it lengthens everywhere; if the lines before it aren't all the same, none before it does either.
    """
    order, lcp = suffix_array(ids)
    before = np.where(order > 0, ids[order - 1], np.iinfo(np.int64).min)
    out = []
    cuts = np.nonzero(lcp < 1)[0]
    todo = [(lo, hi) for lo, hi in zip(cuts, np.append(cuts[1:], len(ids))) if hi - lo >= max(2, need[order[lo]])]
    while todo:
        lo, hi = todo.pop()
        if len(np.unique(doc[order[lo:hi]])) < max(2, need[order[lo]]):
            continue
        inner = lcp[lo + 1 : hi]
        width = int(inner.min())
        left = before[lo:hi]
        if left[0] < 0 or (left != left[0]).any():
            out.append((int(order[lo]), width))
        cuts = np.concatenate([[0], np.nonzero(inner == width)[0] + 1, [hi - lo]])
        todo += [(lo + x, lo + y) for x, y in zip(cuts[:-1], cuts[1:]) if y - x >= max(2, need[order[lo]])]
    return out


def _propose(pdf: pd.DataFrame) -> pd.DataFrame:
    """The closed blocks of this chunk. Columns: source, need, several (chunks), keys (one row a document)."""
    # a key is hashed together with its source, so no block crosses sources
    sizes = np.array([len(k) for k in pdf["keys"]], dtype=np.int64)
    keys = np.concatenate([np.asarray(k, dtype=np.int64) for k in pdf["keys"]])
    _, ids = np.unique(keys, return_inverse=True)
    ends = np.cumsum(sizes + 1) - 1
    total = int(sizes.sum() + len(sizes))
    seq, full, doc = np.empty(total, dtype=np.int64), np.zeros(total, dtype=np.int64), np.repeat(np.arange(len(sizes)), sizes + 1)
    body = np.ones(total, dtype=bool)
    body[ends] = False
    seq[body], full[body] = ids, keys
    seq[~body] = -1 - np.arange(len(sizes))
    need = np.asarray(pdf["need"], dtype=np.int64)[doc]
    source, several = pdf["source"].to_numpy(), pdf["several"].to_numpy()
    blocks = {}
    for start, width in closed_blocks(seq, doc, need):
        d = doc[start]
        parts = [(start, width)] + ([(start + i, 1) for i in range(width)] if several[d] else [])
        for at, n in parts:
            k = full[at : at + n]
            blocks[xxhash.xxh64_intdigest(k.tobytes()) - (1 << 63)] = (source[d], k.tolist())
    return pd.DataFrame({"source": pd.Series([x for x, _ in blocks.values()], dtype=object), "block": pd.Series(list(blocks), dtype="int64"), "keys": pd.Series([k for _, k in blocks.values()], dtype=object)})


def _places(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The places of the proposed blocks in each document: (block, numbers of its lines)."""
    by_source: dict[str, dict[int, list]] = {}
    for pdf in it:
        out = []
        for source, nos, keys, wanted in zip(pdf["source"], pdf["nos"], pdf["keys"], pdf["wanted"]):
            first = by_source.get(source)
            if first is None:
                if len(by_source) > 10_000:
                    by_source.clear()
                first = by_source[source] = {}
                for w in wanted:
                    k = list(w["keys"])
                    first.setdefault(k[0], []).append((w["block"], len(k), k))
            keys, nos = keys.tolist(), nos.tolist()
            got = []
            for i, k in enumerate(keys):
                for block, n, whole in first.get(k, ()):
                    if n == 1 or keys[i : i + n] == whole:
                        got.append({"block": block, "nos": nos[i : i + n]})
            out.append(got)
        yield pdf[["source", "row_id", "need"]].assign(places=pd.Series(out, index=pdf.index, dtype=object))


def find_blocks(df: DataFrame, row_id: str, text: str, source: str, min_rows: int = MIN_ROWS, min_share: float = MIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """(source, row_id, places) of the documents with proposed blocks, and the blocks found: (source, block, n_lines, docs,
    occurrences, first_row, first_line) of each that is in at least ``min_rows`` documents and ``min_share`` of its source's."""
    rows = df.filter(~missing(source)).select(F.col(source).alias("source"), F.col(row_id).alias("row_id"), F.col(text).alias("text"))
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows_of_source")).filter(F.col("rows_of_source") >= min_rows)
    sizes = materialise(sizes)
    lines = rows.filter(F.col("text").isNotNull()).select(
        "source", "row_id",
        F.transform(
            F.filter(F.transform(F.split("text", "\n", -1), lambda x, i: F.struct((i + 1).cast("long").alias("no"), letters(x).alias("key"))), lambda s: s["key"] != ""),
            lambda s: F.struct(s["no"].alias("no"), F.xxhash64("source", s["key"]).alias("key")),
        ).alias("lines"),
    ).filter(F.size("lines") > 0)
    docs = lines.join(broadcast_if_small(sizes), "source")
    n = F.col("rows_of_source")
    parts = F.ceil(n / F.lit(CHUNK_ROWS))
    total = sizes.agg(F.coalesce(F.sum("rows_of_source"), F.lit(0))).scalar()
    small = F.pmod(F.xxhash64("source"), F.greatest(F.lit(1), F.ceil(total / F.lit(CHUNK_ROWS))))
    need = F.greatest(F.lit(min_rows), F.ceil(n * F.lit(min_share) - F.lit(1e-9)))
    docs = docs.select(
        "source", "row_id", F.col("lines.no").alias("nos"), F.col("lines.key").alias("keys"), need.cast("long").alias("need"), parts.alias("parts"),
        F.when(parts > 1, F.concat_ws(":", F.lit("h"), F.xxhash64("source").cast("string"), F.pmod(F.xxhash64("row_id"), parts).cast("string")))
        .otherwise(F.concat_ws(":", F.lit("s"), small.cast("string"))).alias("chunk"),
    )
    docs = materialise(docs)
    # a block over `need` rows of a source in `parts` chunks lies in at least need / parts rows of one of them
    part_need = F.greatest(F.lit(1), F.ceil(F.col("need") / F.col("parts")))
    proposed = docs.select("chunk", "source", part_need.cast("long").alias("need"), (F.col("parts") > 1).alias("several"), "keys").groupBy("chunk").applyInPandas(_propose, "source string, block long, keys array<long>")
    wanted = proposed.dropDuplicates(["source", "block"]).groupBy("source").agg(F.collect_list(F.struct("block", "keys")).alias("wanted"))
    wanted = materialise(wanted)
    width = F.aggregate("wanted", F.lit(0), lambda acc, x: acc + 16 + 8 * F.size(x["keys"]))
    # exact count: only documents with proposed blocks go on
    hits = docs.join(broadcast_if_small(wanted, width=width), "source").select("source", "row_id", "need", "nos", "keys", "wanted")
    hits = hits.mapInPandas(_places, "source string, row_id long, need long, places array<struct<block:bigint,nos:array<bigint>>>")
    hits = materialise(hits.filter(F.size("places") > 0))
    spots = hits.select("source", "row_id", "need", F.explode("places").alias("p"))
    per = spots.groupBy("source", F.col("p.block").alias("block"), "row_id").agg(F.count(F.lit(1)).alias("c"), F.max("need").alias("need"), F.min("p.nos").alias("nos"))
    exact = per.groupBy("source", "block").agg(F.count(F.lit(1)).alias("docs"), F.sum("c").alias("occurrences"), F.max("need").alias("need"), F.min(F.struct("row_id", "nos")).alias("first"))
    enough = exact.filter(F.col("docs") >= F.col("need")).select(
        "source", "block", F.size("first.nos").cast("long").alias("n_lines"), "docs", "occurrences", F.col("first.row_id").alias("first_row"), F.col("first.nos")[0].alias("first_line")
    )
    enough = materialise(enough.join(wanted.select(F.col("source").alias("s"), F.explode("wanted").alias("w")), (F.col("source") == F.col("s")) & (F.col("block") == F.col("w.block"))).select("source", "block", "n_lines", "docs", "occurrences", "first_row", "first_line", F.col("w.keys").alias("keys")))
    # a single line whose every place is the same line of a longer block is no block of its own
    longer = enough.filter("n_lines > 1").select("source", F.explode("keys").alias("key"), "occurrences", "block").groupBy("source", "key", "block").agg(F.max("occurrences").alias("occ"), F.count(F.lit(1)).alias("times")).filter("times = 1")
    longer = longer.groupBy(F.col("source").alias("s"), F.col("key").alias("k")).agg(F.max("occ").alias("occ"))
    within = (F.col("source") == F.col("s")) & (F.col("n_lines") == 1) & (F.col("keys")[0] == F.col("k")) & (F.col("occurrences") == F.col("occ"))
    return hits, enough.join(longer, within, "left_anti").drop("keys")


def repeated_lines(df: DataFrame, row_id: str, text: str, source: str, min_rows: int = MIN_ROWS, min_share: float = MIN_SHARE) -> DataFrame:
    """(row_id, line_no) of each line within a block that its source repeats in at least ``min_rows`` rows and ``min_share`` of its rows."""
    hits, blocks = find_blocks(df, row_id, text, source, min_rows, min_share)
    good = materialise(blocks.groupBy(F.col("source").alias("s")).agg(F.collect_set("block").alias("good")))
    mine = hits.join(broadcast_if_small(good, width=8 * F.size("good")), F.col("source") == F.col("s"))
    kept = F.filter("places", lambda p: F.array_contains("good", p["block"]))
    return mine.select("row_id", F.explode(F.array_distinct(F.flatten(F.transform(kept, lambda p: p["nos"])))).alias("line_no"))


def without_lines(df: DataFrame, row_id: str, text: str, found: DataFrame, out: str = "text") -> DataFrame:
    """All rows with ``text`` less the lines in ``found`` (row_id, line_no); NULL stays NULL, rows without cases are unchanged."""
    drop = found.groupBy(F.col("row_id").alias("__r")).agg(F.collect_set("line_no").alias("__drop"))
    kept = F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("__drop", (i + 1).cast("long")))
    return df.join(drop, F.col(row_id) == F.col("__r"), "left").select(
        F.col(row_id), F.when(F.col("__drop").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")).alias(out), F.coalesce(F.size("__drop"), F.lit(0)).alias("lines_removed")
    )
