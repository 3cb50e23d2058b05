"""Session helpers: reading tables, cutting lineage, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows up to which a side of unknown size may be broadcast (about 100 bytes a row: some 20 MB).
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; a file or a folder of parquet parts."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; make an own one only where none is set and the master is this machine."""
    if spark.sparkContext.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="sieveworks-")
    spark.sparkContext.setCheckpointDir(shared)


def scratch(spark: SparkSession) -> str:
    """A new folder's name below the shared one, for tables that a query writes and reads again."""
    checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4()}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint; the copy survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, width: Column | None = None) -> DataFrame:
    """Hint a broadcast only after counting that df has at most ``rows`` rows; else leave the join to shuffle.

    ``df`` should be materialised or cheap, as counting runs it. The count stops at ``rows + 1`` rows. ``width`` gives a row's
    size in bytes where rows hold arrays or long texts: then the sum must not exceed ``BROADCAST_BYTES`` either.
    """
    some = df.limit(rows + 1)
    n, size = some.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.lit(0) if width is None else width), F.lit(0))).first()
    return F.broadcast(df) if n <= rows and size <= BROADCAST_BYTES else df


def missing(c: Column | str) -> Column:
    """NULL, empty or only white space."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | ~c.rlike(r"(?U)\S")
