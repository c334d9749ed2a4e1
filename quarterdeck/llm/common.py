"""What the operators of this subpackage share: table reads, materialising, size-checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.plans.build import shared_folder

#: A word is a run of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Rows up to which a side with narrow rows counts as small enough to broadcast.
BROADCAST_ROWS = 20_000


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table (all, if none are named)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor afterwards costs a file read, not a recomputation, and branches that share
    ``df`` share its work. The files go when the cluster clears that folder.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # what the write has shuffled is of no more use
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, as counted; else unchanged, and Spark shuffles it.

    ``df`` should be materialised and narrow, as it is counted (up to the limit) first.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that ``df`` doesn't have, whatever it has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        k = 0
        while (own := f"_{name}_{k}") in taken:
            k += 1
        out.append(own)
    return out


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of a text column, of one row at least, so that what is made of one at a time stays small."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            yield batch.slice(at, end - at)
            at = end
        del batch
        pa.default_memory_pool().release_unused()


def words(text) -> Column:
    """The number of words of a text; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def learnable(doc_id: Column) -> Column:
    """False for held-out rows: crc32 of the id as text, modulo 4, is 2. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 != 2


def among_least(h: Column, wanted: int, of: Column | int, spare: int = 20) -> Column:
    """Whether a hash is low enough to be among the ``wanted`` least of ``of``, with a few times as many to spare.

    A filter before ordering by the hash, so that no task orders many times the rows wanted.
    """
    count = F.lit(of) if isinstance(of, int) else of
    return (h / float(1 << 64) + 0.5) * count <= spare * wanted
