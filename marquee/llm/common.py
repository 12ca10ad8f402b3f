"""Helpers shared by the operators: tables, words, scratch tables, batches."""

from __future__ import annotations

import contextlib
import ctypes
import string
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path, table_path

# Fixed value: a word is a maximal run of characters other than these blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def count_words(col: Column) -> Column:
    """Words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def stored(df: DataFrame, name: str, rebalance: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared scratch folder and read it back.

    Cuts lineage: a lost executor costs the tasks it was running, not the
    stages that led here. ``rebalance``: gather many small partitions into files
    of the advisory size first (for results much smaller than their partitions' number).
    """
    path = scratch_path(df.sparkSession, name)
    (df.hint("rebalance") if rebalance else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(col: Column, divisor: int) -> Column:
    """crc32 of the decimal text of ``col`` modulo ``divisor`` (null for null)."""
    return F.crc32(col.cast("string").cast("binary")) % divisor


BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def arrow_map(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with batches that stay small when rows hold long texts.

    Lowers the session's Arrow batch limits where they are higher: the default of
    10,000 rows makes batches of tens of MB, held several times per running task.
    """
    conf = df.sparkSession.conf
    rows = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))

    def lean(batches):
        yield from fn(batches)
        _give_back()

    return df.mapInArrow(lean, schema)


def _give_back() -> None:
    """Return freed memory to the system: Spark keeps an idle Python worker for the next task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):       # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def blocks(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut and join Arrow batches into pieces of about ``max_bytes`` of column ``text``
    (a single longer row is one piece)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        col = batch.column(batch.schema.names.index(text))
        start = 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(col), 0).to_pylist()):
            if size and size + n > max_bytes:
                held.append(batch.slice(start, i - start))
                yield _joined(held)
                held, size, start = [], 0, i
            size += n
        held.append(batch.slice(start))
    if sum(b.num_rows for b in held):
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    held = [b for b in held if b.num_rows]
    return held[0] if len(held) == 1 else pa.concat_batches(held)


BROADCAST_ROWS = 200_000     # of a few numbers each: about 17 MB in the driver


def merged(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, to be sorted and merged where it is joined if it can have more than ``BROADCAST_ROWS`` rows (``rows``: at
    most so many; None: unknown).

    Spark sizes a table by its compressed files, and what a map or an explode makes of it by the rows before: by
    that it may gather and broadcast a table of many times its limit, which the driver's memory does not hold.
    """
    return df if rows is not None and rows <= BROADCAST_ROWS else df.hint("merge")


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
                bound_rows: int = BROADCAST_ROWS, salts: int = 32) -> DataFrame:
    """Join ``left`` with a table ``right`` that has each key once and is cheap to compute twice.

    Up to ``bound_rows`` rows (counted) ``right`` is broadcast and ``left`` is not
    shuffled. Beyond, the keys are salted: a key that holds a third of ``left`` is
    dealt over ``salts`` partitions, and ``right`` is repeated that often and merged, never broadcast.
    """
    if right.count() <= bound_rows:
        return left.join(F.broadcast(right), keys, how)
    salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    return (left.withColumn("_salt", salt)
            .join(merged(salted), [*keys, "_salt"], how).drop("_salt"))
