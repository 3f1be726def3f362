"""Helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words.
BLANKS = " \t\n\x0b\x0c\r"
#: A key is hot if it holds more than one in so many rows: there are fewer such keys than this.
HOT = 1000
#: Rows of a narrow table that may be broadcast; the table is counted before.
FEW = 1_000_000
#: Parts over which rows without a partner are dealt in a join.
SPREAD = 4096


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, found by position: further columns may clash with each other or with an operator's own."""
    flat = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_{df.columns.index(n)}").alias(n) for n in names])


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session, which has no other machine, gets one of its own where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="demandloom-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


#: For each block of clearing() under way, the folders written in it.
WRITTEN: list[list[str]] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of a new name in the shared one; clearing() deletes it."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for block in WRITTEN:
        block.append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any file system that Spark reaches."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def clearing(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what operators wrote to the shared folder within: their results must be written or collected by then."""
    block: list[str] = []
    WRITTEN.append(block)
    try:
        yield
    finally:
        WRITTEN.remove(block)
        for path in block:
            delete(spark, path)


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back, so that lost executors cost no recomputation of what came before."""
    path = new_folder(df.sparkSession, "demandloom")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Python gets so many rows at a time at most in what runs within: whole texts of 10,000 rows take memory several times over, in the JVM and in Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(rows if int(old) <= 0 else min(rows, int(old))))
    try:
        yield
    finally:
        spark.conf.set(name, old)


#: The session's limit of the bytes of a batch for Python, and what by_bytes() sets.
BATCHES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 22


def by_bytes(spark: SparkSession) -> None:
    """From now on Python gets BATCH_BYTES at a time at most in this session: the JVM and Python hold a batch several times over. Batches of narrow rows stay
    as they are. What an operator returns runs later, so this holds until restored()."""
    spark.conf.set(BATCHES, str(BATCH_BYTES))


@contextlib.contextmanager
def restored(spark: SparkSession, name: str) -> Iterator[None]:
    """A session's setting is at its end what it was before."""
    old = spark.conf.get(name)
    try:
        yield
    finally:
        spark.conf.set(name, old)


def plain(df: DataFrame) -> list[str]:
    """The columns that can be hashed and ordered."""
    return [n for n, kind in df.dtypes if not any(x in kind for x in ("map<", "variant", "interval", "void"))]


def looked_up(rows: DataFrame, key: str, table: DataFrame, of: str, n: str) -> DataFrame:
    """rows with the columns of table but `of` and n, null where table has no row for the key.

    table: one row a key (column `of`), n rows of `rows` having it, none of its columns in rows; written once or cheap. Hot keys
    are fewer than HOT, so they are broadcast; their rows, and rows of a null key, are dealt evenly in the join of the others.
    """
    values = [c for c in table.columns if c not in (of, n)]
    total = table.agg(F.sum(n)).first()[0] or 0
    hot = table.where(F.col(n) * HOT > total).select(F.col(of).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in values])
    cold = table.where(F.col(n) * HOT <= total).select(F.col(of).alias("_cold"), F.lit(0).alias("_zero"), *values)
    names = rows.columns
    out = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left").withColumn("_own", F.when(F.col("_hot").isNull(), F.col(key)))
    out = out.withColumn("_deal", F.when(F.col("_own").isNull(), 1 + F.pmod(F.xxhash64(*plain(rows)), F.lit(SPREAD)).cast("int")).otherwise(0))
    out = out.join(cold, (F.col("_own") == F.col("_cold")) & (F.col("_deal") == F.col("_zero")), "left")
    return out.select(*names, *[F.when(F.col("_hot").isNotNull(), F.col(f"_hot_{c}")).otherwise(F.col(c)).alias(c) for c in values])


def semi(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose key is in ids (its only column, distinct, without nulls): by broadcast if ids were counted to be few, else by a shuffle."""
    ids = ids.toDF("_id")
    few = ids.limit(FEW + 1).count() <= FEW
    return rows.where(F.col(key).isNotNull()).join(F.broadcast(ids) if few else ids, F.col(key) == F.col("_id"), "left_semi")


#: Functions with a cache that a worker keeps from task to task, by name.
CACHES: dict[str, Callable] = {}


def trimmed() -> None:
    """Gives free memory back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has this call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidied(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str = "") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """function for mapInArrow, after which free memory goes back to the system: a worker would hold it from task to task and stage to stage. Caches that
    the worker has of other stages are dropped first; keeps: the one that is of use here."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = [c for name, c in CACHES.items() if name != keeps and c.cache_info().currsize]
        for c in others:
            c.cache_clear()
        if others:
            trimmed()
        try:
            yield from function(batches)
        finally:
            trimmed()

    return each


def sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, pa.Table]]:
    """The key values and the rows of each run of equal keys, across batches; one run is held at a time."""
    now, parts = None, []
    for b in batches:
        if not b.num_rows:
            continue
        columns = [b.column(k) for k in keys]
        change = np.zeros(b.num_rows - 1, bool)
        for c in columns:
            change |= pc.not_equal(c.slice(1), c.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), b.num_rows]
        for at, end in zip(starts, starts[1:], strict=False):
            key = tuple(c[at].as_py() for c in columns)
            if key != now and parts:
                yield now, pa.Table.from_batches(parts)
                parts = []
            now = key
            parts.append(b.slice(at, end - at))
    if parts:
        yield now, pa.Table.from_batches(parts)


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text, in order; none for null or blank texts."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare.isNull() | (bare == ""), F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def numbered(rows: DataFrame, order: list[Column | str], out: str = "row_number") -> DataFrame:
    """Adds a number (long, gapless from 0) in the given order, by ranges: what one task orders are the numbers of rows of the ranges.

    rows without equal keys under `order` never gather in one range. Writes rows, narrow ones at best, to the shared folder.
    """
    names = rows.columns
    ranged = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    # The upper bits of _at are the range, the lower 33 the place in it.
    counts = ranged.groupBy(F.shiftright("_at", 33).alias("_range")).agg(F.count("*").alias("_n"))
    before = counts.selectExpr("_range", "sum(_n) over (order by _range) - _n _before")  # one row a range
    placed = ranged.join(F.broadcast(before), F.shiftright("_at", 33) == F.col("_range"))
    return placed.withColumn(out, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).select(*names, out)
