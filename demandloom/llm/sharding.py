"""Reproducible shuffling into shards by a Feistel permutation of global row numbers.

Row numbers follow a hash of the id, then the id, and so depend on the rows alone, not on files or partitions. The
permutation works on pairs of digits (a nearly square domain that just holds all numbers); images past the last number are
permuted again (cycle walking), which keeps it a permutation. Position p of the shuffle lies in shard p mod n, slot p div n.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered, pick

#: Prime modulus 2**31 - 1, multiplier and round keys of the round function.
PRIME, FACTOR, KEYS = 2147483647, 48271, (12345701, 778899123, 1029384756, 561234987, 92837465, 1357924680)
#: Row numbers go by this many blocks of hashed ids first, then by the rows themselves.
BLOCKS = 1024


def sides(n: int) -> tuple[int, int]:
    """The least sides a, b of about equal length whose product holds n numbers; fewer than a numbers are over."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def scrambled(half: Column, key: int) -> Column:
    """Round function: squares and products modulo a prime."""
    t = (half % PRIME + key) % PRIME
    return ((t * t + key) % PRIME * FACTOR + key) % PRIME


def feistel(rows: DataFrame, column: str, n: int) -> DataFrame:
    """Puts column through the permutation of the domain once; rounds change its upper and its lower digit in turn."""
    a, b = sides(n)
    rows = rows.withColumn("upper", F.expr(f"{column} div {b}")).withColumn("lower", F.col(column) % b)
    for turn, key in enumerate(KEYS):
        if turn % 2:
            rows = rows.withColumn("lower", (F.col("lower") + scrambled(F.col("upper"), key)) % b)
        else:
            rows = rows.withColumn("upper", (F.col("upper") + scrambled(F.col("lower"), key)) % a)
    return rows.withColumn(column, F.col("upper") * b + F.col("lower")).drop("upper", "lower")


def permuted(rows: DataFrame, n: int, row: str = "row_number", out: str = "position") -> DataFrame:
    """Adds the image of each row number under the permutation of 0 .. n - 1.

    Walking on concerns fewer rows than the domain has numbers over, of the order of the root of n.
    """
    now = cut(feistel(rows.withColumn(out, F.col(row)), out, n))
    done = now.where(F.col(out) < n)
    while not (rest := now.where(F.col(out) >= n)).isEmpty():
        now = cut(feistel(rest, out, n))
        done = done.unionByName(now.where(F.col(out) < n))
    return done


def block(doc_id: Column) -> Column:
    """Which of BLOCKS an id hashes to; null ids to 0."""
    return F.coalesce(F.pmod(doc_id % PRIME * FACTOR % PRIME, F.lit(BLOCKS)), F.lit(0))


def shard(docs: DataFrame, shards: int = 40, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, row_number, position, shard, slot.

    Law `rows`: numbers of rows differ by one at most. size: UTF-8 bytes plus 16; null texts count as empty. Ids are
    integers; equal and null ids are told apart by checksum and size, and rows alike in all are interchangeable. An empty
    table gives an empty result; further columns are ignored.
    """
    body = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = pick(docs, doc_id, text).select(F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    # A number in place of the row itself tells rows apart that are alike: very many such would else be one range.
    rows = cut(rows.withColumn("alike", F.monotonically_increasing_id()))
    n = rows.count()
    placed = permuted(numbered(rows, [block(F.col("doc_id")), "doc_id", "text_crc32", "size", "alike"]).drop("alike"), n)
    return placed.withColumn("shard", F.pmod("position", F.lit(shards)).cast("int")).withColumn("slot", F.expr(f"position div {shards}"))


def place_of(row_number: int, n: int, shards: int = 40) -> tuple[int, int]:
    """Shard and slot of a row number, computed without any table."""
    (a, b), x = sides(n), row_number
    while True:
        upper, lower = divmod(x, b)
        for turn, key in enumerate(KEYS):
            t = ((upper if turn % 2 else lower) % PRIME + key) % PRIME
            t = ((t * t + key) % PRIME * FACTOR + key) % PRIME
            upper, lower = (upper, (lower + t) % b) if turn % 2 else ((upper + t) % a, lower)
        x = upper * b + lower
        if x < n:
            return x % shards, x // shards
