"""Exact top-k by inner product over norm-sorted, SVD-rotated vectors.

All vectors are rotated by the right singular vectors of the candidates, which leaves inner products as they are and puts
most of them into the first coordinates. Candidates are numbered by descending length and cut into blocks, which are processed in
rounds, each of many times the blocks of the one before. A query takes part in a round only if the round's longest candidate
can still reach its k-th best score so far (Cauchy-Schwarz), and meets only blocks of which the same holds. Within a block a
partial product over the first coordinates plus the product of the residual lengths prunes candidates, and the rest are
scored exactly on the integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered, pick, tidied

#: Vectors of a block of candidates and of queries.
BLOCK, QUERIES = 4096, 1024
#: Blocks of queries that a copy of a block of candidates serves.
SERVED = 16
#: Blocks of a round for each one of the rounds before.
GROWTH = 8
#: Share of the coordinates in the partial products.
HEAD = 4
#: What rounding may take from a bound, relative to the product of lengths.
SLACK = 1e-6
#: Below this sums of integers are exact as doubles; below the other they fit 64 bits. Scores beyond are cut to the ends of long.
EXACT, LONG = 2.0**53, 2.0**63


def quantised(vectors: DataFrame, scale: int = 64, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v (array of long): each component x as floor(scale * x). Rows with a null id or with a null or non-finite component, and null vectors, are left out."""
    rows = pick(vectors, vec_id, embedding).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    good = rows.where("vec_id is not null and x is not null and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('Infinity'))")
    return good.select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Arrays as rows, padded by zeros."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths())
    if len(ends) and (ends == width).all():
        return flat.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(ends), width), np.int64)
    out[np.repeat(np.arange(len(ends)), ends), np.arange(len(flat)) - np.repeat(np.cumsum(ends) - ends, ends)] = flat
    return out


def gram(vectors: DataFrame, width: int) -> np.ndarray:
    """Sum of the outer products of all vectors: one width x width matrix from each task."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for b in batches:
            m = matrix(b.column(0), width).astype(float)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(list(total))], ["i", "row"])

    parts = vectors.select("v").mapInArrow(each, "i long, row array<double>").select("i", F.posexplode("row").alias("j", "x"))
    sums = parts.groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros((width, width))
    out[sums.column("i").to_numpy(), sums.column("j").to_numpy()] = sums.column("x").to_numpy()
    return out


def _blocks(rows: DataFrame, width: int, name: str) -> DataFrame:
    """Rows (block, vec_id, v, norm, floor) as one row per block: name, and its ids, data (matrix of the narrowest integers), floors and longest norm as {name}_..."""

    def made(block: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks().sort_by("vec_id")
        data = matrix(t.column("v").combine_chunks(), width)
        kind = next(k for k in ("i1", "i2", "i4", "i8") if not data.size or (np.iinfo(k).min <= data.min() and data.max() <= np.iinfo(k).max))
        raw = [t.column("vec_id").to_numpy().tobytes(), kind, data.astype(kind).tobytes(), t.column("floor").to_numpy().astype(float).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *[pa.array([x]) for x in raw], pa.array([float(t.column("norm").to_numpy().max())])], [name, *[f"{name}_{x}" for x in ("ids", "kind", "data", "floors", "longest")]])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for b in batches:
            blocks = b.column("block").to_numpy()
            for at in np.split(np.arange(len(blocks)), np.flatnonzero(np.diff(blocks)) + 1):
                if not len(at):
                    continue
                if now is not None and blocks[at[0]] != now:
                    yield made(now, parts)
                    parts = []
                now = int(blocks[at[0]])
                parts.append(b.slice(int(at[0]), len(at)))
        if now is not None:
            yield made(now, parts)

    together = rows.repartition("block").sortWithinPartitions("block").select("block", "vec_id", "v", "norm", "floor")
    return together.mapInArrow(tidied(each), f"{name} long, {name}_ids binary, {name}_kind string, {name}_data binary, {name}_floors binary, {name}_longest double")


def products(q: np.ndarray, c: np.ndarray, most: float) -> np.ndarray:
    """Inner products of the rows as 64-bit integers, exact; most: what none exceeds."""
    if most < EXACT:
        return (q.astype(float) @ c.T.astype(float)).astype(np.int64)
    if most < LONG:
        return q.astype(np.int64) @ c.T.astype(np.int64)
    return np.clip(q.astype(object) @ c.T.astype(object), -(1 << 63), (1 << 63) - 1).astype(np.int64)


def best_of(s: np.ndarray, hit: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest of the scores that hit, ties to the first."""
    at = np.flatnonzero(hit)
    if len(at) <= k:
        return at
    own = s[at]
    least = np.partition(own, len(own) - k)[len(own) - k]
    over = at[own > least]
    return np.r_[over, at[own == least][: k - len(over)]]


def _scored(pairs: DataFrame, rotation: np.ndarray, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best candidates of each query of every pair of blocks, of those whose bound reaches the query's floor."""
    width = len(rotation)
    head = max(1, width // HEAD)
    turned: dict = {}

    def rotated(side: str, number: int, ids: bytes, kind: str, data: bytes) -> tuple:
        """Ids, vectors, first coordinates, residual lengths and lengths of a block; that of the last pair is often the next one's."""
        if turned.get(side, (None,))[0] != (number, ids):
            m = np.frombuffer(data, kind).reshape(-1, width)
            r = m.astype(float) @ rotation
            turned[side] = (number, ids), (np.frombuffer(ids, np.int64), m, r[:, :head], np.sqrt((r[:, head:] ** 2).sum(axis=1)), np.sqrt((m.astype(float) ** 2).sum(axis=1)))
        return turned[side][1]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                qid, q, qh, q_rest, q_norm = rotated("q", row["q"], row["q_ids"], row["q_kind"], row["q_data"])
                cid, c, ch, c_rest, c_norm = rotated("c", row["c"], row["c_ids"], row["c_kind"], row["c_data"])
                bound = qh @ ch.T + np.outer(q_rest, c_rest) + SLACK * np.outer(q_norm, c_norm) + SLACK
                hit = bound >= np.frombuffer(row["q_floors"], float)[:, None]
                hit &= qid[:, None] != cid[None, :]
                asked, met = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
                if not len(asked):
                    continue
                s = products(q[asked], c[met], float(q_norm[asked].max() * c_norm[met].max()) * (1 + SLACK))
                places = [best_of(s[i], hit[x, met], k) for i, x in enumerate(asked.tolist())]
                n = np.array([len(p) for p in places])
                which, flat = np.repeat(np.arange(len(asked)), n), np.concatenate(places)
                yield pa.RecordBatch.from_arrays([pa.array(qid[asked][which]), pa.array(cid[met][flat]), pa.array(s[which, flat])], ["query_id", "vec_id", "score"])

    return pairs.mapInArrow(tidied(each), "query_id long, vec_id long, score long")


def _best(scored: DataFrame, k: int) -> DataFrame:
    """The k best of each query, ties to the smaller id; each task first cuts its own part to k."""
    return scored.selectExpr("*", "row_number() over (partition by query_id order by score desc, vec_id) rank").where(F.col("rank") <= k)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20) -> DataFrame:
    """Each query's k highest inner products: query_id, rank (int, from 1), vec_id, score (long); fewer if there are fewer candidates.

    queries and candidates have vec_id (long) and v (array of long), as from quantised(). A candidate of the query's own id is passed over.
    Ties go to the smaller vec_id; repeated rows count as often as they occur, as candidates; a query's repeated rows are
    one query. Shorter vectors count as padded by zeros; empty tables give an empty result. Scores beyond a long are cut to its ends.
    """
    spark = candidates.sparkSession
    # A number beside the row tells repeated rows apart, so that very many of them are no one range.
    normed = lambda df: df.select("vec_id", "v", F.sqrt(F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("norm"), F.monotonically_increasing_id().alias("alike"))
    order = [F.desc("norm"), "vec_id", "alike"]
    c, q = numbered(cut(normed(candidates)), order, "at"), numbered(cut(normed(queries.dropDuplicates(["vec_id"]))), order, "at")
    n, width = c.agg(F.count("*"), F.max(F.size("v"))).first()
    n_queries, q_width = q.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n or not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(width, q_width, 1)
    # Right singular vectors of all candidates, by descending singular value: eigenvectors of their Gram matrix.
    rotation = np.linalg.eigh(gram(c, width))[1][:, ::-1]
    cb = cut(_blocks(c.select(F.expr(f"at div {BLOCK}").alias("block"), "vec_id", "v", "norm", F.lit(0.0).alias("floor")), width, "c"))
    heads, blocks = cb.select("c", "c_longest"), -(-n // BLOCK)
    queries = cut(q.select(F.expr(f"at div {QUERIES}").alias("block"), "vec_id", "v", "norm"))

    best, start, end = None, 0, 1
    while start < blocks:
        asking = queries.withColumn("floor", F.lit(None).cast("double"))
        if best is not None:
            floors = best.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor"))
            asking = queries.join(floors, F.col("vec_id") == F.col("id"), "left").drop("id")
        # The least length of a candidate that can still reach the query's floor; a query of length nought and one without k candidates need all.
        need = F.when((F.col("norm") > 0) & F.col("floor").isNotNull(), (F.col("floor") - 1e-6 - SLACK * F.abs("floor")) / F.col("norm")).otherwise(F.lit(float("-inf")))
        longest = heads.where(F.col("c") == start).select(F.col("c_longest").alias("longest"))  # one row
        asking = asking.withColumn("need", need).join(F.broadcast(longest), F.col("need") <= F.col("longest")).withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        needs = asking.groupBy("block").agg(F.min("need").alias("need"))
        qb = _blocks(asking, width, "q").join(needs, F.col("q") == F.col("block")).drop("q_longest", "block").withColumn("served", F.expr(f"q div {SERVED}"))
        qb = cut(qb)
        meets = qb.select("q", "served", "need", F.explode(F.sequence(F.lit(start).cast("long"), F.lit(min(end, blocks) - 1).cast("long"))).alias("c"))
        meets = cut(meets.join(heads, "c").where("c_longest >= need").select("q", "c", "served"))
        # Both sides come together by block of candidates and group of blocks of queries: neither is shipped for every pair.
        left = meets.select("q", "c").join(qb.drop("need"), "q").withColumnRenamed("c", "to")
        right = cb.drop("c_longest", "c_floors").join(meets.select(F.col("c").alias("of"), F.col("served").alias("by")).distinct(), F.col("c") == F.col("of")).drop("of")
        found = _scored(left.hint("merge").join(right, (F.col("to") == F.col("c")) & (F.col("served") == F.col("by"))), rotation, k).select("query_id", "vec_id", "score")
        best = cut(_best(found if best is None else best.unionByName(found), k).drop("rank"))
        start, end = end, end * GROWTH
    return _best(best, k).select("query_id", "rank", "vec_id", "score")
