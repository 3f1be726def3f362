"""Best-fit packing with certified bin counts.

Each partition packs its pieces best-fit decreasing. A dual-feasible-function bound on the partition's sizes certifies
its number of bins: where both agree no packing of these pieces does with fewer. Partitions with a gap give up the pieces
of their emptiest bins, certified ones those of a few, as slack adds up over partitions; the pieces given up are dealt
anew over fewer partitions and packed again, until one partition is left. A round that leaves nearly as many pieces halves
the share that is given up, so that the rounds come to an end at any size: about as many as the logarithm of the partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, small_batches, tidied
from .tokens import TEXTS, TOKENIZER, pieces

#: Pieces that one task packs at once.
PER_TASK = 100_000
#: Of its bins, the emptiest that a partition gives up: with a gap, and certified.
GAP_SHARE, SLACK_SHARE = 0.5, 0.05
#: A round that leaves more than this share of its pieces gives up fewer bins the next time.
ENOUGH = 0.75


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of the dual feasible functions u_e (sizes over capacity - e count whole, those under e not at all)."""
    if not len(sizes):
        return 0
    counts = np.bincount(sizes, minlength=capacity + 1)
    number, volume = np.cumsum(counts), np.cumsum(counts * np.arange(capacity + 1))
    e = np.arange(0, capacity // 2 + 1)
    large = number[capacity] - number[capacity - e]
    middle = volume[capacity - e] - np.where(e > 0, volume[e - 1], 0)
    return int((large + -(-middle // capacity)).max())


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing in the order given (sizes must not increase): bin and offset of each, and each bin's room left."""
    place, offset, room = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # has bit r if some bin has room r
    for i, size in enumerate(sizes.tolist()):
        if fits := mask >> size:
            r = size + (fits & -fits).bit_length() - 1
            b = open_bins[r].pop()
            if not open_bins[r]:
                mask ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        place[i], offset[i] = b, capacity - r
        room[b] = r = r - size
        if r:
            open_bins[r].append(b)
            mask |= 1 << r
    return place, offset, np.array(room, np.int64)


def pack(items: DataFrame, capacity: int = 2048, length: str = "length", per_task: int = PER_TASK) -> DataFrame:
    """Adds sequence_id and offset (long) to items so that sequences hold at most `capacity` and have no gaps.

    Items longer than capacity or without a positive length are refused. Equal items are all placed; an empty table gives
    an empty result. Columns named as the two results are replaced. Sequence ids have no order.
    """
    names = [c for c in items.columns if c not in ("sequence_id", "offset")]
    own = [f"c{i}" for i in range(len(names))]
    at = names.index(length)
    now = cut(items.select(*names).toDF(*own))
    schema = T.StructType([*now.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("settled", T.BooleanType())])
    done, share, turn = [], GAP_SHARE, 0
    n = now.count()
    while True:
        parts = max(1, -(-n // per_task))
        last = parts == 1
        placed = cut(now.repartition(parts).mapInArrow(tidied(_packer(at, capacity, turn, last, share)), schema))
        done.append(placed.where("settled").drop("settled"))
        if last:
            break
        now = placed.where("not settled").select(*own)
        left = now.count()
        if not left:
            break
        if left > ENOUGH * n:
            share /= 2
        n, turn = left, turn + 1
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.toDF(*names, "sequence_id", "offset")


def _packer(at: int, capacity: int, turn: int, last: bool, gap_share: float):  # noqa: ANN202
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = list(batches)
        table = pa.Table.from_batches(held) if held else None
        if table is None or not table.num_rows:
            return
        sizes = table.column(at).to_numpy(zero_copy_only=False)
        if table.column(at).null_count or sizes.min() < 1 or sizes.max() > capacity:
            raise ValueError(f"lengths must lie between 1 and {capacity}")
        order = np.argsort(-sizes, kind="stable")
        sizes = sizes[order].astype(np.int64)
        place, offset, room = best_fit(sizes, capacity)
        settled = np.ones(len(room), bool)
        if not last:
            # Certified where the bound is met: no packing has fewer bins. The slack of many partitions may still add up to bins.
            share = gap_share if len(room) > lower_bound(sizes, capacity) else min(SLACK_SHARE, gap_share)
            emptiest = np.argsort(room, kind="stable")[::-1][: max(1, int(len(room) * share))]
            settled[emptiest[room[emptiest] > 0]] = False
        ids = (np.int64(turn) << 56) + (np.int64(TaskContext.get().partitionId()) << 32) + place
        columns = [*table.take(pa.array(order)).columns, pa.array(ids), pa.array(offset), pa.array(settled[place])]
        yield from pa.table(columns, names=[*table.column_names, "sequence_id", "offset", "settled"]).to_batches(max_chunksize=10_000)

    return each


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = 2048, end_id: int = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Token sequences of documents: doc_id, piece, start, length, ids, sequence_id, offset.

    Null texts are empty documents (only end_id); only documents longer than capacity are cut. See pieces() and pack().
    """
    return pack(pieces(docs, tokenizer, capacity, end_id, text, doc_id), capacity)


def digests(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = 2048, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """As pack_documents(), with the CRC-32 of each piece's ids in place of the ids, taken before anything is shuffled."""
    items = pieces(docs, tokenizer, capacity, 0, text, doc_id).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    with small_batches(docs.sparkSession, TEXTS):
        return pack(items, capacity)
