"""Hard negatives by a vertical scan (BOND) of integer vectors.

Rows are cut into blocks that hold their vectors by dimension. An anchor reads a block's dimensions in descending order of its own
magnitudes. What the dimensions not yet read can add at least and at most follows from the block's minima and maxima, so
after each step every row has a lower and an upper bound of its score; rows that can't enter the result leave the bitmap,
and those left at the end have their exact scores.

One pass finds the anchors' positives among the rows of their label, a second what the positives' windows ask for among the others.
Anchors and blocks meet in tiles: a pack of anchors is shipped once for each column of tiles, a block once for each row of tiles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, numbered, pick, runs, tidied
from .search import matrix

#: Rows of a block and anchors of a pack.
BLOCK, PACK = 4096, 256
#: Packs and blocks that meet in a tile, at most.
TILE_PACKS, TILE_BLOCKS = 64, 16
#: Tiles for each core of the cluster, at least, as long as there are packs and blocks enough.
PER_CORE = 4
#: Dimensions of a scan's first step; each further step reads as many as all before it.
FIRST = 8
#: Below this sums of integers are exact as doubles.
EXACT = 2.0**53


def labelled(vectors: DataFrame, scale: int = 256, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding") -> DataFrame:
    """vec_id, label (long), v (array of long): each component x as floor(scale * x). Rows with a null id, label, vector or component, or a non-finite one, are left out."""
    rows = pick(vectors, vec_id, label, embedding).toDF("vec_id", "label", "x").selectExpr("cast(vec_id as long) vec_id", "cast(label as long) label", "cast(x as array<double>) x")
    good = rows.where("vec_id is not null and label is not null and x is not null and forall(x, c -> c is not null and not isnan(c) and abs(c) < double('Infinity'))")
    return good.select("vec_id", "label", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def packed(rows: DataFrame, size: int, width: int, extra: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """One row for each `size` rows by their column at: number, and as bytes their ids, labels, data (a row a dimension, narrowest integers of kind), first and last label, extra columns as lists."""
    kept = [c for c, _ in extra]
    names = ["number", "ids", "labels", "kind", "data", "first", "last", *kept]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (number,), t in runs(batches, "number"):
            m = matrix(t.column("v").combine_chunks(), width).T
            kind = next(k for k in ("i1", "i2", "i4", "i8") if not m.size or (np.iinfo(k).min <= m.min() and m.max() <= np.iinfo(k).max))
            ids, labels = (t.column(c).to_numpy() for c in ("vec_id", "label"))
            own = [pa.array([number]), pa.array([ids.tobytes()]), pa.array([labels.tobytes()]), pa.array([kind]), pa.array([np.ascontiguousarray(m.astype(kind)).tobytes()]), pa.array([int(labels.min())]), pa.array([int(labels.max())])]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array([t.column(c).to_pylist()], pa.list_(t.schema.field(c).type)) for c in kept]], names)

    together = rows.withColumn("number", F.expr(f"at div {size}")).repartition("number").sortWithinPartitions("number", "at").select("number", "vec_id", "label", "v", *kept)
    return together.mapInArrow(tidied(each), ", ".join(["number long, ids binary, labels binary, kind string, data binary, first long, last long", *(f"{c} array<{kind}>" for c, kind in extra)]))


class Side:
    """A pack or a block in a task."""

    def __init__(self, row: dict, width: int) -> None:
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.by_dimension = np.frombuffer(row["data"], row["kind"]).reshape(width, len(self.ids))
        self.most = float(np.abs(self.by_dimension.astype(float)).max(initial=0.0))
        self.extra = row["windows"]


class Window:
    """The best scores of an anchor from least to most, both included, and the ids they belong to, so far."""

    def __init__(self, least: float, most: float, room: int) -> None:
        self.least, self.most, self.room, self.floor = least, most, room, least
        self.found: list[tuple[int, int]] = []

    def bounded(self, low: np.ndarray, up: np.ndarray) -> None:
        """Raises the floor by rows that are sure to lie in the window."""
        sure = low[(low >= self.least) & (up <= self.most)]
        if len(sure) >= self.room:
            self.floor = max(self.floor, np.partition(sure, len(sure) - self.room)[len(sure) - self.room])

    def reached(self, low: np.ndarray, up: np.ndarray) -> np.ndarray:
        return (up >= self.floor) & (low <= self.most)

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = (scores >= self.floor) & (scores <= self.most)
        if inside.any():
            self.found = sorted([*self.found, *zip((-scores[inside]).tolist(), ids[inside].tolist(), strict=True)])[: self.room]
            if len(self.found) == self.room:
                self.floor = max(self.floor, -self.found[-1][0])


def scan(anchor: np.ndarray, order: np.ndarray, least: np.ndarray, most: np.ndarray, block: np.ndarray, alive: np.ndarray, windows: list[Window]) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the block's rows that may enter a window.

    least, most: what the dimensions from each place of the order on can add; alive: places of the rows that take part.
    """
    score, at, step = np.zeros(len(alive)), 0, FIRST
    while at < len(order) and len(alive):
        dims = order[at : at + step]
        score = score + anchor[dims] @ block[np.ix_(dims, alive)].astype(float)
        at, step = at + len(dims), at + len(dims)
        low, up = score + least[at], score + most[at]
        hit = np.zeros(len(alive), bool)
        for w in windows:
            w.bounded(low, up)
            hit |= w.reached(low, up)
        if not hit.all():
            alive, score = alive[hit], score[hit]
    return alive, score


def met(packs: list[Side], block: Side, state: dict, same: bool) -> None:
    """Lets every anchor of the packs read a block; what it finds goes to its windows in state."""
    rows, lo, hi = block.by_dimension, block.by_dimension.min(axis=1).astype(float), block.by_dimension.max(axis=1).astype(float)
    own: dict[int, np.ndarray] = {}
    for p, pack in enumerate(packs):
        q = pack.by_dimension.T
        if pack.most * block.most * len(rows) >= EXACT:  # beyond doubles: whole sums of Python's integers
            whole = q.astype(object) @ rows.astype(object)
        else:
            whole, q = None, q.astype(float)
            order = np.argsort(-np.abs(q), axis=1, kind="stable")
            sorted_q = np.take_along_axis(q, order, 1)
            ends = sorted_q * lo[order], sorted_q * hi[order]
            # Of the dimensions from each place on; nothing is left after the last.
            least, most = (np.c_[np.cumsum(f(*ends)[:, ::-1], axis=1)[:, ::-1], np.zeros(len(q))] for f in (np.minimum, np.maximum))
        for i in range(len(q)):
            label, windows = int(pack.labels[i]), state[p, i]
            if not windows or (whole is None and not any(most[i, 0] >= w.floor and least[i, 0] <= w.most for w in windows)):
                continue
            if label not in own:
                own[label] = np.flatnonzero(block.labels == label) if same else np.flatnonzero(block.labels != label)
            alive = own[label][block.ids[own[label]] != pack.ids[i]]
            if whole is None:
                alive, scores = scan(q[i], order[i], least[i], most[i], rows, alive, windows)
                scores = scores.astype(np.int64)
            else:
                scores = np.clip(whole[i][alive], -(1 << 63), (1 << 63) - 1)
            for w in windows if len(alive) else ():
                w.take(scores, block.ids[alive])


def _tiles(anchors: DataFrame, blocks: DataFrame, width: int, same: bool, room: int, open_windows: Callable[[Side, int], list[Window]]) -> DataFrame:
    """anchor_id, place (of the window), vec_id, score: the best of each tile for each window. anchors, blocks: packed(), the first with windows."""
    n_packs, n_blocks = anchors.count(), blocks.count()
    least = PER_CORE * anchors.sparkSession.sparkContext.defaultParallelism
    packs_in, blocks_in = TILE_PACKS, TILE_BLOCKS
    while max(packs_in, blocks_in) > 1 and -(-n_packs // packs_in) * -(-n_blocks // blocks_in) < least:
        blocks_in, packs_in = (blocks_in // 2, packs_in) if blocks_in > 1 else (blocks_in, packs_in // 2)
    down, across = -(-n_packs // packs_in), -(-n_blocks // blocks_in)
    left = anchors.withColumn("row", F.expr(f"number div {packs_in}"))
    right = blocks.withColumn("column", F.expr(f"number div {blocks_in}")).withColumn("windows", F.lit(None).cast(dict(anchors.dtypes)["windows"]))
    if same:  # only tiles in which labels meet: their ends tell, as both sides are ordered by label
        a = left.groupBy("row").agg(F.min("first").alias("a"), F.max("last").alias("b"))
        b = right.groupBy("column").agg(F.min("first").alias("c"), F.max("last").alias("d"))
        grid = a.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))).alias("column")).join(b, "column").where("a <= d and c <= b")
        grid = cut(grid.select("row", "column"))
        left, right = left.join(grid, "row"), right.join(grid, "column")
    else:
        left = left.withColumn("column", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))))
        right = right.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long"))))
    columns = ["row", "column", "side", "number", "ids", "labels", "kind", "data", "windows"]
    both = left.withColumn("side", F.lit(0)).select(*columns).unionByName(right.withColumn("side", F.lit(1)).select(*columns))
    # A partition of its own for each tile, up to a bound.
    placed = both.repartitionById(min(down * across, 100_000), F.expr(f"cast((row * {across} + column) % {min(down * across, 100_000)} as int)")).sortWithinPartitions("row", "column", "side", "number")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, packs, state = None, [], {}

        def best() -> pa.RecordBatch:
            got = [(int(packs[p].ids[i]), k, v, -s) for (p, i), windows in state.items() for k, w in enumerate(windows) for s, v in w.found]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got, strict=True) if got else [[]] * 4, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["anchor_id", "place", "vec_id", "score"])

        for b in batches:
            for k in range(b.num_rows):
                row = b.slice(k, 1).to_pylist()[0]
                if (row["row"], row["column"]) != tile:
                    if state:
                        yield best()
                    tile, packs, state = (row["row"], row["column"]), [], {}
                side = Side(row, width)
                if row["side"] == 0:
                    state |= {(len(packs), i): open_windows(side, i) for i in range(len(side.ids))}
                    packs.append(side)
                else:
                    met(packs, side, state, same)
        if state:
            yield best()

    found = placed.mapInArrow(tidied(each), "anchor_id long, place int, vec_id long, score long")
    return found.selectExpr("*", "row_number() over (partition by anchor_id, place order by score desc, vec_id) rank").where(F.col("rank") <= room)


def mine(anchors: DataFrame, rows: DataFrame, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank (int, from 1), negative_id, positive_score, negative_score.

    anchors, rows: vec_id, label, v, as from labelled(). An anchor's positives are the rows of its label with the highest inner products, fewer if there are fewer; for each one the
    `negatives` best rows of other labels whose score is at least `least` and at most `most` hundredths of the positive's. Ties go to the smaller vec_id. Rows of the anchor's own id are
    passed over; repeated rows count as often as they occur, an anchor that is repeated once, with its smallest label and vector. Shorter vectors count as padded by zeros.
    Windows without a negative give no row; empty tables give an empty result. Scores beyond a long are cut to its ends.
    """
    order = ["label", "vec_id", "alike"]
    alike = F.monotonically_increasing_id()
    c = numbered(cut(rows.select("vec_id", "label", "v")).withColumn("alike", alike), order, "at")
    once = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("s")).select("vec_id", "s.label", "s.v")
    a = cut(numbered(cut(once).withColumn("alike", alike), order, "at"))
    widths = [x.agg(F.max(F.size("v"))).first()[0] for x in (a, c)]
    if None in widths:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    width = max(1, *widths)
    blocks = cut(packed(c, BLOCK, width))
    of_all = cut(packed(a.withColumn("windows", F.array().cast("array<long>")), PACK, width, (("windows", "array<long>"),)))
    found = cut(_tiles(of_all, blocks, width, True, positives, lambda side, i: [Window(float("-inf"), float("inf"), positives)]).select("anchor_id", "rank", "vec_id", "score"))
    asked = found.groupBy("anchor_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda s: s["score"]).alias("windows"))  # `positives` numbers at most
    with_windows = a.join(asked, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    # Anchors are numbered anew, as some may have no positive.
    sides = cut(packed(cut(numbered(with_windows.drop("at"), order, "at")), PACK, width, (("windows", "array<long>"),)))
    if sides.isEmpty():
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    # least * positive <= 100 * negative <= most * positive, in whole numbers.
    opened = lambda side, i: [Window(-((-least * p) // 100), most * p // 100, negatives) for p in side.extra[i]]
    mined = _tiles(sides, blocks, width, False, negatives, opened)
    of = found.select(F.col("anchor_id").alias("of"), (F.col("rank") - 1).alias("at"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    both = mined.join(of, (F.col("anchor_id") == F.col("of")) & (F.col("place") == F.col("at")))
    return both.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
