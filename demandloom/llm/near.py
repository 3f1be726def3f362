"""Near-duplicates by the exact similarity of word shingles.

Candidates come from operator 1's method at a wider radius: multi-index hashing of SimHash fingerprints of the shingles, which have 1024 bits
and share one of many segments (simhash.Segments; of pairs with a similarity of 0.8 a share of 0.999 does, by arithmetic). A pair goes on if few bits of the first 64 and of the
whole fingerprint differ and enough of its sets' minima agree, told by four bits of each; then its whole shingle sets are compared. A few pairs a text are taken first. What those of them that are likely
alike join in large groups (kins) is compared in blocks, whose sets are shipped once for each block they meet: only alike texts become rows. So are members of a key that very many texts share, unless
one group or kin holds them all. Other pairs go on only if they would join what is apart and are of no common large kin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, looked_up, numbered, runs, sliced, tidied, words
from .components import connected, keep_first
from .simhash import WIDE, Segments, wide

SHINGLE, SIMILARITY = 5, 0.8
#: Of BANDS times ROWS minima of a text the sketch tells four bits each.
BANDS, ROWS = 20, 4
#: A key that more texts than this share, and a kin of more, goes by blocks.
CROWDED = 32
#: Segments by which each text is compared with two others first.
EARLY = 8
#: Standard deviations above the mean of a pair of the similarity asked for, within which the first 64 bits and all of them may differ.
FIRST, WHOLE = 5, 6.5
#: Of the minima so many agree in four bits for all but 2 in 10^7 pairs with a similarity of 0.8: five deviations (3.5) below the mean of 65.
AGREE = 47
#: Texts and hashes of a block, at most, and entries of a block's columns that are counted together.
MEMBERS, ROOM, ENTRIES = 512, 100_000, 1 << 20
#: Tiles of two blocks that a task gets, in the mean.
TILES = 8
SEED = 42
#: Texts, and hashes of a text, that are held at a time.
TOGETHER, BLOCK = 1000, 4096
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes | None, shingle: int) -> np.ndarray:
    """The different XXH64 of a text's word shingles, ascending; texts shorter than a shingle count as one, blank ones have none."""
    found = text.split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    grams = map(b" ".join, zip(*(found[i:] for i in range(shingle)), strict=False)) if len(found) > shingle else [b" ".join(found)]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype=np.uint64))


def minima(hashed: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a text's shingles."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashed), BLOCK):
        least = np.minimum(least, ((hashed[i : i + BLOCK, None] ^ FACTORS[1]) * FACTORS[0]).min(axis=0))
    return least


def keys(hashed: np.ndarray) -> tuple[bytes | None, list[int]]:
    """A text's wide fingerprint, and four bits of each minimum, sixteen to a number; nothing for blank texts."""
    if not len(hashed):
        return None, []
    bits = (minima(hashed) >> np.uint64(20) & np.uint64(15)).reshape(-1, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))
    return wide(hashed), bits.sum(axis=1, dtype=np.uint64).view(np.int64).tolist()


def node(text: Column) -> Column:
    """Names a text by its lower-case words; the same for null and blank texts."""
    return F.xxhash64(words(F.lower(text)))


def mapped(rows: DataFrame, shingle: int, whole: bool) -> DataFrame:
    """rows' columns but the last, a lower-case text as binary, with size, print (its fingerprint) and sketch, or with the sorted shingles if whole."""
    added = [T.StructField("hashes", T.ArrayType(T.LongType()))] if whole else [T.StructField("size", T.LongType()), T.StructField("print", T.BinaryType()), T.StructField("sketch", T.ArrayType(T.LongType()))]
    schema = T.StructType([*rows.schema.fields[:-1], *added])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, TOGETHER):
            found = [shingles(t, shingle) for t in b.columns[-1].to_pylist()]
            listed = lambda values: pa.array(values, pa.list_(pa.int64()))
            if whole:
                made = [listed([h.view(np.int64) for h in found])]
            else:
                both = [keys(h) for h in found]
                made = [pa.array([len(h) for h in found], pa.int64()), pa.array([k for k, _ in both], pa.binary()), listed([m for _, m in both])]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *made], schema.names)

    return rows.mapInArrow(tidied(each), schema)


def agreeing(a: str, b: str) -> Column:
    """How many minima of two sketches agree in their four bits."""
    differ = [F.col(a)[i].bitwiseXOR(F.col(b)[i]) for i in range(BANDS * ROWS // 16)]
    any_bit = [x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseOR(F.shiftrightunsigned(x, 3)).bitwiseAND(F.lit(0x1111111111111111)) for x in differ]
    return BANDS * ROWS - sum(map(F.bit_count, any_bit[1:]), F.bit_count(any_bit[0]))


def apart(a: str, b: str) -> Column:
    """How many bits of two fingerprints differ."""
    word = lambda c, i: F.conv(F.hex(F.substring(c, 8 * i + 1, 8)), 16, -10).cast("long")
    differ = [F.bit_count(word(a, i).bitwiseXOR(word(b, i))) for i in range(WIDE // 64)]
    return sum(differ[1:], differ[0])


def dealt(prints: DataFrame, segments: Segments) -> DataFrame:
    """key, node, size, word (the first 64 bits), root of each text under each of its segments. prints: node, size, print and maybe root; without it each text is its own."""
    root = F.col("root") if "root" in prints.columns else F.col("node")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, TOGETHER):
            raw = np.frombuffer(b"".join(b.column("print").to_pylist()), np.uint8).reshape(-1, WIDE // 8)
            columns = [b.column("node").to_numpy(), b.column("size").to_numpy(), np.ascontiguousarray(raw[:, :8]).view(np.int64)[:, 0], b.column("root").to_numpy()]
            yield pa.RecordBatch.from_arrays([pa.array(segments.values(raw).ravel()), *[pa.array(np.repeat(c, segments.number)) for c in columns]], ["key", "node", "size", "word", "root"])

    return prints.where("print is not null").select("node", "size", "print", root.alias("root")).mapInArrow(tidied(each), "key long, node long, size long, word long, root long")


def beside(prints: DataFrame, segments: Segments, similarity: float) -> DataFrame:
    """Pairs a, b of each text with the first of those that share one of the first EARLY segments and with the one before it there, whose sizes and first 64 bits allow
    the similarity: at most so many a text, however many are alike."""
    first = segments.radius(64, FIRST)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 4
        for b in batches:
            if not b.num_rows:
                continue
            # Of what came before, the first and the last row of the run that may go on.
            before = len(held[0])
            key, node, size, word = held = [np.r_[x, b.column(i).to_numpy()] for i, x in enumerate(held)]
            start = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(key)), 0))
            y = np.arange(before, len(key))
            y = y[start[y] < y]
            x, y = np.r_[start[y], y - 1], np.r_[y, y]
            near = possible(size, word, x, y, similarity, first) & (node[x] != node[y])
            yield pa.RecordBatch.from_arrays([pa.array(f(node[x], node[y])[near]) for f in (np.minimum, np.maximum)], ["a", "b"])
            held = [c[[start[-1], -1]] for c in held]

    rows = dealt(prints, replace(segments, number=min(EARLY, segments.number))).drop("root")
    return rows.repartition("key").sortWithinPartitions("key", "node").mapInArrow(tidied(each), "a long, b long")


def possible(size: np.ndarray, word: np.ndarray, x: np.ndarray, y: np.ndarray, similarity: float, first: int) -> np.ndarray:
    """Whether sizes and first 64 bits of the texts at x and y allow the similarity."""
    return (np.minimum(size[x], size[y]) >= similarity * np.maximum(size[x], size[y]) - 1e-9) & (np.bitwise_count((word[x] ^ word[y]).view(np.uint64)) <= first)


def met(prints: DataFrame, segments: Segments, similarity: float) -> DataFrame:
    """Who shares a segment: pairs a, b (key null) of different roots whose sizes and first 64 bits allow the similarity; of segments that over CROWDED texts share each text a
    with its size and root (b) under the segment's key. prints: node, size, print and maybe root; without it each text is its own."""
    crowded, first = CROWDED, segments.radius(64, FIRST)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64)] * 5
        for b in batches:
            if not b.num_rows:
                continue
            held = [np.r_[x, b.column(i).to_numpy()] for i, x in enumerate(held)]
            # The last run may go on. Of one that is crowded already only so many rows are held as tell it.
            last = int(np.searchsorted(held[0], held[0][-1]))
            run = len(held[0]) - last
            end = last if run <= crowded else len(held[0]) - crowded - 1
            yield of(held, last, end)
            held = [x[end:] for x in held]
        yield of(held, len(held[0]), len(held[0]))

    def of(held: list[np.ndarray], whole: int, end: int) -> pa.RecordBatch:
        """Runs before `whole` are whole; the rows from there to `end` are of a crowded one."""
        key, node, size, word, root = held
        starts = np.flatnonzero(np.r_[True, key[1:whole] != key[: whole - 1]]) if whole else np.empty(0, np.int64)
        length = np.repeat(np.diff(np.r_[starts, whole]), np.diff(np.r_[starts, whole]))
        many = np.r_[np.flatnonzero(length > crowded), np.arange(whole, end)]
        a, b = [], []
        for step in range(1, crowded):
            x = np.flatnonzero((key[step:whole] == key[: max(0, whole - step)]) & (length[step:] <= crowded)) if step < whole else np.empty(0, np.int64)
            if not len(x):
                break
            y = x + step
            near = possible(size, word, x, y, similarity, first) & (root[x] != root[y])
            a.append(np.minimum(node[x], node[y])[near]), b.append(np.maximum(node[x], node[y])[near])
        none = np.zeros(sum(map(len, a)), np.int64)
        blank = np.arange(len(none) + len(many)) < len(none)
        made = [pa.array(np.r_[none, key[many]], mask=blank), pa.array(np.r_[(none[:0], *a, node[many])]), pa.array(np.r_[(none[:0], *b, root[many])]), pa.array(np.r_[none, size[many]], mask=blank)]
        return pa.RecordBatch.from_arrays(made, ["key", "a", "b", "size"])

    return cut(dealt(prints, segments).repartition("key").sortWithinPartitions("key").mapInArrow(tidied(together), "key long, a long, b long, size long"))


def whole_sets(nodes: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """node, hashes of the nodes (column node)."""
    return cut(mapped(texts.join(nodes.distinct(), "node", "left_semi").dropDuplicates(["node"]).select("node", "body"), shingle, True))


def likely(pairs: DataFrame, prints: DataFrame, similarity: float, radius: int) -> DataFrame:
    """The different pairs a, b whose fingerprints differ in at most so many bits and whose sketches allow the similarity. prints: node, print, sketch."""
    sketches = prints.select("node", "print", "sketch")
    sketched = pairs.distinct().join(sketches.toDF("a", "_pa", "_sa"), "a").join(sketches.toDF("b", "_pb", "_sb"), "b").where(apart("_pa", "_pb") <= radius)
    # This bound is for similarities of SIMILARITY and more.
    return cut((sketched.where(agreeing("_sa", "_sb") >= AGREE) if similarity >= SIMILARITY else sketched).select("a", "b"))


def alike(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """The pairs a, b whose shingle sets have the similarity. texts: node, body."""
    sets = whole_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")), texts, shingle)
    both = pairs.join(sets.toDF("a", "_a"), "a").join(sets.toDF("b", "_b"), "b")
    common = F.size(F.array_intersect("_a", "_b"))
    return cut(both.where(common * (1 + similarity) >= similarity * (F.size("_a") + F.size("_b")) - 1e-9).select("a", "b"))


def overlaps(a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray) -> np.ndarray:
    """How many hashes each set of one block shares with each of another. Hashes that many sets hold are counted by matrix products, the others one by one."""
    held, number = np.unique(np.r_[a, b], return_inverse=True)
    rows_a, rows_b = np.repeat(np.arange(len(a_sizes)), a_sizes), np.repeat(np.arange(len(b_sizes)), b_sizes)
    col_a, col_b = number[: len(a)], number[len(a) :]
    n_a, n_b = np.bincount(col_a, minlength=len(held)), np.bincount(col_b, minlength=len(held))
    out = np.zeros((len(a_sizes), len(b_sizes)), np.float32)
    dense = np.flatnonzero(n_a * n_b > 256)
    for i in range(0, len(dense), MEMBERS):
        place = np.full(len(held), -1)
        place[dense[i : i + MEMBERS]] = np.arange(len(dense[i : i + MEMBERS]))
        sides = []
        for rows, cols, n in ((rows_a, col_a, len(a_sizes)), (rows_b, col_b, len(b_sizes))):
            m, at = np.zeros((n, len(dense[i : i + MEMBERS])), np.float32), place[cols]
            m[rows[at >= 0], at[at >= 0]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    few = (n_a * n_b <= 256) & (n_a > 0) & (n_b > 0)
    mine = np.flatnonzero(few[col_a])
    order = np.argsort(col_b, kind="stable")
    starts = np.cumsum(n_b) - n_b
    for part in np.array_split(mine, max(1, -(-int(n_b[col_a[mine]].sum()) // ENTRIES))):
        times = n_b[col_a[part]]
        inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        other = rows_b[order[np.repeat(starts[col_a[part]], times) + inner]]
        out += np.bincount(np.repeat(rows_a[part], times) * len(b_sizes) + other, minlength=out.size).reshape(out.shape)
    return out


def crowded_edges(named: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Pairs a, b of members of the same key (key, node, size, root) that have the similarity and different roots.

    A key's members are cut into blocks by bands of size, of which only neighbours can be alike, and within them by root: blocks of one root don't meet. No block holds more than MEMBERS texts and,
    but for a single text, about ROOM hashes.
    """
    step = math.log(1 / similarity)
    rows = numbered(named.select("key", F.floor(F.log("size") / step + 1e-9).cast("int").alias("band"), "root", "node"), ["key", "band", "root", "node"], "at")
    starts = rows.groupBy("key", "band").agg(F.min("at").alias("start"))
    room = F.greatest(F.lit(1), F.least(F.lit(MEMBERS), F.floor(ROOM / F.exp(step * (F.col("band") + 1)))))
    placed = cut(rows.join(starts, ["key", "band"]).select("key", "band", F.floor((F.col("at") - F.col("start")) / room).alias("block"), "root", "node"))
    heads = placed.groupBy("key", "band", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    other = heads.toDF("_key", "_band", "_block", "_lo", "_hi")
    near = (F.col("key") == F.col("_key")) & (((F.col("band") == F.col("_band")) & (F.col("block") <= F.col("_block"))) | (F.col("band") + 1 == F.col("_band")))
    tiles = cut(heads.join(other, near & ~((F.col("lo") == F.col("hi")) & (F.col("_lo") == F.col("_hi")) & (F.col("lo") == F.col("_lo")))).select("key", "band", "block", "_band", "_block"))
    asked = tiles.select("key", "band", "block").union(tiles.select("key", "_band", "_block")).distinct()
    members = placed.join(asked, ["key", "band", "block"], "left_semi")
    sets = whole_sets(members.select("node"), texts, shingle)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, t in runs(batches, "key", "band", "block"):
            lists = t.column("hashes").combine_chunks()
            raw = [t.column("node").to_numpy(), t.column("root").to_numpy(), np.asarray(lists.value_lengths(), np.int64), lists.flatten().to_numpy()]
            yield pa.RecordBatch.from_arrays([*[pa.array([k], kind) for k, kind in zip(key, (pa.int64(), pa.int32(), pa.int64()), strict=True)], *[pa.array([r.tobytes()]) for r in raw]], ["key", "band", "block", "nodes", "roots", "sizes", "hashes"])

    full = members.join(sets, "node").repartition("key", "band", "block").sortWithinPartitions("key", "band", "block", "node").select("key", "band", "block", "node", "root", "hashes")
    blocks = cut(full.mapInArrow(tidied(packed), "key long, band int, block long, nodes binary, roots binary, sizes binary, hashes binary"))
    names = ["nodes", "roots", "sizes", "hashes"]
    numbered_tiles = cut(tiles.withColumn("tile", F.monotonically_increasing_id()))
    same = (F.col("band") == F.col("_band")) & (F.col("block") == F.col("_block"))
    sides = [
        numbered_tiles.select("tile", "key", "band", "block", F.lit(0).alias("side")),
        numbered_tiles.where(~same).select("tile", "key", F.col("_band").alias("band"), F.col("_block").alias("block"), F.lit(1).alias("side")),
    ]
    sent = [x.join(blocks, ["key", "band", "block"]).select("tile", "side", *names) for x in sides]
    # Few tiles a task: a task holds those of a batch.
    tasks = max(1, numbered_tiles.count() // TILES)
    placed = sent[0].union(sent[1]).repartition(tasks, "tile").sortWithinPartitions("tile", "side")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, t in runs(batches, "tile"):
            rows = t.to_pylist()
            one, two = ([np.frombuffer(row[c], np.int64) for c in names] for row in (rows[0], rows[-1]))
            # As doubles: single precision would lose pairs of just the similarity.
            hit = overlaps(one[3], one[2], two[3], two[2]).astype(np.float64) * (1 + similarity) >= similarity * (one[2][:, None] + two[2][None, :]) - 1e-9
            hit &= one[1][:, None] != two[1][None, :]
            x, y = np.nonzero(hit if len(rows) > 1 else np.triu(hit))
            yield pa.RecordBatch.from_arrays([pa.array(one[0][x]), pa.array(two[0][y])], ["a", "b"])

    return cut(placed.mapInArrow(tidied(each), "a long, b long").distinct())


def links(prints: DataFrame, texts: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """node, root of the texts that have a near copy. prints: node, size, print, sketch, one row a node; texts: node, body."""
    segments = Segments.of(prints.count(), similarity)
    radius = segments.radius(WIDE, WHOLE)
    # A few pairs a text bring large groups together and tell who is kin: joined by pairs that are likely alike. Large kins are then compared whole, in blocks.
    pairs = likely(beside(prints, segments, similarity), prints, similarity, radius)
    edges, kins = alike(pairs, texts, shingle, similarity), connected(pairs).toDF("node", "kin")
    large = cut(kins.join(kins.groupBy("kin").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).select("kin"), "kin", "left_semi"))
    rooted = cut(prints.select("node", "size", "print").join(connected(edges), "node", "left").join(large, "node", "left").withColumn("root", F.coalesce("root", "node")))
    if not large.isEmpty():
        members = rooted.where("kin is not null").select(F.col("kin").alias("key"), "node", "size", "root")
        edges = edges.union(crowded_edges(divided(members), texts, shingle, similarity))
    # Pairs within a large kin are settled, by whatever root; its mark is no node's name.
    mark = F.when(F.col("kin").isNotNull(), F.xxhash64("kin", F.lit(SEED))).otherwise(F.coalesce("root", "node")).alias("root")
    found = met(rooted.select("node", "size", "print", mark), segments, similarity)
    pairs, many = found.where("key is null").select("a", "b"), found.where("key is not null").select("key", F.col("a").alias("node"), "size", F.col("b").alias("root"))
    edges = edges.union(alike(likely(pairs, prints, similarity, radius), texts, shingle, similarity))
    roots = connected(edges)
    if many.isEmpty():
        return roots
    roots = cut(roots)
    named = cut(divided(many).drop("root").join(roots, "node", "left").join(large, "node", "left").select("key", "node", "size", mark))
    return connected(edges.union(crowded_edges(divided(named), texts, shingle, similarity)))


def divided(named: DataFrame) -> DataFrame:
    """The rows (key, root) of keys whose members are of several groups: one group has no more pairs."""
    sides = named.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    return named.join(sides, "key", "left_semi")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Keeps one row of each group that pairs of at least the similarity join: that with the smallest id, of repeated ids the smallest row; a null id only if all are null.

    Texts of the same words are alike, null and blank ones too. Columns are those of docs.
    """
    names = list(docs.columns)
    own = [f"c{i}" for i in range(len(names))]
    docs = docs.toDF(*own)
    ident, body = own[names.index(doc_id)], F.col(own[names.index(text)])
    rows, small = docs.withColumn("node", node(body)), F.lower(body).cast("binary").alias("body")
    prints = cut(mapped(rows.select(F.col(ident).alias("id"), "node", small), shingle, False))
    fps = cut(prints.groupBy("node").agg(F.any_value("size").alias("size"), F.any_value("print").alias("print"), F.any_value("sketch").alias("sketch"), F.count("*").alias("n")))
    roots = links(fps.select("node", "size", "print", "sketch"), rows.select("node", small), shingle, similarity).toDF("_node", "root")
    known = cut(fps.join(roots, F.col("node") == F.col("_node"), "left").select(F.col("node").alias("fp"), F.coalesce("root", "node").alias("root"), "n"))
    members = looked_up(prints.select("id", F.col("node").alias("mark")), "mark", known, "fp", "n")
    return keep_first(docs, ident, node(body), members).toDF(*names)
