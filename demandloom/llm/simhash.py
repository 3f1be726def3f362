"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two halves. Two fingerprints that differ in at most two bits differ in at most one bit of
some half, so that a lookup of the ball of radius one around one's half in a table of the other's halves finds the
pair; whole distances are then checked. Halves that very many fingerprints share would make as many pairs as the square
of their number; fingerprints that meet such a half are linked through the points of the whole 64-bit space that lie
within one bit of them. Two fingerprints share such a point just if they differ in at most two bits, and no more
than 65 of them can share one, so that this way is exact and bounded as well.

Texts that are less alike differ in more bits than halves can tell. Wide fingerprints are cut into many short segments instead,
as many as it takes for alike texts to share one nearly always (Segments); their whole distances are checked likewise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, looked_up, pick, tidied
from .components import connected, keep_first

#: Fingerprints link at this many differing bits or fewer; the two halves and the shared points rest on it.
RADIUS = 2
#: A half that more fingerprints than this share goes the other way.
CROWDED = 64
SEED = 42
#: Bits of a wide fingerprint; of pairs at the similarity asked for so many may share no segment.
WIDE, MISSED = 1024, 1e-3
#: Texts that meet in a segment's value by chance, in the mean, at most; the least bits of a segment.
BY_CHANCE, LEAST_BITS = 4, 8
STEPS = np.arange(WIDE // 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64 majority bits of the XXH64 of a text's word shingles, ASCII letters lower-cased, as a signed number."""
    found = text.lower().split() if text else []
    if not found:
        return 0
    grams = map(b" ".join, zip(*(found[i:] for i in range(shingle)), strict=False)) if len(found) > shingle else [b" ".join(found)]
    hashed = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype=">u8")
    ones = sum(np.unpackbits(hashed[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64) for i in range(0, len(hashed), 8192))
    return int.from_bytes(np.packbits(2 * ones > len(hashed)).tobytes(), "big", signed=True)


def wide(hashed: np.ndarray) -> bytes:
    """WIDE majority bits of hashes: the first 64 are those of the hashes, the others of numbers derived from them."""
    counts = np.zeros(WIDE, np.int64)
    for i in range(0, len(hashed), 255):  # a byte counts to 255
        x = hashed[i : i + 255, None] + STEPS
        derived = x[:, 1:]
        derived = (derived ^ (derived >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        derived = (derived ^ (derived >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x[:, 1:] = derived ^ (derived >> np.uint64(31))
        counts += np.add.reduce(np.unpackbits(x.view(np.uint8), axis=1), axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashed)).tobytes()


@dataclass(frozen=True)
class Segments:
    """Segments of wide fingerprints for so many different texts and pairs of a similarity (of sets) or more.

    The bits of two texts differ with a chance of angle / pi, whose cosine is 2 s / (1 + s) at a similarity of s. bits grows with the logarithm of the texts, so that few
    meet by chance; number is what makes a pair of that similarity share no segment with a chance of MISSED. Bits are drawn by whole permutations of the fingerprint.
    """

    bits: int
    number: int
    differ: float

    @classmethod
    def of(cls, texts: int, similarity: float) -> Segments:
        differ = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
        bits = min(32, max(LEAST_BITS, math.ceil(math.log2(max(1, texts) / BY_CHANCE))))
        both = (1 - differ) ** bits
        return cls(bits, 1 if both == 1 else math.ceil(math.log(MISSED) / math.log1p(-both)), differ)

    def radius(self, of: int, deviations: float) -> int:
        """Differing bits of so many that so many standard deviations above the mean are within."""
        return math.floor(of * self.differ + deviations * math.sqrt(of * self.differ * (1 - self.differ)))

    def places(self) -> np.ndarray:
        """The bits of each segment."""
        rng, each = np.random.default_rng(SEED), WIDE // self.bits
        drawn = [rng.permutation(WIDE)[: each * self.bits].reshape(each, self.bits) for _ in range(-(-self.number // each))]
        return np.concatenate(drawn)[: self.number]

    def values(self, prints: np.ndarray) -> np.ndarray:
        """The segments' values (one row a fingerprint, one column a segment), told apart by the segment's number above the lower 32 bits. prints: fingerprints as bytes, one a row."""
        found = np.unpackbits(prints, axis=1)[:, self.places()]
        packed = np.packbits(np.pad(found, ((0, 0), (0, 0), (32 - self.bits, 0))), axis=2).view(">u4")[:, :, 0]
        return packed.astype(np.int64) + (np.arange(self.number, dtype=np.int64) << 32)


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text") -> DataFrame:
    """Adds `simhash` (long) to docs. Null or blank texts get 0; texts shorter than a shingle count as one shingle.

    Every row gets its own value, repeated rows the same. A column of that name is replaced.
    """
    kept = [c for c in docs.columns if c != "simhash"]
    inner = pick(docs, *kept).toDF(*[f"c{i}" for i in range(len(kept))]).withColumn("raw", F.col(f"c{kept.index(text)}").cast("binary"))
    schema = T.StructType([*inner.schema.fields[:-1], T.StructField("simhash", T.LongType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes | None, int] = {}
            out = [seen[t] if t in seen else seen.setdefault(t, fingerprint(t, shingle)) for t in batch.column("raw").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.int64())], [*batch.schema.names[:-1], "simhash"])

    return inner.mapInArrow(tidied(each), schema).toDF(*kept, "simhash")


def halves(fp: Column) -> Column:
    """Both halves as numbers that don't overlap."""
    return F.array(F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(0xFFFFFFFF)) + F.lit(1 << 32))


def links(prints: DataFrame) -> DataFrame:
    """Edges a, b between distinct fingerprints (column simhash) that join the same groups as all pairs within RADIUS do."""
    fps = prints.select("simhash").where("simhash is not null").distinct()
    table = fps.select(F.explode(halves(F.col("simhash"))).alias("half"), F.col("simhash").alias("b"))
    # Of two halves that differ in one bit, just one has an even number of ones: only that one need look for the other.
    flips = F.array(*[F.lit(1 << i).cast("long") for i in range(32)])
    around = F.when(F.bit_count(F.col("half")) % 2 == 0, F.concat(F.array("half"), F.transform(flips, lambda m: F.col("half").bitwiseXOR(m)))).otherwise(F.array("half"))
    probes = table.select(F.explode(around).alias("half"), F.col("b").alias("a"))
    crowded = cut(table.groupBy(F.col("half").alias("full")).agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).withColumn("crowded", F.lit(True)))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    if crowded.isEmpty():
        return probes.join(table, "half").where(near & (F.col("a") != F.col("b"))).select("a", "b")
    probed = looked_up(probes, "half", crowded, "full", "n")
    pairs = probed.where("crowded is null").join(table, "half").where(near & (F.col("a") != F.col("b"))).select("a", "b")
    met = probed.where("crowded").select("a").union(looked_up(table, "half", crowded, "full", "n").where("crowded").select("b")).distinct()
    point = F.array(*[F.lit(0).cast("long")], *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    points = met.select("a", F.explode(F.transform(point, lambda m: F.col("a").bitwiseXOR(m))).alias("point"))
    # At most 65 fingerprints lie within a bit of a point: the set is bounded.
    shared = points.groupBy("point").agg(F.collect_set("a").alias("all")).where(F.size("all") > 1)
    return pairs.union(shared.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b"))


def groups(prints: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per distinct fingerprint: simhash, root (a fingerprint that names the group), component_id (its smallest id), n (rows).

    prints: columns doc_id and simhash. Ids that are null don't count for component_id; a group of only such has null.
    """
    fps = cut(pick(prints, "simhash", doc_id).where("simhash is not null").groupBy("simhash").agg(F.min(doc_id).alias("least_id"), F.count("*").alias("n")))
    roots = connected(links(fps))
    fps = cut(fps.join(roots, fps.simhash == roots.node, "left").select("simhash", F.coalesce("root", "simhash").alias("root"), "least_id", "n"))
    named = cut(fps.groupBy(F.col("root").alias("name")).agg(F.min("least_id").alias("component_id"), F.count("*").alias("size")))
    return looked_up(fps, "root", named, "name", "size").select("simhash", "root", "component_id", "n")


def near_duplicates(docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 lower-case hex digits), component_id.

    Null and blank texts have fingerprint zero and link as any other. Repeated rows stay, each with the same group.
    An empty table gives an empty result; further columns are ignored.
    """
    prints = cut(fingerprints(pick(docs, doc_id, text), shingle, text).select(doc_id, "simhash"))
    known = cut(groups(prints, doc_id).select(F.col("simhash").alias("fp"), "component_id", "n"))
    return looked_up(prints, "simhash", known, "fp", "n").select(doc_id, F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Keeps one row of each group: that with the smallest id, of repeated ids the smallest row; a null id only if all are null.

    Columns are those of docs.
    """
    names = list(docs.columns)
    own = [f"c{i}" for i in range(len(names))]
    rows = docs.toDF(*own)
    ident, body = own[names.index(doc_id)], own[names.index(text)]
    mark = F.xxhash64(body)
    prints = cut(fingerprints(rows.select(F.col(ident).alias("id"), mark.alias("mark"), body), shingle, body).drop(body))
    known = cut(groups(prints, "id").select(F.col("simhash").alias("fp"), "root", "n"))
    return keep_first(rows, ident, mark, looked_up(prints, "simhash", known, "fp", "n").select("id", "mark", "root")).toDF(*names)
