"""Exact removal of repeated word windows.

A window is `window` consecutive words. Of the m-word sequences in a window the one with the least hash is its minimiser;
consecutive windows that share one occurrence of it (a super-k-mer) travel as one string of words to the bucket of its
hash, where sorting counts windows. Equal windows have the same minimiser and so meet in one bucket.

1. Count super-k-mers by minimiser. A window can only repeat if its minimiser does; a bit map of a bounded size says of each
   minimiser whether it may repeat. Very frequent minimisers, marked in a second map, would crowd a bucket: their windows
   travel one by one, to the bucket of the window's own hash. A minimiser that shares a crowded one's bit goes the same way.
2. Ship the strings whose minimiser may repeat, equal ones of a few megabytes once with their number; count windows bucket by
   bucket; keep for each string, under a 128-bit key, the words that repeated windows cover.
3. Find the same strings in the documents again, now with place but without text, and join the covers to them.
4. Join each text with the spans found in it and cut them out.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, looked_up, pick, sliced, small_batches, tidied

WINDOW = 35
#: Words of a minimiser.
MINIMISER = 8
#: Bits of the map of repeated minimisers: sixteen for each, within these limits (at most 64 MB); a fuller map only ships more.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29
#: Super-k-mers from which a minimiser is crowded.
CROWDED = 3000
#: Bytes of strings that a bucket task sorts at once; it cuts between buckets only.
CHUNK_BYTES = 1 << 20
#: Spans of a text that many rows have, up to which they are broadcast.
MOST_SENT = 10_000
#: Bytes of text whose windows are found at once.
TOGETHER = 1 << 19
#: Texts, and bytes of strings to ship, that a task holds at once.
TEXTS, PACKED = 1000, 1 << 22

A = 0x9E3779B97F4A7C15  # odd, so that no power of it vanishes modulo 2**64


def rolled(hashed: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every run of `width` numbers, modulo 2**64, by doubling."""
    out, done, power, step = None, 0, hashed, 1
    left = width
    while left:
        if left & 1:
            if out is None:
                out, done = power, step
            else:
                n = len(hashed) - done - step + 1
                out = out[:n] * np.uint64(pow(A, step, 1 << 64)) + power[done : done + n]
                done += step
        left >>= 1
        if left:
            n = len(hashed) - 2 * step + 1
            power = power[:n] * np.uint64(pow(A, step, 1 << 64)) + power[step : step + n]
            step *= 2
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A number for each byte, and powers of A and of its inverse, for hashes of stretches of bytes out of running sums.
BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
INVERSE = pow(A, -1, 1 << 64)


POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of a number from the first on; a worker keeps as many as its longest chunk needed."""
    if base not in POWERS or len(POWERS[base]) < n:
        POWERS[base] = np.cumprod(np.full(-(-n // TOGETHER) * TOGETHER, base, np.uint64))
    return POWERS[base][:n]


@dataclass
class Chunk:
    """Texts with single spaces between words, one after the other; words as stretches of bytes, with their text and hash."""

    blob: bytes
    begin: np.ndarray
    end: np.ndarray
    owner: np.ndarray
    first: np.ndarray
    hashed: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Chunk:
        """texts: not blank, words joined by one space."""
        blob = b" ".join(texts)
        raw = np.frombuffer(blob, np.uint8)
        gaps = np.flatnonzero(raw == 32)
        begin, end = np.r_[0, gaps + 1], np.r_[gaps, len(raw)]
        counts = np.array([t.count(b" ") + 1 for t in texts], np.int64)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTES[raw] * powers(A, len(raw)), out=sums[1:])
        hashed = mixed((sums[end] - sums[begin]) * powers(INVERSE, len(raw) + 1)[begin])
        return cls(blob, begin, end, np.repeat(np.arange(len(texts)), counts), np.cumsum(counts) - counts, hashed)

    def windows(self, window: int) -> np.ndarray:
        """First words of the windows that lie within one text."""
        n = len(self.owner) - window + 1
        return np.flatnonzero(self.owner[:n] == self.owner[window - 1 :]) if n > 0 else np.empty(0, np.int64)

    def cut(self, first: int, last: int) -> bytes:
        return self.blob[self.begin[first] : self.end[last]]

    def super_kmers(self, window: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, number of windows and minimiser of each super-k-mer."""
        inside = self.windows(window)
        if not len(inside):
            return inside, inside, np.empty(0, np.uint64)
        grams = mixed(rolled(self.hashed, m))
        # The upper half orders, the place breaks ties: the same way in equal windows.
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        width, step = window - m + 1, 1
        while 2 * step <= width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if rest := width - step:
            least = np.minimum(least[:-rest], least[rest:])
        place = (least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (np.diff(inside) > 1)])
        return inside[new], np.diff(np.r_[new, len(inside)]), grams[place[new]]


def chunks(raw: list[bytes | None]) -> Iterator[tuple[list[bytes], Chunk]]:
    """The texts that have words, as they are and as chunks of about TOGETHER bytes."""
    held, clean, size = [], [], 0
    for t in raw:
        if t and (c := b" ".join(t.split())):
            held.append(t), clean.append(c)
            size += len(c)
            if size > TOGETHER:
                yield held, Chunk.of(clean)
                held, clean, size = [], [], 0
    if held:
        yield held, Chunk.of(clean)


def _minimisers(window: int, m: int):  # noqa: ANN202
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, TEXTS):
            found = [chunk.super_kmers(window, m)[2] for _, chunk in chunks(batch.column(0).to_pylist())]
            value, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))], ["minimiser", "n"])

    return each


def marked(bits: np.ndarray, value: np.ndarray) -> np.ndarray:
    """If the map has each value's bit."""
    slot = value & np.uint64(len(bits) * 8 - 1)
    return ((bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)


def strings(chunk: Chunk, window: int, m: int, bits: np.ndarray, crowded: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """First word, bucket and string of what may repeat."""
    first, n, value = chunk.super_kmers(window, m)
    maybe = np.flatnonzero(marked(bits, value))
    first, n, value = first[maybe], n[maybe], value[maybe]
    edges = chunk.begin[first].tolist(), chunk.end[first + n + window - 2].tolist()
    for at, k, v, alone, a, b in zip(first.tolist(), n.tolist(), value.view(np.int64).tolist(), marked(crowded, value).tolist(), *edges, strict=True):
        if alone:
            for i in range(at, at + k):
                s = chunk.cut(i, i + window - 1)
                yield i, xxhash.xxh64_intdigest(s) - (1 << 63), s
        else:
            yield at, v, chunk.blob[a:b]


def _packed(window: int, m: int, bits, crowded):  # noqa: ANN001, ANN202
    def made(seen: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in seen], pa.int64()), pa.array([s for _, s in seen], pa.binary()), pa.array(seen.values(), pa.int64())], ["bucket", "packed", "n"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, bytes], int] = {}
        held = 0
        for batch in sliced(batches, TEXTS):
            for _, chunk in chunks(batch.column(0).to_pylist()):
                for _, bucket, s in strings(chunk, window, m, bits.value, crowded.value):
                    n = seen.get((bucket, s), 0)
                    seen[bucket, s] = n + 1
                    held += 0 if n else len(s)
                if held > PACKED:
                    yield made(seen)
                    seen, held = {}, 0
        if seen:
            yield made(seen)

    return each


def key(packed: bytes) -> bytes:
    return xxhash.xxh3_128_digest(packed)


def covers(number: dict[bytes, int], window: int) -> Iterator[tuple[bytes, list[int]]]:
    """covered() by key."""
    return ((key(name), cover) for name, cover in covered(number, window))


def covered(number: dict[bytes, int], window: int) -> Iterator[tuple[bytes, list[int]]]:
    """number: how often each string occurs. Each string with a window that occurs twice or more, and first and end word of each covered stretch."""
    names = list(number)
    chunk = Chunk.of(names)
    place = chunk.windows(window)
    times = np.array(list(number.values()), np.int64)[chunk.owner[place]]
    value = rolled(chunk.hashed, window)[place]
    order = np.argsort(value, kind="stable")
    ranked = value[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    head, group = np.flatnonzero(new), np.cumsum(new) - 1
    twice = np.add.reduceat(times[order], head)[group] >= 2
    # Where hashes are equal the words are compared as well.
    odd: set[int] = set()
    for x in np.flatnonzero(~new).tolist():
        a, b = place[order[x]], place[order[head[group[x]]]]
        if chunk.cut(a, a + window - 1) != chunk.cut(b, b + window - 1):
            odd.add(int(group[x]))
    for g in odd:
        members = np.flatnonzero(group == g)
        cuts = [chunk.cut(place[order[x]], place[order[x]] + window - 1) for x in members]
        found: dict[bytes, int] = {}
        for x, c in zip(members, cuts, strict=True):
            found[c] = found.get(c, 0) + int(times[order[x]])
        twice[members] = [found[c] >= 2 for c in cuts]
    hit = place[np.sort(order[twice])]
    owner = chunk.owner[hit]
    for i in np.split(np.arange(len(hit)), np.flatnonzero(np.diff(owner)) + 1) if len(hit) else []:
        a = hit[i] - chunk.first[owner[i[0]]]
        edge = np.flatnonzero(np.diff(a) > window)
        yield names[owner[i[0]]], np.c_[a[np.r_[0, edge + 1]], a[np.r_[edge, len(a) - 1]] + window].ravel().tolist()


def _counted(window: int):  # noqa: ANN202
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(number: dict[bytes, int]) -> pa.RecordBatch:
            found = dict(covered(number, window))
            return pa.RecordBatch.from_arrays([pa.array(map(key, found), pa.binary()), pa.array([number[s] for s in found], pa.int64()), pa.array(found.values(), pa.list_(pa.int32()))], ["packed_key", "n", "cover"])

        number: dict[bytes, int] = {}
        held, now = 0, None
        for batch in batches:
            for bucket, packed, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if held > CHUNK_BYTES and bucket != now:
                    yield made(number)
                    number, held = {}, 0
                now = bucket
                if packed not in number:
                    held += len(packed)
                number[packed] = number.get(packed, 0) + n
        if number:
            yield made(number)

    return each


def _places(window: int, m: int, bits, crowded):  # noqa: ANN001, ANN202
    def made(text: list, times: list, start: list, keys: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(text, pa.binary()), pa.array(times, pa.int64()), pa.array(start, pa.int32()), pa.array(keys, pa.binary())], ["text_key", "times", "start", "key"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, TEXTS):
            text, times, start, keys = [], [], [], []
            number = Counter(batch.column(0).to_pylist())
            for held, chunk in chunks(list(number)):
                names, rows = [hashlib.sha256(t).digest()[:16] for t in held], [number[t] for t in held]
                owner, first = chunk.owner, chunk.first
                for at, _, s in strings(chunk, window, m, bits.value, crowded.value):
                    o = owner[at]
                    text.append(names[o]), times.append(rows[o]), start.append(at - first[o]), keys.append(key(s))
                if len(start) > 200_000:
                    yield made(text, times, start, keys)
                    text, times, start, keys = [], [], [], []
            yield made(text, times, start, keys)

    return each


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, TEXTS):
        kept, n_words, n_removed = [], [], []
        for t, spans in zip(batch.column("raw").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            found = t.split() if t else []
            n = len(found)
            for a, b in sorted(((s["a"], s["b"]) for s in spans or ()), reverse=True):
                found[a:b] = [None] * (b - a)
            found = [w for w in found if w is not None]
            kept.append(b" ".join(found)), n_words.append(n), n_removed.append(n - len(found))
        arrays = [*batch.columns[:-2], pa.array(kept, pa.binary()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-2], "kept", "n_words", "n_removed"])


def bit_map(minimisers: DataFrame, size: int) -> np.ndarray:
    """A map of so many bits (a power of two) with one set for each minimiser. Its words are made on Spark: size / 64 rows at most are collected."""
    slot = F.col("minimiser").bitwiseAND(F.lit(size - 1))
    rows = minimisers.select(slot.alias("slot")).selectExpr("slot div 64 at", "shiftleft(1L, int(slot % 64)) bit").groupBy("at").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()
    bits = np.zeros(size // 64, np.int64)
    bits[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return bits.view(np.uint8)


def repeated_spans(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, text: str = "text") -> DataFrame:
    """For each different text with a repeated window: text_key (first half of its SHA-256), spans, an array of (a, b), words a to b - 1, and n, its rows."""
    spark = docs.sparkSession
    raw = pick(docs, text).select(F.col(text).cast("binary").alias("raw")).where("octet_length(raw) >= 0")
    counts = cut(raw.mapInArrow(tidied(_minimisers(window, minimiser)), "minimiser long, n long").groupBy("minimiser").agg(F.sum("n").alias("n")).where("n > 1"))
    size = LEAST_BITS
    most = 16 * counts.count()
    while size < min(most, MOST_BITS):
        size *= 2
    sent = spark.sparkContext.broadcast
    crowd = counts.where(F.col("n") > CROWDED)
    bits, crowded = sent(bit_map(counts, size)), sent(bit_map(crowd, min(size, max(LEAST_BITS, 1 << (16 * crowd.count()).bit_length()))))

    packed = raw.mapInArrow(tidied(_packed(window, minimiser, bits, crowded)), "bucket long, packed binary, n long")
    cover = cut(packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidied(_counted(window)), "packed_key binary, n long, cover array<int>"))
    places = raw.mapInArrow(tidied(_places(window, minimiser, bits, crowded)), "text_key binary, times long, start int, key binary")
    # A string has one bucket, so one cover.
    found = looked_up(places, "key", cover, "packed_key", "n").where("cover is not null")
    texts = found.groupBy("text_key").agg(F.collect_set(F.struct("start", "cover")).alias("found"), F.sum("times").alias("times"))
    spans = F.expr("flatten(transform(found, f -> transform(sequence(0, size(f.cover) - 2, 2), i -> struct(f.start + f.cover[i] as a, f.start + f.cover[i + 1] as b))))")
    return texts.select("text_key", spans.alias("spans"), F.expr("times div size(found)").alias("n"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, text: str = "text") -> DataFrame:
    """Adds kept (the words that no repeated window covers, joined by one space), n_words, n_removed (long) to docs.

    A window is repeated if its words also start anywhere else, in the same document or another row, repeated rows included;
    windows are judged on the input. Null and blank texts have no words and an empty kept; texts shorter than a window
    keep every word. Columns of these names are replaced; an empty table gives an empty result.
    """
    names = [c for c in docs.columns if c not in ("kept", "n_words", "n_removed")]
    own = [f"c{i}" for i in range(len(names))]
    # A text of very many spans isn't broadcast, however many rows have it.
    with small_batches(docs.sparkSession, TEXTS):
        spans = cut(repeated_spans(docs, window, minimiser, text).select(F.col("text_key").alias("of"), "spans", F.when(F.size("spans") <= MOST_SENT, F.col("n")).otherwise(0).alias("n")))
    flat = pick(docs, *names).toDF(*own)
    body = own[names.index(text)]
    flat = flat.withColumn("text_key", F.unhex(F.left(F.sha2(body, 256), F.lit(32))))
    joined = looked_up(flat, "text_key", spans, "of", "n").select(*own, F.col(body).cast("binary").alias("raw"), "spans")
    schema = T.StructType([*flat.schema.fields[: len(own)], T.StructField("kept", T.BinaryType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    done = joined.mapInArrow(tidied(_kept), schema)
    return done.withColumn("kept", F.decode("kept", "UTF-8")).toDF(*names, "kept", "n_words", "n_removed")
