"""Token ids of whole texts, and the exact histogram of encoded lengths."""

from __future__ import annotations

import functools
import json
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from .common import CACHES, cut, pick, sliced, tidied

#: A tokenizer that drops white space and splits at it, so that words can be encoded one by one.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Its normalizer and pre-tokenizer: after them letters, a number's digits and other signs are parts of their own, in lower case and as bytes.
NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
LETTERS, SIGNS, BLANK = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", "[.,;:!?|#$%&*]", "[ \\t\\n\\r]"
#: All signs of ASCII but those that contractions and special tokens begin with.
ALL_SIGNS = "!-&(-/:;=-@\\[-`{-~"
#: Texts of other characters than these are taken word by word, others part by part.
OTHER = re.compile(f"[^{LETTERS}0-9{ALL_SIGNS} \\t\\n\\r]")
PLAIN = re.compile(f"[{LETTERS}]+|[0-9]|[{ALL_SIGNS}]+")
#: Words of letters, and signs after such up to the word's end, as parts of their own; any other word whole. None of these signs joins with letters.
PARTS = re.compile(f"(?<![^ \\t\\n\\r])[{LETTERS}]+(?={SIGNS}*(?:{BLANK}|\\Z))|(?<=[{LETTERS}]){SIGNS}+(?={BLANK}|\\Z)|[^ \\t\\n\\r]+")
#: Parts whose ids a worker remembers at once: twice this number at most, the latest among them.
REMEMBERED = 300_000
#: Texts after which it is looked how many those are.
TOGETHER = 64
#: Texts that a task takes at once, and bytes of ids that it gives at once.
TEXTS, PIECES = 1000, 1 << 22


class Remembered(dict):
    """What `made` gives for each key; the latest entries are kept, in two generations."""

    def __init__(self, made: Callable[[str], bytes]) -> None:
        self.made, self.before = made, {}

    def __missing__(self, key: str) -> bytes:
        found = self.before.get(key)
        self[key] = found = self.made(key) if found is None else found
        return found

    def age(self) -> None:
        if len(self) > REMEMBERED:
            self.before = dict(self)
            self.clear()


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers.

    For a tokenizer of the known normalizer and pre-tokenizer that ends words with a mark, each distinct part is encoded once
    while it is remembered, plain ones by its model alone; other tokenizers get whole texts.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        rules = [json.loads(x.__getstate__()) if x else {} for x in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        known = (rules[0].get("normalizers"), rules[1].get("pretokenizers")) == (NORMAL, [SPLIT, BYTES])
        self.by_word = known and getattr(self.model, "end_of_word_suffix", None) == "</w>" and all("<" in t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {i: level.pre_tokenize_str(chr(i))[0][0] for i in range(0xDF, 0x100)}
        self.known = Remembered(self.part)

    def each(self, texts: list[str]) -> list[bytes]:
        """Ids of each text on its own."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def part(self, part: str) -> bytes:
        """Ids of a part; the normalizer only lowers plain ones, and the pre-tokenizer leaves them whole."""
        if not PLAIN.fullmatch(part):
            return self.each([part])[0]
        lower = part.lower()
        ids = [t.id for t in self.model.tokenize(lower if lower.isascii() else lower.translate(self.as_bytes))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        if not self.by_word:
            yield from self.each([t or "" for t in texts])
            return
        get = self.known.__getitem__
        for at, t in enumerate(texts):
            if not at % TOGETHER:
                self.known.age()
            yield b"".join(map(get, PARTS.findall(t) if OTHER.search(t) else PLAIN.findall(t.lower()))) if t else b""


@functools.cache
def encoder(path: str) -> Encoder:
    """A worker's encoder, kept from task to task."""
    return Encoder(path)


CACHES["encoder"] = encoder


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, longest: int = 2048, end_id: int = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The token ids of every document, cut into pieces of at most `longest`: doc_id, piece, start, length, ids (binary, little-endian unsigned 32-bit).

    A document's ids end with end_id. A null text is empty, so its one piece holds only end_id. Repeated rows give repeated
    pieces; an empty table gives none; further columns are ignored. tokenizer: a file of the library `tokenizers` whose
    pre-tokenizer drops white space.
    """
    end = np.array([end_id], "<u4").tobytes()
    source = pick(docs, doc_id, text).toDF("doc_id", "text")
    kind = dict(source.dtypes)["doc_id"]
    most = 4 * longest

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in sliced(batches, TEXTS):
            rows, number, start, length, ids, held = [], [], [], [], [], 0
            for row, own in enumerate(encode(batch.column("text").to_pylist())):
                own += end  # noqa: PLW2901
                for k, at in enumerate(range(0, len(own), most)):
                    part = own[at : at + most]
                    rows.append(row), number.append(k), start.append(at // 4), length.append(len(part) // 4), ids.append(part)
                    held += len(part)
                if held > PIECES:
                    yield made(batch, rows, number, start, length, ids)
                    rows, number, start, length, ids, held = [], [], [], [], [], 0
            yield made(batch, rows, number, start, length, ids)

    def made(batch: pa.RecordBatch, rows: list, number: list, start: list, length: list, ids: list) -> pa.RecordBatch:
        arrays = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids"])

    return source.mapInArrow(tidied(each, "encoder"), f"doc_id {kind}, piece int, start long, length long, ids binary")


def lengths(docs: DataFrame, tokenizer: str = TOKENIZER, text: str = "text") -> DataFrame:
    """One row per document: n_tokens (long), without any end id; null texts have none."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in sliced(batches, TEXTS):
            yield pa.RecordBatch.from_arrays([pa.array([len(ids) // 4 for ids in encode(batch.column("text").to_pylist())], pa.int64())], ["n_tokens"])

    return pick(docs, text).toDF("text").mapInArrow(tidied(each, "encoder"), "n_tokens long")


#: Lengths that share their upper digits are summed first, so that no task needs all distinct lengths in order.
BLOCK = 128


def length_histogram(docs: DataFrame, tokenizer: str = TOKENIZER, text: str = "text") -> DataFrame:
    """The exact histogram of encoded lengths with its suffix sums, one row per distinct length.

    n_tokens; n_docs, tokens (of that length); docs_from, tokens_from (of that length or longer); total_docs,
    total_tokens; tokens_within (in documents no longer than it); truncated_tokens (all documents cut to that length).
    Answers: a quantile q is the smallest n_tokens with total_docs - docs_from + n_docs >= q * total_docs; for a context
    limit c between two lengths the truncated total is tokens_within of the one below plus c * docs_from of the one above.
    Null and empty texts have length 0; an empty table gives no rows.
    """
    # Two ways lead on from here: written once, or all texts would be encoded twice.
    counted = cut(lengths(docs, tokenizer, text).groupBy("n_tokens").agg(F.count("*").alias("n_docs")))
    counted = counted.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")).withColumn("block", F.expr(f"n_tokens div {BLOCK}"))
    # Blocks have at most BLOCK lengths each, and there are as many as the longest text has tokens over BLOCK.
    blocks = counted.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    blocks = blocks.selectExpr("block", "sum(d) over (order by block desc rows between unbounded preceding and 1 preceding) d_after", "sum(t) over (order by block desc rows between unbounded preceding and 1 preceding) t_after", "sum(d) over () total_docs", "sum(t) over () total_tokens")
    own = "over (partition by block order by n_tokens desc)"
    summed = counted.join(blocks, "block").selectExpr(
        "n_tokens", "n_docs", "tokens", f"coalesce(d_after, 0) + sum(n_docs) {own} docs_from", f"coalesce(t_after, 0) + sum(tokens) {own} tokens_from", "total_docs", "total_tokens"
    )
    return summed.selectExpr("*", "total_tokens - tokens_from + tokens tokens_within", "total_tokens - tokens_from + n_tokens * docs_from truncated_tokens")


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row: truncated_tokens, what all documents hold when cut to `limit` tokens; null without documents."""
    return histogram.agg(F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")).alias("truncated_tokens"))


def quantiles(histogram: DataFrame, at: list[float]) -> DataFrame:
    """Exact lower quantiles of the lengths: q, n_tokens; no rows without documents."""
    asked = histogram.sparkSession.createDataFrame([(float(q),) for q in at], "q double")
    ranked = histogram.withColumn("rank", F.col("total_docs") - F.col("docs_from") + F.col("n_docs"))
    return ranked.join(F.broadcast(asked), F.col("rank") >= F.col("q") * F.col("total_docs")).groupBy("q").agg(F.min("n_tokens").alias("n_tokens"))
