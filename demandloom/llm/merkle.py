"""A Merkle manifest of a dataset whose versions copy paths.

Rows are leaves of one tree for each value of a column; the trees' tops are leaves of one more, whose top is the dataset's digest.
RUN consecutive nodes hash to one. A tree is cut into aligned blocks of RUN^LEVELS leaves, each built in one task and kept as one row
with all its nodes; the blocks' tops are the leaves of the next tier, cut likewise, until one block is left.

A changed leaf makes a version: new nodes for its ancestors within its block, all others shared with the block's row, and then on
along the path of its block through the upper tiers. That path, the siblings of each ancestor, is computed once a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, looked_up, numbered, pick, runs, tidied

RUN, LEVELS = 8, 4
BLOCK = RUN**LEVELS
#: Versions that a task gives out together.
TOGETHER = 512
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "array<struct<left: string, right: string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above n leaves, until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes before it, so that neighbouring fields can't be taken for one another; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Digest of a row's values."""
    return F.sha2(F.concat(*map(field, values)), 256)


def built(rows: DataFrame, extra: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """tree, block, n, digests (nodes of the block's lowest level, in order), nodes (levels above them), top, and each extra column as a list.

    rows: tree (string), pos (long, gapless from 0 in a tree), n (long, nodes of the tree at this level), digest, extra columns. A block holds BLOCK rows at most.
    """
    kept = [c for c, _ in extra]
    names = ["tree", "block", "n", "digests", "nodes", "top", *kept]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block), rows in runs(batches, "tree", "block"):
            n, levels = rows.column("n")[0].as_py(), [rows.column("digest").to_pylist()]
            for _ in range(min(LEVELS, height(n))):
                below = levels[-1]
                levels.append([digest("".join(below[i : i + RUN])) for i in range(0, len(below), RUN)])
            lists = [pa.array([rows.column(c).to_pylist()], pa.list_(rows.schema.field(c).type)) for c in kept]
            own = [pa.array([tree]), pa.array([block]), pa.array([n]), pa.array([levels[0]]), pa.array([levels[1:]], pa.list_(pa.list_(pa.string()))), pa.array([levels[-1][0]])]
            yield pa.RecordBatch.from_arrays([*own, *lists], names)

    together = rows.withColumn("block", F.expr(f"pos div {BLOCK}")).repartition("tree", "block").sortWithinPartitions("tree", "block", "pos").select("tree", "block", "n", "digest", *kept)
    schema = "tree string, block long, n long, digests array<string>, nodes array<array<string>>, top string"
    return together.mapInArrow(tidied(each), ", ".join([schema, *(f"{c} array<{kind}>" for c, kind in extra)]))


def steps(levels: list[list[str]]) -> list[list[dict]]:
    """For each level of a block but its top: the siblings to the left and to the right of each node, joined."""
    out = []
    for level in levels[:-1]:
        at_level = []
        for i in range(0, len(level), RUN):
            run = level[i : i + RUN]
            at_level += [{"left": "".join(run[:k]), "right": "".join(run[k + 1 :])} for k in range(len(run))]
        out.append(at_level)
    return out


def path_of(own: list[list[dict]], i: int) -> list[dict]:
    """The siblings along the way from a block's i-th node to its top."""
    return [level[i // RUN**k] for k, level in enumerate(own)]


def version(node: str, path: list[dict]) -> list[str]:
    """The nodes that a version copies if a node changes to this: its ancestors, upwards. All other nodes stay shared."""
    copies = []
    for step in path:
        node = digest(step["left"] + node + step["right"])
        copies.append(node)
    return copies


def above(blocks: DataFrame) -> DataFrame:
    """tree, block, path (siblings from the block's top up to the tree's top), root (the tree's top), for each block of built()."""
    if (blocks.agg(F.max("n")).first()[0] or 0) <= BLOCK:
        return blocks.select("tree", "block", F.array().cast(STEP).alias("path"), F.col("top").alias("root"))
    upper = cut(built(blocks.select("tree", F.col("block").alias("pos"), F.expr(f"(n + {BLOCK} - 1) div {BLOCK}").alias("n"), F.col("top").alias("digest"))))
    return paths(upper, above(upper))


def paths(blocks: DataFrame, over: DataFrame) -> DataFrame:
    """tree, block (place of a node of these blocks' lowest level), path and root. over: what above() says of the blocks."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                own = steps([row["digests"], *row["nodes"]])
                m = len(row["digests"])
                made = [path_of(own, i) + row["path"] for i in range(m)]
                kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
                yield pa.RecordBatch.from_arrays([pa.array([row["tree"]] * m), pa.array([row["block"] * BLOCK + i for i in range(m)], pa.int64()), pa.array(made, kind), pa.array([row["root"]] * m)], ["tree", "block", "path", "root"])

    both = blocks.select("tree", "block", "digests", "nodes").join(over, ["tree", "block"])
    return cut(both.mapInArrow(tidied(each), f"tree string, block long, path {STEP}, root string"))


def manifest(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The blocks of all trees, and for each block its path to the dataset's root.

    leaves: id (long), tree (string or null), leaf, shown (a changed leaf, or null), few bytes a row. Within a tree leaves ascend by id, nulls first; repeated ids by
    their leaves; rows repeated whole are leaves each. Trees are ordered by their names' bytes, null first. The first result has the columns of built() with ids and
    shown, the second tree, block, path, subroot and root; trees are named `-` for null, else `=` and the name. Without rows both are empty.
    """
    named = leaves.select(F.coalesce(F.concat(F.lit("="), "tree"), F.lit("-")).alias("tree"), "id", "leaf", "shown")
    rows = numbered(cut(named).withColumn("alike", F.monotonically_increasing_id()), ["tree", "id", "leaf", "shown", "alike"], "at")
    trees = cut(rows.groupBy(F.col("tree").alias("of")).agg(F.min("at").alias("start"), F.count("*").alias("n"), F.count("*").alias("size")))
    placed = looked_up(rows, "tree", trees, "of", "n").select("tree", (F.col("at") - F.col("start")).alias("pos"), F.col("size").alias("n"), F.col("leaf").alias("digest"), "id", "shown")
    blocks = cut(built(placed, (("id", "long"), ("shown", "string"))))
    over = cut(above(blocks).withColumnRenamed("root", "subroot"))
    # The trees' tops are leaves of one tree more.
    tops = numbered(over.where("block = 0").select(F.col("tree").alias("name"), "subroot"), ["name"], "pos")
    forest = cut(built(tops.select(F.lit("").alias("tree"), "pos", F.lit(tops.count()).cast("long").alias("n"), F.col("subroot").alias("digest"))))
    last = paths(forest, above(forest)).select(F.col("block").alias("pos"), F.col("path").alias("last"), "root").join(tops.select("pos", "name"), "pos")
    last = cut(last.join(over.groupBy(F.col("tree").alias("name")).agg(F.count("*").alias("blocks")), "name").select("name", "last", "root", "blocks"))
    full = looked_up(over, "tree", last, "name", "blocks")
    return blocks, cut(full.select("tree", "block", F.concat("path", "last").alias("path"), "subroot", "root"))


def versions(blocks: DataFrame, over: DataFrame) -> DataFrame:
    """id, tree, leaf, subroot, root, proof (siblings of each ancestor's run to the left and the right, from the leaf up), shown, copies (the nodes that the version
    with the shown leaf, or the leaf itself, doesn't share, from its parent up to its root), folded_root, verified: one row a leaf of manifest()."""
    names = ["id", "tree", "leaf", "subroot", "root", "proof", "shown", "copies", "folded_root", "verified"]
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1).to_pylist()[0]
                own, m, tree = steps([row["digests"], *row["nodes"]]), len(row["digests"]), row["tree"]
                tree = tree[1:] if tree.startswith("=") else None
                for i in range(0, m, TOGETHER):
                    proofs, copies, folded, part = [], [], [], range(i, min(m, i + TOGETHER))
                    for j in part:
                        now = row["shown"][j] or row["digests"][j]
                        proofs.append(path_of(own, j) + row["path"])
                        copies.append(version(now, proofs[-1]))
                        folded.append(copies[-1][-1] if copies[-1] else now)
                    columns = [pa.array(row["id"][i : i + TOGETHER], pa.int64()), pa.array([tree] * len(part), pa.string()), pa.array(row["digests"][i : i + TOGETHER]), pa.array([row["subroot"]] * len(part)), pa.array([row["root"]] * len(part))]
                    columns += [pa.array(proofs, kind), pa.array(row["shown"][i : i + TOGETHER], pa.string()), pa.array(copies, pa.list_(pa.string())), pa.array(folded), pa.array([f == row["root"] for f in folded])]
                    yield pa.RecordBatch.from_arrays(columns, names)

    both = blocks.join(over.select("tree", "block", "path", "subroot", "root"), ["tree", "block"])
    return both.mapInArrow(tidied(each), f"id long, tree string, leaf string, subroot string, root string, proof {STEP}, shown string, copies array<string>, folded_root string, verified boolean")


def tampered(docs: DataFrame, share: int = 3) -> DataFrame:
    """versions() of documents, a tree a language, of which those are shown with their text's A-Z in lower case whose id's CRC-32 `share` divides.

    Null values count as `-`, empty texts as texts of no bytes; a null id is never tampered with, nor is a null text changed by it. Ties, repeated rows and empty tables as in
    manifest(). Further columns, of any name, are passed over.
    """
    rows = pick(docs, *COLUMNS)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = leaf(*[F.translate(c, upper, upper.lower()) if c == "text" else F.col(c) for c in COLUMNS])
    hit = F.crc32(F.col("doc_id").cast("string")) % share == 0
    return versions(*manifest(rows.select(F.col("doc_id").cast("long").alias("id"), F.col("lang").alias("tree"), leaf(*map(F.col, COLUMNS)).alias("leaf"), F.when(hit, changed).alias("shown"))))
