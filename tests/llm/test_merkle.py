"""The Merkle manifest against a tree built whole, in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from demandloom.llm import merkle, queries

from .test_operators import SCHEMA, clashing, rows


def h(x):
    return hashlib.sha256(x.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return h("".join(map(field, (doc_id, source, lang, n_chars, text))))


def tops(leaves):
    """All levels of a tree."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 8 * 8 : i // 8 * 8 + 8]
        out.append((run[: i % 8], run[i % 8 + 1 :]))
        i //= 8
    return out


def expected(made):
    trees = {}
    for r in made:
        trees.setdefault(r[2], []).append(r)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {n: tops([leaf(r) for r in sorted(trees[n], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for n in names}
    forest = tops([built[n][-1][0] for n in names])
    out = []
    for place, n in enumerate(names):
        for i, r in enumerate(sorted(trees[n], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))):
            way = siblings(built[n], i) + siblings(forest, place)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            now = leaf(r, changed)
            for left, right in way:
                now = h("".join([*left, now, *right]))
            proof = h("".join("".join([*left, *right]) for left, right in way))
            out.append((r[0], leaf(r), built[n][-1][0], forest[-1][0], proof, now, now == forest[-1][0]))
    return sorted(out, key=str)


def digested(df):
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    return sorted((tuple(r) for r in df.select("id", "leaf", "subroot", "root", F.sha2(siblings, 256), "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("langs", [["en"], ["en", "de", None, "ü", ""]])
def test_as_whole_trees(spark, langs):
    """Nulls, empty and long texts, repeated ids and rows, one tree and many, clashing columns."""
    made = [(*r[:2], langs[i % len(langs)], *r[3:]) for i, r in enumerate(rows())]
    docs = clashing(spark.createDataFrame(made, SCHEMA).repartition(3), "tree", "leaf", "id", "pos", "n", "block")
    assert digested(merkle.tampered(docs)) == expected(made)


def test_more_than_a_block_and_many_trees(spark):
    """Tiers over blocks, in one tree and in the tree of trees."""
    made = [(i, f"Text {i}", "big", "s", i) for i in range(9000)] + [(i, "X", f"lang{i:05d}", None, None) for i in range(4200)]
    docs = spark.createDataFrame(made, SCHEMA).repartition(5)
    done = merkle.tampered(docs).cache()
    assert digested(done) == expected(made)
    one = done.where("id = 8500 and tree = 'big'").first()
    # A version copies its ancestors only: one node a level.
    assert len(one.copies) == len(one.proof) == 5 + 5
    done.unpersist()


def test_single_and_empty(spark, tmp_path):
    one = [(7, "Abc", None, None, 3)]
    assert digested(merkle.tampered(spark.createDataFrame(one, SCHEMA))) == expected(one)
    assert merkle.tampered(spark.createDataFrame([], SCHEMA)).count() == 0
    spark.createDataFrame(one, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    row = queries.op12_merkle(spark, str(tmp_path)).first()
    assert row.root == row.leaf == row.subroot and row.proof_sha256 == h("") and row.n_copied == 0
