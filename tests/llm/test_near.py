"""Near-duplicates against all pairs by brute force."""

import random

import numpy as np

import corpus_pipeline as pipeline
from demandloom.llm import near, simhash

from .test_operators import SCHEMA, rows


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def kept(made):
    """The ids that stay of rows (id, text): the least of each group."""
    sets, root = [shingles(t) for _, t in made], list(range(len(made)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(made):
        groups.setdefault(find(i), []).append(d)
    return sorted(min((d for d in g if d is not None), default=-1) for g in groups.values())


def corpus():
    """Texts, near copies of 0.8 to 1 and a little less, chains of copies, a crowd of near copies of one text, and a passage that many share."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    out, passage = [], [word() for _ in range(200)]
    crowd = [word() for _ in range(300)]
    for _ in range(60):
        base = [word() for _ in range(rng.randrange(60, 400))]
        copy = list(base)
        for _ in range(rng.randrange(1, 1 + len(base) // 30)):
            copy[rng.randrange(len(copy))] = word()
        again = list(copy)
        for _ in range(rng.randrange(1, 1 + len(base) // 40)):
            again[rng.randrange(len(again))] = word()
        out += [base, copy, again]
    for _ in range(80):
        copy = list(crowd)
        for _ in range(rng.randrange(1, 9)):
            copy[rng.randrange(len(copy))] = word()
        out.append(copy)
        out.append(passage + [word() for _ in range(rng.randrange(20, 60))])
    rng.shuffle(out)
    return list(enumerate(" ".join(t) for t in out))


def test_near_copies_as_by_all_pairs(spark, monkeypatch):
    made = corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in made], SCHEMA).repartition(3)
    want = kept(made)
    out = near.deduplicate(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == want
    assert sorted(r.doc_id for r in pipeline.near_dedup(spark, docs, "").collect()) == want
    monkeypatch.setattr(near, "CROWDED", 2)
    assert sorted(r.doc_id for r in near.deduplicate(docs).collect()) == want


def test_nulls_blanks_and_repeated_rows(spark):
    made = [(r[0], r[1]) for r in rows()]
    out = near.deduplicate(spark.createDataFrame(rows(), SCHEMA).repartition(3))
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in out.collect()) == kept_with_blanks(made)
    assert near.deduplicate(spark.createDataFrame([], SCHEMA)).count() == 0


def kept_with_blanks(made):
    """As kept; blank texts are alike."""
    blank = [d for d, t in made if not shingles(t)]
    return sorted(kept([x for x in made if shingles(x[1])]) + [min(blank)])


def test_overlaps_as_by_sets():
    """Hashes that many sets hold and others, empty sets, a block with itself and with another."""
    rng = np.random.default_rng(2)
    made = [[np.unique(rng.integers(0, most, rng.integers(0, 60))) for _ in range(70)] for most in (40, 3000)]
    made[0] += [np.empty(0, np.int64), made[1][0]]
    for a in made:
        for b in made:
            got = near.overlaps(np.concatenate(a), np.array([len(x) for x in a]), np.concatenate(b), np.array([len(x) for x in b]))
            assert got.tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]


def test_sketches_tell_pairs_apart(spark):
    """Four bits of a minimum agree for all alike sets, and for few of those that share half of what they hold."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        shared, own = (450, 50) if i % 2 else (200, 200)  # similarities of 0.818 and a third
        common = rng.integers(0, 1 << 63, shared, dtype=np.uint64)
        a, b = (np.unique(np.r_[common, rng.integers(0, 1 << 63, own, dtype=np.uint64)]) for _ in range(2))
        rows.append((i, near.keys(a)[1], near.keys(b)[1], int((near.minima(a) == near.minima(b)).sum())))
    df = spark.createDataFrame(rows, "i long, x array<long>, y array<long>, same int")
    got = df.select("i", "same", near.agreeing("x", "y").alias("n")).collect()
    assert all(r.n >= r.same for r in got) and all(r.n >= near.AGREE for r in got if r.i % 2)
    assert sum(r.n >= near.AGREE for r in got if r.i % 2 == 0) <= 4


def test_candidates_share_a_segment_of_wide_fingerprints(spark):
    """Candidates come by segments of SimHash fingerprints: alike pairs all, of unrelated texts few; crowded segments give members instead of pairs, wherever batches end."""
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(600):  # similarities of 0.8
        common = rng.integers(0, 1 << 63, 160, dtype=np.uint64)
        sets += [np.unique(np.r_[common, rng.integers(0, 1 << 63, 20, dtype=np.uint64)]) for _ in range(2)]
    prints = [simhash.wide(s) for s in sets]
    # The first 64 bits are those of operator 1's fingerprint of different shingles.
    text = b"a b c d e f g h i j"
    assert simhash.wide(near.shingles(text, 3))[:8][::-1] == simhash.fingerprint(text, 3).to_bytes(8, "big", signed=True)
    df = spark.createDataFrame([(i, 180, p) for i, p in enumerate(prints)], "node long, size long, print binary").repartition(3)
    segments = simhash.Segments.of(len(sets), 0.8)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = near.met(df, segments, 0.8).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    values, groups = segments.values(np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1)), {}
    for i, row in enumerate(values.tolist()):
        for v in row:
            groups.setdefault(v, []).append(i)
    crowded = {(v, i) for v, g in groups.items() if len(g) > near.CROWDED for i in g}
    assert {(r.key, r.a) for r in found if r.key is not None} == crowded and sum(r.key is not None for r in found) == len(crowded)
    pairs = {(r.a, r.b) for r in found if r.key is None}
    alike = {(i, i + 1) for i in range(0, len(sets), 2)}
    assert alike <= pairs and len(pairs - alike) < 0.05 * len(sets) ** 2 / 2
    assert all(set(values[a]) & set(values[b]) for a, b in pairs)


def test_a_crowd_keeps_pairs_of_just_the_similarity(spark, monkeypatch):
    """196 of 245 shingles: in single precision 196 * 1.8 was less than 0.8 * 441."""
    monkeypatch.setattr(near, "CROWDED", 1)
    shared = [f"s{i}" for i in range(200)]
    texts = [" ".join([*shared, *(f"{c}{i}" for i in range(n))]) for c, n in (("x", 20), ("y", 29))]
    nodes = spark.createDataFrame([(1, i, i, len(near.shingles(t.encode(), 5))) for i, t in enumerate(texts)], "key long, node long, root long, size long")
    bodies = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "node long, body binary")
    assert sorted(r["size"] for r in nodes.collect()) == [216, 225]
    assert [(r.a, r.b) for r in near.crowded_edges(nodes, bodies, 5, 0.8).collect()] == [(0, 1)]


def test_whole_sets_compared_grow_with_the_texts_of_a_group(spark, monkeypatch):
    """Texts that are nearly alike, most pairs of which share a segment and few of which have the similarity: what is compared whole is no pair of each two of them."""
    rng, asked, plain = random.Random(5), [], near.whole_sets
    base = [f"w{i}" for i in range(150)]

    def counted(nodes, texts, shingle):
        asked.append(nodes.count())
        return plain(nodes, texts, shingle)

    monkeypatch.setattr(near, "whole_sets", counted)
    made = []
    for i in range(160):
        copy = list(base)
        for at in rng.sample(range(150), rng.randrange(1, 6)):
            copy[at] = f"x{rng.randrange(10**6)}"
        made.append((i, " ".join(copy)))
    want = kept(made)
    assert 1 < len(want) < 150
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in made], SCHEMA).repartition(3)
    assert sorted(r.doc_id for r in near.deduplicate(docs).collect()) == want
    assert sum(asked) <= 40 * len(made)
