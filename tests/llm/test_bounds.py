"""Hot keys, sizes beyond earlier bounds, and the classifier chain against a plain version."""

import random
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from demandloom.llm import common, mixing, packing, quality, search, sharding, simhash, substrings, toxicity, warc

from .test_operators import SCHEMA, check_packing, removed

WORDS = [f"w{i}" for i in range(300)]


def hot_rows():
    """Two thirds of the rows are one text, source and null id; others differ."""
    rng = random.Random(9)
    text = " ".join(rng.choice(WORDS) for _ in range(60))
    return [(None, text, "en", "hot", 1) for _ in range(60)] + [(i, " ".join(rng.choice(WORDS) for _ in range(50)), "en", f"s{i % 3}", i) for i in range(30)]


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(hot_rows(), SCHEMA).repartition(5)


@pytest.mark.parametrize("share", [1000, 0])
def test_looked_up_by_broadcast_and_by_shuffle(spark, monkeypatch, share):
    monkeypatch.setattr(common, "HOT", share)
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else f"k{i % 3}") for i in range(200)], "i int, key string")
    table = spark.createDataFrame([("k0", 53, "a"), ("k1", 53, None), ("other", 1, "z")], "of string, n long, value string")
    got = {r.i: r.value for r in common.looked_up(rows, "key", table, "of", "n").collect()}
    assert got == {i: "a" if i % 5 and i % 3 == 0 else None for i in range(200)}


def test_one_text_source_and_null_id_throughout(spark, hot, monkeypatch):
    assert Counter(r.n_removed for r in substrings.remove_repeats(hot).where("doc_id is null").collect()) == {60: 60}
    out = sharding.shard(hot).collect()
    assert sorted(r.row_number for r in out) == list(range(90))
    groups = Counter(r.component_id for r in simhash.near_duplicates(hot).collect())
    assert groups[None] == 60
    assert simhash.deduplicate(hot).where("doc_id is null").count() == 1
    weights = mixing.temperature_weights(hot)
    want = Counter(map(tuple, mixing.mix(hot, weights).select("doc_id", "copy", "n_copies").collect()))
    monkeypatch.setattr(mixing, "FEW", 0)
    assert Counter(map(tuple, mixing.mix(hot, weights).select("doc_id", "copy", "n_copies").collect())) == want


def test_quality_counts_by_broadcast_and_by_shuffle(spark, hot, monkeypatch):
    trusted = spark.createDataFrame([(i,) for i in (1, 2, 3, 3, None)], "doc_id long")
    want = quality.log_ratios(hot, trusted, 40)
    monkeypatch.setattr(common, "FEW", 0)
    assert quality.log_ratios(hot, trusted, 40) == want


def test_warc_of_one_payload(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "x" * 2000 if i % 3 else "") for i in range(90)], "page_id long, url string, html string").repartition(7)
    out = warc.read(spark, warc.write(pages, str(tmp_path / "w"))).collect()
    assert Counter((r.record_type, r.refers_to, r.payload_bytes) for r in out) == {("response", None, 0): 30, ("response", None, 2000): 1, ("revisit", 89, 2000): 59}


def test_packing_goes_on_for_as_many_rounds_as_it_takes(spark):
    """Sizes of just over a third leave a gap in every partition; sixty partitions need more rounds than six."""
    rng = random.Random(3)
    sizes = [rng.choice((34, 35, 45, 55)) for _ in range(1200)]
    out = packing.pack(spark.createDataFrame(list(enumerate(sizes)), "id long, length long"), 100, per_task=20).collect()
    assert sorted((r.id, r.length) for r in out) == list(enumerate(sizes))
    assert len({r.sequence_id >> 56 for r in out}) > 1
    whole = len(packing.best_fit(np.sort(np.array(sizes))[::-1], 100)[2])
    assert check_packing(out, 100) <= 1.03 * whole


def test_every_minimiser_crowded(spark, monkeypatch):
    """All windows travel one by one: as many crowded minimisers as there are."""
    monkeypatch.setattr(substrings, "CROWDED", 1)
    rng = random.Random(2)
    passages = [" ".join(rng.choice(WORDS) for _ in range(40)) for _ in range(30)]
    texts = [f"a{i} {passages[i % 30]} b{i}" for i in range(90)]
    out = substrings.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 8, 3)
    assert Counter((r.n_words, r.n_removed, r.kept) for r in out.collect()) == Counter(removed(texts, 8))


def test_search_with_a_dominating_vector_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 64)
    monkeypatch.setattr(search, "QUERIES", 16)
    rng = np.random.default_rng(5)
    data = [(i, [int(x) for x in (rng.integers(-50, 50, 6) if i % 3 else [40, -3, 7, 0, 1, 2])]) for i in range(600)]
    v = spark.createDataFrame(data, "vec_id long, v array<long>").repartition(40)
    got = defaultdict(list)
    for r in search.top_k(v.where("vec_id % 50 = 0"), v, 7).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    m = np.array([x for _, x in data])
    for q in range(0, 600, 50):
        s = m @ m[q]
        order = [i for i in np.lexsort((np.arange(600), -s)).tolist() if i != q][:7]
        assert sorted(got[q]) == [(k + 1, i, int(s[i])) for k, i in enumerate(order)]


def test_scores_beyond_exact_doubles(spark):
    big = 1 << 31
    data = [(1, [big, 1]), (2, [big, 2]), (3, [big, 3]), (4, [1 << 62, 1 << 62]), (5, [-(1 << 62), 5])]
    v = spark.createDataFrame(data, "vec_id long, v array<long>")
    got = {(r.query_id, r.vec_id): r.score for r in search.top_k(v, v).collect()}
    exact = lambda a, b: max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b, strict=True))))
    assert got == {(i, j): exact(a, b) for i, a in data for j, b in data if i != j}


def plain_chain(texts, labels, categories=2):
    """The chain on dense matrices: probabilities of texts after training on all of them, penalties as the operator chose them."""
    terms = toxicity.Terms()
    x = np.zeros((len(texts), toxicity.FEATURES), bool)
    for i, t in enumerate(texts):
        x[i, terms.of(t)] = True
    fold = np.array([toxicity.xxhash.xxh32_intdigest(str(i)) % toxicity.FOLDS for i in range(len(texts))])

    def fitted(rows, before, y, penalty):
        used = np.flatnonzero(x[rows].sum(axis=0) >= toxicity.LEAST_DOCS)
        a = np.c_[x[rows][:, used], np.log(np.clip(before[rows], 1e-4, 1 - 1e-4) / (1 - np.clip(before[rows], 1e-4, 1 - 1e-4))), np.ones(len(rows))]
        w, m, v = (np.zeros(a.shape[1]) for _ in range(3))
        share = y[rows].mean()
        for step in range(1, toxicity.STEPS + 1):
            g = a.T @ (np.where(y[rows] > 0, 0.5 / share, 0.5 / (1 - share)) * (1 / (1 + np.exp(-np.clip(a @ w, -30, 30))) - y[rows])) / len(rows)
            g[: len(used)] += penalty * w[: len(used)]
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g**2
            w = w - toxicity.RATE * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return used, w

    def applied(model, rows, before):
        used, w = model
        q = np.clip(before[rows], 1e-4, 1 - 1e-4)
        return 1 / (1 + np.exp(-np.clip(np.c_[x[rows][:, used], np.log(q / (1 - q)), np.ones(len(rows))] @ w, -30, 30)))

    seen, out = np.empty((len(texts), 0)), np.empty((len(texts), 0))
    for c in range(categories):
        y, tried = labels[:, c].astype(float), []
        for penalty in toxicity.PENALTIES:
            p = np.empty(len(texts))
            for f in range(toxicity.FOLDS):
                inside, outside = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
                p[inside] = applied(fitted(outside, seen, y, penalty), inside, seen)
            q = np.clip(p, 1e-9, 1 - 1e-9)
            tried.append((-(np.log(q[y > 0]).mean() + np.log(1 - q[y == 0]).mean()) / 2, penalty, p))
        _, penalty, p = min(tried, key=lambda t: t[0])
        out = np.c_[out, applied(fitted(np.arange(len(texts)), seen, y, penalty), np.arange(len(texts)), out)]
        seen = np.c_[seen, p]
    return out


def test_toxicity_as_by_a_plain_chain(spark):
    rng = random.Random(8)
    labels = np.array([(i % 4 == 0, i % 6 == 0) for i in range(120)])
    texts = [" ".join([*rng.choices(WORDS[:60], k=30), *(["junk"] if a and rng.random() < 0.8 else []), *(["vile"] if b and rng.random() < 0.7 else [])]) for a, b in labels]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = spark.createDataFrame([(i, int(not a), int(b)) for i, (a, b) in enumerate(labels.tolist())], "doc_id long, quality int, toxic int")
    got = {r.doc_id: (r.p_junk, r.p_toxic, r.rejected) for r in toxicity.score(docs, toxicity.fit_chain(docs, table)).collect()}
    want = plain_chain(texts, labels)
    for i, (junk, toxic) in enumerate(want.tolist()):
        assert got[i][:2] == pytest.approx((junk, toxic), abs=1e-6) and got[i][2] == (toxic >= toxicity.THRESHOLD)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_folder(Cluster)


def test_substring_steps_take_few_texts_at_once(spark, monkeypatch):
    """Equal strings are shipped once across batches, and no more than PACKED bytes and a chunk's at once; Python gets TEXTS texts at a time; the session's setting comes back."""
    one, none = (SimpleNamespace(value=np.full(1 << 10, x, np.uint8)) for x in (255, 0))
    batch = lambda *texts: pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], ["raw"])
    text = b" ".join(b"w%d" % i for i in range(200))
    out = list(substrings._packed(35, 8, one, none)(iter([batch(text), batch(text)])))
    assert len(out) == 1 and set(out[0].column("n").to_pylist()) == {2}
    rng = np.random.default_rng(6)
    long = [b" ".join(b"w%d" % i for i in rng.integers(0, 1 << 40, 60_000)) for _ in range(20)]
    sizes = [b.column("packed").nbytes for b in substrings._packed(35, 8, one, none)(iter([batch(*long)]))]
    assert len(sizes) > 1 and max(sizes) < 4 * substrings.PACKED
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old, seen, before = spark.conf.get(name), [], substrings.repeated_spans
    monkeypatch.setattr(substrings, "repeated_spans", lambda *a: (seen.append(spark.conf.get(name)), before(*a))[1])
    assert substrings.remove_repeats(spark.createDataFrame([(1, text.decode()), (2, text.decode())], "doc_id long, text string")).agg({"n_removed": "sum"}).first()[0] == 400
    assert seen == [str(substrings.TEXTS)] and spark.conf.get(name) == old
