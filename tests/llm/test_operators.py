"""Each operator against a brute-force version on small tables with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from demandloom.llm import common, components, mixing, packing, quality, search, sharding, simhash, substrings, tokens, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts():
    rng = random.Random(5)
    word = lambda: rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randrange(40))
    out = [" ".join(word() for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    passage = " ".join(word() for _ in range(60))
    out += [f"{out[i]} {passage}\n{out[i + 1]}" for i in range(0, 12, 3)]
    out += [out[0], out[0], out[3].upper(), out[5] + " extra", "", None, " \t\n", "one", "a b", "é ü\x85ß x", "the " * 90, "line\nline\nother line\nline\n\n", " ".join(word() for _ in range(6000))]
    out += ["x y z q " * 30, passage]
    return out


def rows():
    made = [(i * 7 % 101, t, "en", None if i % 9 == 0 else f"src{i % 4}", len(t or "")) for i, t in enumerate(texts())]
    return [*made, made[3], made[3], (None, made[8][1], None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df, *names):
    """df with further columns that have an operator's own names."""
    for n in names:
        df = df.withColumn(n, common.F.lit(1))
    return df


def fingerprint(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    g = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def grouped(ids, prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(prints))]


def test_simhash(docs, none, monkeypatch):
    ids, prints = [r[0] for r in rows()], [fingerprint(r[1]) for r in rows()]
    want = Counter(zip(ids, (f"{p:016x}" for p in prints), grouped(ids, prints), strict=True))
    assert Counter(map(tuple, simhash.near_duplicates(clashing(docs, "simhash", "component_id")).collect())) == want
    monkeypatch.setattr(simhash, "CROWDED", 1)
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns and kept.count() == len({(c if c is not None else p) for c, p in zip(grouped(ids, prints), prints, strict=True)})


@pytest.mark.parametrize("crowded", [simhash.CROWDED, 2])
def test_simhash_links_of_clustered_fingerprints(spark, monkeypatch, crowded):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (1 << 64) - 1 for b in base for _ in range(60)} | {base[0] & 0xFFFFFFFF | rng.getrandbits(32) << 32 for _ in range(40)})
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    out = simhash.groups(spark.createDataFrame(list(enumerate(signed)), "doc_id long, simhash long")).collect()
    want = dict(zip(signed, grouped(range(len(prints)), prints), strict=True))
    assert {r.simhash: r.component_id for r in out} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (95, 100), (7, 7), (200, 201), (200, 201), (None, 3)]
    out = {r.node: r.root for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**dict.fromkeys(range(41), 0), **dict.fromkeys((90, 95, 100), 90), 200: 200, 201: 200}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def check_packing(out, capacity):
    bins = defaultdict(list)
    for r in out:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(docs, none):
    out = packing.digests(clashing(docs, "sequence_id", "piece")).collect()
    tok = Tokenizer.from_file(tokens.TOKENIZER)
    want = Counter()
    for d, t, *_ in rows():
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], "<u4")
            want[d, k // 2048, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    n = check_packing(out, 2048)
    assert n <= packing.lower_bound(np.array([r.length for r in out]), 2048) + 1
    assert packing.digests(none).count() == 0
    ids = packing.pack_documents(docs).where("length < 50").first()
    assert len(ids["ids"]) == 4 * ids.length


def test_packing_over_partitions(spark):
    rng = random.Random(3)
    sizes = [rng.randrange(1, 101) for _ in range(3000)]
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id long, length long")
    out = packing.pack(items, 100, per_task=400).collect()
    assert sorted((r.id, r.length) for r in out) == list(enumerate(sizes))
    assert check_packing(out, 100) <= packing.lower_bound(np.array(sizes), 100) * 1.02
    assert packing.lower_bound(np.array([51, 51, 51]), 100) == 3 and packing.lower_bound(np.array([], int), 100) == 0
    with pytest.raises(Exception, match="lengths must lie"):
        packing.pack(spark.createDataFrame([(1, 101)], "id long, length long"), 100).count()


def test_token_histogram(docs, none, spark):
    tok = Tokenizer.from_file(tokens.TOKENIZER)
    n = sorted(len(tok.encode(r[1] or "", add_special_tokens=False).ids) for r in rows())
    out = tokens.length_histogram(docs)
    got = {r.n_tokens: r for r in out.collect()}
    assert sorted(got) == sorted(set(n))
    for k, r in got.items():
        assert (r.n_docs, r.docs_from, r.tokens_from) == (n.count(k), sum(x >= k for x in n), sum(x for x in n if x >= k))
        assert r.tokens_within == sum(x for x in n if x <= k) and r.truncated_tokens == sum(min(x, k) for x in n)
    assert tokens.truncated_total(out, 100).first()[0] == sum(min(x, 100) for x in n)
    q = {r.q: r.n_tokens for r in tokens.quantiles(out, [0.0, 0.5, 1.0]).collect()}
    assert q == {0.0: n[0], 0.5: n[-(-len(n) // 2) - 1], 1.0: n[-1]}
    assert tokens.length_histogram(none).count() == 0


def removed(all_texts, k):
    split = [WORD.findall(t or "") for t in all_texts]
    seen = Counter(tuple(w[i : i + k]) for w in split for i in range(len(w) - k + 1))
    out = []
    for w in split:
        gone = {j for i in range(len(w) - k + 1) if seen[tuple(w[i : i + k])] > 1 for j in range(i, i + k)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize(("window", "m", "crowded"), [(35, 8, 3000), (35, 8, 1), (5, 2, 3000), (5, 2, 2)])
def test_substrings(docs, monkeypatch, window, m, crowded):
    monkeypatch.setattr(substrings, "CROWDED", crowded)
    monkeypatch.setattr(substrings, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(substrings, "TOGETHER", 2000)
    out = substrings.remove_repeats(clashing(docs, "kept", "spans", "text_key"), window, m)
    want = Counter((r[0], *x) for r, x in zip(rows(), removed([r[1] for r in rows()], window), strict=True))
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out.collect()) == want


def test_substrings_of_nothing(none):
    assert substrings.remove_repeats(none).count() == 0


def test_covers_tells_equal_hashes_apart(monkeypatch):
    monkeypatch.setattr(substrings, "rolled", lambda hashed, width: np.zeros(len(hashed) - width + 1, np.uint64))
    strings = [b"a b c d", b"a b c x", b"q r s t"]
    got = dict(substrings.covers(dict.fromkeys(strings, 1), 3))
    assert got == {substrings.key(strings[0]): [0, 3], substrings.key(strings[1]): [0, 3]}


def test_sharding(docs, none, spark):
    out = sharding.shard(clashing(docs, "slot", "size")).collect()
    n = len(rows())
    assert sorted(r.row_number for r in out) == sorted(r.position for r in out) == list(range(n))
    assert all((r.shard, r.slot) == sharding.place_of(r.row_number, n) for r in out)
    order = sorted(out, key=lambda r: r.row_number)
    block = lambda r: 0 if r.doc_id is None else r.doc_id % sharding.PRIME * sharding.FACTOR % sharding.PRIME % sharding.BLOCKS
    assert [block(r) for r in order] == sorted(map(block, out))
    body = Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == body
    per = Counter(r.shard for r in out)
    assert max(per.values()) - min(per[s] for s in range(40)) <= 1
    assert sharding.shard(none).count() == 0
    for m in (1, 2, 3, 10, 97, 1000):
        assert sorted(sharding.place_of(i, m, 1)[1] for i in range(m)) == list(range(m))


def test_quality(docs, none, spark):
    labels = spark.createDataFrame([(r[0],) for r in rows()[:30]], "doc_id long")
    ratios = quality.log_ratios(docs, labels, 50)
    trusted, seen = {r[0] for r in rows()[:30]}, [Counter(), Counter()]

    def grams(w):
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
        pairs = [xxhash.xxh64_intdigest(a.to_bytes(8, "little"), b) for a, b in zip(h[1:], [], strict=False)]
        signed = lambda v: v - (1 << 64) if v >> 63 else v
        # A pair's hash takes the second word's hash into a hash that the first's seeds.
        def pair(a, b):
            return xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))

        return [signed(x) % 50 for x in [*h, *(pair(a, b) for a, b in zip(h, h[1:], strict=False)), *pairs]]

    for r in rows():
        g = grams(WORD.findall(r[1] or ""))
        seen[0].update(g)
        if r[0] in trusted:
            seen[1].update(g)
    total = [sum(c.values()) + 50 for c in seen]
    want = [np.log((seen[1][b] + 1) / total[1]) - np.log((seen[0][b] + 1) / total[0]) for b in range(50)]
    assert np.allclose(ratios, want)

    got = Counter()
    for r in quality.assess(clashing(docs, "score", "kept", "w1"), labels, buckets=50).collect():
        assert r.kept == (not r.base_failed and r.score >= r.threshold)
        got[r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, round(r.score, 9)] += 1
    want_rows = Counter()
    for d, t, *_ in rows():
        w = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = len({j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)})
        g = grams(w)
        score = sum(ratios[b] for b in g) / len(g) if g else 0.0
        want_rows[d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), again, len(w) < 20 or 100 * again > 30 * len(w), round(score, 9)] += 1
    assert got == want_rows
    assert quality.assess(none, labels).count() == 0
    assert quality.assess(docs, labels.limit(0)).where("not base_failed and not kept").count() == 0


def test_search(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 40)
    monkeypatch.setattr(search, "QUERIES", 4)
    rng = np.random.default_rng(2)
    data = [(i, [float(np.float32(x)) for x in rng.normal(size=8) * rng.gamma(1)]) for i in range(300)]
    data += [(300, None), (301, [1.0] * 7 + [None]), (302, [float("nan")] * 8), (303, [float("inf")] * 8), (None, [1.0] * 8), (320, [0.0] * 8), (340, [1.0, 2.0]), (7, data[7][1]), (360, [])]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("score", common.F.lit(1))
    v = search.quantised(table)
    got = defaultdict(list)
    for r in search.top_k(v.where("vec_id % 20 = 0"), v, 5).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    good = [(i, [int(np.floor(64 * x)) for x in e]) for i, e in data if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    for q, e in good:
        if q % 20 == 0:
            best = sorted(((-sum(a * b for a, b in zip(e, f, strict=False)), i) for i, f in good if i != q))[:5]
            assert sorted(got.pop(q)) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert not got
    assert search.top_k(v.limit(0), v).count() == 0 and search.top_k(v, v.limit(0)).count() == 0
    assert search.top_k(v.where("vec_id < 3"), v.where("vec_id < 3"), 5).count() == 6


def test_mixing(docs, none, spark):
    weights = spark.createDataFrame([("src0", 3.0), ("src1", 1.0), (None, 1.0), ("other", 9.0), ("src2", None)], "source string, weight double")
    out = mixing.mix(clashing(docs, "copy", "rate"), weights, 500)
    made = out.collect()
    n = Counter(r[3] for r in rows())
    w = {"src0": 3.0, "src1": 1.0, None: 1.0}
    want = Counter()
    for d, _, _, s, _ in rows():
        lam = 500 * w.get(s, 0) / (sum(w.values()) * n[s])
        parts, k = max(1, int(np.ceil(lam / 16))), 0
        for i in range(1, parts + 1):
            u = int(hashlib.md5(f"mix:{'null' if d is None else d}:{i}".encode()).hexdigest()[:13], 16) / 2**52
            p = c = np.exp(-lam / parts)
            j = 0
            while c <= u and j < mixing.MOST:
                j += 1
                p *= lam / parts / j
                c += p
            k += j
        for copy in range(k):
            want[d, s, copy, k] += 1
    assert Counter((r.doc_id, r.source, r["copy"], r.n_copies) for r in made) == want
    assert [r.order_key for r in made] == sorted(r.order_key for r in made)
    assert 350 < len(made) < 650
    assert mixing.mix(none, weights).count() == 0


def test_mixing_follows_the_weights(spark):
    many = spark.range(40_000).selectExpr("id doc_id", "if(id % 10 < 7, 'big', 'small') source")
    weights = spark.createDataFrame([("big", 1.0), ("small", 1.0)], "source string, weight double")
    got = {r.source: r["count"] for r in mixing.mix(many, weights).groupBy("source").count().collect()}
    assert all(abs(x - 20_000) < 600 for x in got.values())


def test_warc(spark, tmp_path):
    big = "x<é>" * 400
    data = [(1, "http://a", big), (5, "http://b", big), (3, None, big), (None, "u\r\n", big), (7, "http://c", None), (8, "http://d", ""), (9, "h", "small"), (10, "h", "small"), (5, "http://b", big), (11, "e", "WARC/1.1\r\n\r\n" + "\x1f\x8b" * 999)]
    data += [(100 + i, f"http://{i}", random.Random(i).randbytes(3000).hex()) for i in range(60)]
    pages = clashing(spark.createDataFrame(data, "page_id long, url string, html string"), "digest", "payload")
    folder = warc.write(pages, str(tmp_path / "w"), per_file=50_000)
    want = Counter()
    for p, _, h in data:
        body = (h or "").encode()
        again = len(body) >= 1000 and h == big and p != 5
        want[p, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", 5 if again else None] += 1
    for size in (777, 20_000, 32 << 20):
        out = warc.read(spark, folder, size).collect()
        assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
        assert all(r.payload is None if r.record_type == "revisit" else hashlib.sha1(r.payload).hexdigest() == r.payload_digest for r in out)
    assert warc.read(spark, warc.write(pages.limit(0), str(tmp_path / "none"))).count() == 0


def test_warc_false_members(tmp_path, spark):
    (tmp_path / "x.warc.gz").write_bytes(b"junk" + warc.MAGIC + b"no member" + warc.gzipped(b"not a record") + b"".join(warc.gzipped(warc.record(i, "u", warc.MAGIC * 50, None, False)) for i in range(5)) + b"tail")
    for size in (10, 100, 10_000):
        assert sorted(r.page_id for r in warc.read(spark, str(tmp_path), size).collect()) == list(range(5))


def test_toxicity(spark, none):
    rng = random.Random(4)
    plain = [f"w{i}" for i in range(400)]
    def text(bad):
        w = [rng.choice(plain) for _ in range(rng.randrange(20, 200))]
        for _ in range(bad):
            w.insert(rng.randrange(len(w)), rng.choice(["awful", "awfully", "Vile!"]))
        return " ".join(w)

    data = [(i, text(3 if i % 5 == 0 else 0)) for i in range(600)]
    docs = clashing(spark.createDataFrame([*data, (None, None), (1000, ""), (3, data[3][1])], "doc_id long, text string"), "p_toxic", "rejected")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(400)] + [(None, 1, 1), (5000, 0, 0), (401, None, None)], "doc_id long, quality int, toxic int")
    chain = toxicity.fit_chain(docs, labels)
    assert list(chain) == ["junk", "toxic"]
    out = toxicity.score(docs, chain).collect()
    assert len(out) == 603
    held = [(r.rejected, r.doc_id % 5 == 0) for r in out if r.doc_id is not None and 400 <= r.doc_id < 600]
    assert sum(a == b for a, b in held) >= 0.97 * len(held)
    none_fit = toxicity.fit_chain(docs, labels.limit(0))
    assert toxicity.score(docs, none_fit).where("rejected").count() == 0
    assert toxicity.score(none, chain).count() == 0
