"""The registered query of each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import merkle, mixing, negatives, packing, quality, ranking, search, sharding, simhash, substrings, tokens, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mixing.temperature_weights(docs))
    return mixed.select("doc_id", "source", "copy", "n_copies", "order_key", F.md5("text").alias("text_md5"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), chain).drop("text")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.length_histogram(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = search.quantised(table(spark, sf_dir, "embeddings"))
    return search.top_k(vectors.where("vec_id % 20 = 0"), vectors)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write(table(spark, sf_dir, "pages"))
    back = warc.read(spark, folder)
    whole = F.col("record_type") == "response"
    return back.select(
        "page_id",
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    rows = negatives.labelled(vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))
    return negatives.mine(rows.where("vec_id % 100 = 0"), rows)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    done = merkle.tampered(table(spark, sf_dir, "documents"))
    return done.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", "verified", F.size("copies").alias("n_copied"))


def op13_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    apart = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return ranking.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), apart)


#: A table of CRC-32 by half bytes, made by the rule of the polynomial.
CRC_TABLE = "SELECT list_transform(range(0, 16), lambda i: list_reduce([i, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"


def leaf_sql(text: str) -> str:
    """SQL of a document's leaf, with this column for its text."""
    fields = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


def folding_sql(nodes: str, runs: str, start: str, name: str) -> str:
    """SQL of recursive tables: `runs` of the siblings in a table of nodes (tree, lvl, pos, n, h), and `name`, rows of start (r, tree, lvl, pos, cur, was, proof) carried upwards."""
    left, right = f"{runs}.hs[1:pos % 8]", f"{runs}.hs[pos % 8 + 2:]"
    return f"""{runs} AS (SELECT tree, lvl, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM {nodes} WHERE n > 1 GROUP BY ALL),
        {name} AS ({start}
            UNION ALL
            SELECT r, f.tree, f.lvl + 1, pos // 8, sha256(array_to_string({left}, '') || cur || array_to_string({right}, '')),
                sha256(array_to_string({left}, '') || was || array_to_string({right}, '')), proof || array_to_string({left}, '') || array_to_string({right}, '')
            FROM {name} f JOIN {runs} ON {runs}.tree = f.tree AND {runs}.lvl = f.lvl AND {runs}.run = f.pos // 8)"""


def feistel_sql(rows: str) -> str:
    """SQL of the permutation of sharding.py: rows (id, x, a, b, n) with x put through all rounds."""
    sql = f"SELECT id, a, b, n, x // b AS u, x % b AS l FROM ({rows})"
    for turn, key in enumerate(sharding.KEYS):
        half, digit = ("u", "l") if turn % 2 else ("l", "u")
        t = f"(({half} % {sharding.PRIME} + {key}) % {sharding.PRIME})"
        f = f"((({t} * {t} + {key}) % {sharding.PRIME} * {sharding.FACTOR} + {key}) % {sharding.PRIME})"
        sql = f"SELECT * REPLACE (({digit} + {f}) % {'b' if turn % 2 else 'a'} AS {digit}) FROM ({sql})"
    return f"SELECT id, u * b + l AS x, a, b, n FROM ({sql})"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_packing, op3_mixing, op4_substrings, op5_toxicity, op6_sharding, op7_token_counts, op8_quality, op9_top_k, op10_warc, op11_negatives, op12_merkle, op13_ranking)
}

ORACLES: dict[str, str] = {
    "op3_mixing": """
        WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
        r AS (SELECT source, (SELECT sum(n) FROM n) * sqrt(n) / ((SELECT sum(sqrt(n)) FROM n) * n) AS rate FROM n),
        parts AS (SELECT source, rate, greatest(ceil(rate / 16), 1)::INT AS parts FROM r),
        cdf AS (
            WITH RECURSIVE c(source, k, p, c) AS (
                SELECT source, 0, exp(-rate / parts), exp(-rate / parts) FROM parts
                UNION ALL
                SELECT c.source, c.k + 1, c.p * (t.rate / t.parts) / (c.k + 1), c.c + c.p * (t.rate / t.parts) / (c.k + 1)
                FROM c JOIN parts t ON t.source IS NOT DISTINCT FROM c.source WHERE c.k < 80)
            SELECT * FROM c),
        u AS (
            SELECT d.doc_id, d.source, md5(d.text) AS text_md5, i.i, ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || i.i), 1, 13))::BIGINT / 4503599627370496.0 AS u
            FROM documents d JOIN parts t ON t.source IS NOT DISTINCT FROM d.source, LATERAL (SELECT unnest(range(1, t.parts + 1)) AS i) i),
        k AS (SELECT u.doc_id, u.source, u.text_md5, u.i, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM u.source AND cdf.c <= u.u AND cdf.k < 80) AS k FROM u),
        m AS (SELECT doc_id, source, text_md5, sum(k)::INT AS n_copies FROM k GROUP BY ALL)
        SELECT doc_id, source, text_md5, j.j::INT AS copy, n_copies,
            ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':copy:' || j.j), 1, 15))::BIGINT AS order_key
        FROM m, LATERAL (SELECT unnest(range(0, n_copies)) AS j) j""",
    "op4_substrings": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
        i AS (SELECT r, unnest(range(1, len(w) - 33)) AS i FROM d),
        k AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM i JOIN d USING (r)),
        t AS (SELECT r, i FROM k QUALIFY count(*) OVER (PARTITION BY k) > 1),
        c AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM t),
        g AS (SELECT r, list(p) AS p FROM c GROUP BY r),
        o AS (SELECT doc_id, len(w) AS n_words, coalesce(len(p), 0) AS n_removed,
            CASE WHEN p IS NULL THEN w ELSE list_filter(w, lambda x, n: NOT list_contains(p, n)) END AS kept FROM d LEFT JOIN g USING (r))
        SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM o""",
    # CRC-32 by half bytes, the lower one first.
    "op6_sharding": f"""
        WITH RECURSIVE t AS ({CRC_TABLE}),
        d AS (SELECT row_number() OVER () AS id, doc_id, encode(coalesce(text, '')) AS body FROM documents),
        h AS (SELECT id, doc_id, octet_length(body) + 16 AS size, string_split(hex(body), '') AS h FROM d),
        c AS (SELECT id, doc_id, size, CASE WHEN size = 16 THEN 0 ELSE xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(range(0, len(h)), lambda i: (strpos('0123456789ABCDEF', h[xor(i, 1) + 1]) - 1)::BIGINT)),
            lambda c, x: xor(c >> 4, t[(xor(c, x) & 15) + 1]))) END AS crc FROM h, t),
        m AS (SELECT count(*) AS n, floor(sqrt(greatest(count(*) - 1, 0)))::BIGINT + 1 AS a FROM c),
        s AS (SELECT n, a, greatest(1, (n + a - 1) // a) AS b FROM m),
        r AS (SELECT id, row_number() OVER (ORDER BY coalesce(doc_id % {sharding.PRIME} * {sharding.FACTOR} % {sharding.PRIME} % {sharding.BLOCKS}, 0), doc_id NULLS FIRST, crc, size) - 1 AS x FROM c),
        p AS ({feistel_sql("SELECT id, x, a, b, n FROM r, s")} UNION ALL {feistel_sql("SELECT id, x, a, b, n FROM p WHERE x >= n")})
        SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (p.x % 40)::INT AS shard, (p.x // 40)::BIGINT AS slot,
            NULL::INT AS grown_shard, r.x::BIGINT AS row_number FROM p JOIN c USING (id) JOIN r USING (id) WHERE p.x < n""",
    "op9_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, rank::INT AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20""",
    "op10_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
        m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS last FROM d)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
            CASE WHEN last IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN last IS DISTINCT FROM page_id THEN last END AS refers_to FROM m""",
    "op11_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
            FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (
            SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
                row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
            FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
        SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
    "op12_merkle": f"""
        WITH RECURSIVE t AS ({CRC_TABLE}),
        d AS (SELECT *, row_number() OVER () AS r, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, string_split(hex(encode(doc_id::VARCHAR)), '') AS x FROM documents),
        l AS (SELECT r, doc_id, coalesce('=' || lang, '-') AS tree, {leaf_sql("text")} AS leaf,
            CASE WHEN xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(range(0, len(x)), lambda i: (strpos('0123456789ABCDEF', x[xor(i, 1) + 1]) - 1)::BIGINT)),
                lambda c, y: xor(c >> 4, t[(xor(c, y) & 15) + 1]))) % 3 = 0 THEN {leaf_sql("low")} END AS shown FROM d, t),
        o AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, shown NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM l),
        a AS (SELECT tree, 0 AS lvl, pos, n, leaf AS h FROM o
            UNION ALL SELECT tree, lvl + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM a WHERE n > 1 GROUP BY tree, lvl, pos // 8),
        s AS (SELECT tree AS own, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, h FROM a WHERE n = 1),
        b AS (SELECT '' AS tree, 0 AS lvl, pos, n, h FROM s
            UNION ALL SELECT tree, lvl + 1, pos // 8, (any_value(n) + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM b WHERE n > 1 GROUP BY tree, lvl, pos // 8),
        {folding_sql("a", "ar", "SELECT r, tree, 0 AS lvl, pos, coalesce(shown, leaf) AS cur, leaf AS was, '' AS proof FROM o", "p")},
        pt AS (SELECT r, tree, cur, was, proof FROM p QUALIFY row_number() OVER (PARTITION BY r ORDER BY lvl DESC) = 1),
        {folding_sql("b", "br", "SELECT r, '' AS tree, 0 AS lvl, s.pos, cur, was, proof FROM pt JOIN s ON s.own = pt.tree", "q")},
        qt AS (SELECT r, lvl, cur, was, proof FROM q QUALIFY row_number() OVER (PARTITION BY r ORDER BY lvl DESC) = 1)
        SELECT o.doc_id, o.leaf, pt.was AS subroot, b.h AS root, sha256(qt.proof) AS proof_sha256, qt.cur AS folded_root, qt.cur = b.h AS verified,
            (qt.lvl + (SELECT max(lvl) FROM p WHERE p.r = o.r))::INT AS n_copied
        FROM o JOIN pt USING (r) JOIN qt USING (r), b WHERE b.n = 1""",
}
