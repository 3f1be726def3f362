"""Hierarchies among columns: cases of a product and a customer hierarchy, plain checks of all pairs, many columns at once."""

import itertools
import random

from pyspark.sql import functions as F

from demandloom.operators import hierarchy


def frame(spark, more=()):
    """100 keys of 20 weeks: market (2), segment (5), brand (10) nested; another cut of the keys; a flag; a number that differs from row to row."""
    rng = random.Random(0)
    apg, flag = {k: f"APG{rng.randrange(4)}" for k in range(100)}, {k: rng.randrange(2) for k in range(100)}
    rows = [(f"K{k:03d}", 202401 + w, f"B{k % 10:02d}", f"S{k % 10 // 2}", f"M{k % 10 // 2 // 3}", apg[k], flag[k], rng.gauss(5, 1)) for k in range(100) for w in range(20)]
    df = spark.createDataFrame(rows, "key string, year_week int, brand_name string, segment_name string, market_name string, APG_code string, ps_pos_mapped int, some_dense_float double")
    return df.withColumns(dict(more)) if more else df


def by_column(df):
    return {r.column: r for r in df.collect()}


def chain(found, name):
    return [c for _, c in sorted((r.level, c) for c, r in found.items() if r.chain == name)]


def test_nested_chain_and_one_of_its_own(spark):
    found = by_column(hierarchy.hierarchy_chains(frame(spark), ["brand_name", "segment_name", "market_name", "APG_code"], least_keys=2, least=2, binary=True))
    assert chain(found, "product") == ["market_name", "segment_name", "brand_name"] and chain(found, "customer") == ["APG_code"]
    assert found["brand_name"].parent == "segment_name" and found["market_name"].parent is None
    assert found["brand_name"].keys_per_group == 10 and found["segment_name"].n_values == 5 and all(0 < r.score <= 1 for r in found.values())


def test_reasons(spark):
    found = by_column(hierarchy.hierarchy_chains(frame(spark, [("half", F.when(F.col("year_week") % 2 == 0, F.col("brand_name"))), ("own", F.col("key"))]), ["brand_name", "ps_pos_mapped", "some_dense_float", "half", "own"], least_keys=2))
    assert {c: r.rejected for c, r in found.items()} == {"brand_name": None, "ps_pos_mapped": "few values", "some_dense_float": "several values a key", "half": "seldom filled", "own": "as many values as keys"}
    assert by_column(hierarchy.hierarchy_chains(frame(spark), ["ps_pos_mapped"], least_keys=2, least=2, binary=True))["ps_pos_mapped"].chain == "other"


def test_renamed_columns_collapse(spark):
    df = frame(spark, [("form_name", F.col("segment_name")), ("sub_form_name", F.concat(F.lit("x"), F.col("segment_name")))])
    found = by_column(hierarchy.hierarchy_chains(df, ["form_name", "sub_form_name", "segment_name"], least_keys=2, least=2))
    assert found["form_name"].same_as == found["sub_form_name"].same_as == "segment_name" and found["form_name"].chain is None and chain(found, "product") == ["segment_name"]


def test_thirty_columns_without_a_row_for_each_pair(spark):
    """What determines what as by plain sets, from as many rows as combinations times columns."""
    rng = random.Random(3)
    cuts = {f"c{i:02d}": [rng.randrange(2 + i) for _ in range(60)] for i in range(28)} | {"nested": [k // 6 for k in range(60)], "fine": [k // 2 for k in range(60)]}
    rows = [(f"k{k}", *[v[k] if k % 13 or n != "c05" else None for n, v in cuts.items()]) for k in range(60) for _ in range(3)]
    df = spark.createDataFrame(rows, "key string, " + ", ".join(f"{n} int" for n in cuts))
    keys, _ = hierarchy.column_profile(df, list(cuts), "key")
    got = hierarchy.determines(keys, range(30))
    values = list(zip(*[[r[i + 1] for r in rows] for i in range(30)], strict=True))
    want = set()
    for a, b in itertools.permutations(range(30), 2):
        seen = {}
        for r in values:
            if r[a] is not None and r[b] is not None:
                seen.setdefault(r[a], set()).add(r[b])
        if all(len(s) <= 1 for s in seen.values()):
            want.add((a, b))
    assert got == want and (29, 28) in got


def test_no_rows(spark):
    found = by_column(hierarchy.hierarchy_chains(frame(spark).limit(0), ["brand_name"]))
    assert found["brand_name"].chain is None
