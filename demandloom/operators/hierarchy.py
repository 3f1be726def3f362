"""Hierarchies among columns: which group keys, which are nested, and chains of them from coarse to fine.

Rows are first grouped to one a key, keys to the distinct combinations of the accepted columns. A column determines another if all combinations of each of its values agree
on the other; that is found for all pairs in one aggregation of the combinations, once for each column. Chains are walked on the columns, which are few.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.tables import cut

# What names of columns speak for.
PRODUCT = ("brand", "segment", "form", "category", "market", "family", "variant", "gtin", "cpl", "product")
CUSTOMER = ("apg", "customer", "account", "planning_customer", "retailer", "store", "channel", "banner")
#: Weight of a label's score.
NAMED = {"product": 1.0, "customer": 0.9, "other": 0.7}
SCHEMA = "column string, label string, chain string, level int, parent string, n_values long, keys_per_group double, least_keys long, coverage double, score double, same_as string, rejected string"


def label_of(column: str, product: Sequence[str] = PRODUCT, customer: Sequence[str] = CUSTOMER) -> tuple[str, int]:
    """Label and rank of a column by the first pattern in its name."""
    patterns = [*product, *customer]
    rank = next((i for i, p in enumerate(patterns) if p in column.lower()), len(patterns))
    kind = "product" if any(p in column.lower() for p in product) else "customer" if any(p in column.lower() for p in customer) else "other"
    return kind, rank


def score_of(n_values: int, keys_per_group: float, label: str, level: int) -> float:
    """Best for some thirty groups of some thirty keys, for names that tell, and for coarse levels."""
    near = lambda x: max(0.0, 1.0 - abs(math.log10(max(x, 1)) - 1.5))
    return NAMED[label] * (0.4 * near(n_values) + 0.4 * near(keys_per_group) + 0.2 * (1 - 0.2 * (level - 1)))


def column_profile(df: DataFrame, columns: Sequence[str], key: str) -> tuple[DataFrame, list]:
    """The key table (a value of each column a key, as text), and for each column: column, filled (rows), n_rows, many (keys of more than one value), n_keys, n_values, least, median (keys a value)."""
    sides = [x for i, c in enumerate(columns) for x in (F.min(F.col(c).cast("string")).alias(f"a{i}"), F.max(F.col(c).cast("string")).alias(f"b{i}"), F.count(c).alias(f"n{i}"))]
    keys = cut(df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"), *sides))
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"a{i}").alias("v"), F.col(f"n{i}").alias("filled"), (F.col(f"a{i}") != F.col(f"b{i}")).alias("many")) for i in range(len(columns))])).alias("c")
    # Keys by value, then values by column: partial sums all the way.
    values = keys.select("_n", each).groupBy("c.i", "c.v").agg(F.count("*").alias("k"), F.sum("c.filled").alias("filled"), F.sum("_n").alias("n"), F.count_if("c.many").alias("many"))
    sizes = values.groupBy("i", F.when(F.col("v").isNotNull(), F.col("k")).alias("k")).agg(F.count("v").alias("values"), F.sum("filled").alias("filled"), F.sum("n").alias("n"), F.sum("many").alias("many"), F.sum(F.col("k")).alias("keys"))
    up = "sum(values) over (partition by i order by k nulls first)"
    ranked = sizes.selectExpr("*", f"{up} up", "sum(values) over (partition by i) all_values")
    found = ranked.groupBy("i").agg(
        F.sum("values").alias("n_values"), F.sum("filled").alias("filled"), F.sum("n").alias("n_rows"), F.sum("many").alias("many"), F.sum("keys").alias("n_keys"), F.min("k").alias("least"),
        F.min(F.when(F.col("up") > F.expr("(all_values - 1) div 2"), F.col("k"))).alias("low"), F.min(F.when(F.col("up") > F.expr("all_values div 2"), F.col("k"))).alias("high"),
    )
    return keys, found.collect()  # a row a column


def determines(keys: DataFrame, at: Sequence[int]) -> set[tuple[int, int]]:
    """Pairs (a, b) of columns of the key table of which each value of a has one value of b."""
    combinations = cut(keys.select(*[f"a{i}" for i in at]).distinct())
    own = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"a{i}").alias("v")) for i in at])).alias("c")
    sides = [F.coalesce(F.min(f"a{i}") == F.max(f"a{i}"), F.lit(True)).alias(f"one{i}") for i in at]
    agreed = combinations.select("*", own).where("c.v is not null").groupBy("c.i", "c.v").agg(*sides).groupBy("i").agg(*[F.bool_and(f"one{i}").alias(f"one{i}") for i in at])
    return {(r.i, b) for r in agreed.collect() for b in at if b != r.i and r[f"one{b}"]}  # a row a column


def chains_of(columns: dict[str, dict], parents: dict[str, set[str]], deepest: int) -> list[list[str]]:
    """Chains from coarse to fine within columns of one label: from the finest column that is left upwards to the nearest level above each."""
    out, taken = [], set()
    for column in sorted(columns, key=lambda c: -columns[c]["n_values"]):
        if column in taken:
            continue
        chain = [column]
        taken.add(column)
        while len(chain) < deepest:
            above = [p for p in columns if p in parents[chain[-1]] and p not in taken]
            if not above:
                break
            chain.append(max(above, key=lambda p: columns[p]["n_values"]))
            taken.add(chain[-1])
        out.append(chain[::-1])
    return out


def hierarchy_chains(
    df: DataFrame, columns: Sequence[str], key: str = "key", least_keys: int = 5, least: int = 3, most: int = 2000, coverage: float = 0.95, binary: bool = False, deepest: int = 3,
    product: Sequence[str] = PRODUCT, customer: Sequence[str] = CUSTOMER,
) -> DataFrame:
    """One row a candidate column: its label by name, its chain (product, customer, other) and level in it (1: coarsest), parent, n_values, keys_per_group, least_keys, coverage, score; same_as: the column
    it only renames; rejected: why it can't group keys, the first reason that holds.

    A column groups keys if it has few enough and enough values (two only if binary), fewer than there are keys, is filled in enough rows, has one value a key and a median of least_keys keys a value. Null values
    count for nothing. Of columns that cut the keys alike that with the most telling name stays. The longest chain of a label is its chain, the others' columns go to `other`. Values are compared as text.
    """
    keys, found = column_profile(df, columns, key)
    out = {c: dict.fromkeys(SCHEMA.replace(" string", "").replace(" int", "").replace(" long", "").replace(" double", "").split(", ")) | {"column": c} for c in columns}
    for r in found:
        c = columns[r.i]
        median = int(((r.low or 0) + (r.high or 0)) / 2)
        share = r.filled / max(1, r.n_rows)
        reasons = [
            (r.n_values < least or (r.n_values == 2 and not binary), "few values"), (r.many > 0, "several values a key"), (r.n_values > most, "many values"), (r.n_values >= r.n_keys, "as many values as keys"),
            (share < coverage, "seldom filled"), (median < least_keys, "few keys a value"),
        ]
        label, rank = label_of(c, product, customer)
        out[c] |= {"label": label, "_rank": rank, "_i": r.i, "n_values": r.n_values, "keys_per_group": r.n_keys / max(1, r.n_values), "least_keys": r.least, "coverage": round(share, 4), "rejected": next((why for hit, why in reasons if hit), None)}
    fit = {c: x for c, x in out.items() if x["label"] and not x["rejected"]}
    pairs = {(columns[a], columns[b]) for a, b in determines(keys, [x["_i"] for x in fit.values()])} if fit else set()
    for a in sorted(fit, key=lambda c: (fit[c]["_rank"], c)):
        for b in sorted(fit, key=lambda c: (fit[c]["_rank"], c)):
            if a != b and not fit[a]["same_as"] and not fit[b]["same_as"] and (a, b) in pairs and (b, a) in pairs:
                fit[b]["same_as"] = a
    own = {c: x for c, x in fit.items() if not x["same_as"]}
    parents = {a: {b for b in own if (a, b) in pairs and own[a]["n_values"] > own[b]["n_values"]} for a in own}
    named: dict[str, list[list[str]]] = {}
    extra: list[list[str]] = []
    for label in ("product", "customer", "other"):
        made = sorted(chains_of({c: x for c, x in own.items() if x["label"] == label}, parents, deepest), key=lambda c: -len(c))
        named[label] = made[:1]
        extra += made[1:]
    rest = [c for chain in [*named["other"], *extra] for c in chain]
    for name, chain in (("product", named["product"]), ("customer", named["customer"]), ("other", [rest])):
        for level, c in enumerate(chain[0] if chain else [], 1):
            within = next(x for x in [*named["product"], *named["customer"], *named["other"], *extra] if c in x)
            own[c] |= {"chain": name, "level": level, "parent": within[within.index(c) - 1] if within.index(c) else None, "score": round(score_of(own[c]["n_values"], own[c]["keys_per_group"], own[c]["label"], level), 4)}
    order = [f.split(" ")[0] for f in SCHEMA.split(", ")]
    return df.sparkSession.createDataFrame([tuple(x[f] for f in order) for x in out.values()], SCHEMA)
