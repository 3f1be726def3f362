"""Connected components of a graph whose edges are rows, and the rows that stand for groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, looked_up, plain


def connected(edges: DataFrame) -> DataFrame:
    """Labels every node that has an edge with the smallest node of its component: columns node, root.

    edges: columns a, b (long). Self-loops and repeated edges are harmless; edges with a null end are ignored;
    without edges the result is empty. Alternates large-star and small-star steps (each hangs a node's neighbours
    on their smallest), whose degree of a node is only ever aggregated, never gathered, until nothing changes.
    """
    ends = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, mark = cut(ends.distinct()), None
    while True:
        found = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if (found.n, found.x) == mark or not found.n:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
        mark = found.n, found.x
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut(hung.union(least).distinct())


def keep_first(docs: DataFrame, doc_id: str, mark: Column, members: DataFrame) -> DataFrame:
    """Of each group the row of docs with the smallest id, of repeated ids the smallest row; a null id only if all are null.

    members: id, mark (long) and root of every row of docs; mark: the same mark as a Column over docs, whose columns have names
    of their own. Which rows stay is decided on members, so that docs are joined once.
    """
    pairs = cut(members.groupBy("id", "mark", "root").agg(F.count("*").alias("n")))
    least = pairs.groupBy("root").agg(F.min("id").alias("least"), F.sum("n").alias("n"))
    chosen = looked_up(pairs.withColumnRenamed("n", "_n"), "root", cut(least), "root", "n").where(F.col("id").eqNullSafe(F.col("least")))
    chosen = cut(chosen.select("root", pair(F.col("id"), F.col("mark")).alias("of"), F.col("_n").alias("n")))
    rows = looked_up(docs.withColumn("_pair", pair(F.col(doc_id), mark)), "_pair", chosen, "of", "n").where("root is not null").drop("_pair")
    repeated = chosen.groupBy("root").agg(F.sum("n").alias("n")).where("n > 1").select("root", F.lit(True).alias("_again"))
    if repeated.isEmpty():
        return rows.drop("root")
    again = cut(repeated)
    least_row = F.min_by(F.struct(*docs.columns), F.struct(*plain(docs))).alias("row")
    return rows.join(again, "root", "left_anti").drop("root").union(rows.join(again, "root", "left_semi").groupBy("root").agg(least_row).select("row.*"))


def pair(ident: Column, mark: Column) -> Column:
    """An id, null or not, and a mark as one key."""
    return F.concat(F.coalesce(F.concat(F.lit("+"), ident.cast("string")), F.lit("-")), F.lit(":"), mark.cast("string"))
