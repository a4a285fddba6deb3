"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.session import scratch_path
from wattlake.sources.tables import remove_files


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's reader only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, so that no other column of the input can clash with the operator's own."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here, and lost executors cost no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove what ``stored`` wrote, once nothing refers to it any more."""
    remove_files(df.sparkSession, {f.rsplit("/", 1)[0] for f in df.inputFiles()})


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph: (node, root), one row per node that has an edge.

    ``edges`` holds (a, b) with a != b. Each round sends every node to the neighbour (or itself) that comes
    first in an order drawn anew for the round, and contracts the graph. The random order makes the
    number of rounds logarithmic for any shape, long chains included. A round's map and the
    contracted edges are stored, so no lineage grows; minima are partial before the shuffle, and the
    joins are plain ones that adaptive execution can split at a hub.
    """
    edges, maps, round_ = stored(_tidy(edges), "edges"), [], 0
    while not edges.isEmpty():
        order = lambda node: F.struct(F.xxhash64(F.lit(round_), node).alias("h"), node.alias("node"))
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = stored(both.groupBy("a").agg(F.min(order(F.col("b"))).alias("m"))
                       .select("a", F.least("m", order(F.col("a")))["node"].alias("to")), "moved")
        maps.append(moved)
        left = edges.join(moved, "a").select(F.col("to").alias("x"), F.col("b").alias("a"))
        contracted = left.join(moved, "a").select(F.col("x").alias("a"), F.col("to").alias("b"))
        old, edges = edges, stored(_tidy(contracted), "edges")
        forget(old)
        round_ += 1
    forget(edges)
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    labels = maps[0].select(F.col("a").alias("node"), F.col("to").alias("root"))
    for moved in maps[1:]:
        step = moved.select(F.col("a").alias("root"), "to")
        labels = labels.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return labels


def _tidy(edges: DataFrame) -> DataFrame:
    return (edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x & y, conditions)
