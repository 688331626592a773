"""The weighted co-occurrence graph of entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.entities import category, color


def document_frequency(mentioned: DataFrame, key: str = "ticker") -> DataFrame:
    """name, count of the documents that mention it."""
    return mentioned.select(key, "name").distinct().groupBy("name").agg(F.count("*").alias("count"))


def kept_names(frequency: DataFrame, top: int | None = None, least: int = 2) -> DataFrame:
    """Names in at least so many documents, or (0 and None: no) the top ones by count, then name, whatever their count."""
    return frequency.orderBy(F.desc("count"), "name").limit(top) if top else frequency.filter(F.col("count") >= least)


#: Names of a document beyond which its pairs are made by blocks of so many.
BLOCK = 256


def edges(mentioned: DataFrame, kept: DataFrame, min_weight: int = 5, key: str = "ticker", block: int = BLOCK) -> DataFrame:
    """source, target, weight of all pairs of kept names in a document, source before target.

    Names are pruned before pairs are made. Pairs of a document come from its sorted names, without a self-join. Those of a document of many
    names come from pairs of blocks of them, which are rows that go to tasks of their own. Counts are partial in each task before they
    are shuffled.
    """
    names = mentioned.join(kept.select("name"), "name", "left_semi").groupBy(key).agg(F.array_sort(F.collect_set("name")).alias("names"))
    first = names.filter(F.size("names") <= block).select(F.posexplode("names").alias("i", "source"), "names")
    pairs = first.select("source", F.explode(F.slice("names", F.col("i") + 2, F.size("names"))).alias("target"))
    pairs = pairs.unionByName(_pairs_of_blocks(names.filter(F.size("names") > block), key, block))
    return pairs.groupBy("source", "target").agg(F.count("*").alias("weight")).filter(F.col("weight") >= min_weight)


def _pairs_of_blocks(names: DataFrame, key: str, block: int) -> DataFrame:
    """source, target of the pairs in each document's sorted names. A block goes to each of its pairs with others and to itself."""
    last = F.floor((F.size("names") - 1) / block).cast("int")
    blocks = names.select(key, last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("b"), "names")
    blocks = blocks.select(key, "last", "b", F.slice("names", F.col("b") * block + 1, F.lit(block)).alias("names"))
    sent = blocks.select(key, "b", "names", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("c"))
    met = sent.groupBy(key, F.least("b", "c").alias("low"), F.greatest("b", "c").alias("high")).agg(F.array_sort(F.collect_list(F.struct("b", "names"))).alias("two"))
    source = met.select(F.explode(F.col("two")[0]["names"]).alias("source"), F.element_at("two", -1)["names"].alias("right"))
    return source.select("source", F.explode(F.filter("right", lambda x: x > F.col("source"))).alias("target"))


def nodes(frequency: DataFrame, edge: DataFrame, profile: str = "graph") -> DataFrame:
    """id, count, category, color of the names with an edge."""
    ends = edge.select(F.explode(F.array("source", "target")).alias("name")).distinct()
    found = frequency.join(ends, "name", "left_semi").withColumn("category", category(F.col("name"), profile))
    return found.select(F.col("name").alias("id"), "count", "category", color(F.col("category")).alias("color"))


def neighbours(edge: DataFrame, name: str) -> DataFrame:
    """neighbour, weight of a node's edges in either direction."""
    out = edge.filter(F.col("source") == name).select(F.col("target").alias("neighbour"), "weight")
    return out.unionByName(edge.filter(F.col("target") == name).select(F.col("source").alias("neighbour"), "weight"))


def scales(node: DataFrame, edge: DataFrame) -> DataFrame:
    """nodes, edges, max_count, max_weight: what a drawing scales by."""
    both = node.select(F.col("count").alias("c"), F.lit(None).cast("long").alias("w")).unionByName(edge.select(F.lit(None).cast("long").alias("c"), F.col("weight").alias("w")))
    return both.agg(F.count("c").alias("nodes"), F.max("c").alias("max_count"), F.count("w").alias("edges"), F.max("w").alias("max_weight"))


def view(node: DataFrame, edge: DataFrame, min_weight: int, label_from: int = 20, search: str | None = None) -> tuple[DataFrame, DataFrame]:
    """What a viewer shows at a threshold: edges, and their nodes with whether they bear a label and match the search."""
    e = edge.filter(F.col("weight") >= min_weight)
    ends = e.select(F.explode(F.array("source", "target")).alias("id")).distinct()
    found = F.lower("id").contains(search.lower()) if search else F.lit(False)
    return node.join(ends, "id", "left_semi").withColumn("labelled", F.col("count") >= label_from).withColumn("found", found), e
