"""Derived tables in generations: all made of one scan of the reports, or of the generation before and what has changed.

A generation is a folder with the names and roles that each report gives (`parsed`, no text), and the counts over them: of names in
files, of reports that mention a name, and of pairs of names. Index, graph and themes come from these. After a rewrite the next
generation needs the changed reports only: their old names count -1, their new ones +1. Pairs are kept of names in two reports or
more; where a name passes that bound, its pairs are counted from `parsed`, or go.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import dims, storage
from tidemark.functions import text as T
from tidemark.operators import graph as G
from tidemark.operators import index as I
from tidemark.operators import themes as TH

TABLES = ["parsed", "counts", "frequency", "pairs"]
_PARSED = "ticker string, company string, sector string, path string, file_names array<string>, body_names array<string>, entries array<struct<name string, role string>>, chain long, copies long, last boolean"


@dataclass
class Generation:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")


def parsed(reports: DataFrame, number: Column | None = None) -> DataFrame:
    """What a report gives: linked names of the file with repeats, of its body once, and those of its sections with their roles; chain, a hash of its supply chain;
    copies, as how many it counts (1 if it has no such column); last: the file that counts for its ticker.

    number tells reports of one ticker apart, where several companies may have it; each has a last file then.
    """
    content = F.col("content")
    sections = F.concat(*[T.loose_section(content, t) for t in dims.SECTION_TITLES.values()])

    def roles(own: Column) -> Column:
        return F.transform(own["names"], lambda n: F.struct(n.alias("name"), T.role(own["chain"], n).alias("role")))

    # The lambda binds chain and names, so that they are made once for a report.
    chain = T.loose_section(content, dims.SECTION_TITLES["supply_chain"])
    entries = F.transform(F.array(F.struct(chain.alias("chain"), F.array_distinct(T.mentions(sections)).alias("names"))), roles)[0]
    rows = reports.select("ticker", "company", "sector", "path", T.mentions(content).alias("file_names"), F.array_distinct(T.mentions(T.body(content))).alias("body_names"), entries.alias("entries"), F.xxhash64(chain).alias("chain"), (F.col("copies") if "copies" in reports.columns else F.lit(1)).cast("long").alias("copies"))
    same = Window.partitionBy("ticker", *([] if number is None else [number]))
    return rows.withColumn("last", F.col("path") == F.max("path").over(same))


def _named(rows: DataFrame, column: str, sign: Column) -> DataFrame:
    return rows.select(F.explode(column).alias("name"), sign.alias("n"))


def _counted(signed: DataFrame, by: list[str], n: str) -> DataFrame:
    """Sums of signed counts; what has come to nothing goes."""
    return signed.groupBy(*by).agg(F.sum("n").alias(n)).filter(F.col(n) > 0)


def _mentioned(rows: DataFrame) -> DataFrame:
    return rows.filter("last").select("ticker", F.explode("body_names").alias("name"))


def _number(folder: str) -> int:
    return int(folder.rpartition("/g")[2])


def _finish(spark: SparkSession, root: str, number: int, made: str) -> Generation:
    if not storage.take_name(spark, made, f"{root}/g{number:09d}"):
        raise RuntimeError(f"generation {number} has been made by another run")
    return Generation(spark, f"{root}/g{number:09d}")


def latest(spark: SparkSession, root: str) -> Generation | None:
    found = [n for n in storage.names_in(spark, root) if n.startswith("g")]
    return Generation(spark, f"{root}/{found[-1]}") if found else None


def first_generation(spark: SparkSession, reports: DataFrame, root: str, number: Column | None = None) -> Generation:
    """The generation after the newest one, from all reports. Their texts are scanned once. number: as in `parsed`."""
    before = latest(spark, root)
    made = f"{root}/making-{storage.uuid.uuid4().hex}"
    parsed(reports, number).write.parquet(f"{made}/parsed")
    rows = spark.read.parquet(f"{made}/parsed")
    _counted(_named(rows, "file_names", F.col("copies")), ["name"], "count").write.parquet(f"{made}/counts")
    mentioned = _mentioned(rows)
    G.document_frequency(mentioned).write.parquet(f"{made}/frequency")
    kept = G.kept_names(spark.read.parquet(f"{made}/frequency"))
    G.edges(mentioned, kept, 1).write.parquet(f"{made}/pairs")
    return _finish(spark, root, _number(before.folder) + 1 if before else 1, made)


def next_generation(spark: SparkSession, root: str, changed: DataFrame, removed: DataFrame | None = None) -> Generation:
    """The generation after the newest one, from it and the changed reports (new or rewritten, as a whole, all of a ticker) and removed tickers. No other text is read.

    What is changed may be given as `parsed` gives it.
    """
    old = latest(spark, root)
    if old is None:
        raise RuntimeError(f"no generation in {root}")
    made = f"{root}/making-{storage.uuid.uuid4().hex}"
    rows = old.table("parsed")
    fresh = storage.written(changed if "file_names" in changed.columns else parsed(changed), "changed-names")
    tickers = fresh.select("ticker").unionByName(removed.select("ticker")) if removed is not None else fresh.select("ticker")
    tickers = tickers.distinct()
    gone = rows.join(tickers, "ticker", "left_semi")
    rows.join(tickers, "ticker", "left_anti").unionByName(fresh).write.parquet(f"{made}/parsed")
    now = spark.read.parquet(f"{made}/parsed")
    signed = gone.withColumn("sign", F.lit(-1)).unionByName(fresh.withColumn("sign", F.lit(1)))

    counts = old.table("counts").select("name", F.col("count").alias("n")).unionByName(_named(signed, "file_names", F.col("sign") * F.col("copies")))
    _counted(counts, ["name"], "count").write.parquet(f"{made}/counts")
    frequency = old.table("frequency").select("name", F.col("count").alias("n")).unionByName(signed.filter("last").select("ticker", F.col("sign").alias("n"), F.explode("body_names").alias("name")).distinct().select("name", "n"))
    _counted(frequency, ["name"], "count").write.parquet(f"{made}/frequency")

    was, is_now = G.kept_names(old.table("frequency")).select("name"), G.kept_names(spark.read.parquet(f"{made}/frequency")).select("name")
    lost, new = was.join(is_now, "name", "left_anti"), storage.written(is_now.join(was, "name", "left_anti"), "new-names")
    both = was.join(is_now, "name", "left_semi")
    ends = lambda pairs, names, how: pairs.join(names.withColumnRenamed("name", "source"), "source", how).join(names.withColumnRenamed("name", "target"), "target", how)
    weights = ends(old.table("pairs"), lost, "left_anti").select("source", "target", F.col("weight").alias("n"))
    for sign in (-1, 1):
        own = G.edges(_mentioned(signed.filter(F.col("sign") == sign)), both, 1)
        weights = weights.unionByName(own.select("source", "target", (F.col("weight") * sign).alias("n")))
    # Reports that mention a name that is new among the kept ones, whether they have changed or not.
    mentioned = _mentioned(now)
    with_new = mentioned.join(mentioned.join(new, "name", "left_semi").select("ticker").distinct(), "ticker", "left_semi")
    found = G.edges(with_new, is_now, 1)
    of_new = found.join(new.select(F.col("name").alias("source"), F.lit(True).alias("a")), "source", "left").join(new.select(F.col("name").alias("target"), F.lit(True).alias("b")), "target", "left")
    of_new = of_new.filter(F.col("a").isNotNull() | F.col("b").isNotNull()).select("source", "target", F.col("weight").alias("n"))
    _counted(weights.unionByName(of_new), ["source", "target"], "weight").write.parquet(f"{made}/pairs")
    return _finish(spark, root, _number(old.folder) + 1, made)


def derived(generation: Generation, min_weight: int = 5, top: int | None = None) -> dict[str, DataFrame]:
    """index, totals, nodes, edges, theme_entries, theme_sizes, theme_related, theme_index of a generation."""
    spark = generation.spark
    counts, frequency = generation.table("counts"), generation.table("frequency")
    if top:
        edge = G.edges(_mentioned(generation.table("parsed")), G.kept_names(frequency, top), min_weight)
    else:
        edge = generation.table("pairs").filter(F.col("weight") >= min_weight)
    themes, groups = dims.themes(spark), dims.theme_groups(spark)
    entry = generation.table("parsed").select("ticker", "company", "sector", F.inline("entries")).select("name", "ticker", "company", "sector", "role")
    found = TH.theme_entries(entry, themes)
    sizes = TH.theme_sizes(found)
    return {
        "index": I.entity_index(counts),
        "totals": I.category_totals(counts),
        "nodes": G.nodes(frequency, edge),
        "edges": edge,
        "theme_entries": found,
        "theme_sizes": sizes,
        "theme_related": TH.related(entry, themes),
        "theme_index": TH.theme_index(sizes, groups),
    }
