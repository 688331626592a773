"""Queries over the driver's tables: the operators on links of pages, documents, orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import dims
from tidemark.functions import numbers as N
from tidemark.functions import text as T
from tidemark.operators import graph as G
from tidemark.streaming.refresh import event_counts

LINK = r'<a href="([^"]+)"'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, name: all links of all pages."""
    return table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("name"))


def link_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(spark, sf_dir).groupBy("name").agg(F.count("*").alias("count"))


def link_doc_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.kept_names(G.document_frequency(links(spark, sf_dir), "page_id"))


def link_graph(spark: SparkSession, sf_dir: str, min_weight: int = 2) -> DataFrame:
    m = links(spark, sf_dir)
    return G.edges(m, G.kept_names(G.document_frequency(m, "page_id")), min_weight, "page_id")


def link_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = links(spark, sf_dir)
    return G.nodes(G.document_frequency(m, "page_id"), link_graph(spark, sf_dir))


def link_topn_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = links(spark, sf_dir)
    return G.edges(m, G.kept_names(G.document_frequency(m, "page_id"), top=50), 1, "page_id")


def link_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.neighbours(link_graph(spark, sf_dir), "/the")


def link_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.scales(link_nodes(spark, sf_dir), link_graph(spark, sf_dir))


def link_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.view(link_nodes(spark, sf_dir), link_graph(spark, sf_dir), 3, 5, "TH")[0]


def index_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with other than ASCII letters above the CJK share count as one kind, which like the rest needs two mentions; short names do not."""
    other = F.regexp_count("name", F.lit(r"[^\x00-\x7F]")) > dims.CJK_SHARE * F.char_length("name")
    kind = F.when(F.char_length("name") <= 4, "short").when(other, "accented").otherwise("plain")
    rows = link_counts(spark, sf_dir).withColumn("kind", kind).filter((F.col("kind") == "short") | (F.col("count") >= 2))
    w = Window.partitionBy("kind")
    return rows.select("kind", "name", "count", F.row_number().over(w.orderBy(F.desc("count"), "name")).cast("long").alias("place"), F.count("*").over(w).alias("total"))


def role_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The role algorithm with words for marks: which of three stands in the last 100 characters before a term's first occurrence."""
    text, term = F.col("text"), "tion"
    at = F.position(F.lit(term), text)
    before = F.right(F.left(text, at - 1), F.lit(dims.ROLE_REACH))
    role = F.when((at > 0) & before.contains("the "), "upstream").when((at > 0) & before.contains("of "), "downstream").when((at > 0) & before.contains("and "), "midstream").otherwise("related")
    return table(spark, sf_dir, "documents").groupBy(role.alias("role"), "lang").agg(F.count("*").alias("documents"))


def keyword_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", T.linked_count(text, "ing").cast("long").alias("linked"), T.bare_count(text, "ing").cast("long").alias("bare"), text)
    rows = rows.filter((F.col("linked") > 0) | (F.col("bare") > 0))
    role = F.when(F.split("text", "\n")[0].contains("ing"), "first_line").otherwise("mentioned")
    return rows.select("doc_id", "source", "linked", "bare", role.alias("role"))


def discovery_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyword_discovery(spark, sf_dir).groupBy("role").agg(F.count("*").alias("documents"), F.count_if(F.col("bare") > 0).alias("unlinked"), F.sum("bare").alias("bare"))


def snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", T.snippets(F.col("text"), "tion").alias("contexts"))
    return rows.filter(F.size("contexts") > 0).select("doc_id", F.size("contexts").cast("long").alias("n"), F.array_join("contexts", "|").alias("contexts"))


def audit_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule flags of documents and a bucket, by language."""
    text = F.col("text")
    lines = F.split(text, "\n")
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    short = F.char_length(text) < dims.MIN_CHARS
    marked = F.exists(F.array(F.lit("$$$"), F.lit("###")), lambda p: text.contains(p))
    lined = F.size(F.filter(F.slice(lines, 1, dims.ENGLISH_LINES), lambda x: T.strip(x) != "")) < 3
    bucket = F.when(short | marked, "ENRICHMENT").when(lined, "QUALITY_FIX").otherwise("CLEAN")
    return docs.select("doc_id", "lang", short.alias("short"), marked.alias("marked"), lined.alias("thin"), bucket.alias("bucket"), F.coalesce("quality", F.lit(-1)).cast("long").alias("quality"))


def audit_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    agg = audit_docs(spark, sf_dir).rollup("lang").agg(F.count("*").alias("documents"), *[F.count_if(F.col("bucket") == b).alias(b.lower()) for b in ("CLEAN", "ENRICHMENT", "QUALITY_FIX")])
    return agg.withColumn("score", F.round(N.share(F.col("clean"), F.col("documents")), 2))


def batch_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    return docs.join(labels, "doc_id", "left_anti").select("doc_id", F.lit("unlabelled").alias("side")).unionByName(labels.join(docs, "doc_id", "left_anti").select("doc_id", F.lit("unknown").alias("side")))


ALIASES = {"/the": "/The", "/of": "/Of", "/and": "/And", "/der": "/Der"}


def alias_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = F.create_map(*[F.lit(x) for kv in ALIASES.items() for x in kv])
    return links(spark, sf_dir).groupBy(F.coalesce(aliases[F.col("name")], F.col("name")).alias("name")).agg(F.count("*").alias("count"), F.count_distinct("page_id").alias("pages"))


def theme_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    themes = spark.createDataFrame([("articles", ["/the", "/der", "/la", "/el"]), ("links", ["/of", "/and", "/nowhere", "/und"])], "tag string, related array<string>")
    listed = themes.select("tag", F.posexplode("related").alias("pos", "related"))
    counts = G.document_frequency(links(spark, sf_dir), "page_id").withColumnRenamed("name", "related")
    return F.broadcast(listed).join(counts, "related").select("tag", F.col("pos").cast("long").alias("pos"), "related", F.col("count").alias("companies"))


def theme_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of names with the counts of those that occur; a group keeps a row if none does."""
    groups = spark.createDataFrame([(0, "a", ["/the", "/of"]), (1, "b", ["/nowhere"]), (2, "c", ["/the", "/und"])], "ord int, group string, tags array<string>")
    counts = G.document_frequency(links(spark, sf_dir), "page_id")
    built = groups.select("ord", F.explode("tags").alias("name")).join(counts, "name")
    return F.broadcast(groups).select(F.col("ord").cast("long").alias("ord"), "group").join(built.select("ord", F.col("name").alias("tag"), F.col("count").alias("companies")), "ord", "left")


def stmt_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's latest three years with orders, in thousands."""
    years = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("period")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    w = Window.partitionBy("o_custkey").orderBy(F.desc("period"))
    top = years.withColumn("rank", F.row_number().over(w).cast("long")).filter("rank <= 3")
    return top.select("o_custkey", "period", "rank", F.round((F.col("v") / 1000).cast("double"), 3).alias("revenue_k"))


def quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    money = lambda c: c.cast("decimal(24,4)")
    price = money(F.col("l_extendedprice"))
    cost = F.when(F.col("l_returnflag") != "R", money(F.col("l_extendedprice") * F.col("l_discount")))
    # Added up by order before the join.
    sums = [F.sum(price).alias("revenue"), F.sum(cost).alias("selling"), F.sum(F.when(F.col("l_linestatus") == "F", price)).alias("gross")]
    joined = items.groupBy("l_orderkey").agg(*sums).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    by = joined.groupBy(F.col("o_orderpriority").alias("segment"), F.date_trunc("quarter", "o_orderdate").cast("date").alias("period"))
    return by.agg(*[F.sum(k).alias(k) for k in ("revenue", "selling", "gross")])


def stmt_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Margins of quarters, with a gap filled from the other figures."""
    rows = quarters(spark, sf_dir)
    filled = F.coalesce("gross", F.col("revenue") - F.col("selling"))
    return rows.select("segment", F.date_format("period", "yyyy-MM-dd").alias("period"), F.round(N.margin(filled.cast("double"), F.col("revenue").cast("double")), 4).alias("gross_margin"), F.round(N.margin(F.col("selling").cast("double"), F.nullif(F.col("revenue").cast("double"), F.lit(0.0))), 4).alias("selling_margin"))


def stmt_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").cast("long").alias("period")).agg(*[F.count_if(F.col("o_orderstatus") == s).alias(f"status_{s.lower()}") for s in ("F", "O", "P")])


def stmt_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = stmt_pivot(spark, sf_dir)
    return wide.unpivot("period", ["status_f", "status_o", "status_p"], "metric", "value")


def exclusion_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").filter("o_totalprice > 300000")
    return customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").filter(F.col("c_mktsegment") != "MACHINERY").select("c_custkey", "c_name")


def enrich_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the patch of their largest order, where there is a large one."""
    orders = table(spark, sf_dir, "orders").filter("o_totalprice > 300000").groupBy("o_custkey").agg(F.max_by("o_orderpriority", F.struct("o_totalprice", "o_orderkey")).alias("patch"))
    customers = table(spark, sf_dir, "customer")
    joined = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", F.coalesce("patch", "c_mktsegment").alias("segment"), F.when(F.col("patch").isNull(), "unchanged").otherwise("updated").alias("status"))


def enrich_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_upsert(spark, sf_dir).groupBy("status").agg(F.count("*").alias("reports"))


def json_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k long").alias("p"))
    return events.groupBy("event_type").agg(F.count("p.k").alias("patched"), F.sum("p.k").alias("k_sum"), F.min("p.k").alias("k_min"), F.max("p.k").alias("k_max"))


def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")), table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    named = lambda df, name: df.select("k", F.lit(name).alias("op"))
    return named(part.union(supplier).distinct(), "union").unionByName(named(part.intersect(supplier), "intersect")).unionByName(named(part.exceptAll(supplier), "except"))


def page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", F.nullif(F.regexp_extract(html, r"<title>([^<]*)</title>", 1), F.lit("")).alias("title"), F.nullif(F.regexp_extract(html, r'<html lang="([a-z]+)"', 1), F.lit("")).alias("lang"))


def sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.file_name(F.col("url")).alias("file"), T.page_name(F.col("url")).alias("page"))


def format_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select("o_orderkey", N.grouped(v).alias("grouped"), N.plain(v).alias("plain"), N.millions(v * 1000).alias("millions"))


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(18,4)"))
    return event_counts(events).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round(F.col("total").cast("double"), 2).alias("total"))


def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("last_order"))


def scoped_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scope of sectors, matched in any case, over customers."""
    rows = table(spark, sf_dir, "customer").filter(F.lower("c_mktsegment").isin("building", "automobile"))
    return rows.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name", "c_mktsegment").agg(F.count("*").alias("customers"))


def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.filter(F.split(T.strip(text), "\n"), lambda x: T.strip(x) != "")).cast("long").alias("full_lines"), F.char_length(text).cast("long").alias("chars"))
