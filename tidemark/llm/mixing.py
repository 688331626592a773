"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree. DataFrame functions only.

Documents are cut into blocks of at most BLOCK words. The blocks of a source stand in a random but fixed order, that of a hash;
a source gives the mix as many blocks from the front of its order as bring its words nearest its target, passing over all of
them again where its target is above its size. The tree then halves the output shards again and again: at each node the exact
number of blocks of every source that go left is drawn from the multivariate hypergeometric distribution, as if the node's
blocks were dealt blindly. Each shard draws its quota of a source as the next blocks in the source's order, so shards are disjoint
and every shard holds the mix. Within its shard a block stands where a second hash puts it.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, broadcast_if_few, cut_lineage, pick, set_aside, table

BLOCK = 256
#: Buckets of a source at least, and blocks that a bucket of a source of all words would hold.
BUCKETS, BUCKET_BLOCKS = 1024, 100_000
SHARDS = 8
SEED = 20240611
#: A source's target is at most so many times its size.
MOST = 3


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, copy: one row for each document; copy numbers those that agree in all three."""
    counted = pick(docs, "doc_id", "source", "text").select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    return counted.groupBy("doc_id", "source", "size").count().select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("copy"))


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_no, source_size, target of every source, one row each.

    Sources by code point, null last, weigh 1, 2, 3 and so on; together they get all words. A target stops at MOST times the
    source's size and the excess goes to the others by weight: the least level at which min(level * weight, cap) sums to all.
    """
    every = Window.partitionBy()
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = src.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    src = src.withColumn("weight", (F.col("source_no") % 3 + 1).cast("long")).withColumn("cap", F.col("source_size") * MOST).withColumn("total", F.sum("source_size").over(every))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    src = src.withColumn("left_words", F.col("total") - F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    src = src.withColumn("left_weight", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
    src = src.withColumn("free", F.col("left_words") * F.col("weight") <= F.col("cap") * F.col("left_weight"))
    free_words = F.col("total") - F.coalesce(F.sum(F.when(~F.col("free"), F.col("cap"))).over(every), F.lit(0))
    share = free_words * F.col("weight") / F.sum(F.when(F.col("free"), F.col("weight"))).over(every)
    return src.select("source", "source_no", "source_size", F.when(F.col("free"), share).otherwise(F.col("cap").cast("double")).alias("target"))


def _hypergeometric(good: int, total: int, n: int, rng: random.Random) -> int:
    """How many of n drawn from total are among the good ones: inversion from the mode outwards, in expected steps of one deviation."""
    lo, hi = max(0, n + good - total), min(n, good)
    if lo == hi:
        return lo
    mode = min(hi, max(lo, (n + 1) * (good + 1) // (total + 2)))
    choose = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    p = math.exp(choose(good, mode) + choose(total - good, n - mode) - choose(total, n))
    u, up, down, p_up, p_down = rng.random() - p, mode, mode, p, p
    while u > 0 and (up < hi or down > lo):
        if up < hi:
            p_up *= (good - up) * (n - up) / ((up + 1) * (total - good - n + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > lo:
            p_down *= down * (total - good - n + down) / ((good - down + 1) * (n - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
        if p_up < 1e-300 and p_down < 1e-300:
            break
    return mode


def split_quotas(quotas: list[int], shards: int, seed: int = SEED) -> list[list[int]]:
    """For each shard the number of blocks of every source; shards differ by one block at most, sums are exact.

    Plain arithmetic over one number for each source and shard, the only thing that the driver holds.
    """
    rng = random.Random(seed)

    def split(node: list[int], n: int) -> list[list[int]]:
        if n == 1:
            return [node]
        total, left = sum(node), n // 2
        room = total * left // n
        mine, rest_total, rest_room = [], total, room
        for k in node:
            x = _hypergeometric(k, rest_total, rest_room, rng)
            mine.append(x)
            rest_total, rest_room = rest_total - k, rest_room - x
        return split(mine, left) + split([a - b for a, b in zip(node, mine, strict=True)], n - left)

    return split(list(quotas), shards)


def mix(docs: DataFrame, shards: int = SHARDS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """All blocks of all documents, the taken ones with a shard and an order within it.

    Columns: doc_id, source, source_no, source_size, target, size, copy, block (its number in the document), pass (0 for the first
    time), words, taken, shard (null if not taken), place (order within a shard).

    The order of blocks depends on doc_id, size, copy, block and pass only, so reruns agree. Null and blank texts are a block of no words;
    rows that agree in doc_id, source and size are told apart by number. A hot source is dealt over buckets, the more the more words there
    are, whose sums give each block its place; no task holds a source.
    """
    sizes = cut_lineage(sized(docs))
    want = cut_lineage(targets(sizes))
    total = want.agg(F.sum("source_size")).first()[0] or 0
    buckets = max(BUCKETS, 1 << (total // block // BUCKET_BLOCKS).bit_length())
    passes = F.greatest(F.lit(1), F.ceil(F.col("target") / F.nullif("source_size", F.lit(0))).cast("int"))
    # Sources are matched null-safe. Their table has a row for each source; while these are few it goes to every task, so that a hot source stays where it is.
    want = broadcast_if_few(want)
    with_target = sizes.join(want, sizes.source.eqNullSafe(want.source)).drop(want.source)
    rows = with_target.withColumn("pass", F.explode(F.sequence(F.lit(0), F.coalesce(passes, F.lit(1)) - 1)))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("size") / block) - 1).cast("int"))))
    rows = rows.withColumn("words", F.least(F.lit(block), F.col("size") - F.col("block") * block))
    rows = rows.withColumn("hash", F.xxhash64(F.lit(seed), "pass", "doc_id", "size", "copy", "block")).withColumn("bucket", F.pmod("hash", F.lit(buckets)))
    key = ["source_no", "pass", "bucket"]
    by_source = Window.partitionBy("source_no").orderBy("pass", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*key).agg(F.sum("words").alias("w"), F.count("*").alias("n"))
    sums = sums.select(*key, F.coalesce(F.sum("w").over(by_source), F.lit(0)).alias("words_before"), F.coalesce(F.sum("n").over(by_source), F.lit(0)).alias("blocks_before"))
    within = Window.partitionBy(*key).orderBy("hash", "doc_id", "size", "copy", "block")
    placed = rows.withColumn("rank", F.row_number().over(within) - 1).withColumn("upto", F.sum("words").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(sums, key).withColumn("after", F.col("words_before") + F.col("upto"))
    before = F.col("after") - F.col("words")
    taken = (before < F.col("target")) & ((F.col("after") <= F.col("target")) | (F.col("after") - F.col("target") <= F.col("target") - before))
    placed = cut_lineage(placed.select("doc_id", "source", "source_no", "source_size", "target", "size", "copy", "block", "pass", "words", "hash", taken.alias("taken"), (F.col("blocks_before") + F.col("rank")).alias("at")))
    quotas = dict(placed.filter("taken").groupBy("source_no").count().collect())
    dealt = split_quotas([quotas.get(i, 0) for i in range(max(quotas, default=-1) + 1)], shards, seed)
    ends = [{"source_no": i, "ends": [sum(d[i] for d in dealt[: j + 1]) for j in range(shards)]} for i in range(len(dealt[0]) if dealt else 0)]
    quota = docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(ends)), "array<struct<source_no int, ends array<long>>>")))
    out = placed.join(quota, "source_no", "left")
    shard = F.when(F.col("taken"), F.size(F.filter("ends", lambda e: e <= F.col("at"))))
    return out.withColumn("shard", shard).withColumn("place", F.xxhash64(F.lit(seed + 1), "hash")).drop("ends", "hash", "at")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix by whole documents, with all their columns: each as many times as it was drawn, none that was not.

    A block is a document here, so that no text is cut; a source's words then miss its target by half a document at most. Rows come in the
    tree's order: shard by shard, each shuffled, so that files written of them are the shards one after the other.
    """
    renamed, back = set_aside(docs, ["size", "copy", "shard", "place", *(f"drawn_{k}" for k in ("doc_id", "source", "size", "copy"))])
    drawn = mix(docs, block=1 << 30).filter("taken").select(*(F.col(k).alias(f"drawn_{k}") for k in ("doc_id", "source", "size", "copy")), "shard", "place")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = renamed.withColumn("size", size).withColumn("copy", F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy("text")))
    same = F.col("doc_id").eqNullSafe(F.col("drawn_doc_id")) & F.col("source").eqNullSafe(F.col("drawn_source")) & (F.col("size") == F.col("drawn_size")) & (F.col("copy") == F.col("drawn_copy"))
    placed = rows.join(drawn, same).repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
    return placed.select(*renamed.columns).withColumnsRenamed(back)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = mix(table(spark, sf_dir, "documents"))
    by_doc = blocks.groupBy("doc_id", "source_no", "size", "copy").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sum(F.when(F.col("taken"), F.col("words")).otherwise(0)).alias("taken"), F.sort_array(F.collect_set("shard")).alias("shards")
    )
    return by_doc.select("doc_id", "size", "source_size", "target", "taken", "shards")
