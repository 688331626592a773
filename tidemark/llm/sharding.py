"""Sharding by a k-d tree. DataFrame functions only.

The law is `bytes`: shards are near equal in bytes. Rows with equal texts are a group and stay in one shard. Space is spanned by what
can be told from a text alone (so a group is one point): size in bytes, bytes a character, lines. Nodes are split along their
widest dimension (of 256 steps between the node's least and greatest value; ties by a hash of the text) at the weighted median,
found from a histogram of at most 65,536 cells a node, again within the cell that holds it until that is small, and then exactly.

Large groups, over a hundredth of a shard, would make medians coarse. There are fewer than 100 a shard; each goes to the shard with the most room
first, and the medians are weighted so that every leaf gets what room is left. Only a group larger than a whole shard, which
no shard can hold at equal sizes, is spread over shards, by doc_id.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, pick, table

SHARDS = 8
STEPS = 256
DIMS = ("dim0", "dim1", "dim2")
_HASH_BITS = 48
PARTS = 256
#: Groups of a cell that are sorted to find a median exactly; larger cells are cut again.
CELL = 1 << 16


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, a hash of the text, and its dimensions. A null text has size 1, crc32 0, as an empty one, but is another group."""
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    return pick(docs, "doc_id", "text").select(
        "doc_id",
        size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col("text").isNull(), text).alias("hash"),
        F.log2(size.cast("double")).alias("dim0"),
        (F.octet_length(text) / F.greatest(F.char_length(text), F.lit(1))).alias("dim1"),
        F.log2((F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("double")).alias("dim2"),
    )


def place_heavy(heavy: list[tuple[int, int]], total: int, shards: int) -> tuple[dict[int, list[tuple[float, int]]], list[float]]:
    """For each heavy group its shards with the share of its rows up to each; and the room left in every shard."""
    room = [total / shards] * shards
    out = {}
    for group, size in sorted(heavy, key=lambda x: (-x[1], x[0])):
        best = max(range(shards), key=lambda j: room[j])
        if size <= total / shards:
            room[best] -= size
            out[group] = [(1.0, best)]
            continue
        parts, left = [], float(size)
        for j in sorted(range(shards), key=lambda j: -room[j]):
            part = min(left, max(room[j], 0.0))
            if part > 0:
                parts.append((part, j))
                room[j] -= part
                left -= part
        scale, upto = sum(p for p, _ in parts), 0.0
        out[group] = []
        for p, j in parts:
            upto += p / scale
            out[group].append((upto, j))
        out[group][-1] = (1.0, out[group][-1][1])
    return out, room


def _split_key(low: float, high: float, dim: str) -> Column:
    step = F.least(F.lit(STEPS - 1), F.floor((F.col(dim) - low) / (high - low) * STEPS)) if high > low else F.lit(0)
    return F.shiftleft(step.cast("long"), _HASH_BITS) + F.shiftrightunsigned("hash", 64 - _HASH_BITS)


def _by_node(nodes: dict[int, Column]) -> Column:
    out = None
    for n, c in nodes.items():
        out = F.when(F.col("node") == n, c) if out is None else out.when(F.col("node") == n, c)
    return out


def kd_tree(groups: DataFrame, room: list[float]) -> list[tuple[DataFrame, dict]]:
    """The cuts of each level, {node: (dimension's key, cut)}; nodes are numbered as in a heap, leaves are shards in order.

    groups has a row for each group: hash, bytes and the dimensions. At each level the driver gets a few numbers a node.
    """
    ranges = groups.agg(*[f(d).alias(f"{f.__name__}_{d}") for d in DIMS for f in (F.min, F.max)]).first()
    span = {d: (ranges[f"max_{d}"] or 0) - (ranges[f"min_{d}"] or 0) or 1 for d in DIMS}
    leaves = {1: list(range(len(room)))}
    levels: list[dict[int, tuple[Column, int]]] = []
    now = groups.withColumn("node", F.lit(1))
    while any(len(x) > 1 for x in leaves.values()):
        stats = {r.node: r for r in now.groupBy("node").agg(F.sum("bytes").alias("bytes"), *[f(d).alias(f"{f.__name__}_{d}") for d in DIMS for f in (F.min, F.max)]).collect()}
        keys, goal = {}, {}
        for n, r in stats.items():
            if len(leaves[n]) > 1:
                dim = max(DIMS, key=lambda d: (r[f"max_{d}"] - r[f"min_{d}"]) / span[d])
                keys[n] = _split_key(r[f"min_{dim}"], r[f"max_{dim}"], dim)
                half = leaves[n][: len(leaves[n]) // 2]
                whole = sum(max(room[j], 0) for j in leaves[n])
                goal[n] = r.bytes * (sum(max(room[j], 0) for j in half) / whole if whole > 0 else 0.5)
        cuts: dict[int, int] = {}
        if keys:
            aim = _by_node({n: F.lit(float(g)) for n, g in goal.items()})
            keyed = now.withColumn("key", _by_node(keys)).filter("key is not null").select("node", "key", "bytes")
            at, shift = {}, _HASH_BITS - 8
            while True:
                cell = F.shiftright("key", shift)
                within = keyed.filter(F.shiftright("key", shift + 16) == _by_node({n: F.lit(c) for n, (c, *_) in at.items()})) if at else keyed
                hist = within.groupBy("node", cell.alias("cell")).agg(F.sum("bytes").alias("b"), F.count("*").alias("n"))
                start = _by_node({n: F.lit(b) for n, (_, b, _) in at.items()}) if at else F.lit(0)
                hist = hist.withColumn("before", start + F.coalesce(F.sum("b").over(Window.partitionBy("node").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                found = hist.filter(F.col("before") <= aim).groupBy("node").agg(F.max_by(F.struct("cell", "before", "n"), "cell").alias("x")).select("node", "x.*").collect()
                at = {r.node: (r.cell, r.before, r.n) for r in found}
                if not shift or max(n for *_, n in at.values()) <= CELL:
                    break
                # The next 16 bits of the key, within the cells that hold the medians.
                shift = max(0, shift - 16)
            inside = keyed.filter(cell == _by_node({n: F.lit(c) for n, (c, *_) in at.items()}))
            inside = inside.groupBy("node", "key").agg(F.sum("bytes").alias("bytes"))
            upto = F.sum("bytes").over(Window.partitionBy("node").orderBy("key")) + _by_node({n: F.lit(b) for n, (_, b, _) in at.items()})
            off = F.abs(upto - aim)
            best = {r.node: r for r in inside.withColumn("upto", upto).withColumn("off", off).groupBy("node").agg(F.min_by(F.struct("key", "off"), F.struct("off", "key")).alias("x")).select("node", "x.*").collect()}
            for n, r in best.items():
                cell_start = at[n][0] << shift
                cuts[n] = r.key if r.off < abs(at[n][1] - goal[n]) else cell_start - 1
        level = {n: (keys[n], cuts[n]) for n in cuts}
        levels.append(level)
        leaves = {m: x for n, old in leaves.items() for m, x in ((2 * n, old[: (len(old) + 1) // 2] if len(old) == 1 else old[: len(old) // 2]), (2 * n + 1, old[len(old) // 2 :] if len(old) > 1 else []))}
        now = descend(now, level)
    return levels


def descend(df: DataFrame, level: dict[int, tuple[Column, int]]) -> DataFrame:
    side = _by_node({n: F.when(key > cut, 1).otherwise(0) for n, (key, cut) in level.items()}) if level else F.lit(0)
    return df.withColumn("node", F.col("node") * 2 + F.coalesce(side, F.lit(0)))


def _numbered(rows: DataFrame, by: str) -> DataFrame:
    """Adds number, gapless from 0 in each group: a place in the row's part of it, on top of the sizes of the parts before.

    There are few groups, and at most PARTS sums for each.
    """
    counts = rows.groupBy(by, "part").count()
    first = counts.select(by, "part", F.coalesce(F.sum("count").over(Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    at = F.row_number().over(Window.partitionBy(by, "part").orderBy("doc_id", "hash")) - 1
    return rows.withColumn("at", at).join(F.broadcast(first), [by, "part"]).withColumn("number", (F.col("first") + F.col("at")).cast("long")).drop("at", "first")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 within the shard) of every row.

    shards is a power of two. Repeated rows each get a slot; equal texts share a shard unless they alone outweigh one. An empty
    table gives none. Other columns are ignored. Slots come from the sums of PARTS parts a shard and an order within each part.
    """
    if shards & (shards - 1):
        raise ValueError("shards must be a power of two")
    rows = cut_lineage(measured(docs))
    groups = cut_lineage(rows.groupBy("hash", *DIMS).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    # Fewer than 100 groups a shard can be so large.
    large = {r.hash: r for r in groups.filter(F.col("bytes") * 100 * shards > total).select("hash", "bytes", "rows").collect()}
    heavy, room = place_heavy([(r.hash, r.bytes) for r in large.values()], total, shards)
    placed = rows.withColumn("node", F.lit(1))
    for level in kd_tree(groups.filter(F.col("bytes") * 100 * shards <= total), room):
        placed = descend(placed, level)
    listed = [{"hash": g, "rows": large[g].rows, "upto": [u for u, _ in parts], "to": [j for _, j in parts]} for g, parts in heavy.items()]
    known = docs.sparkSession.range(1).select(F.inline(F.from_json(F.lit(json.dumps(listed)), "array<struct<hash long, rows long, upto array<double>, to array<int>>>")))
    joined = placed.join(F.broadcast(known), "hash", "left").withColumn("part", F.pmod(F.xxhash64("doc_id", "hash"), F.lit(PARTS)))
    columns = ["doc_id", "size", "text_crc32", "hash", F.col("shard").cast("int").alias("shard"), "part"]
    parts_of = F.coalesce(F.size("to"), F.lit(0))
    done = joined.filter(parts_of < 2).withColumn("shard", F.coalesce(F.get("to", F.lit(0)), F.col("node") - shards)).select(*columns)
    if any(len(parts) > 1 for parts in heavy.values()):
        # Rows of a group that no shard can hold are numbered; the shards get shares of the numbers.
        share = (F.col("number") + 0.5) / F.col("rows")
        spot = F.element_at("to", F.least(F.size("to"), F.size(F.filter("upto", lambda u: u <= share)) + 1))
        done = done.unionByName(_numbered(joined.filter(parts_of > 1), "hash").withColumn("shard", spot).select(*columns))
    return _numbered(done, "shard").select("doc_id", "size", "text_crc32", "shard", F.col("number").alias("slot"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = shard(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
