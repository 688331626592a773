"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are grouped into tiles by the population counts of their first two quarters, within a tile by those of the last two. Two
fingerprints within the radius have counts that differ by no more than the radius over all quarters, so only such parts of tiles are
compared: numpy exclusive-or and bit counts. Tiles are files in the shared folder; what is shuffled are pairs of their numbers. Each task keeps a union-find over the links it sees and gives one edge for
each linked fingerprint, not one for each pair; components follow by random contraction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import arrays, hash_store
from .common import broadcast_if_few, cut_lineage, new_folder, pick, set_aside, table

RADIUS = 4
SHINGLE = 4
#: Fingerprints of a tile, and near tiles that a task takes with one at a time.
TILE, PARTNERS = 1 << 16, 8
SEED = 42
#: Comparisons at a time.
STRIP = 1 << 18


def _fingerprints(buf: np.ndarray, offsets: np.ndarray, shingle: int, words: int = 1, sets: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprint of each text of a chunk, so many 64-bit words, zero without words; and its number of shingles.

    The first word votes with the shingles' hashes, the others with hashes of those. With a list for sets, each different shingle
    votes and counts once, and the list gets the sorted hashes of each text.
    """
    lower = arrays.LOWER[buf]
    starts, ends, first = arrays.spans(lower, offsets)
    out, shingles = np.zeros((len(offsets) - 1, words), np.uint64), np.zeros(len(offsets) - 1, np.int64)
    if sets is not None:
        sets += [np.zeros(0, np.uint64)] * len(out)
    if not len(starts):
        return out, shingles
    # Words joined by one blank: where each word then starts and ends.
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts + 1, out=at[1:])
    joined = np.full(at[-1], 0x20, np.uint8)
    inside = np.zeros(len(lower) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    keep = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    filled = np.ones(at[-1], bool)
    filled[at[1:] - 1] = False
    joined[filled] = lower[keep]
    raw = joined.tobytes()
    hash64 = xxhash.xxh64_intdigest
    for i in range(len(out)):
        a, b = first[i], first[i + 1]
        if a == b:
            continue
        n = max(1, b - a - shingle + 1)
        begins, stops = at[a : a + n].tolist(), (at[min(a + shingle, b) : b + 1] - 1).tolist()
        h = np.array([hash64(raw[s:e], SEED) for s, e in zip(begins, stops, strict=True)], np.uint64)
        if sets is not None:
            h = np.unique(h)
            sets[i - len(out)], n = h, len(h)
        shingles[i] = n
        for w in range(words):
            votes = h if w == 0 else arrays.mix(h + np.uint64(w * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            ones = np.zeros(64, np.int64)
            for lo in range(0, n, 4096):
                ones += np.unpackbits(votes[lo : lo + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            out[i, w] = np.packbits(ones * 2 > n).view(">u8")[0]
    return out, shingles


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint (a signed long of the 64 bits) of every whole text. Null and blank texts have zero. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_fingerprints(buf, offsets, shingle)[0].ravel() for *_, buf, offsets in arrays.chunks(batch.column("text"))]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(found).view(np.int64))], names=["doc_id", "fp"])

    return pick(docs, "doc_id", "text").mapInArrow(run, docs.select("doc_id").schema.add("fp", "long"))


class Forest:
    """Union-find whose roots are the least members."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while (y := up.get(top, top)) != top:
            top = y
        while x != top:
            up[x], x = top, up.get(x, x)
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def stars(self) -> tuple[list[int], list[int]]:
        members = list(self.up)
        return members, [self.root(x) for x in members]


def join_near(near: np.ndarray, rows: np.ndarray, cols: np.ndarray, label: np.ndarray) -> None:
    """Gives nodes that a row of flags joins one label, the least of theirs. Rows and columns say which node each is.

    Work is by rows, and by labels that meet, not by pairs: in a crowd the first row joins all that it is near.
    """
    for i in np.flatnonzero(near.any(axis=1)).tolist():
        met = label[cols[near[i]]]
        own = label[rows[i]]
        if (met != own).any():
            met = np.unique(np.append(met, own))
            if len(met) == 2:
                label[label == met[1]] = met[0]
            else:
                label[np.isin(label, met)] = met[0]


def _pass_on(ids: np.ndarray, label: np.ndarray, forest: Forest) -> None:
    """One edge for each node that got another's label."""
    linked = np.flatnonzero(label != np.arange(len(label)))
    for a, b in zip(ids[linked].tolist(), ids[label[linked]].tolist(), strict=True):
        if a != b:
            forest.join(a, b)


def link_tile(left: np.ndarray, right: np.ndarray, radius: int, forest: Forest) -> None:
    """Joins all pairs within the radius, a strip of rows at a time."""
    ids = np.unique(np.concatenate((left, right)))
    label, at, to = np.arange(len(ids)), np.searchsorted(ids, left), np.searchsorted(ids, right)
    rows_a_strip = max(1, STRIP // max(1, len(right)))
    for lo in range(0, len(left), rows_a_strip):
        near = np.bitwise_count(left[lo : lo + rows_a_strip, None] ^ right[None, :]) <= radius
        join_near(near, at[lo : lo + rows_a_strip], to, label)
    _pass_on(ids, label, forest)


def _stars(forest: Forest) -> Iterator[pa.RecordBatch]:
    members, roots = forest.stars()
    for lo in range(0, len(members), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(np.array(x[lo : lo + 10_000], np.uint64).view(np.int64)) for x in (members, roots)], names=["u", "v"])


def _near_runs(cd: np.ndarray, fps: np.ndarray, c: int, d: int, reach: int, onward: bool) -> list[np.ndarray]:
    """Fingerprints, in order of the counts of their last two quarters, within reach of the counts c and d; onward: of the same and later counts only."""
    out = []
    for step in range(0 if onward else -reach, reach + 1):
        if 0 <= c + step <= 16:
            side = reach - abs(step)
            low = d if onward and not step else max(0, d - side)
            first, last = (c + step) * 17 + low, (c + step) * 17 + min(16, d + side)
            at, end = np.searchsorted(cd, first), np.searchsorted(cd, last, "right")
            if at < end:
                out.append(fps[at:end])
    return out


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) among distinct fingerprints, column fp, that connect just those connected by links within the radius.

    A tile has one count of each of the first two quarters and is a file in the shared folder, in order of the counts of the last two.
    What is dealt to tasks are numbers of tiles: one, and up to PARTNERS that are near, so no fingerprint is shuffled more than once.
    """
    spark = distinct.sparkSession
    folder = new_folder(spark, "simhash-quarters")
    a, b, c, d = (F.bit_count(F.shiftrightunsigned("fp", k).bitwiseAND(F.lit(0xFFFF))) for k in (48, 32, 16, 0))
    keyed = distinct.select("fp", a.alias("a"), b.alias("b"), (c * 17 + d).cast("int").alias("cd"))
    # At most 17 ** 2 = 289 rows.
    sizes = cut_lineage(keyed.groupBy("a", "b").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks")))
    dealt = keyed.join(F.broadcast(sizes), ["a", "b"]).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    name = lambda t: f"quarters{t['a']}-{t['b']}-{t['block']}"

    def write(group: pa.Table) -> pa.Table:
        tile = {x: group.column(x)[0].as_py() for x in ("a", "b", "block")}
        fps, cd = group.column("fp").to_numpy().view(np.uint64), group.column("cd").to_numpy()
        order = np.argsort(cd, kind="stable")
        hash_store.write(folder, name(tile), cd[order], [("<u8", fps[order])])
        return pa.table({x: pa.array([v], pa.int32()) for x, v in tile.items()})

    def read(tile: dict) -> tuple[np.ndarray, np.ndarray]:
        cd, (fps,) = hash_store.mapped(folder, name(tile), ("<u8",))
        return cd.astype(np.int64), np.array(fps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for own, others in zip(batch.column("own").to_pylist(), batch.column("others").to_pylist(), strict=True):
                counts, left = read(own)
                near = [(*read(x), radius - abs(x["a"] - own["a"]) - abs(x["b"] - own["b"]), x == own) for x in others]
                at, length = arrays.runs(counts)
                for i, n in zip(at.tolist(), length.tolist(), strict=True):
                    c, d = divmod(int(counts[i]), 17)
                    right = [x for cd, fps, reach, same in near for x in _near_runs(cd, fps, c, d, reach, same)]
                    if right:
                        link_tile(left[i : i + n], np.concatenate(right), radius, forest)
        yield from _stars(forest)

    tiles = cut_lineage(dealt.groupBy("a", "b", "block").applyInArrow(write, "a int, b int, block int"))
    own, other = (tiles.select(F.struct("*").alias(x)) for x in ("own", "other"))
    # Each pair once: an equality join for each step between the counts of two near tiles, and of one pair of opposite steps only one.
    steps = F.lit([[x, y] for x in range(radius + 1) for y in range(x - radius, radius - x + 1) if x or y >= 0])
    one = own.withColumn("step", F.explode(steps)).select("own", (F.col("own.a") + F.col("step")[0]).alias("a"), (F.col("own.b") + F.col("step")[1]).alias("b"))
    met = one.join(other.withColumn("a", F.col("other.a")).withColumn("b", F.col("other.b")), ["a", "b"]).filter(F.col("own") <= F.col("other"))
    # Numbers of tiles only: 10,000 for each tile of ten billion fingerprints.
    some = met.groupBy("own").agg(F.sort_array(F.collect_list("other")).alias("others"))
    some = some.select("own", F.explode(F.transform(F.sequence(F.lit(0), F.floor((F.size("others") - 1) / PARTNERS).cast("int")), lambda k: F.slice("others", k * PARTNERS + 1, PARTNERS))).alias("others"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return some.repartition(n, F.xxhash64("own", "others")).mapInArrow(run, "u long, v long")


#: Rows of a key beyond which a join deals them apart, and the most keys that can be so: there are no more than rows / max(HOT, rows / HOT_KEYS).
HOT, HOT_KEYS = 1_000_000, 10_000


def hot_join(rows: DataFrame, named: DataFrame, key: str, total: int | None = None) -> DataFrame:
    """Joins rows, so many, to a table that has each key once. Keys that hold more than HOT rows go to every task, HOT_KEYS of them at most."""
    total = rows.count() if total is None else total
    if total <= HOT:
        return rows.join(named, key)
    often = cut_lineage(rows.groupBy(key).count().filter(F.col("count") > max(HOT, total // HOT_KEYS)).select(key))
    if often.isEmpty():
        return rows.join(named, key)
    often = F.broadcast(often)
    apart = rows.join(F.broadcast(cut_lineage(named.join(often, key, "left_semi"))), key)
    return rows.join(often, key, "left_anti").join(named, key).unionByName(apart)


def _merged(edges: DataFrame) -> DataFrame:
    """Edges that connect the same nodes, fewer: those of a node meet in a task, which gives one for each node that is not its component's least there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for u, v in zip(*(batch.column(c).to_numpy().view(np.uint64).tolist() for c in ("u", "v")), strict=True):
                forest.join(u, v)
        yield from _stars(forest)

    return edges.select("u", "v").filter("u <> v").repartition("u").mapInArrow(run, "u long, v long").filter("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """u and root, a node that stands for its component, for all nodes with an edge.

    Edges of a node are merged where they meet first. Then, each round, every node points to its least neighbour (or itself), and nodes that
    point to one are contracted: stars with the least node in the middle, which tasks give, are done in one round. Every other round goes
    by random numbers and points one step on, so that whatever is left shrinks by a constant factor in two, in expectation. No cap on rounds.
    """
    tidy = lambda rows, u, v: cut_lineage(rows.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).filter("u <> v").distinct())
    left, maps = tidy(_merged(edges), "u", "v"), []
    while n := left.count():
        chance = len(maps) % 2
        # In order of the unsigned numbers, as in the tasks.
        number = lambda c: F.struct((F.xxhash64(F.lit(len(maps)), c) if chance else (F.col(c) < 0).cast("long")).alias("number"), F.col(c).alias("node"))  # noqa: B023, E731
        both = left.select("u", number("v").alias("to")).union(left.select(F.col("v").alias("u"), number("u").alias("to")))
        points = both.groupBy("u").agg(F.min("to").alias("to")).select("u", F.least("to", number("u"))["node"].alias("root"))
        if chance:
            points = hot_join(points.withColumnRenamed("root", "mid"), points.withColumnRenamed("u", "mid"), "mid", 2 * n).select("u", "root")
        points = cut_lineage(points)
        maps.append((n, points))
        moved = hot_join(left, points, "u", n).select("v", F.col("root").alias("ru"))
        left = tidy(hot_join(moved, points.select(F.col("u").alias("v"), F.col("root").alias("rv")), "v", n), "ru", "rv")
    if not maps:
        return left.select("u", F.col("v").alias("root"))
    # What a round's nodes became in the end, from the last round back.
    label = maps.pop()[1]
    while maps:
        n, before = maps.pop()
        later = before.select(F.col("root").alias("mid")).distinct().join(label.withColumnRenamed("u", "mid"), "mid", "left")
        later = later.select("mid", F.coalesce("root", "mid").alias("root"))
        label = cut_lineage(hot_join(before.withColumnRenamed("root", "mid"), later, "mid", 2 * n).select("u", "root"))
    return label


def _rooted(distinct: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """The rows with root, the same for all of a component."""
    label = components(edges)
    return distinct.join(label.withColumnRenamed("u", key), key, "left").withColumn("root", F.coalesce("root", key))


def _component_ids(distinct: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """key and component_id, the least of `least` over its component."""
    rooted = cut_lineage(_rooted(distinct.select(key, "least"), edges, key))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return hot_join(rooted, least, "root").select(key, "component_id")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint and component_id (the least doc_id reachable over links) of every row.

    Fingerprints of zero, those of blank and null texts, link like any other. Repeated rows each give a row. A null doc_id
    counts for nothing in a component's least id. Copies meet as one fingerprint before any comparison.
    """
    fps = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    ids = _component_ids(distinct, links(distinct, radius, tile), "fp")
    return hot_join(fps, ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: For near copies: 64-bit words of a fingerprint, differing bits of a candidate, words in a shingle, the least similarity, documents in a tile.
WIDE, WIDE_RADIUS, WIDE_SHINGLE, SIMILARITY, WIDE_TILE = 4, 62, 5, 0.8, 1 << 15
#: Documents of a group of candidates whose shingles a task holds at once, twice over, and how many shingles these have in the mean tile.
VERIFY_TILE, VERIFY_SHINGLES = 4096, 4 << 20


def wide_fingerprints(docs: DataFrame, shingle: int = WIDE_SHINGLE, words: int = WIDE, sets: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Kept columns (doc_id), fp (binary) and n, the number of different shingles, of every whole text; with sets their hashes too. No shuffle."""
    keep = keep or ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in arrays.chunks(batch.column("text")):
                found: list[np.ndarray] = []
                fps, n = _fingerprints(buf, offsets, shingle, words, found)
                raw, size = fps.astype("<u8").tobytes(), 8 * words
                columns = [*(batch.column(c).slice(lo, hi - lo) for c in keep), pa.array([raw[k : k + size] for k in range(0, len(raw), size)], pa.binary()), pa.array(n)]
                if sets:
                    columns.append(pa.array([x.astype("<u8").tobytes() for x in found], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "fp", "n", "hashes"][: len(columns)])

    schema = docs.select(*keep).schema.add("fp", "binary").add("n", "long")
    return pick(docs, *keep, "text").mapInArrow(run, schema.add("hashes", "binary") if sets else schema)


def link_wide(left_ids: np.ndarray, left: np.ndarray, right_ids: np.ndarray, right: np.ndarray, radius: int, forest: Forest) -> None:
    """Joins all pairs within the radius. Rows go by population count; strips whose counts differ beyond the radius are skipped."""
    by_count = lambda x: np.argsort(np.bitwise_count(x).sum(axis=1, dtype=np.int64), kind="stable")
    a, b = by_count(left), by_count(right)
    left_ids, left, right_ids, right = left_ids[a], left[a], right_ids[b], right[b]
    ones_left, ones_right = (np.bitwise_count(x).sum(axis=1, dtype=np.int64) for x in (left, right))
    ids = np.unique(np.concatenate((left_ids, right_ids)))
    label, at, to = np.arange(len(ids)), np.searchsorted(ids, left_ids), np.searchsorted(ids, right_ids)
    rows_a_strip = max(1, STRIP // max(1, len(right)))
    for lo in range(0, len(left), rows_a_strip):
        hi = min(lo + rows_a_strip, len(left))
        c, d = np.searchsorted(ones_right, ones_left[lo] - radius), np.searchsorted(ones_right, ones_left[hi - 1] + radius, "right")
        apart = np.zeros((hi - lo, d - c), np.uint16)
        for w in range(left.shape[1]):
            apart += np.bitwise_count(left[lo:hi, w, None] ^ right[None, c:d, w])
        join_near(apart <= radius, at[lo:hi], to[c:d], label)
    _pass_on(ids, label, forest)


def _pairs_of_tiles(tiles: DataFrame, run, near: Column) -> DataFrame:
    """Edges of the pairs of tiles (a, b; a row of numbers each) that are near. Workers read the tiles from the shared folder."""
    a, b = (tiles.select(F.struct("*").alias(x)) for x in ("a", "b"))
    n = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return a.join(b, near).repartition(n, F.xxhash64("a", "b")).mapInArrow(run, "u long, v long")


def wide_links(distinct: DataFrame, radius: int = WIDE_RADIUS, similarity: float = SIMILARITY, tile: int = WIDE_TILE) -> DataFrame:
    """Edges (u, v) that connect the rows (id, fp, n) whose fingerprints are within the radius.

    Sets of shingles of that similarity have numbers in that ratio, so tiles are steps of it and meet their own and the next step: no
    pair that similar is missed. Tiles are files in the shared folder; what is dealt to tasks are pairs of their numbers, step by step.
    """
    spark = distinct.sparkSession
    folder, words = new_folder(spark, "simhash-tiles"), WIDE
    step = F.floor(F.ln(F.greatest("n", F.lit(1)).cast("double")) / -math.log(similarity)).cast("int")
    keyed = distinct.select("id", "fp", step.alias("step"))
    # A few hundred rows: steps grow with the logarithm of a text's length.
    sizes = cut_lineage(keyed.groupBy("step").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks")))
    dealt = keyed.join(F.broadcast(sizes), "step").withColumn("block", F.pmod("id", F.col("blocks")).cast("int"))

    def write(group: pa.Table) -> pa.Table:
        step, block = (group.column(c)[0].as_py() for c in ("step", "block"))
        ids = group.column("id").to_numpy().view(np.uint64)
        fps = np.frombuffer(b"".join(group.column("fp").to_pylist()), "<u8").reshape(len(ids), words)
        order = np.argsort(ids)
        hash_store.write(folder, f"tile{step}-{block}", ids[order], [("<u8", fps[order, w]) for w in range(words)])
        return pa.table({"step": pa.array([step], pa.int32()), "block": pa.array([block], pa.int32())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for pair in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                sides = []
                for x in pair:
                    ids, fps = hash_store.mapped(folder, f"tile{x['step']}-{x['block']}", ("<u8",) * words)
                    sides += [np.array(ids), np.stack(fps, axis=1)]
                link_wide(*sides, radius, forest)
        yield from _stars(forest)

    tiles = cut_lineage(dealt.select("step", "block", "id", "fp").groupBy("step", "block").applyInArrow(write, "step int, block int"))
    same, after = F.col("a.step") == F.col("b.step"), F.col("a.step") + 1 == F.col("b.step")
    edges = _pairs_of_tiles(tiles, run, same & (F.col("a.block") <= F.col("b.block")))
    return edges.union(_pairs_of_tiles(tiles, run, after))


#: Candidates of a text up to which their sets are looked at one by one, not those of the whole tile at once.
SINGLY = 32


def verify_tile(left: list[tuple], right: list[tuple], radius: int, similarity: float, forest: Forest) -> None:
    """Joins the pairs (id, fp, hashes) within the radius whose sets of shingles are so similar, but for those that are joined already.

    Shingles are numbered within the tile. A text marks its own, and the marks in another's set are what they share; for many
    candidates these are counted in one pass over the sets of the tile, so that a crowd of unlike texts costs a pass for each, not a step for each pair.
    """
    both = [*left, *right]
    ids = np.array([x[0] for x in both], np.uint64)
    fps = np.frombuffer(b"".join(x[1] for x in both), "<u8").reshape(len(both), -1)
    sets = [np.frombuffer(x[2], "<u8") for x in both]
    size = np.array([len(x) for x in sets])
    vocab, number = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(size)
    starts = ends - size
    mark, label = np.zeros(len(vocab) + 1, bool), np.arange(len(both))
    number = np.append(number, len(vocab))
    for i in range(len(left)):
        lo = len(left) if right else i + 1
        apart = np.bitwise_count(fps[lo:] ^ fps[i]).sum(axis=1, dtype=np.int64)
        near = (apart <= radius) & (np.minimum(size[lo:], size[i]) >= similarity * np.maximum(size[lo:], size[i])) & (label[lo:] != label[i])
        found = lo + np.flatnonzero(near)
        if not len(found):
            continue
        own = number[starts[i] : ends[i]]
        mark[own] = True
        if len(found) <= SINGLY:
            shared = np.array([np.count_nonzero(mark[number[starts[j] : ends[j]]]) for j in found.tolist()])
        else:
            upto = np.concatenate(([0], np.cumsum(mark[number[starts[lo] : -1]])))
            shared = upto[ends[found] - starts[lo]] - upto[starts[found] - starts[lo]]
        mark[own] = False
        alike = found[shared >= similarity * (size[found] + size[i] - shared)]
        if len(alike):
            met = np.unique(np.append(label[alike], label[i]))
            label[np.isin(label, met)] = met[0]
    _pass_on(ids, label, forest)


def verified(docs: DataFrame, candidates: DataFrame, radius: int = WIDE_RADIUS, similarity: float = SIMILARITY, tile: int = VERIFY_TILE, texts: DataFrame | None = None, shingles: int = VERIFY_SHINGLES) -> DataFrame:
    """Edges (u, v) that connect the rows linked by pairs within the radius and of at least so similar sets of shingles.

    Pairs are sought within each component of the candidates' edges, so that no table of pairs arises. A component of more than a tile, in
    documents or in shingles, is written to tiles in the shared folder, and pairs of their numbers are dealt to tasks. With ``texts`` (id, n,
    stays_hash: a text for each fingerprint) only those of candidates are read again and shingled.
    """
    folder = new_folder(docs.sparkSession, "shingle-tiles")
    label = broadcast_if_few(cut_lineage(components(candidates).withColumnRenamed("u", "id")))
    if texts is not None:
        wanted = broadcast_if_few(cut_lineage(texts.join(label, "id", "left_semi").select("stays_hash").distinct()))
        docs = docs.select("doc_id", "text").join(wanted, F.xxhash64("text") == F.col("stays_hash"), "left_semi")
    sets = wide_fingerprints(docs, sets=True).withColumn("id", F.xxhash64("fp", "n")).join(label, "id", "left_semi")
    sets = sets.groupBy("id").agg(F.first("fp").alias("fp"), F.first("hashes").alias("hashes")).join(label, "id")
    lengths = texts.select("id", "n") if texts is not None else wide_fingerprints(docs).select(F.xxhash64("fp", "n").alias("id"), "n").distinct()
    blocks = lengths.join(label, "id").groupBy("root").agg(F.greatest(F.ceil(F.count("*") / tile), F.ceil(F.sum("n") / shingles)).cast("int").alias("blocks"))
    blocks = cut_lineage(blocks)
    sets = cut_lineage(hot_join(sets, blocks, "root").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).select("root", "block", "blocks", "id", "fp", "hashes"))

    def rows_of(table: pa.Table) -> list[tuple]:
        ids = table.column("id").to_numpy().view(np.uint64).tolist()
        return list(zip(ids, table.column("fp").to_pylist(), table.column("hashes").to_pylist(), strict=True))

    def whole(group: pa.Table) -> pa.Table:
        forest = Forest()
        verify_tile(rows_of(group), [], radius, similarity, forest)
        found = list(_stars(forest))
        return pa.Table.from_batches(found) if found else pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})

    edges = sets.groupBy("root", "block").applyInArrow(whole, "u long, v long")
    if blocks.filter("blocks > 1").isEmpty():
        return edges

    def write(group: pa.Table) -> pa.Table:
        root, block = (group.column(c)[0].as_py() for c in ("root", "block"))
        rows = sorted(rows_of(group))
        ends = np.cumsum([len(h) // 8 for *_, h in rows])
        fps = np.frombuffer(b"".join(f for _, f, _ in rows), "<u8").reshape(len(rows), -1)
        name = f"shingles{root}-{block}"
        hash_store.write(folder, name, np.array([i for i, *_ in rows], np.uint64), [("<u8", ends), *(("<u8", w) for w in fps.T)])
        hash_store.write(folder, f"{name}-hashes", np.frombuffer(b"".join(h for *_, h in rows), "<u8"), [])
        return pa.table({"root": pa.array([root], pa.int64()), "block": pa.array([block], pa.int32())})

    def read(tile: dict) -> list[tuple]:
        name = f"shingles{tile['root']}-{tile['block']}"
        ids, (ends, *fps) = hash_store.mapped(folder, name, ("<u8",) * (1 + WIDE))
        hashes, _ = hash_store.mapped(folder, f"{name}-hashes", ())
        ends = ends.astype(np.int64)
        starts, fps = np.concatenate(([0], ends[:-1])), np.stack(fps, axis=1)
        return [(i, f.tobytes(), hashes[a:b].tobytes()) for i, f, a, b in zip(ids.tolist(), fps, starts.tolist(), ends.tolist(), strict=True)]

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                verify_tile(read(a), read(b), radius, similarity, forest)
        yield from _stars(forest)

    tiles = cut_lineage(sets.filter("blocks > 1").groupBy("root", "block").applyInArrow(write, "root long, block int"))
    return edges.union(_pairs_of_tiles(tiles, across, (F.col("a.root") == F.col("b.root")) & (F.col("a.block") < F.col("b.block"))))


def _copies(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, id), distinct fingerprints (id, fp, n), and the edges that connect near copies."""
    hashed = docs.select("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    fps = cut_lineage(wide_fingerprints(hashed, keep=["doc_id", "text_hash"]).withColumn("id", F.xxhash64("fp", "n")))
    distinct = cut_lineage(fps.groupBy("id").agg(F.first("fp").alias("fp"), F.first("n").alias("n"), F.min("doc_id").alias("least"), F.min(_key("doc_id", "text_hash")).alias("stays")))
    return fps, distinct, verified(docs, cut_lineage(wide_links(distinct)), texts=distinct.select("id", "n", "stays.stays_hash"))


def _key(doc_id: str, text_hash: str) -> Column:
    """What tells the rows of a component apart: ids ascending, rows without one last, equal ids by their text."""
    return F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("stays_id"), F.col(text_hash).alias("stays_hash"))


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id and component_id, the least doc_id reachable, of every row, over pairs whose shingles are at least as similar as SIMILARITY.

    Two texts of word-shingle similarity J differ in about acos(2J / (1 + J)) / pi of their fingerprints' bits: 39 of 256 at 0.8, with a
    deviation of 6, so the radius lies four deviations above. It only finds candidates; their shingles decide. Copies meet as one
    fingerprint first.
    """
    fps, distinct, edges = _copies(docs)
    return hot_join(fps, _component_ids(distinct, edges, "id"), "id").select("doc_id", "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """One document of each component of near copies, with all its columns: the one of least doc_id.

    A row is told by its doc_id and text, so rows that share a doc_id, or have none, with unlike texts are documents of their own; a row
    without a doc_id stays only where its component has none with one. Of rows equal in both one stays, the first by its other columns.
    """
    _, distinct, edges = _copies(docs)
    rooted = _rooted(distinct.select("id", "stays"), edges, "id")
    stay = cut_lineage(rooted.groupBy("root").agg(F.min("stays").alias("stays")).select("stays.stays_id", "stays.stays_hash"))
    renamed, back = set_aside(docs, ["stays_id", "stays_hash", "at"])
    kept = renamed.join(stay, F.col("doc_id").eqNullSafe(F.col("stays_id")) & (F.xxhash64("text") == F.col("stays_hash")), "left_semi")
    keys = renamed.select("doc_id", F.xxhash64("text").alias("stays_hash"))
    if not keys.groupBy("doc_id", "stays_hash").count().filter("count > 1").isEmpty():
        # A row each for the repeated: equal texts, so any other column may differ.
        rest = [F.to_json(F.struct(c)) for c in renamed.columns if c not in ("doc_id", "text")]
        first = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(*rest)
        kept = kept.withColumn("at", F.row_number().over(first)).filter("at = 1").drop("at")
    return kept.withColumnsRenamed(back)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
