"""Hard negatives by one-dimensional distance keys.

Vectors get one coordinate more, so that all have one length; then the larger the inner product with an anchor, the smaller the distance. Each
vector is stored under its nearest pivot by its distance to it, in blocks of a stretch of distances. By the triangle inequality the rows
of a block lie between two distances from an anchor. A search scans key intervals from the anchor's own outwards, annulus by annulus,
and ends when no block left can hold a row as near as the last of the results: they are certain then. Scores are exact integers.

Blocks are files in the shared folder. Anchors are dealt to tasks in the order of their keys, and a task scans for some of them at a time. Which
blocks there are is a list of a bounded length: with more vectors, blocks get longer, not more.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hash_store
from .common import cut_lineage, new_folder, pick, table

#: Pivots, rows of the sample that they are fitted on, and rounds of that.
PIVOTS, SAMPLE, ROUNDS = 64, 2048, 5
#: Least rows of a block, most blocks but for those that pivots and partitions cut, rows scanned at a time, anchors searched for at a time.
BLOCK, BLOCKS, ROWS, TILE = 2048, 100_000, 4096, 64
#: Most partitions that anchors are dealt to.
PARTITIONS = 20_000
#: Positives of an anchor, negatives of a positive, and bounds of their scores in hundredths of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90

_SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
_LONG = (1 << 63) - 1


def taking_part(vectors: DataFrame) -> DataFrame:
    """vec_id, label and embedding (of doubles) of the rows that take part: with an id, a label and finite components only; every seventh label moved on."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double") * 256) < float("inf")))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    kept = pick(vectors, "vec_id", "embedding", "label").filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), x.alias("embedding"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """floor(256 * x) of lists of doubles, as rows of doubles; zeros behind a shorter list."""
    sizes = np.diff(np.asarray(column.offsets))
    values = np.floor(256 * np.asarray(column.flatten(), np.float64))
    out = np.zeros((len(column), dims))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _facts(rows: DataFrame) -> tuple[int, int, float, float]:
    """Rows, the longest vector, the greatest component and the greatest squared length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, dims, greatest, longest = 0, 0, 0.0, 0.0
        for batch in batches:
            if batch.num_rows:
                column = batch.column("embedding")
                n, dims = n + batch.num_rows, max(dims, int(np.diff(np.asarray(column.offsets)).max()))
                x = _matrix(column, dims)
                greatest, longest = max(greatest, float(np.abs(x).max(initial=0))), max(longest, float((x * x).sum(axis=1).max()))
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (n, dims, greatest, longest)], names=["n", "dims", "greatest", "longest"])

    got = rows.select("embedding").mapInArrow(run, "n long, dims long, greatest double, longest double")
    found = got.agg(F.sum("n").alias("n"), *(F.max(c).alias(c) for c in ("dims", "greatest", "longest"))).first()
    return found["n"] or 0, found["dims"] or 0, found["greatest"] or 0.0, found["longest"] or 0.0


def _augmented(x: np.ndarray, longest: float) -> np.ndarray:
    return np.column_stack((x, np.sqrt(np.maximum(longest - (x * x).sum(axis=1), 0))))


def _apart(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots."""
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T, 0))


def _pivots(rows: DataFrame, dims: int, longest: float) -> np.ndarray:
    """Centres of a bounded sample of different vectors, the first by a hash of the id."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toArrow().column(0).combine_chunks()
    x = np.unique(_augmented(_matrix(sample, dims), longest), axis=0)
    pivots = x[np.linspace(0, len(x) - 1, min(PIVOTS, len(x))).astype(int)]
    for _ in range(ROUNDS):
        nearest = _apart(x, pivots).argmin(axis=1)
        pivots = np.stack([x[nearest == p].mean(axis=0) if (nearest == p).any() else pivots[p] for p in range(len(pivots))])
    return pivots


def _with_keys(rows: DataFrame, pivots: np.ndarray, dims: int, longest: float, kind: str) -> DataFrame:
    """pivot, key (the distance to it), vec_id, label and vector (packed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("embedding"), dims)
            apart = _apart(_augmented(x, longest), pivots) if math.isfinite(longest) else np.zeros((len(x), len(pivots)))
            nearest = apart.argmin(axis=1)
            packed = [row.tobytes() for row in x.astype(kind)]
            columns = [pa.array(nearest.astype(np.int32)), pa.array(apart[np.arange(len(x)), nearest]), batch.column("vec_id"), batch.column("label"), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["pivot", "key", "vec_id", "label", "vector"])

    return rows.mapInArrow(run, "pivot int, key double, vec_id long, label long, vector binary")


def _write_blocks(keyed: DataFrame, folder: str, dims: int, kind: str, block: int) -> np.ndarray:
    """Writes blocks of rows in the order of their keys, each of one pivot. Returns name (partition, number), pivot, least and greatest key of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), []

        def write(rows: pa.Table) -> None:
            pivot, key = rows.column("pivot").to_numpy(), rows.column("key").to_numpy()
            for at in np.split(np.arange(len(pivot)), np.flatnonzero(np.diff(pivot)) + 1):
                own = rows.slice(int(at[0]), len(at))
                x = np.frombuffer(b"".join(own.column("vector").to_pylist()), kind).reshape(len(at), dims)
                fields = [("<i8", own.column("label").to_numpy()), *((kind, x[:, d]) for d in range(dims))]
                hash_store.write(folder, f"{part}-{len(made)}", own.column("vec_id").to_numpy().view(np.uint64), fields)
                made.append((part, len(made), int(pivot[at[0]]), float(key[at].min()), float(key[at].max())))

        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                own = batch.slice(0, block - n)
                batch, n = batch.slice(len(own)), n + len(own)
                held.append(own)
                if n == block:
                    write(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            write(pa.Table.from_batches(held))
        yield pa.RecordBatch.from_pylist([dict(zip(("part", "number", "pivot", "low", "high"), x, strict=True)) for x in made], schema=kinds)

    kinds = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("pivot", pa.int64()), ("low", pa.float64()), ("high", pa.float64())])
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = keyed.repartitionByRange(parts, "pivot", "key", "vec_id").sortWithinPartitions("pivot", "key", "vec_id")
    listed = cut_lineage(in_order.mapInArrow(run, "part long, number long, pivot long, low double, high double")).toArrow()
    return np.column_stack([listed.column(c).to_numpy().astype(np.float64) for c in listed.column_names])


class Searches:
    """Searches for the rows of the highest scores (ties: the least id first) between two scores, of the anchor's label or of any other."""

    def __init__(self, anchor: list[int], low: list[int | None], high: list[int | None], same: bool, k: int):
        self.anchor, self.same, self.k = anchor, same, k
        self.low, self.high = low, high
        self.best: list[list[tuple[int, int]]] = [[] for _ in anchor]  # (-score, id), ascending

    def meet(self, i: int, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Offers rows to a search."""
        best = self.best[i]
        if self.low[i] is not None:
            allowed = allowed & (scores >= self.low[i])
        if self.high[i] is not None:
            allowed = allowed & (scores <= self.high[i])
        if len(best) == self.k:
            allowed = allowed & (scores >= -best[-1][0])
        at = np.flatnonzero(allowed)
        if len(at) > 4 * self.k and scores.dtype != object:
            # Of many no more than those that reach the k-th.
            at = at[scores[at] >= np.partition(scores[at], len(at) - self.k)[len(at) - self.k]]
            at = at[np.lexsort((ids[at], -scores[at]))[: self.k]]
        if len(at):
            self.best[i] = sorted(best + [(-int(s), int(v)) for s, v in zip(scores[at].tolist(), ids[at].tolist(), strict=True)])[: self.k]

    def certain(self, i: int, bound: float) -> bool:
        """No row of a score of at most the bound can change the results."""
        return len(self.best[i]) == self.k and -self.best[i][-1][0] > bound


def _double(score: int | None, without: float) -> float:
    """A score as a double, or what stands for none; beyond all doubles infinite."""
    if score is None:
        return without
    try:
        return float(score)
    except OverflowError:
        return math.inf if score > 0 else -math.inf


def scan(searches: Searches, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, blocks: np.ndarray, between: tuple[np.ndarray, np.ndarray], load: Callable) -> None:
    """Runs the searches to their certain ends. between: the least and the greatest score that each block can have with each anchor."""
    least, most = between
    order, at, step = [], [0] * len(searches.anchor), 2
    for i, a in enumerate(searches.anchor):
        some = np.flatnonzero((most[a] >= _double(searches.low[i], -np.inf)) & (least[a] <= _double(searches.high[i], np.inf)))
        order.append(some[np.argsort(-most[a][some], kind="stable")])
    live = [i for i in range(len(searches.anchor)) if len(order[i])]
    while live:
        # The next annulus of each search, twice as many blocks as before.
        asked: dict[int, list[int]] = {}
        for i in live:
            for b in order[i][at[i] : at[i] + step].tolist():
                asked.setdefault(b, []).append(i)
            at[i] += step
        for b in sorted(asked):
            who = sorted({searches.anchor[i] for i in asked[b]})
            place = {a: n for n, a in enumerate(who)}
            for own_ids, own_labels, x in load(blocks[b]):
                scores = vectors[who] @ x.T
                for i in asked[b]:
                    a = searches.anchor[i]
                    alike = own_labels == labels[a]
                    searches.meet(i, scores[place[a]], own_ids, alike & (own_ids != ids[a]) if searches.same else ~alike)
        step *= 2
        live = [i for i in live if at[i] < len(order[i]) and not searches.certain(i, float(most[searches.anchor[i]][order[i][at[i]]]))]


def _bounds(x: np.ndarray, pivots: np.ndarray, blocks: np.ndarray, longest: float, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest score of each block with each anchor, by the triangle inequality."""
    shape = (len(x), len(blocks))
    if not exact:
        return np.full(shape, -np.inf), np.full(shape, np.inf)
    to = _apart(np.column_stack((x, np.zeros(len(x)))), pivots)[:, blocks[:, 2].astype(int)]
    near = np.maximum(np.maximum(to - blocks[:, 4], blocks[:, 3] - to), 0)
    both = (x * x).sum(axis=1)[:, None] + longest
    slack = 1 + 1e-6 * both
    return (both - (to + blocks[:, 4]) ** 2) / 2 - slack, (both - near**2) / 2 + slack


def hard_negatives(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, every: int = 100) -> DataFrame:
    """For each anchor (a row whose vec_id is divisible by ``every``) and each of its best positives the best negatives within the bounds.

    Rows without an id, a label or a vector, or with a component that is null or not finite (256 times, too), take no part. A shorter
    vector goes on with zeros. Rows that share an id are no positives of each other; repeated rows count as often as they stand. A
    score beyond a long is set to its end. An anchor without positives or without negatives within bounds gives no row.
    """
    spark = vectors.sparkSession
    rows = taking_part(vectors)
    n, dims, greatest, longest = _facts(rows)
    if not n:
        return spark.createDataFrame([], _SCHEMA)
    dims = max(dims, 1)
    # Sums of products that a double holds exactly; beyond, whole numbers of any size, and no bounds.
    exact = greatest * greatest * dims < 2**53
    kind = "<i4" if greatest < 2**31 else "<f8"
    pivots = _pivots(rows, dims, longest) if exact else np.zeros((1, dims + 1))
    folder = new_folder(spark, "distance-keys")
    block = min(max(BLOCK, n // BLOCKS), max(ROWS, (256 << 20) // (8 * dims)))
    blocks = _write_blocks(_with_keys(rows, pivots, dims, longest, kind), folder, dims, kind, block)
    kinds = ("<i8", *([kind] * dims))

    def whole(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        return x if exact else np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)

    def load(which: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        ids, (labels, *columns) = hash_store.mapped(folder, f"{int(which[0])}-{int(which[1])}", kinds)
        for lo in range(0, len(ids), ROWS):
            hi = min(lo + ROWS, len(ids))
            yield ids[lo:hi].view(np.int64), labels[lo:hi], whole(np.stack([c[lo:hi] for c in columns], axis=1))

    def mine(ids: np.ndarray, labels: np.ndarray, packed: list[bytes]) -> Iterator[tuple[int, ...]]:
        x = np.frombuffer(b"".join(packed), kind).reshape(len(ids), dims).astype(np.float64)
        between, x = _bounds(x, pivots, blocks, longest, exact), whole(x)
        first = Searches(list(range(len(ids))), [None] * len(ids), [None] * len(ids), True, positives)
        scan(first, ids, labels, x, blocks, between, load)
        pairs = [(a, -s, v) for a, best in enumerate(first.best) for s, v in best]
        pairs = [(a, s, v) for a, s, v in pairs if -(-low * s // 100) <= high * s // 100]
        second = Searches([a for a, _, _ in pairs], [-(-low * s // 100) for _, s, _ in pairs], [high * s // 100 for _, s, _ in pairs], False, negatives)
        scan(second, ids, labels, x, blocks, between, load)
        clipped = lambda s: max(-_LONG - 1, min(_LONG, s))
        for (a, s, v), best in zip(pairs, second.best, strict=True):
            for rank, (t, w) in enumerate(best, 1):
                yield int(ids[a]), v, rank, w, clipped(s), clipped(-t)

    kept = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("rank", pa.int32()), ("negative_id", pa.int64()), ("positive_score", pa.int64()), ("negative_score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, TILE):
                own = batch.slice(lo, TILE)
                found = list(mine(own.column("vec_id").to_numpy(), own.column("label").to_numpy(), own.column("vector").to_pylist()))
                columns = list(zip(*found, strict=True)) or [[] for _ in kept]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kept, strict=True)], schema=kept)

    anchors = _with_keys(rows.filter(F.col("vec_id") % every == 0), pivots, dims, longest, kind)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(n // every // (4 * TILE) + 1, PARTITIONS))
    return anchors.repartitionByRange(parts, "pivot", "key", "vec_id").sortWithinPartitions("pivot", "key", "vec_id").mapInArrow(run, _SCHEMA)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH taking AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(256 * x::DOUBLE))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM taking a JOIN taking b ON a.vec_id % 100 = 0 AND (a.label <> b.label OR a.vec_id <> b.vec_id)
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INT AS rank,
    other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
