"""Quality rules with an n-gram perplexity of bytes.

A modified Kneser-Ney model of byte 4-grams is counted by Spark over all texts and kept as sorted hash arrays in the shared
folder, which workers map into memory. It spans all languages, so that a text which turns to another of them is no outlier. A
document is rejected whose log-perplexity a word, or a character of its words, leaves its language's band: text strewn with symbols has dear
words, tables have dear characters and, where their cells are short, cheap words; text made of the commonest words over and over has
cheap words. Bands come from all different texts that pass the base rules: the language's median, less or more so many deviations, where
the deviation is that of texts of about the same length. Copies of a text count once, in
the model too. Lengths with few texts take in their neighbours, and a language with few is judged by the bands of all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import arrays, hash_store
from .common import broadcast_if_few, cut_lineage, new_folder, pick, set_aside, table

ORDER = 4
#: Entries in an array file, about.
SHARD_ENTRIES = 1 << 21
#: Distinct n-grams that a task gathers before it passes them on.
GATHER = 2_000_000
#: How many deviations below and above the median a document may lie, by word and by character.
BANDS = {"word_ppl": (4.8, 6.5), "char_ppl": (7.0, 4.2)}
#: The least deviation that is believed, as a part of the median.
LEAST_DEVIATION = 0.02
#: Different texts that a median or a deviation needs.
SUPPORT = 16
#: How many powers of two around a length its deviation may be taken from: the first with so many texts.
AROUND = (0, 1, 2, 4, 64)
#: Deviations are counted by logarithm, in so many steps a unit.
STEPS = 50
#: In place of a language: all texts, by their common median and by their language's.
EVERY, COMMON = "\0every", "\0common"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True


def _codes(buf: np.ndarray, offsets: np.ndarray, before: bytes = bytes(ORDER - 1)) -> np.ndarray:
    """The 4-gram that ends at each byte, as a number; zeros stand before a text, other bytes before one that goes on."""
    n = len(offsets) - 1
    padded = np.zeros(len(buf) + (ORDER - 1) * n, np.uint8)
    padded[: ORDER - 1] = np.frombuffer(before, np.uint8)
    at = np.arange(len(buf)) + (ORDER - 1) * np.repeat(np.arange(1, n + 1), np.diff(offsets))
    padded[at] = buf
    code = padded[at].astype(np.uint32)
    for j in range(1, ORDER):
        code |= padded[at - j].astype(np.uint32) << np.uint32(8 * j)
    return code


def _coded(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bool]]:
    """First and end row, 4-grams, each text's first, and whether the text goes on; long texts come in pieces."""
    before = bytes(ORDER - 1)
    for lo, hi, buf, offsets, more in arrays.pieces(col):
        yield lo, hi, _codes(buf, offsets, before), offsets, more
        before = (before + buf[-(ORDER - 1) :].tobytes())[-(ORDER - 1) :] if more else bytes(ORDER - 1)


def gram_counts(docs: DataFrame) -> DataFrame:
    """gram, n: the counts of all 4-grams of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def squeeze() -> None:
            grams, back = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
            held[:] = [(grams, np.bincount(back, np.concatenate([n for _, n in held])).astype(np.int64))]

        def emit() -> Iterator[pa.RecordBatch]:
            if held:
                squeeze()
                grams, n = held.pop()
                for lo in range(0, len(grams), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(grams[lo : lo + 50_000].astype(np.int64)), pa.array(n[lo : lo + 50_000])], names=["gram", "n"])

        for batch in batches:
            for _, _, codes, *_ in _coded(batch.column("text")):
                code = np.sort(codes)
                at, n = arrays.runs(code)
                held.append((code[at], n))
                if len(held) > 8:
                    squeeze()
            if sum(len(g) for g, _ in held) > GATHER:
                yield from emit()
        yield from emit()

    return pick(docs, "text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def different(docs: DataFrame) -> DataFrame:
    """Each different text once. Only texts that occur more than once are shuffled, each task's copies as one."""
    keyed = pick(docs, "text").withColumn("hash", F.xxhash64("text"))
    again = broadcast_if_few(cut_lineage(keyed.groupBy("hash").count().filter("count > 1").select("hash")))
    copies = keyed.join(again, "hash", "left_semi").groupBy("hash").agg(F.first("text").alias("text"))
    return keyed.join(again, "hash", "left_anti").select("text").union(copies.select("text"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Discounts of counts 1, 2, and 3 and more, from the numbers of n-grams counted once to four times."""
    y = n1 / max(n1 + 2 * n2, 1)
    ratio = lambda a, b, k: min(max(k - (k + 1) * y * b / max(a, 1), 0.05), k - 0.05)
    return [ratio(n1, n2, 1), ratio(n2, n3, 2), ratio(n3, n4, 3)]


def model_entries(counts: DataFrame) -> DataFrame:
    """kind, gram, value: log-probabilities of n-grams of k bytes (kind k) and log back-off weights of contexts of k bytes (kind 8 + k).

    Below the highest order an n-gram counts in how many contexts it was seen. A context has at most 256 successors, so windows over contexts
    are small; the driver gets four numbers for each order.
    """
    by_order = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        by_order[k] = by_order[k + 1].groupBy(F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1)).alias("gram")).agg(F.count("*").alias("n"))
    seen = reduce(DataFrame.union, [rows.select(F.lit(k).alias("k"), F.least("n", F.lit(5)).alias("n")) for k, rows in by_order.items()])
    found = {(r.k, r.n): r["count"] for r in seen.groupBy("k", "n").count().collect()}
    lower, out = None, []
    for k in range(1, ORDER + 1):
        d = discounts(*(found.get((k, n), 0) for n in (1, 2, 3, 4)))
        discount = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        of_context = Window.partitionBy("ctx")
        grams = by_order[k].withColumn("ctx", F.shiftright("gram", 8)).withColumn("d", discount)
        grams = grams.withColumn("total", F.sum("n").over(of_context)).withColumn("spare", F.sum("d").over(of_context) / F.col("total"))
        out.append(grams.groupBy("ctx").agg(F.first("spare").alias("spare")).select(F.lit(7 + k).alias("kind"), F.col("ctx").alias("gram"), F.log("spare").alias("value")))
        if lower is not None:
            suffix = F.col("gram").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1))
            grams = grams.withColumn("suffix", suffix).join(lower.withColumnsRenamed({"gram": "suffix", "p": "below"}), "suffix")
        below = F.lit(1 / 256) if lower is None else F.col("below")
        lower = cut_lineage(grams.select("gram", ((F.col("n") - F.col("d")) / F.col("total") + F.col("spare") * below).alias("p")))
        out.append(lower.select(F.lit(k).alias("kind"), "gram", F.log("p").alias("value")))
    return reduce(DataFrame.union, out)


def entry_keys(kind: int, grams: np.ndarray) -> np.ndarray:
    """The key of each n-gram of a kind: different ones have different keys."""
    return arrays.mix((grams.astype(np.uint64) | np.uint64(kind << 40)) + np.uint64(0x9E3779B97F4A7C15))


@dataclass
class Model:
    """Where the arrays are, and which shards there are."""

    folder: str
    bits: int
    present: np.ndarray


def write_model(counts: DataFrame, folder: str) -> Model:
    """Writes the sorted hash arrays."""
    counts = cut_lineage(counts)
    bits = max(0, int(np.ceil(np.log2(max(1, 3 * counts.count()) / SHARD_ENTRIES))))

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, grams = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "gram"))
            keys = arrays.mix((grams.astype(np.uint64) | kinds.astype(np.uint64) << np.uint64(40)) + np.uint64(0x9E3779B97F4A7C15))
            yield pa.RecordBatch.from_arrays([pa.array(hash_store.top(keys, bits).astype(np.int32)), pa.array(keys.view(np.int64)), batch.column("value")], names=["shard", "key", "value"])

    def run(group: pa.Table) -> pa.Table:
        s = group.column("shard")[0].as_py()
        keys = group.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        hash_store.write(folder, f"gram{s}", keys[order], [("<f4", group.column("value").to_numpy()[order])])
        return pa.table({"shard": pa.array([s], pa.int32())})

    keyed = model_entries(counts).mapInArrow(key, "shard int, key long, value double")
    shards = keyed.repartition(1 << bits, "shard").groupBy("shard").applyInArrow(run, "shard int").collect()
    return Model(folder, bits, hash_store.shards_present([r.shard for r in shards], bits))


def _look(model: Model, kind: int, grams: np.ndarray) -> np.ndarray:
    """The values of n-grams, 0 where absent (no log-probability is 0)."""
    keys = entry_keys(kind, grams)
    return hash_store.find(model.folder, "gram", model.present, ("<f4",), keys, hash_store.top(keys, model.bits))[0].astype(np.float64)


def log_probability(model: Model, grams: np.ndarray) -> np.ndarray:
    """Natural log of the probability of each 4-gram's last byte after the others, backing off where it is unseen."""
    out, todo, grams = np.zeros(len(grams)), np.arange(len(grams)), grams.astype(np.uint64)
    for k in range(ORDER, 0, -1):
        g = grams[todo] & np.uint64((1 << (8 * k)) - 1)
        found = _look(model, k, g)
        out[todo] += found
        missing = found == 0
        todo, g = todo[missing], g[missing]
        if not len(todo):
            return out
        out[todo] += _look(model, 7 + k, g >> np.uint64(8))
    out[todo] += np.log(1 / 256)
    return out


def _summed(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The number of flags in each range; ranges ascend and do not overlap."""
    out, some = np.zeros(len(starts), np.int64), np.flatnonzero(ends > starts)
    if len(some):
        edges = np.stack((starts[some], ends[some]), axis=1).ravel()
        out[some] = np.add.reduceat(np.append(flags, False), edges, dtype=np.int64)[::2]
    return out


def _word_hashes(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and how many each text has; a long text's come from its pieces."""
    if len(offsets) > 2 or len(buf) <= 2 * arrays.CHUNK_BYTES:
        starts, ends, first = arrays.spans(buf, offsets)
        return arrays.span_hashes(buf, starts, ends), np.diff(first)
    found = []
    for _, _, part, part_offsets, _ in arrays.pieces(pa.array([memoryview(buf)], pa.large_binary()), arrays.CHUNK_BYTES):
        starts, ends, _ = arrays.spans(part, part_offsets)
        found.append(arrays.span_hashes(part, starts, ends))
    return np.concatenate(found), np.array([sum(map(len, found))])


def base_counts(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text of a chunk. Words, lines and windows are known by 64-bit hashes within their text."""
    n = len(offsets) - 1
    begins, ends = offsets[:-1], offsets[1:]
    h, words = _word_hashes(buf, offsets)
    space = arrays.SPACE[buf]
    # White space is one byte a code point, and no part of a word.
    out = {"n_words": words, "word_chars": _summed((buf & 0xC0) != 0x80, begins, ends) - _summed(space, begins, ends), "n_symbols": _summed(_SYMBOL[buf], begins, ends)}
    # Lines with a word; of equal ones in a text all but one are repeats.
    breaks = np.flatnonzero(buf == 0x0A)
    line_start = np.unique(np.concatenate((begins, breaks + 1)))
    line_start = line_start[line_start < len(buf)]
    line_end = np.append(line_start[1:], len(buf)).astype(np.int64)
    line_end -= (buf[line_end - 1] == 0x0A) & (line_end > line_start) if len(line_start) else 0
    some = _summed(~space, line_start, line_end) > 0
    line_start, line_end = line_start[some], line_end[some]
    doc = np.searchsorted(offsets, line_start, "right") - 1
    keys = arrays.mix(arrays.span_hashes(buf, line_start, line_end) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out["n_dup_lines"] = np.bincount(doc, minlength=n) - np.bincount(doc[np.unique(keys, return_index=True)[1]], minlength=n)
    # Words in windows that occur twice or more in their text.
    out["n_repeat_words"] = np.zeros(n, np.int64)
    if len(h) >= WINDOW:
        doc = np.repeat(np.arange(n, dtype=np.int32), words)
        key = arrays.mix(doc[WINDOW - 1 :].astype(np.uint64))
        for j in range(WINDOW):
            key = arrays.mix(key + h[j : len(h) - WINDOW + 1 + j])
        whole = np.flatnonzero(doc[: len(h) - WINDOW + 1] == doc[WINDOW - 1 :])
        key = key[whole]
        ordered = np.sort(key)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        del ordered
        if len(twice):
            at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
            covered = np.zeros(len(h), bool)
            hit = whole[twice[at] == key]
            for j in range(WINDOW):
                covered[hit + j] = True
            out["n_repeat_words"] = np.bincount(doc[covered], minlength=n)
    return out


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, model: Model) -> DataFrame:
    """All columns, the base counts, and nats: the negative log-probability of the text. No shuffle."""
    keep = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nats = np.zeros(batch.num_rows)
            for lo, hi, codes, offsets, _ in _coded(batch.column("text")):
                grams, back = np.unique(codes, return_inverse=True)
                total = np.concatenate(([0.0], np.cumsum(log_probability(model, grams)[back])))
                nats[lo:hi] += total[offsets[:-1]] - total[offsets[1:]]
            for lo, hi, buf, offsets in arrays.chunks(batch.column("text")):
                counts = base_counts(buf, offsets)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(counts[c].astype(np.int64)) for c in BASE] + [pa.array(nats[lo:hi])], names=[*keep, *BASE, "nats"])

    schema = docs.select("*").schema
    for c in BASE:
        schema = schema.add(c, "long")
    return docs.mapInArrow(run, schema.add("nats", "double"))


def _figures(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    rows = rows.withColumn("word_ppl", F.try_divide("nats", "n_words")).withColumn("char_ppl", F.try_divide("nats", "word_chars"))
    # Lengths by powers of two: a few dozen rows for each language.
    return rows.withColumn("length", F.floor(F.log2(F.greatest("n_words", F.lit(1)).cast("double"))).cast("int")).withColumn("band_lang", F.coalesce("lang", F.lit("")))


def _spread(rows: DataFrame, names: list[str]) -> DataFrame:
    """band, length and, under each name, the relative deviation from the middle of the texts of about that length.

    That is of the narrowest range of lengths with SUPPORT texts, else of all. Deviations are counted first, in steps of 2 %.
    """
    away = [F.struct(F.lit(k).alias("name"), F.abs(F.try_divide(k, f"{k}_middle") - 1).alias("away")) for k in names]
    counted = rows.select("band", "length", F.explode(F.array(*away)).alias("x"))
    counted = counted.groupBy("band", "length", F.col("x.name").alias("name"), F.round(F.log(F.greatest("x.away", F.lit(1e-6))) * STEPS).cast("int").alias("step")).agg(F.count("*").alias("n"))
    counted = cut_lineage(counted)
    # A few dozen lengths; each count goes to those of them that it is near.
    at = cut_lineage(counted.select(F.col("length").alias("at")).distinct())
    near = counted.withColumn("around", F.explode(F.lit(list(AROUND)))).crossJoin(F.broadcast(at)).filter(F.abs(F.col("at") - F.col("length")) <= F.col("around"))
    found = near.groupBy("band", "at", "name", "around").agg(F.sum("n").alias("texts"), F.percentile("step", 0.5, F.col("n")).alias("step"))
    found = found.filter((F.col("texts") >= SUPPORT) | (F.col("around") == max(AROUND)))
    found = found.groupBy("band", F.col("at").alias("length"), "name").agg(F.min_by("step", "around").alias("step"))
    deviation = lambda k: (1.4826 * F.exp(F.max(F.when(F.col("name") == k, F.col("step"))) / STEPS)).alias(k)
    return cut_lineage(found.groupBy("band", "length").agg(*[deviation(k) for k in names]))


class Judge:
    """A fitted model and the bands of every language and length.

    ``measured`` holds the kept columns, a hash of the text, the base counts and nats of all rows, written once to the shared folder.
    """

    def __init__(self, docs: DataFrame, keep: list[str] | None = None, bands: dict[str, tuple[float, float]] = BANDS) -> None:
        spark = docs.sparkSession
        self.bands, self.model = bands, write_model(gram_counts(different(docs)), new_folder(spark, "byte-lm"))
        folder = new_folder(spark, "measured")
        measured = measure(docs.select(*dict.fromkeys([*(keep or docs.columns), "text", "lang"])).withColumn("text_hash", F.xxhash64("text")), self.model)
        measured.select(*dict.fromkeys([*(keep or docs.columns), "lang"]), "text_hash", *BASE, "nats").write.parquet(folder)
        self.measured = spark.read.parquet(folder)
        good = _figures(self.measured).filter(~F.col("base_failed"))
        good = cut_lineage(good.groupBy("band_lang", "text_hash").agg(*[F.first(c).alias(c) for c in ("length", *bands)]))
        middles = lambda rows, *by: rows.groupBy(*by).agg(F.count("*").alias("texts"), *[F.percentile_approx(k, 0.5, 1000).alias(f"{k}_middle") for k in bands])
        every = cut_lineage(middles(good).select(F.lit(EVERY).alias("every"), "*").drop("texts"))
        langs = middles(good, "band_lang").crossJoin(F.broadcast(every.withColumnsRenamed({f"{k}_middle": f"{k}_every" for k in bands})))
        few = F.col("texts") < SUPPORT
        langs = langs.select("band_lang", F.when(few, F.col("every")).otherwise(F.col("band_lang")).alias("band"), *[F.when(few, F.col(f"{k}_every")).otherwise(F.col(f"{k}_middle")).alias(f"{k}_middle") for k in bands])
        langs = broadcast_if_few(cut_lineage(langs))
        own = good.join(langs, "band_lang")
        rows = own.filter(F.col("band") != EVERY).unionByName(own.withColumn("band", F.lit(COMMON)))
        rows = rows.unionByName(good.withColumn("band", F.lit(EVERY)).crossJoin(F.broadcast(every.drop("every"))))
        spread = _spread(rows, list(bands))
        common = spread.filter(F.col("band") == COMMON).select("length", *[F.col(k).alias(f"{k}_common") for k in bands])
        spread = spread.select("band", "length", *[F.col(k).alias(f"{k}_deviation") for k in bands])
        lengths = good.select("band_lang", "length").distinct().join(langs, "band_lang")
        self.ends = cut_lineage(lengths.join(broadcast_if_few(spread), ["band", "length"]).join(F.broadcast(common), "length").drop("band"))

    def verdicts(self) -> DataFrame:
        """The measured rows with base_failed, word_ppl, char_ppl (nats), below and above (outside a band at that end), kept.

        base_failed: under 10 words, or over a fifth of the words in repeated windows. kept: not that, and within both bands of the
        language (null: a language of its own). Null and blank texts fail. Repeated rows are judged alike.
        """
        found = _figures(self.measured).join(broadcast_if_few(self.ends), ["band_lang", "length"], "left")
        below = above = F.lit(False)
        for k, (low, high) in self.bands.items():
            deviation = F.col(f"{k}_middle") * F.greatest(f"{k}_deviation", f"{k}_common", F.lit(LEAST_DEVIATION))
            below |= F.coalesce(F.col(k) < F.col(f"{k}_middle") - low * deviation, F.lit(False))
            above |= F.coalesce(F.col(k) > F.col(f"{k}_middle") + high * deviation, F.lit(False))
        found = found.withColumn("below", ~F.col("base_failed") & below).withColumn("above", ~F.col("base_failed") & above)
        return found.withColumn("kept", ~(F.col("base_failed") | F.col("below") | F.col("above"))).drop("text_hash", "length", "band_lang", *(c for c in self.ends.columns if c not in ("length", "band_lang")))


def accepted(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns. Texts are scored once and written beside their figures."""
    renamed, back = set_aside(docs, [*BASE, "nats", "base_failed", *BANDS, *(f"{k}_{x}" for k in BANDS for x in ("middle", "deviation", "common")), "below", "above", "kept", "length", "band_lang", "text_hash"])
    return Judge(renamed).verdicts().filter("kept").select(*renamed.columns).withColumnsRenamed(back)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    judge = Judge(table(spark, sf_dir, "documents"), ["doc_id"])
    return judge.verdicts().select("doc_id", *BASE, "base_failed", "kept", *BANDS, "below", "above")
