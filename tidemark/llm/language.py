"""Language identification by error-correcting output codes over hashed byte n-grams.

Every language gets a codeword. For each bit, a binary n-gram classifier tells the languages with a 1 from those with a 0: the
mean log-odds of the text's n-grams, each language counting alike. The prediction is the codeword of least loss, where the loss of a
bit is log(1 + exp(-margin)) and weighs as much as that bit separates the languages in training. The softmax of the
losses is the score. A text is flagged ambiguous whose nearest codeword leads the next by under a quarter of what it does for the language's
own training text: texts half in one language and half in another. Equal losses go to the first language by name. Long texts are read
in pieces that begin at words.

Counts come from all training rows, as one row for each language and n-gram bucket; the driver gets BUCKETS numbers a language.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays
from .common import held_out, pick, set_aside, table

BUCKETS = 1 << 15
#: Bytes in an n-gram.
ORDERS = (2, 3, 4)
#: Added to every count.
PRIOR = 0.5
#: How sharply margins count in a loss, and losses in a score.
SHARPNESS, CERTAINTY = 12.0, 2.0
#: A lead under which a prediction is ambiguous; chosen on held-out rows and on texts joined of two languages.
AMBIGUOUS = 0.25
#: N-grams whose log-odds are added up at a time.
STRIP = 1 << 18
_FOLD = arrays.LOWER.copy()
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 0x20


def _features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, ordered by text, and each text's first. All but letters and other non-ASCII bytes count as blanks; runs of those as one.

    A text's n-grams begin with blanks before it, whatever texts stand around it.
    """
    n = len(offsets) - 1
    folded = np.full(len(buf) + n, 0x20, np.uint8)
    folded[np.arange(len(buf)) + np.repeat(np.arange(n), np.diff(offsets))] = _FOLD[buf]
    blank = folded == 0x20
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    ends = np.cumsum(keep)[offsets[1:] + np.arange(n)]
    x = folded[keep].astype(np.uint32)
    first = np.concatenate(([0], ends))
    begin = first[:-1][np.diff(first) > 0]
    grams = []
    for k in ORDERS:
        code = np.zeros(len(x), np.uint32)
        for j in range(k - 1, -1, -1):
            shifted = np.full(len(x), 0x20, np.uint32)
            shifted[j:] = x[: len(x) - j]
            # What stands before a text are blanks, not the text before it.
            for i in range(j):
                at = begin + i
                shifted[at[at < len(x)]] = 0x20
            code = (code << np.uint32(8)) | shifted
        code = (code ^ np.uint32(k * 0x1F123BB5)) * np.uint32(0x9E3779B1)
        grams.append(code >> np.uint32(33 - BUCKETS.bit_length()))
    return np.stack(grams, axis=1), first


def counts(labelled: DataFrame) -> DataFrame:
    """lang, bucket, n over all rows that have text and lang."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lo, hi, buf, offsets, _ in arrays.pieces(batch.column("text")):
                grams, first = _features(buf, offsets)
                for lang in set(langs[lo:hi]):
                    rows = np.repeat(np.array([x == lang for x in langs[lo:hi]]), np.diff(first))
                    total[lang] = total.get(lang, 0) + np.bincount(grams[rows].ravel(), minlength=BUCKETS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["lang", "bucket", "n"])

    rows = pick(labelled, "lang", "text").filter("lang is not null and text is not null")
    return rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """A row of +1 and -1 for each language: all distinct splits for up to 6, else the best spread of random codes."""
    if n <= 6:
        bits = [c for c in product((1, -1), repeat=n) if c[:1] == (1,) and -1 in c]
        return np.array(bits, np.int8).T.reshape(n, len(bits))
    rng, best, most = np.random.default_rng(seed), None, -1
    width = 10 * int(np.ceil(np.log2(n)))
    for _ in range(50):
        code = rng.choice(np.array([1, -1], np.int8), (n, width))
        apart = (width - code.astype(np.int32) @ code.T) // 2 + width * np.eye(n, dtype=np.int32)
        if apart.min() > most and (np.abs(code.sum(axis=0)) < n).all():
            best, most = code, apart.min()
    return best if best is not None else rng.choice(np.array([1, -1], np.int8), (n, width))


def _strips(cuts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring cuts that span about STRIP n-grams."""
    a = 0
    while a < len(cuts) - 1:
        b = max(a + 1, int(np.searchsorted(cuts, cuts[a] + 2 * STRIP, "right")) - 1)
        yield a, b
        a = b


class Codes:
    """Languages, their codewords, and each bit's classifier and weight."""

    def __init__(self, langs: list[str], n: np.ndarray) -> None:
        self.langs, self.code = langs, codewords(len(langs))
        p = (n + PRIOR) / (n + PRIOR).sum(axis=1, keepdims=True) if len(langs) else n
        odds = [np.log(p[bit > 0].mean(axis=0)) - np.log(p[bit < 0].mean(axis=0)) for bit in self.code.T]
        self.odds = np.array(odds, np.float32).T.reshape(BUCKETS, len(odds)).copy() if odds else np.zeros((BUCKETS, 0), np.float32)
        apart = np.array([(self.code[:, b] * (p @ self.odds[:, b])).min() for b in range(self.code.shape[1])]) if odds else np.zeros(0)
        self.weight = np.maximum(apart, 1e-3) / np.maximum(apart, 1e-3).sum() if len(apart) else apart
        #: By how much the codeword of a language's training text is nearer than each other one.
        whole = self.losses(p @ self.odds) if odds else np.zeros((len(langs), len(langs)))
        self.pure = whole - np.diag(whole)[:, None]

    def margins(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The mean log-odds of every bit for every text."""
        total, n = self.sums(buf, offsets)
        return total / np.maximum(n, 1)[:, None]

    def sums(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sums of log-odds, and of how many n-grams."""
        grams, first = _features(buf, offsets)
        out = np.zeros((len(offsets) - 1, self.odds.shape[1]))
        # So many n-grams at a time: a long text has many.
        edges = np.unique(np.concatenate((np.arange(0, len(grams), STRIP), first)))
        text = np.searchsorted(first, edges[:-1], "right") - 1
        for lo in range(0, len(edges) - 1, 1024):
            cuts = edges[lo : lo + 1025]
            for a, b in _strips(cuts):
                part = grams[cuts[a] : cuts[b]]
                total = self.odds[part[:, 0]]
                for k in range(1, grams.shape[1]):
                    total += self.odds[part[:, k]]
                np.add.at(out, text[lo + a : lo + b], np.add.reduceat(total, cuts[a:b] - cuts[a], axis=0, dtype=np.float64))
        return out, np.diff(first) * grams.shape[1]

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """The weighted loss of every codeword for every text."""
        z = SHARPNESS * margins[:, None, :] * self.code[None]
        return (np.logaddexp(0, -z) * self.weight).sum(axis=2)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best language's number, its score, and its lead: by how much its codeword is nearer than the next, as a part of how
        much it is for the language's training text as a whole."""
        loss = self.losses(margins)
        share = np.exp(-CERTAINTY * (loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        if loss.shape[1] < 2:
            return best, share.max(axis=1), np.ones(len(loss))
        order = np.argsort(loss, axis=1, kind="stable")
        rows = np.arange(len(loss))
        gap = loss[rows, order[:, 1]] - loss[rows, order[:, 0]]
        return best, share.max(axis=1), gap / np.maximum(self.pure[order[:, 0], order[:, 1]], 1e-9)


def fit(labelled: DataFrame) -> Codes:
    found = counts(labelled).toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    n = np.zeros((len(langs), BUCKETS))
    if langs:
        n[np.searchsorted(langs, found.column("lang").to_numpy(zero_copy_only=False).astype(str)), found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return Codes(langs, n)


def identify(df: DataFrame, codes: Codes, text: str = "text") -> DataFrame:
    """Adds lang_pred, score and ambiguous to every row. No shuffle.

    `und` with score 0 for a null text, one without a letter, and where nothing was learned. Repeated rows are judged alike.
    """
    new = ("lang_pred", "score", "ambiguous", "has_letter")
    rows = df.drop(*new).withColumn("has_letter", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    schema = df.drop(*new).schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    shared = df.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value
        for batch in batches:
            known = batch.column("has_letter").to_numpy(zero_copy_only=False) & bool(codes.langs)
            pred, score, lead = np.full(batch.num_rows, "und", object), np.zeros(batch.num_rows), np.ones(batch.num_rows)
            total, n = 0.0, 0
            for lo, hi, buf, offsets, more in arrays.pieces(batch.column(text)) if codes.langs else ():
                sums, grams = codes.sums(buf, offsets)
                total, n = total + sums, n + grams
                if not more:
                    best, score[lo:hi], lead[lo:hi] = codes.decode(total / np.maximum(n, 1)[:, None])
                    pred[lo:hi] = np.array(codes.langs, object)[best]
                    total, n = 0.0, 0
            pred[~known], score[~known] = "und", 0.0
            kept = [n for n in batch.schema.names if n != "has_letter"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + [pa.array(pred, pa.string()), pa.array(score), pa.array((lead < AMBIGUOUS) & known)], names=[*kept, "lang_pred", "score", "ambiguous"])

    return rows.mapInArrow(run, schema)


def in_a_language(docs: DataFrame, codes: Codes) -> DataFrame:
    """The documents, with all their columns, that have a letter and are not ambiguous; a missing lang becomes the prediction."""
    renamed, back = set_aside(docs, ["lang_pred", "score", "ambiguous", "has_letter"])
    kept = identify(renamed, codes).filter((F.col("lang_pred") != "und") & ~F.col("ambiguous"))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*renamed.columns).withColumnsRenamed(back)


def training(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out(0))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    codes = fit(training(docs))
    return identify(docs.select("doc_id", held_out(0).alias("held_out"), "text"), codes).drop("text")
