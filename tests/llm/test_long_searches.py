"""Hard negatives, conversation repair and suffix-array dedup: against brute force, and on odd cases."""

import functools
import hashlib
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tests.llm.conftest import frame
from tidemark.llm import conversations, negatives, repeats, suffixes

VECTORS = "vec_id long, embedding array<double>, label int, score double, rank int, anchor_id long"
TURNS = "conv_id long, turn long, role string, text string, cost long, part int, audit string"


# --- suffixes -----------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_suffix_order(seed):
    rng = random.Random(seed)
    for _ in range(150):
        text = [rng.randint(1, rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(0, 50))] * rng.choice([1, 1, 2, 4]) + [0]
        cap = rng.choice([3, 10, 400])
        order = sorted(range(len(text)), key=lambda i: text[i:])
        same = lambda a, b: sum(1 for _ in itertools.takewhile(lambda p: p[0] == p[1], zip(text[a:], text[b:], strict=False)))  # noqa: B023, E731
        shared = [0] + [min(cap, same(a, b)) for a, b in itertools.pairwise(order)]
        got = suffixes.suffix_order(np.array(text, np.uint16), max(text) + 1, cap, rng.choice([16, 1 << 20]), rng.choice([0, 5, 1000]))
        assert got[0].tolist() == order and got[1].tolist() == shared


def test_least_of_stretches():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 500, 900).astype(np.uint16)
    minima, at = suffixes.Minima(len(values)), 0
    while at < len(values):
        step = int(rng.integers(1, 70))
        minima.append(values[at : at + step])
        at = min(at + step, len(values))
        lo = rng.integers(0, at, 100)
        hi = np.minimum(lo + rng.integers(0, 900, 100), at - 1)
        assert minima.least(lo, hi).tolist() == [values[a : b + 1].min() for a, b in zip(lo, hi, strict=True)]


# --- repeats ------------------------------------------------------------------------------------------------------------------------


def plain_repeats(texts, length):
    """n_bytes, n_removed, n_spans and the hash of what is left, of each text."""
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return out


def odd_texts(rng, n):
    base = ["".join(rng.choice("abcd é") for _ in range(rng.randint(0, 300))) for _ in range(n)]
    passage = "".join(rng.choice("xyz ") for _ in range(70))
    made = base + [base[0], base[1] + base[2], base[3][:90] + "?" + base[3][90:], "ab" * 200, "x" * 500, "y" * 61, "", None]
    return made + [b[:40] + passage + b[40:90] for b in base] + [passage[:59], passage[5:66], "z" + passage + "z"]


@pytest.mark.parametrize(("shard", "seed"), [(1 << 20, 1), (2000, 2)])
def test_repeats(spark, shard, seed):
    """Small windows; with small shards keys are told apart by the keys of parts, down to whole windows."""
    texts = odd_texts(random.Random(seed), 30)
    docs = frame(spark, [[i, t, "en", "s"] for i, t in enumerate(texts)])
    docs = docs.selectExpr("doc_id", "text", "doc_id AS id", "'b' AS body", "1 AS key", "'t' AS text_id", "0 AS n_removed")
    got = {r.doc_id: r for r in repeats.without_repeats(docs, length=60, gram=8, shard=shard, body=True).collect()}
    want = plain_repeats([(t or "").encode() for t in texts], 60)
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == w, i
        assert hashlib.sha256(got[i].kept).hexdigest() == w[3] and (got[i].id, got[i].body, got[i].key, got[i].text_id) == (i, "b", 1, "t")


def test_op13(spark, sf, rows):
    want = sorted(zip([str(r[0]) for r in rows], plain_repeats([(r[1] or "").encode() for r in rows], 400), strict=True))
    assert sorted((str(r[0]), tuple(r[1:])) for r in repeats.op13(spark, sf).collect()) == want
    assert sum(w[1][1] for w in want) > 100_000


def test_passages_by_bytes_not_by_words(spark):
    """Of passages of 51 words and more in two documents those of 400 bytes go, shorter ones stay; n_removed tells, n_bytes is the size before."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    passages = [" ".join(word(size) for _ in range(51)) for size in (5, 6, 8, 12)]
    texts = [f"{word(60)} {p} {word(70)}" for p in passages for _ in range(2)] + [" ".join(word(7) for _ in range(80)) for _ in range(3)]
    got = {r.doc_id: r for r in repeats.without_repeats(frame(spark, [[i, t, "en", "s"] for i, t in enumerate(texts)])).collect()}
    lengths = [len(p) + 2 for p in passages for _ in range(2)] + [0, 0, 0]
    assert [got[i].n_bytes for i in range(len(texts))] == [len(t) for t in texts]
    # The blanks around a passage are shared too, and a neighbouring letter may be by chance.
    for i, n in enumerate(lengths):
        assert n <= got[i].n_removed <= n + 8 if n >= 400 else not got[i].n_removed


def test_shards_hold_whole_keys_within_their_bytes():
    """However many keys come to a task, what it sorts at once is bounded; only a key that has more goes alone."""
    rng = np.random.default_rng(3)
    key = np.sort(np.concatenate((rng.integers(0, 60, 300), np.full(90, 25), np.full(200, 61))))
    rows = pa.table({"key": key, "body": [b"x" * int(n) for n in rng.integers(0, 40, len(key))]})
    for step in (1, 7, 100, 1000):
        got = list(repeats.shards_of(iter(rows.to_batches(max_chunksize=step)), 1000))
        assert pa.concat_tables(got).equals(rows.combine_chunks()) or pa.concat_tables(got).to_pydict() == rows.to_pydict()
        of = [set(x.column("key").to_pylist()) for x in got]
        assert sum(map(len, of)) == len(set(key.tolist()))
        for keys, x in zip(of, got, strict=True):
            assert len(keys) == 1 or sum(len(b) + 1 for b in x.column("body").to_pylist()) <= 1000
    assert max(map(len, of)) > 1 and not list(repeats.shards_of(iter(()), 1000))


def test_sorts_of_a_task_are_bounded(spark, monkeypatch):
    """Four keys of 900 bytes and more in one partition, which hashes once dealt to one shard, are sorted apart; the repeats are those of each key."""
    rng, most = np.random.default_rng(4), 1000
    body = [bytes(rng.integers(97, 123, 450).astype(np.uint8)) for _ in range(4)]
    rows = [[k, bytes([k, i]), 1, False, bytearray(body[k][:440] + bytes([97 + i]) * 10)] for k in range(4) for i in range(2)]
    contexts = spark.createDataFrame(rows, "key long, mark binary, n long, twofold boolean, body binary")

    def held(shard, length, of=repeats._repeats_of_shard):
        assert pc.sum(pc.binary_length(shard.column("body"))).as_py() <= most
        return of(shard, length)

    monkeypatch.setattr(repeats, "_repeats_of_shard", held)
    run = repeats._sorted_shards(contexts.coalesce(1), 1, most, 400).collect()
    assert sorted((r.key, r.begins, r.ends) for r in run) == [(k, [0], [41]) for k in range(4) for _ in range(2)]


def test_few_bytes_in_few_files(spark):
    """Files by the bytes, not by the partitions that a session deals out to; a megabyte is not worth hundreds."""
    rows, cores = spark.range(0, 1000, 1, 300), spark.sparkContext.defaultParallelism
    assert repeats._in_files(rows, 1 << 20).rdd.getNumPartitions() == min(2 * cores, 300)
    assert repeats._in_files(rows, 200 * repeats._FILE).rdd.getNumPartitions() == max(201, min(2 * cores, 300))
    assert repeats._in_files(rows, 1 << 50).rdd.getNumPartitions() == 300


def test_stretches_of_segments():
    """Windows keep their keys whatever else is in the buffer; each is in one stretch."""
    rng = np.random.default_rng(2)
    text = rng.integers(97, 101, 150_000).astype(np.uint8)
    row, start, end, key, _ = repeats.stretches(text, np.array([0, 70_000, 70_100, 150_000]))
    assert set(row.tolist()) == {0, 2} and (end - start)[row == 0].sum() == 70_000 - 399 and (end - start)[row == 2].sum() == 79_900 - 399
    alone = repeats.stretches(text[70_100:], np.array([0, 79_900]))
    windows = lambda s, e, k: {i: v for a, b, v in zip(s.tolist(), e.tolist(), k.tolist(), strict=True) for i in range(a, b)}
    assert windows(start[row == 2], end[row == 2], key[row == 2]) == windows(*alone[1:4])


# --- negatives ----------------------------------------------------------------------------------------------------------------------


def plain_negatives(rows):
    taking = []
    for vec_id, x, label in rows:
        if vec_id is not None and label is not None and x is not None and all(v is not None and abs(256 * v) < float("inf") for v in x):
            taking.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [int(np.floor(256 * v)) for v in x]))
    out = []
    dot = lambda a, b: sum(p * q for p, q in zip(a, b, strict=False))
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    for i, label, x in taking:
        if i % 100 == 0:
            alike = sorted((-dot(x, y), j) for j, other, y in taking if other == label and j != i)[:5]
            others = sorted((-dot(x, y), j) for j, other, y in taking if other != label)
            for s, p in alike:
                found = [(t, j) for t, j in others if 30 * -s <= 100 * -t <= 90 * -s][:10]
                out += [(i, p, rank, j, clip(-s), clip(-t)) for rank, (t, j) in enumerate(found, 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, x, label, 0.5, 1, 2) for i, x, label in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("scale", [1.0, 1e9, 1e200])
def test_hard_negatives(spark, scale):
    """Ties, copies, and scores beyond what doubles and longs hold."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(v) * scale for v in centres[i % 6] + 0.4 * rng.normal(size=8)], int(rng.integers(0, 4))) for i in range(400)]
    rows += [(1000 + i, rows[100][1], i % 4) for i in range(60)] + [(500, rows[100][1], 1), (500, rows[100][1], 1), (600, [0.0] * 8, 1), (700, [0.1], 2)]
    rows += [(None, rows[0][1], 1), (800, None, 1), (900, rows[0][1], None), (901, [None] * 8, 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, 2), (904, [], 3)]
    got = sorted(tuple(r) for r in negatives.hard_negatives(vectors(spark, rows)).collect())
    want = plain_negatives(rows)
    assert got == want and len(want) > 100


def test_hard_negatives_of_small_blocks(spark, monkeypatch):
    """Blocks of few rows: most are never scanned, and the results are the same."""
    rng = np.random.default_rng(6)
    centres = 3 * rng.normal(size=(20, 6))
    rows = [(i, [float(v) for v in centres[i % 20] + 0.1 * rng.normal(size=6)], i % 3) for i in range(1000)]
    monkeypatch.setattr(negatives, "BLOCK", 16)
    assert sorted(tuple(r) for r in negatives.hard_negatives(vectors(spark, rows)).collect()) == plain_negatives(rows)


def test_scan_ends_early():
    """Far blocks are not loaded once the results are certain."""
    rng = np.random.default_rng(7)
    pivots = np.column_stack((10 * np.eye(4), np.zeros(4)))
    x = np.round(np.repeat(100 * np.eye(4), 200, axis=0) + rng.normal(size=(800, 4)))
    longest = float((x * x).sum(axis=1).max())
    pivots = negatives._augmented(100 * np.eye(4), longest)
    key = negatives._apart(negatives._augmented(x, longest), pivots)[np.arange(800), np.repeat(np.arange(4), 200)]
    blocks = np.array([[0, b, b // 4, key[b * 50 : b * 50 + 50].min(), key[b * 50 : b * 50 + 50].max()] for b in range(16)])
    loaded = []

    def load(which):
        at = slice(int(which[1]) * 50, int(which[1]) * 50 + 50)
        loaded.append(int(which[1]))
        yield np.arange(800)[at], np.zeros(50, int), x[at]

    search = negatives.Searches([0], [None], [None], True, 5)
    between = negatives._bounds(x[:1], pivots, blocks, longest, True)
    negatives.scan(search, np.array([0]), np.array([0]), x[:1], blocks, between, load)
    assert search.best[0] == sorted((-int(s), i) for i, s in enumerate(x @ x[0]) if i)[:5] and len(loaded) < 12


def test_no_vectors(spark):
    assert negatives.hard_negatives(vectors(spark, [])).collect() == []
    assert negatives.hard_negatives(vectors(spark, [(100, [1.0], 1)])).collect() == []
    assert negatives.hard_negatives(vectors(spark, [(100, None, 1)])).collect() == []


# --- conversations ------------------------------------------------------------------------------------------------------------------


def plain_repair(roles, texts):
    """The cheapest audit, least in ASCII order, by trying everything; and the repaired lines."""
    seen, rows, counts = set(), [], [0, 0, 0]
    for role, text in zip(roles, texts, strict=True):
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        if fault is not None:
            counts[fault] += 1
        seen.add((role, text))
        rows.append((role[:1], fault in (0, 1), fault == 2))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def best(i, last, inserts):
        found = [(0, "")] if i == len(rows) and last in ("", "a") else []
        for c in [c for c in "ua" if c in follows[last] and inserts < 3]:
            found += [(cost + 2, "I" + rest) for cost, rest in best(i, c, inserts + 1)]
        if i < len(rows):
            initial, must, short = rows[i]
            found += [(cost + 3, "D" + rest) for cost, rest in best(i + 1, last, 0)]
            if not must:
                if initial and initial in follows[last]:
                    found += [(cost + short, "K" + rest) for cost, rest in best(i + 1, initial, 0)]
                for c in [c for c in "ua" if c in follows[last]]:
                    found += [(cost + 2 + short, "R" + rest) for cost, rest in best(i + 1, c, 0)]
        return [min(found)] if found else []

    (cost, audit), lines, last, at = best(0, "", 0)[0], [], "", 0
    for edit in audit:
        turn = "assistant" if last == "u" else "user"
        if edit == "I":
            lines.append(turn + ":")
            last = turn[0]
            continue
        if edit != "D":
            role = roles[at] if edit == "K" else turn
            lines.append(f"{role}:{texts[at]}")
            last = role[0]
        at += 1
    return counts, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def plain_op12(rows):
    held = {}
    for conv_id, turn, role, text in rows:
        dealt = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: text.translate(str.maketrans("", "", ".!?"))}.get(dealt, text)
        held.setdefault(conv_id, []).extend([(turn, "user" if dealt == 4 else role, text)] * {0: 0, 3: 2}.get(dealt, 1))
    out = {}
    for conv_id, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, _, _ in own if t is not None]
        roles, texts = [r for _, r, _ in own], [t for _, _, t in own]
        counts, cost, audit, sha = plain_repair(tuple(roles), tuple(texts))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(roles))
        out[conv_id] = (gaps, *counts, illegal, cost, audit, sha)
    return out


def talk(rng, n, longest):
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ä"])
            text = rng.choice(["Yes.", "no", "What?", "", " \n", None, "long " * 20 + ".", "é!", "?. \t"]) if rng.random() < 0.6 else f"turn {turn} of {conv}."
            rows.append((conv, turn if rng.random() < 0.95 else None, role, text))
    return rows + [(None, 0, "user", "Nobody's."), (None, None, None, None)]


@pytest.mark.parametrize("most", [1024, 3, 1])
def test_conversations(spark, most):
    """Conversations in one piece, in many, and of a piece a row, give the same."""
    rows = talk(random.Random(8), 40, 14) + talk(random.Random(9), 1, 90)
    df = spark.createDataFrame([(*r, 7, 1, "KK") for r in rows], TURNS).repartition(3)
    found = conversations.repaired(conversations.damaged(df), most_rows=most)
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in found.collect()}
    assert got == plain_op12(rows)


def test_conversations_of_nothing(spark):
    df = spark.createDataFrame([], TURNS)
    assert conversations.repaired(conversations.damaged(df)).collect() == []
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    (row,) = conversations.repaired(conversations.damaged(spark.createDataFrame([(gone, 0, "user", "x", 1, 1, "")], TURNS))).collect()
    assert (row.conv_id, row.gaps, row.cost, row.audit, row.repaired_sha256) == (gone, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_states_are_few():
    made = conversations.Automaton()
    assert made.all_states() < 40 and all(min(v) == 0 for v in made.vectors)
