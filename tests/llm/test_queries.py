"""Every query on the odd documents against a plain version, on an empty table, and on a single null."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import xxhash
from tokenizers import Tokenizer

from tidemark.llm import articles, bpe, fingerprints, hash_store, language, mixing, quality, sharding, simhash, token_files, word_lm
from tidemark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def remainder(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5


def key(row):
    return (row[0] is not None, row[0] or 0, row[1] or "")


@pytest.mark.parametrize("name", [n for n in QUERIES if n.split("_")[0] not in ("op9", "op11", "op12")])
def test_empty_and_single(spark, empty_sf, one_sf, name):
    assert QUERIES[name](spark, empty_sf).collect() == []
    (row,) = QUERIES[name](spark, one_sf).collect()
    assert row.doc_id == 5


def test_fingerprints(spark, sf, rows):
    got = collections.defaultdict(list)
    for r in fingerprints.op1(spark, sf).collect():
        got[r.doc_id].append(r)
    ordered = sorted(rows, key=key)
    assert sum(map(len, got.values())) == len(rows)
    by_text = collections.defaultdict(set)
    for i, (doc_id, text, *_) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        found = [r for r in got[doc_id] if r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(text)]
        assert found, (doc_id, text[:40])
        by_text[text].update(r.fingerprint for r in found)
        assert all(0 <= x <= 1 for r in found for x in (r.near_edited, r.near_next))
    single = [t for t, f in by_text.items() if len(f) > 1 and t not in ("a b c", "a b d")]
    assert not single


def test_fingerprint_rate_is_generalised_jaccard():
    rng = np.random.default_rng(3)
    a = [f"w{x}" for x in rng.integers(0, 60, 300)]
    b = a[:200] + [f"v{x}" for x in rng.integers(0, 60, 150)]
    x, y = collections.Counter(a), collections.Counter(b)
    exact = sum((x & y).values()) / sum((x | y).values())
    texts = pa.array([" ".join(a), " ".join(b)])
    (chunk,) = fingerprints.arrays.chunks(texts)
    sig, _ = fingerprints.signatures(*chunk[2:], samples=2048)
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.05


def test_fingerprints_are_those_of_a_plain_sampler():
    """Term by term and sample by sample, by the formulas of the method."""
    samples, f = 6, np.float32
    r1, r2, c1, c2, b1, b2 = fingerprints._variates(samples)
    texts = ["a b a c", "the quick brown fox the fox the", "x", "a a a a a a a b"]
    (chunk,) = fingerprints.arrays.chunks(pa.array(texts))
    got, _ = fingerprints.signatures(*chunk[2:], samples=samples)
    for text, sig in zip(texts, got, strict=True):
        for k in range(samples):
            heights = []
            for word, weight in collections.Counter(WORD.findall(text)).items():
                raw = np.frombuffer(word.encode(), np.uint8)
                h = int(fingerprints.arrays.span_hashes(raw, np.array([0]), np.array([len(raw)]))[0])
                part = lambda shift: (h >> shift) & (fingerprints._ROWS - 1)  # noqa: B023, E731
                r = f(r1[part(0), k] + r2[part(20), k])
                beta = f(b1[part(0), k] + b2[part(20), k])
                beta = f(beta - np.floor(beta))
                t = np.floor(f(f(f(np.log(float(weight))) / r) + beta))
                heights.append(f(np.log(f(c1[part(32), k] + c2[part(52), k])) - f(f(f(t - beta) + f(1)) * r)))
            least = np.array([min(heights)], f)
            assert sig[k] == ((least.view(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(16))[0]


def test_fingerprints_do_not_depend_on_the_chunk():
    texts = [" ".join(f"w{i % 7}{j}" for j in range(i % 50)) for i in range(300)]
    whole = fingerprints._of_texts(texts, 64)[0]
    alone = np.concatenate([fingerprints._of_texts([t], 64)[0] for t in texts])
    assert (whole == alone).all()


def test_columns_added(spark, sf, rows):
    """The operators' own interfaces: columns beside those that are there, for every row."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    some = fingerprints.fingerprint(docs.select("doc_id", "text", "score"), samples=8)
    assert some.columns == ["doc_id", "text", "score", "fingerprint"] and some.count() == len(rows)
    assert {r.fingerprint for r in some.filter("doc_id in (100, 101, 102)").collect()} == {"0" * 32}
    path = bpe.vocabulary_path(bpe.RANKS)
    ids = bpe.add_ids(docs.select("doc_id", "text", "ids"))
    assert ids.columns == ["doc_id", "text", "ids"] and all(list(r.ids) == bpe.encode(r.text or "", path) for r in ids.collect())


def test_language(spark, sf, rows):
    got = {r.doc_id: r for r in language.op2(spark, sf).collect()}
    plain = [r for r in rows if r[0] is not None and r[0] < 90]
    assert all(got[d].lang_pred == lang for d, _, lang, _ in plain)
    assert all(got[d].held_out == (remainder(d) == 0) for d, *_ in rows if d is not None)
    assert [got[d].lang_pred for d in (100, 101, 102, 107)] == ["und"] * 4
    assert all(0 <= r.score <= 1 for r in got.values())


def plain_grams(text):
    """All 2-, 3- and 4-grams of the folded bytes, blanks before them."""
    folded = b"   " + b"".join(w + b" " for w in re.findall(rb"[a-z\x80-\xff]+", text.translate(LOWER).encode()))
    return [folded[i - k + 1 : i + 1] for i in range(3, len(folded)) for k in (2, 3, 4)]


def bucket(gram):
    k = len(gram)
    code = (int.from_bytes(gram, "big") ^ (k * 0x1F123BB5 & 0xFFFFFFFF)) * 0x9E3779B1 & 0xFFFFFFFF
    return code >> (33 - language.BUCKETS.bit_length())


def test_language_model_is_the_plain_one():
    """Odds, margins and decoding against dictionaries; a text's are the same whatever stands around it."""
    train = {"de": "das haus und der garten, über die straße", "en": "the house and the garden in winter", "fr": "la maison et le jardin où été"}
    n = np.zeros((3, language.BUCKETS))
    for i, text in enumerate(train.values()):
        for g in plain_grams(text):
            n[i, bucket(g)] += 1
    codes = language.Codes(list(train), n)
    texts = ["the garden", "das haus", "la maison et", "x", "winter straße", "the house la maison"]
    p = [(n[i] + 0.5) / (n[i] + 0.5).sum() for i in range(3)]
    (chunk,) = language.arrays.chunks(pa.array(texts))
    together = codes.margins(*chunk[2:])
    for text, margins in zip(texts, together, strict=True):
        (one,) = language.arrays.chunks(pa.array([text]))
        assert np.allclose(codes.margins(*one[2:])[0], margins, atol=1e-5)
        want = []
        for bit in codes.code.T:
            sides = [sum(p[i] for i in range(3) if bit[i] == s) / sum(bit == s) for s in (1, -1)]
            want.append(np.mean([math.log(sides[0][bucket(g)]) - math.log(sides[1][bucket(g)]) for g in plain_grams(text)]))
        assert np.allclose(margins, want, atol=1e-4), text
        loss = [sum(w * math.log1p(math.exp(-language.SHARPNESS * m * c)) for w, m, c in zip(codes.weight, want, code, strict=True)) for code in codes.code]
        share = np.exp(-language.CERTAINTY * (np.array(loss) - min(loss)))
        best, score, _ = codes.decode(margins[None])
        assert best[0] == np.argmin(loss) and score[0] == pytest.approx(share.max() / share.sum(), rel=1e-3)


def test_texts_in_two_languages_are_ambiguous(spark):
    """Half and half is flagged and goes, a text in one language or with a quarter of another stays, one without letters goes."""
    import random

    from tests.llm.conftest import frame, prose

    rng = random.Random(5)
    pure = [[i, prose(rng, ("en", "de", "fr")[i % 3], 80), ("en", "de", "fr")[i % 3], "s"] for i in range(150)]
    half = [[1000 + i, prose(rng, "en", 60) + " " + prose(rng, "de", 53), "en", "s"] for i in range(20)]
    mostly = [[2000 + i, prose(rng, "fr", 90) + " " + prose(rng, "en", 20), "fr", "s"] for i in range(10)]
    docs = frame(spark, pure + half + mostly + [[3000, "1 2 3", "en", "s"]])
    codes = language.fit(docs.filter("doc_id < 1000"))
    got = {r.doc_id: r for r in language.identify(docs.select("doc_id", "text"), codes).collect()}
    assert not any(got[r[0]].ambiguous for r in pure + mostly) and sum(got[r[0]].ambiguous for r in half) >= 14
    kept = {r.doc_id for r in language.in_a_language(docs, codes).collect()}
    assert kept == {d for d, r in got.items() if not r.ambiguous} - {3000}


def test_long_texts_are_like_short_ones(monkeypatch):
    """Fingerprints, languages and base counts of a text in pieces are those of the whole."""
    rng = np.random.default_rng(4)
    text = " ".join(f"w{x}" + ("\n" if x % 9 == 0 else "") for x in rng.zipf(1.3, 30_000) % 5000)
    (chunk,) = fingerprints.arrays.chunks(pa.array([text]), 1 << 30)
    whole, counts = fingerprints.signatures(*chunk[2:]), quality.base_counts(*chunk[2:])
    monkeypatch.setattr(fingerprints.arrays, "CHUNK_BYTES", 10_000)
    monkeypatch.setattr(fingerprints, "TERMS", 512)
    assert (fingerprints.signatures(*chunk[2:])[0] == whole[0]).all()
    assert {k: v.tolist() for k, v in quality.base_counts(*chunk[2:]).items()} == {k: v.tolist() for k, v in counts.items()}
    assert [int(counts[c][0]) for c in quality.BASE] == list(base(text))


def test_ranges(spark):
    """A binary search in the plan, of one size for any number of bounds."""
    for bounds in ([], [5], [1, 3, 9], list(range(0, 9000, 3))):
        keys = [-5, 0, 1, 2, 3, 4, 5, 8, 9, 10, 8997, 10**12]
        got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", fingerprints.range_of(spark_col("k"), bounds).alias("r"))
        assert {r.k: r.r for r in got.collect()} == {k: sum(b <= k for b in bounds) for k in keys}


def spark_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


def test_codewords_keep_apart():
    for n in (2, 3, 4, 6):
        code = language.codewords(n)
        assert code.shape == (n, 2 ** (n - 1) - 1) and len({tuple(c) for c in code}) == n
    code = language.codewords(20)
    assert min((code[a] != code[b]).sum() for a in range(20) for b in range(a)) >= 10
    assert language.codewords(1).shape == (1, 0)


def test_mix(spark, sf, rows):
    got = mixing.op3(spark, sf).collect()
    again = sorted(mixing.op3(spark, sf).collect(), key=str)
    assert sorted(got, key=str) == again and len(got) == len(rows)
    size = collections.Counter()
    for _, text, _, source in rows:
        size[source] += len(WORD.findall(text or ""))
    order = sorted((s for s in size if s is not None)) + [s for s in size if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    fixed, total = {}, sum(size.values())
    while True:
        rest = [s for s in order if s not in fixed]
        share = (total - sum(fixed.values())) / sum(weight[s] for s in rest)
        above = [s for s in rest if share * weight[s] > 3 * size[s]]
        if not above:
            break
        fixed |= {s: 3 * size[s] for s in above}
    want = {s: fixed.get(s, share * weight[s]) for s in order}
    # Source sizes tell the sources apart here.
    assert len(set(size.values())) == len(size)
    taken = collections.Counter()
    for r in got:
        assert r.taken <= 3 * r.size
        taken[r.source_size] += r.taken
    for s in order:
        assert all(r.target == pytest.approx(want[s]) for r in got if r.source_size == size[s])
        assert abs(taken[size[s]] - want[s]) <= mixing.BLOCK / 2


def test_mix_blocks_are_disjoint_and_shards_even(spark, sf):
    blocks = mixing.mix(spark.read.parquet(f"{sf}/documents.parquet"), block=8).filter("taken")
    rows = blocks.collect()
    assert len({(r.doc_id, r.source, r["size"], r["copy"], r["block"], r["pass"]) for r in rows}) == len(rows)
    n = collections.Counter(r.shard for r in rows)
    assert set(n) == set(range(8)) and max(n.values()) - min(n.values()) <= 8


def test_mix_is_the_plain_one(spark, sf):
    """Which blocks are taken, their shards and places, against lists in the order of their hashes; and documents written in that order."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = mixing.mix(docs, block=8).withColumn("hash", spark_hash()).collect()
    taken = collections.defaultdict(list)
    for source in {r.source_no for r in rows}:
        mine = sorted((r for r in rows if r.source_no == source), key=lambda r: (r["pass"], r.hash % mixing.BUCKETS, r.hash, r.doc_id or 0, r["size"], r["copy"], r["block"]))
        upto = 0
        for r in mine:
            after = upto + r.words
            want = upto < r.target and (after <= r.target or after - r.target <= r.target - upto)
            assert r.taken == want
            if want:
                taken[source].append(r)
            upto = after
    dealt = mixing.split_quotas([len(taken[i]) for i in range(max(taken) + 1)], mixing.SHARDS)
    for source, mine in taken.items():
        assert [r.shard for r in mine] == [j for j, d in enumerate(dealt) for _ in range(d[source])]
    got = [r.doc_id for r in mixing.mixed_documents(docs).select("doc_id").collect()]
    whole = mixing.mix(docs, block=1 << 30).filter("taken").orderBy("shard", "place").collect()
    assert got == [r.doc_id for r in whole]


def spark_hash():
    from pyspark.sql import functions as F

    return F.xxhash64(F.lit(mixing.SEED), "pass", "doc_id", "size", "copy", "block")


def test_split_quotas():
    for quotas in ([0, 0], [5, 0, 17], [1000, 10, 1], []):
        dealt = mixing.split_quotas(quotas, 8)
        assert [sum(x) for x in zip(*dealt, strict=True)] == quotas
        sizes = [sum(x) for x in dealt]
        assert max(sizes) - min(sizes) <= 3 and all(k >= 0 for d in dealt for k in d)
    draws = [mixing._hypergeometric(30, 100, 40, __import__("random").Random(i)) for i in range(2000)]
    assert abs(np.mean(draws) - 12) < 0.2 and abs(np.var(draws) - 40 * 0.3 * 0.7 * 60 / 99) < 0.7


def base(text):
    words = WORD.findall(text)
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    n = collections.Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if n[w] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), repeats, len(covered)


def test_quality(spark, sf, rows):
    got = collections.defaultdict(list)
    for r in quality.op4(spark, sf).collect():
        got[r.doc_id].append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    for doc_id, text, *_ in rows:
        assert base(text or "") in got[doc_id]


def test_quality_counts_repeats():
    texts = ["a b c d e a b c d e", "x\nx\n\nx\r\nx\n \n ", "one two three four five six one two three four five", "| # 日本 & é", "q\nq", "", " ", "z z z z z z z"]
    (chunk,) = quality.arrays.chunks(pa.array(texts))
    found = quality.base_counts(*chunk[2:])
    assert [tuple(int(found[c][i]) for c in quality.BASE) for i in range(len(texts))] == [base(t) for t in texts]


def test_quality_keeps_prose_and_drops_noise(spark):
    import random

    from tests.llm.conftest import frame, prose

    rng = random.Random(1)
    plain = [[i, prose(rng, ("en", "de")[i % 2], 150), ("en", "de")[i % 2], "s"] for i in range(120)]
    noise = [[1000 + i, " ".join(w + "&&&$$$###"[rng.randrange(7) :] for w in prose(rng, "en", 150).split()), "en", "s"] for i in range(3)]
    kept = {r.doc_id for r in quality.accepted(frame(spark, plain + noise)).collect()}
    assert kept == {r[0] for r in plain}


def test_quality_bands_need_support_and_count_copies_once(spark):
    """A noisy document alone in its length or language is rejected; copies over half of a language neither move its median nor pass as noise."""
    import random

    from tests.llm.conftest import frame, prose

    rng = random.Random(8)
    noise = lambda lang, n: " ".join(w + rng.choice(["###", "$$$", "&&&", "%%%"]) for w in prose(rng, lang, n).split())
    plain = [[i, prose(rng, ("en", "de")[i % 2], rng.randint(60, 120)), ("en", "de")[i % 2], "s"] for i in range(200)]
    hot = noise("de", 80)
    odd = [[1000, noise("en", 3000), "en", "s"], [1001, noise("fr", 90), "fr", "s"], [1002, prose(rng, "en", 3000), "en", "s"], *([2000 + i, hot, "de", "s"] for i in range(150))]
    kept = {r.doc_id for r in quality.accepted(frame(spark, plain + odd)).collect()}
    assert len(kept & set(range(200))) >= 190 and 1002 in kept and not kept & {1000, 1001, *range(2000, 2150)}


def test_model_is_a_distribution(spark, tmp_path):
    """Probabilities of all 256 bytes after any context sum to one, seen or not."""
    docs = spark.createDataFrame([("abcabcabd abd ü",), ("bca bca",)], "text string")
    model = quality.write_model(quality.gram_counts(docs), f"file://{tmp_path}/lm")
    for context in (b"abc", b"zzz", b"xab", b"\0\0\0", b"\0\0a"):
        grams = np.array([int.from_bytes(context + bytes([c]), "big") for c in range(256)], np.uint32)
        assert np.exp(quality.log_probability(model, grams)).sum() == pytest.approx(1, abs=1e-5)


def plain_byte_model(texts):
    """log p of the last byte of four, by dictionaries."""
    order = {4: collections.Counter(padded[i : i + 4] for t in texts for padded in [b"\0\0\0" + t.encode()] for i in range(len(padded) - 3))}
    for k in (3, 2, 1):
        order[k] = collections.Counter(g[1:] for g in order[k + 1])
    d = {k: quality.discounts(*(sum(n == c for n in order[k].values()) for c in (1, 2, 3, 4))) for k in order}

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / 256
        after = [n for g, n in order[k].items() if g[:-1] == gram[:-1]]
        if not after:
            return p(gram[1:])
        n = order[k].get(gram, 0)
        return ((n - d[k][min(n, 3) - 1] if n else 0) + sum(d[k][min(x, 3) - 1] for x in after) * p(gram[1:])) / sum(after)

    return p


def test_byte_model_and_bands_are_the_plain_ones(spark):
    """Probabilities, medians, deviations and verdicts against dictionaries and lists."""
    import random
    import statistics

    from tests.llm.conftest import frame, prose

    rng = random.Random(2)
    rows = [[i, prose(rng, ("en", "de")[i % 2], 40 + i % 20), ("en", "de")[i % 2], "s"] for i in range(60)]
    rows += [[100, " ".join(w + "%%$$#" for w in prose(rng, "en", 45).split()), "en", "s"], [101, rows[0][1], "en", "s"], [102, "the the of of and and to to in in the of and to in " * 3, "en", "s"]]
    judge = quality.Judge(frame(spark, rows), ["doc_id"])
    got = {r.doc_id: r for r in judge.verdicts().collect()}
    p = plain_byte_model({t for _, t, *_ in rows})
    figures = {}
    for d, t, lang, _ in rows:
        padded = b"\0\0\0" + t.encode()
        nats = -sum(math.log(p(padded[i : i + 4])) for i in range(len(padded) - 3))
        n, chars, *_ , repeated = base(t)
        assert got[d].nats == pytest.approx(nats, rel=1e-5)
        if n >= 10 and 100 * repeated <= 20 * n:
            figures[d] = (lang, t, int(math.log2(n)), nats / n, nats / chars)
    unique = {(lang, t): x for lang, t, *x in figures.values()}
    for which, k in ((1, "word_ppl"), (2, "char_ppl")):
        middle = {}
        for lang in ("en", "de"):
            values = sorted(x[which] for (at, _), x in unique.items() if at == lang)
            middle[lang] = values[(len(values) - 1) // 2]
        away = {lang: statistics.median([abs(x[which] / middle[lang] - 1) for (at, _), x in unique.items() if at == lang]) for lang in middle}
        common = statistics.median([abs(x[which] / middle[at] - 1) for (at, _), x in unique.items()])
        low, high = quality.BANDS[k]
        for d, (lang, _, _, *x) in figures.items():
            spread = max(1.4826 * away[lang], 1.4826 * common, quality.LEAST_DEVIATION) * middle[lang]
            z = (x[which - 1] - middle[lang]) / spread
            if z > 1.1 * high:
                assert got[d].above and not got[d].kept
            if z < -1.1 * low:
                assert got[d].below and not got[d].kept
            if got[d].above and which == 1:
                assert z > 0.9 * high or got[d].char_ppl > got[101].char_ppl
    assert not got[100].kept and got[100].above
    assert sum(r.kept for r in got.values()) >= 58


def test_lower_band_drops_repetition(spark):
    """Text of the commonest words over and over, which the windows of five do not see, is too cheap."""
    import random

    from tests.llm.conftest import frame

    rng = random.Random(12)
    vocab = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    word = lambda: vocab[min(int(rng.paretovariate(0.3)) - 1, 2999)]
    plain = [[i, " ".join(word() for _ in range(rng.randint(130, 250))), "en", "s"] for i in range(150)]
    # No window of five words twice, so that the base rules have nothing against it.
    cheap, seen = [], set()
    while len(cheap) < 180:
        window = (*cheap[-4:], rng.choice(vocab[:5]))
        if len(window) < 5 or window not in seen:
            seen.add(window)
            cheap.append(window[-1])
    cheap = " ".join(cheap)
    got = {r.doc_id: r for r in quality.Judge(frame(spark, [*plain, [999, cheap, "en", "s"]]), ["doc_id"]).verdicts().collect()}
    assert got[999].below and not got[999].base_failed and not got[999].kept
    assert sum(got[i].kept for i in range(150)) >= 149


def test_bpe(spark, sf, rows):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    enc = bpe.encoding(path)
    got = collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op5(spark, sf).collect())
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        ids = enc.encode_ordinary(text or "")
        want[doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert got == want


def odd_texts(n, length):
    rng = __import__("random").Random(2)
    parts = ["a", "b", "'s", " ", "  ", "\n", "\t", " ", "　", "\u0085", "é", "日", "1", "23", "!", "<|endoftext|>", "\x1c", "\x1f", "\x00", "'", " ", "«", "𠀀", " x", " é", ",", ".\n"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, length))) for _ in range(n)]


def test_bpe_pieces_are_safe():
    path = P.path("byte_bpe_multi_50k.tiktoken")
    for text in odd_texts(200, 300):
        assert bpe.encode(text, path, 20) == bpe.encoding(path).encode_ordinary(text)
        assert "".join(bpe.safe_pieces(text, 20)) == text


def plain_fingerprint(text):
    words = WORD.findall(text.translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(values, radius):
    up = list(range(len(values)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= radius:
                up[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(len(values))]


def test_simhash(spark, sf, rows):
    got = collections.Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.op6(spark, sf).collect())
    prints = [plain_fingerprint(t or "") for _, t, *_ in rows]
    roots = components(prints, 4)
    least = {}
    for (doc_id, *_), r in zip(rows, roots, strict=True):
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    assert got == collections.Counter((d, f"{p:016x}", least.get(r)) for (d, *_), p, r in zip(rows, prints, roots, strict=True))


def test_links_join_chains_and_crowds(spark):
    """A chain of small steps and a crowd of near copies, over tiles much smaller than either."""
    rng = __import__("random").Random(4)
    chain, x = [], rng.getrandbits(64)
    for _ in range(60):
        chain.append(x)
        for b in rng.sample(range(64), 3):
            x ^= 1 << b
    centre = rng.getrandbits(64)
    crowd = [centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    values = sorted({*chain, *crowd, *(rng.getrandbits(64) for _ in range(200))})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), tile=16)
    label = {r.u: r.root for r in simhash.components(edges).collect()}
    groups = collections.defaultdict(set)
    for v, s in zip(values, signed, strict=True):
        groups[label.get(s, s)].add(v)
    want = collections.defaultdict(set)
    for v, r in zip(values, components(values, 4), strict=True):
        want[r].add(v)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in want.values()}


def test_representatives(spark, sf, rows):
    kept = simhash.representatives(spark.read.parquet(f"{sf}/documents.parquet"))
    found = [(r.doc_id, r.text) for r in kept.collect()]
    ids = [d for d, _ in found]
    # Two documents share the id 110.
    assert len(set(found)) == len(found) and ids.count(110) == 2 and kept.columns == spark.read.parquet(f"{sf}/documents.parquet").columns
    assert 7 in ids and not {103, 104} & set(ids)


def test_representatives_tell_rows_by_id_and_text(spark):
    """Rows without an id, or with one id and unlike texts, are documents of their own; copies of a text are one."""
    rng = __import__("random").Random(3)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40))
    unlike = [text() for _ in range(6)]
    rows = list(zip([None, None, None, 5, 5, 6], unlike, range(6), strict=True))
    schema = "doc_id long, text string, at int"
    got = simhash.representatives(spark.createDataFrame(rows, schema).repartition(3)).collect()
    assert sorted(r.text for r in got) == sorted(unlike) and {r["at"] for r in got} == set(range(6))
    more = [*rows, (None, unlike[3], 9), (7, unlike[0], 8), (6, unlike[5], 1), (None, None, 3), (8, "", 4)]
    got = simhash.representatives(spark.createDataFrame(more, schema).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(7, unlike[0], 8), *rows[1:5], (6, unlike[5], 1), (8, "", 4)], key=str)


def test_components_of_long_paths_and_stars(spark):
    """A path of 2,000 nodes in order, one in random order, and a star, with hot keys dealt apart or not."""
    rng = __import__("random").Random(7)
    shuffled = rng.sample(range(10_000, 12_000), 2000)
    edges = [*zip(range(2000), range(1, 2001)), *zip(shuffled, shuffled[1:]), *((20_000, k) for k in range(20_001, 20_500)), (5, 5)]  # noqa: B905
    got = collections.defaultdict(set)
    for r in simhash.components(spark.createDataFrame(edges, "u long, v long").repartition(3)).collect():
        got[r.root].add(r.u)
    assert sorted(map(sorted, got.values())) == [list(range(2001)), list(range(10_000, 12_000)), list(range(20_000, 20_500))]


def test_hot_join_is_a_join(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 100)
    monkeypatch.setattr(simhash, "HOT_KEYS", 5)
    rows = spark.createDataFrame([(i % 50 if i % 3 else 7, i) for i in range(1000)], "k int, x int")
    named = spark.createDataFrame([(k, f"n{k}") for k in range(0, 50, 2)] + [(7, "hot")], "k int, name string")
    got = sorted(map(tuple, simhash.hot_join(rows, named, "k").select("k", "x", "name").collect()))
    assert got == sorted(map(tuple, rows.join(named, "k").select("k", "x", "name").collect())) and len(got) > 500


def test_crowds_are_joined_by_rows():
    """5,000 near copies: 25 million pairs, a few thousand steps."""
    rng = np.random.default_rng(1)
    bits = np.uint64(1) << rng.integers(0, 64, (5000, 2), dtype=np.uint64)
    crowd = np.unique(np.uint64(0x0123456789ABCDEF) ^ bits[:, 0] ^ bits[:, 1])
    far = rng.integers(1, 1 << 63, 3000, dtype=np.uint64)
    forest, began = simhash.Forest(), __import__("time").perf_counter()
    simhash.link_tile(np.concatenate((crowd, far)), np.concatenate((crowd, far)), 4, forest)
    assert {forest.root(int(x)) for x in crowd} == {int(crowd.min())} and __import__("time").perf_counter() - began < 10


def test_shards(spark, sf, rows):
    got = sharding.op7(spark, sf).collect()
    want = collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    by_id = {d: t for d, t, *_ in rows}
    texts = collections.defaultdict(set)
    for r in got:
        if r.doc_id not in (None, 110):
            texts[by_id[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in texts.values())


def test_shards_are_even(spark):
    """With a group of copies of a twentieth of all bytes whole, and one of two fifths spread."""
    rng = __import__("random").Random(6)
    for copies, length in ((20, 2000), (400, 2000)):
        rows = [(i, "".join(rng.choice("ab é\n") for _ in range(rng.randint(100, 1000)))) for i in range(1500)] + [(5000 + i, "copy" * (length // 4)) for i in range(copies)]
        got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        size = collections.Counter()
        for r in got:
            size[r.shard] += r["size"]
        mean = sum(size.values()) / 8
        assert len(size) == 8 and max(abs(s - mean) for s in size.values()) < 0.05 * mean, size
        if copies == 20:
            assert len({r.shard for r in got if r.doc_id >= 5000}) == 1


@pytest.mark.parametrize("heavy", [False, True])
def test_tree_against_plain_sorting(spark, heavy):
    """Each node's groups sorted along its widest dimension and cut at the prefix nearest to the room of its left half."""
    rng = __import__("random").Random(17)
    texts = ["".join(rng.choice("abcdefgh é日\n" if rng.random() < 0.5 else "ab c") for _ in range(rng.randint(60, 200))) for _ in range(3600)]
    texts += rng.sample(texts, 300) + [f"heavy text {rng.random()} " * rng.randint(150, 400) for _ in range(9 if heavy else 0)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    measured = sharding.measured(docs).collect()
    size, point = collections.Counter(), {}
    for r in measured:
        size[r.hash] += r["size"]
        point[r.hash] = [r.dim0, r.dim1, r.dim2]
    total, shards = sum(size.values()), 8
    room, home = [total / shards] * shards, {}
    for h in sorted((h for h in size if size[h] * 100 * shards > total), key=lambda h: (-size[h], h)):
        home[h] = room.index(max(room))
        room[home[h]] -= size[h]
    assert bool(home) == heavy
    light = [h for h in size if h not in home]
    width = lambda hs, d: max(point[h][d] for h in hs) - min(point[h][d] for h in hs)
    span = [width(light, d) or 1 for d in range(3)]

    def split(hs, leaves):
        if len(leaves) == 1:
            home.update(dict.fromkeys(hs, leaves[0]))
            return
        d = max(range(3), key=lambda d: width(hs, d) / span[d])
        low, across = min(point[h][d] for h in hs), width(hs, d)
        key = lambda h: (min(255, math.floor((point[h][d] - low) / across * 256)) if across else 0, (h % (1 << 64)) >> 16)
        hs, half = sorted(hs, key=key), leaves[: len(leaves) // 2]
        goal = sum(size[h] for h in hs) * (sum(room[j] for j in half) / sum(room[j] for j in leaves))
        upto = [0]
        for h in hs:
            upto.append(upto[-1] + size[h])
        cut = min(range(len(upto)), key=lambda i: (abs(upto[i] - goal), i))
        split(hs[:cut], half)
        split(hs[cut:], leaves[len(leaves) // 2 :])

    split(light, list(range(shards)))
    want = {r.doc_id: home[r.hash] for r in measured}
    assert {r.doc_id: r.shard for r in sharding.shard(docs).collect()} == want


def test_cells_that_are_cut_again_give_the_same_cuts(spark, sf, monkeypatch):
    """Medians found in one cell or by cutting cells down to single keys."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = sorted(map(tuple, sharding.shard(docs).collect()), key=str)
    monkeypatch.setattr(sharding, "CELL", 1)
    assert sorted(map(tuple, sharding.shard(docs).collect()), key=str) == want


def test_token_files(spark, sf, rows):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    start, want = 0, []
    for doc_id, text, *_ in sorted(rows, key=key):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_files.op8(spark, sf).collect()), key=lambda x: x[1]) == want


def test_units_are_safe():
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = odd_texts(3000, 30) + ["hello <|endoftext|> world", "<|endoftext|><|endoftext|>", "x<|endoftext|", "|>a<|endoftext|>b", *thue_morse(4096), "<|endoftext|>"]
    found = [x for _, ids, ends in token_files.encode_with_end(pa.array(texts), path, 7) for x in np.split(ids, ends[:-1])]
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 7], text


def thue_morse(n):
    one = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return [one, one.translate(str.maketrans("ab", "ba"))]


@pytest.mark.parametrize("n", [256, 1024, 2048, 4096, 8192])
def test_spans_with_different_bytes_hash_differently(n):
    """Strings on which polynomials modulo a power of two agree; as lines, words, terms and units."""
    a, b = thue_morse(n)
    (chunk,) = quality.arrays.chunks(pa.array([f"{a}\n{b}"]))
    starts, ends, _ = quality.arrays.spans(*chunk[2:])
    for seed in (0, 1):
        h = quality.arrays.span_hashes(chunk[2], starts, ends, seed)
        assert h[0] != h[1]
    assert quality.base_counts(*chunk[2:])["n_dup_lines"].tolist() == [0]
    sigs, _ = fingerprints._of_texts([a, b], 64)
    assert (sigs[0] != sigs[1]).any()


def test_hashes_do_not_depend_on_the_place():
    rng = np.random.default_rng(5)
    raw = rng.integers(0, 4, 3000, dtype=np.uint8)
    starts = rng.integers(0, 2400, 2000)
    ends = starts + rng.integers(0, 600, 2000)
    by_bytes = collections.defaultdict(set)
    for a, b, h in zip(starts, ends, quality.arrays.span_hashes(raw, starts, ends), strict=True):
        by_bytes[raw[a:b].tobytes()].add(int(h))
    assert all(len(x) == 1 for x in by_bytes.values()) and len(set().union(*by_bytes.values())) == len(by_bytes)


def test_units_that_collide_are_told_apart(monkeypatch):
    """With a hash that often collides, ids are still the library's."""
    path = P.path("byte_bpe_50k.json")
    whole = token_files.arrays.span_hashes
    monkeypatch.setattr(token_files.arrays, "span_hashes", lambda *x: whole(*x) if len(x) > 3 else whole(*x) % np.uint64(50))
    coder, library = token_files.Encoder(path), Tokenizer.from_file(path)
    for k in range(5):
        texts = odd_texts(50 * (k + 1), 30)[50 * k :]
        (chunk,) = token_files.arrays.chunks(pa.array(texts))
        ids, n = coder.encode(*chunk[2:])
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_planes_round_trip():
    ids = np.random.default_rng(1).integers(0, 1 << 32, 10_000, dtype=np.uint32)
    raw = token_files.pack(ids, [[3, 0, 10_000]], block=999)
    assert (token_files.unpack(raw) == ids).all() and token_files.read_index(raw)["docs"] == [[3, 0, 10_000]]
    for a, b in ((0, 0), (998, 1000), (5000, 9999), (9990, 10_000)):
        assert (token_files.unpack(raw, a, b) == ids[a:b]).all()
    assert not len(token_files.unpack(token_files.pack(np.zeros(0, np.uint32), [])))


@pytest.mark.parametrize(("shard_bytes", "chunk", "gather"), [(16 << 20, 2 << 20, 3_000_000), (5000, 1 << 16, 20_000)])
def test_word_lm(spark, sf, rows, monkeypatch, shard_bytes, chunk, gather):
    """With one cell or many, and with long texts whole or in pieces."""
    import functools

    monkeypatch.setattr(word_lm, "fit", functools.partial(word_lm.fit, shard_bytes=shard_bytes))
    tokens = [(d, [*WORD.findall((t or "").translate(LOWER)), "\0end"]) for d, t, *_ in rows]
    train = [x for d, x in tokens if remainder(d) != 1]
    seen = collections.Counter(w for x in train for w in x)
    pairs = collections.Counter(p for x in train for p in zip(["\0start", *x], x))  # noqa: B905
    kinds = collections.Counter(w for _, w in pairs)
    of = lambda c: word_lm.discounts([sum(n == k for n in c.values()) for k in (1, 2, 3, 4)])
    d2, d1, n, v = of(pairs), of(kinds), sum(seen.values()), len(seen)
    after = collections.defaultdict(lambda: [0, 0.0])
    for (a, _), k in pairs.items():
        after[a][0] += k
        after[a][1] += d2[min(k, 3)]
    spare = sum(d1[min(k, 3)] for k in kinds.values()) / len(pairs)

    def p(a, w):
        q = max(kinds[w] - d1[min(kinds[w], 3)], 0) / len(pairs) + spare / (v + 1)
        total, held = after.get(a, (0, 0))
        return max(pairs[a, w] - d2[min(pairs[a, w], 3)], 0) / total + held / total * q if total else q

    got = collections.defaultdict(list)
    for r in word_lm.op10(spark, sf).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    for d, x in tokens:
        want = sum(math.log10(p(a, w)) for a, w in zip(["\0start", *x], x))  # noqa: B905
        plain = sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)
        (r, *_) = [r for r in got[d] if r.n_tokens == len(x) and r.score == pytest.approx(want)]
        assert (r.n_known, r.train_tokens, r.held_out) == (sum(seen[w] > 0 for w in x), n, remainder(d) == 1)
        assert r.base_score == pytest.approx(plain)


def test_pieces_are_the_texts():
    texts = ["", None, "ab  cd " * 50, "x" * 900 + " y", " " * 700 + "z " * 300, "é日 \n" * 200, "a b", "x" * 2000]
    for limit in (7, 64, 500):
        found, starts = [b""] * len(texts), []
        for lo, hi, buf, offsets, more in word_lm.arrays.pieces(pa.array(texts), limit):
            for i in range(lo, hi):
                found[i] += buf[offsets[i - lo] : offsets[i - lo + 1]].tobytes()
            assert hi == lo + 1 or not more
            if more:
                starts.append(len(found[lo]))
                assert re.fullmatch(rb".*[\x20\x09-\x0d]", found[lo], re.S)
        assert found == [(t or "").encode() for t in texts]


def test_token_pieces(monkeypatch):
    """Tokens and the tokens before them are the same whether a text is cut or not."""
    texts = pa.array(["a b c d " * 100, None, "e", "long " * 400, ""])

    def run(chunk):
        monkeypatch.setattr(word_lm, "CHUNK", chunk)
        parts = list(word_lm._tokens(texts))
        return np.concatenate([x[2] for x in parts]).tolist(), np.concatenate([x[4] for x in parts]).tolist()

    assert run(1 << 20) == run(50) == run(7)


def test_counts_of_any_size(tmp_path):
    """Counts beyond a byte and beyond 32 bits come back as they are; a missing file is an error."""
    keys, n = np.array([1, 5, 9, 1 << 63], np.uint64), np.array([3, 255, 1 << 40, 254])
    hash_store.write(f"file://{tmp_path}", "x1", keys, [("small", n), ("<f4", n)])
    present = hash_store.shards_present([1, 3], 2)
    look = lambda keys, shard: hash_store.find(f"file://{tmp_path}", "x", present, ("small", "<f4"), keys, np.full(len(keys), shard))
    assert look(np.array([9, 2, 1 << 63, 1, 5], np.uint64), 1)[0].tolist() == [1 << 40, 0, 254, 3, 255]
    assert look(keys, 2)[0].tolist() == [0] * 4
    with pytest.raises(FileNotFoundError):
        look(keys, 3)


PAGES = [
    ("http://a.example/1", "<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Menu</a></nav><div class='ad'>Buy</div><article><h1>Head &amp; tail</h1><p>One\n two<p><b>Three<br>four</b></p></article><footer>End</footer></body>", "Head & tail\nOne two\nThree four"),
    ("http://b.example/1", "<body><div id=top>Site name</div><div class=text><h2>First</h2><p>Alpha beta gamma</p></div><div class='user-comments'><p>Nice</p></div><p>Copyright line</p></body>", "First\nAlpha beta gamma"),
    ("http://b.example/2", "<body><div id=top>Site name</div><div class=text><h2>Second</h2><p>Delta epsilon</p><ul><li>x<li>y</ul></div><p>Copyright line</p></body>", "Second\nDelta epsilon\nx\ny"),
    ("http://b.example/3", "<body><div id=top>Site name</div><div class=text><h2>Third</h2><p>Zeta</p></div><p>Copyright line</p></body>", "Third\nZeta"),
    ("http://b.example/3", "<body><div id=top>Site name</div><div class=text><h2>Third</h2><p>Zeta</p></div><p>Copyright line</p></body>", "Third\nZeta"),
    (None, None, ""),
    ("http://c.example", "", ""),
    ("http://c.example", "plain &lt;text&gt; only <!-- x --> here", "plain <text> only here"),
    ("http://d.example", "<article><p>" + "word " * 50_000 + "</article><p>after", ("word " * 50_000).strip()),
    ("http://e.example", "<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    ("http://f.example", "<body><main><table><tr><td>a<td>b</table><script>if (1 < 2) x('</p>')</script><form>f</form><p>cut <b", "a\nb\ncut <b"),
]


def test_articles(spark, empty_sf):
    rows = [(i, u, h, "z", 1) for i, (u, h, _) in enumerate(PAGES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host int").repartition(3)
    got = {r.page_id: r for r in articles.main_text(pages).collect()}
    for i, (url, _, want) in enumerate(PAGES):
        assert (got[i].url, got[i].text, got[i].n_chars) == (url, want, len(want)), i
    assert articles.op9(spark, empty_sf).collect() == []


def test_versions_of_an_article_keep_their_text(spark):
    """Near copies on a host of few pages share nearly all, which is no template as long as another page has none of it."""
    long = "Shared paragraph of some length that stands in every version of the article."
    page = lambda end: f"<article><h1>Title</h1><p><b>Title</b></p><p>{long}</p><p>{end}</p></article>"
    small = [(1, "http://a/1", page("Old ending.")), (2, "http://a/2", page("New ending.")), (3, "http://a/3", "<article><p>Other.</p></article>")]
    more = [(10 + i, f"http://b/{i}", page(f"Ending {i}.")) for i in range(6)] + [(20, "http://b/20", "<article><p>Other.</p></article>")]
    rows = spark.createDataFrame([*small, *more], "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in articles.main_text(rows).collect()}
    assert got[1] == f"Title\nTitle\n{long}\nOld ending." and got[2] == f"Title\nTitle\n{long}\nNew ending." and got[3] == got[20] == "Other."
    assert all(got[10 + i] == f"Title\nTitle\n{long}\nEnding {i}." for i in range(6))


def test_templates_rule_articles(spark):
    """Lines that a host's pages share go from articles too; a text split over articles stays whole, whatever stands in a line with it."""
    page = lambda i: f"<body><div class=wrap><article><h1>Title {i}</h1><p>By <b>author {i}</b></p><p>First part {i}</p><p>Posted by the editors</p></article><article><p>Second {i}</p></article></div><footer>End {i}</footer></body>"
    pages = spark.createDataFrame([(i, "http://a.example/", page("abcde"[i])) for i in range(5)], "page_id long, url string, html string").repartition(2)
    got = {r.page_id: r.text for r in articles.main_text(pages).collect()}
    assert got == {i: f"Title {c}\nBy author {c}\nFirst part {c}\nSecond {c}" for i, c in enumerate("abcde")}


def test_template_texts_are_counted_exactly(spark):
    """A line that all pages share is known among any number of others; copies of a page count as one page."""
    body = lambda i: "".join(f"<p>Paragraph {i} {j}</p>" for j in range(60))
    rows = [(i, "http://a.example/", f"<body><div>{body(i)}<p>All rights reserved</p></div></body>") for i in range(6)]
    rows += [(10 + i, "http://b.example/", f"<body><div>{body(min(i, 2))}</div></body>") for i in range(20)]
    got = {r.page_id: r.text for r in articles.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    want = lambda i: "\n".join(f"Paragraph {i} {j}" for j in range(60))
    assert got == {i: want(i) for i in range(6)} | {10 + i: want(min(i, 2)) for i in range(20)}


def test_tree_matching_merges_by_order():
    page = lambda x: articles.fold(articles.parse(x))
    tree = page("<body><h1>a</h1><div><p>x</p></div></body>")
    assert articles._score(tree, page("<body><div><p>y</p></div></body>")) == 4
    articles.merge(tree, page("<body><h1>b</h1><aside>no</aside><section>s</section><div><p>y</p><p>z</p></div></body>"))
    assert list(tree.kids["body"].kids) == ["h1", "section", "div"]
    again = articles.Template.load(tree.dump())
    assert again.dump() == tree.dump() and again.kids["body"].n == 2


def test_tree_matching_is_the_greatest_matching():
    """Against a plain search over all matchings that keep the order."""
    rng = __import__("random").Random(6)

    def tree(depth):
        out = articles.Template(rng.choice("ab") if depth < 3 else "root")
        for key in rng.sample("abcd", rng.randint(0, 4)) if depth else []:
            kid = tree(depth - 1)
            kid.key = key
            out.kids[key] = kid
        return out

    def plain(a, b):
        def best(x, y):
            if not x or not y:
                return 0
            return max(best(x[1:], y), best(x, y[1:]), plain(x[0], y[0]) + best(x[1:], y[1:]) if x[0].key == y[0].key else 0)

        return 1 + best(list(a.kids.values()), list(b.kids.values()))

    for _ in range(60):
        a, b = tree(3), tree(3)
        assert articles._score(a, b) == plain(a, b)


def test_near_copies_are_those_from_the_similarity_on(spark):
    """All pairs from 0.80 to 0.85 are linked and none from 0.70 to 0.79, in one tile or several."""
    rng = __import__("random").Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    shingles = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    rows, want = [], {}
    for g in range(400):
        base, (low, high) = [word() for _ in range(300)], ((0.8, 0.85) if g % 2 else (0.7, 0.79))
        copy, alike = list(base), 1.0
        while alike > high:
            copy[rng.randrange(300)] = word()
            a, b = shingles(base), shingles(copy)
            alike = len(a & b) / len(a | b)
        if alike < low:
            continue
        rows += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(copy))]
        want |= {2 * g: 2 * g, 2 * g + 1: 2 * g + (alike < 0.8)}
    assert len(rows) > 600
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()} == want
    ids = simhash.wide_fingerprints(docs).selectExpr("doc_id", "xxhash64(fp, n) as id")
    first = ids.agg({"id": "min"}).first()[0]
    all_one = ids.selectExpr("id as u", f"{first} as v")
    # Tiles bounded by documents, and by shingles.
    for bounds in ({"tile": 100}, {"shingles": 40_000}):
        label = {r.u: r.root for r in simhash.components(simhash.verified(docs, all_one, **bounds)).collect()}
        assert len(label) == 2 * len(set(label.values())) == sum(want[2 * g] == want[2 * g + 1] for g in range(400) if 2 * g in want) * 2


def test_tiles_are_verified_pair_by_pair(monkeypatch):
    """Against all pairs, with candidates looked at singly or together, in one tile or across two."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(60):
        base = rng.integers(1, 1 << 60, rng.integers(1, 120), dtype=np.uint64)
        for _ in range(3):
            keep = base[rng.random(len(base)) > rng.choice([0.0, 0.05, 0.15])]
            rows.append((len(rows) + 1, rng.integers(0, 2, 4, dtype=np.uint64).tobytes(), np.unique(keep).tobytes()))
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    sets = [set(np.frombuffer(h, np.uint64).tolist()) for *_, h in rows]
    for singly in (0, 32, 1000):
        monkeypatch.setattr(simhash, "SINGLY", singly)
        for cut in (len(rows), 70):
            forest, want = simhash.Forest(), simhash.Forest()
            simhash.verify_tile(rows[:cut], rows[cut:], 256, 0.8, forest)
            for i in range(cut):
                for j in range(cut if cut < len(rows) else i + 1, len(rows)):
                    if alike(sets[i], sets[j]):
                        want.join(rows[i][0], rows[j][0])
            assert [forest.root(i) for i, *_ in rows] == [want.root(i) for i, *_ in rows]


def test_near_copies(spark):
    """Copies, light edits and a crowd of them are one group each; texts that share a passage are not."""
    rng = __import__("random").Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, want = [], {}
    for g in range(12):
        base = [word() for _ in range(rng.randint(150, 400))]
        for copy in range(40 if g == 0 else 4):
            words = list(base)
            if copy:
                words[rng.randrange(len(words))] = word()
            rows.append((1000 * g + copy, " ".join(words)))
            want[1000 * g + copy] = 1000 * g
    passage = [word() for _ in range(60)]
    for i in range(30):
        rows.append((20_000 + i, " ".join([*passage, *(word() for _ in range(150))])))
        want[20_000 + i] = 20_000 + i
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in simhash.near_copies(docs).collect()} == want
    assert {r.doc_id for r in simhash.representatives(docs).collect()} == set(want.values())
    distinct = simhash.wide_fingerprints(docs).selectExpr("xxhash64(fp, n) as id", "fp", "n").distinct()
    small = simhash.components(simhash.wide_links(distinct, tile=7)).groupBy("root").count().count()
    assert small == 12
