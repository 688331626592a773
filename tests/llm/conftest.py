import random

import pytest

WORDS = {
    "en": "the of and to in is that for with was on as are by from this house river stone garden letter winter market number".split(),
    "de": "der die das und ist von mit auf für ein nicht haus fluss stein garten brief winter markt zahl über größe straße".split(),
    "fr": "le la les et est de des pour avec dans maison rivière pierre jardin lettre hiver marché nombre où été déjà être".split(),
}
#: Extra columns whose names the operators use themselves.
EXTRA = "score double, lang_pred string, size long, copy int, shard int, fp long, range int, kept boolean, n_words long, length int, ids string, host string, key long, node int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + (rng.choice([",", ".", ".\n", ""]) if rng.random() < 0.2 else "") for _ in range(n))


def documents():
    """Plain documents in three languages and sources (one holds a third of all), and the odd cases."""
    rng, rows = random.Random(5), []
    for i in range(90):
        lang = ("en", "de", "fr")[i % 3]
        rows.append([i, prose(rng, lang, rng.randint(15, 120)), lang, "hot" if i % 3 == 0 else f"s{i % 5}"])
    base = rows[7][1]
    odd = [
        (100, None, "en", "s1"), (101, "", "en", "s1"), (102, "  \n\t ", None, "s2"), (103, base, "de", "s2"), (104, base, None, None), (105, base.replace(" ", "  ", 1), "de", "s3"),
        (106, prose(rng, "en", 40_000), "en", "s3"), (107, "12345 678 !!", None, "s3"), (108, "naïve Straße 日本語 テキスト 𠀀  　x\u0085y", "de", ""), (109, "x" * 100_000, "en", "s4"),
        (110, "a b c", "en", "s4"), (110, "a b c", "en", "s4"), (110, "a b d", "en", "s4"), (None, "no id here at all", "en", "s4"), (111, "<|endoftext|> it's 's \x1c\x1f", "en", None),
    ]
    return rows + [list(x) for x in odd]


def frame(spark, rows):
    extra = len(EXTRA.split(", "))
    return spark.createDataFrame([(d, t, lang, s, len(t or ""), *[None] * extra) for d, t, lang, s in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def rows():
    return documents()


@pytest.fixture(scope="session")
def sf(spark, rows, tmp_path_factory):
    """A folder with the documents as the queries read them."""
    folder = tmp_path_factory.mktemp("sf")
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def empty_sf(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("none")
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def one_sf(spark, tmp_path_factory):
    """A single document, of no text."""
    folder = tmp_path_factory.mktemp("one")
    frame(spark, [[5, None, None, None]]).write.parquet(f"{folder}/documents.parquet")
    return str(folder)
