"""The pipeline, stage by stage, against what each stage should leave."""

import collections

from tidemark.llm import bpe
from tidemark.llm.common import table

import corpus_pipeline
from tests.llm.test_queries import base


def test_stages(spark, sf, rows, tmp_path):
    docs = table(spark, sf, "documents")
    columns, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        folder = f"{tmp_path}/{name}"
        stage(spark, docs, sf).write.parquet(folder)
        docs = spark.read.parquet(folder)
        left[name] = docs
        if name != "byte bpe":
            assert docs.columns == columns
    quality = {r.doc_id for r in left["quality rules"].collect()}
    failed = set()
    for d, t, *_ in rows:
        n, _, _, _, repeated = base(t or "")
        if n < 10 or 100 * repeated > 20 * n:
            failed.add(d)
    assert not quality & failed
    assert {r.doc_id for r in left["language id"].collect()} <= quality
    once = [r.doc_id for r in left["near duplicates"].collect()]
    assert len(once) == len(set(once)) and len(once) >= 60
    assert not {103, 104} & set(once)
    mixed = collections.Counter(r.doc_id for r in left["source mix"].collect())
    assert set(mixed) <= set(once) and max(mixed.values()) <= 3
    last = left["byte bpe"].collect()
    assert collections.Counter(r.doc_id for r in last) == mixed
    text, path = {d: t for d, t, *_ in rows}, bpe.vocabulary_path(bpe.RANKS)
    assert all(r.decodes and bpe.decode(list(r.ids), path).decode() == text[r.doc_id] and r.n_tokens == len(r.ids) for r in last)


def test_extra_columns_come_through(spark, rows, tmp_path):
    """Columns of the documents keep their values, also under names that the stages use."""
    from tests.llm.conftest import frame

    names = ["score", "size", "copy", "kept", "length", "n_words", "lang_pred"]
    docs = frame(spark, rows).drop(*names).selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in names])
    for name, stage in corpus_pipeline.STAGES[:4]:
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    found = docs.collect()
    assert found and all(r[n] == f"{n}{r.doc_id}" for r in found for n in names)


def test_run(spark, sf, empty_sf):
    done = corpus_pipeline.run(spark, sf)
    assert done.count() > 50 and done.filter("not decodes").count() == 0
    assert corpus_pipeline.run(spark, empty_sf).count() == 0
