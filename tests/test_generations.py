"""Derived tables by generations, versions of a snapshot, and rewrites and searches over whole tables."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark import dims, storage
from tidemark.operators import discover as D
from tidemark.operators import graph as G
from tidemark.operators import rewrite as W
from tidemark.operators import terms as TM
from tidemark.plans import generations as N
from tidemark.plans.rebuild import link_and_rebuild
from tidemark.sources import reports as R
from tidemark.sources.versions import Overtaken, Versions

REPORT = "ticker string, company string, sector string, path string, content string"


def text(rng, names):
    link = lambda: f"[[{rng.choice(names)}]]"
    return f"# t [[{rng.choice(names)}]]\n\n## 業務簡介\n{link()} {link()} AI\n\n## 供應鏈位置\n**上游:** {link()}\n**下游:** {link()}\n\n## 主要客戶及供應商\n- {link()}\n\n## 財務概況\n{link()}"


def row(rng, ticker, names, sector=None):
    sector = sector or rng.choice(["A", "B", "C"])
    return (f"{ticker:04d}", f"c{ticker}", sector, f"/r/{sector}/{ticker:04d}_c{ticker}.md", text(rng, names))


def tables(generation):
    sets = {name: collections.Counter(tuple(r) for r in generation.table(name).collect()) for name in ("counts", "frequency", "pairs")}
    parsed = {r.ticker: (r.sector, sorted(r.file_names), sorted(r.body_names), sorted(map(tuple, r.entries)), r.last) for r in generation.table("parsed").collect()}
    return sets, parsed


def test_deltas_give_what_a_rebuild_gives(spark, tmp_path):
    """Reports rewritten, added and removed; names that come into two reports and names that drop out of them."""
    rng = random.Random(4)
    names = [f"n{i}" for i in range(40)] + ["HBM", "台積電"]
    held = {t: row(rng, t, names) for t in range(25)}
    root = f"file://{tmp_path}/g"
    N.first_generation(spark, spark.createDataFrame(list(held.values()), REPORT), root)
    for step in range(3):
        changed = [row(rng, t, names) for t in [*rng.sample(sorted(held), 6), 100 + step]]
        removed = rng.sample([t for t in sorted(held) if f"{t:04d}" not in {c[0] for c in changed}], 2)
        held.update({int(c[0]): c for c in changed})
        for t in removed:
            del held[t]
        made = N.next_generation(spark, root, spark.createDataFrame(changed, REPORT), spark.createDataFrame([(f"{t:04d}",) for t in removed], "ticker string"))
        whole = N.first_generation(spark, spark.createDataFrame(list(held.values()), REPORT), f"file://{tmp_path}/whole{step}")
        assert tables(made) == tables(whole)
    assert made.folder.endswith("/g000000004") and N.latest(spark, root).folder == made.folder
    with pytest.raises(RuntimeError):
        N._finish(spark, root, 4, f"{root}/g000000003")


def test_generations_of_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/g"
    none = spark.createDataFrame([], REPORT)
    with pytest.raises(RuntimeError):
        N.next_generation(spark, root, none)
    N.first_generation(spark, none, root)
    made = N.next_generation(spark, root, spark.createDataFrame([("0001", "c", "s", "p", None), ("0002", "c", "s", "q", "")], REPORT))
    assert made.table("counts").count() == 0 and made.table("parsed").count() == 2
    assert all(df.count() >= 0 for df in N.derived(made).values())


def test_link_and_refresh_by_deltas(spark, tmp_path):
    rng = random.Random(5)
    found = spark.createDataFrame([row(rng, t, ["x", "y", "HBM"]) for t in range(8)], REPORT)
    root = f"file://{tmp_path}/g"
    N.first_generation(spark, found, root)
    rows = lambda made: {name: sorted(map(str, df.collect())) for name, df in made.items()}
    assert rows(link_and_rebuild(spark, found, "AI", min_weight=1, root=root)[2]) == rows(link_and_rebuild(spark, found, "AI", min_weight=1)[2])
    assert N.latest(spark, root).folder.endswith("2")


def test_versions(spark, tmp_path):
    rng = random.Random(6)
    held = Versions(spark, f"file://{tmp_path}/v", REPORT)
    one = spark.createDataFrame([row(rng, t, ["x"], "AB"[t % 2]) for t in range(6)], REPORT)
    assert held.latest() == 0 and held.read().count() == 0
    assert held.overwrite(one, "one") == 1 and held.overwrite(one, "one") == 1
    changed = held.read(1, ["A"]).withColumn("content", F.lit("new"))
    assert held.overwrite(changed, "two", based_on=1) == 2
    assert held.manifest(2)["sectors"]["B"] == held.manifest(1)["sectors"]["B"]
    contents = lambda v: collections.Counter(r.content == "new" for r in held.read(v).collect())
    assert contents(1) == {False: 6} and contents(2) == {True: 3, False: 3}
    with pytest.raises(Overtaken):
        held.overwrite(changed, "three", based_on=1)
    assert held.overwrite(spark.createDataFrame([], REPORT), "four", sectors=["B"]) == 3 and held.read().count() == 3 and held.read(2).count() == 6


def test_two_writers_append_each_ticker_once(spark, tmp_path):
    rng = random.Random(7)
    mine, other = (Versions(spark, f"file://{tmp_path}/v", REPORT) for _ in range(2))
    rows = lambda tickers: spark.createDataFrame([row(rng, t, ["x"], "A") for t in tickers], REPORT)
    mine.append_new(rows([1, 2]), "first")
    write = mine._write

    def meanwhile(df, run):
        made = write(df, run)
        other.append_new(rows([3, 4]), "theirs")  # takes the version that mine was about to take
        return made

    mine._write = meanwhile
    mine.append_new(rows([2, 3, 5]), "mine")
    mine.append_new(rows([2, 3, 5]), "mine")
    assert sorted(r.ticker for r in mine.read().collect()) == ["0001", "0002", "0003", "0004", "0005"]
    assert mine.manifest(mine.latest())["runs"] == ["first", "theirs", "mine"]


def test_names_are_taken_once(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    assert storage.put_text(spark, path, "一") and not storage.put_text(spark, path, "二") and storage.get_text(spark, path) == "一"
    assert storage.names_in(spark, f"file://{tmp_path}/none") == [] and "a" in storage.names_in(spark, f"file://{tmp_path}")


@pytest.mark.parametrize("block", [1, 7, 256])
def test_pairs_of_hub_documents(spark, block):
    rng = random.Random(8)
    docs = {"a": [f"n{i}" for i in range(60)], "b": [f"n{i}" for i in range(40, 50)], "c": ["n1"], "d": rng.sample([f"n{i}" for i in range(60)], 33)}
    mentioned = spark.createDataFrame([(d, n) for d, names in docs.items() for n in names], "ticker string, name string")
    want = collections.Counter(p for names in docs.values() for p in itertools.combinations(sorted(names), 2))
    every = spark.createDataFrame([(f"n{i}",) for i in range(60)], "name string")
    assert {(r.source, r.target): r.weight for r in G.edges(mentioned, every, 1, block=block).collect()} == want


def test_a_document_of_thousands_of_names_is_split(spark):
    """No row holds more than two blocks of names, and the pairs of one document come from many rows."""
    names = spark.range(5000).select(F.lit("hub").alias("ticker"), F.format_string("n%05d", "id").alias("name"))
    arrays = names.groupBy("ticker").agg(F.array_sort(F.collect_set("name")).alias("names"))
    assert G.edges(names, names, 1, block=500).agg(F.count("*"), F.max("weight")).first()[:] == (5000 * 4999 // 2, 1)
    plan = G._pairs_of_blocks(arrays, "ticker", 500)._jdf.queryExecution().toString()
    assert "low" in plan and "high" in plan


def test_terms_as_by_single_searches(spark):
    """Every term as discover() finds it: terms within terms, overlaps with themselves, signs of regular expressions."""
    rng = random.Random(9)
    terms = ["AI", "AI5", "5", "aa", "(x)", "台積", "台積電", "電", "[[", "無"]
    bits = ["AI", "AI5", "aa", "aaa", "(x)", "台積電", "[[台積電]]", "[[AI]]", "[[AI5]]", "[[aa]]a", "電車", " ", "\n", "[[", "]]"]
    sections = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
    made = [(f"{i:04d}", "c", "s", f"p{i}", f"{sections()}\n## 業務簡介\n{sections()}\n\n## 供應鏈位置\n{sections()}\n## 主要客戶及供應商\n{sections()}" + ("\n## 財務概況\nAI" if i % 3 else "")) for i in range(40)]
    reports = spark.createDataFrame([*made, ("9999", "c", "s", "p", None)], REPORT)
    table = spark.createDataFrame([(t,) for t in [*terms, "AI", ""]], "name string")
    got = {(r.name, r.ticker): (r.linked, r.bare, r.role) for r in TM.find_terms(reports, table, most=4).collect()}
    want = {(t, r.ticker): (r.linked, r.bare, r.role) for t in terms for r in D.discover(reports, t).collect()}
    assert got == want
    taggable = {(r.name, r.ticker): r.taggable for r in TM.find_terms(reports, table).collect()}
    for t in ("AI", "台積電", "aa"):
        assert all(taggable.get((t, r.ticker), 0) == r.applied for r in D.link_term(reports, t).collect() if dims.FINANCE_HEADER in (r.content or ""))


def test_terms_are_linked_longest_first(spark):
    reports = spark.createDataFrame([("1", "c", "s", "p", "台積電與台積、AI5 AI, [[AI]] [[台積電 ADR]] 電x\n## 財務概況 AI"), ("2", "c", "s", "p", "AI"), ("3", "c", "s", "p", None)], REPORT)
    terms = spark.createDataFrame([("AI",), ("AI5",), ("台積",), ("台積電",), ("電",), ("ADR",)], "name string")
    got = {r.ticker: (r.content, r.applied) for r in TM.link_terms(reports, terms).collect()}
    # 台積電 goes on in a letter, as the rule for single terms has it; what stands in a link stays.
    assert got == {"1": ("台積電與[[台積]]、[[AI5]] [[AI]], [[AI]] [[台積電 ADR]] 電x\n## 財務概況 AI", 3), "2": ("AI", 0), "3": (None, 0)}
    with pytest.raises(ValueError):
        TM.link_terms(reports, terms, most=1)


def test_texts_stay_where_they_are(spark, monkeypatch, tmp_path):
    rng = random.Random(10)
    reports = spark.createDataFrame([row(rng, t, ["TSMC"]) for t in range(20)], REPORT)
    patches = spark.createDataFrame([("0003", "新", None, None, "S", "I")], "ticker string, desc string, supply_chain string, cust string, sector string, industry string")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    few = W.enrich(reports, patches)
    assert "hashpartitioning" not in plan(few)
    monkeypatch.setattr(W, "BROADCAST_CHARS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        R.write_bucketed(reports, "tidemark_test_bucketed", 4, f"file://{tmp_path}/b")
        many = W.enrich(spark.table("tidemark_test_bucketed"), patches)
        assert plan(many).count("Exchange hashpartitioning") == 1
        assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS tidemark_test_bucketed")


def test_links_are_normalised_whatever_the_text_holds(spark):
    from tidemark.functions.entities import normalise_links

    rows = spark.createDataFrame([("a\0LOST\0b [[TSMC]][[TSMC]] ([[台積電]])",), ("[[SiC]]",), ("",), (None,)], "t string")
    assert [r.x for r in rows.select(normalise_links(F.col("t")).alias("x")).collect()] == ["a\0LOST\0b [[台積電]][[台積電]]", "[[碳化矽]]", "", None]
