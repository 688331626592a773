import datetime
import json
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests import reports as fixture
from tidemark import dims, sinks
from tidemark.functions import entities as E
from tidemark.functions import numbers as N
from tidemark.functions import text as T
from tidemark.operators import audit as A
from tidemark.operators import base_reports as BR
from tidemark.operators import discover as D
from tidemark.operators import graph as G
from tidemark.operators import index as I
from tidemark.operators import rewrite as W
from tidemark.operators import statements as S
from tidemark.operators import themes as TH
from tidemark.operators import valuation as V
from tidemark.operators.mentions import mentions
from tidemark.plans.rebuild import link_and_rebuild, rebuild
from tidemark.sources import batches as B
from tidemark.sources import landing as L
from tidemark.sources import reports as R
from tidemark.sources.patches import parse_patches
from tidemark.sources.scope import parse_scope, profile_of, profile_sectors
from tidemark.streaming.refresh import arriving, event_counts, follow, upserted


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return fixture.write(tmp_path_factory.mktemp("corpus") / "reports")


@pytest.fixture(scope="module")
def reports(spark, root):
    return R.read_reports(spark, root).cache()


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first().x


def by(df, key, *cols):
    return {r[key]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}


def test_scan(spark, root, reports):
    assert by(reports, "ticker", "company", "sector")["2201"] == ("C+D 車用", "Auto Parts")
    assert reports.count() == 4 and R.read_reports(spark, root, "any").count() == 5
    two = reports.unionByName(reports.filter("ticker = '1101'").withColumn("path", F.lit("zzz")).withColumn("company", F.lit("late")))
    assert by(R.last_wins(two), "ticker", "company")["1101"] == "late"
    assert R.in_scope(reports, sectors=["auto parts"]).count() == 2 and R.in_scope(reports, sectors=["auto parts"], fold_case=False).count() == 0


def test_parse(reports):
    got = {r.ticker: r for r in R.parse_reports(reports).collect()}
    assert got["1101"].meta_industry == "Semiconductors" and float(got["1101"].market_cap_m) == 12345
    assert got["2201"].meta_sector is None and got["2201"].market_cap_m is None
    assert "### 主要供應商" in got["1101"].customers and got["2202"].desc == "" and got["2202"].finance == ""
    assert all(r.body + r.finance == r.content for r in got.values())


def test_batches(spark, root):
    b = B.read_batches(spark, root.rsplit("/", 1)[0] + "/task.md")
    assert [r.ticker for r in B.batch_tickers(b, 1).collect()] == ["1101", "1102", "9999"]
    assert {r.batch_no for r in B.completed(b).collect()} == {1, 4}
    assert parse_scope(["--batch", "4"]).select(b.select("ticker").distinct(), b).count() == 1


def test_scope_words():
    assert parse_scope([]).tickers is None and parse_scope(["--sector", "Auto", "Parts"]).sector == "Auto Parts"
    assert parse_scope(["1101", "x", "22012"]).tickers == ("1101",)
    assert profile_of("AI 電網") == "tech" and profile_of("電網") == "energy" and profile_of("鞋") == "all"
    assert profile_sectors("all") is None and "Solar" in profile_sectors("energy") and "Solar" not in profile_sectors("tech")


def test_fixed_values(spark):
    assert len(dims.ALIASES) == 90 and len(set(dims.ALIASES.values())) == 82
    assert not set(dims.ALIASES) & set(dims.ALIASES.values()) - {a for a, c in dims.ALIASES.items() if a == c}
    assert [len(x) for x in dims.CATEGORIES["graph"].values()] == [55, 20, 18] and [len(x) for x in dims.CATEGORIES["index"].values()] == [73, 20, 17]
    assert len(dims.THEMES) == 20 and sum(len(r) for *_, r in dims.THEMES) == 67 and len(dims.THEME_GROUPS) == 8
    assert len(dims.GENERIC_MARKERS) == 20 and len(dims.ENGLISH_INDICATORS) == 11
    assert dims.themes(spark).count() == 20 and dims.theme_groups(spark).count() == 8


def test_categories(spark):
    names = ["5G", "磊晶", "電動車", "消費性電子", "Intel", "台a積b電c", "碳化矽"]
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    got = by(rows.select("n", E.category(F.col("n")).alias("g"), E.category(F.col("n"), "index").alias("i")), "n", "g", "i")
    assert got["5G"] == ("technology", "technology") and got["磊晶"] == (dims.TAIWAN, "technology")
    assert got["Intel"][0] == dims.INTERNATIONAL and got["台a積b電c"][0] == dims.TAIWAN and got["碳化矽"][0] == "material"


def test_mention_scopes_and_index(spark, reports):
    count = by(I.entity_counts(reports), "name", "count")
    text = "".join(c for n, c in fixture.REPORTS.items() if n != "notes.md")
    found = re.findall(r"\[\[([^\]]+)\]\]", text)
    assert count == {n: found.count(n) for n in found}
    # Loose sections stop at a sub-heading, so what stands under one is not seen.
    pairs = {(r.ticker, r.name) for r in mentions(reports, "sections").collect()}
    assert ("1101", "Apple") not in pairs and ("1101", "NVIDIA") in pairs
    assert ("1101", "Apple") in {(r.ticker, r.name) for r in mentions(reports, "body").collect()}
    index = {r.name: r for r in I.entity_index(I.entity_counts(reports)).collect()}
    assert "HBM" in index and "Apple" not in index and index["NVIDIA"].place == 1
    page = sinks.index_page(I.entity_index(I.entity_counts(reports)), len(count), 4).first().page
    assert "## Technologies & Standards (2)\n" in page and "- [[NVIDIA]] (4)" in page and "total, showing top 200" in page
    totals = by(I.category_totals(I.entity_counts(reports)), "category", "names")
    assert totals[None] == len(count)


def test_graph(reports):
    m = mentions(reports, "body")
    f = G.document_frequency(m)
    docs = {t: set(re.findall(r"\[\[([^\]]+)\]\]", c.split(dims.FINANCE_HEADER)[0])) for t, c in ((n.split("/")[-1][:4], c) for n, c in fixture.REPORTS.items() if "/" in n)}
    df = {}
    for names in docs.values():
        for n in names:
            df[n] = df.get(n, 0) + 1
    assert by(f, "name", "count") == df
    for least in (1, 2):
        want = {}
        for names in docs.values():
            kept = sorted(n for n in names if df[n] >= 2)
            for i, a in enumerate(kept):
                for b in kept[i + 1 :]:
                    want[a, b] = want.get((a, b), 0) + 1
        edges = G.edges(m, G.kept_names(f), least)
        got = {(r.source, r.target): r.weight for r in edges.collect()}
        assert got == {k: w for k, w in want.items() if w >= least} and all(a < b for a, b in got)
        nodes = by(G.nodes(f, edges), "id", "count", "color")
        assert set(nodes) == {x for k in got for x in k}
    first = next(iter(got))[0]
    assert by(G.neighbours(edges, first), "neighbour", "weight") == {b if a == first else a: w for (a, b), w in got.items() if first in (a, b)}
    assert {r.name for r in G.kept_names(f, top=2).collect()} == {n for n, _ in sorted(df.items(), key=lambda x: (-x[1], x[0]))[:2]}
    graph = sinks.graph_json(G.nodes(f, edges), edges).first().value
    assert set(json.loads(graph)) == {"nodes", "links"} and "<svg" in sinks.graph_page(graph)
    nodes, shown = G.view(G.nodes(f, edges), edges, 2, 2, "nvi")
    assert any(r.found for r in nodes.collect()) and shown.count() == edges.count()
    assert G.scales(G.nodes(f, edges), edges).first().edges == edges.count()


def test_roles(spark):
    chain = "供應鏈位置\n上游 A 中游 B " + "x" * 120 + " C 下游 D"
    for name, want in (("A", "upstream"), ("B", "upstream"), ("C", "related"), ("D", "downstream"), ("Z", "related")):
        assert one(spark, T.role(F.col("s"), F.col("n")), s=chain, n=name) == want


def test_themes(spark, reports):
    entry = TH.entries(reports)
    themes, groups = dims.themes(spark), dims.theme_groups(spark)
    found = TH.theme_entries(entry, themes)
    rows = {(r.tag, r.ticker): r.role for r in found.collect()}
    assert rows[("HBM", "1101")] == "upstream" and rows[("Tesla", "2201")] == "related" and rows[("NVIDIA", "1102")] == "downstream"
    sizes = {r.tag: r for r in TH.theme_sizes(found).collect()}
    assert all(r.companies == r.upstream + r.midstream + r.downstream + r.related for r in sizes.values())
    index = TH.theme_index(TH.theme_sizes(found), groups)
    assert {r.group for r in index.collect()} == {g for g, _ in dims.THEME_GROUPS}
    pages = by(sinks.theme_pages(found, TH.related(entry, themes), themes), "tag", "page")
    assert "**涵蓋公司數:** 2" in pages["NVIDIA"] and "[[HBM]] (1)" in pages["NVIDIA"]
    assert all(p.count("- **") == sizes[t].companies for t, p in pages.items())
    assert "[HBM](HBM.md) — 1 家公司" in sinks.theme_index_page(index).first().page
    assert {r.tag for r in TH.theme_entries(entry, themes, "HBM").collect()} == {"HBM"}
    with pytest.raises(ValueError):
        TH.theme_entries(entry, themes, "none")


def plain_discovery(text, term):
    bare = list(re.finditer(r"(?<!\[\[)" + re.escape(term) + r"(?!\]\])", text))
    cut = ["..." + text[max(0, m.start() - 30) : m.end() + 30].replace("\n", " ").strip() + "..." for m in bare[:3]]
    return text.count(f"[[{term}]]"), len(bare), cut


@pytest.mark.parametrize("term", ["AI", "NVIDIA", "電動車", "a.b", "[["])
def test_discovery(reports, term):
    got = {r.ticker: (r.linked, r.bare, r.contexts) for r in D.discover(reports, term).collect()}
    want = {}
    for name, content in fixture.REPORTS.items():
        if "/" in name:
            found = plain_discovery(content.split(dims.FINANCE_HEADER)[0], term)
            if found[0] or found[1]:
                want[name.split("/")[-1][:4]] = found
    assert got == want


def test_discovery_roles_and_links(reports):
    hits = D.discover(reports, "AI")
    assert by(hits, "ticker", "role") == {"1101": "core_business", "1102": "core_business", "2201": "core_business"}
    assert by(D.discover(reports, "模組"), "ticker", "role") == {"1101": "supply_chain"}
    assert D.discover(reports, "AI", ["Auto Parts"]).count() == 1
    linked = by(D.link_term(reports, "AI"), "ticker", "applied", "content")
    # What goes on in a letter or a character is counted as bare but not linked.
    assert linked["1101"][0] == 2 and "[[AI]] 晶片，[[AI]] 市場" in linked["1101"][1] and linked["2201"][0] == 2 and "[[AI]]5" in linked["2201"][1]
    assert linked["2202"] == (0, fixture.REPORTS["Auto Parts/2202_短.md"])
    lines = D.discovery_lines(hits).orderBy("ticker").collect()
    assert lines[0].line == "○ 1101 甲公司 (Semiconductors) (+2 未標記)" and lines[1].line.startswith("✓ 1102")
    total = D.discovery_totals(hits).first()
    assert (total.documents, total.linked_documents, total.unlinked_documents) == (3, 1, 2)
    assert sum(r.documents for r in D.by_role(hits).collect()) == 3
    with pytest.raises(ValueError):
        D.discover(reports, "")


def test_audit(spark, root, reports):
    got = {r.ticker: r for r in A.audit(reports).collect()}
    assert got["1101"].is_clean and got["1101"].bucket == "CLEAN" and got["1101"].mention_count == 10
    assert got["2202"].issues == ["Content too short (<200 chars)"] and got["2202"].bucket == "ENRICHMENT"
    assert got["1102"].bucket == "QUALITY_FIX" and got["1102"].issues == ["Only 6 wikilinks (minimum 8)", "Generic wikilinks (1): ['國際大廠']", "Supply chain too thin (1 lines)"]
    issues = got["2201"].issues
    assert issues[:2] == ["Placeholder found: '(待更新)'", "English text detected: 'manufactures'"] and "Missing metadata: 板塊:" in issues and got["2201"].bucket == "ENRICHMENT"
    empty = reports.filter("ticker = '1101'").withColumn("content", F.replace("content", F.lit("**板塊:** Technology"), F.lit("**板塊:** ")))
    assert A.audit(empty).first().is_clean and A.audit(empty, True).first().issues == ["Empty metadata: 板塊:"]
    b = B.read_batches(spark, root.rsplit("/", 1)[0] + "/task.md")
    checked = A.audit_batches(b, A.audit(reports))
    scores = by(A.batch_scores(checked), "batch_no", "clean", "missing", "score")
    assert scores[1] == (1, 1, 33) and scores[None][1] == 1
    assert by(A.batch_scores(checked, False), "batch_no", "score")[1] == 50
    lists = {(r.batch_no, r.bucket): r.tickers for r in A.batch_lists(checked).collect()}
    assert lists[1, "MISSING"] == ["9999"]


def day(text):
    return datetime.date.fromisoformat(text)


def test_statements(spark):
    rows = []

    def put(ticker, statement, item, values):
        rows.extend((ticker, ".TW", "A", statement, item, day(p), v) for p, v in values.items())

    put("1", "income", "Total Revenue", {"2025-12-31": 4e6, "2024-12-31": 2e6, "2023-12-31": None, "2022-12-31": 1e6, "2021-12-31": 5e6})
    put("1", "income", "Gross Profit", {"2025-12-31": 1e6, "2024-12-31": float("nan"), "2022-12-31": 2e6})
    put("1", "income", "Selling General And Administration", {"2025-12-31": 9e5, "2024-12-31": 8e5})
    put("1", "income", "Selling And Marketing Expense", {"2025-12-31": 4e5, "2024-12-31": 3e5})
    put("1", "income", "Net Income", {"2025-12-31": None})
    put("1", "income", "Net Income Common Stockholders", {"2025-12-31": 7e5})
    put("1", "cash", "Operating Cash Flow", {"2025-12-31": 3e6, "2024-12-31": 1e6})
    put("1", "cash", "Free Cash Flow", {"2025-12-31": 2e6, "2024-12-31": 5e5})
    put("1", "cash", "Capital Expenditure", {"2025-12-31": -7e5})
    put("2", "income", "Total Revenue", {"2025-12-31": 0.0})
    put("2", "income", "Gross Profit", {"2025-12-31": 1e6})
    landed = spark.createDataFrame(rows, L.STATEMENTS)
    table = S.latest_periods(S.metrics(S.wide(landed)))
    got = {(r.ticker, str(r.period)): r for r in table.collect()}
    assert [p for t, p in sorted(got, reverse=True) if t == "1"] == ["2025-12-31", "2024-12-31", "2022-12-31"]
    new = got["1", "2025-12-31"]
    assert (new["rank"], new["Revenue"], new["Gross Margin (%)"], new["General & Admin Exp"], new["CAPEX"]) == (1, 4.0, 25.0, 0.5, -0.7)
    assert new["Net Income"] is None  # the first key was delivered, though empty
    assert got["1", "2024-12-31"]["Gross Margin (%)"] is None and got["1", "2024-12-31"]["CAPEX"] == -0.5
    assert got["2", "2025-12-31"]["Gross Margin (%)"] is None
    assert S.long(table).count() == len(got) * len(dims.METRICS)
    printed = by(S.rendered(table), "ticker", "markdown")
    assert "| Revenue                 |       4.00 |       2.00 |       1.00 |" in printed["1"] and len({len(x) for x in printed["1"].split("\n")}) == 1
    sections = S.finance_sections(S.rendered(table), spark.createDataFrame([("1", "### 估值指標")], "ticker string, block string"))
    text = by(sections, "ticker", "section")
    assert text["1"].startswith(dims.FINANCE_TITLE + "\n### 估值指標\n\n" + dims.ANNUAL_TITLE) and text["1"].endswith(dims.NO_DATA + "\n")


def test_rendered_tables_read_back(reports):
    got = {(r.freq, str(r.period), r.metric): r.value for r in S.parse_rendered(reports.filter("ticker = '1101'")).collect()}
    assert got == {("A", "2025-12-31", "Revenue"): 4321.5, ("A", "2024-12-31", "Revenue"): 3210.25, ("A", "2025-12-31", "Gross Profit"): None, ("A", "2024-12-31", "Gross Profit"): 10.0, ("Q", "2025-12-31", "Revenue"): 987.75}


def info(spark, *rows):
    names = [x.split()[0] for x in L.INFO.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], L.INFO)


def test_valuation(spark, reports):
    rows = [
        {"ticker": "1101", "suffix": ".TW", "currentPrice": 0.0},
        {"ticker": "1101", "suffix": ".TWO", "currentPrice": 1234.5, "trailingPE": 12.345, "priceToBook": 0.0, "marketCap": 2.5e9, "mostRecentQuarter": 1767139200, "enterpriseToEbitda": 3.0},
    ]
    picked = L.first_suffix(info(spark, *rows), "currentPrice <> 0")
    blocks = V.blocks(picked, F.lit("2026-03-26").cast("date"))
    got = blocks.first()
    assert got.block.split("\n")[0] == "### 估值指標 (股價 $1,234.50 as of 2026-03-26 | TTM 截至 2025-12-31)"
    assert got.block.split("\n")[3] == "|     12.35 |         N/A |       N/A | N/A |      3.00 |" and got.market_cap == "2,500" and got.enterprise_value is None
    done = {r.ticker: r for r in W.refresh_valuation(reports, blocks).collect()}
    assert done["1101"].status == "updated" and "股價 $1,234.50 as of" in done["1101"].content and "股價 $10.00" not in done["1101"].content
    assert "**市值:** 2,500 百萬台幣" in done["1101"].content and "**企業價值:** 1,000 百萬台幣" in done["1101"].content
    assert done["1101"].content.count(dims.ANNUAL_HEADER) == 1 and done["1102"].status == "skipped" and done["1102"].content == fixture.REPORTS["Semiconductors/1102_乙.md"]
    assert by(W.outcomes(W.refresh_valuation(reports, blocks)), "status", "reports") == {"updated": 1, "skipped": 3}
    no_block = one(spark, W.set_valuation(F.col("c"), F.lit("NEW $1")), c=f"a\n{dims.FINANCE_TITLE}\n{dims.ANNUAL_TITLE}\nx")
    assert no_block == f"a\n{dims.FINANCE_TITLE}\nNEW $1\n\n{dims.ANNUAL_TITLE}\nx"


def test_enrich(spark, reports):
    patch = {"2201": {"desc": "新 $1 \\說明 [[TSMC]]", "supply_chain": "- [[EV]]", "cust": "- c", "sector": "S"}, "9999": {"desc": "x"}}
    patches = parse_patches(spark.createDataFrame([(json.dumps(patch),)], "value string"))
    done = {r.ticker: r for r in W.enrich(reports, patches).collect()}
    text = done["2201"].content
    assert done["2201"].status == "updated" and "**板塊:** S\n**產業:** N/A\n**市值:** N/A 百萬台幣" in text
    assert "新 $1 \\說明 [[台積電]]\n" in text and "## 供應鏈位置\n- [[電動車]]\n\n## 主要客戶及供應商\n- c\n" in text and text.endswith(fixture.FINANCE)
    assert done["1102"].status == "unchanged" and [r.ticker for r in W.patches_without_report(patches, reports).collect()] == ["9999"]


def test_normalise(spark, reports):
    got = by(reports.select("ticker", W.normalise(F.col("content")).alias("x"), (W.normalise(W.normalise(F.col("content"))) == W.normalise(F.col("content"))).alias("same")), "ticker", "x", "same")
    assert all(same for _, same in got.values())
    assert "[[台積電]] 供應商" in got["1102"][0] and "[[碳化矽]]" in got["1101"][0]
    assert one(spark, W.normalise(F.col("c")), c="[[TSMC]] 沒有財務") == "[[TSMC]] 沒有財務"
    assert one(spark, W.normalise(F.col("c")), c="[[WIN Semi]]（[[穩懋]]）## 財務概況 a ## 財務概況 [[TSMC]]") == "[[穩懋]]## 財務概況 a ## 財務概況 [[TSMC]]"


def test_sections_and_finance(spark):
    text = "x\n## A\nold\n## B\nrest"
    assert one(spark, W.set_section(F.col("c"), "## A", F.lit("n$w"), "## B"), c=text) == "x\n## A\nn$w\n\n## B\nrest"
    assert one(spark, W.set_section(F.col("c"), "## A", F.lit("new")), c=text) == "x\n## A\nnew\n"
    assert one(spark, W.set_finance(F.col("c"), F.lit("## 財務概況 n")), c="a\n\n## 財務概況 old") == "a\n\n## 財務概況 n"
    assert one(spark, W.set_finance(F.col("c"), F.lit("## 財務概況 n")), c="a \n") == "a\n\n## 財務概況 n"


def test_numbers(spark):
    v = F.col("v").cast("double")
    assert one(spark, N.plain(v), v="1234.5") == "1234.50" and one(spark, N.plain(v), v="0.125") == "0.12"
    assert one(spark, N.plain(v), v=None) == "-" and one(spark, N.multiple(v), v="0") == "N/A" and one(spark, N.grouped(v), v="1234.5") == "1,234.50"
    assert one(spark, N.margin(v, F.lit(0.0)), v="1") is None and one(spark, N.share(F.lit(1), F.lit(0)), v="1") == 0


def test_base_reports(spark, reports):
    universe = spark.createDataFrame([("1101", "甲公司"), ("3301", "新:公司"), ("3302", "無")], "ticker string, company string")
    excluded = spark.createDataFrame([("3302",)], "ticker string")
    fresh = L.universe(universe, excluded, reports)
    landed = info(spark, {"ticker": "3301", "sector": "A/B", "industry": "I", "marketCap": 1.5e9, "longBusinessSummary": "S"})
    nothing = spark.createDataFrame([], "ticker string, section string")
    (row,) = BR.base_reports(fresh, landed, nothing).collect()
    assert row.path == "AB/3301_新公司.md" and "**市值:** 1,500 百萬台幣\n**企業價值:** N/A 百萬台幣\n\nS\n" in row.content and row.content.startswith("# 3301 - [[新:公司]]")
    base = BR.base_reports(universe.filter("ticker = '1101'"), landed, nothing)
    kept = BR.kept_prose(base, reports).first().content
    assert "生產 [[HBM]]" in kept and "- [[ASML]]、[[SiC]]" in kept and dims.NO_DATA in kept
    folders = by(BR.industry_folder(reports), "ticker", "folder")
    assert folders["1101"] == "Semiconductors" and folders["2202"] == "Uncategorized"


def test_snapshots(spark, reports, tmp_path):
    folder = f"{tmp_path}/v1"
    R.write_snapshot(reports, folder)
    back = R.read_snapshot(spark, folder)
    assert back.filter("sector = 'Auto Parts'").count() == 2
    fresh = spark.createDataFrame([Row(ticker="1101", company="x", sector="N", path="p", content="c"), Row(ticker="7777", company="y", sector="N", path="p", content="c")])
    sinks.append_new(fresh, back, folder)
    assert R.read_snapshot(spark, folder).filter("sector = 'N'").count() == 1
    sinks.write_by(BR.industry_folder(reports), "folder", f"{tmp_path}/by")
    sinks.write_text(spark.createDataFrame([("a\nb",)], "page string"), "page", f"{tmp_path}/page")
    assert spark.read.text(f"{tmp_path}/page").count() == 2


def test_rebuild(spark, reports):
    out = rebuild(spark, reports, min_weight=1)
    assert all(out[k].count() >= 0 for k in out) and out["edges"].count() > 0
    hits, changed, again = link_and_rebuild(spark, reports, "AI", min_weight=1)
    assert hits.count() == 3 and again["index"].filter("name = 'AI'").first()["count"] == 5
    _, only, _ = link_and_rebuild(spark, reports, "AI", ["Auto Parts"])
    assert by(only, "ticker", "applied") == {"1101": 0, "1102": 0, "2201": 2, "2202": 0}


def test_follow(spark, reports, tmp_path):
    rows = reports.select("ticker", "company", "sector", "path", "content")
    landing = f"{tmp_path}/in"
    rows.filter("ticker < '2'").coalesce(1).write.parquet(landing)
    follow(arriving(spark, landing), f"{tmp_path}/v", f"{tmp_path}/c").awaitTermination()
    late = rows.filter("ticker in ('1101', '2201')").withColumn("company", F.lit("new"))
    late.coalesce(1).write.mode("append").parquet(landing)
    follow(arriving(spark, landing), f"{tmp_path}/v", f"{tmp_path}/c").awaitTermination()
    assert by(spark.read.parquet(f"{tmp_path}/v/1"), "ticker", "company") == {"1101": "new", "1102": "乙", "2201": "new"}
    assert upserted(rows, late).count() == 4


def test_event_windows_stream_as_in_a_batch(spark, tmp_path):
    start = datetime.datetime(2026, 1, 1)
    rows = [(start + datetime.timedelta(hours=h), ("a", "b")[h % 2], float(h)) for h in range(24 * 6)]
    spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/e")
    events = spark.read.parquet(f"{tmp_path}/e")
    batch = {(r.start, r.event_type): (r.n, r.total) for r in event_counts(events).collect()}
    stream = event_counts(spark.readStream.schema(events.schema).parquet(f"{tmp_path}/e"))
    stream.writeStream.outputMode("append").format("memory").queryName("windows").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    got = {(r.start, r.event_type): (r.n, r.total) for r in spark.sql("select * from windows").collect()}
    assert got and all(batch[k] == v for k, v in got.items()) and len(batch) - len(got) <= 4
    assert event_counts(events, "2 days", "1 day").count() > len(batch)
