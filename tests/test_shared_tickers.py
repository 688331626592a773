"""Queries on tables whose keys have more than four digits, so that several documents or customers share a ticker, against their SQL."""

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark import catalog
from tidemark.operators import rewrite as W
from tidemark.operators import terms as TM
from tidemark.sources import reports as P

NAMES = ["report_refresh_valuation", "report_refresh_finance", "kept_prose", "landed_suffix", "new_tickers", "new_reports", "report_enrich_outcomes", "report_last_wins", "report_mentions", "report_scan", "report_stream", "report_tables_read_back", "report_enrich", "report_versions", "report_rebuild", "report_delta_refresh"]
KEYS = [*range(12), *range(1000, 1009), *range(10000, 10045), *range(100000, 100012)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder, con = tmp_path_factory.mktemp("shared"), duckdb.connect()
    segments = ["BUILDING", "MACHINERY"]
    made = {
        "documents": ("doc_id long, text string, lang string, source string, n_chars long", [(i, f"text {i} AI\n$1 \\ {'x' * (i % 300)}", "en", "s", i + 7) for i in KEYS]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", [(i, f"c{i}", i % 2, 1.0, segments[i % 7 % 2]) for i in [*KEYS, 2001, 20010, 20011]]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string", [(k, i, "FO"[k % 2], 100.25 + k, datetime.datetime(2020 + k % 5, 1 + k % 12, 3), "1") for k, i in enumerate(KEYS * 3)]),
        "nation": ("n_nationkey int, n_name string", [(0, "A"), (1, "B")]),
    }
    for name, (schema, rows) in made.items():
        spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{folder}/{name}.parquet")
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet/*.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, tables, name):
    folder, con = tables
    df = catalog.QUERIES[name](spark, folder)
    cursor = con.execute(catalog.ORACLES[name])
    at = [df.columns.index(c[0]) for c in cursor.description]
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    got = sorted((tuple(plain(r[i]) for i in at) for r in df.collect()), key=repr)
    assert got == sorted((tuple(map(plain, r)) for r in cursor.fetchall()), key=repr) and got


def test_cut_texts_are_refreshed_as_whole_ones(spark):
    """Marks, amounts within amounts or within the block, blocks with amounts, nothing to put in."""
    head = "**市值:** 1 百萬台幣\n**企業價值:** N/A 百萬台幣\n"
    fin = "\n## 財務概況\n### 估值指標 (old)\n| a |\n\n### 年度關鍵財務數據\n| x |"
    texts = [head + fin, head * 2 + fin * 2, "**市值:** 1 **企業價值:** 2 百萬台幣" + fin, "**企業價值:** 1 **市值:** 2 百萬台幣", fin.replace("| a |", "**市值:** 5 百萬台幣"), head + "\x02" + fin, head + "\x01", head + "## 財務概況\n### 年度關鍵財務數據", "**市值:** x ### 估值指標 百萬台幣\n### 年度" + fin, "", None, head.replace("1 ", "$1 \\ ")]
    blocks = [("b $1 \\", "3", "4"), ("b **市值:** 9 百萬台幣", "3", ""), (None, None, "4"), (None, None, None), ("b", "$2", None)]
    rows = spark.createDataFrame([(f"{i}-{j}", t) for i, t in enumerate(texts) for j in range(len(blocks))], "ticker string, content string")
    landed = spark.createDataFrame([(f"{i}-{j}", *b) for i in range(len(texts)) for j, b in enumerate(blocks)], "ticker string, block string, market_cap string, enterprise_value string")
    plain = W.set_metadata(W.set_valuation(F.col("content"), F.col("block")), F.col("market_cap"), F.col("enterprise_value"))
    want = {r.ticker: r.x for r in rows.join(landed, "ticker").select("ticker", plain.alias("x")).collect()}
    assert {r.ticker: r.content for r in W.refresh_valuation(rows, landed).collect()} == want


def test_all_terms_are_found_in_one_pass(spark):
    """However many there are: it took a pass over the texts for every 200,000."""
    texts = spark.createDataFrame([("1", "[[C7]] 與 C199999，C2000000 及 股份"), ("2", "C7"), ("3", None)], "ticker string, content string")
    terms = spark.range(400_000).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("name")).union(spark.createDataFrame([("及",), ("股份公司",)], "name string"))
    found = TM.find_terms(texts, terms)
    assert found._jdf.queryExecution().toString().count("MapInArrow") == 4  # one, in each of the plan's four forms
    got = {(r.ticker, r.name): (r.linked, r.bare) for r in found.collect()}
    bare = {"C1", "C19", "C199", "C1999", "C19999", "C199999", "C2", "C20", "C200", "C2000", "C20000", "C200000", "及"}
    assert got == {("1", "C7"): (1, 0), ("2", "C7"): (0, 1)} | {("1", x): (0, 1) for x in bare}


def test_tasks_list_files(spark, tmp_path):
    """The same rows as Spark's own listing, which the driver holds."""
    for name, text in {"A & B/1101_甲 +%41.md": "x\ny", "C/1101_乙.md": "", "C/notes.md": "n", "C/.1102_x.md": "h", "D/1103_c.md": "z"}.items():
        (tmp_path / "r" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "r" / name).write_text(text, encoding="utf-8")
    rows = lambda df: sorted(tuple(r) for r in df.select("ticker", "company", "sector", "content").collect())
    found = P.found_reports(spark, f"file://{tmp_path}/r")
    assert rows(found) == rows(P.read_reports(spark, f"file://{tmp_path}/r")) and len(rows(found)) == 2
    assert not found.inputFiles()  # the driver knows no file
