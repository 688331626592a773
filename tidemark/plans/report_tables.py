"""Reports, batches, patches and market data made of the driver's tables, so that the report operators run on them.

Each text is a query that Spark and DuckDB both read. They only make the input; what operators do with it is written twice, in
`report_queries` with the operators and in `report_sql` on its own.
"""

from __future__ import annotations

NAMES = ["AI", "HBM", "台積電", "NVIDIA", "Apple", "電動車", "碳化矽", "5G", "TSMC", "SiC", "資料中心", "國際大廠", "CoWoS", "Tesla", "ASML", "矽光子", "聯發科", "PCB", "Delta", "磷化銦"]
#: The same names without aliases.
CANONICAL = [{"TSMC": "台積電", "SiC": "碳化矽", "Delta": "台達電"}.get(n, n) for n in NAMES]
SECTORS = ["Semiconductors", "Auto Parts", "Solar", "Footwear & Accessories"]
LF = "chr(10)"
TICKER = "lpad(cast(doc_id as string), 4, '0')"


def _pick(of: list[str], number: str) -> str:
    return f"split_part('{'|'.join(of)}', '|', cast(({number}) % {len(of)} as int) + 1)"


def pieces(names: list[str] = NAMES) -> str:
    """The parts of a report for each document: ticker, company, sector, path, short, title, meta, desc, chain, cust, fin."""
    n = lambda k: f"({_pick(names, f'doc_id * 7 + (doc_id % 13) * (doc_id % 3) + {3 * k}')})"
    link = lambda k: f"'[[' || {n(k)} || ']]'"
    unlinked = f"({_pick(NAMES, 'doc_id * 7 + (doc_id % 13) * (doc_id % 3) + 3')})"
    return f"""select doc_id, {TICKER} as ticker, concat('C', cast(doc_id as string)) as company, {_pick(SECTORS, "doc_id")} as sector,
  '/r/' || ({_pick(SECTORS, "doc_id")}) || '/' || {TICKER} || '_C' || cast(doc_id as string) || '.md' as path,
  doc_id % 11 = 5 as short, '# ' || {TICKER} || ' - [[C' || cast(doc_id as string) || ']]' || case when doc_id % 12 in (2, 3) then ' AI' else '' end as title,
  case when doc_id % 5 = 0 then '' else '**板塊:** Technology' || {LF} || '**產業:** ' || case when doc_id % 7 = 0 then '' else lang end || {LF} || '**市值:** ' || cast(n_chars as string) || ' 百萬台幣' || {LF} || '**企業價值:** ' || case when doc_id % 6 = 0 then 'N/A' else cast(n_chars * 2 as string) end || ' 百萬台幣' || {LF} || {LF} end as meta,
  {link(0)} || case when doc_id % 12 in (1, 2, 3) then ' 與其他。' else ' 與 AI，AI 用於 AI5、[[AI]] 及 ' || {unlinked} || '。' end || case when doc_id % 10 = 3 then {LF} || 'It provides parts and manufactures them' else '' end || {LF} || replace(coalesce(text, ''), '#', '') as descr,
  case when doc_id % 4 = 3 then '- ' || {link(2)} else '**上游:** ' || {link(2)} || '、' || {link(3)} || '、[[C' || cast(doc_id as string) || ']]、[[股份公司' || cast(doc_id as string) || ']]、[[股份公司' || cast(doc_id as string) || ']]' || {LF} || '**中游:** ' || {link(4)} || ' (' || {link(4)} || ')' || {LF} || {LF} || '**下游:** ' || {link(5)} end as chain,
  case when doc_id % 3 = 2 then '(待更新)' else '### 主要客戶' || {LF} || '- ' || {link(3)} || {LF} || '- ' || {link(6)} || {LF} || '### 主要供應商' || {LF} || '- AI 與 ' || {link(7)} end as cust,
  case when doc_id % 9 = 4 then '' else '## 財務概況 (單位: 百萬台幣, 只有 Margin 為 %)' || {LF} || '### 估值指標 (old)' || {LF} || '| AI |' || {LF} || {LF} || '### 年度關鍵財務數據 (近 3 年)' || {LF} || '| x |' || {LF} end as fin
from documents"""


def joined(title: str = "title", meta: str = "meta", descr: str = "descr", chain: str = "chain", cust: str = "cust", fin: str = "fin") -> str:
    """The text of a report of its parts."""
    short = f"'# x' || {LF} || '短'"
    whole = " || ".join([title, LF, LF, "'## 業務簡介'", LF, meta, descr, LF, LF, "'## 供應鏈位置'", LF, chain, LF, LF, "'## 主要客戶及供應商'", LF, cust, LF, LF, fin])
    return f"case when short then {short} else {whole} end"


REPORTS = f"select ticker, company, sector, path, {joined()} as content from ({pieces()}) p"

#: Files as a scan would find them: path, content.
FILES = """select '/r/' || (case doc_id % 5 when 0 then 'Solar/' when 1 then '' else 'Auto Parts/' end) || (case doc_id % 4 when 0 then cast(1000 + doc_id % 9000 as string) || '_C ' || lang when 1 then cast(1000 + doc_id % 9000 as string) || ' ' || lang when 2 then 'notes' || cast(doc_id as string) else cast(1000 + doc_id % 9000 as string) || '_' || source end) || (case doc_id % 6 when 0 then '.txt' else '.md' end) as path,
  'x' as content from documents"""

#: Lines of a batch catalogue.
BATCHES = """select '- [' || (case when n_nationkey % 3 = 0 then ' ' else 'x' end) || '] **Batch ' || cast(n_nationkey as string) || '** (' || n_name || '): '
  || lpad(cast(n_nationkey * 31 as string), 4, '0') || ', ' || lpad(cast(n_nationkey * 31 + 5 as string), 4, '0') || ', 9' || lpad(cast(n_nationkey as string), 3, '0') as value from nation
  union all select '- [x] **Batch 99** (None):' as value from nation where n_nationkey = 0 union all select 'no batch 1234' as value from nation"""

#: Patches as JSON, one a line; some tickers have no report.
PATCHES = f"""select '{{"' || (case when doc_id % 100 = 1 then 'X' else '' end) || {TICKER} || '": {{"desc": "新的 [[TSMC]] 說明 ' || cast(doc_id as string) || '", "supply_chain": "**上游:** [[SiC]]", '
  || (case when doc_id % 8 = 1 then '"cust": "- [[AI]]", ' else '' end) || '"sector": "S", "industry": "I"}}}}' as value from documents where doc_id % 4 = 1"""

def _periods(freq: str, parts: str, period: str) -> str:
    return f"""select cast(o_custkey as bigint) as o_custkey, '{freq}' as freq, cast(year(o_orderdate) as int) as y, {period} as period, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as total,
  cast(sum(case when o_orderstatus = 'F' then cast(o_totalprice as decimal(18, 2)) end) as double) as done, cast(count(*) as double) as n from orders group by o_custkey, {parts}"""


_YEAR = "cast(year(o_orderdate) as int)"
_QUARTER = "cast(quarter(o_orderdate) as int)"
_ENDS = f"make_date({_YEAR}, {_QUARTER} * 3, case when {_QUARTER} in (1, 4) then 31 else 30 end)"
_PERIODS = f"{_periods('A', 'year(o_orderdate)', f'make_date({_YEAR}, 12, 31)')} union all {_periods('Q', 'year(o_orderdate), quarter(o_orderdate)', _ENDS)}"

#: Items of statements: statement, item, value, and for which rows. Some are missing, empty, or delivered under their second name; no figure is half-way between two printed ones.
_ITEMS = [
    ("income", "Total Revenue", "case when y % 7 = 3 then null else total * 1000 + 1 end", "true"),
    ("income", "Gross Profit", "done * 1000 + 1", "true"),
    ("income", "Operating Income", "done * 500 + 1", "true"),
    ("income", "Net Income", "cast(null as double)", "o_custkey % 4 = 0"),
    ("income", "Net Income Common Stockholders", "total * 100 + 1", "true"),
    ("income", "Selling And Marketing Expense", "n * 1000 + 1", "o_custkey % 2 = 0"),
    ("income", "Selling General And Administration", "n * 4000 + 2", "true"),
    ("income", "General And Administrative Expense", "case when y % 2 = 0 then n * 2500 + 1 end", "o_custkey % 5 = 0"),
    ("income", "Research And Development", "n * 300 + 1", "o_custkey % 3 = 1"),
    ("cash", "Operating Cash Flow", "total * 200 + 3", "true"),
    ("cash", "Total Cashflows From Investing Activities", "-total - 1", "true"),
    ("cash", "Free Cash Flow", "total * 150 + 1", "o_custkey % 2 = 1"),
    ("cash", "Capital Expenditure", "-n * 1000 - 1", "o_custkey % 3 = 2"),
]


def _by_item(column: int) -> str:
    quote = (lambda x: f"'{x}'") if column < 2 else (lambda x: x)
    return "case i.k " + " ".join(f"when {k} then {quote(item[column])}" for k, item in enumerate(_ITEMS)) + " end"


def _landed(items: str) -> str:
    """Statements as landed, in long form: years and quarters, an item a row. items: how the engine puts a number k for each item beside a row."""
    return f"""with periods as ({_PERIODS}) select lpad(cast(o_custkey as string), 4, '0') as ticker, case when o_custkey % 3 = 0 then '.TWO' else '.TW' end as suffix, freq,
  {_by_item(0)} as statement, {_by_item(1)} as item, period, {_by_item(2)} as value from periods {items} where {_by_item(3)}"""


LANDED = _landed(f"cross join (select unnest(range({len(_ITEMS)})) as k) i")
LANDED_IN_SPARK = _landed(f"lateral view explode(sequence(0, {len(_ITEMS) - 1})) i as k")

#: Market data as landed: a row for each customer and suffix.
INFO = """select lpad(cast(c_custkey as string), 4, '0') as ticker, s.suffix, case when c_custkey % 3 = 0 and s.suffix = '.TW' then 0.0 when c_custkey % 17 = 0 then null else cast(c_custkey as double) * 1.25 end as currentPrice,
  case when c_custkey % 2 = 0 then c_name end as longName, cast(c_custkey as double) * 7654321 as marketCap, case when c_custkey % 5 = 0 then 0.0 else cast(c_custkey as double) * 8765432 end as enterpriseValue,
  cast(c_custkey % 50 as double) / 4 as trailingPE, case when c_custkey % 4 = 1 then null else cast(c_custkey % 30 as double) / 8 end as forwardPE, 1.5 as priceToSalesTrailing12Months, cast(c_custkey % 7 as double) as priceToBook, cast(null as double) as enterpriseToEbitda,
  case when c_custkey % 6 = 0 then null else cast(1700000000 + c_custkey * 86400 as bigint) end as mostRecentQuarter, case when c_custkey % 8 = 0 then cast(0 as bigint) else cast(1760000000 as bigint) end as nextFiscalYearEnd,
  c_mktsegment as sector, case when c_custkey % 9 = 0 then null else 'I/' || c_mktsegment || ':*' end as industry, case when c_custkey % 2 = 0 then 'About ' || c_name end as longBusinessSummary
from customer cross join (select '.TW' as suffix union all select '.TWO' as suffix) s"""
