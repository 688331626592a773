"""What the report queries give, in SQL for DuckDB, written on its own over the same made-up inputs."""

from __future__ import annotations

from tidemark import dims
from tidemark.plans import report_tables as X

BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(texts: list[str]) -> str:
    return "[" + ", ".join(map(_q, texts)) + "]"


def _case(column: str, values: dict[str, str], other: str) -> str:
    return f"case {column} " + " ".join(f"when {_q(k)} then {_q(v)}" for k, v in values.items()) + f" else {other} end"


def _category(column: str, profile: str) -> str:
    whens = " ".join(f"when list_contains({_list(names)}, {column}) then {_q(c)}" for c, names in dims.CATEGORIES[profile].items())
    cjk = f"length(regexp_replace({column}, '[^\\x{{4E00}}-\\x{{9FFF}}]', '', 'g')) > 0.3 * length({column})"
    return f"case {whens} when {cjk} then 'taiwan_company' else 'international_company' end"


REPORTS = f"reports as ({X.REPORTS})"
BODY = "string_split(content, '## 財務概況')[1]"
LINKS = r"regexp_extract_all({}, '\[\[([^\]]+)\]\]', 1)"
BATCHES = r"""batches as (select batch_no, sector, completed, unnest(found) as ticker, generate_subscripts(found, 1) - 1 as ord from (
  select regexp_extract(value, 'Batch (\d+)', 1)::int as batch_no, regexp_extract(value, '\*\* \((.*?)\)', 1) as sector, value[4:4] = 'x' as completed,
    regexp_extract_all(string_split(value, '):')[2], '\d{4}') as found
  from (""" + X.BATCHES + """) where starts_with(value, '- [')))"""
SECTIONS = {"desc": "業務簡介", "supply_chain": "供應鏈位置", "customers": "主要客戶及供應商"}


def _loose(title: str) -> str:
    return f"coalesce(list_filter(string_split(content, '## '), lambda x: starts_with(x, '{title}'))[-1], '')"


def _exact(text: str, title: str) -> str:
    at = f"strpos({text}, '## {title}' || chr(10))"
    rest = f"substr({text}, {at} + {len(title) + 4})"
    end = f"strpos({rest}, chr(10) || '## ')"
    return f"case when {at} = 0 then '' when {end} = 0 then {rest} else left({rest}, {end} - 1) end"


def _line(key: str) -> str:
    start = f"list_filter(string_split(content, chr(10)), lambda x: starts_with(trim(x, {BLANK}), '**{key}:**'))[1]"
    return f"nullif(trim(substr({start}, strpos({start}, '**{key}:**') + {len(key) + 5}), {BLANK}), '')"


def _times(text: str, what: str) -> str:
    return f"((length({text}) - length(replace({text}, {what}, ''))) // length({what}))"


TERM = "'AI'"
_LINKED = _times("body", f"'[[' || {TERM} || ']]'")
_BARE = f"({_times('body', TERM)} - {_times('body', f"'[[' || {TERM}")} - {_times('body', f"{TERM} || ']]'")} + {_LINKED})"
FOUND = f"""found as (select *, {_LINKED} as linked, {_BARE} as bare,
    case when contains({_exact("body", SECTIONS["desc"])}, {TERM}) then 'core_business' when contains({_exact("body", SECTIONS["supply_chain"])}, {TERM}) then 'supply_chain'
      when contains({_exact("body", SECTIONS["customers"])}, {TERM}) then 'customer_supplier' else 'mentioned' end as role
  from (select *, {BODY} as body from reports where lower(sector) in ('semiconductors', 'solar')))
, hits as (select * from found where linked > 0 or bare > 0)"""

_ALL_LINES = "list_filter(string_split({0}, chr(10)), lambda x: trim(x, " + BLANK + ") <> '')"


def _until(title: str, end: str) -> str:
    at = f"strpos(content, '## {title}' || chr(10))"
    rest = f"substr(content, {at} + {len(title) + 4})"
    stop = f"strpos({rest}, chr(10) || '## {end}')"
    return f"case when {at} = 0 then '' when {stop} = 0 then {rest} else left({rest}, {stop} - 1) end"


def _metadata(field: str, strict: bool) -> str:
    line = f"list_filter(string_split(content, chr(10)), lambda x: contains(x, '{field}'))[1]"
    rest = f"trim(substr({line}, strpos({line}, '{field}') + {len(field)}), {BLANK})"
    if strict:
        rest = f"trim(regexp_replace({rest}, '^\\*\\*', ''), {BLANK})"
    return f"case when not contains(content, '{field}') then 'Missing metadata: {field}' when {rest} = '' or contains({line}, '(待更新)') then 'Empty metadata: {field}' end"


def _audit(strict: bool = False) -> str:
    names = LINKS.format("content")
    english = f"""list_filter([list_filter({_list(dims.ENGLISH_INDICATORS)}, lambda i: contains(l, i))[1] for l in string_split(content, chr(10))[1:20] if not contains(l, '**') and not contains(l, ':')], lambda i: i is not null)[1]"""
    return f"""audited as (select *, length(content) < 200 as short,
    list_filter({_list(dims.PLACEHOLDERS)}, lambda p: contains(content, p)) as placeholders, {english} as english, {names} as names,
    [n for n in {names} if len(list_filter({_list(dims.GENERIC_MARKERS)}, lambda m: contains(n, m))) > 0] as generic,
    len({_ALL_LINES.format(_until("供應鏈位置", "主要客戶及供應商"))}) as supply_lines, len({_ALL_LINES.format(_until("主要客戶及供應商", "財務概況"))}) as customer_lines from reports),
  ruled as (select *, case when short then ['Content too short (<200 chars)'] else list_filter(list_concat(
      list_transform(placeholders, lambda p: 'Placeholder found: ''' || p || ''''), [case when english is not null then 'English text detected: ''' || english || '''' end],
      [{", ".join(f"case when not contains(content, '{s}') then 'Missing section: {s}' end" for s in dims.REQUIRED_SECTIONS)}],
      [{", ".join(_metadata(f, strict) for f in dims.REQUIRED_METADATA)}],
      [case when len(names) < 8 then 'Only ' || len(names) || ' wikilinks (minimum 8)' end,
       case when len(generic) > 0 then 'Generic wikilinks (' || len(generic) || '): [''' || array_to_string(generic, ''', ''') || ''']' end,
       case when contains(content, '## 供應鏈位置' || chr(10)) and supply_lines < 3 then 'Supply chain too thin (' || supply_lines || ' lines)' end,
       case when contains(content, '## 主要客戶及供應商' || chr(10)) and customer_lines < 4 then 'Customers/suppliers too thin (' || customer_lines || ' lines)' end]), lambda x: x is not null) end as issues from audited),
  bucketed as (select *, case when len(issues) = 0 then 'CLEAN' when short or len(placeholders) > 0 or english is not null then 'ENRICHMENT' else 'QUALITY_FIX' end as bucket from ruled)"""


CHECKED = f"{REPORTS}, {_audit()}, {BATCHES}, checked as (select b.*, coalesce(r.bucket, 'MISSING') as bucket from batches b left join bucketed r on b.ticker = r.ticker where completed)"
_BUCKETS = "count(*) as tickers, " + ", ".join(f"count(*) filter (bucket = '{b}') as {b.lower()}" for b in ("CLEAN", "ENRICHMENT", "QUALITY_FIX", "MISSING"))

INDEX = f"""counts as (select name, count(*) as count from (select unnest({LINKS.format("content")}) as name from reports) group by name),
  listed as (select *, {_category("name", "index")} as category from counts),
  indexed as (select category, name, count, row_number() over (partition by category order by count desc, name) as place, count(*) over (partition by category) as total from listed where category not in ('taiwan_company', 'international_company') or count >= 2)"""

GRAPH = f"""seen as (select distinct ticker, unnest({LINKS.format(BODY)}) as name from reports),
  freq as (select name, count(*) as count from seen group by name)"""


def _edges(kept: str, least: int) -> str:
    return f"""{GRAPH}, kept as ({kept}), used as (select * from seen where name in (select name from kept)),
  edge as (select a.name as source, b.name as target, count(*) as weight from used a join used b on a.ticker = b.ticker and a.name < b.name group by 1, 2 having count(*) >= {least}),
  node as (select name as id, count, {_category("name", "graph")} as category from freq where name in (select source from edge union select target from edge)),
  coloured as (select *, {_case("category", dims.CATEGORY_COLORS, "null")} as color from node)"""


OFTEN, TOP = _edges("select name from freq where count >= 2", 5), _edges("select name from freq order by count desc, name limit 6", 1)

ENTRIES = f"""linked as (select distinct ticker, company, sector, {_loose(SECTIONS["supply_chain"])} as chain, unnest({LINKS.format(" || ".join(_loose(t) for t in SECTIONS.values()))}) as name from reports),
  near as (select *, strpos(chain, name) as spot, right(left(chain, greatest(strpos(chain, name) - 1, 0)), 100) as before from linked),
  entry as (select name, ticker, company, sector, case when spot > 0 and contains(before, '上游') then 'upstream' when spot > 0 and contains(before, '下游') then 'downstream' when spot > 0 and contains(before, '中游') then 'midstream' else 'related' end as role from near)"""
THEMES = "themes(tag, name, descr, related) as (values " + ", ".join(f"({_q(t)}, {_q(n)}, {_q(d)}, {_list(r)})" for t, n, d, r in dims.THEMES) + ")"
GROUPS = "groups(ord, grp, tags) as (values " + ", ".join(f"({i}::bigint, {_q(g)}, {_list(t)})" for i, (g, t) in enumerate(dims.THEME_GROUPS)) + ")"
BUILT = f"""{REPORTS}, {ENTRIES}, {THEMES}, {GROUPS}, built as (select tag, ticker, company, sector, role from themes join entry on tag = entry.name),
  sizes as (select tag, count(*) as companies, count(*) filter (role = 'upstream') as upstream, count(*) filter (role = 'midstream') as midstream, count(*) filter (role = 'downstream') as downstream, count(*) filter (role = 'related') as related from built group by tag),
  per_name as (select name, count(*) as companies from entry group by name),
  others as (select tag, unnest(related) as related, generate_subscripts(related, 1) - 1 as pos from themes),
  related as (select tag, pos, related, companies from others join per_name on related = name),
  in_group as (select ord, grp, unnest(tags) as tag, generate_subscripts(tags, 1) - 1 as pos from groups),
  listed as (select g.ord, g.grp, x.pos, x.tag, x.companies from groups g left join (select ord, pos, i.tag, companies from in_group i join sizes s on i.tag = s.tag) x on g.ord = x.ord)"""
PAGE = "replace(replace(tag, ' ', '_'), '/', '_') || '.md'"

PATCHED = "patched as (select *, doc_id % 8 = 1 as has_cust from (select doc_id, lpad(doc_id::varchar, 4, '0') as ticker from documents where doc_id % 4 = 1 and doc_id % 100 <> 1))"
_NEW_META = "case when doc_id % 5 = 0 and p.ticker is not null then '**板塊:** S' || chr(10) || '**產業:** I' || chr(10) || '**市值:** N/A 百萬台幣' || chr(10) || '**企業價值:** N/A 百萬台幣' || chr(10) || chr(10) else meta end"


def _once(part: str) -> str:
    """A repeated link in brackets goes, for one of the names that can be so repeated."""
    for n in sorted(set(X.CANONICAL)):
        part = f"replace({part}, {_q(f'[[{n}]] ([[{n}]])')}, {_q(f'[[{n}]]')})"
    return part


def _enriched() -> str:
    """The text of a report of its parts after a patch: canonical names where the patch was applied to a text with a finance section."""
    aliased = lambda c: f"case when c.fin = '' then o.{c} else c.{c} end"
    return f"""o as ({X.pieces()}), c as ({X.pieces(X.CANONICAL)}), {PATCHED},
  parts as (select o.doc_id, o.ticker, o.short, p.ticker is not null as updated, o.title, {_NEW_META.replace("doc_id", "o.doc_id").replace(" meta end", " o.meta end")} as meta,
      case when p.ticker is not null then '新的 [[' || (case when c.fin = '' then 'TSMC' else '台積電' end) || ']] 說明 ' || o.doc_id || chr(10) else {aliased("descr")} || chr(10) end as descr,
      case when p.ticker is not null then '**上游:** [[' || (case when c.fin = '' then 'SiC' else '碳化矽' end) || ']]' || chr(10) else {aliased("chain")} || chr(10) end as chain,
      case when p.has_cust and c.fin <> '' then '- [[AI]]' || chr(10) else {aliased("cust")} || chr(10) end as cust, o.fin
    from o join c on o.doc_id = c.doc_id left join patched p on o.ticker = p.ticker),
  enriched as (select ticker, updated, case when short then '# x' || chr(10) || '短' else {{0}} end as content from parts)"""


_WHOLE = "title || chr(10) || chr(10) || '## 業務簡介' || chr(10) || meta || descr || chr(10) || '## 供應鏈位置' || chr(10) || chain || chr(10) || '## 主要客戶及供應商' || chr(10) || cust || chr(10)"
_DONE = f"(case when fin = '' then {_WHOLE} else {_once(_WHOLE)} end) || fin"

LANDED = f"landed as ({X.LANDED}), firsts as (select ticker, min(case suffix when '.TW' then 0 else 1 end) as best from landed where value is not null group by ticker), chosen as (select l.* from landed l join firsts f on l.ticker = f.ticker and f.best = case suffix when '.TW' then 0 else 1 end)"


def _v(statement: str, item: str) -> str:
    return f"max(case when statement = '{statement}' and item = '{item}' then value end)"


def _h(statement: str, item: str) -> str:
    return f"bool_or(bool_or(statement = '{statement}' and item = '{item}')) over (partition by ticker, freq)"


METRICS = f"""{LANDED},
  wide as (select ticker, freq, period, {_v("income", "Total Revenue")} as rev, {_v("income", "Gross Profit")} as gross, {_v("income", "Selling And Marketing Expense")} as selling, {_v("income", "Research And Development")} as rd,
    {_v("income", "General And Administrative Expense")} as ga, {_h("income", "General And Administrative Expense")} as has_ga, {_v("income", "Selling General And Administration")} as sga, {_h("income", "Selling And Marketing Expense")} as has_selling,
    {_h("income", "Selling General And Administration")} as has_sga,
    {_v("income", "Operating Income")} as op, case when {_h("income", "Net Income")} then {_v("income", "Net Income")} else {_v("income", "Net Income Common Stockholders")} end as net,
    {_v("cash", "Operating Cash Flow")} as ocf, {_h("cash", "Operating Cash Flow")} as has_ocf, {_v("cash", "Total Cashflows From Investing Activities")} as investing, {_v("cash", "Free Cash Flow")} as fcf, {_h("cash", "Free Cash Flow")} as has_fcf,
    {_v("cash", "Capital Expenditure")} as capex
    from chosen group by ticker, freq, period),
  derived as (select *, case when has_ga then coalesce(ga, case when has_sga then sga - selling end) when has_sga and has_selling then sga - selling end as admin, case when has_ocf and has_fcf then coalesce(capex, fcf - ocf) else capex end as spent from wide),
  ranked as (select *, row_number() over (partition by ticker, freq order by period desc) as rank from derived where rev is not null),
  kept as (select ticker, freq, period, rank, unnest([{{cells}}]) as x from ranked where rank <= case freq when 'A' then 3 else 4 end)"""
_CELLS = ", ".join(
    f"{{'metric': '{m}', 'value': {v}}}"
    for m, v in [
        ("Revenue", "rev / 1000000"), ("Gross Profit", "gross / 1000000"), ("Gross Margin (%)", "case when rev <> 0 then gross / rev * 100 end"), ("Selling & Marketing Exp", "selling / 1000000"), ("R&D Exp", "rd / 1000000"), ("General & Admin Exp", "admin / 1000000"),
        ("Operating Income", "op / 1000000"), ("Operating Margin (%)", "case when rev <> 0 then op / rev * 100 end"), ("Net Income", "net / 1000000"), ("Net Margin (%)", "case when rev <> 0 then net / rev * 100 end"), ("Op Cash Flow", "ocf / 1000000"),
        ("Investing Cash Flow", "investing / 1000000"), ("Financing Cash Flow", "cast(null as double)"), ("CAPEX", "spent / 1000000"),
    ]
)
METRICS = METRICS.replace("{cells}", _CELLS)
CELL = "case when x.value is null then '-' else printf('%.2f', x.value) end"
PRINTED = f"""{METRICS}, cells as (select ticker, freq, period, rank, x.metric as metric, {CELL} as cell from kept),
  widths as (select ticker, freq, rank, period, greatest(10, max(length(cell)))::int as w from cells group by 1, 2, 3, 4),
  names as (select unnest({_list(dims.METRICS)}) as metric, generate_subscripts({_list(dims.METRICS)}, 1) as i),
  lines as (select ticker, freq, -1 as i, '| ' || repeat(' ', 23) || ' | ' || string_agg(lpad(strftime(period, '%Y-%m-%d'), w, ' '), ' | ' order by rank) || ' |' as line from widths group by 1, 2
    union all select ticker, freq, 0, '|:' || repeat('-', 24) || '|' || string_agg(repeat('-', (w + 1)::int) || ':', '|' order by rank) || '|' from widths group by 1, 2
    union all select c.ticker, c.freq, n.i, '| ' || rpad(n.metric, 23, ' ') || ' | ' || string_agg(lpad(cell, w, ' '), ' | ' order by c.rank) || ' |' from cells c join names n on c.metric = n.metric join widths s on c.ticker = s.ticker and c.freq = s.freq and c.rank = s.rank group by 1, 2, 3, n.metric)"""

INFO = f"""landed_info as ({X.INFO}), info_first as (select ticker, min(case suffix when '.TW' then 0 else 1 end) as best from landed_info where currentPrice <> 0 group by ticker),
  info as (select i.* from landed_info i join info_first f on i.ticker = f.ticker and f.best = case suffix when '.TW' then 0 else 1 end)"""


def _multiple(column: str) -> str:
    return f"case when {column} is null or {column} = 0 then 'N/A' else printf('%.2f', {column}) end"


def _millions(column: str) -> str:
    return f"case when {column} <> 0 then format('{{:,.0f}}', {column} / 1000000) end"


_LABELS = [label for _, label in dims.MULTIPLES]
_DAY = "case when {0} <> 0 then strftime(to_timestamp({0}) at time zone 'UTC', '%Y-%m-%d') end"
_WIDTH = [f"greatest({len(label)}, length(m{i}))" for i, label in enumerate(_LABELS)]
BLOCKS = f"""{INFO}, shot as (select ticker, {", ".join(f"{_multiple(k)} as m{i}" for i, (k, _) in enumerate(dims.MULTIPLES))}, case when currentPrice <> 0 then format('{{:,.2f}}', currentPrice) end as price,
    {_DAY.format("mostRecentQuarter")} as ttm, {_DAY.format("nextFiscalYearEnd")} as fwd, {_millions("marketCap")} as market_cap, {_millions("enterpriseValue")} as enterprise_value from info),
  noted as (select *, concat_ws(' | ', '股價 $' || price || ' as of 2026-01-02', 'TTM 截至 ' || ttm, 'Forward 預估至 ' || fwd) as note from shot),
  blocks as (select ticker, case when note = '' then '### 估值指標' else '### 估值指標 (' || note || ')' end || chr(10) || '| ' || {" || ' | ' || ".join(f"lpad({_q(label)}, {w}::int, ' ')" for label, w in zip(_LABELS, _WIDTH, strict=True))} || ' |' || chr(10)
    || '|' || {" || '|' || ".join(f"repeat('-', {w} + 2)" for w in _WIDTH)} || '|' || chr(10) || '| ' || {" || ' | ' || ".join(f"lpad(m{i}, {w}::int, ' ')" for i, w in enumerate(_WIDTH))} || ' |' as block, market_cap, enterprise_value from noted)"""


def _amount(text: str, key: str, value: str) -> str:
    return f"case when {value} is null then {text} else regexp_replace({text}, '(\\*\\*{key}:\\*\\*) [^\\n]+?百萬台幣', '\\1 ' || {value} || ' 百萬台幣') end"


def _amounts(text: str) -> str:
    return _amount(_amount(text, "市值", "market_cap"), "企業價值", "enterprise_value")


FRESH = f"""{INFO}, fresh as (select distinct ticker, 'N:' || ticker as company from landed_info where right(ticker, 1) <> '3' and ticker not in (select lpad(cast(doc_id as string), 4, '0') from documents where doc_id % 10 = 4))"""
_NOTHING = "'## 財務概況 (單位: 百萬台幣, 只有 Margin 為 %)' || chr(10) || '### 年度關鍵財務數據 (近 3 年)' || chr(10) || '無可用數據。' || chr(10) || chr(10) || '### 季度關鍵財務數據 (近 4 季)' || chr(10) || '無可用數據。' || chr(10)"


def _base(company: str, desc: str, chain: str, cust: str, meta: bool = True) -> str:
    block = f"""'**板塊:** ' || coalesce(i.sector, 'Unknown') || chr(10) || '**產業:** ' || coalesce(industry, 'Unknown') || chr(10)
    || '**市值:** ' || coalesce({_millions("marketCap")}, 'N/A') || ' 百萬台幣' || chr(10) || '**企業價值:** ' || coalesce({_millions("enterpriseValue")}, 'N/A') || ' 百萬台幣' || chr(10) || chr(10) || """
    return f"""'# ' || u.ticker || ' - [[' || {company} || ']]' || chr(10) || chr(10) || '## 業務簡介' || chr(10) || {block if meta else ""} {desc} || chr(10) || chr(10)
    || '## 供應鏈位置' || chr(10) || {chain} || chr(10) || chr(10) || '## 主要客戶及供應商' || chr(10) || {cust} || chr(10) || chr(10) || {_NOTHING}"""


_PENDING = "'*(待enrichment)*'"
_SUMMARY = "coalesce(longBusinessSummary, '*(待enrichment — 請使用 /update-enrichment 補充業務描述)*')"


def _mention_scopes() -> str:
    texts = {"file": "content", "body": BODY, "sections": " || ".join(_loose(t) for t in SECTIONS.values())}
    return " union all ".join(f"select '{s} {d}' as scope, name, count(*) as mentions from (select {'distinct' if d == 'distinct' else ''} ticker, unnest({LINKS.format(t)}) as name {', generate_subscripts(' + LINKS.format(t) + ', 1) as k' if d == 'all' else ''} from reports) group by name" for s, t in texts.items() for d in ("distinct", "all"))


def _scopes() -> str:
    tech = [s for g in dims.PROFILES["tech"] for s in dims.SECTOR_GROUPS[g]]
    energy = [s for g in dims.PROFILES["energy"] for s in dims.SECTOR_GROUPS[g]]
    rules = {"all": "true", "sector": "lower(sector) = 'auto parts'", "tickers": "ticker in ('0001', '0012')", "batch": "ticker in (select ticker from batches where batch_no = 2)", "HBM 封裝": f"list_contains({_list(tech)}, sector)", "儲能": f"list_contains({_list(energy)}, sector)", "鞋": "true"}
    return " union all ".join(f"select '{n}' as scope, count(*) as reports, min(ticker) as first, max(ticker) as last from reports where {r} having count(*) > 0" for n, r in rules.items())


_FILE = r"regexp_extract(path, '/(\d{4})[^/]*\.md$', 1)"
_LINE_ROWS = """select tag, 0 as a, '' as b, '' as c, '# ' || name || chr(10) || chr(10) || '> ' || descr || chr(10) || chr(10) || '**涵蓋公司數:** ' || companies || coalesce(chr(10) || chr(10) || '**相關主題:** ' || others, '') || chr(10) || chr(10) || '---' as line
    from themes join sizes using (tag) left join (select tag, string_agg('[[' || related || ']] (' || companies || ')', ' | ' order by pos) as others from related group by tag) using (tag)"""
_ROLE = {"upstream": ("上游", 1), "midstream": ("中游", 3), "downstream": ("下游", 5), "related": ("相關公司", 7)}
_ROLE_NO = "case role " + " ".join(f"when '{r}' then {i}" for r, (_, i) in _ROLE.items()) + " end"
_ROLE_TITLE = "case role " + " ".join(f"when '{r}' then '{t}'" for r, (t, _) in _ROLE.items()) + " end"

_MADE = f"""{INDEX.replace("listed as", "classed as").replace("from listed", "from classed")}, {OFTEN}, {BUILT.replace(REPORTS + ", ", "")}"""
_KINDS = """select 'index' as kind, category as a, name as b, count as n from indexed union all select 'totals', category, null, count(*) from indexed group by category union all select 'totals', null, null, count(*) from counts
  union all select 'nodes', id, category, count from coloured union all select 'edges', source, target, weight from edge union all select 'theme_sizes', tag, null, companies from sizes
  union all select 'theme_related', tag, related, companies from related union all select 'theme_index', grp, tag, companies from listed union all select 'theme_entries', tag, role, count(*) from built group by tag, role"""
_PATCHED_REPORTS = f"{_enriched().format(_DONE)}, given as ({X.REPORTS})"

SQL = {
    "report_rebuild": f"with {REPORTS}, {_MADE} {_KINDS}",
    "report_delta_refresh": f"with {_PATCHED_REPORTS}, reports as (select g.ticker, g.company, g.sector, g.path, case when e.updated then e.content else g.content end as content from given g join enriched e on g.ticker = e.ticker), {_MADE} {_KINDS}",
    "report_versions": f"""with {_PATCHED_REPORTS}, second as (select g.ticker, g.sector, case when g.sector in ('Solar', 'Auto Parts') and e.updated then e.content else g.content end as content from given g join enriched e on g.ticker = e.ticker),
  fresh as (select distinct ticker, sector from ({X.INFO}) i where ticker not in (select ticker from given))
  select 1 as version, ticker, sector, md5(content) as digest from given union all select 2, ticker, sector, md5(content) from second
  union all select 3, ticker, sector, md5(content) from second union all select 3, ticker, sector, md5('new') from fresh""",
    "report_scan": f"""with {REPORTS}, twice as (select *, suffix(company, '7') as again from reports)
  select ticker, case when again then company || ' 新+%41' else company end as company, case when again then 'Zinc & Co+' else sector end as sector, md5(case when again then content || chr(10) || 'last' else content end) as digest from twice""",
    "report_stream": f"""with {REPORTS} select ticker, case when suffix(company, '7') then company || ' new' else company end as company, case when suffix(company, '7') then replace(path, '/r/', '/s/') else path end as path, md5(content) as digest from reports""",
    "listed_in_sheets": """select case when c_custkey < 10000 then lpad(c_custkey::varchar, 4, '0') else c_custkey::varchar end as ticker, c_name as company, case when c_custkey < 10000 then null else c_acctbal end as balance from customer""",
    "report_all_terms": f"""with {REPORTS}, {INDEX}, bodies as (select ticker, {BODY} as body from reports), near as (select name, ticker, body from bodies join indexed on contains(body, name)),
  found as (select *, {_LINKED.replace(TERM, "name")} as linked, {_BARE.replace(TERM, "name")} as bare from near)
  select name, ticker, linked, bare, case when contains({_exact("body", SECTIONS["desc"])}, name) then 'core_business' when contains({_exact("body", SECTIONS["supply_chain"])}, name) then 'supply_chain'
    when contains({_exact("body", SECTIONS["customers"])}, name) then 'customer_supplier' else 'mentioned' end as role from found where linked > 0 or bare > 0""",
    "report_parse": f"""with {REPORTS}, b as (select *, {BODY} as body from reports) select ticker, length(body) as body_chars, md5(substr(content, length(body) + 1)) as finance,
  {_exact("body", SECTIONS["desc"])} as "desc", {_exact("body", SECTIONS["supply_chain"])} as supply_chain, {_exact("body", SECTIONS["customers"])} as customers, {_line("板塊")} as meta_sector, {_line("產業")} as meta_industry,
  try_cast(replace(regexp_extract({_line("市值")}, '(-?[0-9,]+(\\.[0-9]+)?)', 1), ',', '') as double) as market_cap_m, try_cast(replace(regexp_extract({_line("企業價值")}, '(-?[0-9,]+(\\.[0-9]+)?)', 1), ',', '') as double) as ev_m from b""",
    "report_loose_sections": f"with {REPORTS} select ticker, " + ", ".join(f'{_loose(t)} as "{s}"' for s, t in SECTIONS.items()) + " from reports",
    "report_files": f"""with files as ({X.FILES}), named as (select 'any' as kind, path from files where suffix(path, '.md') union all select 'prefix', path from files where regexp_matches(path, '/\\d{{4}}[^/]*\\.md$')
  union all select 'ticker', path from files where regexp_matches(path, '/\\d{{4}}_[^/]*\\.md$') union all select 'report', path from files where regexp_matches(path, '/[^/]+/\\d{{4}}_[^/]+\\.md$'))
  select kind, nullif({_FILE}, '') as ticker, nullif(regexp_extract(path, '/\\d{{4}}_([^/]+)\\.md$', 1), '') as company, regexp_extract(path, '/([^/]+)/[^/]+$', 1) as sector, path from named""",
    "report_last_wins": f"""with {REPORTS} select ticker, case when suffix(company, '7') then company || ' new' else company end as company, case when suffix(company, '7') then replace(path, '/r/', '/s/') else path end as path, md5(content) as digest from reports""",
    "report_scopes": f"with {REPORTS}, {BATCHES} {_scopes()}",
    "batch_catalogue": f"with {BATCHES} select batch_no, sector, ticker, ord::int as ord, completed, 'all' as list from batches union all select batch_no, sector, ticker, ord::int, completed, 'completed' from batches where completed union all select 7, null, ticker, null, null, 'batch 7' from batches where batch_no = 7",
    "report_audit": f"with {REPORTS}, {_audit()} select ticker, len(issues) = 0 as is_clean, array_to_string(issues, '; ') as issues, bucket, len(names) as mention_count, supply_lines, customer_lines from bucketed",
    "report_audit_strict": f"with {REPORTS}, {_audit(True)}, each as (select unnest(issues) as issue, bucket from bucketed) select issue, bucket, count(*) as reports from each where contains(issue, 'metadata') group by 1, 2",
    "report_batch_scores": f"""with {CHECKED}, agg as (select batch_no, {_BUCKETS} from checked group by rollup (batch_no))
  select batch_no, tickers, clean, enrichment, quality_fix, missing, round_even(100.0 * clean / tickers, 0)::int as score, true as count_missing from agg
  union all select batch_no, tickers, clean, enrichment, quality_fix, missing, case when tickers = missing then 0 else round_even(100.0 * clean / (tickers - missing), 0)::int end, false from agg""",
    "report_batch_lists": f"with {CHECKED} select batch_no, bucket, string_agg(ticker, ',' order by ord) as tickers from checked group by 1, 2",
    "report_mentions": f"with {REPORTS} {_mention_scopes()}",
    "report_index": f"with {REPORTS}, {INDEX} select category, name, count, place, total from indexed",
    "report_index_shown": f"with {REPORTS}, {INDEX} select category, count(*) as rows from indexed where not (category = 'international_company' and place > 200) and not (category = 'taiwan_company' and place > 300) group by 1",
    "report_category_totals": f"with {REPORTS}, {INDEX} select category, count(*) as names from indexed group by 1 union all select null, count(*) from counts",
    "report_index_page": f"""with {REPORTS}, {INDEX}, few as (select * from indexed),
  sections(ord, category, title, most) as (values {", ".join(f"({i}, '{c}', '{t}', {'null' if m is None else m})" for i, (c, t, m) in enumerate(dims.INDEX_SECTIONS))}),
  totals as (select s.*, (select count(*) from few f where f.category = s.category) as total from sections s),
  lines as (select -1 as ord, 0 as place, '# Wikilink Index' || chr(10) || chr(10) || '1,234 unique entities across 56 ticker reports.' || chr(10) as line
    union all select ord, 0, '## ' || title || case when most is null then ' (' || total || ')' else ' (' || total || ' total, showing top ' || most || ')' end || chr(10) from totals
    union all select ord, place, '- [[' || name || ']] (' || count || ')' from few join sections using (category) where most is null or place <= most union all select ord, 1073741824, '' from totals)
  select string_agg(line, chr(10) order by ord, place) as page from lines""",
    "report_set_section": f"""with {REPORTS}, v as (select *, '- $1 \\new ' || ticker as value, '## 主要客戶及供應商' || chr(10) as head, strpos(content, chr(10) || '## 財務概況') as fin from reports)
  select ticker, md5(case when contains(content, head) and fin > 0 then left(content, strpos(content, head) + length(head) - 1) || value || chr(10) || substr(content, fin) else content end) as "between",
    md5(case when sector <> 'Solar' and contains(content, '## 財務概況') then {BODY} || '## 財務概況' || chr(10) || value || chr(10) else content end) as to_end from v""",
    "report_edges": f"with {REPORTS}, {OFTEN} select source, target, weight from edge",
    "report_nodes": f"with {REPORTS}, {OFTEN} select id, count, category, color from coloured",
    "report_graph_json": f"""with {REPORTS}, {TOP} select to_json({{'nodes': (select list({{'id': id, 'count': count, 'category': category, 'color': color}} order by count desc, id) from coloured),
  'links': (select list({{'source': source, 'target': target, 'weight': weight}} order by source, target, weight) from edge)}})::varchar as value""",
    "report_entries": f"with {REPORTS}, {ENTRIES} select name, ticker, company, sector, role from entry",
    "report_themes": f"with {BUILT} select tag, companies, upstream, midstream, downstream, related from sizes",
    "report_one_theme": f"with {BUILT} select tag, ticker, company, sector, role from built where tag = 'HBM'",
    "report_related": f"with {BUILT} select tag, pos, related, companies from related",
    "report_theme_index": f'with {BUILT} select ord, grp as "group", pos, tag, companies from listed',
    "report_theme_pages": f"""with {BUILT}, lines as ({_LINE_ROWS} union all select tag, {_ROLE_NO}, '', '', chr(10) || '## ' || {_ROLE_TITLE} || ' (' || count(*) || ')' || chr(10) from built group by tag, role
    union all select tag, {_ROLE_NO} + 1, sector, ticker, '- **' || ticker || ' ' || company || '** (' || sector || ')' from built)
  select tag, {PAGE} as file, string_agg(line, chr(10) order by a, b, c, line) as page from lines group by tag""",
    "report_theme_index_page": f"""with {BUILT}, lines as (select -1 as ord, 0 as pos, '# Thematic Investment Screens' || chr(10) || chr(10) || '> Auto-generated supply chain maps for thematic investing.' || chr(10) || chr(10) || '---' || chr(10) as line
    union all select distinct ord, -1, '## ' || grp || chr(10) from listed union all select ord, pos, '- [' || tag || '](' || {PAGE} || ') — ' || companies || ' 家公司' from listed where tag is not null union all select distinct ord, 1073741824, '' from listed)
  select string_agg(line, chr(10) order by ord, pos) as page from lines""",
    "report_discover": f"with {REPORTS}, {FOUND} select ticker, company, sector, linked, bare, role from hits",
    "report_discovery_lines": f"""with {REPORTS}, {FOUND} select case role {" ".join(f"when '{r}' then {i}" for i, (_, r, _) in enumerate(dims.DISCOVERY_ROLES))} end::bigint as role_ord, case role {" ".join(f"when '{r}' then '{t}'" for _, r, t in dims.DISCOVERY_ROLES)} end as label, ticker,
  case when linked > 0 then '✓' else '○' end || ' ' || ticker || ' ' || company || ' (' || sector || ')' || case when bare > 0 then ' (+' || bare || ' 未標記)' else '' end as line from hits""",
    "report_discovery_totals": f"with {REPORTS}, {FOUND} select count(*) as documents, count(*) filter (linked > 0) as linked_documents, count(*) filter (bare > 0 and linked = 0) as unlinked_documents, coalesce(sum(bare), 0)::bigint as bare_mentions from hits",
    "report_by_role": f"with {REPORTS}, {FOUND} select role, count(*) as documents, sum(bare)::bigint as bare from hits group by 1",
    # A bare AI is hidden behind a mark while linked ones stand, one that goes on in a letter is put back.
    "report_link_term": rf"""with {REPORTS}, marked as (select *, contains(content, '## 財務概況') as guarded, replace({BODY}, '[[AI]]', chr(2)) as body from reports),
  tagged as (select *, regexp_replace(regexp_replace(body, '\[\[AI', '[[' || chr(3), 'g'), 'AI\]\]', chr(3) || ']]', 'g') as hidden from marked),
  found as (select *, regexp_replace(hidden, 'AI([^A-Za-z\x{{4E00}}-\x{{9FFF}}]|$)', '[[' || chr(4) || ']]\1', 'g') as linked from tagged)
  select ticker, case when guarded then length(linked) - length(replace(linked, chr(4), '')) else 0 end as applied,
    md5(case when guarded then replace(replace(replace(linked, chr(4), 'AI'), chr(3), 'AI'), chr(2), '[[AI]]') || substr(content, strpos(content, '## 財務概況')) else content end) as digest from found""",
    "report_patches": f"""select (case when doc_id % 100 = 1 then 'X' else '' end) || lpad(doc_id::varchar, 4, '0') as ticker, '新的 [[TSMC]] 說明 ' || doc_id as "desc", '**上游:** [[SiC]]' as supply_chain, case when doc_id % 8 = 1 then '- [[AI]]' end as cust, 'S' as sector, 'I' as industry from documents where doc_id % 4 = 1""",
    "report_enrich": f"with {REPORTS}, {_enriched().format(_DONE)} select r.ticker, case when updated then 'updated' else 'unchanged' end as status, md5(case when updated then e.content else r.content end) as digest from reports r join enriched e on r.ticker = e.ticker",
    "report_enrich_outcomes": f"with {PATCHED} select case when p.ticker is null then 'unchanged' else 'updated' end as status, count(*) as reports from documents d left join patched p on d.doc_id = p.doc_id group by 1 union all select 'no report', count(*) from documents where doc_id % 100 = 1",
    "report_normalise": f"""with w as (select *, {X.joined()} as content from ({X.pieces()})), v as (select *, {X.joined(fin="''")} as head from ({X.pieces(X.CANONICAL)}))
  select w.ticker, md5(case when w.short or w.fin = '' then w.content else {_once("v.head")} || w.fin end) as digest from w join v on w.doc_id = v.doc_id""",
    "report_statements": f"with {METRICS} select ticker, freq, strftime(period, '%Y-%m-%d') as period, rank, x.metric as metric, round(x.value, 9) as value from kept",
    "report_statements_as_delivered": f"with {METRICS}, first as (select *, row_number() over (partition by ticker, freq order by period) as place from derived) select ticker, freq, strftime(period, '%Y-%m-%d') as period, place as rank, round(rev / 1000000, 9) as revenue from first where place <= case freq when 'A' then 3 else 4 end",
    "report_tables_printed": f"with {PRINTED} select ticker, freq, string_agg(line, chr(10) order by i) as markdown from lines group by 1, 2",
    "report_tables_read_back": f"with {METRICS} select ticker, freq, period::date::varchar as period, x.metric as metric, printf('%.2f', x.value)::double as value from kept",
    "landed_suffix": f"with landed as ({X.INFO}) select ticker, min(suffix order by suffix) as suffix, 'price' as accept from landed where currentPrice <> 0 group by ticker union all select ticker, min(suffix), 'name' from landed where longName is not null group by ticker",
    "valuation_blocks": f"with {BLOCKS} select ticker, block, market_cap, enterprise_value from blocks",
    "report_refresh_valuation": rf"""with {REPORTS}, {BLOCKS}, j as (select r.ticker, r.content, b.block, b.market_cap, b.enterprise_value from reports r left join blocks b on r.ticker = b.ticker),
  put as (select *, case when block is null or not contains(content, '### 估值指標') then content else left(content, strpos(content, '### 估值指標') - 1) || block || chr(10) || substr(content, strpos(content, chr(10) || '### 年度')) end as changed from j)
  select ticker, case when block is null then 'skipped' else 'updated' end as status, md5({_amounts("changed")}) as digest from put""",
    "report_refresh_finance": rf"""with {REPORTS}, {BLOCKS}, j as (select r.ticker, r.content, b.block, b.market_cap, b.enterprise_value, '## 財務概況 (單位: 百萬台幣, 只有 Margin 為 %)' || chr(10) || 'new ' || b.ticker as section from reports r left join blocks b on r.ticker = b.ticker),
  put as (select *, case when section is null then content when contains(content, '## 財務概況') then {BODY} || section else rtrim(content, {BLANK}) || chr(10) || chr(10) || section end as changed from j)
  select ticker, case when section is null then 'skipped' else 'updated' end as status, md5({_amounts("changed")}) as digest from put""",
    "new_tickers": f"with {FRESH} select ticker, company from fresh",
    "first_tickers": f"with {FRESH} select ticker, company from fresh order by ticker limit 5",
    "new_reports": f"""with {FRESH} select u.ticker, coalesce(i.sector, 'Unknown') as sector, coalesce(i.sector, 'Unknown') || '/' || u.ticker || '_' || replace(u.company, ':', '') || '.md' as path,
  case when i.ticker is null or industry is null then 'Unknown' else replace(replace(replace(industry, '/', '_'), ':', ''), '*', '') end as folder, {_base("u.company", _SUMMARY, _PENDING, _PENDING)} as content from fresh u left join info i on u.ticker = i.ticker""",
    "kept_prose": f"""with {INFO}, u as ({X.pieces()}) select u.ticker, md5(case when short then {_base("u.company", _SUMMARY, _PENDING, _PENDING)} else {_base("u.company", "meta || descr", "chain", "cust || chr(10)", False)} end) as digest from u left join info i on u.ticker = i.ticker""",
    "canonical_names": f"""with {REPORTS}, names as (select unnest({_list(sorted({n for by in dims.CATEGORIES.values() for names in by.values() for n in names} | set(dims.ALIASES)))}) as name union select unnest({LINKS.format("content")}) from reports),
  known as (select name, {_category("name", "index")} as index_category, {_category("name", "graph")} as graph_category from names)
  select *, {_case("graph_category", dims.CATEGORY_COLORS, "null")} as color, {_case("name", dims.ALIASES, "name")} as canonical from known""",
}
