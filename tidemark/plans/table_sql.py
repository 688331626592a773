"""The same queries in SQL for DuckDB, written on their own."""

LINKS = """links as (select page_id, unnest(regexp_extract_all(html, '<a href="([^"]+)"', 1)) as name from pages),
freq as (select name, count(distinct page_id) as count from links group by name)"""
GRAPH = (
    LINKS
    + """,
kept as (select distinct page_id, name from links where name in (select name from freq where count >= 2)),
edge as (select a.name as source, b.name as target, count(*) as weight from kept a join kept b on a.page_id = b.page_id and a.name < b.name group by 1, 2 having count(*) >= 2),
ends as (select source as name from edge union select target from edge)"""
)
NODES = GRAPH + ", node as (select name as id, count from freq where name in (select name from ends))"

AUDIT = r"""audited as (
  select d.doc_id, lang, length(text) < 200 as short, contains(text, '$$$') or contains(text, '###') as marked,
    len(list_filter(string_split(text, chr(10))[1:20], lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '')) < 3 as thin, coalesce(quality, -1)::bigint as quality
  from documents d left join labels l on d.doc_id = l.doc_id),
bucketed as (select doc_id, lang, short, marked, thin, case when short or marked then 'ENRICHMENT' when thin then 'QUALITY_FIX' else 'CLEAN' end as bucket, quality from audited)"""

FOUND = r"""found as (
  select doc_id, source, text, 0::bigint as linked, (length(text) - length(replace(text, 'ing', ''))) // 3 as bare from documents),
roled as (select doc_id, source, linked, bare, case when contains(string_split(text, chr(10))[1], 'ing') then 'first_line' else 'mentioned' end as role from found where bare > 0)"""

QUARTERS = """quarters as (
  select o_orderpriority as segment, date_trunc('quarter', o_orderdate)::date as period,
    sum(l_extendedprice::decimal(24,4)) as revenue,
    sum(case when l_returnflag <> 'R' then (l_extendedprice * l_discount)::decimal(24,4) end) as selling,
    sum(case when l_linestatus = 'F' then l_extendedprice::decimal(24,4) end) as gross
  from lineitem join orders on l_orderkey = o_orderkey group by 1, 2)"""

SQL = {
    "link_counts": f"with {LINKS} select name, count(*) as count from links group by name",
    "link_doc_freq": f"with {LINKS} select name, count from freq where count >= 2",
    "link_graph": f"with {GRAPH} select source, target, weight from edge",
    "link_nodes": f"with {NODES} select id, count, 'international_company' as category, '#3498db' as color from node",
    "link_topn_graph": f"""with {LINKS}, top as (select name from freq order by count desc, name limit 50),
        kept as (select distinct page_id, name from links where name in (select name from top))
        select a.name as source, b.name as target, count(*) as weight from kept a join kept b on a.page_id = b.page_id and a.name < b.name group by 1, 2""",
    "link_neighbours": f"with {GRAPH} select target as neighbour, weight from edge where source = '/the' union all select source, weight from edge where target = '/the'",
    "link_scales": f"with {NODES} select (select count(*) from node) as nodes, (select max(count) from node) as max_count, (select count(*) from edge) as edges, (select max(weight) from edge) as max_weight",
    "link_view": f"""with {NODES}, seen as (select source as id from edge where weight >= 3 union select target from edge where weight >= 3)
        select id, count, 'international_company' as category, '#3498db' as color, count >= 5 as labelled, contains(lower(id), 'th') as found from node where id in (select id from seen)""",
    "index_categories": rf"""with {LINKS}, counted as (select name, count(*) as count, case when length(name) <= 4 then 'short'
          when len(regexp_extract_all(name, '[^\x00-\x7F]')) > 0.3 * length(name) then 'accented' else 'plain' end as kind from links group by name)
        select kind, name, count, row_number() over (partition by kind order by count desc, name) as place, count(*) over (partition by kind) as total from counted where kind = 'short' or count >= 2""",
    "role_window": """with cut as (select lang, instr(text, 'tion') as spot, right(left(text, greatest(instr(text, 'tion') - 1, 0)), 100) as before from documents)
        select case when spot > 0 and contains(before, 'the ') then 'upstream' when spot > 0 and contains(before, 'of ') then 'downstream' when spot > 0 and contains(before, 'and ') then 'midstream' else 'related' end as role,
          lang, count(*) as documents from cut group by 1, 2""",
    "keyword_discovery": f"with {FOUND} select doc_id, source, linked, bare, role from roled",
    "discovery_totals": f"with {FOUND} select role, count(*) as documents, count(*) filter (bare > 0) as unlinked, sum(bare)::bigint as bare from roled group by role",
    "snippets": r"""with cut as (select doc_id, string_split(text, 'tion') as a from documents where contains(text, 'tion')),
        hit as (select doc_id, a, unnest(range(1, least(len(a), 4))) as i from cut),
        one as (select doc_id, i, '...' || trim(replace(right(array_to_string(a[1:i], 'tion'), 30) || 'tion' || left(array_to_string(a[i + 1:], 'tion'), 30), chr(10), ' '), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) || '...' as s from hit)
        select doc_id, count(*) as n, string_agg(s, '|' order by i) as contexts from one group by doc_id""",
    "audit_docs": f"with {AUDIT} select * from bucketed",
    "audit_rollup": f"""with {AUDIT} select lang, count(*) as documents, count(*) filter (bucket = 'CLEAN') as clean, count(*) filter (bucket = 'ENRICHMENT') as enrichment,
        count(*) filter (bucket = 'QUALITY_FIX') as quality_fix, round(100.0::double * count(*) filter (bucket = 'CLEAN') / count(*), 2) as score from bucketed group by grouping sets ((lang), ())""",
    "batch_missing": """select doc_id, 'unlabelled' as side from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)
        union all select doc_id, 'unknown' from labels l where not exists (select 1 from documents d where l.doc_id = d.doc_id)""",
    "alias_normalise": f"""with {LINKS}, named as (select page_id, case name when '/the' then '/The' when '/of' then '/Of' when '/and' then '/And' when '/der' then '/Der' else name end as name from links)
        select name, count(*) as count, count(distinct page_id) as pages from named group by name""",
    "theme_related": f"""with {LINKS}, theme(tag, pos, related) as (values ('articles', 0, '/the'), ('articles', 1, '/der'), ('articles', 2, '/la'), ('articles', 3, '/el'), ('links', 0, '/of'), ('links', 1, '/and'), ('links', 2, '/nowhere'), ('links', 3, '/und'))
        select tag, pos::bigint as pos, related, count as companies from theme join freq on related = name""",
    "theme_groups": f"""with {LINKS}, g(ord, "group") as (values (0, 'a'), (1, 'b'), (2, 'c')), t(ord, tag) as (values (0, '/the'), (0, '/of'), (1, '/nowhere'), (2, '/the'), (2, '/und')),
        built as (select ord, tag, count as companies from t join freq on tag = name)
        select g.ord::bigint as ord, "group", tag, companies from g left join built on g.ord = built.ord""",
    "stmt_topk": """with years as (select o_custkey, year(o_orderdate) as period, sum(o_totalprice::decimal(18,2)) as v from orders group by 1, 2),
        ranked as (select *, row_number() over (partition by o_custkey order by period desc) as rank from years)
        select o_custkey, period::bigint as period, rank, round((v / 1000)::double, 3) as revenue_k from ranked where rank <= 3""",
    "stmt_margin": f"""with {QUARTERS} select segment, strftime(period, '%Y-%m-%d') as period, round(coalesce(gross, revenue - selling)::double / nullif(revenue::double, 0) * 100, 4) as gross_margin,
        round(selling::double / nullif(revenue::double, 0) * 100, 4) as selling_margin from quarters""",
    "stmt_pivot": "select year(o_orderdate)::bigint as period, count(*) filter (o_orderstatus = 'F') as status_f, count(*) filter (o_orderstatus = 'O') as status_o, count(*) filter (o_orderstatus = 'P') as status_p from orders group by 1",
    "stmt_unpivot": """select year(o_orderdate)::bigint as period, metric, count(*) filter (o_orderstatus = upper(right(metric, 1))) as value
        from orders, (values ('status_f'), ('status_o'), ('status_p')) m(metric) group by 1, 2""",
    "exclusion_anti": "select c_custkey, c_name from customer where c_mktsegment <> 'MACHINERY' and c_custkey not in (select o_custkey from orders where o_totalprice > 300000)",
    "enrich_upsert": """with best as (select o_custkey, o_orderpriority as patch, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey desc) as r from orders where o_totalprice > 300000)
        select c_custkey, coalesce(patch, c_mktsegment) as segment, case when patch is null then 'unchanged' else 'updated' end as status from customer left join best on c_custkey = o_custkey and r = 1""",
    "enrich_outcomes": "select case when exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 300000) then 'updated' else 'unchanged' end as status, count(*) as reports from customer group by 1",
    "json_patch": """with p as (select event_type, json_extract_string(props, '$.k')::bigint as k from events)
        select event_type, count(k) as patched, sum(k)::bigint as k_sum, min(k) as k_min, max(k) as k_max from p group by event_type""",
    "set_ops": """select k, 'union' as op from (select p_partkey as k from part union select s_suppkey from supplier)
        union all select k, 'intersect' from (select p_partkey as k from part intersect select s_suppkey from supplier)
        union all select k, 'except' from (select p_partkey as k from part except select s_suppkey from supplier)""",
    "page_meta": r"""select page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') as title, nullif(regexp_extract(html, '<html lang="([a-z]+)"', 1), '') as lang from pages""",
    "sanitise": r"""select page_id, trim(regexp_replace(url, '[<>:"/\\|?*]', '', 'g')) as file, translate(url, ' /', '__') as page from pages""",
    "format_numbers": """select o_orderkey, format('{:,.2f}', o_totalprice) as grouped, format('{:.2f}', o_totalprice) as plain,
        case when o_totalprice <> 0 then format('{:,.0f}', o_totalprice * 1000 / 1000000) end as millions from orders""",
    "event_windows": """select strftime(date_trunc('day', ts), '%Y-%m-%d') as day, event_type, count(*) as n, round(sum(value::decimal(18,4))::double, 2) as total from events group by 1, 2""",
    "last_wins": "select o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) as last_order from orders group by 1",
    "scoped_batches": "select n_name, c_mktsegment, count(*) as customers from customer join nation on c_nationkey = n_nationkey where lower(c_mktsegment) in ('building', 'automobile') group by 1, 2",
    "line_counts": r"""select doc_id, len(list_filter(string_split(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> ''))::bigint as full_lines, length(text)::bigint as chars from documents""",
}
