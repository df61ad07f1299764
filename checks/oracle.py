"""The registered queries in DuckDB SQL over the same tables, written from the rules, not from the plan."""

SPANS_ORDERS = """
so_root as (
  select lpad(lower(hex(o_orderkey)), 32, '0') trace_id, 1::bigint span_id,
    epoch_us(o_orderdate) start_time, 'cust-' || n_name service,
    [{'key': 'span.kind', 'vtype': 'string', 'value': 'client'}] tags, []::bigint[] refs
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
so_line as (
  select lpad(lower(hex(l_orderkey)), 32, '0') trace_id, (1 + l_linenumber)::bigint span_id,
    epoch_us(l_shipdate) start_time, 'supp-' || n_name service,
    list_concat(
      case when l_discount >= 0.08
        then [{'key': 'peer.service', 'vtype': 'string', 'value': p_brand}] else [] end,
      [{'key': 'span.kind', 'vtype': 'string', 'value':
        case when l_returnflag = 'R' then 'client' when l_returnflag = 'A' then 'server'
             when l_linestatus = 'O' then 'producer' else 'consumer' end}]) tags,
    [(1 + l_linenumber // 2)::bigint] refs
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
    join part on l_partkey = p_partkey),
spans_orders as (select * from so_root union all select * from so_line)"""

SPANS_REPEATED = (
    SPANS_ORDERS
    + """,
spans_repeated as (
  select * from spans_orders union all select * from spans_orders where span_id % 3 = 0)"""
)

SPANS_CONV = """
spans_conv as (
  select lpad(lower(hex(conv_id)), 32, '0') trace_id, (turn + 1)::bigint span_id,
    null::bigint start_time, role service,
    []::struct(key varchar, vtype varchar, value varchar)[] tags,
    case when turn > 0 then [turn::bigint] else []::bigint[] end refs
  from conversations)"""

SPANS_EVENTS = """
se as (
  select *, row_number() over (partition by user_id, cast(ts as date) order by ts, event_id) seq
  from events),
spans_events as (
  select user_id::varchar || '/' || cast(ts as date)::varchar trace_id, seq::bigint span_id,
    epoch_us(ts) start_time, event_type service,
    [{'key': 'k', 'vtype': 'string', 'value': json_extract_string(props, '$.k')}] tags,
    case when seq > 1 then [(seq - 1)::bigint] else []::bigint[] end refs
  from se)"""

TREES = """
sizes as (select o_custkey tree_id, count(*) nodes from orders group by 1),
expanded as (select tree_id, unnest(range(nodes))::bigint node from sizes),
placed as (
  select tree_id, node, case when node = 0 then 0 else
    ('0x' || substr(md5(tree_id::varchar || '/' || node::varchar), 1, 8))::ubigint
      % (select count(*) from nation) end place
  from expanded),
nodes as (
  select tree_id, node, case when node > 0 then (node - 1) // 3 end parent_node, n_name service
  from placed join nation on place = n_nationkey),
tree_counts as (
  select p.service parent, c.service child, cast(count(*) as bigint) call_count
  from nodes c join nodes p on c.tree_id = p.tree_id and c.parent_node = p.node group by 1, 2)"""

_TEXTS = """
  array_to_string(list_transform(tags,
    lambda t: t.key || ':' || coalesce(t.vtype, '-') || ':' || coalesce(t.value, '-')), ';') tag_text,
  array_to_string(list_transform(refs, lambda r: coalesce(r::varchar, 'null')), ',') ref_text"""


def _first(key: str) -> str:
    return f"list_filter(tags, lambda t: t.key = '{key}')[1].value"


def _links(spans: str, peer_tag: str = "peer.service") -> str:
    """CTEs from a span view to `links` (kind, parent, child), one row per link."""
    return f"""
u0 as (select distinct trace_id, span_id, start_time, service, tags, refs from {spans}),
u as (
  select *, {_first("span.kind")} kind, {_first(peer_tag)} peer,
    count(*) over (partition by trace_id, span_id) n,
    row_number() over (partition by trace_id, span_id
      order by start_time nulls first, service nulls first,
        coalesce(list_filter(tags, lambda t: t.value in ('client', 'producer', 'server', 'consumer'))[1].value
          in ('server', 'consumer'), false),
        array_to_string(list_transform(tags, lambda t: t.key || '=' || coalesce(t.value, '')), ';')) ord
  from u0),
claim0 as (
  select trace_id, span_id, ord, service, unnest(tags) t, generate_subscripts(tags, 1) pos from u),
claim1 as (
  select *, case when t.value in ('client', 'producer') then 'c'
                 when t.value in ('server', 'consumer') then 's' end side from claim0),
claim2 as (
  select trace_id, span_id, ord, pos,
    last_value(case when side = 'c' then {{'v': service}} end ignore nulls) over w c,
    last_value(case when side = 's' then {{'v': service}} end ignore nulls) over w s
  from claim1 where side is not null
  window w as (partition by trace_id, span_id order by ord, pos
    rows between unbounded preceding and current row)),
shared as (
  select c.v parent, s.v child from claim2 where c.v is not null and s.v is not null
  qualify row_number() over (partition by trace_id, span_id order by ord, pos) = 1),
eligible as (
  select * from u where len(refs) > 0 and service is not null
    and not (n > 1 and kind is distinct from 'client')),
answers as (
  select trace_id, span_id, service from u where n = 1 or kind = 'server'
  qualify row_number() over (partition by trace_id, span_id order by ord) = 1),
calls as (select trace_id, unnest(refs) ref, service child from eligible),
parents as (
  select answers.service parent, calls.child from calls join answers
    on answers.trace_id = calls.trace_id and answers.span_id = calls.ref
  where answers.service is not null),
referred as (select distinct trace_id, unnest(refs) span_id from u),
leaves as (select * from eligible anti join referred using (trace_id, span_id)),
peers as (select service parent, peer child from leaves where peer is not null),
links as (
  select 'shared' kind, * from shared union all select 'parent', * from parents
  union all select 'peer', * from peers),
edges as (select parent, child, cast(count(*) as bigint) call_count from links group by 1, 2)"""


SPANS_TIES = """,
spans_ties as (
  select trace_id, span_id % 2 span_id, start_time // 31536000000000 start_time, substr(service, 1, 6) service,
    tags, refs from spans_orders)"""


def _with(*ctes: str, select: str) -> str:
    return "with " + ",".join(ctes) + "\n" + select


def _by_kind(view: str, spans: str, kind: str | None = None) -> str:
    where = f"where kind = '{kind}'" if kind else ""
    return _with(
        view,
        _links(spans),
        select=f"select kind, parent, child, cast(count(*) as bigint) links from links {where} group by all",
    )


def _edges(view: str, spans: str, peer_tag: str = "peer.service", select: str = "select * from edges") -> str:
    return _with(view, _links(spans, peer_tag), select=select)


_PARENT_ID = "case when span_id % 2 = 0 then (span_id - 1) // 2 + 1 end"

_EVENT_DAY = """,
day_events as (
  select * from spans_events where start_time > epoch_us(timestamp '2024-01-15')
    and start_time < epoch_us(timestamp '2024-01-16') - 1)"""


def _names(rule: str, prefixes: list[str], pattern: str | None, suffix: str = "") -> str:
    date = f"strftime(day, '{pattern}')" if pattern else None
    return " union all ".join(
        f"select '{rule}' as rule, {place} as place, day::varchar as day,"
        f" '{p}span-' || {date or repr('read')} as read_name,"
        f" '{p}dependencies-' || {date or repr('write')} || '{suffix}' as write_name from days"
        for place, p in enumerate(prefixes)
    )


ORACLE: dict[str, str] = {
    "day_scan": _with(
        SPANS_EVENTS + _EVENT_DAY, select="select trace_id, span_id, start_time, service from day_events"
    ),
    "day_scan_late": _with(
        SPANS_EVENTS + _EVENT_DAY, select="select trace_id, span_id, start_time, service from day_events"
    ),
    "range_scan": _with(
        SPANS_EVENTS.replace("cast(ts as date)::varchar trace_id", "cast(ts as date)::varchar id"),
        select=f"""select lpad(id, 32, '0') trace_id, span_id, start_time, service, {_TEXTS}
        from spans_events where start_time // 1000 >= 1706659200000 - 86400000""",
    ),
    "partition_names": "with days as (select distinct cast(o_orderdate as date) as day from orders) "
    + " union all ".join(
        [
            _names("plain", [""], "%Y-%m-%d"),
            _names("dots", ["prod-", "prod:"], "%Y.%m.%d"),
            _names("joined", [""], "%Y%m%d", "/dependencies"),
            _names("alias", ["prod-", "prod:"], None),
        ]
    ),
    "source_fallback": _edges(SPANS_EVENTS, "spans_events"),
    "missing_source": _edges(SPANS_EVENTS, "spans_events"),
    "sink_layout": _edges(SPANS_EVENTS, "spans_events", select="select * from edges, (values ('v1'), ('v2')) as l(layout)"),
    "decode_spans": _with(
        SPANS_ORDERS,
        select=f"select trace_id, span_id, start_time, service, {_TEXTS} from spans_orders",
    ),
    "decode_tags": """
        select event_id, 'event:STRING:' || event_type || ';value:float64:-;k:string:'
          || coalesce(json_extract_string(props, '$.k'), '-') || ';nested:string:-;list:string:-;flag:string:true;number:string:'
          || event_id || ';absent:string:-' as tag_text
        from events""",
    "decode_rows": _with(
        SPANS_ORDERS,
        select=f"select trace_id, span_id, start_time, service, {_TEXTS} from spans_orders",
    ),
    "rejected_docs": """
        select case event_id % 4 when 1 then '{"broken ' || event_id
            when 2 then '{"traceID":"1","spanID":"1","tags":"' || event_id || '"}'
            else '{"traceID":"' || lower(hex(event_id)) || '"}' end as text,
          case event_id % 4 when 3 then 'missing traceID or spanID' else 'not in the documents'' format' end as flaw
        from events where event_id % 4 <> 0""",
    "merge_tag_fields": """
        select event_id, 'event:string:' || event_type || ';n:int64:-;k:-:'
          || json_extract_string(props, '$.k') as tag_text
        from events""",
    "hex_ids": """
        select o_orderkey, o_orderkey as short_id, o_orderkey - 1152921504606846976 as high_id,
          o_orderkey as long_id, o_orderkey - 1152921504606846976 as upper_id,
          null::bigint as bad_id
        from orders""",
    "merge_refs": """
        select l_orderkey, l_linenumber, l_partkey,
          case when l_linenumber > 2 then (l_linenumber // 2 + 1)::varchar || ',' else '' end
          || case when l_linenumber > 1
               then (l_linenumber // 2 + 1)::varchar || ',' || (l_linenumber - 5)::varchar
               else '' end as ref_text
        from lineitem""",
    "legacy_parent": _with(
        SPANS_ORDERS,
        select=f"""select trace_id, span_id, start_time, service,
          array_to_string(list_transform(list_append(refs, {_PARENT_ID}),
            lambda r: coalesce(r::varchar, 'null')), ',') ref_text from spans_orders""",
    ),
    "legacy_dependencies": _edges(
        SPANS_ORDERS
        + f""",
        spans_legacy as (select * replace (list_append(refs, {_PARENT_ID}) as refs) from spans_orders)""",
        "spans_legacy",
    ),
    "norm_trace_id": """
        select o_orderkey, lpad(d, 32, '0') as short_id, lpad(lpad(d, 16, '0'), 32, '0') as id_16,
          lpad(d, 32, 'a') as id_32, lpad(d, 40, 'b') as id_40,
          lpad('a0' || d, 32, '0') as blank_id
        from (select o_orderkey, lower(hex(o_orderkey)) d from orders)""",
    "canonical_order": _with(
        SPANS_ORDERS,
        # Tags keep their relative order within a key: first as stored, then the added copy.
        """parts as (
          select *, list_filter(tags, lambda t: t.key = 'peer.service') p,
            list_filter(tags, lambda t: t.key = 'span.kind') k from spans_orders),
        texts as (
          select *, list_concat(
            list_transform(p, lambda t: t.key || ':string:' || t.value),
            list_transform(p, lambda t: t.key || ':string:again'),
            list_transform(k, lambda t: t.key || ':string:' || t.value),
            list_transform(k, lambda t: t.key || ':string:again'),
            ['z:string:' || service]) tt,
            list_sort(list_concat([span_id], refs, [-1::bigint])) rr from parts)""",
        select="""select trace_id, span_id, start_time, service, array_to_string(tt, ';') tag_text,
          array_to_string(rr, ',') ref_text from texts""",
    ),
    "tag_lookup": _with(
        SPANS_ORDERS,
        select=f"""select trace_id, span_id, start_time, service, {_first("peer.service")} peer,
          {_first("span.kind")} kind, {_first("absent")} absent from spans_orders""",
    ),
    "span_kinds": _with(
        SPANS_ORDERS,
        select=f"""select trace_id, span_id, start_time, service,
          coalesce({_first("span.kind")} = 'client', false) client,
          coalesce({_first("span.kind")} = 'server', false) server from spans_orders""",
    ),
    "trace_groups": _with(
        SPANS_REPEATED,
        "counted as (select trace_id, cast(count(*) as bigint) spans from spans_repeated group by 1)",
        """distinct_ones as (
          select trace_id, cast(count(*) as bigint) distinct_spans, count(distinct span_id) span_ids,
            count(distinct service) services, min(start_time) first_start, max(start_time) last_start
          from (select distinct * from spans_repeated) group by 1)""",
        select="select * from counted join distinct_ones using (trace_id)",
    ),
    "dedup_spans": _with(
        SPANS_REPEATED,
        select=f"""select trace_id, span_id, start_time, service, {_TEXTS}
          from (select distinct * from spans_repeated)""",
    ),
    "shared_groups": _with(
        SPANS_REPEATED,
        _links("spans_repeated"),
        select="""select trace_id, span_id, max(n) n, max(answers.service) parent_service
          from u left join answers using (trace_id, span_id) group by 1, 2""",
    ),
    "eligible_spans": _with(
        SPANS_REPEATED,
        _links("spans_repeated"),
        select="""select trace_id, span_id, service, peer, array_to_string(refs, ',') ref_text
          from eligible""",
    ),
    "leaf_spans": _with(
        SPANS_REPEATED,
        _links("spans_repeated"),
        select="select trace_id, span_id, service, peer, array_to_string(refs, ',') ref_text from leaves",
    ),
    "shared_links": _by_kind(SPANS_ORDERS, "spans_orders", "shared"),
    "shared_ties": _by_kind(SPANS_ORDERS + SPANS_TIES, "spans_ties", "shared"),
    "parent_links": _by_kind(SPANS_ORDERS, "spans_orders", "parent"),
    "peer_links": _by_kind(SPANS_ORDERS, "spans_orders", "peer"),
    "all_links": _by_kind(SPANS_REPEATED, "spans_repeated"),
    "all_links_conv": _by_kind(SPANS_CONV, "spans_conv"),
    "all_links_events": _by_kind(SPANS_EVENTS, "spans_events"),
    "dependencies": _edges(SPANS_ORDERS, "spans_orders"),
    "late_spans": _edges(SPANS_REPEATED, "spans_repeated"),
    "stored_dependencies": _edges(SPANS_REPEATED, "spans_repeated"),
    "dependencies_other_tag": _edges(SPANS_ORDERS, "spans_orders", peer_tag="span.kind"),
    "day_document": _edges(
        SPANS_EVENTS,
        "spans_events",
        select="""select '2024-01-30T00:00:00Z' as "timestamp", parent, child, call_count from edges""",
    ),
    "adjacency_map": _edges(SPANS_ORDERS, "spans_orders"),
    "read_document": _edges(SPANS_ORDERS, "spans_orders"),
    "assert_equal": _with(
        SPANS_ORDERS,
        _links("spans_orders"),
        """part as (
          select parent, child, cast(count(*) as bigint) call_count
          from links where kind <> 'peer' group by 1, 2)""",
        select="""select *, 1::bigint surplus from (select * from edges except all select * from part)
          union all
          select *, -1::bigint from (select * from part except all select * from edges)""",
    ),
    "tree_spans": _with(
        TREES,
        select="""select lpad(tree_id::varchar, 32, '0') trace_id, node + 1 span_id, node start_time,
          service, '' tag_text, coalesce((parent_node + 1)::varchar, '') ref_text from nodes""",
    ),
    "tree_edges": _with(TREES, select="select * from tree_counts"),
    "tree_dependencies": _with(TREES, select="select * from tree_counts"),
    "run_day": _edges(SPANS_EVENTS + _EVENT_DAY, "day_events"),
    "published_day": _edges(SPANS_EVENTS + _EVENT_DAY, "day_events"),
}

for _layout, _second in (("sink_v1", "ts_index"), ("sink_v2", "ts_bucket")):
    ORACLE[_layout] = _edges(
        SPANS_EVENTS,
        "spans_events",
        select=f"""
        select 1706572800000 as ts, 1706572800000 as {_second}, parent, child, call_count,
          'spanweave' as source from edges
        union all
        select 1706659200000, 1706659200000, null, null, null, null""",
    )
