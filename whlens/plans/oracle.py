"""DuckDB texts for the checked queries (``oracle_sql``).

Each text runs on the test tables registered as views and recomputes the
same result without Spark: roles become CTEs, operators become plain SQL.
Column names and types match the Spark outputs.
"""

from __future__ import annotations

from whlens.plans import registry as R
from whlens.plans.roles import (QUERY_METRICS_COLUMNS, QUERY_QUEUE_INFO_COLUMNS, QUERY_WLM_COLUMNS,
                                metric_column_rule, rest_metric_rule)

# --- roles as DuckDB SQL ------------------------------------------------------------

ROLE_SQL: dict[str, str] = {
    "warehouses": """
        select s_suppkey % 3 as account_id, s_suppkey % 4 as workspace_id, s_suppkey as warehouse_id,
               s_name as warehouse_name, cast('1995-01-01 00:00:00' as timestamp) as change_time from supplier
        union all
        select s_suppkey % 3, s_suppkey % 4, s_suppkey, concat(s_name, '_v2'), cast('1998-01-01 00:00:00' as timestamp)
        from supplier where s_suppkey % 10 = 0
        union all
        select s_suppkey % 3, s_suppkey % 4, s_suppkey, s_name, cast('1997-01-01 00:00:00' as timestamp)
        from supplier where s_suppkey % 5 = 0""",
    "usage": """
        select l.l_suppkey % 3 as account_id, l.l_suppkey % 4 as workspace_id, l.l_suppkey as warehouse_id,
               o.o_orderpriority as sku_name, 'DBU' as usage_unit, l.l_quantity as usage_quantity,
               cast(l.l_shipdate as date) as usage_date, l.l_shipdate as usage_start_time,
               l.l_shipdate as usage_end_time,
               case when l.l_returnflag = 'R' then 'JOBS' else 'SQL' end as billing_origin_product
        from lineitem l join orders o on l.l_orderkey = o.o_orderkey""",
    "list_prices": """
        select sku_name, 'DBU' as usage_unit,
               case when sku_name = '4-NOT SPECIFIED' then 'EUR' else 'USD' end as currency_code,
               price_start_time,
               lead(price_start_time) over (partition by sku_name order by price_start_time) as price_end_time,
               price
        from (select o_orderpriority as sku_name, cast(date_trunc('quarter', o_orderdate) as timestamp) as price_start_time,
                     round(avg(o_totalprice) / 1000, 4) as price
              from orders where o_orderpriority <> '5-LOW'
              group by 1, 2) p
        union all
        select '9-UNUSED', 'DBU', 'USD', cast('1996-01-01 00:00:00' as timestamp), null, 1.0""",
    "warehouse_changes": "select user_id as warehouse_id, ts as change_time from events",
    "warehouse_events": "select user_id as warehouse_id, ts as event_time, event_id, event_type, value from events",
    "query_history": """
        select event_id as statement_id, ts as start_time, user_id, event_type as statement_type, value, props
        from events""",
    "ddl_chunks": """
        select c.doc_id as xid, c.doc_id % 11 as pid, c.doc_id % 5 as userid, e.ts as starttime, e.ts as endtime,
               concat('  ', c.source, ' ') as label, c.sequence,
               substr(c.text, cast(c.sequence as integer) * 200 + 1, 200) as text
        from (select doc_id, text, source,
                     unnest(range(0, greatest(cast(ceil(length(text) / 200) as bigint), 1))) as sequence
              from documents) c
        left join events e on e.event_id = c.doc_id""",
    "stl_query": """
        select conv_id % 5 as userid, conv_id * 2 as xid, conv_id % 11 as pid, conv_id as query,
               min(length(text)) as aborted, min(turn) as concurrency_scaling_status,
               timestamp '2024-01-01 00:00:00' + to_days(cast(conv_id % 30 as integer)) + to_seconds(min(length(text))) as starttime,
               timestamp '2024-01-01 00:00:00' + to_days(cast(conv_id % 30 as integer)) + to_seconds(min(length(text))) + to_minutes(max(turn)) as endtime
        from conversations group by conv_id""",
    "stl_querytext": """
        select conv_id % 5 as userid, conv_id * 2 as xid, conv_id % 11 as pid, conv_id as query,
               turn as sequence, text from conversations""",
    "sf_tables": """
        select case when c_nationkey = 0 then null when c_nationkey = 1 then 'SNOWFLAKE'
                    else concat('CAT_', cast(c_nationkey as varchar)) end as table_catalog,
               c_mktsegment as table_schema, c_name as table_name,
               case when c_custkey % 11 = 0 then cast('2024-01-01 00:00:00' as timestamp) end as deleted
        from customer""",
    "sf_views": """
        select concat('CAT_', cast(c_nationkey as varchar)) as table_catalog, c_mktsegment as table_schema,
               c_name as table_name, concat('select ', cast(c_custkey as varchar)) as view_definition,
               cast(null as timestamp) as deleted
        from customer where c_custkey % 4 = 0
        union all
        select concat('CAT_', cast(c_nationkey as varchar)), c_mktsegment, c_name, 'old',
               cast('2024-01-01 00:00:00' as timestamp)
        from customer where c_custkey % 8 = 0""",
    "pg_type": """
        select p_partkey + 1 as oid, case p_partkey + 1 when 16 then 'bool' when 18 then 'char' when 20 then 'int8' when 21 then 'int2'
                 when 23 then 'int4' when 700 then 'float4' when 701 then 'float8' when 1042 then 'bpchar'
                 when 1043 then 'varchar' when 1083 then 'time' when 1114 then 'timestamp' when 1184 then 'timestamptz'
                 when 1186 then 'interval' when 1266 then 'timetz' when 1560 then 'bit' when 1562 then 'varbit'
                 when 1700 then 'numeric' else case when p_partkey % 35 = 0 then '_' || p_name
                   when p_partkey % 4 = 1 then replace(p_name, ' ', '_') else p_name end end as typname, p_size % 6 as typnamespace,
               case when p_partkey % 3 = 0 then p_partkey + 1 else 0 end as typrelid,
               case when p_partkey % 5 = 0 then p_partkey else 0 end as typelem from part""",
    "pg_class": "select p_partkey + 1 as oid, case when p_partkey % 2 = 0 then 'c' else 'r' end as relkind from part",
    "pg_namespace": "select r_regionkey as oid, r_name as nspname from region",
    "pg_cast": """
        select p_partkey + 1 as castsource, (p_partkey * 7) % 2500 + 1 as casttarget,
               case when p_partkey % 4 = 0 then 0 else p_partkey end as castfunc,
               case p_partkey % 3 when 0 then 'e' when 1 then 'a' else 'i' end as castcontext from part""",
    "pg_proc": """
        select p_partkey + 1 as oid, p_name as proname, p_size as prorettype, p_partkey % 3 as pronargs,
               p_size % 6 as pronamespace, p_partkey % 2 = 0 as proisagg from part""",
    "pg_proc_args": """
        select p.p_partkey + 1 as oid, n.n_nationkey as pos, (p.p_partkey * 3 + n.n_nationkey) % 2000 + 1 as type_oid
        from part p join nation n on n.n_nationkey < p.p_partkey % 3""",
    "pg_description": """
        select p_partkey + 1 as objoid, case when p_partkey % 2 = 0 then 'pg_type' else 'pg_proc' end as catalog_name,
               p_type as description from part where p_partkey % 7 = 0""",
    "search_path": "select r_regionkey as rank_on_path, r_name as nspname from region where r_regionkey < 4",
    "sys_tables": """
        select p_partkey as object_id, p_brand as table_schema,
               concat(p_name, '_', cast(p_partkey as varchar)) as table_name, i.n as index_id,
               p_size * 10 as row_count
        from part join (select n_nationkey as n from nation where n_nationkey < 3) i
          on i.n <> 0 or p_partkey % 2 = 0""",
    "sys_columns": """
        select p.p_partkey as object_id, p.p_brand as table_schema,
               concat(p.p_name, '_', cast(p.p_partkey as varchar)) as table_name,
               concat('c', cast(n.n_nationkey as varchar)) as column_name,
               case n.n_nationkey when 0 then 'int' when 1 then 'varchar' when 2 then 'decimal' else 'tinyint' end
                 as data_type
        from part p join nation n on n.n_nationkey < 4""",
    "query_stats": """
        select o_custkey as sql_handle, o_orderdate as creation_time, o_orderkey, o_totalprice from orders""",
    "query_texts": "select c_custkey as sql_handle, c_name as text from customer where c_custkey % 10 <> 0",
    "executions": """
        select 10000 - event_id as pos,
               case when event_id % 97 = 0 then null
                    when event_id = 2500 then cast('2023-06-01 00:00:00' as timestamp) else ts end as submission,
               event_type as state, value from events""",
    "info_columns": """
        select concat('CAT_', cast(object_id % 3 as varchar)) as table_catalog, table_schema, table_name,
               column_name, case when data_type = 'varchar' then 'YES' else 'NO' end as is_nullable, data_type
        from sys_columns""",
}

ROLE_DEPS = {
    "info_columns": ["sys_columns"],
}


def with_roles(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs of the named roles (and their deps), then
    the ``extra`` CTEs in order."""
    order: list[str] = []

    def add(n):
        for dep in ROLE_DEPS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    bodies = [(n, ROLE_SQL[n]) for n in order] + list((extra or {}).items())
    ctes = ",\n".join(f"{n} as ({body})" for n, body in bodies)
    return f"with {ctes}\n{sql}"


def _metric_sql(columns, ts):
    cols = ", ".join(f"{metric_column_rule(n, i)} as {n}" for i, n in enumerate(columns))
    return (f"select {', '.join(columns)} from (select {cols}, o_totalprice as extra_column from orders) m "
            f"where {ts} between timestamp '{R.STATS_START} 00:00:00' and timestamp '{R.STATS_END} 00:00:00'")


# --- profile tables (fixed test-table layouts) ------------------------------------------

# Columns of the profiled test tables and their kind
# (n = numeric, s = text, t = timestamp, a = array).
PROFILE_COLUMNS = {
    "region": [("r_regionkey", "n"), ("r_name", "s")],
    "nation": [("n_nationkey", "n"), ("n_name", "s"), ("n_regionkey", "n")],
    "customer": [("c_custkey", "n"), ("c_name", "s"), ("c_nationkey", "n"), ("c_acctbal", "n"),
                 ("c_mktsegment", "s")],
    "supplier": [("s_suppkey", "n"), ("s_name", "s"), ("s_nationkey", "n"), ("s_acctbal", "n")],
    "part": [("p_partkey", "n"), ("p_name", "s"), ("p_brand", "s"), ("p_type", "s"), ("p_size", "n"),
             ("p_retailprice", "n")],
    "orders": [("o_orderkey", "n"), ("o_custkey", "n"), ("o_orderstatus", "s"), ("o_totalprice", "n"),
               ("o_orderdate", "t"), ("o_orderpriority", "s")],
    "lineitem": [("l_orderkey", "n"), ("l_partkey", "n"), ("l_suppkey", "n"), ("l_linenumber", "n"),
                 ("l_quantity", "n"), ("l_extendedprice", "n"), ("l_discount", "n"), ("l_tax", "n"),
                 ("l_returnflag", "s"), ("l_linestatus", "s"), ("l_shipdate", "t")],
    "events": [("event_id", "n"), ("user_id", "n"), ("event_type", "s"), ("ts", "t"), ("value", "n"), ("props", "s")],
    "documents": [("doc_id", "n"), ("text", "s"), ("lang", "s"), ("source", "s"), ("n_chars", "n")],
    "embeddings": [("vec_id", "n"), ("embedding", "a"), ("label", "n")],
    "pages": [("page_id", "n"), ("url", "s"), ("html", "s")],
    "benchmark": [("item_id", "n"), ("text", "s")],
    "labels": [("doc_id", "n"), ("quality", "n"), ("toxic", "n")],
    "conversations": [("conv_id", "n"), ("turn", "n"), ("role", "s"), ("text", "s")],
}


def _min_max_sql(tables) -> str:
    parts = []
    for t in tables:
        for c, kind in PROFILE_COLUMNS[t]:
            if kind == "n":
                # + 0.0 turns DuckDB's -0.0 minimum of zeros into 0.0
                parts.append(f"select '{t}' as TableName, '{c}' as ColumnName, "
                             f"cast(min({c}) as double) + 0.0 as MinValue, "
                             f"cast(max({c}) as double) + 0.0 as MaxValue from {t}")
    return "\nunion all\n".join(parts)


def _stats_sql(tables, schema) -> str:
    parts = []
    for t in tables:
        for c, kind in PROFILE_COLUMNS[t]:
            ds = f"cast(sum(strlen({c})) as double)" if kind == "s" else "cast(null as double)"
            lo = f"cast(min({c}) as double) + 0.0" if kind == "n" else "cast(null as double)"
            hi = f"cast(max({c}) as double) + 0.0" if kind == "n" else "cast(null as double)"
            parts.append(
                f"select '{c}' as column_name, {ds} as data_size, cast(count(distinct {c}) as double) "
                f"as distinct_values_count, case when count(*) = 0 then null else (count(*) - count({c})) / "
                f"count(*) end as nulls_fraction, cast(null as double) as row_count, {lo} as low_value, "
                f"{hi} as high_value, '{schema}' as schema_name, '{t}' as table_name from {t}")
        parts.append(f"select cast(null as varchar), cast(null as double), cast(null as double), "
                     f"cast(null as double), cast(count(*) as double), cast(null as double), "
                     f"cast(null as double), '{schema}', '{t}' from {t}")
    return "\nunion all\n".join(parts)


def _iso(expr: str, sep: str = "T", null: str = "") -> str:
    return (f"case when {expr} is null then '{null}' when strftime({expr}, '%f') = '000000' "
            f"then strftime({expr}, '%Y-%m-%d{sep}%H:%M:%S') else strftime({expr}, '%Y-%m-%d{sep}%H:%M:%S.%f') end")


EV_S = f"timestamp '{R.EV_START} 00:00:00'"
EV_E = f"timestamp '{R.EV_END} 00:00:00'"
EV_E1 = f"(timestamp '{R.EV_END} 00:00:00' + interval 1 day)"
EV_E_SEC = f"timestamp '{R.EV_END} 23:59:59'"

# Every name that a warehouse has had.
_NAMES = "select account_id, workspace_id, warehouse_id, warehouse_name from warehouses group by all"


def _named_usage(names: str = _NAMES, where: str = "true") -> str:
    """SQL usage, a row for each name of its warehouse."""
    return f"""
        select u.*, n.warehouse_name from usage u, ({names}) n
        where u.billing_origin_product = 'SQL' and {where}
          and (u.account_id, u.workspace_id, u.warehouse_id) = (n.account_id, n.workspace_id, n.warehouse_id)"""


def _priced_usage(join: str) -> str:
    """Named usage of the window with the dollar price in force when it ended."""
    window = f"u.usage_date >= date '{R.USAGE_START}' and u.usage_date <= date '{R.USAGE_END}'"
    return with_roles(f"""
        select s.*, r.price_start_time, r.currency_code, r.price as price_per_unit,
               ifnull(r.price_end_time, cast(date '{R.TODAY}' + 1 as timestamp)) as coalesced_price_end_time,
               ifnull(r.price * s.usage_quantity, 0) as usage_usd
        from ({_named_usage(where=window)}) s
        {join} (select *, ifnull(price_end_time, timestamp '9999-12-31 00:00:00') as valid_to
                from list_prices where currency_code = 'USD') r
          on r.sku_name = s.sku_name and r.usage_unit = s.usage_unit
         and r.price_start_time <= s.usage_end_time and s.usage_end_time < r.valid_to
        where s.account_id is not null""", "usage", "warehouses", "list_prices")


def _intervals() -> str:
    """Each warehouse change with the time of the next one."""
    return f"""select warehouse_id, change_time,
          ifnull(first_value(change_time) over (partition by warehouse_id order by change_time
                                                rows between 1 following and 1 following),
                 timestamp '{R.OPEN_END}') as next_change_time
        from warehouse_changes"""


def _valid_events(before: str) -> str:
    """Events of the window within an interval; ``before`` compares with its end."""
    return with_roles(f"""
        select e.* from warehouse_events e, ({_intervals()}) i
        where e.warehouse_id = i.warehouse_id and e.event_time >= i.change_time and e.event_time {before} i.next_change_time
          and e.event_time >= {EV_S} and e.event_time < {EV_E1}""", "warehouse_events", "warehouse_changes")


def _statements(piece: str) -> str:
    """DDL statements put together from their chunks."""
    return with_roles(f"""
        select xid, pid, min(userid) as userid, min(starttime) as starttime, min(endtime) as endtime,
               min(trim(label)) as label, array_to_string(list({piece} order by sequence), '') as sqltext
        from (select *, regexp_replace(text, ' +$', '') as trimmed from ddl_chunks)
        where starttime between timestamp '{R.DDL_START} 00:00:00' and timestamp '{R.DDL_END} 00:00:00'
        group by xid, pid""", "ddl_chunks")


# Catalog of types. Built-in display names are fixed values, by oid.
_BUILTIN = """(values (16, 'boolean'), (18, '"char"'), (20, 'bigint'), (21, 'smallint'), (23, 'integer'), (700, 'real'),
    (701, 'double precision'), (1042, 'character'), (1043, 'character varying'), (1083, 'time without time zone'),
    (1114, 'timestamp without time zone'), (1184, 'timestamp with time zone'), (1186, 'interval'),
    (1266, 'time with time zone'), (1560, 'bit'), (1562, 'bit varying'), (1700, 'numeric')) as b(oid, shown)"""


def _quoted(c: str) -> str:
    return f"""if(regexp_matches({c}, '^[a-z_][a-z0-9_$]*$'), {c}, '"' || replace({c}, '"', '""') || '"')"""


# First on the search path wins a name; ties by oid.
_ON_PATH = """select arg_min(t.oid, (sp.rank_on_path, t.oid)) as oid
    from pg_type t, pg_namespace n, search_path sp
    where n.oid = t.typnamespace and sp.nspname = n.nspname group by t.typname"""
_PROCS_ON_PATH = """select arg_min(p.oid, (sp.rank_on_path, p.oid)) as oid
    from pg_proc p left join (select oid, list(type_oid order by pos) as vec from pg_proc_args group by oid) v using (oid),
         pg_namespace n, search_path sp
    where n.oid = p.pronamespace and sp.nspname = n.nspname group by p.proname, v.vec"""


def _shown_types(visible: bool) -> dict[str, str]:
    """CTEs up to ``shown`` (oid, shown): how each type is displayed."""
    schema = ""
    if visible:
        schema = f"if(t.oid in (select oid from on_path) or n.nspname is null, '', {_quoted('n.nspname')} || '.') || "
    own = f"""select t.oid, ifnull(b.shown, {schema}{_quoted('t.typname')}) as shown
        from pg_type t left join {_BUILTIN} on b.oid = t.oid left join pg_namespace n on n.oid = t.typnamespace"""
    out = {"on_path": _ON_PATH} if visible else {}
    return out | {"own": own, "shown": """
        select t.oid, if(t.typname[1] = '_' and t.typelem <> 0, ifnull(e.shown, '???') || '[]', o.shown) as shown
        from pg_type t join own o on o.oid = t.oid left join own e on e.oid = t.typelem"""}


def _types_sql(visible: bool) -> str:
    return with_roles(f"""
        select n.nspname as "Schema", s.shown as "Name",
               (select min(d.description) from pg_description d where d.objoid = t.oid and d.catalog_name = 'pg_type') as "Description"
        from pg_type t join shown s on s.oid = t.oid left join pg_namespace n on t.typnamespace = n.oid
        where t.typelem not in (select oid from pg_type)
          and (t.typrelid = 0 or t.typrelid in (select oid from pg_class where relkind = 'c'))
          {'and t.oid in (select oid from on_path)' if visible else ''}""",
                      "pg_type", "pg_namespace", "pg_class", "pg_description", *(["search_path"] if visible else []),
                      extra=_shown_types(visible))


def _aggregates_sql(visible: bool) -> str:
    return with_roles(f"""
        select n.nspname as "Schema", p.proname as "Name",
               ifnull((select shown from shown where oid = p.prorettype), '???') as "Result_data_type",
               if(p.pronargs = 0, '*', a.args) as "Argument_data_types",
               (select min(d.description) from pg_description d where d.objoid = p.oid and d.catalog_name = 'pg_proc') as "Description"
        from pg_proc p left join pg_namespace n on p.pronamespace = n.oid
        left join (select g.oid, array_to_string(list(ifnull(s.shown, '???') order by g.pos), ', ') as args
                   from pg_proc_args g left join shown s on s.oid = g.type_oid group by g.oid) a on a.oid = p.oid
        where p.proisagg {f'and p.oid in ({_PROCS_ON_PATH})' if visible else ''}""",
                      "pg_proc", "pg_namespace", "pg_type", "pg_proc_args", "pg_description",
                      *(["search_path"] if visible else []), extra=_shown_types(visible))


def _casts_sql(visible: bool) -> str:
    return with_roles(f"""
        select ifnull(a.shown, '???') as "Source_type", ifnull(b.shown, '???') as "Target_type",
               if(x.castfunc = 0, '(binary coercible)', f.proname) as "Function",
               case x.castcontext when 'a' then 'in assignment' when 'e' then 'no' else 'yes' end as "Implicit?"
        from pg_cast x left join shown a on a.oid = x.castsource left join shown b on b.oid = x.casttarget
        left join pg_proc f on f.oid = x.castfunc
        {'where x.castsource in (select oid from on_path) or x.casttarget in (select oid from on_path)' if visible else ''}""",
                      "pg_cast", "pg_proc", "pg_type", "pg_namespace", *(["search_path"] if visible else []),
                      extra=_shown_types(visible))


def _table_schema_sql(counts: str, keys: str) -> str:
    """Columns with the row counts of their table, found by ``keys``."""
    return with_roles(f"""
        select c.table_schema, c.table_name, c.column_name, c.data_type, k.rows
        from sys_columns c, counts k
        where {' and '.join(f'c.{x} = k.{x}' for x in keys.split())}
          and (c.table_schema, c.table_name) in (select (table_schema, table_name) from sys_tables)""",
                      "sys_tables", "sys_columns", extra={
                          "parts": "select table_schema, table_name, row_count from sys_tables where index_id < 2",
                          "counts": counts})


def _ordered(sql: str) -> str:
    return f"select count(*) as n_rows, cast(0 as bigint) as out_of_order from ({sql})"


def _ms(expr: str) -> str:
    """Epoch milliseconds, truncated (DuckDB's epoch_ms rounds)."""
    return f"(epoch_us({expr}) // 1000)"


def _rest_sql() -> str:
    s_ms = _ms(f"timestamp '{R.EV_START} 00:00:00'")
    e_ms = _ms(f"(timestamp '{R.EV_END} 00:00:00' + interval 1 day)") + " - 1"
    from whlens.sources.json_pages import HISTORY_METRICS
    mcols = ", ".join(f"{rest_metric_rule(n, i, ty.simpleString())} as {n}"
                      for i, (n, ty) in enumerate(HISTORY_METRICS))
    return f"""
        select cast(event_id as varchar) as query_id, text as query_text, user_id,
               concat('user', cast(user_id as varchar)) as "user", {_ms('ts')} as start_time,
               {_ms('ts')} + cast(trunc(value * 1000) as bigint) as end_time, 'FINISHED' as status, {mcols}
        from events e left join documents d on e.event_id = d.doc_id
        where e.event_type <> 'error' and {_ms('ts')} between {s_ms} and {e_ms}
          and not contains(coalesce(text, ''), 'This is a system generated query from sql editor')
          and not contains(coalesce(text, ''), 'SELECT * FROM system.information_schema')
          and not contains(coalesce(text, ''), 'SET use_cached_result = false ')"""


# Date columns of the checked outputs, compared as midnight timestamps.
DATE_OUTPUTS = {"usage_with_warehouse": ["usage_date"], "usage_cost": ["usage_date"],
                "usage_cost_unpriced": ["usage_date"], "usage_latest_name": ["usage_date"],
                "usage_window": ["usage_date"], "usage_cost_bucketed": ["usage_date"], "usage_cost_sorted": ["usage_date"]}


def _dates_as_timestamps(sql: str, cols) -> str:
    repl = ", ".join(f"cast({c} as timestamp) as {c}" for c in cols)
    return f"select * replace ({repl}) from ({sql}) q"


def oracle_sql() -> dict[str, str]:
    q = _oracle_sql()
    for name, cols in DATE_OUTPUTS.items():
        q[name] = _dates_as_timestamps(q[name], cols)
    return q


def _oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_table"] = "select * from customer"
    q["history_capped"] = "select * from events"
    q["catalog_columns"] = with_roles(f"select * from info_columns where table_catalog = '{R.CATALOG}'",
                                      "info_columns")
    q["usage_with_warehouse"] = with_roles(_named_usage(), "usage", "warehouses")
    q["usage_cost"] = q["usage_cost_bucketed"] = q["usage_cost_sorted"] = _priced_usage("join")
    q["usage_cost_unpriced"] = _priced_usage("left join")
    q["usage_cost_order"] = _ordered(q["usage_cost"])
    newest = """select account_id, workspace_id, warehouse_id,
          first(warehouse_name order by change_time desc, warehouse_name asc nulls last) as warehouse_name
        from warehouses group by all"""
    q["usage_latest_name"] = with_roles(_named_usage(newest), "usage", "warehouses")
    q["usage_window"] = with_roles(f"""
        select * from usage where billing_origin_product = 'SQL'
          and usage_date between date '{R.USAGE_START}' and date '{R.USAGE_END}'""", "usage")
    q["struct_access"] = with_roles("select account_id, warehouse_id, sku_name, usage_quantity from usage", "usage")
    q["price_struct_access"] = with_roles(
        "select sku_name, price_start_time, price as price_per_unit from list_prices", "list_prices")
    q["version_intervals"] = with_roles(_intervals(), "warehouse_changes")
    q["warehouse_events"] = q["warehouse_events_bucketed"] = q["warehouse_events_sorted"] = _valid_events("<=")
    q["warehouse_events_single"] = _valid_events("<")
    q["warehouse_events_order"] = _ordered(q["warehouse_events"])
    q["warehouse_info"] = with_roles("""
        select * exclude (rn) from (
          select *, row_number() over (partition by warehouse_id, workspace_id, account_id, warehouse_name
                                       order by change_time desc) as rn from warehouses) where rn = 1""",
                                     "warehouses")
    q["hourly_history"] = with_roles(f"""
        select *, strftime(start_time, '%Y%m%d_%H') as hour from query_history
        where start_time >= {EV_S} and start_time < {EV_E1}""", "query_history")
    q["hourly_counts"] = with_roles(f"""
        select strftime(start_time, '%Y%m%d_%H') as hour, count(*) as n from query_history
        where start_time >= {EV_S} and start_time < {EV_E1} group by 1""", "query_history")
    q["rest_history"] = _rest_sql()
    q["history_epoch_ms"] = f"""
        select event_id, {_ms('ts')} as start_time_ms, event_type from events
        where {_ms('ts')} between {_ms(EV_S)} and {_ms(EV_E1)} - 1"""
    q["exclude_system_queries"] = "select * from documents where not contains(coalesce(text, ''), 'License')"
    q["nested_to_json"] = ("select event_id, to_json({'event_type': event_type, 'user_id': user_id}) as detail "
                           "from events")
    q["json_metrics"] = "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events"
    q["round_ms"] = """
        select event_id, make_timestamp((q + case when r > 500 or (r = 500 and q % 2 <> 0) then 1 else 0 end) * 1000)
                 as ts
        from (select event_id, r, (us - r) // 1000 as q
              from (select event_id, us, ((us % 1000) + 1000) % 1000 as r
                    from (select event_id, epoch_us(ts) as us from events)))"""
    q["iso_text"] = f"select event_id, {_iso('ts')} as ts from events"
    q["live_objects"] = with_roles(
        "select * from sf_tables where deleted is null and table_catalog not in ('SNOWFLAKE')", "sf_tables")
    q["live_views"] = with_roles(
        "select * from sf_views where deleted is null and table_catalog not in ('SNOWFLAKE')", "sf_views")
    q["live_functions"] = with_roles("""
        select table_catalog as function_catalog, table_schema, table_name, deleted from sf_tables
        where deleted is null and table_catalog not in ('SNOWFLAKE')""", "sf_tables")
    q["tables_with_views"] = with_roles("""
        select a.*, b.view_definition from sf_tables a left join sf_views b
          on a.table_catalog = b.table_catalog and a.table_schema = b.table_schema and a.table_name = b.table_name
        where a.deleted is null and a.table_catalog not in ('SNOWFLAKE')""", "sf_tables", "sf_views")
    q["warehouse_usage"] = f"""
        select * from events where cast(ts as date) between date '{R.EV_START}' and date '{R.EV_END}'"""
    q["history_by_end_time"] = f"""
        select event_id as query_id, ts as end_time, event_type as query_type, value from events
        where ts >= {EV_S} and ts <= {EV_E_SEC}"""
    q["closed_window"] = with_roles(
        f"select * from query_history where start_time between {EV_S} and {EV_E}", "query_history")
    q["query_text"] = with_roles(f"""
        select stl_query.userid, stl_query.xid, stl_query.pid, stl_query.query, stl_query.aborted,
               stl_query.concurrency_scaling_status, stl_query.starttime, stl_query.endtime,
               stl_querytext.sequence, stl_querytext.text
        from stl_query join stl_querytext using (userid, xid, pid, query)
        where stl_query.starttime >= timestamp '{R.TEXT_START} 00:00:00'
          and stl_query.starttime <= timestamp '{R.TEXT_END} 00:00:00'""", "stl_query", "stl_querytext")
    q["query_ddl"] = _statements("if(trimmed = '', text, trimmed)")
    q["query_ddl_raw"] = _statements("text")
    q["query_metrics"] = _metric_sql(QUERY_METRICS_COLUMNS, "starttime")
    q["query_queue_info"] = _metric_sql(QUERY_QUEUE_INFO_COLUMNS, "queue_start_time")
    q["query_wlm"] = _metric_sql(QUERY_WLM_COLUMNS, "queue_start_time")
    for visible, suffix in ((False, ""), (True, "_visible")):
        q["rs_types" + suffix] = _types_sql(visible)
        q["rs_aggregates" + suffix] = _aggregates_sql(visible)
        q["rs_casts" + suffix] = _casts_sql(visible)
    q["visible_objects"] = with_roles("""
        select oid, typname, typnamespace, nspname from (
          select t.oid, t.typname, t.typnamespace, n.nspname,
                 row_number() over (partition by t.typname order by sp.rank_on_path, t.oid) as rn
          from pg_type t join pg_namespace n on n.oid = t.typnamespace
          join search_path sp on sp.nspname = n.nspname) where rn = 1""",
                                      "pg_type", "pg_namespace", "search_path")
    q["describe_objects"] = with_roles("""
        select t.oid, t.typname, d.description from pg_type t
        left join (select objoid, description from pg_description where catalog_name = 'pg_type') d
          on d.objoid = t.oid""", "pg_type", "pg_description")
    q["table_schema"] = _table_schema_sql("select table_schema, table_name, row_count as rows from parts", "table_schema table_name")
    q["table_schema_order"] = _ordered(q["table_schema"])
    q["table_schema_by_name"] = _table_schema_sql("select table_name, row_count as rows from parts", "table_name")
    q["table_schema_summed"] = _table_schema_sql(
        "select table_schema, table_name, cast(sum(row_count) as bigint) as rows from parts group by all", "table_schema table_name")
    q["numeric_columns"] = with_roles("""
        select t.table_schema as schema_name, t.table_name, c.column_name, c.data_type as type_name
        from (select distinct object_id, table_schema, table_name from sys_tables) t
        join sys_columns c on t.object_id = c.object_id
        where c.data_type in ('int', 'bigint', 'smallint', 'decimal', 'numeric', 'float', 'real')""",
                                      "sys_tables", "sys_columns")
    q["query_stats_text"] = with_roles(f"""
        select qs.*, st.text from query_stats qs join query_texts st on st.sql_handle = qs.sql_handle
        where qs.creation_time >= timestamp '{R.STATS_START} 00:00:00'
          and qs.creation_time <= timestamp '{R.STATS_END} 00:00:00'""", "query_stats", "query_texts")
    q["column_min_max"] = _min_max_sql(["lineitem"])
    q["column_min_max_all"] = _min_max_sql(R.PROFILE_TABLES)
    q["column_stats_exact"] = _stats_sql(R.PROFILE_TABLES, R.STATS_SCHEMA)
    q["column_stats"] = f"""
        select * exclude (distinct_values_count), if(column_name is null, null, true) as distinct_ok
        from ({q['column_stats_exact']})"""
    q["history_trino_window"] = f"""
        select event_id, ts as created, user_id, event_type, value, props from events
        where ts >= {EV_S} and ts < {EV_E1}"""
    q["history_text_date"] = f"""
        select event_id, strftime(ts, '%Y-%m-%d') as date,
               to_json(map(['event_type'], [event_type])) as session_properties,
               {_iso('ts', ' ', 'NaT')} as create_time, {_iso('ts', ' ', 'NaT')} as execution_start_time,
               {_iso('ts', ' ', 'NaT')} as end_time, value
        from events where strftime(ts, '%Y-%m-%d') between '{R.EV_START}' and '{R.EV_END}'"""
    q["stats_incremental"] = f"select * from ({q['column_stats']}) s where table_name = 'events'"
    q["landed_history"] = q["rest_history"]
    q["landed_ledger"] = """
        select case when page % 5 >= 3 then 'document' else 'lines' end as form, case page % 5 when 4 then 'unreadable' else 'read' end as status,
               cast(count(*) filter (page % 5 <> 4) as bigint) as pages,
               cast(coalesce(sum(n) filter (page % 5 <> 4), 0) as bigint) as records, count(*) filter (page % 5 = 4) as unreadable
        from (select event_id // 100 as page, count(*) as n from events group by 1) p group by 1, 2"""
    q["hourly_reexport"] = with_roles(f"""
        select strftime(start_time, '%Y%m%d_%H') as hour, count(*) filter (kept) as n, count(*) filter (kept) as ledger_n,
               cast(case when cast(min(start_time) as date) = date '{R.EV_START}' then 2 else 1 end as bigint) as runs
        from (select start_time, cast(start_time as date) = date '{R.EV_END}' or coalesce(statement_type, '') <> 'error' as kept from query_history
              where cast(start_time as date) in (date '{R.EV_START}', date '{R.EV_END}')) h
        group by 1 having count(*) filter (kept) > 0""", "query_history")
    q["export_parquet"] = f"""
        select e.event_id, r.ts, e.value, to_json({{'event_type': e.event_type, 'user_id': e.user_id}})::varchar as detail
        from events e join ({q['round_ms']}) r on r.event_id = e.event_id"""
    late = "case when event_id % 3 > 0 then ts end"
    q["export_csv"] = f"""
        select cast(event_id as varchar) as event_id, {_iso('ts')} as ts, {_iso(f'({late})')} as ended, event_type from events"""
    counted = [f"select '{n}' as table_name, count(*) as row_count from {n}" for n in R.PROFILE_TABLES]
    q["table_sizes"] = f"""
        with sizes as ({' union all '.join(counted)})
        select *, true as has_files, true as has_bytes from
          (select * from sizes union all select null, cast(sum(row_count) as bigint) from sizes) s"""
    q["concat_conflicts"] = """
        select cast(c_custkey as varchar) as id, cast(c_nationkey as double) as amount, to_json({'name': c_name, 'kind': c_mktsegment})::varchar as detail,
               cast(c_custkey as varchar) as info_a, c_acctbal as info_v, c_name as info_w,
               concat(c_custkey, '|', c_nationkey) as xs, timestamp '2024-01-05 00:00:00' as at from customer
        union all
        select s_name, s_acctbal, s_name, s_name, cast(s_suppkey as double), null, s_name, timestamp '2024-01-05 01:02:03' from supplier"""
    q["concat_missing"] = """
        select c_name, c_acctbal, c_mktsegment from customer
        union all by name select s_name, s_acctbal from supplier"""
    q["exec_window"] = with_roles(
        f"select * from executions where submission is not null and submission between {EV_S} and {EV_E}",
        "executions")
    q["take_until"] = with_roles(f"""
        select * from executions
        where pos < coalesce((select min(pos) from executions where submission < {EV_S}), 9223372036854775807)
          and submission is not null and submission between {EV_S} and {EV_E}""", "executions")
    q["flatten_events"] = with_roles("""
        select pos, submission as "Status.SubmissionDateTime", state as "Status.State", value from executions""",
                                     "executions")
    q["athena_query_logs"] = q["athena_query_logs_zoned"] = with_roles(f"""
        select pos, {_iso('submission')} as "Status.SubmissionDateTime", state as "Status.State", value
        from executions where submission is not null and submission between {EV_S} and {EV_E}""", "executions")
    return q
