"""Catalog inventories: metadata joins, lookups and visibility (J3, J7, J8,
J10-J15, C11, C14, A7).

Both sides of these joins are catalog metadata (no fact table is involved),
so most are plain joins: Spark's planner broadcasts a side whose estimated
size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-plans from
the measured shuffle sizes; larger catalogs stay sort-merge joins. Tables,
partitions and columns of a whole server (``table_schema``) are never
broadcast: they have many rows in few compressed bytes. Vendor functions without a Spark twin (``format_type``,
``obj_description``, ``oidvectortypes``, ``pg_*_is_visible``) are modelled as
lookups into landed catalog tables and a window ranking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from whlens.operators.filters import live_rows, visible_objects
from whlens.operators.joins import spread_order

# The SQL Server type names whose columns get min/max profiles.
NUMERIC_TYPE_NAMES = ("int", "bigint", "smallint", "decimal", "numeric", "float", "real")


def order_by_ordinal(df: DataFrame, *positions: int) -> DataFrame:
    """O3: ``ORDER BY 1, 2``: PostgreSQL-family ascending order puts nulls last."""
    return spread_order(df, *[F.col(f"`{df.columns[i - 1]}`").asc_nulls_last() for i in positions])


# --- Snowflake -------------------------------------------------------------

def tables_with_views(tables: DataFrame, views: DataFrame,
                      excluded_catalogs: Sequence[str] = ("SNOWFLAKE",)) -> DataFrame:
    """Live tables left-joined on (catalog, schema, name) to views, adding
    ``view_definition``. Views are not filtered on ``deleted`` (a dropped view
    of the same name multiplies the row, as in the source SQL)."""
    a = live_rows(tables, excluded_catalogs=excluded_catalogs)
    b = views.select(F.col("table_catalog").alias("_v_cat"), F.col("table_schema").alias("_v_sch"),
                     F.col("table_name").alias("_v_name"), "view_definition")
    cond = ((F.col("table_catalog") == F.col("_v_cat")) & (F.col("table_schema") == F.col("_v_sch"))
            & (F.col("table_name") == F.col("_v_name")))
    return a.join(b, cond, "left").select(*[F.col(f"`{c}`") for c in a.columns], "view_definition")


# --- Redshift / PostgreSQL catalog -----------------------------------------

# How built-in types are displayed, by type oid.
DISPLAYED_TYPES = {
    16: "boolean", 18: '"char"', 20: "bigint", 21: "smallint", 23: "integer", 700: "real", 701: "double precision",
    1042: "character", 1043: "character varying", 1083: "time without time zone",
    1114: "timestamp without time zone", 1184: "timestamp with time zone", 1186: "interval",
    1266: "time with time zone", 1560: "bit", 1562: "bit varying", 1700: "numeric",
}
UNKNOWN_TYPE = "???"


def quoted_name(c: Column) -> Column:
    """An identifier as SQL text shows it: quoted unless it is plain lower case."""
    return F.when(c.rlike("^[a-z_][a-z0-9_$]*$"), c).otherwise(
        F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))


def displayed_types(pg_type: DataFrame, pg_namespace: DataFrame | None = None,
                    search_path: DataFrame | None = None) -> DataFrame:
    """(oid, displayed): the display name of every type. Built-in types have
    their SQL names, arrays (``_name`` with an element type) their element's and
    ``[]``; with a search path, types that it doesn't show have their schema."""
    t = pg_type.select("oid", "typname", "typelem", *(["typnamespace"] if search_path is not None else []))
    shown = quoted_name(F.col("typname"))
    if search_path is not None:
        vis = visible_type_oids(pg_type, pg_namespace, search_path).select(F.col("oid").alias("_vis"))
        t = with_namespace(t, "typnamespace", pg_namespace, "_ns").join(vis, F.col("oid") == F.col("_vis"), "left")
        shown = F.when(F.col("_vis").isNull() & F.col("_ns").isNotNull(),
                       F.concat(quoted_name(F.col("_ns")), F.lit("."), shown)).otherwise(shown)
    for oid, name in DISPLAYED_TYPES.items():
        shown = F.when(F.col("oid") == oid, F.lit(name)).otherwise(shown)
    t = t.select("oid", shown.alias("_own"), F.when(F.col("typname").startswith("_") & (F.col("typelem") != 0), F.col("typelem")).alias("_elem"))
    elem = t.select(F.col("oid").alias("_e_oid"), F.col("_own").alias("_e_name"))
    out = t.join(elem, F.col("_elem") == F.col("_e_oid"), "left")
    return out.select("oid", F.when(F.col("_elem").isNull(), F.col("_own")).otherwise(
        F.concat(F.coalesce("_e_name", F.lit(UNKNOWN_TYPE)), F.lit("[]"))).alias("displayed"))


def type_name(df: DataFrame, oid_col: str, displayed: DataFrame, out: str) -> DataFrame:
    """J15 ``format_type(oid, NULL)``: the displayed name; ``???`` for an oid that is no
    type's, null for null."""
    lk = displayed.select(F.col("oid").alias(f"_tn_{out}"), F.col("displayed").alias(out))
    joined = df.join(lk, F.col(oid_col) == F.col(f"_tn_{out}"), "left")
    return joined.withColumn(out, F.when(F.col(oid_col).isNotNull(), F.coalesce(out, F.lit(UNKNOWN_TYPE)))).drop(f"_tn_{out}")


def describe_objects(df: DataFrame, oid_col: str, descriptions: DataFrame, catalog: str,
                     out: str = "description") -> DataFrame:
    """J14 ``obj_description(oid, catalog)``: left lookup in a landed
    (objoid, catalog_name, description) table."""
    lk = (descriptions.where(F.col("catalog_name") == catalog)
          .select(F.col("objoid").alias("_d_oid"), F.col("description").alias(out)))
    return df.join(lk, F.col(oid_col) == F.col("_d_oid"), "left").drop("_d_oid")


def with_namespace(df: DataFrame, ns_col: str, namespaces: DataFrame,
                   out: str = "nspname") -> DataFrame:
    """Left join to the namespace names."""
    lk = namespaces.select(F.col("oid").alias(f"_ns_{out}"), F.col("nspname").alias(out))
    return df.join(lk, F.col(ns_col) == F.col(f"_ns_{out}"), "left").drop(f"_ns_{out}")


def resolve_type_names(df: DataFrame, key: str, vec: str, displayed: DataFrame, out: str,
                       sep: str = ", ") -> DataFrame:
    """C14 ``oidvectortypes``: a vector of type oids to ``sep``-joined displayed names
    in vector order. Long form: posexplode, lookup, ordered listagg per ``key``, which
    carries the other columns along; ``df`` is read once."""
    rest = [c for c in df.columns if c not in (key, vec)]
    longf = df.select(key, *rest, F.posexplode_outer(F.col(vec)).alias("_rt_pos", "_rt_oid"))
    named = type_name(longf, "_rt_oid", displayed, "_rt_name")
    return named.groupBy(key).agg(*[F.any_value(c).alias(c) for c in rest],
                                  F.expr(f"listagg(_rt_name, '{sep}') within group (order by _rt_pos)").alias(out))


def visible_type_oids(pg_type: DataFrame, pg_namespace: DataFrame, search_path: DataFrame) -> DataFrame:
    """Oids of types visible on the search path (``pg_type_is_visible``)."""
    t = with_namespace(pg_type.select("oid", "typname", "typnamespace"), "typnamespace", pg_namespace)
    return visible_objects(t, ["typname"], "nspname", search_path, tie_breakers=["oid"]).select("oid")


def rs_types(pg_type: DataFrame, pg_namespace: DataFrame, pg_class: DataFrame,
             pg_description: DataFrame, search_path: DataFrame | None = None) -> DataFrame:
    """Export ``types``.

    Keeps base/composite types: ``typrelid = 0`` or the related class is a
    composite (``relkind = 'c'``, a scalar subquery == left join on the
    unique class oid), and no type has this type's ``typelem`` as oid
    (``NOT EXISTS`` == left anti join)."""
    t = pg_type
    cls = pg_class.select(F.col("oid").alias("_c_oid"), F.col("relkind").alias("_c_relkind"))
    t = (t.join(cls, F.col("typrelid") == F.col("_c_oid"), "left")
         .where((F.col("typrelid") == 0) | (F.col("_c_relkind") == "c"))
         .drop("_c_oid", "_c_relkind"))
    elem = pg_type.select(F.col("oid").alias("_el_oid"))
    t = t.join(elem, F.col("typelem") == F.col("_el_oid"), "left_anti")
    if search_path is not None:
        t = t.join(visible_type_oids(pg_type, pg_namespace, search_path), "oid", "left_semi")
    t = with_namespace(t, "typnamespace", pg_namespace)
    t = type_name(t, "oid", displayed_types(pg_type, pg_namespace, search_path), "_name")
    t = describe_objects(t, "oid", pg_description, "pg_type", "_descr")
    out = t.select(F.col("nspname").alias("Schema"), F.col("_name").alias("Name"),
                   F.col("_descr").alias("Description"))
    return order_by_ordinal(out, 1, 2)


def rs_aggregates(pg_proc: DataFrame, pg_namespace: DataFrame, pg_type: DataFrame,
                  pg_description: DataFrame, search_path: DataFrame | None = None) -> DataFrame:
    """Export ``aggregates``.

    ``pg_proc.proargtypes`` is an array of type oids. Visibility
    (``pg_function_is_visible``) ranks procs of equal name and argument
    vector along the search path."""
    p = pg_proc.where(F.col("proisagg"))
    if search_path is not None:
        allp = with_namespace(pg_proc.select("oid", "proname", "proargtypes", "pronamespace"),
                              "pronamespace", pg_namespace)
        vis = visible_objects(allp, ["proname", "proargtypes"], "nspname", search_path,
                              tie_breakers=["oid"]).select("oid")
        p = p.join(vis, "oid", "left_semi")
    displayed = displayed_types(pg_type, pg_namespace, search_path)
    p = p.select("oid", "proname", "prorettype", "pronargs", "pronamespace", "proargtypes")
    p = resolve_type_names(p, "oid", "proargtypes", displayed, "_args")
    p = with_namespace(p, "pronamespace", pg_namespace)
    p = type_name(p, "prorettype", displayed, "_ret")
    p = describe_objects(p, "oid", pg_description, "pg_proc", "_descr")
    out = p.select(F.col("nspname").alias("Schema"), F.col("proname").alias("Name"),
                   F.col("_ret").alias("Result_data_type"),
                   F.when(F.col("pronargs") == 0, F.lit("*")).otherwise(F.col("_args"))
                   .alias("Argument_data_types"),
                   F.col("_descr").alias("Description"))
    return order_by_ordinal(out, 1, 2, 4)


def cast_context(c: Column) -> Column:
    """C11: ``e`` -> no, ``a`` -> in assignment, anything else -> yes."""
    return (F.when(c == "e", F.lit("no")).when(c == "a", F.lit("in assignment"))
            .otherwise(F.lit("yes")))


def rs_casts(pg_cast: DataFrame, pg_proc: DataFrame, pg_type: DataFrame,
             pg_namespace: DataFrame, search_path: DataFrame | None = None) -> DataFrame:
    """Export ``casts`` (J11, C11, F13, F16, O3): five left lookups, the type
    lookup used twice (source / target); visible if source or target is."""
    c = pg_cast
    procs = pg_proc.select(F.col("oid").alias("_p_oid"), F.col("proname").alias("_p_name"))
    c = c.join(procs, F.col("castfunc") == F.col("_p_oid"), "left").drop("_p_oid")
    displayed = displayed_types(pg_type, pg_namespace, search_path)
    c = type_name(c, "castsource", displayed, "_src")
    c = type_name(c, "casttarget", displayed, "_tgt")
    if search_path is not None:
        vis = (visible_type_oids(pg_type, pg_namespace, search_path))
        vs = vis.select(F.col("oid").alias("_vs"))
        vt = vis.select(F.col("oid").alias("_vt"))
        c = (c.join(vs, F.col("castsource") == F.col("_vs"), "left")
             .join(vt, F.col("casttarget") == F.col("_vt"), "left")
             .where(F.col("_vs").isNotNull() | F.col("_vt").isNotNull()))
    out = c.select(F.col("_src").alias("Source_type"), F.col("_tgt").alias("Target_type"),
                   F.when(F.col("castfunc") == 0, F.lit("(binary coercible)"))
                   .otherwise(F.col("_p_name")).alias("Function"),
                   cast_context(F.col("castcontext")).alias("Implicit?"))
    return order_by_ordinal(out, 1, 2)


# --- SQL Server --------------------------------------------------------------

def table_partitions(sys_tables: DataFrame, sys_partitions: DataFrame,
                     sys_schemas: DataFrame | None = None, sum_partitions: bool = False) -> DataFrame:
    """Rows per table from heap/clustered partitions (``index_id IN (0,1)``).
    By default one row per partition, as the source SQL (not summed). With
    ``sys_schemas`` the table's schema name is attached (``TableSchema``)."""
    p = sys_partitions.where(F.col("index_id").isin(0, 1))
    t = sys_tables.select(F.col("object_id").alias("_t_oid"), F.col("name").alias("TableName"),
                          F.col("schema_id").alias("_t_sid"))
    keys = ["TableName"]
    if sys_schemas is not None:
        s = sys_schemas.select(F.col("schema_id").alias("_s_sid"), F.col("name").alias("TableSchema"))
        t = t.join(F.broadcast(s), F.col("_t_sid") == F.col("_s_sid"))  # schemas are few
        keys = ["TableSchema", "TableName"]
    p = p.select(F.col("object_id").alias("_p_oid"), "rows")
    a = t.join(p.hint("merge"), F.col("_t_oid") == F.col("_p_oid"))
    a = a.select(*keys, "rows")
    if sum_partitions:
        a = a.groupBy(*keys).agg(F.sum("rows").alias("rows"))
    return a


def table_schema(is_tables: DataFrame, is_columns: DataFrame, sys_tables: DataFrame,
                 sys_partitions: DataFrame, sys_schemas: DataFrame | None = None,
                 by_schema: bool = True, sum_partitions: bool = False) -> DataFrame:
    """Export ``schema`` (J7, A7, F11, O4): every column of every table with
    the table's row count, ordered by table name.

    ``by_schema=True`` (default) attaches the partition row counts by
    (schema, table name). The source SQL joins them by table *name* only
    (``by_schema=False``): a name shared by k schemas then pairs every
    column of each with the partitions of all k tables, k*k rows per name,
    which is both wrong and quadratic in a hot name."""
    tbl = is_tables.select(F.col("table_schema").alias("_ts"), F.col("table_name").alias("_tn"))
    col = is_columns.select("table_schema", "table_name", "column_name", "data_type")
    tc = col.hint("merge").join(tbl, (F.col("table_name") == F.col("_tn")) & (F.col("table_schema") == F.col("_ts")))
    if by_schema:
        if sys_schemas is None:
            raise ValueError("by_schema=True needs sys_schemas")
        a = table_partitions(sys_tables, sys_partitions, sys_schemas, sum_partitions)
        j = tc.hint("merge").join(a, (F.col("table_name") == F.col("TableName"))
                    & (F.col("table_schema") == F.col("TableSchema")))
    else:
        a = table_partitions(sys_tables, sys_partitions, None, sum_partitions)
        j = tc.hint("merge").join(a, F.col("table_name") == F.col("TableName"))
    return spread_order(j, F.col("TableName").asc_nulls_first()).select(
        "table_schema", "table_name", "column_name", "data_type", "rows")


def numeric_columns(sys_tables: DataFrame, sys_schemas: DataFrame, sys_columns: DataFrame,
                    sys_types: DataFrame, type_names: Sequence[str] = NUMERIC_TYPE_NAMES) -> DataFrame:
    """(schema, table, column, type) of every column with a numeric type:
    tables -> schemas -> columns -> types, filtered by type name."""
    t = sys_tables.select(F.col("object_id").alias("_t_oid"), F.col("name").alias("table_name"),
                          F.col("schema_id").alias("_t_sid"))
    s = sys_schemas.select(F.col("schema_id").alias("_s_sid"), F.col("name").alias("schema_name"))
    c = sys_columns.select(F.col("object_id").alias("_c_oid"), F.col("name").alias("column_name"),
                           F.col("user_type_id").alias("_c_tid"))
    tp = (sys_types.where(F.col("name").isin(*type_names))
          .select(F.col("user_type_id").alias("_tp_tid"), F.col("name").alias("type_name")))
    j = (t.join(s, F.col("_t_sid") == F.col("_s_sid"))
         .join(c, F.col("_t_oid") == F.col("_c_oid"))
         .join(tp, F.col("_c_tid") == F.col("_tp_tid")))
    return j.select("schema_name", "table_name", "column_name", "type_name")
