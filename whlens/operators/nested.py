"""Nested records: flattening, fixed projections, JSON text and schema-union
concatenation (P5-P8, N3, N4, U2)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field(path: str) -> Column:
    """P5: struct field access by a dotted path; each level is quoted, so
    reserved words such as ``default`` need no special care."""
    parts = path.split(".")
    c = F.col(f"`{parts[0]}`")
    for p in parts[1:]:
        c = c.getField(p)
    return c


def _has_path(schema: T.StructType, path: Sequence[str]) -> bool:
    dtype: T.DataType = schema
    for p in path:
        if not isinstance(dtype, T.StructType) or p not in dtype.fieldNames():
            return False
        dtype = dtype[p].dataType
    return True


def field_or_null(df: DataFrame, path: str, dtype: str | None = None) -> Column:
    """The field at ``path`` or a typed null when the schema lacks it
    (a missing JSON key reads as null)."""
    if _has_path(df.schema, path.split(".")):
        c = field(path)
        return c.cast(dtype) if dtype else c
    return F.lit(None).cast(dtype or "string")


def leaf_paths(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Paths to every non-struct leaf; arrays and maps are leaves."""
    out = []
    for f in schema.fields:
        p = prefix + (f.name,)
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            out.extend(leaf_paths(f.dataType, p))
        else:
            out.append(p)
    return out


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """One column per leaf, named by joining the path with ``sep``.
    A null parent gives null leaves; arrays stay whole."""
    cols = []
    for p in leaf_paths(df.schema):
        c = F.col(f"`{p[0]}`")
        for name in p[1:]:
            c = c.getField(name)
        cols.append(c.alias(sep.join(p)))
    return df.select(*cols)


def tag(df: DataFrame, **consts) -> DataFrame:
    """Constant columns (``schema_name``, ``table_name``, ...)."""
    return df.withColumns({k: F.lit(v) for k, v in consts.items()})


def is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.ArrayType, T.MapType))


def json_text(c: Column) -> Column:
    """JSON text of a nested value; null fields are written as ``null``."""
    return F.to_json(c, {"ignoreNullFields": "false"})


def nested_to_json(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Struct / array / map columns to JSON text, decided by the schema
    type (not by sampling values). Null fields are written as ``null``."""
    names = columns if columns is not None else [f.name for f in df.schema.fields if is_nested(f.dataType)]
    if not names:
        return df
    return df.withColumns({n: json_text(F.col(f"`{n}`")) for n in names})


def json_field(c: Column | str, path: str, dtype: str = "string") -> Column:
    """A single value from JSON text by JSON path; null when absent."""
    col = F.col(c) if isinstance(c, str) else c
    return F.get_json_object(col, path).cast(dtype)


def _key(name: str, case_sensitive: bool) -> str:
    return name if case_sensitive else name.lower()


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _digits(dtype: T.DataType) -> T.DecimalType:
    """The decimal type that holds every value of an integer or decimal type."""
    if isinstance(dtype, T.DecimalType):
        return dtype
    return T.DecimalType((3, 5, 10, 19)[_INTEGERS.index(type(dtype))], 0)


def common_type(a: T.DataType, b: T.DataType, case_sensitive: bool = False) -> T.DataType:
    """The least type that holds the values of both.

    Integers go to the wider one, with decimals to a decimal, with floating point to
    double; dates to timestamps; structs to the struct of both's fields, arrays and maps
    to those of their elements' common type. What is left (a number and a text, a struct
    and a text, a decimal of more than 38 digits) goes to text, nested values as JSON."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = (type(a), type(b))
    if all(k in _INTEGERS for k in kinds):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    if all(isinstance(t, T.NumericType) for t in (a, b)):
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in (a, b)):
            return T.DoubleType()
        x, y = _digits(a), _digits(b)
        scale = max(x.scale, y.scale)
        precision = max(x.precision - x.scale, y.precision - y.scale) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else T.StringType()
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if all(k in times for k in kinds):
        return T.TimestampType() if T.TimestampType in kinds else T.TimestampNTZType()
    if kinds == (T.StructType, T.StructType):
        fields = {_key(f.name, case_sensitive): f for f in a.fields}
        for f in b.fields:
            k = _key(f.name, case_sensitive)
            known = fields.get(k)
            fields[k] = T.StructField(known.name, common_type(known.dataType, f.dataType, case_sensitive)) if known else f
        return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])
    if kinds == (T.ArrayType, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType, case_sensitive))
    if kinds == (T.MapType, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, common_type(a.valueType, b.valueType, case_sensitive))
    return T.StringType()


def as_type(c: Column, have: T.DataType, want: T.DataType, case_sensitive: bool = False) -> Column:
    """A value of type ``have`` as the ``common_type`` ``want`` that it is part of."""
    if have == want:
        return c
    if isinstance(want, T.StringType):
        if isinstance(have, T.BinaryType):
            return F.hex(c)
        return json_text(c) if is_nested(have) else c.cast("string")
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        mine = {_key(f.name, case_sensitive): f for f in have.fields}
        fields = []
        for f in want.fields:
            m = mine.get(_key(f.name, case_sensitive))
            value = as_type(c.getField(m.name), m.dataType, f.dataType, case_sensitive) if m else F.lit(None).cast(f.dataType)
            fields.append(value.alias(f.name))
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(c, lambda x: as_type(x, have.elementType, want.elementType, case_sensitive))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(c, lambda _, x: as_type(x, have.valueType, want.valueType, case_sensitive))
    return c.cast(want)


def concat_frames(dfs: Sequence[DataFrame]) -> DataFrame:
    """Append frames by column name; a column missing from a frame is null, and one
    whose types differ has their ``common_type``. Names differ in case only where
    ``spark.sql.caseSensitive`` says so."""
    case_sensitive = dfs[0].sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    whole = reduce(lambda a, b: common_type(a, b, case_sensitive), [T.StructType(df.schema.fields) for df in dfs])

    def shaped(df: DataFrame) -> DataFrame:
        mine = {_key(f.name, case_sensitive): f for f in df.schema.fields}
        columns = []
        for f in whole.fields:
            m = mine.get(_key(f.name, case_sensitive))
            value = as_type(F.col(f"`{m.name.replace('`', '``')}`"), m.dataType, f.dataType, case_sensitive) if m else F.lit(None).cast(f.dataType)
            columns.append(value.alias(f.name))
        return df.select(*columns)
    return reduce(lambda a, b: a.union(b), [shaped(df) for df in dfs])
