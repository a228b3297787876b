"""Kinds of columns: which Spark type carries them, how they compare and how they are written out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds that automated repair may write.
REPAIRABLE = frozenset((
    "UUID", "INT", "INET", "LIST", "TIMEUUID", "VARINT", "BIGINT", "BOOLEAN", "ASCII", "DATE", "BLOB", "FLOAT", "SET", "SMALLINT", "TIMESTAMP", "MAP", "TINYINT", "TEXT", "TIME", "DOUBLE", "DECIMAL",
))
#: Kinds whose cells carry no write time and no time to live.
COLLECTIONS = frozenset(("LIST", "SET", "MAP"))
#: Kinds that a Spark type may stand for, the first by default.
KINDS = {
    "string": ("TEXT", "ASCII", "VARCHAR", "UUID", "TIMEUUID", "INET", "VARINT"),
    "bigint": ("BIGINT", "TIME"),
    "int": ("INT",),
    "smallint": ("SMALLINT",),
    "tinyint": ("TINYINT",),
    "double": ("DOUBLE",),
    "float": ("FLOAT",),
    "boolean": ("BOOLEAN",),
    "binary": ("BLOB",),
    "date": ("DATE",),
    "timestamp": ("TIMESTAMP",),
    "timestamp_ntz": ("TIMESTAMP",),
    "decimal": ("DECIMAL", "VARINT"),
    "array": ("LIST", "SET"),
    "map": ("MAP",),
    "struct": ("TUPLE",),
}


def kind_of(data_type: T.DataType, declared: str | None = None) -> str:
    family = data_type.simpleString().split("(")[0].split("<")[0]
    allowed = KINDS.get(family, (family.upper(),))
    if declared is None:
        return allowed[0]
    if declared not in allowed:
        raise ValueError(f"{declared} can't be held in {data_type.simpleString()}")
    return declared


def comparable(value: Column, data_type: T.DataType, kind: str | None = None) -> Column:
    """A form that is equal exactly where values are: maps as sorted entries, sets without order or repeats."""
    if isinstance(data_type, T.MapType):
        entry = lambda e: F.struct(comparable(e["key"], data_type.keyType).alias("key"), comparable(e["value"], data_type.valueType).alias("value"))
        return F.array_sort(F.transform(F.map_entries(value), entry))
    if isinstance(data_type, T.ArrayType):
        inner = data_type.elementType
        if isinstance(inner, (T.MapType, T.ArrayType, T.StructType)):
            value = F.transform(value, lambda x: comparable(x, inner))
        return F.array_sort(F.array_distinct(value)) if kind == "SET" else value
    if isinstance(data_type, T.StructType):
        made = F.struct(*(comparable(value[f.name], f.dataType).alias(f.name) for f in data_type.fields))
        return F.when(value.isNotNull(), made)
    return value


def differs(a: Column, b: Column, data_type: T.DataType, kind: str | None = None) -> Column:
    """Whether two cells differ; null equals null only, NaN equals NaN, 0.0 equals -0.0."""
    return ~comparable(a, data_type, kind).eqNullSafe(comparable(b, data_type, kind))


def rendered(value: Column, data_type: T.DataType, kind: str | None = None) -> Column:
    """Text of a value: moments as epoch milliseconds, bytes as UTF-8, null as ``null``, collections in order."""
    return F.coalesce(_text(value, data_type, kind), F.lit("null"))


def _text(value: Column, data_type: T.DataType, kind: str | None) -> Column:
    if isinstance(data_type, T.DateType):
        return (F.unix_date(value).cast("long") * 86_400_000).cast("string")
    if isinstance(data_type, T.TimestampType):
        return F.unix_millis(value).cast("string")
    if isinstance(data_type, T.TimestampNTZType):
        return F.floor(epoch_micros(value, data_type) / 1000).cast("string")
    if isinstance(data_type, T.MapType):
        key, item = data_type.keyType, data_type.valueType
        entries = F.array_sort(F.map_entries(value))
        return F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda e: F.concat(rendered(e["key"], key), F.lit("="), rendered(e["value"], item))), ", "), F.lit("}"))
    if isinstance(data_type, T.ArrayType):
        inner = data_type.elementType
        items = F.array_sort(F.array_distinct(value)) if kind == "SET" else value
        return F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: rendered(x, inner)), ", "), F.lit("]"))
    return value.cast("string")


def epoch_micros(value: Column, data_type: T.DataType) -> Column:
    """Microseconds since 1970, whatever the session's time zone."""
    if isinstance(data_type, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), value)
    return F.unix_micros(value)
