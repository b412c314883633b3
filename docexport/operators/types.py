"""Types that differ between sources: a common type, casts to it, comparable forms.

Files of one index, or indices of one scan, may hold a field in different
types. ``common_type`` gives the narrowest type that all values fit: numbers
widen, times become UTC wall clock, objects and lists are merged part by part,
anything else becomes text. ``conform`` is the cast to it, value by value and
without loss but for the digits that a long has beyond a double.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
                               IntegralType, LongType, MapType, NullType, NumericType, ShortType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType)

from ..functions.timefn import as_utc_ntz

# Microseconds are kept: the defaults cut to milliseconds.
JSON_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
              "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_TIMES = (DateType, TimestampType, TimestampNTZType)
# Whole-number types from narrow to wide, with their digits.
_WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


def same_type(a: DataType, b: DataType) -> bool:
    """Equal but for nullability."""
    return a.simpleString() == b.simpleString()


def common_type(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds the values of both."""
    if same_type(a, b) or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        return _common_number(a, b)
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return TimestampNTZType()
    if isinstance(a, StructType) and isinstance(b, StructType):
        return common_schema([a, b])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, MapType) and isinstance(b, MapType):
        return MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    return StringType()


def _common_number(a: NumericType, b: NumericType) -> DataType:
    if isinstance(a, IntegralType) and isinstance(b, IntegralType):
        return max(a, b, key=lambda t: _WHOLE[type(t)])
    if isinstance(a, (DoubleType, FloatType)) or isinstance(b, (DoubleType, FloatType)):
        return DoubleType()
    (p, s), (q, t) = ((x.precision, x.scale) if isinstance(x, DecimalType) else (_WHOLE[type(x)], 0) for x in (a, b))
    scale = max(s, t)
    precision = max(p - s, q - t) + scale
    return DecimalType(precision, scale) if precision <= 38 else DoubleType()


def common_schema(schemas: list[StructType]) -> StructType:
    """All fields in the order in which they first appear, each with its common type."""
    fields: dict[str, DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            fields[f.name] = common_type(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return StructType([StructField(n, t) for n, t in fields.items()])


def conform(col: Column, src: DataType, dst: DataType) -> Column:
    """``col`` as a value of ``dst``, a type that ``common_type`` gave for ``src``."""
    if same_type(src, dst):
        return col
    if isinstance(src, NullType):
        return F.lit(None).cast(dst)
    if isinstance(dst, StringType):
        return _text(col, src)
    if isinstance(dst, TimestampNTZType):
        return as_utc_ntz(col, src)
    if isinstance(dst, StructType):
        have = {f.name: f.dataType for f in src.fields}
        parts = [(conform(col.getField(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                 for f in dst.fields]
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(dst, ArrayType):
        return F.transform(col, lambda x: conform(x, src.elementType, dst.elementType))
    if isinstance(dst, MapType):
        if not same_type(src.keyType, dst.keyType):
            col = F.transform_keys(col, lambda k, _: conform(k, src.keyType, dst.keyType))
        return F.transform_values(col, lambda _, v: conform(v, src.valueType, dst.valueType))
    return col.cast(dst)


def _text(col: Column, src: DataType) -> Column:
    if isinstance(src, (StructType, ArrayType, MapType)):
        return F.to_json(col, JSON_TIMES)
    if isinstance(src, (TimestampType, TimestampNTZType)):
        text = F.replace(as_utc_ntz(col, src).cast("string"), F.lit(" "), F.lit("T"))
        return F.concat(text, F.lit("Z")) if isinstance(src, TimestampType) else text
    return col.cast("string")


def unite(frames: list[DataFrame]) -> DataFrame:
    """Union by column name, duplicates kept; missing columns are NULL, other types conform to the common one."""
    schema = common_schema([df.schema for df in frames])
    plain = all(same_type(f.dataType, schema[f.name].dataType) for df in frames for f in df.schema.fields)
    if not plain:
        frames = [df.select([conform(F.col(_quoted(f.name)), f.dataType, schema[f.name].dataType).alias(f.name) for f in df.schema.fields])
                  for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def has_map(dtype: DataType) -> bool:
    if isinstance(dtype, MapType):
        return True
    if isinstance(dtype, ArrayType):
        return has_map(dtype.elementType)
    return isinstance(dtype, StructType) and any(has_map(f.dataType) for f in dtype.fields)


def comparable(col: Column, dtype: DataType) -> Column:
    """A form of ``col`` that Spark can group by: maps, at any depth, as their entries sorted by key.

    Values that are equal, whatever the order of their map entries, have equal forms.
    """
    if not has_map(dtype):
        return col
    if isinstance(dtype, ArrayType):
        return F.transform(col, lambda x: comparable(x, dtype.elementType))
    if isinstance(dtype, StructType):
        parts = [comparable(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(col.isNotNull(), F.struct(*parts))
    entries = F.transform(F.map_entries(col), lambda e: F.struct(comparable(e["key"], dtype.keyType).alias("key"),
                                                                comparable(e["value"], dtype.valueType).alias("value")))
    return F.array_sort(entries)
