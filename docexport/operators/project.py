"""Projections: field selection, metadata columns, flattening, renaming.

Dotted field paths are resolved against the schema, not the data: a path
walks through structs (and string-keyed maps); a path that meets an array,
a number or a string gives NULL, and an absent field gives a typed NULL
column. Output columns are named by the full path (``"a.b.c"``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DataType, MapType,
                               NumericType, StringType, StructType)

from .types import JSON_TIMES, common_type, conform


def qcol(name: str) -> Column:
    """A top-level column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def resolve_path(schema: StructType, path: str) -> tuple[Column, DataType] | None:
    """Column and type for a dotted ``path`` through nested structs.

    Returns ``None`` when the path is absent or passes through a value that
    is not an object (array, number, string): such a path has no value.
    """
    parts = path.split(".")
    top = {f.name: f.dataType for f in schema.fields}
    if parts[0] not in top:
        return None
    col, dtype = qcol(parts[0]), top[parts[0]]
    for part in parts[1:]:
        if isinstance(dtype, StructType):
            names = {f.name: f.dataType for f in dtype.fields}
            if part not in names:
                return None
            col, dtype = col.getField(part), names[part]
        elif isinstance(dtype, MapType) and isinstance(dtype.keyType, StringType):
            col, dtype = col.getItem(part), dtype.valueType
        else:
            return None
    return col, dtype


def falsy_to_null(col: Column, dtype: DataType) -> Column:
    """NULL where the value is falsy: 0, false, empty text, empty list or map."""
    if isinstance(dtype, BooleanType):
        return F.when(col, col)
    if isinstance(dtype, NumericType):
        return F.when(col != F.lit(0), col)
    if isinstance(dtype, StringType):
        return F.when(col != F.lit(""), col)
    if isinstance(dtype, BinaryType):
        return F.when(F.length(col) > 0, col)
    if isinstance(dtype, (ArrayType, MapType)):
        return F.when(F.size(col) > 0, col)
    if isinstance(dtype, StructType) and not dtype.fields:
        return F.lit(None).cast(dtype)
    return col


def field_column(schema: StructType, path: str, falsy: str = "keep",
                 absent_type: str = "string") -> Column:
    """One exported field, named by its full path.

    A top-level column whose name is the path itself (a literal dotted key)
    is used when the nested value is missing; a nested value replaces it.
    With ``falsy="null"`` a falsy nested value counts as missing. If both have
    values of different types, the column has their common type.
    """
    names = set(schema.fieldNames())
    literal = qcol(path) if path in names else None
    nested = None
    if "." in path:
        hit = resolve_path(schema, path)
        if hit is not None:
            col, dtype = hit
            nested = falsy_to_null(col, dtype) if falsy == "null" else col
    elif literal is not None:
        return literal.alias(path)
    if nested is not None and literal is not None:
        lit_type = schema[path].dataType
        both = common_type(lit_type, dtype)
        return F.coalesce(conform(nested, dtype, both), conform(literal, lit_type, both)).alias(path)
    if nested is not None:
        return nested.alias(path)
    if literal is not None:
        return literal.alias(path)
    return F.lit(None).cast(absent_type).alias(path)


def select_fields(df: DataFrame, fields, metadata=(), id_col: str | None = "_id",
                  falsy: str = "keep", drop_parents: bool = False) -> DataFrame:
    """Metadata, then the fields, each once, then ``_id`` if not asked for.

    ``drop_parents=True`` reproduces the flattening side effect where the
    parent object of a flattened path is removed: a field that is also the
    first segment of a dotted field comes out empty.
    """
    return df.select(field_columns(df, fields, metadata, id_col, falsy, drop_parents))


def field_columns(df: DataFrame, fields, metadata=(), id_col: str | None = "_id",
                  falsy: str = "keep", drop_parents: bool = False) -> list[Column]:
    """The columns of :func:`select_fields`, for use in a wider projection."""
    schema = df.schema
    out: list[Column] = []
    seen: set[str] = set()
    parents = {f.split(".")[0] for f in fields if "." in f} if drop_parents else set()
    for name in (*metadata, *fields):
        if name in seen:
            continue
        seen.add(name)
        if name in parents:
            out.append(F.lit(None).cast(schema[name].dataType if name in schema.fieldNames()
                                        else StringType()).alias(name))
        else:
            out.append(field_column(schema, name, falsy,
                                    absent_type="double" if name == "_score" else "string"))
    if id_col is not None and id_col not in seen and id_col in schema.fieldNames():
        out.append(qcol(id_col))  # carried for dedup and order, dropped before writing
    return out


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns; names not in the frame are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def cells_as_text(df: DataFrame) -> DataFrame:
    """Whole objects, lists and maps as one JSON text cell each (for CSV)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (StructType, ArrayType, MapType)):
            cols.append(F.to_json(qcol(f.name), JSON_TIMES).alias(f.name))
        else:
            cols.append(qcol(f.name))
    return df.select(cols)
