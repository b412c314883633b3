"""Sources: document scan, hit-shaped JSON, raw CSV, part files."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FractionalType, StringType, StructField, StructType

from ..functions.fmt import parse_decimal_mark
from ..operators.dedup import union_parts
from ..operators.project import qcol
from ..sinks.csv import TIMESTAMP_FORMAT, TIMESTAMP_NTZ_FORMAT, text_options
from ..spec import METADATA_FIELDS
from .parts import has_breaks, header_groups, with_file_position


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"
# A data file's extension, dropped from index names taken from file names.
_DATA_EXT = r"(\.(snappy|gz|zstd|zst|lz4))?\.(parquet|json|jsonl|ndjson|csv|orc|avro|txt)(\.(gz|bz2|zst))?$"


def _index_name(path: str) -> str:
    """Index name of a concrete path: its last element, less a data file extension."""
    return re.sub(_DATA_EXT, "", path.rstrip("/").split("/")[-1])


def _merged(spark: SparkSession, fmt: str, paths, options: dict) -> DataFrame | None:
    """The files read as one frame with the fields of all, or None where Spark can't merge their types."""
    try:
        return spark.read.format(fmt).options(mergeSchema="true", **options).load(paths)
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" in str(e):
            return None
        raise


def _same_types(spark: SparkSession, fmt: str, path: str, options: dict, schema) -> list[DataFrame]:
    """The files of a path in frames of like types: one, unless Parquet or ORC files disagree.

    Disagreeing files are halved in the order of their names until each half
    can be merged, then groups with equal schemas are read together. Footers
    are read by Spark; indices that change their types now and then give few groups.
    """
    if schema is not None:
        return [spark.read.format(fmt).options(**options).schema(schema).load(path)]
    if fmt not in ("parquet", "orc"):
        return [spark.read.format(fmt).options(**options).load(path)]
    df = _merged(spark, fmt, path, options)
    if df is not None:
        return [df]
    files = sorted(spark.read.format(fmt).options(**options).schema("any string").load(path).inputFiles())
    fixed = re.split(r"[*?\[{]", path)[0]
    options = {"basePath": fixed if fixed == path else fixed.rsplit("/", 1)[0]} | options
    groups: dict[str, tuple[StructType, list[str]]] = {}
    todo = [files]
    while todo:
        some = todo.pop()
        df = _merged(spark, fmt, some, options)
        if df is None:
            todo += [some[len(some) // 2:], some[:len(some) // 2]]
            continue
        groups.setdefault(df.schema.simpleString(), (df.schema, []))[1].extend(some)
    return [spark.read.format(fmt).options(**options).schema(s).load(some) for s, some in groups.values()]


def scan(spark: SparkSession, source, fmt: str = "parquet", id_field=None,
         schema: StructType | str | None = None, options: dict | None = None) -> DataFrame:
    """Documents of one index, a wildcard pattern or several indices.

    ``source`` is a path, a glob, a list of them, or a dict ``{index: path}``.
    Every row gets ``_index``: the dict key, or the name of the path element
    that the wildcard matched (else the path's last element). ``id_field``
    names the column that plays ``_id`` (a dict gives one per index). Indices
    with different fields are united by name, missing fields being NULL; a
    field that files or indices hold in different types gets their common type
    (numbers widen, times become UTC wall clock, all else text).
    Filters and projections applied later are pushed into each scan.
    """
    if isinstance(source, dict):
        items = list(source.items())
    else:
        paths = [source] if isinstance(source, str) else list(source)
        items = [(None, p) for p in paths]
    frames = []
    for name, path in items:
        if name is not None:
            index = F.lit(name)
        elif any(ch in path for ch in "*?["):
            parts = re.sub(_SCHEME, "", path).rstrip("/").split("/")
            depth = next(i for i, p in enumerate(parts) if any(ch in p for ch in "*?["))
            # The element of each file's path at the depth of the first wildcard.
            file_parts = F.split(F.regexp_replace(F.col("_metadata.file_path"), _SCHEME, ""), "/")
            index = F.element_at(file_parts, F.lit(depth + 1))
            index = F.regexp_replace(index, _DATA_EXT, "")
        else:
            index = F.lit(_index_name(path))
        idf = id_field.get(name) if isinstance(id_field, dict) else id_field
        for df in _same_types(spark, fmt, path, options or {}, schema):
            # A source that already carries _index (or _id, when no id field is
            # named) keeps its own values.
            cols = [] if "_index" in df.columns else [index.alias("_index")]
            if idf is not None:
                cols.append(qcol(idf).alias("_id"))
            body = [qcol(c) for c in df.columns if not (c == "_id" and idf is not None)]
            frames.append(df.select(*cols, *body))
    return union_parts(*frames)


# Shape of a search hit: metadata around a ``_source`` body.
def hit_schema(source_schema: StructType | str) -> StructType:
    if isinstance(source_schema, str):
        source_schema = StructType.fromDDL(source_schema)
    return StructType([
        StructField("_index", StringType()), StructField("_type", StringType()),
        StructField("_id", StringType()), StructField("_score", DoubleType()),
        StructField("_source", source_schema)])


def lift_hits(hits: DataFrame, metadata=METADATA_FIELDS) -> DataFrame:
    """Metadata beside the body fields, in one row.

    A metadata value replaces a body field of the same name.
    """
    meta = [m for m in metadata if m in hits.columns]
    body = [f.name for f in hits.schema["_source"].dataType.fields if f.name not in meta]
    return hits.select(*[qcol(m) for m in meta],
                       *[F.col("_source").getField(b).alias(b) for b in body])


def read_hits_json(spark: SparkSession, path, source_schema: StructType | str | None = None,
                   metadata=METADATA_FIELDS) -> DataFrame:
    """Hit-shaped JSON lines, lifted.

    Without a declared schema of the body, one is found by a pass over all
    bodies: fields of any of them, numbers widened, and text where bodies
    disagree. Times stay ISO-8601 text, which ranges, order and buckets read.
    """
    if source_schema is not None:
        return lift_hits(spark.read.schema(hit_schema(source_schema)).json(path), metadata)
    hits = spark.read.json(path)
    if "_source" not in hits.columns or not isinstance(hits.schema["_source"].dataType, StructType):
        raise ValueError(f"no hit with a _source body under {path}")
    declared = {f.name: f.dataType for f in hit_schema(StructType([])).fields if f.name != "_source"}
    hits = hits.select(*[qcol(c).cast(declared[c]) if c in declared else qcol(c) for c in hits.columns])
    return lift_hits(hits, metadata)


def write_hits_json(df: DataFrame, path: str, id_field: str, index: str,
                    doc_type: str = "_doc", overwrite: bool = False) -> str:
    """Write rows as hit-shaped JSON lines (the form a search export returns)."""
    body = [c for c in df.columns]
    hits = df.select(
        F.lit(index).alias("_index"), F.lit(doc_type).alias("_type"),
        qcol(id_field).cast("string").alias("_id"), F.lit(1.0).alias("_score"),
        F.struct(*[qcol(c) for c in body]).alias("_source"))
    (hits.write.mode("overwrite" if overwrite else "errorifexists")
     .option("timestampNTZFormat", TIMESTAMP_NTZ_FORMAT)
     .option("timestampFormat", TIMESTAMP_FORMAT)
     .json(path))
    return path


def read_csv(spark: SparkSession, path, schema: StructType | str | None = None,
             sep: str = ",", decimal: str = ".", multi_line: bool | None = None) -> DataFrame:
    """A raw CSV with header, separator and decimal mark (S3).

    With a schema, its columns are found by header name: the file may order
    them differently and hold more. A schema with as many columns as the header
    may give columns new names, if every name that both know stands at the same
    place. Any other declared column that the header lacks, a file of the path
    with another header and a cell that is not of the declared type raise. With a decimal mark other than the dot, declared fractional
    columns are read as text and converted; Spark's CSV reader itself only
    knows the dot. Without a schema types are inferred, and with such a mark a
    column of nothing but numbers written with it is a double. Files without
    line breaks in cells are split among tasks, others read whole by one task
    each; the export's manifest or a look at the lines tells which, unless
    ``multi_line`` does.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if multi_line is None:
        multi_line = has_breaks(spark, path)
    return _read_like(spark, path, schema, sep, decimal, multi_line)


def _read_like(spark: SparkSession, path, schema: StructType | None, sep: str, decimal: str, multi_line: bool,
               base: str | None = None) -> DataFrame:
    """Files with one header."""
    opts = text_options(sep, write=False) | ({"basePath": base} if base else {})
    opts["multiLine"] = "true" if multi_line else "false"
    if schema is None:
        return _numbers_with_mark(spark.read.options(**opts).option("inferSchema", "true").csv(path), decimal)
    marked = {f.name: f.dataType for f in schema.fields
              if decimal != "." and isinstance(f.dataType, FractionalType)}
    declared = {f.name: StructField(f.name, StringType() if f.name in marked else f.dataType) for f in schema.fields}
    header = spark.read.options(**opts).csv(path).columns
    if header:  # without any, there is no row either
        absent = [c for c in declared if c not in header]
        renamed = len(declared) == len(header) and all(c == h or (c not in header and h not in declared)
                                                       for c, h in zip(declared, header))
        if absent and not renamed:
            raise ValueError(f"the CSV header has no column {', '.join(absent)}: {header}")
        types = list(declared.values()) if renamed else [declared.get(c) for c in header]
        in_file = StructType([StructField(h, f.dataType if f else StringType()) for h, f in zip(header, types)])
        raw = spark.read.options(**opts).option("enforceSchema", "false").option("mode", "FAILFAST").schema(in_file).csv(path)
        if renamed:
            raw = raw.toDF(*declared)
    else:
        raw = spark.createDataFrame([], StructType(list(declared.values())))
    return raw.select([parse_decimal_mark(qcol(c), decimal, marked[c]).alias(c) if c in marked else qcol(c)
                       for c in declared])


def _numbers_with_mark(df: DataFrame, decimal: str) -> DataFrame:
    """Text columns all of whose cells are numbers with the mark, as doubles."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)] if decimal != "." else []
    if not texts:
        return df
    number = rf"^\s*[+-]?(\d+({re.escape(decimal)}\d*)?|{re.escape(decimal)}\d+)([eE][+-]?\d+)?\s*$"
    all_numbers = df.agg(*[F.bool_and(qcol(c).rlike(number)).alias(f"c{i}") for i, c in enumerate(texts)]).first()
    doubles = {c for i, c in enumerate(texts) if all_numbers[f"c{i}"]}
    return df.select([parse_decimal_mark(qcol(c), decimal).alias(c) if c in doubles else qcol(c) for c in df.columns])


def read_parts(spark: SparkSession, paths, schemas=None, sep: str = ",",
               decimal: str = ".") -> DataFrame:
    """All part files of one or more exports as one table, by column name.

    Each path is a directory of parts (or a single file); parts of different
    exports, or of one directory, may have different headers: each group of
    files with one header is read alone, missing columns become NULL, and
    columns that groups hold in different types get their common type. A
    declared column that none of a directory's headers has raises.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    schemas = schemas if isinstance(schemas, (list, tuple)) else [schemas] * len(paths)
    frames = []
    for path, schema in zip(paths, schemas):
        if isinstance(schema, str):
            schema = StructType.fromDDL(schema)
        groups = header_groups(spark, path)
        if len(groups) == 1:
            frames.append(_read_like(spark, path, schema, sep, decimal, groups[0][1]))
        else:
            frames.append(_mixed_headers(spark, path, groups, schema, sep, decimal))
    return union_parts(*frames)


def _mixed_headers(spark: SparkSession, path: str, groups, schema: StructType | None, sep: str, decimal: str) -> DataFrame:
    opts = text_options(sep, write=False)
    fixed = re.split(r"[*?\[{]", path)[0]
    base = fixed if fixed == path else fixed.rsplit("/", 1)[0]
    frames, known = [], set()
    for files, breaks in groups:
        if schema is None:
            frames.append(_read_like(spark, files, None, sep, decimal, breaks, base))
            continue
        header = spark.read.options(**opts).option("basePath", base).csv(files[:1]).columns
        present = [f for f in schema.fields if f.name in header]
        known |= {f.name for f in present}
        # a group without any declared column has rows all the same
        part = StructType(present or [StructField(header[0], StringType())])
        df = _read_like(spark, files, part, sep, decimal, breaks, base)
        frames.append(df.select([qcol(f.name) if f in present else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]))
    absent = [] if schema is None else [f.name for f in schema.fields if f.name not in known]
    if absent:
        raise ValueError(f"no CSV header under {path} has a column {', '.join(absent)}")
    return union_parts(*frames)


def read_ordered(spark: SparkSession, path, schema: StructType | str | None = None, sep: str = ",", decimal: str = ".",
                 name: str = "rn") -> DataFrame:
    """A written export with the 1-based place of each row in its parts, taken in the order of their names."""
    return with_file_position(read_csv(spark, path, schema, sep, decimal), name)
