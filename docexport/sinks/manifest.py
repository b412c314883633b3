"""A manifest beside a CSV export: what a reader must know before it opens a part.

It is one small JSON file in the export's folder with the column names, the
number of rows, whether any cell holds a line break (if none does, files may be
split) and the names of the parts it speaks for. What it says is observed while
the parts are written, without another pass.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType

from ..operators.project import qcol

#: Spark's readers pass over names that begin with an underscore.
NAME = "_manifest.json"


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df``, and what its write will have counted."""
    texts = [qcol(f.name) for f in df.schema.fields if isinstance(f.dataType, StringType)]
    broken = [F.contains(c, F.lit(mark)) for c in texts for mark in ("\n", "\r")]
    found = F.max(F.coalesce(reduce(lambda a, b: a | b, broken), F.lit(False))) if broken else F.max(F.lit(False))
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), found.alias("breaks")), seen


def _file(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, path: str) -> list[str]:
    return sorted(f.rsplit("/", 1)[-1] for f in spark.read.text(path).inputFiles())


def write_manifest(spark: SparkSession, path: str, columns: list[str], seen: dict) -> None:
    body = {"columns": columns, "rows": seen.get("rows", 0) or 0,
            "breaks": bool(seen.get("breaks")) or any(m in c for c in columns for m in "\n\r"), "parts": _names(spark, path)}
    fs, target = _file(spark, f"{path}/{NAME}")
    out = fs.create(target, True)
    try:
        out.write(json.dumps(body).encode())
    finally:
        out.close()


def read_manifest(spark: SparkSession, path) -> dict | None:
    """The manifest of a folder, or None: where there is none, or where it doesn't speak for just the files that are there."""
    if not isinstance(path, str):
        return None
    fs, target = _file(spark, f"{path}/{NAME}")
    if any(ch in path for ch in "*?[{") or not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        body = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return body if body["parts"] == _names(spark, path) else None
