"""What CSV files hold before they are parsed: headers, line breaks, and places of rows.

An export's manifest tells it; other files are read once as plain lines, which
Spark splits however big a file is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from ..session import write_scratch
from ..sinks.manifest import read_manifest


def index_files(spark: SparkSession, path) -> DataFrame:
    """``path, header, lines, breaks`` of every file that is not empty.

    ``header`` is the file's first line. A cell with a line break leaves an odd
    number of quotes on the line on which it opens; files without such lines
    hold one row on every line.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("at"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.groupBy("path").agg(F.min_by("value", F.struct("block", "at")).alias("header"), F.count("*").alias("lines"),
                                     F.max(quotes % 2 == 1).alias("breaks"))


def has_breaks(spark: SparkSession, path) -> bool:
    """Whether any cell of the files may hold a line break."""
    manifest = read_manifest(spark, path)
    if manifest is not None:
        return manifest["breaks"]
    return bool(index_files(spark, path).agg(F.max("breaks")).first()[0])


def header_groups(spark: SparkSession, path) -> list[tuple[list[str] | None, bool]]:
    """(files, breaks) of the groups of files with one header; files None: all that the path names."""
    manifest = read_manifest(spark, path)
    if manifest is not None:
        return [(None, manifest["breaks"])]
    index = index_files(spark, path).select("path", "header", "breaks").collect()  # a row for each file
    headers = {r["header"] for r in index}
    if len(headers) <= 1:
        return [(None, any(r["breaks"] for r in index))]
    keys = sorted({(r["header"], r["breaks"]) for r in index})
    return [(sorted(r["path"] for r in index if (r["header"], r["breaks"]) == key), key[1]) for key in keys]


def with_file_position(rows: DataFrame, name: str = "rn") -> DataFrame:
    """Add the 1-based place of each row of a CSV frame over all its files in the order of their names (T1 made visible).

    The rows are written once with their place inside the split they came from;
    an index of the splits (one row each: file, start, rows) gives the offsets.
    """
    placed, _ = write_scratch(rows.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"),
                                          F.monotonically_increasing_id().alias("__at")), "placed")
    splits = placed.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = F.sum("__n").over(Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("__file", "__block", "__first", F.coalesce(before, F.lit(0)).alias("__before"))
    return (placed.join(splits, ["__file", "__block"])
            .select(*rows.columns, (F.col("__before") + F.col("__at") - F.col("__first") + 1).alias(name)))
