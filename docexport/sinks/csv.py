"""CSV sinks: raw export and aggregated table (K1-K4).

Options that make the text faithful on a round trip:
- timestamps written and read with microseconds (the defaults cut to ms);
- cells never trimmed (the defaults trim leading/trailing blanks);
- quotes doubled inside quoted cells (RFC 4180), multi-line cells allowed;
- an empty string written as an empty cell (it reads back as NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType

from ..functions.fmt import decimal_mark, round_floats
from ..operators.project import cells_as_text, qcol
from ..session import scratch_table
from .manifest import observed, write_manifest

# Text formats of timestamps in every CSV/JSON file this package
# writes or reads.
TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def text_options(sep: str = ",", write: bool = True) -> dict[str, str]:
    """CSV options; the microsecond timestamp formats are for writing only.

    Reading uses Spark's default ISO-8601 parsing, which keeps microseconds
    and accepts any fraction length and zone offset (a fixed read pattern
    would turn other spellings into NULL).
    """
    opts = {
        "header": "true",
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "multiLine": "true",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "timestampNTZFormat": TIMESTAMP_NTZ_FORMAT,
        "timestampFormat": TIMESTAMP_FORMAT,
        "nullValue": "",
        "emptyValue": "",
    }
    if not write:
        del opts["timestampNTZFormat"], opts["timestampFormat"]
    return opts


def prepare_csv(df: DataFrame, columns=None, rounding: int | None = 2,
                decimal: str = ".", bool_text: tuple[str, str] | None = None) -> DataFrame:
    """Chosen columns in order, floats rounded, objects as JSON, decimal mark set.

    ``bool_text`` spells booleans, e.g. ``("True", "False")`` as pandas does;
    by default Spark writes ``true``/``false``.
    """
    if columns is not None:
        df = df.select([qcol(c) for c in columns])
    df = cells_as_text(round_floats(df, rounding))
    if decimal != "." or bool_text is not None:
        cols = []
        for f in df.schema.fields:
            c = qcol(f.name)
            if decimal != "." and isinstance(f.dataType, (DoubleType, FloatType)):
                c = decimal_mark(c, decimal)
            elif bool_text is not None and isinstance(f.dataType, BooleanType):
                c = F.when(c, F.lit(bool_text[0])).when(~c, F.lit(bool_text[1]))
            cols.append(c.alias(f.name))
        df = df.select(cols)
    return df


def write_csv(df: DataFrame, path: str, columns=None, sep: str = ",", decimal: str = ".",
              rounding: int | None = 2, max_rows_per_file: int | None = None,
              single_file: bool = False, overwrite: bool = False,
              partition_by: list[str] | None = None,
              bool_text: tuple[str, str] | None = None) -> str:
    """Write ``df`` as CSV part files under ``path`` (K1, K2, K3, K4).

    Part files hold at most ``max_rows_per_file`` rows. ``single_file``
    funnels the rows through one task (for small results such as an
    aggregate); otherwise every task writes its own parts. ``partition_by``
    writes one folder per value. An existing ``path`` is an error unless
    ``overwrite``. A manifest beside the parts tells readers the columns and
    whether files may be split.
    """
    _check_marks(sep, decimal)
    out = prepare_csv(df, columns, rounding, decimal, bool_text)
    if single_file:
        out = out.coalesce(1)
    _write_parts(out, path, sep, max_rows_per_file, overwrite, partition_by)
    return path


def _check_marks(sep: str, decimal: str) -> None:
    if sep == decimal:
        raise ValueError("separator and decimal mark must differ")


def _write_parts(out: DataFrame, path: str, sep: str, max_rows_per_file: int | None, overwrite: bool,
                 partition_by: list[str] | None = None) -> None:
    """Prepared cells into parts, with their manifest."""
    columns = [c for c in out.columns if c not in (partition_by or [])]
    out, seen = observed(out)
    writer = out.write.mode("overwrite" if overwrite else "errorifexists").options(**text_options(sep))
    if max_rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", int(max_rows_per_file))
    if partition_by:
        writer = writer.partitionBy(*partition_by)  # one folder per value, e.g. per slice
    writer.csv(path)
    write_manifest(out.sparkSession, path, columns, seen.get)


def write_single_csv(df: DataFrame, path: str, columns=None, sep: str = ",", decimal: str = ".",
                     rounding: int | None = 2, keep_parts: bool = False,
                     max_rows_per_file: int | None = None, overwrite: bool = False,
                     bool_text: tuple[str, str] | None = None) -> str:
    """Write ``df`` as one CSV file at ``path`` (for results small enough for one task).

    The rows go through a single task into a staging folder next to
    ``path`` and the one part is then renamed to ``path``. With
    ``keep_parts`` the rows are first written in parallel as bounded parts
    (kept in ``path + ".parts"``); both outputs are made from one written copy,
    so the upstream plan runs only once. A file that an overwrite set aside
    (``path + ".old"``) before it was cut off is put back or cleared away.
    """
    _check_marks(sep, decimal)
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    old = jvm.org.apache.hadoop.fs.Path(path + ".old")
    fs = target.getFileSystem(hconf)
    if fs.exists(old):
        if fs.exists(target):
            fs.delete(old, True)
        elif not fs.rename(old, target):
            raise RuntimeError(f"{path}.old is what an earlier overwrite left of {path}; it could not be put back")
    if fs.exists(target):
        if not overwrite:
            raise FileExistsError(f"{path} exists (pass overwrite=True to replace it)")
    out = prepare_csv(df, columns, rounding, decimal, bool_text)
    staging = path + ".staging"
    if keep_parts:
        placed = out.withColumn("__at", F.monotonically_increasing_id())
        with scratch_table(placed, "single-csv") as copy:
            ordered = copy.orderBy("__at").drop("__at")  # as the rows came
            _write_parts(ordered, path + ".parts", sep, max_rows_per_file, overwrite)
            _write_parts(ordered.coalesce(1), staging, sep, 0, True)
    else:
        # coalesce keeps partition order, so a sorted frame stays sorted
        # 0: one file, whatever maxRecordsPerFile the session sets
        _write_parts(out.coalesce(1), staging, sep, 0, True)
    staged = part_files(spark, staging)
    if len(staged) != 1:
        raise RuntimeError(f"{staging} holds {len(staged)} part files, not one; {path} is unchanged")
    held = fs.exists(target)
    if held and not fs.rename(target, old):
        raise RuntimeError(f"{path} could not be set aside; the new file is {staged[0]}")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staged[0]), target):
        if held:
            fs.rename(old, target)
        raise RuntimeError(f"{staged[0]} could not be renamed to {path}")
    if held:
        fs.delete(old, True)
    fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)
    return path


def part_files(spark, path: str) -> list[str]:
    """Names of the CSV part files under ``path``, in name (= partition) order."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
             .load(path).select("path"))
    return sorted(r.path for r in files.collect())
