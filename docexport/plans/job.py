"""End-to-end jobs: export, aggregate only, export then aggregate.

Each job is one lazy plan ending in a sink:

    scan -> filter (predicate AND time range, pushed to the scan)
         -> project (_id, metadata, flattened fields) -> round
         -> dedup (hash aggregate) -> global sort (time, _id)
         -> drop helpers -> rename -> CSV parts

The aggregation reads the export's distinct rows under their original names
(values already rounded), or raw CSVs, and writes one small CSV or parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from ..functions.fmt import round_floats
from ..functions.timefn import order_key as instant_key
from ..operators.aggregate import aggregate
from ..operators.dedup import dedup_by_fields, dedup_by_id
from ..operators.predicate import select_documents, time_column
from ..operators.project import field_columns, qcol, rename_columns
from ..operators.slices import assign_slices, slice_plan
from ..session import scratch_table
from ..sinks.csv import write_csv, write_single_csv
from ..sources.readers import read_parts
from ..spec import AggSpec, ExportSpec

_T = "__t"
SLICE_COL = "slice_id"


def _selected(docs: DataFrame, spec: ExportSpec) -> DataFrame:
    return select_documents(docs, spec.predicate, spec.time_field, spec.start, spec.end, spec.zone)


def _order_key(docs: DataFrame, spec: ExportSpec) -> str | None:
    """The column the export is ordered by: the exported time, or a helper where it is not exported as it is."""
    if spec.time_field is None or not spec.order:
        return None
    exported = spec.time_field in spec.columns and spec.time_field in docs.columns
    return spec.time_field if exported and not isinstance(docs.schema[spec.time_field].dataType, StringType) else _T


def export_rows(docs: DataFrame, spec: ExportSpec, id_col: str = "_id") -> DataFrame:
    """The distinct rows of an export, not yet in order, with their helper columns (``_id``, the order key)."""
    rows = _selected(docs, spec)
    cols = field_columns(rows, spec.fields, spec.metadata, id_col=id_col, falsy=spec.falsy,
                         drop_parents=spec.falsy == "null")
    order_key = _order_key(docs, spec)
    if order_key == _T:
        time, dtype = time_column(rows, spec.time_field)
        cols.append(instant_key(time, dtype).alias(_T))
    projected = round_floats(rows.select(cols), spec.rounding)
    exported = list(spec.columns)
    if spec.dedup == "fields":
        order = [c for c in (order_key, id_col) if c is not None and c in projected.columns]
        return dedup_by_fields(projected, exported, order)
    if id_col in projected.columns:
        return dedup_by_id(projected, exported + ([_T] if _T in projected.columns else []), id_col)
    return projected  # without ids, equal rows may be different documents


def order_rows(rows: DataFrame, docs: DataFrame, spec: ExportSpec, id_col: str = "_id",
               keep_names: bool = False) -> DataFrame:
    """The rows of :func:`export_rows` in the order and under the names in which they are written."""
    order_key = _order_key(docs, spec)
    out = rows
    keys = []
    if spec.slices is not None:
        # The slice id grows with time, so ordering by it first keeps the time
        # order and lets the partitioned writer use the order as it is.
        slice_time = order_key or _T
        if slice_time not in out.columns:
            raise ValueError("slices need the time field in the export")
        # The plan reads only the time column of the matching documents.
        plan = slice_plan(_selected(docs, spec), spec.time_field, spec.slices)
        out = assign_slices(out, slice_time, spec.slices, plan=plan)
        keys.append(F.col(SLICE_COL))
    if order_key is not None:
        keys.append(F.asc_nulls_last(qcol(order_key)))
        if id_col in rows.columns and id_col != order_key:
            keys.append(F.asc_nulls_last(qcol(id_col)))
    if keys:
        out = out.orderBy(*keys)
    drop = [_T] + ([id_col] if id_col not in spec.columns else [])
    out = out.select([qcol(c) for c in out.columns if c not in drop])
    return out if keep_names else rename_columns(out, spec.rename)


def export_frame(docs: DataFrame, spec: ExportSpec, id_col: str = "_id",
                 keep_names: bool = False) -> DataFrame:
    """The rows an export writes, as a lazy DataFrame.

    ``docs`` holds ``_id``, the metadata columns and the document body
    (top-level columns, possibly nested). With ``keep_names`` the columns
    keep their original names (the aggregation reads that form).
    """
    return order_rows(export_rows(docs, spec, id_col), docs, spec, id_col, keep_names)


def _write_export(frame: DataFrame, spec: ExportSpec, path: str) -> str:
    if spec.single_file:
        return write_single_csv(frame, path, sep=spec.sep, decimal=spec.decimal,
                                rounding=spec.rounding, keep_parts=spec.keep_parts,
                                max_rows_per_file=spec.max_rows_per_file, overwrite=spec.overwrite,
                                bool_text=spec.bool_text)
    return write_csv(frame, path, sep=spec.sep, decimal=spec.decimal, rounding=spec.rounding,
                     max_rows_per_file=spec.max_rows_per_file, overwrite=spec.overwrite,
                     partition_by=[SLICE_COL] if spec.slices is not None else None,
                     bool_text=spec.bool_text)


def export(docs: DataFrame, spec: ExportSpec, path: str) -> str:
    """Write the export CSV: a folder of part files, or one file with ``single_file``."""
    return _write_export(export_frame(docs, spec), spec, path)


def aggregate_frame(frame: DataFrame, agg: AggSpec, rename: dict[str, str] | None = None) -> DataFrame:
    result = aggregate(frame, agg)
    return rename_columns(result, rename or {})


def _write_aggregate(result: DataFrame, path: str, agg: AggSpec, sep: str, decimal: str, overwrite: bool, parts: bool,
                     bool_text: tuple[str, str] | None = None) -> None:
    """One file for a small result, or parts in the order of the keys written by many tasks."""
    write = write_csv if parts else write_single_csv
    write(result, path, sep=sep, decimal=decimal, rounding=agg.rounding, overwrite=overwrite, bool_text=bool_text)


def export_and_aggregate(docs: DataFrame, spec: ExportSpec, agg: AggSpec, path: str,
                         agg_path: str, agg_parts: bool = False) -> tuple[str, str]:
    """Export, then aggregate the same rows (under their original names).

    The distinct rows are written once, unordered, to the shared scratch
    folder: the scan, filter and dedup run a single time, the export sorts that
    copy and the aggregation reads only its columns of it, in no order. A lost
    executor costs tasks that read the copy. The copy is deleted at the end.
    ``agg_parts`` writes the aggregate as a folder of parts, by many tasks.
    """
    with scratch_table(export_rows(docs, spec), "export-rows") as rows:
        _write_export(order_rows(rows, docs, spec), spec, path)
        exported = rows.select([qcol(c) for c in spec.columns])
        _write_aggregate(aggregate_frame(exported, agg, spec.rename), agg_path, agg, spec.sep, spec.decimal,
                         spec.overwrite, agg_parts, spec.bool_text)
    return path, agg_path


def aggregate_only(spark: SparkSession, raw_csv, agg: AggSpec, agg_path: str,
                   schema=None, sep: str = ",", decimal: str = ".",
                   rename: dict[str, str] | None = None, overwrite: bool = False, agg_parts: bool = False) -> str:
    """Aggregate raw CSVs written earlier (or by any tool) and write the result.

    ``raw_csv`` is a file, a folder of parts or a list of them; their headers
    may differ.
    """
    frame = read_parts(spark, raw_csv, schema, sep, decimal)
    _write_aggregate(aggregate_frame(frame, agg, rename), agg_path, agg, sep, decimal, overwrite, agg_parts)
    return agg_path
