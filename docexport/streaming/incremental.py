"""Incremental export: the export plan over a stream of document files.

New files landing under a source folder are filtered, projected, flattened
and rounded exactly as a batch export does, duplicates (the same ``_id`` and
fields seen again) are dropped, and the rows are appended as CSV parts.
Progress lives in the checkpoint folder, so a restarted or failed job resumes
without loss or repeats.

No row is late: the state holds the keys of all rows written so far, whatever
their times, so it grows with the export. It is kept by RocksDB, on the
executors' disks and in the checkpoint folder, not in their heaps, unless the
session names another state store.

A stream has no global order: parts are in arrival order, not time order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.fmt import round_floats
from ..operators.predicate import select_documents
from ..operators.project import field_columns, qcol, rename_columns
from ..sinks.csv import prepare_csv, text_options
from ..spec import ExportSpec

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
HEAP_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
DISK_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_frame(docs: DataFrame, spec: ExportSpec, id_col: str = "_id") -> DataFrame:
    """The export rows of a streaming frame of documents (no order)."""
    rows = select_documents(docs, spec.predicate, spec.time_field, spec.start, spec.end, spec.zone)
    cols = field_columns(rows, spec.fields, spec.metadata, id_col=id_col, falsy=spec.falsy,
                         drop_parents=spec.falsy == "null")
    projected = round_floats(rows.select(cols), spec.rounding)
    keys = [c for c in ([id_col] if id_col in projected.columns else []) + list(spec.columns)]
    deduped = projected.dropDuplicates(keys if spec.dedup == "id" else list(spec.columns))
    drop = {id_col} if id_col not in spec.columns else set()
    out = deduped.select([qcol(c) for c in deduped.columns if c not in drop])
    return rename_columns(out, spec.rename)


def export_stream(spark: SparkSession, source: str, schema, spec: ExportSpec, path: str,
                  checkpoint: str, fmt: str = "parquet", id_field: str | None = None,
                  watermark: str | None = None, available_now: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the incremental export of files under ``source`` into CSV parts at ``path``.

    ``watermark`` is taken for earlier callers and has no effect: no row is dropped for its time.
    """
    if spark.conf.get(STATE_STORE, HEAP_STORE) == HEAP_STORE:
        spark.conf.set(STATE_STORE, DISK_STORE)
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    docs = reader.load(source)
    if id_field is not None:
        docs = docs.withColumn("_id", qcol(id_field))
    rows = prepare_csv(stream_frame(docs, spec), rounding=spec.rounding,
                       decimal=spec.decimal)
    writer = (rows.writeStream.format("csv").options(**text_options(spec.sep))
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if spec.max_rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", int(spec.max_rows_per_file))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start(path)
