"""Command line for ``spark-submit``: export, aggregate, or cut slices.

    spark-submit docexport/plans/cli.py export --source 'logs-*' --format json \\
        --schema schema.ddl --id-field uid --fields a,b.c --time-field ts \\
        --start 2024-01-01T00:00:00 --end 2024-01-31T23:59:59 --zone Europe/Rome \\
        --out /data/out/export.csv --single-file \\
        --agg-keys b.c --agg-types a--sum --agg-time-field ts --agg-days 7 \\
        --agg-out /data/out/aggregated.csv

    spark-submit docexport/plans/cli.py aggregate --raw-input export.csv \\
        --raw-schema 'a double, b string, ts timestamp' --agg-keys b --agg-out agg.csv

    spark-submit docexport/plans/cli.py slices --source events --time-field ts \\
        --slices 8 --step 1d --out slices.csv

Options map one to one onto ``ExportSpec``, ``AggSpec`` and ``SliceSpec``;
every check runs before the first Spark job.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from docexport.operators.predicate import select_documents  # noqa: E402
from docexport.operators.slices import slice_table  # noqa: E402
from docexport.plans.job import aggregate_only, export, export_and_aggregate  # noqa: E402
from docexport.session import build_session  # noqa: E402
from docexport.sinks.csv import write_single_csv  # noqa: E402
from docexport.sources.readers import scan  # noqa: E402
from docexport.spec import AggSpec, ExportSpec, SliceSpec, parse_couples, parse_instant  # noqa: E402


def _source_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--source", required=True, help="path, glob, or comma list of paths")
    p.add_argument("--format", default="parquet", help="any Spark source format")
    p.add_argument("--schema", help="DDL schema text or a file holding it")
    p.add_argument("--id-field", help="column that plays _id")
    p.add_argument("--option", action="append", default=[], help="reader option key=value")


def _agg_args(p: argparse.ArgumentParser) -> None:
    p.add_argument("--agg-keys", help="grouping fields, comma separated")
    p.add_argument("--agg-types", help="field--function couples (sum count max min mean)")
    p.add_argument("--agg-names", help="field--name couples for result columns")
    p.add_argument("--bool-columns", help="fields whose true values are counted as 1")
    p.add_argument("--agg-time-field", help="time field for calendar buckets")
    p.add_argument("--agg-days", type=int, default=1, help="bucket width in days")
    p.add_argument("--agg-out", help="path of the aggregated CSV")
    p.add_argument("--agg-parts", action="store_true", help="write the aggregate as a folder of parts")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="docexport")
    ap.add_argument("--master", help="Spark master (default: from spark-submit)")
    sub = ap.add_subparsers(dest="command", required=True)

    ex = sub.add_parser("export", help="export documents, optionally aggregate them")
    _source_args(ex)
    ex.add_argument("--fields", required=True)
    ex.add_argument("--metadata", default="")
    ex.add_argument("--query", help="SQL predicate over the documents")
    ex.add_argument("--time-field")
    ex.add_argument("--start")
    ex.add_argument("--end")
    ex.add_argument("--zone", default="UTC")
    ex.add_argument("--dedup-fields", action="store_true", help="dedup on fields, not _id")
    ex.add_argument("--rename", default="", help="field--new couples")
    ex.add_argument("--rounding", type=int, default=2)
    ex.add_argument("--sep", default=",")
    ex.add_argument("--decimal", default=".")
    ex.add_argument("--max-rows-per-file", type=int, default=10_000_000)
    ex.add_argument("--single-file", action="store_true")
    ex.add_argument("--keep-parts", action="store_true")
    ex.add_argument("--overwrite", action="store_true")
    ex.add_argument("--falsy-null", action="store_true", help="flattened falsy leaves -> empty")
    ex.add_argument("--slices", type=int, help="write one folder of parts per time slice")
    ex.add_argument("--step", help="load-balance step for --slices, such as 1d")
    ex.add_argument("--allow-short", action="store_true")
    ex.add_argument("--title-bools", action="store_true", help="write True/False, not true/false")
    ex.add_argument("--out", required=True)
    _agg_args(ex)

    ag = sub.add_parser("aggregate", help="aggregate a raw CSV")
    ag.add_argument("--raw-input", required=True, help="raw CSV files or folders of parts, comma separated")
    ag.add_argument("--raw-schema", help="DDL schema of the raw CSV (default: inferred)")
    ag.add_argument("--sep", default=",")
    ag.add_argument("--decimal", default=".")
    ag.add_argument("--zone", default="UTC")
    ag.add_argument("--rounding", type=int, default=2)
    ag.add_argument("--rename", default="")
    ag.add_argument("--overwrite", action="store_true")
    _agg_args(ag)

    sl = sub.add_parser("slices", help="cut the time range into slices")
    _source_args(sl)
    sl.add_argument("--time-field", required=True)
    sl.add_argument("--query", help="SQL predicate over the documents")
    sl.add_argument("--start")
    sl.add_argument("--end")
    sl.add_argument("--zone", default="UTC", help="zone of bounds without an offset")
    sl.add_argument("--slices", type=int, required=True)
    sl.add_argument("--step", help="load-balance step such as 1d; none = equal widths")
    sl.add_argument("--allow-short", action="store_true")
    sl.add_argument("--out", required=True)
    sl.add_argument("--overwrite", action="store_true")
    return ap


def _schema(text: str | None) -> str | None:
    if text and os.path.exists(text):
        with open(text) as fh:
            return fh.read().strip()
    return text


def _docs(spark, args):
    sources = [s for s in args.source.split(",") if s]
    opts = dict(o.split("=", 1) for o in args.option)
    return scan(spark, sources if len(sources) > 1 else sources[0], fmt=args.format,
                id_field=args.id_field, schema=_schema(args.schema), options=opts)


def _agg_spec(args) -> AggSpec:
    return AggSpec(keys=args.agg_keys, functions=args.agg_types or {},
                   names=args.agg_names or {}, bool_columns=args.bool_columns,
                   time_field=args.agg_time_field, days=args.agg_days, zone=args.zone,
                   rounding=args.rounding)


def main(argv=None) -> int:
    args = parser().parse_args(argv)
    if args.command == "export":
        spec = ExportSpec(fields=args.fields, metadata=args.metadata, time_field=args.time_field,
                          start=args.start, end=args.end, zone=args.zone, predicate=args.query,
                          dedup="fields" if args.dedup_fields else "id",
                          rename=parse_couples(args.rename), rounding=args.rounding,
                          sep=args.sep, decimal=args.decimal,
                          max_rows_per_file=args.max_rows_per_file, single_file=args.single_file,
                          keep_parts=args.keep_parts, overwrite=args.overwrite,
                          falsy="null" if args.falsy_null else "keep",
                          slices=SliceSpec(n=args.slices, step=args.step,
                                           allow_short=args.allow_short) if args.slices else None,
                          bool_text=("True", "False") if args.title_bools else None)
        agg = _agg_spec(args) if (args.agg_keys or args.agg_time_field) else None
        if agg is not None and not args.agg_out:
            raise SystemExit("--agg-out is needed with aggregation options")
    elif args.command == "aggregate":
        agg = _agg_spec(args)
        if not args.agg_out:
            raise SystemExit("--agg-out is needed")
    else:
        slices = SliceSpec(n=args.slices, step=args.step, allow_short=args.allow_short)
        for bound in (args.start, args.end):
            if bound is not None:
                parse_instant(bound, args.zone)

    spark = build_session(args.master, app=f"docexport-{args.command}")
    if args.command == "export":
        docs = _docs(spark, args)
        if agg is None:
            export(docs, spec, args.out)
        else:
            export_and_aggregate(docs, spec, agg, args.out, args.agg_out, agg_parts=args.agg_parts)
    elif args.command == "aggregate":
        raw = [p for p in args.raw_input.split(",") if p]
        aggregate_only(spark, raw, agg, args.agg_out, schema=_schema(args.raw_schema),
                       sep=args.sep, decimal=args.decimal, rename=parse_couples(args.rename),
                       overwrite=args.overwrite, agg_parts=args.agg_parts)
    else:
        docs = select_documents(_docs(spark, args), args.query, args.time_field, args.start, args.end, args.zone)
        table = slice_table(docs, args.time_field, slices)
        write_single_csv(table, args.out, overwrite=args.overwrite)
    return 0


if __name__ == "__main__":
    sys.exit(main())
