"""Registered queries over the test tables, each with an equivalent DuckDB SQL form.

Every query reads whole tables (``events`` plays the document index: ``_id``
is ``event_id``, the time field is ``ts``). Each callable takes
``(spark, sf_dir)`` and returns a lazy DataFrame; a few write files first
(CSV and JSON round trips) into the session's shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.fmt import keyword_match, round_floats, word_match
from ..operators.aggregate import aggregate, count_rows
from ..operators.dedup import dedup_by_fields, union_parts
from ..operators.order import first_last, time_bounds, top_n
from ..operators.predicate import select_documents
from ..operators.project import select_fields
from ..operators.slices import assign_slices, slice_table
from ..session import scratch_path
from ..sinks.csv import write_csv
from ..sources.readers import read_csv, read_hits_json, read_ordered, read_parts, scan, write_hits_json
from ..spec import AggSpec, ExportSpec, SliceSpec
from ..streaming.incremental import export_stream
from .job import aggregate_only, export, export_and_aggregate, export_frame

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def events_docs(spark: SparkSession, d: str) -> DataFrame:
    return scan(spark, f"{d}/events.parquet", id_field="event_id")


def orders_docs(spark: SparkSession, d: str) -> DataFrame:
    return scan(spark, f"{d}/orders.parquet", id_field="o_orderkey")


def r2(expr: str) -> str:
    """DuckDB form of rounding to 2 places, half to even."""
    return f"round_even({expr}, 2)"


def dsum(expr: str) -> str:
    """DuckDB form of the exact sum of values with 2 decimals, as double."""
    return f"CAST(sum(CAST({expr} AS DECIMAL(28,2))) AS DOUBLE)"


def dmean(expr: str) -> str:
    return f"round_even(CAST(sum(CAST({expr} AS DECIMAL(28,2))) AS DOUBLE) / count({expr}), 2)"


_K_TEXT = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


# ---------------------------------------------------------------- flagship

@register("events_daily_by_type", f"""
WITH f AS (
  SELECT DISTINCT event_id, ts, event_type, {r2('value')} AS value FROM events
  WHERE ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-31 23:59:59')
SELECT CAST(ts AS DATE) AS ts, event_type, count(event_id) AS agg__event_id__count,
       COALESCE({dsum('value')}, 0.0) AS agg__value__sum
FROM f WHERE event_type IS NOT NULL GROUP BY 1, 2
""")
def events_daily_by_type(spark, d):
    """Export January 2024 of the events index, then daily counts and sums per type."""
    spec = ExportSpec(fields=["event_id", "ts", "event_type", "value"], time_field="ts",
                      start="2024-01-01T00:00:00", end="2024-01-31T23:59:59", zone="UTC")
    frame = export_frame(events_docs(spark, d), spec, keep_names=True)
    agg = AggSpec(keys=["event_type"], functions={"event_id": "count", "value": "sum"},
                  time_field="ts", days=1)
    return aggregate(frame, agg)


# ------------------------------------------------------------ S1 P1 P2 F3

@register("scan_fields", """
SELECT ts, user_id, event_type, value, CAST(NULL AS VARCHAR) AS country FROM events
""")
def scan_fields(spark, d):
    docs = events_docs(spark, d)
    return select_fields(docs, ["ts", "user_id", "event_type", "value", "country"], id_col=None)


@register("scan_wildcard", """
SELECT 'events' AS _index, event_id AS _id, ts, event_type FROM events
""")
def scan_wildcard(spark, d):
    """An index pattern: ``_index`` is the name the wildcard matched."""
    docs = scan(spark, f"{d}/ev*.parquet", id_field="event_id")
    return select_fields(docs, ["ts", "event_type"], metadata=["_index", "_id"])


@register("scan_indices", f"""
SELECT 'events' AS _index, event_id AS _id, ts, {r2('value')} AS value,
       CAST(NULL AS TIMESTAMP) AS o_orderdate, CAST(NULL AS DOUBLE) AS o_totalprice
FROM events
UNION ALL
SELECT 'orders', o_orderkey, NULL, NULL, o_orderdate, {r2('o_totalprice')} FROM orders
""")
def scan_indices(spark, d):
    """Two indices with different fields, united by name; dedup on (_index, _id, fields)."""
    docs = scan(spark, {"events": f"{d}/events.parquet", "orders": f"{d}/orders.parquet"},
                id_field={"events": "event_id", "orders": "o_orderkey"})
    spec = ExportSpec(fields=["ts", "value", "o_orderdate", "o_totalprice"],
                      metadata=["_index", "_id"])
    return export_frame(docs, spec)


@register("metadata_columns", """
SELECT 'events' AS _index, event_id AS _id, ts, event_type, value FROM events
""")
def metadata_columns(spark, d):
    docs = events_docs(spark, d)
    return select_fields(docs, ["ts", "event_type", "value"], metadata=["_index", "_id"])


@register("hits_from_json", """
SELECT 'events' AS _index, '_doc' AS _type, CAST(event_id AS VARCHAR) AS _id,
       CAST(1.0 AS DOUBLE) AS _score, ts, user_id, event_type, value, props
FROM events
""")
def hits_from_json(spark, d):
    events = table(spark, d, "events")
    path = scratch_path(spark, "hits")
    write_hits_json(events, path, id_field="event_id", index="events")
    lifted = read_hits_json(spark, path, events.schema)
    return lifted.select("_index", "_type", "_id", "_score", "ts", "user_id", "event_type",
                         "value", "props")


@register("hits_export", f"""
SELECT 'events' AS _index, CAST(event_id AS VARCHAR) AS _id, ts, {_K_TEXT} AS "props.k",
       event_type, {r2('value')} AS value
FROM events WHERE ts IS NOT NULL
""")
def hits_export(spark, d):
    """The whole export over hit-shaped JSON with a nested body: flatten, dedup, order."""
    events = table(spark, d, "events").withColumn("props", F.from_json("props", "k bigint"))
    path = scratch_path(spark, "hits-nested")
    write_hits_json(events, path, id_field="event_id", index="events")
    hits = read_hits_json(spark, path, events.schema, metadata=["_index", "_id"])
    spec = ExportSpec(fields=["ts", "props.k", "event_type", "value"], metadata=["_index", "_id"],
                      time_field="ts")
    return export_frame(hits, spec)


# ------------------------------------------------------------ P3 flattening

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def _events_with_body(spark, d) -> DataFrame:
    return table(spark, d, "events").withColumn("props", F.from_json("props", "k bigint"))


@register("denest_struct", f"""
SELECT event_id, {_K} AS "props.k" FROM events
""")
def denest_struct(spark, d):
    return select_fields(_events_with_body(spark, d), ["event_id", "props.k"], id_col=None)


@register("denest_falsy_null", f"""
SELECT event_id, NULLIF({_K}, 0) AS "props.k" FROM events
""")
def denest_falsy_null(spark, d):
    return select_fields(_events_with_body(spark, d), ["event_id", "props.k"], id_col=None,
                         falsy="null")


@register("denest_dotted_key", f"""
SELECT event_id, COALESCE(CASE WHEN event_type = 'click' THEN {_K} END, user_id) AS "a.b",
       CAST(NULL AS VARCHAR) AS "a.b.c", CAST(NULL AS VARCHAR) AS "props.k.z"
FROM events
""")
def denest_dotted_key(spark, d):
    """A literal dotted key beside a nested object of the same path; paths through numbers."""
    body = _events_with_body(spark, d)
    body = body.select(
        "event_id", "props",
        F.struct(F.when(F.col("event_type") == "click", F.col("props.k")).alias("b")).alias("a"),
        F.col("user_id").alias("a.b"))
    return select_fields(body, ["event_id", "a.b", "a.b.c", "props.k.z"], id_col=None)


# ------------------------------------------------------------ P4 rename

@register("rename_fields", f"""
SELECT DISTINCT o_orderkey AS order_id, o_orderdate, o_orderstatus,
       {r2('o_totalprice')} AS total_price
FROM orders
""")
def rename_fields(spark, d):
    spec = ExportSpec(fields=["o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"],
                      time_field="o_orderdate",
                      rename="o_orderkey--order_id,o_totalprice--total_price,o_nothing--x,bad")
    return export_frame(orders_docs(spark, d), spec)


# ------------------------------------------------------------ F1 F2 F4 F5

@register("time_range", f"""
SELECT DISTINCT event_id, ts, event_type, {r2('value')} AS value FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'
""")
def time_range_q(spark, d):
    spec = ExportSpec(fields=["event_id", "ts", "event_type", "value"], time_field="ts",
                      start="2024-01-05T00:00:00", end="2024-01-12T00:00:00")
    return export_frame(events_docs(spark, d), spec)


@register("open_time_range", f"""
SELECT DISTINCT o_orderkey, o_orderdate, {r2('o_totalprice')} AS o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate IS NOT NULL
""")
def open_time_range(spark, d):
    spec = ExportSpec(fields=["o_orderkey", "o_orderdate", "o_totalprice"],
                      time_field="o_orderdate", start="1997-01-01T00:00:00")
    return export_frame(orders_docs(spark, d), spec)


@register("time_range_zone", f"""
SELECT DISTINCT event_id, ts, event_type, {r2('value')} AS value FROM events
WHERE ts BETWEEN timezone('UTC', timezone('Europe/Rome', TIMESTAMP '2024-01-05 00:00:00'))
             AND timezone('UTC', timezone('Europe/Rome', TIMESTAMP '2024-01-05 23:59:59.999999'))
""")
def time_range_zone(spark, d):
    spec = ExportSpec(fields=["event_id", "ts", "event_type", "value"], time_field="ts",
                      start="2024-01-05T00:00:00", end="2024-01-05T23:59:59.999999",
                      zone="Europe/Rome")
    return export_frame(events_docs(spark, d), spec)


@register("predicate_and", r"""
SELECT doc_id, lang, source, n_chars FROM documents
WHERE list_contains(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), 'the')
  AND lang = 'en'
""")
def predicate_and(spark, d):
    docs = scan(spark, f"{d}/documents.parquet", id_field="doc_id")
    spec = ExportSpec(fields=["doc_id", "lang", "source", "n_chars"],
                      predicate=word_match(F.col("text"), "the") & keyword_match(F.col("lang"), "en"),
                      order=False)
    return export_frame(docs, spec)


# ------------------------------------------------------------ T1 T2 T3

@register("sorted_export", f"""
SELECT o_orderkey, o_orderdate, o_custkey, {r2('o_totalprice')} AS o_totalprice,
       row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn
FROM orders
""")
def sorted_export(spark, d):
    """A sorted export, written; each row with its place in the parts taken in the order of their names."""
    spec = ExportSpec(fields=["o_orderkey", "o_orderdate", "o_custkey", "o_totalprice"],
                      time_field="o_orderdate", max_rows_per_file=4000)
    path = scratch_path(spark, "sorted")
    export(orders_docs(spark, d), spec, path)
    return read_ordered(spark, path, "o_orderkey long, o_orderdate timestamp_ntz, o_custkey long, o_totalprice double")


@register("time_bounds", """
SELECT min(ts) AS first_time, max(ts) AS last_time, count(ts) AS n_docs FROM events
""")
def time_bounds_q(spark, d):
    return time_bounds(events_docs(spark, d), "ts")


@register("first_last_doc", """
SELECT arg_min(event_id, ts) AS first_id, arg_max(event_id, ts) AS last_id,
       min(ts) AS first_time, max(ts) AS last_time
FROM events
""")
def first_last_doc(spark, d):
    return first_last(events_docs(spark, d), "ts", "_id")


_LINEITEM_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                   "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                   "l_linestatus"]


@register("top_n_by_time", f"""
SELECT * FROM lineitem ORDER BY {', '.join(_LINEITEM_ORDER)} LIMIT 100
""")
def top_n_by_time(spark, d):
    return top_n(table(spark, d, "lineitem"), _LINEITEM_ORDER, 100)


# ------------------------------------------------------------ A1 A3

@register("count_matching", """
SELECT count(*) AS n_docs FROM lineitem
WHERE l_returnflag = 'R'
  AND l_shipdate BETWEEN TIMESTAMP '1995-01-01 00:00:00' AND TIMESTAMP '1995-12-31 23:59:59'
""")
def count_matching(spark, d):
    rows = select_documents(table(spark, d, "lineitem"), "l_returnflag = 'R'", "l_shipdate",
                            "1995-01-01T00:00:00", "1995-12-31T23:59:59")
    return count_rows(rows, "n_docs")


@register("group_agg_five", f"""
SELECT l_returnflag, l_linestatus,
       {dsum(r2('l_quantity'))} AS agg__l_quantity__sum,
       count(l_orderkey) AS agg__l_orderkey__count,
       max({r2('l_extendedprice')}) AS agg__l_extendedprice__max,
       min({r2('l_discount')}) AS agg__l_discount__min,
       {dmean(r2('l_tax'))} AS agg__l_tax__mean
FROM lineitem
WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL
GROUP BY 1, 2
""")
def group_agg_five(spark, d):
    agg = AggSpec(keys=["l_returnflag", "l_linestatus"],
                  functions="l_quantity--sum,l_orderkey--count,l_extendedprice--max,"
                            "l_discount--min,l_tax--mean")
    return aggregate(table(spark, d, "lineitem"), agg)


@register("default_count", """
SELECT user_id, event_type, count(event_type) AS agg__event_type__count FROM events
WHERE user_id IS NOT NULL AND event_type IS NOT NULL
GROUP BY 1, 2
""")
def default_count(spark, d):
    return aggregate(table(spark, d, "events"), AggSpec(keys=["user_id", "event_type"]))


@register("null_keys_dropped", f"""
SELECT event_type, count(event_id) AS agg__event_id__count,
       COALESCE({dsum(r2('value'))}, 0.0) AS agg__value__sum
FROM (SELECT NULLIF(event_type, 'error') AS event_type, event_id, value FROM events)
WHERE event_type IS NOT NULL
GROUP BY 1
""")
def null_keys_dropped(spark, d):
    df = table(spark, d, "events").withColumn("event_type", F.expr("nullif(event_type, 'error')"))
    return aggregate(df, AggSpec(keys=["event_type"], functions="event_id--count,value--sum"))


@register("sum_empty_is_zero", f"""
SELECT event_type,
       COALESCE({dsum(r2('v'))}, 0.0) AS agg__v_sum__sum,
       {dmean(r2('v'))} AS agg__v_mean__mean,
       count(v) AS agg__v_count__count,
       min(v) AS agg__v_min__min
FROM (SELECT event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v
      FROM events)
WHERE event_type IS NOT NULL
GROUP BY 1
""")
def sum_empty_is_zero(spark, d):
    v = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value"))
    df = table(spark, d, "events").select(
        "event_type", v.alias("v_sum"), v.alias("v_mean"), v.alias("v_count"), v.alias("v_min"))
    return aggregate(df, AggSpec(keys=["event_type"],
                                 functions="v_sum--sum,v_mean--mean,v_count--count,v_min--min"))


@register("key_order", f"""
SELECT l_returnflag, l_linestatus, {dsum(r2('l_quantity'))} AS agg__l_quantity__sum
FROM lineitem
WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL
GROUP BY 1, 2
""")
def key_order(spark, d):
    agg = AggSpec(keys=["l_linestatus", "l_returnflag"], functions="l_quantity--sum")
    return aggregate(table(spark, d, "lineitem"), agg)


# ------------------------------------------------------------ A4 A5 A6

def _dense_days_sql(local_date: str, table_name: str, days: int, aggs: str, dense_aggs: str,
                    cols: str) -> str:
    """DuckDB form of an n-day bucket as the only key: every bucket, empty ones too."""
    return f"""
WITH e AS (SELECT {local_date} AS d, {cols} FROM {table_name}),
b AS (SELECT min(d) AS d0, max(d) AS d1 FROM e),
g AS (SELECT d0 + CAST(floor(date_diff('day', d0, d) / {days}) * {days} AS INTEGER) AS bucket,
             {aggs}
      FROM e, b WHERE d IS NOT NULL GROUP BY 1),
cal AS (SELECT CAST(x AS DATE) AS bucket FROM b,
        generate_series(CAST(d0 AS TIMESTAMP),
                        CAST(d0 + CAST(floor(date_diff('day', d0, d1) / {days}) * {days} AS INTEGER)
                             AS TIMESTAMP),
                        INTERVAL {days} DAY) AS t(x))
SELECT cal.bucket AS {{time}}, {dense_aggs} FROM cal LEFT JOIN g ON cal.bucket = g.bucket
"""


ORACLE_DAILY = _dense_days_sql(
    "CAST(ts AS DATE)", "events", 1,
    f"count(event_id) AS c, {dsum(r2('value'))} AS s",
    "COALESCE(c, 0) AS agg__event_id__count, COALESCE(s, 0.0) AS agg__value__sum",
    "event_id, value").replace("{time}", "ts")


@register("daily_counts", ORACLE_DAILY)
def daily_counts(spark, d):
    agg = AggSpec(functions="event_id--count,value--sum", time_field="ts", days=1)
    return aggregate(table(spark, d, "events"), agg)


_ROME_DATE_EVENTS = "CAST(timezone('Europe/Rome', timezone('UTC', ts)) AS DATE)"


@register("nday_bucket_zone", _dense_days_sql(
    _ROME_DATE_EVENTS, "events", 7,
    f"count(event_id) AS c, {dsum(r2('value'))} AS s, max({r2('value')}) AS mx",
    "COALESCE(c, 0) AS agg__event_id__count, COALESCE(s, 0.0) AS agg__value__sum, "
    "mx AS agg__value2__max",
    "event_id, value").replace("{time}", "ts"))
def nday_bucket_zone(spark, d):
    df = table(spark, d, "events").withColumn("value2", F.col("value"))
    agg = AggSpec(functions="event_id--count,value--sum,value2--max", time_field="ts", days=7,
                  zone="Europe/Rome")
    return aggregate(df, agg)


_ROME_DATE_ORDERS = "CAST(timezone('Europe/Rome', timezone('UTC', o_orderdate)) AS DATE)"


@register("nday_bucket_keys", f"""
WITH e AS (SELECT {_ROME_DATE_ORDERS} AS d, o_orderstatus, o_orderkey,
                  {r2('o_totalprice')} AS p FROM orders),
b AS (SELECT min(d) AS d0 FROM e)
SELECT d0 + CAST(floor(date_diff('day', d0, d) / 30) * 30 AS INTEGER) AS o_orderdate,
       o_orderstatus, count(o_orderkey) AS agg__o_orderkey__count,
       COALESCE({dsum('p')}, 0.0) AS agg__o_totalprice__sum
FROM e, b
WHERE d IS NOT NULL AND o_orderstatus IS NOT NULL
GROUP BY 1, 2
""")
def nday_bucket_keys(spark, d):
    agg = AggSpec(keys=["o_orderstatus"], functions="o_orderkey--count,o_totalprice--sum",
                  time_field="o_orderdate", days=30, zone="Europe/Rome")
    return aggregate(table(spark, d, "orders"), agg)


@register("dense_calendar", _dense_days_sql(
    "CAST(o_orderdate AS DATE)", "orders", 1,
    f"count(o_orderkey) AS c, {dsum(r2('o_totalprice'))} AS s, max(o_custkey) AS mx",
    "COALESCE(c, 0) AS agg__o_orderkey__count, COALESCE(s, 0.0) AS agg__o_totalprice__sum, "
    "mx AS agg__o_custkey__max",
    "o_orderkey, o_totalprice, o_custkey").replace("{time}", "o_orderdate"))
def dense_calendar(spark, d):
    agg = AggSpec(functions="o_orderkey--count,o_totalprice--sum,o_custkey--max",
                  time_field="o_orderdate", days=1)
    return aggregate(table(spark, d, "orders"), agg)


# ------------------------------------------------------------ A7 A8 A9 A10

@register("bool_occurrences", """
SELECT l_returnflag, CAST(sum(CASE WHEN flag THEN 1 ELSE 0 END) AS BIGINT) AS agg__flag__sum,
       count(*) AS agg__flag2__count
FROM (SELECT l_returnflag,
             CASE WHEN l_tax = 0 THEN NULL ELSE l_discount > 0.05 END AS flag FROM lineitem)
WHERE l_returnflag IS NOT NULL
GROUP BY 1
""")
def bool_occurrences(spark, d):
    flag = F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.col("l_discount") > 0.05)
    df = table(spark, d, "lineitem").select("l_returnflag", flag.alias("flag"),
                                            flag.alias("flag2"))
    agg = AggSpec(keys=["l_returnflag"], functions="flag--sum,flag2--count",
                  bool_columns=["flag", "flag2"])
    return aggregate(df, agg)


@register("aggregate_names", f"""
SELECT event_type, max({r2('value')}) AS top_value, count(event_id) AS agg__event_id__count
FROM events WHERE event_type IS NOT NULL GROUP BY 1
""")
def aggregate_names(spark, d):
    agg = AggSpec(keys=["event_type"], functions="value--max,event_id--count",
                  names="value--top_value,event_id")
    return aggregate(table(spark, d, "events"), agg)


@register("unknown_columns_pruned", f"""
SELECT event_type, min({r2('value')}) AS agg__value__min
FROM events WHERE event_type IS NOT NULL GROUP BY 1
""")
def unknown_columns_pruned(spark, d):
    agg = AggSpec(keys=["event_type", "nope"], functions="value--min,ghost--sum",
                  names="ghost--g", bool_columns=["phantom"])
    return aggregate(table(spark, d, "events"), agg)


@register("rounded_then_aggregated", f"""
SELECT l_returnflag, l_linestatus,
       {dsum(r2('l_extendedprice * l_discount'))} AS agg__disc__sum,
       {dmean(r2('l_extendedprice * l_tax'))} AS agg__tax__mean
FROM lineitem
WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL
GROUP BY 1, 2
""")
def rounded_then_aggregated(spark, d):
    li = table(spark, d, "lineitem")
    df = li.select("l_returnflag", "l_linestatus",
                   (F.col("l_extendedprice") * F.col("l_discount")).alias("disc"),
                   (F.col("l_extendedprice") * F.col("l_tax")).alias("tax"))
    return aggregate(df, AggSpec(keys=["l_returnflag", "l_linestatus"],
                                 functions="disc--sum,tax--mean"))


# ------------------------------------------------------------ X1 X2

@register("round_half_even", f"""
SELECT l_orderkey, l_linenumber, {r2('l_extendedprice * l_discount')} AS disc_price,
       {r2('l_extendedprice * (1 - l_discount) * (1 + l_tax)')} AS charge
FROM lineitem
""")
def round_half_even(spark, d):
    li = table(spark, d, "lineitem")
    df = li.select("l_orderkey", "l_linenumber",
                   (F.col("l_extendedprice") * F.col("l_discount")).alias("disc_price"),
                   (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax")))
                   .alias("charge"))
    return round_floats(df, 2)


@register("decimal_comma", f"""
SELECT event_id, ts, event_type, {r2('value')} AS value FROM events
""")
def decimal_comma(spark, d):
    events = table(spark, d, "events").select("event_id", "ts", "event_type", "value")
    path = scratch_path(spark, "decimal-comma")
    write_csv(events, path, sep=";", decimal=",", rounding=2)
    return read_csv(spark, path, events.schema, sep=";", decimal=",")


# ------------------------------------------------------------ K1 K2 K3 S3 S4 U1

@register("raw_csv_roundtrip", """
SELECT conv_id, turn, NULLIF(role, '') AS role, NULLIF(text, '') AS text FROM conversations
""")
def raw_csv_roundtrip(spark, d):
    conv = table(spark, d, "conversations")
    path = scratch_path(spark, "raw-csv")
    write_csv(conv, path)
    return read_csv(spark, path, conv.schema)


@register("pages_csv_roundtrip", """
SELECT page_id, NULLIF(url, '') AS url, NULLIF(html, '') AS html FROM pages
""")
def pages_csv_roundtrip(spark, d):
    pages = table(spark, d, "pages")
    path = scratch_path(spark, "pages-csv")
    write_csv(pages, path, sep="|")
    return read_csv(spark, path, pages.schema, sep="|")


@register("agg_csv_roundtrip", f"""
SELECT event_type, count(event_id) AS agg__event_id__count,
       COALESCE({dsum(r2('value'))}, 0.0) AS agg__value__sum,
       {dmean(r2('user_id'))} AS agg__user_id__mean
FROM events WHERE event_type IS NOT NULL GROUP BY 1
""")
def agg_csv_roundtrip(spark, d):
    agg = AggSpec(keys=["event_type"], functions="event_id--count,value--sum,user_id--mean")
    result = aggregate(table(spark, d, "events"), agg)
    path = scratch_path(spark, "agg-csv")
    write_csv(result, path, single_file=True)
    return read_csv(spark, path, result.schema)


@register("merge_partials", """
SELECT o_orderkey, o_orderdate, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'F' THEN NULLIF(o_orderpriority, '') END AS o_orderpriority
FROM orders
""")
def merge_partials(spark, d):
    orders = table(spark, d, "orders")
    first = orders.filter("o_orderstatus = 'F'").select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    rest = orders.filter("NOT (o_orderstatus <=> 'F')").select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    p1, p2 = scratch_path(spark, "parts-a"), scratch_path(spark, "parts-b")
    write_csv(first, p1, max_rows_per_file=1000)
    write_csv(rest, p2, max_rows_per_file=1000)
    return read_parts(spark, [p1, p2], [first.schema, rest.schema])


@register("export_then_aggregate", f"""
SELECT ts AS day, event_type AS kind, count(event_id) AS agg__event_id__count,
       COALESCE({dsum(r2('value'))}, 0.0) AS total
FROM (SELECT event_id, CAST(ts AS DATE) AS ts, event_type, value FROM events WHERE ts IS NOT NULL)
GROUP BY 1, 2
""")
def export_then_aggregate(spark, d):
    """The export-and-aggregate job: raw CSV and aggregated CSV written, aggregate read back."""
    spec = ExportSpec(fields=["event_id", "ts", "event_type", "value"], time_field="ts", rename="event_type--kind,ts--day",
                      max_rows_per_file=5000)
    agg = AggSpec(keys=["event_type"], functions="event_id--count,value--sum",
                  names="value--total", time_field="ts", days=1)
    raw, aggregated = scratch_path(spark, "raw"), scratch_path(spark, "agg") + ".csv"
    export_and_aggregate(events_docs(spark, d), spec, agg, raw, aggregated)
    return read_csv(spark, aggregated,
                    "day date, kind string, agg__event_id__count long, total double")


@register("stream_export", f"""
SELECT DISTINCT event_id AS _id, ts, event_type, {r2('value')} AS value FROM events
WHERE ts IS NOT NULL
""")
def stream_export(spark, d):
    """The export as a Structured Streaming job over the index files, run to completion."""
    events = table(spark, d, "events")
    spec = ExportSpec(fields=["ts", "event_type", "value"], metadata=["_id"], time_field="ts")
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    query = export_stream(spark, f"{d}/ev*.parquet", events.schema, spec, out, ckpt,
                          id_field="event_id")
    query.awaitTermination()
    return read_csv(spark, out, "_id long, ts timestamp_ntz, event_type string, value double")


@register("aggregate_only_job", f"""
WITH e AS (SELECT {_ROME_DATE_EVENTS} AS d, event_type, {r2('value')} AS v FROM events),
b AS (SELECT min(d) AS d0 FROM e)
SELECT d0 + CAST(floor(date_diff('day', d0, d) / 7) * 7 AS INTEGER) AS ts, event_type,
       {dmean('v')} AS mean_value
FROM e, b WHERE d IS NOT NULL AND event_type IS NOT NULL
GROUP BY 1, 2
""")
def aggregate_only_job(spark, d):
    """Aggregation alone over a raw CSV (semicolons, decimal comma) written earlier."""
    events = table(spark, d, "events").select("event_id", "ts", "event_type", "value")
    raw, out = scratch_path(spark, "raw-semicolon"), scratch_path(spark, "agg-only") + ".csv"
    write_csv(events, raw, sep=";", decimal=",")
    agg = AggSpec(keys=["event_type"], functions="value--mean", names="value--mean_value",
                  time_field="ts", days=7, zone="Europe/Rome")
    aggregate_only(spark, raw, agg, out, schema=events.schema, sep=";", decimal=",")
    return read_csv(spark, out, "ts date, event_type string, mean_value double",
                    sep=";", decimal=",")


# ------------------------------------------------------------ U2 U3

@register("dedup_by_id", f"""
SELECT DISTINCT event_id AS _id, ts, user_id, event_type, {r2('value')} AS value
FROM (SELECT * FROM events UNION ALL SELECT * FROM events)
""")
def dedup_by_id(spark, d):
    docs = events_docs(spark, d)
    spec = ExportSpec(fields=["ts", "user_id", "event_type", "value"], metadata=["_id"],
                      time_field="ts")
    return export_frame(union_parts(docs, docs), spec)


@register("dedup_by_fields", """
SELECT doc_id, text, lang FROM (
  SELECT doc_id, text, lang, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn
  FROM documents)
WHERE rn = 1
""")
def dedup_by_fields_q(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return dedup_by_fields(docs, ["text"], ["doc_id"])


# ------------------------------------------------------------ I1 I2 A2

@register("equal_slices", """
WITH b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events)
SELECT event_id, ts,
       CAST(CASE WHEN hi = lo THEN 0
                 ELSE least(3, ((epoch_us(ts) - lo) * 4) // (hi - lo)) END AS INTEGER) AS slice_id
FROM events, b
""")
def equal_slices(spark, d):
    events = table(spark, d, "events").select("event_id", "ts")
    return assign_slices(events, "ts", SliceSpec(n=4))


@register("slice_counts", """
WITH b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
s AS (SELECT CAST(CASE WHEN hi = lo THEN 0
                       ELSE least(3, ((epoch_us(ts) - lo) * 4) // (hi - lo)) END AS INTEGER) AS slice_id
      FROM events, b WHERE ts IS NOT NULL),
c AS (SELECT slice_id, count(*) AS n_docs FROM s GROUP BY 1),
ids AS (SELECT CAST(i AS INTEGER) AS slice_id FROM range(0, 4) t(i))
SELECT ids.slice_id,
       make_timestamp(lo + (ids.slice_id * (hi - lo) + 3) // 4) AS slice_start,
       make_timestamp(CASE WHEN ids.slice_id = 3 THEN hi
                           ELSE lo + ((ids.slice_id + 1) * (hi - lo) + 3) // 4 END) AS slice_end,
       COALESCE(c.n_docs, 0) AS n_docs
FROM ids CROSS JOIN b LEFT JOIN c ON ids.slice_id = c.slice_id
""")
def slice_counts(spark, d):
    return slice_table(table(spark, d, "events"), "ts", SliceSpec(n=4))


def _load_plan_sql(table_name: str, t: str, n: int, step_us: int) -> str:
    """DuckDB CTEs ``b`` (bounds), ``h`` (histogram) and ``p`` (plan) of load slices."""
    return f"""
WITH RECURSIVE
b AS (SELECT min(epoch_us({t})) AS lo, max(epoch_us({t})) AS hi, count({t}) AS total
      FROM {table_name} WHERE {t} IS NOT NULL),
h AS (SELECT (epoch_us({t}) - lo) // {step_us} AS k, count(*) AS c, min(epoch_us({t})) AS mn
      FROM {table_name}, b WHERE {t} IS NOT NULL GROUP BY 1),
hn AS (SELECT k, c, mn, row_number() OVER (ORDER BY k) AS rn FROM h),
walk(rn, acc, cuts) AS (
  SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT hn.rn,
         CASE WHEN len(w.cuts) < {n - 1} AND w.acc + hn.c >= b.total / {n}
                   AND (hn.k + 1) * {step_us} <= b.hi - b.lo THEN 0 ELSE w.acc + hn.c END,
         CASE WHEN len(w.cuts) < {n - 1} AND w.acc + hn.c >= b.total / {n}
                   AND (hn.k + 1) * {step_us} <= b.hi - b.lo
              THEN list_append(w.cuts, hn.k + 1) ELSE w.cuts END
  FROM walk w JOIN hn ON hn.rn = w.rn + 1 CROSS JOIN b),
fin AS (SELECT cuts FROM walk ORDER BY rn DESC LIMIT 1),
p0 AS (SELECT lo, hi, cuts, len(cuts) AS m,
              CASE WHEN len(cuts) = 0 THEN 0 ELSE cuts[len(cuts)] END AS last_cut
       FROM b, fin),
p AS (SELECT lo, hi, cuts, m, last_cut,
             COALESCE((SELECT min(mn) FROM h WHERE h.k >= p0.last_cut), lo) AS r0
      FROM p0)"""


def _load_label_sql(us: str, n: int, step_us: int) -> str:
    """DuckDB form of the slice of a time in micros ``us``, plan ``p`` in scope."""
    return f"""CAST(CASE
          WHEN m > 0 AND {us} < lo + last_cut * {step_us}
            THEN len(list_filter(cuts, lambda c: c <= ({us} - lo) // {step_us}))
          WHEN hi = r0 THEN m
          ELSE m + least({n} - m - 1, (({us} - r0) * ({n} - m)) // (hi - r0)) END AS INTEGER)"""


def _load_slices_sql(table_name: str, t: str, n: int, step_us: int) -> str:
    """DuckDB form of load-balanced slices: a recursive walk over the histogram."""
    return _load_plan_sql(table_name, t, n, step_us) + f""",
rows AS (SELECT epoch_us({t}) AS us FROM {table_name} WHERE {t} IS NOT NULL),
lab AS (SELECT {_load_label_sql('us', n, step_us)} AS slice_id FROM rows, p),
cnt AS (SELECT slice_id, count(*) AS n_docs FROM lab GROUP BY 1),
ids AS (SELECT CAST(i AS INTEGER) AS slice_id FROM range(0, {n}) t(i))
SELECT ids.slice_id,
       make_timestamp(CASE WHEN ids.slice_id < m THEN
                             CASE WHEN ids.slice_id = 0 THEN lo
                                  ELSE lo + cuts[ids.slice_id] * {step_us} END
                           ELSE r0 + ((ids.slice_id - m) * (hi - r0) + ({n} - m) - 1) // ({n} - m)
                      END) AS slice_start,
       make_timestamp(CASE WHEN ids.slice_id < m THEN lo + cuts[ids.slice_id + 1] * {step_us}
                           WHEN ids.slice_id = {n - 1} THEN hi
                           ELSE r0 + ((ids.slice_id - m + 1) * (hi - r0) + ({n} - m) - 1) // ({n} - m)
                      END) AS slice_end,
       COALESCE(cnt.n_docs, 0) AS n_docs
FROM ids CROSS JOIN p LEFT JOIN cnt ON ids.slice_id = cnt.slice_id
"""


_DAY_US = 86_400 * 1_000_000


@register("sliced_export", _load_plan_sql("orders", "o_orderdate", 12, 7 * _DAY_US) + f"""
SELECT o_orderkey, o_orderdate, {r2('o_totalprice')} AS o_totalprice,
       {_load_label_sql('epoch_us(o_orderdate)', 12, 7 * _DAY_US)} AS slice_id
FROM orders, p
""")
def sliced_export(spark, d):
    """Export written as one folder of parts per load-balanced time slice, read back."""
    spec = ExportSpec(fields=["o_orderkey", "o_orderdate", "o_totalprice"],
                      time_field="o_orderdate", slices=SliceSpec(n=12, step="7d"),
                      max_rows_per_file=4000)
    path = scratch_path(spark, "sliced")
    export(orders_docs(spark, d), spec, path)
    return read_csv(spark, path,
                    "o_orderkey long, o_orderdate timestamp_ntz, o_totalprice double, slice_id int")


@register("load_slices", _load_slices_sql("events", "ts", 4, 3 * _DAY_US))
def load_slices(spark, d):
    return slice_table(table(spark, d, "events"), "ts", SliceSpec(n=4, step="3d"))


@register("load_slices_orders", _load_slices_sql("orders", "o_orderdate", 12, 7 * _DAY_US))
def load_slices_orders(spark, d):
    return slice_table(table(spark, d, "orders"), "o_orderdate", SliceSpec(n=12, step="7d"))


@register("load_slices_remainder", _load_slices_sql("events", "ts", 7, 5 * _DAY_US))
def load_slices_remainder(spark, d):
    """Fewer cuts than slices: the rest of the range is cut in equal widths."""
    return slice_table(table(spark, d, "events"), "ts", SliceSpec(n=7, step="5d"))
