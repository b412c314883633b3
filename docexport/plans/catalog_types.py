"""Registered queries over data whose types, times or headers are not uniform.

They come beside those of ``catalog`` and work alike: whole tables, one DuckDB
SQL form each. Where a table has to be turned into other input first (times as
text, fields that change their type, parts with several headers), that step
only writes the rows in the form the job meets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.timefn import as_utc_ntz
from ..operators.aggregate import aggregate
from ..operators.dedup import dedup_by_fields, dedup_by_id
from ..operators.order import first_last
from ..operators.predicate import select_documents
from ..operators.slices import slice_table
from ..session import scratch_path
from ..sinks.csv import text_options, write_csv
from ..sources.readers import read_csv, read_hits_json, read_ordered, read_parts, scan, write_hits_json
from ..spec import AggSpec, ExportSpec, SliceSpec
from .catalog import events_docs, r2, register, table
from .job import aggregate_only, export

# ------------------------------------------------------------ times as text


def _iso(ts: Column, hours: float, suffix: str) -> Column:
    shifted = F.timestamp_add("MINUTE", F.lit(int(hours * 60)), ts)
    return F.concat(F.replace(shifted.cast("string"), F.lit(" "), F.lit("T")), F.lit(suffix))


def text_time_docs(spark, d) -> DataFrame:
    """Events whose time is ISO-8601 text, with several offsets and without one."""
    ts, turn = F.col("ts"), F.col("event_id") % 4
    text = (F.when(turn == 0, _iso(ts, 0, "Z")).when(turn == 1, _iso(ts, 2, "+02:00")).when(turn == 2, _iso(ts, -5.5, "-05:30"))
            .otherwise(_iso(ts, 0, "")))
    return events_docs(spark, d).withColumn("ts", text)


def _instant(df: DataFrame, name: str = "ts") -> Column:
    return as_utc_ntz(F.col(name), df.schema[name].dataType)


@register("text_time_range", """
SELECT event_id, ts, event_type FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-04 23:00:00' AND TIMESTAMP '2024-01-12 22:59:59.999999'
""")
def text_time_range(spark, d):
    """A closed range, in Rome wall clock, over times that are text with any offset."""
    docs = select_documents(text_time_docs(spark, d), None, "ts", "2024-01-05T00:00:00", "2024-01-12T23:59:59.999999", "Europe/Rome")
    return docs.select("event_id", _instant(docs).alias("ts"), "event_type")


@register("text_time_order", """
SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events
""")
def text_time_order(spark, d):
    """An export ordered by text times, its rows at their places in the written parts."""
    path = scratch_path(spark, "text-times")
    export(text_time_docs(spark, d), ExportSpec(fields=["event_id", "ts"], time_field="ts", max_rows_per_file=3000), path)
    rows = read_ordered(spark, path, "event_id long, ts string")
    return rows.withColumn("ts", _instant(rows))


@register("text_time_bounds", """
SELECT arg_min(event_id, ts) AS first_id, arg_max(event_id, ts) AS last_id, min(ts) AS first_time, max(ts) AS last_time FROM events
""")
def text_time_bounds(spark, d):
    """First and last document by instants that are text."""
    return first_last(text_time_docs(spark, d), "ts", "event_id")


@register("text_time_slices", """
WITH b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
s AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(5, ((epoch_us(ts) - lo) * 6) // (hi - lo)) END AS INTEGER) AS slice_id
      FROM events, b WHERE ts IS NOT NULL),
c AS (SELECT slice_id, count(*) AS n_docs FROM s GROUP BY 1),
ids AS (SELECT CAST(i AS INTEGER) AS slice_id FROM range(0, 6) t(i))
SELECT ids.slice_id, make_timestamp(lo + (ids.slice_id * (hi - lo) + 5) // 6) AS slice_start,
       make_timestamp(CASE WHEN ids.slice_id = 5 THEN hi ELSE lo + ((ids.slice_id + 1) * (hi - lo) + 5) // 6 END) AS slice_end,
       COALESCE(c.n_docs, 0) AS n_docs
FROM ids CROSS JOIN b LEFT JOIN c ON ids.slice_id = c.slice_id
""")
def text_time_slices(spark, d):
    """Equal-width slices of times that are text."""
    return slice_table(text_time_docs(spark, d), "ts", SliceSpec(n=6))


@register("date_field_buckets", """
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderstatus, o_orderkey FROM orders),
b AS (SELECT min(d) AS d0 FROM o)
SELECT d0 + CAST(((d - d0) // 30) * 30 AS INTEGER) AS o_orderdate, o_orderstatus, count(o_orderkey) AS agg__o_orderkey__count
FROM o, b WHERE o_orderstatus IS NOT NULL AND d IS NOT NULL GROUP BY 1, 2
""")
def date_field_buckets(spark, d):
    """30-day buckets of a DATE field with a key."""
    orders = table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return aggregate(orders, AggSpec(keys=["o_orderstatus"], functions="o_orderkey--count", time_field="o_orderdate", days=30))


# ------------------------------------------------------------ large sums

@register("sum_large_values", """
SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(round_even(l_extendedprice, 0) AS BIGINT)) AS BIGINT) AS total_units
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1
""")
def sum_large_values(spark, d):
    """Sums of values around 10^17, whose multiples of 0.01 and whose totals pass 64 bits."""
    lines = table(spark, d, "lineitem").select("l_returnflag", (F.rint("l_extendedprice") * F.lit(1e12)).alias("v"), F.lit(1).alias("one"))
    sums = aggregate(lines, AggSpec(keys=["l_returnflag"], functions="one--count,v--sum", names="one--n,v--total"))
    return sums.select("l_returnflag", "n", F.rint(F.col("total") / F.lit(1e12)).cast("long").alias("total_units"))


# ------------------------------------------------------------ types that drift

def _drifting_indices(spark, d) -> str:
    """Three indices of events that hold ``event_id`` as int, bigint and text and ``user_id`` as int, bigint and double."""
    events, base = table(spark, d, "events"), scratch_path(spark, "drift")
    for i, (id_type, user_type) in enumerate([("int", "int"), ("bigint", "bigint"), ("string", "double")]):
        (events.filter(F.col("event_id") % 3 == i)
         .select(F.col("event_id").cast(id_type), F.col("user_id").cast(user_type), "ts", "event_type").write.parquet(f"{base}/events-{i}"))
    return base


_DRIFT_SQL = """
SELECT {index} AS _index, CAST(event_id AS VARCHAR) AS _id, CAST(user_id AS DOUBLE) AS user_id, ts, event_type FROM events
"""


@register("scan_drift_types", _DRIFT_SQL.format(index="'events-' || (event_id % 3)"))
def scan_drift_types(spark, d):
    """A wildcard pattern over indices that hold a field in different types."""
    docs = scan(spark, f"{_drifting_indices(spark, d)}/events-*", id_field="event_id")
    return docs.select("_index", "_id", "user_id", "ts", "event_type")


@register("scan_drift_indices", _DRIFT_SQL.format(index="['x', 'y', 'z'][event_id % 3 + 1]"))
def scan_drift_indices(spark, d):
    """Named indices that hold a field in different types."""
    base = _drifting_indices(spark, d)
    docs = scan(spark, {name: f"{base}/events-{i}" for i, name in enumerate("xyz")}, id_field="event_id")
    return docs.select("_index", "_id", "user_id", "ts", "event_type")


@register("hits_inferred", f"""
SELECT CAST(event_id AS VARCHAR) AS _id, ts, event_type, CAST(user_id AS VARCHAR) AS user_id, {r2('value')} AS value,
       CASE WHEN event_id % 2 = 0 THEN event_id END AS only_even
FROM events
""")
def hits_inferred(spark, d):
    """Hits read without a declared schema: fields that only some bodies have, and one that is a number here and text there."""
    events, base = table(spark, d, "events").drop("props"), scratch_path(spark, "hits-inferred")
    even = events.filter("event_id % 2 = 0").withColumn("only_even", F.col("event_id"))
    odd = events.filter("event_id % 2 = 1").withColumn("user_id", F.col("user_id").cast("string"))
    for name, part in (("even", even), ("odd", odd)):
        write_hits_json(part, f"{base}/{name}", id_field="event_id", index="events")
    hits = read_hits_json(spark, f"{base}/*")
    rounded = F.rint(F.col("value") * 100) / 100
    return hits.select("_id", _instant(hits).alias("ts"), "event_type", "user_id", rounded.alias("value"), "only_even")


@register("dedup_maps", """
SELECT CAST(event_id AS BIGINT) AS _id, event_type, CAST(user_id AS VARCHAR) AS "user", event_type AS kind FROM events
""")
def dedup_maps(spark, d):
    """Documents that came twice, with the entries of a map in another order, are one row each."""
    events = table(spark, d, "events")
    user, kind = (F.struct(F.lit(k).alias("key"), F.col(c).cast("string").alias("value")) for k, c in (("user", "user_id"), ("kind", "event_type")))
    twice = [events.withColumn("props", F.map_from_entries(F.array(*entries))) for entries in ((user, kind), (kind, user))]
    rows = dedup_by_id(twice[0].unionByName(twice[1]).withColumn("_id", F.col("event_id").cast("long")), ["event_type", "props"])
    return rows.select("_id", "event_type", F.col("props")["user"].alias("user"), F.col("props")["kind"].alias("kind"))


@register("first_by_time_and_id", """
SELECT user_id, event_type, ts, event_id AS _id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts NULLS FIRST, event_id NULLS FIRST) = 1
""")
def first_by_time_and_id(spark, d):
    """Of the events with equal fields the first by time and id, in a hash aggregate without a sort."""
    docs = events_docs(spark, d).select("user_id", "event_type", "ts", "_id")
    return dedup_by_fields(docs, ["user_id", "event_type"], ["ts", "_id"])


# ------------------------------------------------------------ CSV parts

def _mixed_parts(spark, d) -> str:
    """One folder of CSV parts with two headers, whose shared columns stand at different places."""
    orders, path = table(spark, d, "orders"), scratch_path(spark, "mixed-parts")
    first = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    rest = orders.filter("NOT (o_orderstatus <=> 'F')").select("o_orderstatus", "o_orderkey", "o_orderpriority", "o_orderdate")
    for part in (first, rest):
        part.write.mode("append").options(**text_options()).option("maxRecordsPerFile", 2000).csv(path)
    return path


@register("merge_parts_mixed_headers", """
SELECT o_orderkey, o_orderdate, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderstatus <> 'F' THEN NULLIF(o_orderpriority, '') END AS o_orderpriority
FROM orders
""")
def merge_parts_mixed_headers(spark, d):
    """Parts with different headers in one folder, merged by column name."""
    return read_parts(spark, _mixed_parts(spark, d),
                      "o_orderkey long, o_orderdate timestamp_ntz, o_orderstatus string, o_totalprice double, o_orderpriority string")


@register("aggregate_parts_job", """
SELECT o_orderstatus, count(o_orderkey) AS agg__o_orderkey__count,
       CASE WHEN o_orderstatus = 'F' THEN COALESCE(CAST(sum(CAST(round_even(o_totalprice, 2) AS DECIMAL(28,2))) AS DOUBLE), 0.0) ELSE 0.0 END AS total
FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1
""")
def aggregate_parts_job(spark, d):
    """The aggregate-only job over a folder with two headers, its result written in parts by many tasks."""
    out = scratch_path(spark, "agg-parts")
    aggregate_only(spark, _mixed_parts(spark, d), AggSpec(keys=["o_orderstatus"], functions="o_orderkey--count,o_totalprice--sum", names="o_totalprice--total"),
                   out, agg_parts=True)
    return read_csv(spark, out, "o_orderstatus string, agg__o_orderkey__count long, total double")


@register("decimal_comma_inferred", f"""
SELECT o_orderkey, {r2('o_totalprice')} AS o_totalprice, o_orderstatus FROM orders
""")
def decimal_comma_inferred(spark, d):
    """A raw CSV with a decimal comma, read without a schema."""
    path = scratch_path(spark, "comma-inferred")
    write_csv(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), path, sep=";", decimal=",")
    rows = read_csv(spark, path, sep=";", decimal=",")
    return rows.withColumn("o_orderkey", F.col("o_orderkey").cast("long"))
