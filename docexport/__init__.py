"""Spark-native document export and aggregation.

Read documents from any Spark source, filter them by predicate and time
range in a named zone, pick and flatten fields, remove duplicates, rename
and round, write delimited text; aggregate by keys and calendar buckets;
cut a time range into equal-width or load-balanced slices.
"""

from .spec import AggSpec, ExportSpec, SliceSpec, parse_couples, parse_duration, parse_functions

__all__ = ["AggSpec", "ExportSpec", "SliceSpec", "parse_couples", "parse_duration",
           "parse_functions"]
