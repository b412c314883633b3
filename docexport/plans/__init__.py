"""Jobs assembled from the operators, and plan checks."""

from .job import aggregate_frame, aggregate_only, export, export_and_aggregate, export_frame

__all__ = ["aggregate_frame", "aggregate_only", "export", "export_and_aggregate", "export_frame"]
