"""Structured Streaming form of the export."""

from .incremental import export_stream, stream_frame

__all__ = ["export_stream", "stream_frame"]
