"""Bronze ingest as a once-only file stream."""

from tristrata.streaming.bronze_stream import stream_bronze

__all__ = ["stream_bronze"]
