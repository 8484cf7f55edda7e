"""Incremental runs of the batch checks over newly arriving files.

The source has no streaming; this module only lets the same row checks
(X-*) and contracts run as new files of a table land, with Structured
Streaming's file source and ``foreachBatch`` (exactly-once sinks are the
caller's choice)."""

from aislekit.streaming.checks_stream import stream_row_checks  # noqa: F401
