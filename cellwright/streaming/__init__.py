"""Structured Streaming forms of the batch operators."""

from .jobs import coalesce_stream, counted_cov_stream, cov_stream, current_state, ingest, message_rate, route, smoothed_rate, sync_stream, tumbling  # noqa: F401
