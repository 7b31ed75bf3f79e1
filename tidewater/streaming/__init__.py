"""Structured Streaming: apply a save mode to every micro-batch."""

from .sync_stream import jdbc_batch_writer, latest_snapshot, run_available, snapshot_batch_writer, start_sync
