"""Continuous ingest with an offset log."""

from ledgerline.streaming.ingest import DEFAULT_TRIGGER_SECONDS, batch_writer, drain, run_batches, run_ingest, start_ingest

__all__ = ["DEFAULT_TRIGGER_SECONDS", "batch_writer", "drain", "run_batches", "run_ingest", "start_ingest"]
