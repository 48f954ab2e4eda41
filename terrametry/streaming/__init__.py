"""Structured Streaming: message ingest, keyed upsert, log sink, alert rules."""
