"""Message ingest, replay and streaming summaries on Structured Streaming."""
