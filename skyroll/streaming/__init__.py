"""Versioned table storage and the micro-batch ingest."""
