"""Scheduled incremental runs as Structured Streaming jobs over landed files."""
