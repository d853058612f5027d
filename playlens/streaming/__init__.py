"""Incremental, exactly-once file loads with Structured Streaming."""
