"""Readers (raw JSON, silver/gold Parquet, current snapshot) and sinks."""
