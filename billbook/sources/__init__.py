"""Readers: test-table bindings, raw text loads and lake Parquet scans."""
