"""Sinks: message topic, raw CSV tree, processed Parquet tree."""
