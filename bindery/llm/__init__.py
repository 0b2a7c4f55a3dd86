"""Operators of a training-data pipeline: scoring, deduplication, search, packing, redaction, extraction, encoding."""
