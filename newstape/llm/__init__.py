"""Operators of a training-data pipeline: scans, formatting, deduplication, scoring, archives, packing."""
