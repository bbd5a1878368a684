"""Scans, landed files, and sinks."""
