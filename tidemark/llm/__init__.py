"""Operators of a training-data pipeline (deduplication, scans, scoring, archives, mixing)."""
