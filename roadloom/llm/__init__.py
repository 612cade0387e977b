"""Operators of a training-data pipeline: mixing, scoring, deduplication, extraction, packing."""
