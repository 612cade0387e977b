"""Readers and writers for route tables."""
