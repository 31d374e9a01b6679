"""Readers for Bronze files, lake tables, extracts and event streams."""
