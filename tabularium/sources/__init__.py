"""Readers and writers: parquet tables, JSON Lines trees, archives, paged APIs, publication."""
