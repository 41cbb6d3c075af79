"""Operators over DataFrames: relational stages, sequencing, snapshots, parsing, gates."""
