"""Operators for training-text pipelines. Nothing else in the library imports this subpackage."""

from __future__ import annotations


def query_modules() -> list:
    """The modules that register queries."""
    from tabularium.llm import queries

    return [queries]
