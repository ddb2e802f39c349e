"""Queries of this subpackage and, where SQL can say it, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        LLM_QUERIES[name] = fn
        if sql is not None:
            LLM_ORACLES[name] = sql
        return fn

    return register
