"""Query registry: each key maps to a Spark builder and (optionally) DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str  # SURVEY inventory ids covered


REGISTRY: dict[str, Query] = {}


def register(key: str, ids: str, sql: str | None = None):
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, sql, ids)
        return fn
    return deco
