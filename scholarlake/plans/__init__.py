"""Queries over the test tables and the SQL that checks them, by area."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

#: The modules of this package that hold ``QUERIES`` and ``ORACLES``.
AREAS: tuple[str, ...] = ("dedup", "candidates", "records", "answers", "pages", "stored")


def _areas():
    return [importlib.import_module(f"{__name__}.{area}") for area in AREAS]


def queries() -> dict[str, Query]:
    return {name: query for area in _areas() for name, query in area.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for area in _areas() for name, sql in area.ORACLES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["title_stats"](spark, sf_dir)
