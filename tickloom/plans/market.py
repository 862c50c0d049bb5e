"""All market queries: each operator on the driver's tables with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.plans import crosssections, datasets, joined, live, microstructure, series, stored

PARTS = (datasets, joined, series, crosssections, microstructure, live, stored)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for part in PARTS for name, (f, _) in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in PARTS for name, (_, sql) in part.QUERIES.items() if sql}
