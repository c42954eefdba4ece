"""All queries of the contact-list operators."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .registry import REGISTRY, Tables

for _part in ("q_text", "q_normalize", "q_filters", "q_joins", "q_profiles", "q_io"):
    importlib.import_module(f"{__package__}.{_part}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))) for name, (f, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in REGISTRY.items() if sql}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["flagship"](spark, sf_dir)
