"""Queries by name, each with DuckDB SQL for the same result where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import fixtures


@dataclass
class Tables:
    """The tables of one run: ``t("fx_leads")`` is a DataFrame."""

    spark: SparkSession
    sf_dir: str

    def __call__(self, name: str) -> DataFrame:
        return fixtures.load(self.spark, self.sf_dir, name)


REGISTRY: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of Tables."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable:
        if name in REGISTRY:
            raise ValueError(f"two queries named {name}")
        REGISTRY[name] = (f, fixtures.oracle(sql) if sql else None)
        return f

    return add
