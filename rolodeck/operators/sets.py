"""Lists put together, compared and routed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def concatenated(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both, duplicates included; columns that one lacks are empty there."""
    out = first.unionByName(second, allowMissingColumns=True)
    texts = {c for c, kind in out.dtypes if kind == "string"}
    return out.select(*[X.blank_if_null(F.col(c)).alias(c) if c in texts else F.col(c) for c in out.columns])


def new_emails(old: DataFrame, new: DataFrame, old_email: str = "email", new_email: str = "Email") -> DataFrame:
    """One row, n: distinct e-mails of new that old has not; blank ones don't count."""
    keys = lambda d, c: d.select(X.key(F.col(c)).alias("e")).filter("e <> ''")
    return keys(new, new_email).subtract(keys(old, old_email)).agg(F.count(F.lit(1)).alias("n"))


def union_sources(*lists: Column) -> Column:
    """The sorted distinct union of comma-separated lists."""
    parts = F.concat(*[F.split(X.blank_if_null(c), ",") for c in lists])
    return F.array_join(F.array_sort(F.array_distinct(F.filter(parts, lambda s: s != ""))), ",")


def stream(emails: Column, phone: Column) -> Column:
    """Where a place goes: email if it has one, else call if it has a phone, else none."""
    return F.when(F.size(F.coalesce(emails, F.array().cast("array<string>"))) > 0, "email").when(X.blank_if_null(phone) != "", "call").otherwise("none")
