"""Saved people-search URLs as tables of filters, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import containing

#: Column, and the URL parameter it stands for; parameters that end with [] may repeat.
PARAMETERS = {"titles": "personTitles[]", "locations": "personLocations[]", "seniorities": "personSeniorities[]", "sizes": "organizationNumEmployeesRanges[]", "keywords": "qKeywords"}


def parsed(searches: DataFrame, url: str = "url") -> DataFrame:
    """searches without url, with a list for each of PARAMETERS (values decoded and stripped, in order) and revenue_min, revenue_max.

    The parameters stand behind the question mark of the URL's fragment. All of it is one projection.
    """
    query = F.split_part(F.split_part(F.col(url), F.lit("#"), F.lit(2)), F.lit("?"), F.lit(2))
    pairs = F.transform(F.filter(F.split(query, "&"), lambda p: F.contains(p, F.lit("="))), lambda p: F.struct(F.split_part(p, F.lit("="), F.lit(1)).alias("key"), _decoded(F.split_part(p, F.lit("="), F.lit(2))).alias("value")))
    out = searches.withColumn("_pairs", pairs)
    values = lambda key: F.transform(F.filter("_pairs", lambda p: (p["key"] == key) & (p["value"] != "")), lambda p: p["value"])
    out = out.withColumns({c: values(key) for c, key in PARAMETERS.items()})
    return out.withColumns({f"revenue_{x}": F.get(values(f"revenueRange[{x}]"), F.lit(0)).try_cast("long") for x in ("min", "max")}).drop("_pairs", url)


def _decoded(c: Column) -> Column:
    return F.trim(F.coalesce(F.try_url_decode(c), c))


def built(filters: DataFrame, start: str, key: str = "search_id") -> DataFrame:
    """(key, url): the filters written as parameters after ``start``; blanks are written %20."""
    encoded = lambda v: F.replace(F.url_encode(v), F.lit("+"), F.lit("%20"))
    written = lambda c, p: F.transform(F.col(c), lambda v: F.concat(F.lit(f"&{p}="), encoded(v)))
    parts = [written(c, p) for c, p in PARAMETERS.items()]
    revenue = [F.when(F.col(f"revenue_{x}").isNotNull(), F.concat(F.lit(f"&revenueRange[{x}]="), F.col(f"revenue_{x}").cast("string"))) for x in ("min", "max")]
    return filters.select(key, F.concat(F.lit(start), F.array_join(F.concat(*parts), ""), *[F.coalesce(r, F.lit("")) for r in revenue]).alias("url"))


def country(filters: DataFrame, words: DataFrame, default: str, key: str = "search_id") -> DataFrame:
    """(key, code): of the first location that holds a country word, that word's code; words: word, code, pos."""
    found = containing(filters.select(key, F.posexplode("locations").alias("at", "location")), F.lower("location"), words, "word")
    best = found.groupBy(F.col(key).alias("k_")).agg(F.min(F.struct("at", "pos", "code")).alias("best"))
    return filters.join(best, F.col(key) == F.col("k_"), "left").select(key, F.coalesce("best.code", F.lit(default)).alias("code"))


def round_trip(filters: DataFrame, key: str = "search_id") -> DataFrame:
    """Of each list, whether it has the same set of values after building and parsing."""
    again = parsed(built(filters, "https://x/#/people?page=1", key)).withColumnRenamed(key, "k_").withColumnsRenamed({c: f"{c}_" for c in PARAMETERS})
    same = lambda a, b: F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))
    return filters.join(again, F.col(key) == F.col("k_")).select(key, *[same(F.col(c), F.col(f"{c}_")).alias(c) for c in PARAMETERS])
