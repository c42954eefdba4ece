"""Counts, shares and reports over lead and place tables.

All are aggregates that combine before they shuffle. Several value counts share one pass: columns are stacked into (column, value) rows. Percentages are rounded half to even.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import checkpointed, numbered
from ..functions import text as X
from . import classify
from .matching import containing


#: Up to so many different values are ranked by one window for each field; beyond, by ranges of values.
WINDOW_ROWS = 1_000_000


def count_if(c: Column) -> Column:
    return F.coalesce(F.sum(c.cast("long")), F.lit(0).cast("long"))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.coalesce(F.bround(F.try_divide(100.0 * part, whole), digits), F.lit(0.0))


def coverage(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """field, has, missing, share of rows (in per cent) that have it; one pass."""
    sums = df.agg(F.count(F.lit(1)).alias("n"), *[count_if(X.nonblank(X.blank_if_null(c))).alias(k) for k, c in columns.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).alias("has")) for k in columns]))
    return sums.select("n", rows.alias("r")).select("r.field", "r.has", (F.col("n") - F.col("r.has")).alias("missing"), percent(F.col("r.has"), F.col("n")).alias("share"))


def top_counts(df: DataFrame, columns: dict[str, tuple[Column, int | None]], order: str = "ord", empty: str = "EMPTY") -> DataFrame:
    """field, value, n, rank: of each column its k most frequent values (all if k is None), blank ones as ``empty``; ties by first appearance. One pass."""
    value = lambda c: F.when(X.nonblank(X.blank_if_null(c)), c).otherwise(F.lit(empty))
    stacked = df.select(order, F.explode(F.array(*[F.struct(F.lit(k).alias("field"), value(c).alias("value")) for k, (c, _) in columns.items()])).alias("x"))
    counts = stacked.groupBy("x.field", "x.value").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    rank = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "first")).cast("long")
    limits = {k: most for k, (_, most) in columns.items() if most is not None}
    whole = [k for k in columns if k not in limits]
    if whole:
        counts = checkpointed(counts)  # read more than once
    parts = []
    if limits:  # the largest limit is a literal, so each task sends no more than so many values of a field
        top = counts.filter(F.col("field").isin(*limits)).withColumn("rank", rank).filter(F.col("rank") <= max(limits.values()))
        own = F.lit(0)
        for k, most in limits.items():
            own = F.when(F.col("field") == k, F.lit(most)).otherwise(own)
        parts.append(top.filter(F.col("rank") <= own))
    if whole:
        every = counts.filter(F.col("field").isin(*whole))
        few = every.limit(WINDOW_ROWS + 1).count() <= WINDOW_ROWS
        parts.append(every.withColumn("rank", rank) if few else ranked(every))
    return reduce(DataFrame.unionByName, parts).drop("first")


def ranked(counts: DataFrame) -> DataFrame:
    """counts (field, value, n, first) with ``rank`` inside each field by n, then first, where a field may have any number of values: numbered in one global order, from each field's first."""
    order = [F.col("field"), F.desc("n"), F.col("first")]
    every = checkpointed(numbered(counts, order, "place"))
    starts = every.groupBy(F.col("field").alias("f_")).agg(F.min("place").alias("start"))
    return every.join(F.broadcast(starts), F.col("field") == F.col("f_")).select("field", "value", "n", "first", (F.col("place") - F.col("start") + 1).alias("rank"))


def distinct_counts(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """field, distinct values (blank ones are one value)."""
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("field"), X.blank_if_null(c).alias("value")) for k, c in columns.items()])).alias("x"))
    return stacked.select("x.*").distinct().groupBy("field").agg(F.count(F.lit(1)).alias("n"))


def title_classes(df: DataFrame, title: str = "title", others: int = 15, order: str = "ord") -> DataFrame:
    """kind, value, n: rows in each class of titles (kind "class"), and the most frequent titles that are in none (kind "other"); ties by first appearance."""
    marked = df.select(order, F.col(title).alias("title"), classify.title_class(F.col(title)).alias("class"))
    counts = marked.groupBy(F.lit("class").alias("kind"), F.col("class").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    top = top_counts(marked.filter(F.col("class") == classify.OTHER_TITLE), {"other": (F.col("title"), others)}, order)
    return counts.unionByName(top.select(F.col("field").alias("kind"), "value", "n"))


def expected_countries(leads: DataFrame, locations: DataFrame, words: DataFrame, codes: DataFrame) -> DataFrame:
    """Countries that search locations (column location) name, their phone codes, and leads with such a phone.

    words: word, code, pos; codes: country (the word), code (of phones). A word counts where it stands as a word, letters being compared as they are.
    """
    whole = F.rlike("l", F.concat(F.lit("\\b\\Q"), F.col("word"), F.lit("\\E\\b")))
    named = containing(locations.select(F.lower("location").alias("l")).distinct(), F.col("l"), words, "word").filter(whole).select("word").distinct()
    wanted = named.join(codes.select(F.lower("country").alias("word"), F.col("code").alias("phone_code")), "word")
    # A phone has one prefix of each length, so that equality joins find its codes, however many different phones there are.
    lengths = F.array(*[F.lit(n) for n in range(2, 6)])
    prefixes = leads.select(F.explode(F.transform(lengths, lambda n: F.when(F.length("company_phone") >= n, F.substr(F.col("company_phone"), F.lit(1), n)))).alias("prefix")).filter("prefix is not null")
    counts = prefixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counts, F.col("prefix") == F.col("phone_code"), "left").select("word", "phone_code", F.coalesce("n", F.lit(0)).alias("leads"))


def recommendations(leads: DataFrame, codes: list[str], known: list[str]) -> DataFrame:
    """place, filter, removed: the filters worth while and how many rows each would remove.

    1 email: rows without one; 2 phone: rows whose phone code is none of codes (not asked where there are none); 3 individual: titles of people who contribute alone; 4 industry: always, without
    a number. The first three only if they remove any. known: all phone codes, longest match first.
    """
    phone = X.strip(X.first_present(*[F.col(c).cast("string") for c in ("company_phone", "phone", "organization_phone") if c in leads.columns]))
    wanted = F.coalesce(X.phone_code(phone, known).isin(*codes), F.lit(False)) if codes else F.lit(True)
    removed = {"email": ~F.coalesce(X.present(F.col("email")), F.lit(False)), "phone": ~wanted, "individual": classify.title_class(F.col("title")).isin(*classify.INDIVIDUAL)}
    sums = leads.agg(*[count_if(c).alias(k) for k, c in removed.items()])
    rows = [F.struct(F.lit(i + 1).alias("place"), F.lit(k).alias("filter"), F.col(k).alias("removed")) for i, k in enumerate(removed)]
    rows.append(F.struct(F.lit(4).alias("place"), F.lit("industry").alias("filter"), F.lit(None).cast("long").alias("removed")))
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*").filter("removed is null or removed > 0")


def approval(marked: DataFrame, column: str = "industry") -> DataFrame:
    """Per value: total, kept, removed, approval in per cent."""
    out = marked.groupBy(F.when(X.nonblank(X.blank_if_null(F.col(column))), F.col(column)).otherwise("EMPTY").alias(column)).agg(F.count(F.lit(1)).alias("total"), count_if(F.col("kept")).alias("kept"))
    return out.withColumns({"removed": F.col("total") - F.col("kept"), "approval": percent(F.col("kept"), F.col("total"))})


def shares(df: DataFrame, key: Column, name: str) -> DataFrame:
    """name, n, share: counts per value and their share of all rows."""
    counts = df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", percent(F.col("n"), F.lit(df.count())))


def stages(named: dict[str, DataFrame]) -> DataFrame:
    """stage, rows, with_email, deliverable, sources: several stages of one run side by side."""
    out = None
    for name, df in named.items():
        one = df.select(F.lit(name).alias("stage"), X.blank_if_null(F.col("email")).alias("email"), X.blank_if_null(F.col("email_status")).alias("status"), "source")
        out = one if out is None else out.unionByName(one)
    return out.groupBy("stage").agg(F.count(F.lit(1)).alias("rows"), count_if(F.col("email") != "").alias("with_email"), count_if(F.col("status").isin("verified", "deliverable")).alias("deliverable"), F.count_distinct("source").alias("sources"))


def place_coverage(places: DataFrame) -> DataFrame:
    has = {"emails": F.size("emails") > 0, "website": X.blank_if_null(F.col("website")) != "", "phone": X.blank_if_null(F.col("phone")) != ""}
    out = places.agg(F.count(F.lit(1)).alias("n"), *[count_if(c).alias(k) for k, c in has.items()])
    return out.select("n", *has, *[F.coalesce(F.floor(F.try_divide(100.0 * F.col(k), F.col("n"))), F.lit(0)).cast("long").alias(f"{k}_pct") for k in has])


def term_report(places: DataFrame, term: str) -> DataFrame:
    """Per term and in all (``all``): places, with and without website, share without, with phone."""
    site = X.blank_if_null(F.col("website")) != ""
    out = places.rollup(term).agg(F.count(F.lit(1)).alias("total"), count_if(site).alias("with_site"), count_if(X.blank_if_null(F.col("phone")) != "").alias("with_phone"))
    return out.select(F.coalesce(term, F.lit("all")).alias("term"), "total", "with_site", (F.col("total") - F.col("with_site")).alias("no_site"), percent(F.col("total") - F.col("with_site"), F.col("total")).alias("no_site_pct"), "with_phone")


def term_categories(places: DataFrame, terms: DataFrame, term: str, category: str, k: int = 3, order: str = "ord") -> DataFrame:
    """term, passed, categories: of each term in terms (column term) the k most frequent categories; terms without places don't pass."""
    counts = places.groupBy(F.col(term).alias("t_"), F.col(category).alias("c_")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    top = counts.withColumn("r", F.row_number().over(Window.partitionBy("t_").orderBy(F.desc("n"), "first"))).filter(F.col("r") <= k)
    lists = top.groupBy("t_").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "c_"))), lambda x: x["c_"]), "|").alias("categories"))
    return terms.join(lists, F.col("term") == F.col("t_"), "left").select("term", F.col("t_").isNotNull().alias("passed"), X.blank_if_null(F.col("categories")).alias("categories"))


def score_summary(evaluated: DataFrame, score: Column, key: str | None = None) -> DataFrame:
    """sites, scored, average (1 digit), below 50 and its share (floor) of scored ones; per key if given."""
    agg = [F.count(F.lit(1)).alias("sites"), F.count(score).alias("scored"), F.coalesce(F.bround(F.avg(score), 1), F.lit(0.0)).alias("average"), count_if(score < 50).alias("below_50")]
    out = evaluated.groupBy(key).agg(*agg) if key else evaluated.agg(*agg)
    return out.withColumn("below_50_pct", F.coalesce(F.floor(F.try_divide(100.0 * F.col("below_50"), F.col("scored"))), F.lit(0)).cast("long"))


def warnings(rows: DataFrame, text: str, longest: int) -> DataFrame:
    """rows with ``warnings``: too long (in words), em dash, empty."""
    t = X.blank_if_null(F.col(text))
    return rows.withColumn("warnings", F.array_compact(F.array(F.when(X.strip(t) == "", "empty"), F.when(F.size(F.split(X.strip(t), r"\s+")) > longest, "too_long"), F.when(F.contains(t, F.lit("—")), "em_dash"))))


def warning_counts(rows: DataFrame, text: str, longest: int = 15) -> DataFrame:
    """(warning, n): rows with each warning, all warnings ("all warnings"), and rows that have any ("any warning")."""
    listed = warnings(rows, text, longest).select("warnings")
    each = F.concat("warnings", F.when(F.size("warnings") > 0, F.array(F.lit("any warning"))).otherwise(F.array().cast("array<string>")), F.transform("warnings", lambda _: F.lit("all warnings")))
    return listed.select(F.explode(each).alias("warning")).groupBy("warning").agg(F.count(F.lit(1)).alias("n"))


def segment_summary(rows: DataFrame, segment: Column, text: str, longest: int = 15) -> DataFrame:
    """(segment, n, too_long, em_dash): leads of each segment and of all ("all"), and those whose message has over so many words, or an em dash."""
    marked = warnings(rows, text, longest).withColumn("segment", segment)
    has = lambda w: count_if(F.array_contains("warnings", w))
    out = marked.rollup("segment").agg(F.count(F.lit(1)).alias("n"), has("too_long").alias("too_long"), has("em_dash").alias("em_dash"), F.grouping("segment").alias("all_"))
    return out.withColumn("segment", F.when(F.col("all_") == 1, "all").otherwise(F.col("segment"))).drop("all_")


def best_leads(leads: DataFrame, n: int, order: str = "ord") -> DataFrame:
    """The n leads with the highest score, ties by order, with reasons. Points for content, bio, jobs, headline and e-mail. A bounded top-k: each task keeps n rows."""
    size = F.length(X.blank_if_null(F.col("content")))
    parts = {
        "content": F.when(size > 2000, 30).when(size > 500, 15).otherwise(0),
        "bio": F.when(F.length(X.blank_if_null(F.col("bio"))) > 100, 25).when(X.blank_if_null(F.col("bio")) != "", 10).otherwise(0),
        "jobs": F.when(F.col("n_jobs") >= 3, 25).when(F.col("n_jobs") > 0, 10).otherwise(0),
        "headline": F.when(X.blank_if_null(F.col("professional_title")) != "", 10).otherwise(0),
        "email": F.when(X.blank_if_null(F.col("email")) != "", 10).otherwise(0),
    }
    score = sum(parts.values(), F.lit(0))
    why = F.array_join(F.array_compact(F.array(*[F.when(v > 0, F.lit(k)) for k, v in parts.items()])), ",")
    return leads.withColumns({"score": score, "why": why}).orderBy(F.desc("score"), order).limit(n)


def sorted_campaigns(campaigns: DataFrame) -> DataFrame:
    """With ``place``: oldest first, those without a date last, ties by id."""
    first = F.coalesce(F.nullif(X.blank_if_null(F.col("created_at")), F.lit("")), F.lit("9999"))
    return numbered(campaigns, [first, F.col("campaign_id")], "place")
