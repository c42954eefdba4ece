"""Lookups with repeated, missing and hot keys: as many rows come out as went in, and the last answer counts."""

import pytest
from pyspark.sql import functions as F

from rolodeck.operators import classify, enrich, filters, joins, lookup, normalize
from rolodeck.sources import readers


def answers(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, at int")


@pytest.mark.parametrize("hot", [False, True])
def test_last_answer_wins_and_no_row_is_added_or_lost(spark, monkeypatch, hot):
    monkeypatch.setattr(lookup, "HEAVY", 10)
    rows = [(i, "busy" if i % 3 else f"k{i % 7}") for i in range(60)] + [(60, None), (61, "unknown"), (62, "k3"), (62, "k3")]
    df = spark.createDataFrame(rows, "ord int, key string")
    said = answers(spark, [("busy", "old", 1), ("busy", "new", 3), ("busy", "middle", 2), ("k3", "a", None), ("k3", "b", 0), ("k0", "x", 1), ("k0", "y", 1), (None, "nothing", 9), ("nobody", "asks", 1)])
    got = lookup.looked_up(df, said, F.col("key"), F.col("key"), {"value": F.col("value")}, "found", ("at",), hot=hot)
    want = {"busy": "new", "k3": "b", "k0": "y"}  # a later answer, null first; of two at one time the larger
    assert sorted((r.ord, r.found and r.found.value) for r in got.collect()) == sorted((i, want.get(k)) for i, k in rows)
    assert got.columns == ["ord", "key", "found"]


def test_a_null_value_is_an_answer(spark):
    df = spark.createDataFrame([("a",), ("b",)], "key string")
    got = lookup.looked_up(df, answers(spark, [("a", "old", 1), ("a", None, 2)]), F.col("key"), F.col("key"), {"value": F.col("value")}, "found", ("at",))
    assert {r.key: r.found and tuple(r.found) for r in got.collect()} == {"a": (None,), "b": None}


def test_empty_tables(spark):
    none = answers(spark, [])
    df = spark.createDataFrame([("a",)], "key string")
    for hot in (False, True):
        assert [r.found for r in lookup.looked_up(df, none, F.col("key"), F.col("key"), {"value": F.col("value")}, "found", hot=hot).collect()] == [None]
        assert lookup.looked_up(none.select("key"), none, F.col("key"), F.col("key"), {"value": F.col("value")}, "found", hot=hot).count() == 0


def test_email_status(spark):
    leads = spark.createDataFrame([("A@x.lv",), (" a@X.lv ",), ("b@x.lv",), ("",), (None,)], "email string")
    said = spark.createDataFrame([("A@X.LV", "invalid", 1), ("a@x.lv", "valid", 2), ("b@x.lv", "error", 2), ("b@x.lv", "valid", 1)], "email string, status string, at int")
    got = [(r.email, r.email_status) for r in enrich.email_status(leads, said, order=("at",)).collect()]
    assert sorted(got, key=str) == sorted([("A@x.lv", "valid"), (" a@X.lv ", "valid"), ("b@x.lv", "verification_failed"), ("", "missing"), (None, "missing")], key=str)


def test_filled_country(spark):
    leads = spark.createDataFrame([("x.lv", ""), ("X.LV", None), ("x.lv", "Had"), ("y.lv", ""), ("", "")], "company_domain string, company_country string")
    said = spark.createDataFrame([("x.lv", "Estonia", 1), ("X.lv", "Latvia", 2)], "domain string, country string, at int")
    got = sorted((r.company_domain, r.filled, r.company_country) for r in joins.filled_country(leads, said, ("at",)).collect())
    assert got == [("", "no_domain", ""), ("X.LV", "filled", "Latvia"), ("x.lv", "filled", "Latvia"), ("x.lv", "had", "Had"), ("y.lv", "not_found", "")]


def test_scores_of_industries(spark):
    leads = spark.createDataFrame([("Gyms",), ("gyms",), ("Bars",), ("",), (None,)], "industry string")
    scores = spark.createDataFrame([("gyms", "irrelevant", "was", 1), ("Gyms", "relevant", "is", 2), ("Gyms", "maybe", "was", 0), ("bars", "nonsense", "?", 1)], "industry string, score string, reason string, at int")
    got = sorted(((r.industry, r.score) for r in joins.scored_industries(leads, scores, order=("at",)).collect()), key=str)
    assert got == sorted([("Gyms", "relevant"), ("gyms", "relevant"), ("Bars", "maybe"), ("", None), (None, None)], key=str)
    kept = sorted(((r.industry, r.relevance, r.reason, r.kept) for r in filters.by_relevance(leads, scores, False, order=("at",)).collect()), key=str)
    assert kept == sorted([("Gyms", "relevant", "is", True), ("gyms", "irrelevant", "was", False), ("Bars", "nonsense", "?", False), ("", None, None, True), (None, None, None, True)], key=str)


def test_evaluations_and_pages(spark):
    leads = spark.createDataFrame([(1, "https://a"), (2, "https://a"), (3, "https://b"), (4, ""), (5, None)], "ord int, web string")
    done = spark.createDataFrame([("https://a", 10, 1), ("https://a", 90, 2)], "site string, points int, at int")
    got = classify.with_evaluation(leads, done, F.col("web"), {"score": F.col("points")}, ("at",)).collect()
    assert sorted((r.ord, r.web_status, r.score) for r in got) == [(1, "success", 90), (2, "success", 90), (3, "not_evaluated", None), (4, "no_website", None), (5, "no_website", None)]
    pages = spark.createDataFrame([("https://a", "new", 2), ("https://a", "old", 1), ("https://b", None, 1)], "url string, html string, at int")
    got = readers.pages_of(leads, pages, "ord", "web", ("at",)).collect()
    assert sorted((r.ord, r.html, r.status) for r in got) == [(1, "new", "success"), (2, "new", "success"), (3, None, "success"), (4, None, "error"), (5, None, "error")]


def test_profiles(spark):
    leads = spark.createDataFrame([(1, "mine"), (2, "mine"), (3, "mine")], "ord int, linkedin_bio string")
    jobs = "work_experience array<struct<position_title: string, company_name: string, employment_period: string>>, education array<struct<institution_name: string, degree: string, attendance_period: string>>"
    said = spark.createDataFrame([(1, "old", "h", "c", "i", "l", "3", "f", [], [], 1), (1, "", "h2", "c", "i", "l", "3", "f", [("a", "b", "c")], [], 2), (2, "new", "h", "c", "i", "l", "3", "f", [], [], 1)], f"ord int, bio string, professional_title string, company_name string, company_industry string, location string, total_tenure_years string, followers_range string, {jobs}, at int")
    got = {r.ord: (r.linkedin_bio, r.linkedin_headline, len(r.linkedin_experience or []), r.linkedin_enrichment_credits) for r in normalize.profile_filled(leads, said, "now", 1, order=("at",)).collect()}
    assert got == {1: ("mine", "h2", 1, 1), 2: ("new", "h", 0, 1), 3: ("mine", "", 0, None)}
