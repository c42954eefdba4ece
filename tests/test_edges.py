"""Hand-made rows: blanks of all kinds, ties, chains, odd URLs and names, empty input."""

import random
import unicodedata
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rolodeck import cluster
from rolodeck.functions import names, text
from rolodeck.operators import classify, dedup, enrich, filters, graph, joins, normalize, pages, profiles, searches, sets
from rolodeck.schemas import LEAD
from rolodeck.sources import readers, sinks
from rolodeck.streaming import incremental


def leads(spark, rows):
    full = [{c: "" for c in LEAD} | {"ord": i} | r for i, r in enumerate(rows, 1)]
    schema = "ord long, " + ", ".join(f"{c} string" for c in LEAD)
    return spark.createDataFrame([[r["ord"], *(r[c] for c in LEAD)] for r in full], schema)


def values(spark, column, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r.v for r in df.select("i", column(F.col("x")).alias("v")).orderBy("i").collect()]


def test_blanks(spark):
    assert values(spark, text.key, None, "", " \t", " A b ") == ["", "", "", "a b"]
    assert values(spark, text.nonblank, None, "", " ", "x") == [False, False, False, True]
    assert values(spark, text.present, None, "", " ", "x") == [False, False, True, True]


def test_urls(spark):
    assert values(spark, text.domain, "acme.com/x", "http://www.acme.com:80/x?y", None) == ["acme.com/x", "acme.com:80", None]
    assert values(spark, text.profile_key, "HTTPS://www.LinkedIn.com/in/A/?t=1", "linkedin.com/in/a/", None) == ["linkedin.com/in/a/", "linkedin.com/in/a", ""]
    assert values(spark, text.name_slug, "https://x.com/in/a+b", "https://x.com/in/%zz", "https://x.com/company/a") == ["a+b", "%zz", None]
    assert values(spark, lambda c: text.tld(c, [".co.uk"]), "a.co.uk", "localhost", "", None) == [".co.uk", "", "", ""]


def test_slugs(spark):
    """Ids behind names, particles, empty parts and blanks; each step reads the one before once."""
    split = lambda c: F.concat_ws("|", (n := text.slug_names(text.name_slug(c), list(names.PARTICLES)))["first"], n["last"])
    slugs = ["jean-paul-van-der-berg", "maria-lopez-a1b2c3d4", "a-b-123-456789", "ab-c-1234567", "x-12345", "van-de", "de-van-x", "a--b", "-", "a%2Db-c%C5%A1", ""]
    wanted = ["jean paul|van der berg", "maria|lopez", "a|b", "ab|c", "x|12345", "van|de", "de|van x", "a|b", "|", "a b|cš", "|"]
    assert values(spark, split, *[f" https://x.com/in/{s}/ " for s in slugs], "https://x.com/company/a", None) == [*wanted, "", ""]
    for column in (text.name_slug, lambda c: text.slug_trimmed(text.name_slug(c)), lambda c: text.slug_names(text.name_slug(c), ["van"])):
        plan = spark.createDataFrame([("",)], "url string").select(column(F.col("url")).alias("v"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.split("\n")[0].count("url#") == 1


def test_names():
    assert names.cased("o'neil VAN DER berg mcdonald") == "O'Neil van der Berg McDonald"
    assert (names.cased("van"), names.cased("de la cruz macleod"), names.cased(None)) == ("Van", "De la Cruz MacLeod", "")
    assert names.folded("Bērziņš") == names.folded("berzins") != names.folded("Łódź")
    assert names.casual("SIA \"Acme\" | hair salon", (), ("SIA",), "You") == "Acme"
    assert names.casual("SIA", (), ("SIA",), "You") == "You"
    assert names.casual(None, (), (), "You") == ""


def test_merge_is_a_fold(spark):
    """The third record beats the second alone but not the union so far; a tie keeps the existing one."""
    rows = [
        {"email": "A@x.lv", "name": "one", "source": "feed_b"},
        {"email": "a@x.lv", "title": "boss", "city": "Riga", "source": "feed_a"},
        {"email": " a@x.lv", "name": "three", "title": "chief", "source": "feed_a"},
        {"email": "", "name": "n", "company_name": "c", "source": "feed_a"},
        {"email": "", "name": "N ", "company_name": "C", "country": "LV", "source": "feed_a"},
        {"email": "", "source": "feed_c"},
        {"email": "", "source": "feed_c"},
    ]
    got = {r.ord: r for r in dedup.merged_by_email(leads(spark, rows)).collect()}
    assert set(got) == {1, 4, 6, 7}
    assert (got[1].name, got[1].title, got[1].city, got[1].source) == ("one", "boss", "Riga", "feed_a,feed_b")
    assert (got[4].name, got[4].country) == ("N ", "LV")


def brute_merge(rows):
    """The fold, row by row."""
    count = lambda r: sum(bool(r[c].strip()) for c in LEAD)
    out = {}
    for r in rows:
        mail, name, org = r["email"].strip().lower(), r["name"].strip().lower(), r["company_name"].strip().lower()
        key = ("e", mail) if mail else ("n", name, org) if name and org else ("u", r["ord"])
        if key not in out:
            out[key] = dict(r)
            continue
        base, other = (r, out[key]) if count(r) > count(out[key]) else (out[key], r)
        new = {c: base[c] if base[c].strip() else other[c] if other[c].strip() else "" for c in LEAD}
        new["source"] = ",".join(sorted({s for x in (base, other) for s in x["source"].split(",") if s}))
        out[key] = new | {"ord": out[key]["ord"]}
    return sorted(tuple(r[c] for c in ("ord", *LEAD)) for r in out.values())


@pytest.mark.parametrize("most", [None, 2])
def test_merge_against_brute_force(spark, most):
    rng = random.Random(3)
    rows = [{c: "" for c in LEAD} | {c: rng.choice(["", "", " ", "x", "y"]) for c in ("name", "title", "city", "country", "company_name")} | {"email": rng.choice(["", "a@x", "B@x", "b@x"]), "source": rng.choice(["feed_a", "feed_b"]), "ord": i} for i in range(1, 120)]
    got = dedup.merged_by_email(leads(spark, rows), **({"most": most} if most else {})).select("ord", *LEAD).collect()
    assert sorted(map(tuple, got)) == brute_merge(rows)


def brute_campaigns(rows):
    seen, out = set(), {}
    for rank, order, mail, url, name in sorted(rows):
        keys = [(k, v) for k, v in (("email", mail), ("url", url), ("name_org", name)) if v]
        hit = next((k for k, v in keys if (k, v) in seen), None) if rank > 1 else None
        out[order] = hit
        if hit is None:
            seen |= set(keys)
    return out


@pytest.mark.parametrize("seed, how", [(0, {}), (1, {}), (2, {}), (3, {"rounds": 0}), (4, {"rounds": 1}), (5, {"rounds": 0, "most": 3})])
def test_cross_campaign(spark, seed, how):
    """By rounds, by connected parts, and by both."""
    rng = random.Random(seed)
    rows = [(rng.randint(1, 4), i, *(rng.choice(["", *map(str, range(12))]) for _ in range(3))) for i in range(60)]
    df = leads(spark, [{"ord": i, "email": m, "linkedin_url": u, "name": n, "company_name": n} for _, i, m, u, n in rows]).join(spark.createDataFrame([(i, r) for r, i, *_ in rows], "ord long, rank int"), "ord")
    got = {r.ord: r.reason for r in dedup.cross_campaign(df, "rank", **how).collect()}
    assert got == brute_campaigns(rows)


def test_dropped_rows_lend_no_keys(spark):
    df = leads(spark, [{"email": "a"}, {"email": "a", "linkedin_url": "u"}, {"linkedin_url": "u"}]).withColumn("rank", F.col("ord").cast("int"))
    assert {r.ord: r.reason for r in dedup.cross_campaign(df, "rank").collect()} == {1: None, 2: "email", 3: None}


def test_new_only_and_reference(spark):
    old = leads(spark, [{"email": "a@x"}, {"name": "N", "company_name": "C"}])
    new = leads(spark, [{"email": "A@x"}, {"email": "b@x", "name": "n", "company_name": "c"}, {"email": ""}, {"name": "n"}])
    assert [r.ord for r in joins.new_only(new, old).orderBy("ord").collect()] == [3, 4]
    assert joins.without_reference(new, old.select(F.col("email").alias("Email"))).count() == 3


def test_chain_and_report(spark):
    df = leads(spark, [{"email": "a", "title": "Design Director"}, {"email": "", "title": "intern"}, {"email": "b", "title": "Designer"}, {"email": "c"}])
    stages = [("email", filters.has_email(F.col("email"))), ("title", filters.title_allowed(F.col("title")))]
    tags = filters.tagged(df, stages)
    assert [r.first_failed for r in tags.orderBy("ord").collect()] == [None, "email", "title", None]
    report = {r.stage: (r.before, r.removed, r.after) for r in filters.stage_report(tags, ["email", "title"]).collect()}
    assert report == {"email": (4, 1, 3), "title": (3, 1, 2)}


@pytest.mark.parametrize("niche, score, segment", [("x", 70, "x_decent"), ("x", 69, "x_poor"), ("x", None, "x_poor"), (None, 80, "unknown_decent"), (None, None, "unknown_poor"), ("būvnieki", 71, "buvnieki_decent")])
def test_segments(spark, niche, score, segment):
    df = spark.createDataFrame([(niche, score)], "n string, s int")
    assert df.select(classify.segment(F.col("n"), F.col("s")).alias("v")).first().v == segment


def test_web_score_without_parts(spark):
    df = spark.createDataFrame([(None,) * 5, (50, True, False, None, None)], "performance_score int, is_mobile_friendly boolean, has_ssl boolean, seo_score int, best_practices_score int")
    assert [r.s for r in df.select(classify.web_score().alias("s")).collect()] == [0, int((50 * 0.35 + 100 * 0.2 + 0 * 0.15) / 0.7)]


def test_half_way_percentages(spark):
    df = spark.range(16).withColumn("email", F.when(F.col("id") < 1, "x").otherwise(""))
    assert profiles.coverage(df, {"email": F.col("email")}).first().share == 6.2  # 6.25: half to even


def test_round_trip_of_odd_searches(spark):
    url = "https://app.example.com/#/people?page=1&personTitles[]=R%26D%20%2B%20x&personTitles[]=%zz&qKeywords="
    df = searches.parsed(spark.createDataFrame([(1, url)], "search_id long, url string"))
    assert df.first().titles == ["R&D + x", "%zz"]
    assert all(searches.round_trip(df).first()[1:])


def test_page_text():
    html = "<html><head><title>t</title><script>no()</script></head><body><nav>menu of the site</nav><div class='x about-us'>" + "We bake <b>bread</b>. " * 5 + "</div><br><main><p>" + "More words here " * 5 + "</p></main></body></html>"
    got = pages.page_text(html, pages.SITE_RULES)
    assert "no()" not in got and got.startswith("We bake bread .") and got.endswith("More words here") and "menu" not in got
    assert pages.page_text("<h1>A <i>big</i> headline</h1>", pages.SITE_RULES) == "Abigheadline"  # headlines are joined without blanks
    assert pages.page_text(None, pages.SITE_RULES) == pages.page_text("", pages.SITE_RULES) == ""
    assert pages.page_text("<body><nav>a</nav><p>short &amp; sweet", pages.SITE_RULES) == "a short & sweet"
    assert pages.page_text("<body><nav>a</nav><p>short", pages.SECTION_RULES) == ""
    assert len(pages.page_text("<main>" + "word " * 9999, pages.SITE_RULES)) == 2000


def test_enrichment_calls_once_and_retries(spark):
    seen = []

    def flaky(key):
        seen.append(key)
        if key == "fast":
            raise enrich.FailFast("gone")
        if key == "late" and seen.count("late") < 3:
            raise TimeoutError("later")
        return key.upper()

    assert enrich.call_with_retries(flaky, "late") == ("LATE", None)
    assert enrich.call_with_retries(flaky, "fast") == (None, "failed: gone") and seen.count("fast") == 1


def test_pre_detection_of_malformed(spark):
    assert values(spark, normalize.is_pre_normalized, None, "{", '{"linkedin_url":"u","org_name":"o"}', '{"linkedin_url":"u","org_name":{"name":"o"}}') == [False, False, True, False]


def test_json_reader_refuses_objects(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}')
    for whole in (1 << 20, 0):
        with pytest.raises(Exception, match="the top level must be a list"):
            readers.json_leads(spark, str(tmp_path), "a int", whole).collect()


def test_unknown_feed():
    with pytest.raises(ValueError):
        normalize.dispatched({"feed_x": None}, None)


def test_outreach_drops_empty_lists(spark):
    df = spark.createDataFrame([(1, [], "x@y"), (2, None, "x@y"), (3, ["a@b"], "x@y")], "ord long, emails array<string>, email_1 string")
    assert {r.ord: r.email for r in sinks.outreach10(df, ("ord",)).collect()} == {2: "x@y", 3: "a@b"}


def test_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_mode(spark.range(2), path, "create")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_mode(spark.range(2), path, "create")
    sinks.write_mode(spark.range(3), path, "replace")
    assert spark.read.parquet(path).count() == 3


def test_fan_out_drops_stale_niches(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.createDataFrame([(1, "A b"), (2, "c")], "ord int, niche string")
    sinks.fan_out(df, path)
    sinks.fan_out(df.filter("ord = 2"), path, keep_others=True)
    assert spark.read.parquet(path).count() == 2
    assert [tuple(r) for r in sinks.fan_out(df.filter("ord = 2"), path).collect()] == [("c", 1)]
    assert [r.ord for r in spark.read.parquet(path).collect()] == [2]


def test_streams_and_unions(spark):
    df = spark.createDataFrame([(["a@b"], "", "b,a"), ([], "+1", None), (None, None, ",b,")], "e array<string>, p string, s string")
    got = df.select(sets.stream(F.col("e"), F.col("p")).alias("v"), sets.union_sources(F.col("s"), F.lit("c,a")).alias("u")).collect()
    assert [(r.v, r.u) for r in got] == [("email", "a,b,c"), ("call", "a,c"), ("none", "a,b,c")]


def test_empty_input(spark):
    none = leads(spark, [])
    assert dedup.merged_by_email(none).count() == 0
    assert dedup.cross_campaign(none.withColumn("rank", F.lit(1)), "rank").count() == 0
    assert profiles.coverage(none, {"email": F.col("email")}).first().share == 0.0
    assert filters.match_all(none, {"title": ["x"]}).first().share == 0.0
    assert joins.new_only(none, none).count() == 0


# --- layouts, by hand


def test_layout_columns():
    """The columns and their order, written out."""
    assert sinks.OUTREACH10 == ("email", "company_name", "casual_name", "icebreaker", "niche", "city", "score", "segment", "website", "phone")
    assert sinks.CALLING9 == ("niche", "business_name", "category", "address", "city", "phone", "google_maps_url", "rating", "review_count")
    assert sinks.PLACE10 == ("scraped_at", "niche", "business_name", "category", "address", "city", "phone", "google_maps_url", "rating", "review_count")
    assert sinks.EMAIL24[7:12] == ("email_1", "email_2", "facebook", "instagram", "linkedin") and sinks.EMAIL24[-4:] == ("cms", "insight_1", "insight_2", "insight_3")
    assert sinks.SHEET28[9:15] == ("Company Name", "Casual Company Name", "Company Website", "Company LinkedIn", "Company Phone", "Company Domain") and sinks.SHEET28[-3:] == ("LinkedIn Education", "Website Content", "Source")
    assert sinks.CSV20[9:12] == ("company_name", "casual_org_name", "company_website") and sinks.CSV20[-4:] == ("industry", "company_summary", "icebreaker", "source")
    assert normalize.PLACE_LEAD[:3] == ("scraped_at", "search_query", "business_name") and normalize.PLACE_LEAD[-4:] == ("additional_contact_methods", "pages_scraped", "search_enriched", "enrichment_status")


def test_organization_as_text_object_or_variant(spark):
    rows = [
        (1, "", '{"name":"Obj","website_url":"http://o","phone":"+2","primary_domain":"o"}', "http://w", None),
        (2, "Own", '{"name":"Obj"}', "http://w", "+1"),
        (3, "", '"Text"', "http://w", "+1"),
        (4, "", '""', "http://w", "+1"),
        (5, "", None, "http://w", "+1"),
    ]
    df = spark.createDataFrame(rows, "ord int, company_name string, org string, website_url string, organization_phone string").withColumn("org_name", F.parse_json("org"))
    sheet = [(r["Company Name"], r["Company Website"], r["Company Phone"], r["Company Domain"]) for r in sinks.sheet28(df, keep=("ord",)).orderBy("ord").collect()]
    assert sheet == [("Obj", "http://o", "+2", "o"), ("Own", "", "+1", ""), ("Text", "http://w", "+1", ""), ("", "", "+1", ""), ("", "http://w", "+1", "")]
    lines = [(r.company_name, r.company_website, r.company_phone) for r in sinks.csv20(df, ("ord",)).orderBy("ord").collect()]
    assert lines == [("Obj", "http://w", ""), ("Own", "http://w", "+1"), ("Text", "http://w", "+1"), ("", "http://w", "+1"), ("", "http://w", "+1")]
    struct = df.withColumn("org_name", F.from_json("org", "name string, website_url string"))
    assert [r["Company Name"] for r in sinks.sheet28(struct.filter("ord < 3"), keep=("ord",)).orderBy("ord").collect()] == ["Obj", "Own"]
    plain = df.withColumn("org_name", F.when(F.col("ord") == 3, "Text").otherwise(""))
    assert [(r["Company Name"], r["Company Website"]) for r in sinks.sheet28(plain, keep=("ord",)).orderBy("ord").collect()] == [("", ""), ("Own", ""), ("Text", "http://w"), ("", ""), ("", "")]


def test_sheet_lists_and_long_texts(spark):
    job = "array<struct<title: string, company: string, period: string>>"
    rows = [("Ann", [("A", "C", "2020"), (None, "D", None)], "x" * 1001), ("🟢 run", None, ""), ("Actor", None, "y" * 1000)]
    got = sinks.sheet28(spark.createDataFrame(rows, f"name string, linkedin_experience {job}, website_content string")).collect()
    assert [(r["Full Name"], r["LinkedIn Experience"], len(r["Website Content"])) for r in got] == [("Ann", "A @ C (2020) |  @ D ()", 1003), ("Actor", "", 1000)]


def test_falsy_values_and_truth(spark):
    df = spark.createDataFrame([(0.0, 0, True, False), (4.5, 7, None, True)], "rating double, review_count int, is_mobile_friendly boolean, has_ssl boolean")
    got = [(r.rating, r.review_count, r.is_mobile_friendly, r.has_ssl) for r in sinks.email24(df).collect()]
    assert got == [("", "", "True", ""), ("4.5", "7", "", "True")]


def test_texts_that_look_false_stay(spark):
    df = spark.createDataFrame([("0", "false", "true", Decimal("0.00"), 0.0), ("0.0", "x", None, Decimal("4.50"), 4.0)], "business_name string, category string, city string, rating decimal(5,2), review_count double")
    got = [(r.business_name, r.category, r.city, r.rating, r.review_count) for r in sinks.place10(df, F.lit("now")).collect()]
    assert got == [("0", "false", "true", "", ""), ("0.0", "x", "", "4.50", "4.0")]


def test_each_insight_has_a_message(spark):
    """From a site's values to what is said of them; only a site without problems gets the fallback."""
    rows = [(7.4, True, True, 90, 90, None), (3.2, True, True, 90, 90, None), (None, False, True, 90, 90, None), (None, True, False, 90, 90, None), (None, True, True, 31, 90, None), (None, True, True, 90, 44, None), (1.0, True, True, 45, 60, "Wix"), (None, True, True, 90, 90, "Wix")]
    df = spark.createDataFrame(rows, "lcp_seconds double, has_ssl boolean, is_mobile_friendly boolean, performance_score int, seo_score int, cms string")
    score = F.when(F.col("performance_score") == 45, 49).otherwise(95)
    got = [r.m for r in df.select(classify.message(F.get(classify.web_insights(score), F.lit(0)), F.lit("Acme")).alias("m")).collect()]
    assert got == [
        "I opened Acme on my phone and waited 7.4 seconds.",
        "I opened Acme on my phone and waited 3.2 seconds.",
        "My browser warned me of Acme: the connection is not secure.",
        "On my phone the site of Acme is hard to use.",
        "In a speed test Acme got 31 of 100 points.",
        "In a search test Acme got 44 of 100 points.",
        "Tests gave the site of Acme 49 of 100 points.",
        "I had a look at the site of Acme.",
    ]


def test_place_rules(spark):
    lists = "emails array<string>, phones array<string>, categories array<string>, facebooks array<string>, instagrams array<string>, linkedIns array<string>, twitters array<string>, youtubes array<string>, tiktoks array<string>, whatsapps array<string>"
    schema = f"placeId string, title string, categoryName string, address string, street string, city string, postalCode string, countryCode string, phone string, phoneUnformatted string, website string, domain string, url string, totalScore double, reviewsCount int, permanentlyClosed boolean, {lists}"
    mails = ["a@shop.lv", "b@hotmail.com", "c@mail.ru", "d@other.lv", "a@shop.lv"]
    tail = (mails, ["1", "2", "3", "4", "5", "6"], None, ["f1", "f2"], *[None] * 6)
    place = lambda site, domain, closed=None: ("P/1", "A/b c*", *[None] * 8, site, domain, "u", None, None, closed, *tail)
    df = spark.createDataFrame([place("http://shop.lv", "shop.lv"), place("http://facebook.com/x", "facebook"), place("http://delfi.lv/x", "delfi.lv"), place(None, None), place("x", "y", True)], schema)
    one, social, blocked, none = normalize.places(df).collect()
    assert (one.website, one.domain, one.emails) == ("http://shop.lv", "shop.lv", ["a@shop.lv", "a@shop.lv", "b@hotmail.com", "c@mail.ru"])
    assert (social.website, social.domain, social.emails) == (None, None, ["b@hotmail.com", "c@mail.ru"])
    assert (blocked.website, blocked.domain, blocked.emails) == (None, None, [])
    assert (none.website, none.emails, none.country, none.facebook, len(none.phones_extra)) == (None, ["b@hotmail.com", "c@mail.ru"], "lv", "f1", 6)
    assert one.google_maps_url == "https://www.google.com/maps/search/?api=1&query=A/b%20c%2A&query_place_id=P/1"


def test_titles(spark):
    want = {"Chief of staff": "C-Level", "SVP Sales": "VP / SVP", "Art Director": "Director", "Head, IT": "Head of", "Managing partner": "Manager", "Partner": "Owner / Founder", "Board member": "Board / Chair", "Advisor": "Specialist / Expert", "Clerk": "Other IC", " ": "No title", None: "No title", "Headhunter": "Other IC"}
    assert values(spark, classify.title_class, *want) == list(want.values())
    assert values(spark, lambda c: F.array_join(classify.seniority(c), ","), "Head, Sr. lead", "Senior c.e.o", "assistant to the director", "Assistant", "Co-Owner", None) == ["senior", "c_suite,senior", "director", "entry", "owner", ""]


def test_recommendations_leave_out_what_removes_nothing(spark):
    df = leads(spark, [{"email": "a@b", "title": "CEO", "company_phone": "+37120"}, {"email": "c@d", "title": "Director", "company_phone": "+37121"}])
    assert [(r.filter, r.removed) for r in profiles.recommendations(df, ["+371"], ["371"]).collect()] == [("industry", None)]
    assert [(r.filter, r.removed) for r in profiles.recommendations(df, ["+49"], ["371", "49"]).collect()] == [("phone", 2), ("industry", None)]
    assert [(r.filter, r.removed) for r in profiles.recommendations(df, [], ["371"]).collect()] == [("industry", None)]


# --- readers, pages, keys


def test_json_behind_white_space(spark, tmp_path):
    (tmp_path / "a.json").write_text('\n\t [{"a": 1}, {"a": 2}]')
    (tmp_path / "b.json").write_bytes(b'\xef\xbb\xbf[{"a": 3}]')
    assert sorted(r.a for r in readers.json_leads(spark, str(tmp_path), "a int").collect()) == [1, 2, 3]


def test_only_a_files_head_is_sniffed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n" + "1;2\n" * 2000 + "," * 1_000_000)
    assert readers.sniffed_separator(spark, str(tmp_path)) == ";"
    assert readers.heads(spark, spark.read.text(str(tmp_path)).inputFiles(), 3) == [b"a;b"]


def test_learned_names_override(spark, tmp_path):
    (tmp_path / "ids.json").write_text('{"id": "1", "name": "learned"}\n{"id": "3", "name": "new"}\n')
    known = spark.createDataFrame([("1", "old"), ("2", "kept")], "id string, name string")
    assert sorted(tuple(r) for r in readers.id_map(spark, str(tmp_path / "ids.json"), known).collect()) == [("1", "learned"), ("2", "kept"), ("3", "new")]


def test_pages_with_a_clashing_column(spark):
    df = spark.createDataFrame([(1, "<p>x</p>", "mine")], "page_id int, html string, Content string")
    with pytest.raises(ValueError, match="into="):
        pages.with_text(df)
    assert pages.with_text(df, into="text").first().Content == "mine"


def test_technology(spark):
    marks = ["<link href='/wp-content/x.css'>", "<meta name='generator' content='WordPress 6'>", "SHOPIFY.theme", "x data-wf-page", "__NEXT_DATA__", "<div data-v-0a>", "we react to vue and angular words", None]
    df = spark.createDataFrame([(i, m, {"Server": "nginx", "X-Powered-By": "Ghost-API"} if i == 6 else None) for i, m in enumerate(marks)], "page_id int, html string, h map<string,string>")
    got = [(r.cms, r.framework, r.server) for r in pages.technology(df, headers="h").orderBy("page_id").collect()]
    assert got == [("WordPress", "", ""), ("WordPress", "", ""), ("Shopify", "", ""), ("Webflow", "", ""), ("", "Next.js", ""), ("", "Vue.js", ""), ("Ghost", "", "nginx"), ("", "", "")]


def test_first_seen_with_null_keys_ties_and_helper_names(spark):
    df = spark.createDataFrame([(2, None, "a"), (1, None, "b"), (3, "x", "c"), (3, "x", "d"), (4, "x", "e")], "ord int, k string, _key string")
    got = sorted((r.ord, r._key) for r in dedup.first_seen(df, F.col("k"), "ord").collect())
    assert got == [(1, "b"), (3, "c"), (3, "d")]


def test_enrichment_keeps_columns_named_as_helpers(spark):
    df = spark.createDataFrame([("a", "kept", "mine")], "k string, v string, _needs string")
    row = enrich.enriched(df, F.lit(True), "k", "v", str.upper, "model").first()
    assert (row.v, row.v_by, row._needs) == ("A", "model", "mine")


def test_lookups_keep_columns_named_as_helpers(spark):
    df = leads(spark, [{"email": "a@b", "industry": "Food", "company_domain": "x.lv"}]).select("*", *[F.lit("mine").alias(c) for c in ("_of", "_said", "_same", "_same_hit", "_low", "_mail", "_keys")])
    scores = spark.createDataFrame([("food", "relevant", "why")], "industry string, score string, reason string")
    names = spark.createDataFrame([("7", "Food", 1)], "id string, name string, ord int")
    answers = spark.createDataFrame([("X.lv", "Latvia")], "domain string, country string")
    reviewed = spark.createDataFrame([("n", "A@b", "c")], "Name string, Email string, Company string")
    one = filters.by_relevance(df, scores, False).first()
    assert (one.relevance, one._same, one._low, one._same_hit) == ("relevant", "mine", "mine", "mine")
    assert joins.name_ids(df, "industry", names).first().asDict()["id"] == "7" and joins.scored_industries(df, scores).first()._of == "mine"
    two = joins.filled_country(df, answers).first()
    assert (two.company_country, two._of, two._said) == ("Latvia", "mine", "mine")
    three = joins.kept_or_removed(df, reviewed).first()
    assert three.kept and three._mail == "mine"


def test_a_long_chain_across_campaigns(spark, monkeypatch):
    """Row i shares an e-mail with row i - 1 and a profile with row i + 1: every other one stays."""
    n, steps, real = 1000, [], dedup.checkpointed
    monkeypatch.setattr(dedup, "checkpointed", lambda d: steps.append(1) or real(d))
    monkeypatch.setattr(graph, "checkpointed", lambda d: steps.append(1) or real(d))
    df = leads(spark, [{"email": f"m{i // 2}", "linkedin_url": f"p{(i + 1) // 2}"} for i in range(n)]).withColumn("rank", F.when(F.col("ord") == 1, 1).otherwise(2))
    got = {r.ord: r.reason for r in dedup.cross_campaign(df, "rank").collect()}
    assert [got[i] is None for i in range(1, n + 1)] == [i % 2 == 1 for i in range(1, n + 1)]
    assert len(steps) < 40  # some ten rounds, and not five hundred


def test_global_numbers(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"), F.lit(1).alias("_part")).repartition(7)
    got = cluster.numbered(df, [F.col("x")], "place").collect()
    assert all(r.place == r.x + 1 and r._part == 1 for r in got) and len(got) == 1000


def test_unlimited_value_counts(spark):
    df = spark.range(900).select(F.col("id").alias("ord"), F.when(F.col("id") < 300, F.col("id") % 7).otherwise(F.col("id")).cast("string").alias("v"), F.lit("one").alias("w"))
    got = {(r.field, r.value): (r.n, r.rank) for r in profiles.top_counts(df, {"v": (F.col("v"), None), "w": (F.col("w"), None)}).collect()}
    order = sorted([(-got[k][0], int(k[1]), k) for k in got if k[0] == "v"])
    assert [got[k][1] for _, _, k in order] == list(range(1, 608)) and got["w", "one"] == (900, 1)


def test_stream_appends_new_keys_only(spark, tmp_path):
    """Two runs: what the sink has already is not appended again; new keys are."""
    landing, sink, state = (str(tmp_path / x) for x in ("landing", "sink", "state"))
    schema = "event_id long, user_id long, event_type string"
    run = lambda: incremental.append_new(spark, landing, schema, sink, state, lambda d: d.select("user_id", "event_type"), incremental.user_key, 1)
    for users in (range(30), range(10, 50)):
        spark.createDataFrame([(i, i % 40, "x") for i in users], schema).write.mode("append").parquet(landing)
        run()
    got = incremental.sink_table(spark, sink)
    assert got.count() == 40 and got.select("user_id").distinct().count() == 40 and got.select("part").distinct().count() > 1


# --- page text, rule by rule


def element(selector, text):
    """An element that the selector, and as few others as can be, hits."""
    name, sign, value = next(((a, s, b) for s in ("*=", "~=", "=") if s in selector for a, b in [selector.split(s)]), (selector, "", ""))
    return f"<{name}>{text}</{name}>" if not sign else f"<div {name}='{'x-' + value + '-y' if sign == '*=' else 'p ' + value + ' q' if sign == '~=' else value}'>{text}</div>"


@pytest.mark.parametrize("block, selector", [(b, s) for b in pages.SITE_RULES.blocks for s in b.selectors])
def test_site_blocks(block, selector):
    """Each selector's elements are read, up to its number of them, if their text is long enough; a long other part keeps the body out."""
    rest = "<h1>" + "A headline of a hundred characters and more, so that the page has enough text without its body. " * 2 + "</h1>"
    keep = lambda i: f"{i}" + "k" * block.over  # noqa: E731  one character more than is left out
    page = "<body>" + rest + "".join(element(selector, keep(i)) for i in range(block.most + 2)) + "</body>"
    got = pages.page_text(page, pages.SITE_RULES)
    limit = block.most - (selector == "h1")  # the headline above is one
    assert [keep(i) in got for i in range(block.most + 2)] == [i < limit for i in range(block.most + 2)]
    assert "s" * block.over not in pages.page_text("<body>" + rest + element(selector, "s" * block.over) + "</body>", pages.SITE_RULES)


@pytest.mark.parametrize("selector", pages.SECTION_RULES.blocks[0].selectors)
def test_section_blocks(selector):
    page = "<body>" + "".join(element(selector, f"{i}" + "k" * 20) for i in range(7)) + "</body>"
    got = pages.page_text(page, pages.SECTION_RULES)
    assert [f"{i}" + "k" * 20 in got for i in range(7)] == [i < 5 for i in range(7)]
    assert pages.page_text(element(selector, "s" * 20), pages.SECTION_RULES) == ""


@pytest.mark.parametrize("rules, tag", [(r, t) for r in (pages.SITE_RULES, pages.SECTION_RULES) for t in r.skip])
def test_skipped_elements(rules, tag):
    assert "hidden" not in pages.page_text(f"<body><main>{'seen words ' * 20}<{tag}>{'hidden ' * 20}</{tag}></main></body>", rules)


def test_page_text_limits():
    words = "word " * 2000
    assert len(pages.page_text(f"<main>{words}</main>", pages.SITE_RULES)) <= 2000 < len(pages.page_text(f"<main>{words}</main>", pages.SECTION_RULES)) <= 3000
    assert pages.page_text("<body><main>" + "m" * 60 + "</main><p>" + "b" * 99 + "</p></body>", pages.SITE_RULES).endswith("b" * 99)  # little text: the whole body
    assert "b" * 99 not in pages.page_text("<body><main>" + "m" * 120 + "</main><p>" + "b" * 99 + "</p></body>", pages.SITE_RULES)


def test_folding_in_the_jvm(spark):
    """Over all letters of Latin, Greek and Cyrillic, and marks behind them, as Python folds them."""
    letters = [chr(i) for i in [*range(0x20, 0x250), *range(0x300, 0x530), *range(0x1C80, 0x1C90), *range(0x1D00, 0x2000), *range(0x2C60, 0x2C80), *range(0x2DE0, 0x2E00), *range(0xA640, 0xA7A0)] if unicodedata.category(chr(i)) != "Cn"]
    texts = letters + [f"{a}{b}x" for a in "aEñΣ" for b in ("\u0301", "\u0327\u0308", "ς", "Σ")] + ["ΟΔΟΣ", "Ångström", "Jānis Bērziņš", "ÉÈ", "İ", ""]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", names.folded_name(F.col("t")).alias("v")).collect()
    assert [(r.t, r.v) for r in got if r.v != names.folded(r.t)] == []


def test_a_mailbox_with_most_records(spark):
    """Without any broadcast that Spark chooses itself: the hot key is folded in rounds, as it would be in order."""
    rows = [dict.fromkeys(LEAD, "") | {"email": "all@x" if i % 3 else f"m{i % 5}", "name": f"n{i}", "city": "" if i % 4 else f"c{i}", "source": "feed_a", "ord": i} for i in range(1, 200)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = dedup.merged_by_email(leads(spark, rows), most=20).select("ord", *LEAD).collect()
        assert sorted(map(tuple, got)) == brute_merge(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
