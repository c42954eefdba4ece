"""Queries of sources, sinks, pages, enrichment and the incremental stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import enrich as E, filters as L, normalize as N, pages as G
from ..sources import readers as R, sinks as S
from ..streaming import incremental as I
from .. import cluster
from .q_joins import _COLS, _MERGE
from .q_normalize import _LEAD34, _LEAD_B, _leads34
from .registry import query


def folder(t, kind: str) -> str:
    """A path, not used before, in the shared folder."""
    return f"{cluster.shared_folder(t.spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


# --- sources
def _json(t, whole: int = 64 << 20):
    path = folder(t, "json")
    t("fx_leads").select("ord", "name", "email").write.json(path, lineSep=",")  # objects joined by commas
    rows = t.spark.read.text(path, wholetext=True).select(F.concat(F.lit("["), F.regexp_replace("value", ",+$", ""), F.lit("]")).alias("value"))
    rows.write.option("lineSep", "\n").text(path + "-lists")
    return R.json_leads(t.spark, path + "-lists", "ord long, name string, email string", whole)


query("src_json", "SELECT ord, name, email FROM fx_leads")(_json)
query("src_json_split", "SELECT ord, name, email FROM fx_leads")(lambda t: _json(t, 0))  # as large files are read


def _csv(sep):
    def run(t):
        path = folder(t, "csv")
        t("fx_leads").select("ord", F.col("name").alias("Name"), F.when(F.col("ord") % 2 == 0, F.col("email")).otherwise("").alias("Email"), F.when(F.col("ord") % 2 == 1, F.col("email")).otherwise("").alias("EMAIL_ADDRESS")).write.option("header", True).option("sep", sep).csv(path)
        found = R.csv_sniffed(t.spark, path, {"ord": ["ord"], "name": ["name", "Name"], "email": ["Email", "EMAIL_ADDRESS"]})
        return found.withColumn("ord", F.col("ord").cast("long"))

    return run


query("src_csv_alias", "SELECT ord, name, email FROM fx_leads")(_csv(","))
query("src_csv_sniff", "SELECT ord, name, email FROM fx_leads")(_csv(";"))


def _feeds(t):
    path = folder(t, "feeds")
    t("fx_leads").select("ord", "name", "source").write.partitionBy("source").parquet(path)
    return R.vendor_feeds(t.spark, path, ["feed_a", "feed_c"]).select("ord", "name", "source")


query("src_vendor_feeds", "SELECT ord, name, source FROM fx_leads WHERE source IN ('feed_a', 'feed_c')")(_feeds)
_runs = lambda t: t("fx_leads").select("ord", F.when(F.col("ord") % 4 == 3, "2024-05-backup").otherwise(F.concat(F.lit("2024-0"), (F.col("ord") % 4 + 1).cast("string"))).alias("run_id"))
query("src_latest_snapshot", "SELECT ord, '2024-03' AS run_id FROM fx_leads WHERE ord % 4 = 2")(lambda t: R.latest_run(_runs(t)))
query("src_registry", "SELECT client, campaign_id, created_at FROM fx_campaigns WHERE client <> 'client_4' UNION ALL SELECT DISTINCT client, 'folder_' || type, '' FROM fx_campaigns WHERE client = 'client_4'")(
    lambda t: R.campaigns(t("fx_campaigns").filter("client <> 'client_4'").groupBy("client").agg(F.collect_list(F.struct("campaign_id", "created_at")).alias("campaigns")), t("fx_campaigns").select("client", F.concat(F.lit("folder_"), "type").alias("folder")))
)
def _stored(t):
    """Customers' pages, each stored twice, the first time shorter."""
    now = t("pages").select(F.concat(F.lit("p:"), F.col("page_id").cast("string")).alias("url"), "html", F.lit(2).alias("nth"))
    sites = t("customer").select(F.col("c_custkey").alias("ord"), F.concat(F.lit("p:"), F.col("c_custkey").cast("string")).alias("site"))
    found = R.pages_of(sites, now.unionByName(now.withColumns({"html": F.lit("<p>soon"), "nth": F.lit(1)})), "ord", "site", ("nth",))
    return found.select("ord", "status", F.coalesce(F.length("html"), F.lit(0)).cast("long").alias("chars"))


query("src_pages", "SELECT c_custkey AS ord, CASE WHEN p.url IS NULL THEN 'error' ELSE 'success' END AS status, coalesce(length(html), 0)::BIGINT AS chars FROM customer LEFT JOIN (SELECT any_value(url) AS url, any_value(html) AS html, page_id FROM pages GROUP BY page_id) p ON p.page_id = c_custkey")(_stored)


# --- sinks
def _written(t):
    path = folder(t, "run")
    n = S.write_run(t("fx_leads").select("ord", "name"), path, "run-1")
    return t.spark.read.parquet(path).select("ord", "run_id", F.lit(n).cast("long").alias("rows"))


query("snk_run", "SELECT ord, 'run-1' AS run_id, (SELECT count(*) FROM fx_leads) AS rows FROM fx_leads")(_written)
# org_name is a text in some rows and an object in others, as a variant; website_url and organization_phone are what it falls back to.
_ORG = """SELECT *, CASE WHEN ord % 4 < 2 THEN '' ELSE company_name END AS own_name, CASE WHEN ord % 3 = 0 THEN '' ELSE company_website END AS own_site, CASE ord % 5 WHEN 0 THEN 'text' WHEN 1 THEN 'object' WHEN 2 THEN 'blank' ELSE 'none' END AS form FROM fx_leads"""
_NAME = "CASE WHEN own_name <> '' THEN own_name WHEN form = 'text' THEN 'Text ' || ord WHEN form = 'object' THEN 'Object ' || ord ELSE '' END"
_SHEET = {
    "First Name": "first_name", "Last Name": "last_name", "Full Name": "name", "Job Title": "title", "Email": "email", "Email Status": "email_status", "LinkedIn URL": "linkedin_url", "City": "city", "Country": "country", "Company Name": _NAME, "Casual Company Name": "'casual ' || ord",
    "Company Website": "CASE WHEN own_site <> '' THEN own_site WHEN form = 'object' THEN 'https://object.example' WHEN form = 'blank' THEN '' ELSE 'https://fallback.example' END", "Company LinkedIn": "CASE WHEN company_linkedin = '' AND form = 'object' THEN 'https://linkedin.com/object' ELSE company_linkedin END",
    "Company Phone": "CASE WHEN company_phone <> '' THEN company_phone ELSE '+000' END", "Company Domain": "CASE WHEN company_domain = '' AND form = 'object' THEN 'object.example' ELSE company_domain END", "Company Country": "company_country", "Industry": "industry", "Company Summary": "''", "Icebreaker": "''",
    "LinkedIn Headline": "'Head'", "LinkedIn Bio": "''", "LinkedIn Industry": "''", "LinkedIn Location": "''", "LinkedIn Followers": "''", "LinkedIn Experience": "CASE WHEN ord % 2 = 0 THEN 'A @ C1 (2020) | B @ C2 () | C @ C3 (2018)' ELSE '' END", "LinkedIn Education": "CASE WHEN ord % 2 = 0 THEN 'BSc @ S1 | MSc @ S2' ELSE '' END",
    "Website Content": "CASE WHEN ord % 1500 > 1000 THEN repeat('x', 1000) || '...' ELSE repeat('x', (ord % 1500)::INT) END", "Source": "source",
}


def _with_org(t):
    form = F.col("ord") % 5
    object_ = F.format_string('{"name":"Object %d","website_url":"https://object.example","linkedin_url":"https://linkedin.com/object","phone":"+999","primary_domain":"object.example"}', "ord")
    org = F.when(form == 0, F.format_string('"Text %d"', "ord")).when(form == 1, object_).when(form == 2, F.lit('""'))
    job = lambda a, b, c: F.struct(F.lit(a).alias("title"), F.lit(b).alias("company"), F.lit(c).cast("string").alias("period"))
    school = lambda a, b: F.struct(F.lit(a).alias("degree"), F.lit(b).alias("school"))
    even = lambda xs: F.when(F.col("ord") % 2 == 0, F.array(*xs))
    return t("fx_leads").withColumns({
        "company_name": F.when(F.col("ord") % 4 < 2, "").otherwise(F.col("company_name")), "company_website": F.when(F.col("ord") % 3 == 0, "").otherwise(F.col("company_website")), "org_name": F.parse_json(org), "website_url": F.lit("https://fallback.example"), "organization_phone": F.lit("+000"),
        "casual_org_name": F.format_string("casual %d", "ord"), "linkedin_headline": F.lit("Head"), "linkedin_experience": even([job("A", "C1", "2020"), job("B", "C2", None), job("C", "C3", "2018"), job("D", "C4", "2017")]), "linkedin_education": even([school("BSc", "S1"), school("MSc", "S2"), school("PhD", "S3")]),
        "website_content": F.repeat(F.lit("x"), (F.col("ord") % 1500).cast("int")),
    })


query("snk_sheet28", f"SELECT ord, {', '.join(f'{v} AS "{k}"' for k, v in _SHEET.items())} FROM ({_ORG}) WHERE NOT contains(name, 'Scanning pages')")(lambda t: S.sheet28(_with_org(t), keep=("ord",)))
assert (tuple(_SHEET), len(S.CSV20), len(S.OUTREACH10), len(S.CALLING9), len(S.EMAIL24), len(S.PLACE10)) == (S.SHEET28, 20, 10, 9, 24, 10)


def _modes(t):
    path = folder(t, "modes")
    rows = t("fx_leads").select("ord")
    S.write_mode(rows, path, "create")
    S.write_mode(rows.filter("ord % 2 = 0"), path, "append")
    return t.spark.read.parquet(path).groupBy("ord").agg(F.count(F.lit(1)).alias("n"))


query("snk_modes", "SELECT ord, CASE WHEN ord % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS n FROM fx_leads")(_modes)


def _csv20(t):
    path = folder(t, "csv20")
    S.csv20(_with_org(t), ("ord",)).write.option("header", True).csv(path)
    back = t.spark.read.option("header", True).csv(path)
    assert tuple(back.columns[1:]) == S.CSV20
    return back.select(F.col("ord").cast("long").alias("ord"), *[X.blank_if_null(F.col(c)).alias(c) for c in S.CSV20])


_C20 = {"company_name": _NAME, "casual_org_name": "'casual ' || ord", "company_website": "CASE WHEN own_site <> '' THEN own_site ELSE 'https://fallback.example' END", "company_phone": "CASE WHEN company_phone <> '' THEN company_phone ELSE '+000' END", "company_summary": "''", "icebreaker": "''"}
_TWENTY = "first_name, last_name, name, title, email, email_status, linkedin_url, city, country, company_name, casual_org_name, company_website, company_linkedin, company_phone, company_domain, company_country, industry, company_summary, icebreaker, source".split(", ")
query("snk_csv20", f"SELECT ord, {', '.join(f'{_C20.get(c, c)} AS {c}' for c in _TWENTY)} FROM ({_ORG})")(_csv20)
_blank = lambda c: f"CASE WHEN coalesce({c}::VARCHAR, '') IN ('0', '0.0', 'false') THEN '' WHEN {c}::VARCHAR = 'true' THEN 'True' ELSE coalesce({c}::VARCHAR, '') END AS {c}"
query(
    "snk_outreach10",
    """SELECT ord, CASE WHEN ord % 5 = 0 THEN 'one@x.lv' ELSE emails[1] END AS email, business_name AS company_name, coalesce(casual_name, business_name) AS casual_name, insight_lv AS icebreaker, niche, city, coalesce(overall_score::VARCHAR, '') AS score, segment_id AS segment, website, phone
    FROM fx_business WHERE ord % 5 = 0 OR ord % 5 > 1""",
)(lambda t: S.outreach10(t("fx_business").withColumns({"emails": F.when(F.col("ord") % 5 > 1, F.col("emails")).when(F.col("ord") % 5 == 1, F.array().cast("array<string>")), "email_1": F.lit("one@x.lv")}), ("ord",)))
query("snk_calling9", f"SELECT ord, niche, business_name, category, address, city, phone, google_maps_url, {_blank('rating')}, {_blank('review_count')} FROM fx_business")(lambda t: S.calling9(t("fx_business"), ("ord",)))
query(
    "snk_email24",
    f"""SELECT ord, niche, business_name, category, address, city, phone, website, coalesce(emails[1], '') AS email_1, coalesce(emails[2], '') AS email_2, coalesce(facebook, '') AS facebook, instagram, coalesce(linkedin, '') AS linkedin, google_maps_url,
    {', '.join(map(_blank, ('rating', 'review_count', 'overall_score', 'performance_score', 'seo_score', 'is_mobile_friendly', 'has_ssl')))}, coalesce(cms, '') AS cms, {', '.join(f"coalesce(insights[{i}], '') AS insight_{i}" for i in (1, 2, 3))} FROM fx_business""",
)(lambda t: S.email24(t("fx_business"), ("ord",)))


def _fan(t):
    return S.fan_out(t("fx_places").select("ord", F.concat(F.lit("Best "), "niche").alias("niche")), folder(t, "fan"))


query("snk_fanout", "SELECT 'best_' || niche AS niche_safe, count(*) AS rows FROM fx_places GROUP BY 1")(_fan)
# A place may be called 0 or false: only numbers and truth values are blanked.
_odd = lambda t: t("fx_business").withColumn("category", F.when(F.col("ord") % 8 == 0, "0").when(F.col("ord") % 8 == 1, "false").when(F.col("ord") % 8 == 2, "true").otherwise(F.col("category")))
query("snk_place10", f"SELECT ord, '2026-01-02' AS scraped_at, niche, business_name, CASE ord % 8 WHEN 0 THEN '0' WHEN 1 THEN 'false' WHEN 2 THEN 'true' ELSE category END AS category, address, city, phone, google_maps_url, {_blank('rating')}, {_blank('review_count')} FROM fx_business")(lambda t: S.place10(_odd(t), F.lit("2026-01-02"), ("ord",)))
query("snk_place34", f"SELECT * REPLACE ({', '.join(map(_blank, ('rating', 'review_count', 'pages_scraped', 'search_enriched')))}) FROM ({_LEAD34})")(lambda t: S.place34(_leads34(t), ("ord",)))


def _scores(t):
    scores = t("fx_leads").filter("industry <> ''").select("industry").distinct().withColumn("score", F.when(F.col("industry") < "F", "relevant").otherwise("maybe"))
    return S.write_scores(scores, folder(t, "scores"), "run-1")


query("snk_scores", "SELECT CASE WHEN industry < 'F' THEN 'relevant' ELSE 'maybe' END AS score, count(DISTINCT industry) AS n FROM fx_leads WHERE industry <> '' GROUP BY 1")(_scores)
query("snk_cleanup", "SELECT page_id, trim(html[1:150], ' ') AS company_summary FROM pages")(lambda t: S.cleaned(t("pages"), ("html", "url"), "html"))
# --- pages
query("pg_text")(lambda t: G.with_text(t("pages").select("page_id", "html")))
query("pg_text_sections")(lambda t: G.with_text(t("pages").select("page_id", "html"), G.SECTION_RULES))
query("pg_status", "SELECT page_id, CASE WHEN page_id % 10 = 9 THEN 'http_404' WHEN length(html) < 50 THEN 'no_content' ELSE 'success' END AS status FROM pages")(lambda t: t("pages").select("page_id", G.page_status(F.col("html"), F.when(F.col("page_id") % 10 == 9, 404).otherwise(200)).alias("status")))
_host = r"regexp_extract(url, '://([^/?#]*)', 1)"
_SECTION = "CASE WHEN contains(url, '/en') THEN 1 WHEN contains(url, '/fr') THEN 2 WHEN contains(url, '/de') THEN 3 END"
query(
    "pg_site_rollup",
    f"""SELECT site, string_agg(t, chr(10) ORDER BY section) AS content FROM (SELECT site, section, substr(t, 1, (10000 - before)::INT) AS t FROM (SELECT *, coalesce(sum(length(t)) OVER (PARTITION BY site ORDER BY section ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (
    SELECT right({_host}, 12) AS site, {_SECTION} AS section, arg_min(substr(html, 1, 3000), page_id) AS t FROM pages WHERE {_SECTION} IS NOT NULL GROUP BY 1, 2)) WHERE before < 10000) GROUP BY site""",
)(
    lambda t: G.site_rollup(
        t("pages").withColumn("site", F.right(F.try_parse_url("url", F.lit("HOST")), F.lit(12))), "site", F.when(F.contains("url", F.lit("/en")), 1).when(F.contains("url", F.lit("/fr")), 2).when(F.contains("url", F.lit("/de")), 3), "html", "page_id"
    )
)
query(
    "pg_contact_links",
    rf"""WITH h AS (SELECT page_id, {_host} AS host, regexp_extract_all(html, 'href=["'']([^"''#?]+)', 1) AS hs FROM pages), l AS (SELECT page_id, host, unnest(hs) AS href, generate_subscripts(hs, 1) AS pos FROM h),
    f AS (SELECT page_id, host, href, pos, CASE WHEN starts_with(href, '/') AND NOT starts_with(href, '//') THEN 'https://' || host || href WHEN regexp_matches(href, '^https?://') THEN href END AS link FROM l)
    SELECT page_id, rank, link FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rank FROM (SELECT page_id, link, min(pos) AS pos FROM f WHERE regexp_extract(link, '://([^/?#]*)', 1) = host AND EXISTS (SELECT 1 FROM cfg_contact_path WHERE contains(lower(href), pattern)) GROUP BY 1, 2)) WHERE rank <= 5""",
)(lambda t: G.contact_links(t("pages"), t("cfg_contact_path")))
query("pg_contacts", r"""SELECT page_id, array_to_string(list_sort(list_distinct(regexp_extract_all(html, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}'))), '|') AS emails, array_to_string(list_sort(list_distinct(regexp_extract_all(html, 'tel:([+0-9() -]{6,20})', 1))), '|') AS phones FROM pages""")(
    lambda t: G.contacts(t("pages")).select("page_id", F.array_join(F.array_sort("emails"), "|").alias("emails"), F.array_join(F.array_sort("phones"), "|").alias("phones"))
)
query(
    "pg_bundle",
    f"""SELECT site, substr(string_agg(CASE WHEN kind = 0 THEN '== main ==' ELSE '== page ==' END || chr(10) || html, chr(10) ORDER BY r), 1, 50000) AS bundle FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY kind, page_id) AS r FROM (SELECT right({_host}, 12) AS site, CASE WHEN contains(url, '/en') THEN 0 ELSE 1 END AS kind, page_id, html FROM pages)) WHERE r <= 6 GROUP BY site""",
)(lambda t: G.bundle(t("pages").withColumn("site", F.right(F.try_parse_url("url", F.lit("HOST")), F.lit(12))), "site", F.contains("url", F.lit("/en")), "html", "page_id"))
_SYSTEMS = [("WordPress", r"""/wp-content/|/wp-includes/|wp-json|<meta\s+name=["'']generator["'']\s+content=["'']WordPress"""), ("Shopify", r"cdn\.shopify\.com|Shopify\.theme"), ("Squarespace", r"squarespace\.com|data-squarespace"), ("Wix", r"static\.wixstatic\.com|X-Wix-"), ("Weebly", r"weebly\.com|weebly-footer"), ("Google Sites", r"sites\.google\.com|googleusercontent\.com/site"), ("Webflow", r"webflow\.com|data-wf-"), ("Ghost", r"ghost\.org|ghost-api"), ("Joomla", r"joomla|/administrator/"), ("Drupal", r"drupal\.org|Drupal\.settings")]
_LIBRARIES = [("Next.js", r"__NEXT_DATA__|_next/static"), ("Nuxt.js", r"__NUXT__|_nuxt/"), ("React", r"data-reactroot|react-dom"), ("Angular", r"ng-version|angular\.js"), ("Vue.js", r"data-v-[a-f0-9]|Vue\.config"), ("Svelte", r"svelte-|__svelte")]
_case = lambda c, ps: "coalesce(CASE " + " ".join(f"WHEN regexp_matches({c}, '(?i){p}') THEN '{n}'" for n, p in ps) + " END, '')"
_MARKS = ["<link href=''/wp-content/a.css''>", "<script src=''https://cdn.shopify.com/x.js''>", "<div data-v-1f>", "<script id=__NEXT_DATA__>", "<div data-reactroot>", "svelte-abc", "see squarespace.com", "plain reactive words about vue and joomlas"]
_TECH = "SELECT page_id, CASE page_id % 11 " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(_MARKS)) + " ELSE html END AS h, CASE page_id % 6 WHEN 1 THEN 'Ghost-API' WHEN 2 THEN 'PHP' END AS powered, CASE page_id % 4 WHEN 0 THEN 'nginx' WHEN 1 THEN 'apache' END AS server FROM pages"


def _tech(t):
    mark = F.col("html")
    for i, m in enumerate(_MARKS):
        mark = F.when(F.col("page_id") % 11 == i, m.replace("''", "'")).otherwise(mark)
    n = F.col("page_id")
    pairs = [F.when(n % 4 == 0, F.struct(F.lit("server").alias("key"), F.lit("nginx").alias("value"))), F.when(n % 4 == 1, F.struct(F.lit("Server").alias("key"), F.lit("apache").alias("value"))), F.when(n % 6 == 1, F.struct(F.lit("X-Powered-By").alias("key"), F.lit("Ghost-API").alias("value"))), F.when(n % 6 == 2, F.struct(F.lit("x-powered-by").alias("key"), F.lit("PHP").alias("value")))]
    return G.technology(t("pages").withColumns({"html": mark, "headers": F.map_from_entries(F.array_compact(F.array(*pairs)))}), headers="headers")


query("pg_tech", f"SELECT page_id, {_case("(h || ' ' || coalesce(powered, ''))", _SYSTEMS)} AS cms, {_case('h', _LIBRARIES)} AS framework, coalesce(server, '') AS server FROM ({_TECH})")(_tech)
query("pg_ssl", "SELECT page_id, starts_with(url, 'https') AS ssl FROM pages")(lambda t: t("pages").select("page_id", G.is_ssl(F.col("url")).alias("ssl")))


# --- the stream
def _stream(t):
    landing, sink = folder(t, "landing"), folder(t, "sink")
    t("events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day")).repartitionByRange(6, "day").write.parquet(landing)
    I.append_new(t.spark, landing, "event_id long, user_id long, event_type string, day date", sink, folder(t, "state"), lambda d: d.select("user_id", "event_type"), I.user_key, 2, parts=8)
    return I.sink_table(t.spark, sink).select("user_id", "event_type")


query("stm_incremental", "SELECT DISTINCT user_id, event_type FROM events")(_stream)


# --- enrichment
def _model(key: str) -> str | None:
    """Stands for a caller's service: fails for some keys, has nothing for others."""
    if key.endswith("7"):
        raise TimeoutError("no answer")
    return None if key.endswith("3") else key.upper()


_needing = lambda t: t("fx_leads").withColumn("casual", F.when(F.col("ord") % 4 == 0, "kept"))
_KEY = "company_name"
query(
    "enr_apply",
    "SELECT ord, CASE WHEN ord % 4 = 0 THEN 'kept' WHEN company_name = '' OR regexp_matches(company_name, '[37]$') THEN '' ELSE upper(company_name) END AS casual, CASE WHEN ord % 4 = 0 OR company_name = '' OR regexp_matches(company_name, '[37]$') THEN '' ELSE 'model' END AS by FROM fx_leads",
)(lambda t: E.enriched(_needing(t), L.needs_value("casual", F.col(_KEY)), _KEY, "casual", _model, "model", answers=folder(t, "answers")).select("ord", X.blank_if_null(F.col("casual")).alias("casual"), X.blank_if_null(F.col("casual_by")).alias("by")))
query("enr_retry", "SELECT DISTINCT 'k' || c_custkey AS key, CASE WHEN c_custkey % 10 = 7 THEN 'TimeoutError: no answer' ELSE '' END AS error FROM customer")(lambda t: E.looked_up(t("customer").select(F.concat(F.lit("k"), F.col("c_custkey").cast("string")).alias("k")), "k", _model).select("key", X.blank_if_null(F.col("error")).alias("error")))
query(
    "enr_fallback",
    "SELECT ord, CASE WHEN ord % 4 = 0 THEN 'kept' WHEN company_name = '' THEN '' WHEN regexp_matches(company_name, '[37]$') THEN lower(company_name) ELSE upper(company_name) END AS casual, CASE WHEN ord % 4 = 0 OR company_name = '' THEN '' WHEN regexp_matches(company_name, '[37]$') THEN 'fallback' ELSE 'model' END AS by FROM fx_leads",
)(lambda t: E.enriched(_needing(t), L.needs_value("casual", F.col(_KEY)), _KEY, "casual", _model, "model", fallback=F.lower(_KEY)).select("ord", X.blank_if_null(F.col("casual")).alias("casual"), X.blank_if_null(F.col("casual_by")).alias("by")))
query("enr_prompt", "SELECT ord, 'Say one line about ' || company_name || ' to ' || first_name || '.' AS prompt FROM fx_leads")(lambda t: t("fx_leads").select("ord", E.prompt("Say one line about {company} to {who}.", company=F.col("company_name"), who=F.col("first_name")).alias("prompt")))
def _checked(t):
    """Each e-mail was checked for each lead that has it, in its spelling; the last answer is the valid one, or an error."""
    email = F.lower("email")
    last = F.when(F.contains(email, F.lit("7@")), "error").otherwise("valid")
    answers = t("fx_leads").filter("email <> ''").select("email", F.explode(F.array(F.struct(F.lit("unknown").alias("status"), F.lit(1).alias("nth")), F.struct(last.alias("status"), F.lit(2).alias("nth")))).alias("a"))
    return E.email_status(t("fx_leads"), answers.select("email", "a.*"), order=("nth",)).select("ord", "email_status")


query("enr_email_status", "SELECT ord, CASE WHEN email = '' THEN 'missing' WHEN contains(lower(email), '7@') THEN 'verification_failed' ELSE 'valid' END AS email_status FROM fx_leads")(_checked)


# --- the flagship
def flagship(t):
    """Feed B normalised, junk dropped, merged by e-mail, with an e-mail, counted by country."""
    from ..operators import dedup, profiles

    leads = N.vendor_b(t("fx_feed_b"), ("ord",))
    merged = dedup.merged_by_email(leads.filter(~L.is_junk(F.col("name"))))
    return profiles.top_counts(merged.filter(L.has_email(F.col("email"))), {"country": (F.col("country"), None)})


query(
    "flagship",
    _MERGE.replace("FROM fx_leads", f"FROM ({_LEAD_B} WHERE NOT contains(name, 'Scanning pages'))").replace(f"SELECT ord, {_COLS} FROM m QUALIFY", f"SELECT 'country' AS field, value, n, rank FROM (SELECT *, row_number() OVER (ORDER BY n DESC, first) AS rank FROM (SELECT CASE WHEN country = '' THEN 'EMPTY' ELSE country END AS value, count(*) AS n, min(ord) AS first FROM (SELECT ord, {_COLS} FROM m QUALIFY")
    + ") WHERE email <> '' GROUP BY 1))",
)(flagship)
