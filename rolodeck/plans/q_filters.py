"""Queries of filters, filter chains and presets."""

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import classify, filters as L
from .registry import query

_PASS = {
    "email": "email <> ''",
    "phone_code": "starts_with(company_phone, '+371') OR starts_with(company_phone, '+49')",
    "title": "lower(title) = '' OR NOT (regexp_matches(lower(title), 'intern|trainee|student|assistant|junior') OR (regexp_matches(lower(title), 'designer?|design') AND NOT regexp_matches(lower(title), 'design director|head of design')))",
    "industry_in": "lower(industry) IN ('building', 'machinery', 'household', 'furniture')",
    "industry_out": "lower(industry) NOT IN ('furniture')",
    "country": "lower(CASE WHEN country <> '' THEN country ELSE company_country END) IN ('latvia', 'germany', 'estonia')",
    "website": "company_website <> '' OR company_domain <> ''",
}
_TLD = "CASE WHEN ends_with(company_domain, '.co.uk') THEN '.co.uk' WHEN contains(company_domain, '.') THEN '.' || string_split(company_domain, '.')[-1] ELSE '' END"
_COUNTRY = "lower(CASE WHEN country <> '' THEN country ELSE company_country END)"
_COUNTRY_L = "lower(CASE WHEN l.country <> '' THEN l.country ELSE l.company_country END)"
_RULES = f"""SELECT l.*, (SELECT count(*) FROM cfg_foreign f WHERE f.country = {_COUNTRY_L} AND f.tld = {_TLD}) = 0 AS tld_ok,
  coalesce((SELECT company_phone = '' OR starts_with(company_phone, code) FROM cfg_phone p WHERE p.country = {_COUNTRY_L}), true) AS phone_ok FROM fx_leads l"""


def _keep(name, sql, predicate):
    query(name, f"SELECT ord FROM fx_leads WHERE {sql}")(lambda t: t("fx_leads").filter(predicate(t("fx_leads"))).select("ord"))


_keep("flt_junk", "NOT contains(name, 'Scanning pages')", lambda d: ~L.is_junk(F.col("name")))
_keep("flt_invalid", "NOT contains(name, 'Scanning pages') AND (name <> '' OR email <> '')", lambda d: L.valid(F.col("name"), F.col("email")))
_keep("flt_email", _PASS["email"], lambda d: L.has_email(F.col("email")))
_keep("flt_phone_code", "starts_with(company_phone, '+371')", lambda d: L.phone_has_code(L.own(d.columns, L.PHONES), "371"))
_keep("flt_title_exclude", _PASS["title"], lambda d: L.title_allowed(F.col("title")))
_keep("flt_industry_in", _PASS["industry_in"], lambda d: L.in_industries(d, ["Building", "MACHINERY", "household", "furniture"]))
_keep("flt_industry_out", _PASS["industry_out"], lambda d: ~L.in_industries(d, ["Furniture"]))
_keep("flt_country", f"{_COUNTRY} = 'latvia'", lambda d: F.lower(L.lead_country(d.columns)) == "latvia")
_keep("flt_website", _PASS["website"], lambda d: L.has_website(d.columns))
_rules = lambda t: L.with_country_rules(t("fx_leads"), t("cfg_foreign"), t("cfg_phone"))
query("flt_foreign_tld", f"SELECT ord FROM ({_RULES}) WHERE tld_ok")(lambda t: (d := _rules(t)).filter(L.not_foreign_tld(d.columns, [".co.uk"])).select("ord"))
query("flt_phone_country", f"SELECT ord FROM ({_RULES}) WHERE phone_ok")(lambda t: (d := _rules(t)).filter(L.phone_of_country(d.columns)).select("ord"))
_STAGES = [*_PASS, "foreign_tld", "phone_country"]


def _chain(t):
    d = _rules(t)
    stages = {
        "email": L.has_email(F.col("email")),
        "phone_code": L.phone_has_code(L.own(d.columns, L.PHONES), "371") | L.phone_has_code(L.own(d.columns, L.PHONES), "+49"),
        "title": L.title_allowed(F.col("title")),
        "industry_in": L.in_industries(d, ["Building", "Machinery", "Household", "Furniture"]),
        "industry_out": ~L.in_industries(d, ["Furniture"]),
        "country": F.lower(L.lead_country(d.columns)).isin("latvia", "germany", "estonia"),
        "website": L.has_website(d.columns),
        "foreign_tld": L.not_foreign_tld(d.columns, [".co.uk"]),
        "phone_country": L.phone_of_country(d.columns),
    }
    return L.tagged(d, list(stages.items()))


_TAGGED = f"SELECT *, CASE {' '.join(f"WHEN NOT ({p}) THEN '{s}'" for s, p in {**_PASS, 'foreign_tld': 'tld_ok', 'phone_country': 'phone_ok'}.items())} END AS first_failed FROM ({_RULES})"
query("flt_chain", f"SELECT ord, coalesce(first_failed, 'kept') AS outcome FROM ({_TAGGED})")(lambda t: _chain(t).select("ord", F.coalesce("first_failed", F.lit("kept")).alias("outcome")))
_POSITION = "CASE first_failed " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(_STAGES, 1)) + " END"
query(
    "win_stage_before",
    f"""SELECT stage, position, CAST(total - coalesce(sum(n) OVER (ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before, n AS removed, CAST(total - sum(n) OVER (ORDER BY position) AS BIGINT) AS after
    FROM (SELECT first_failed AS stage, {_POSITION} AS position, count(*) AS n, (SELECT count(*) FROM fx_leads) AS total FROM ({_TAGGED}) WHERE first_failed IS NOT NULL GROUP BY first_failed)""",
)(lambda t: L.stage_report(_chain(t), _STAGES))
query(
    "flt_chain_top_removed",
    f"""SELECT stage, value, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY n DESC, first) AS rank FROM (
    SELECT first_failed AS stage, CASE first_failed WHEN 'title' THEN title WHEN 'industry_in' THEN industry WHEN 'country' THEN country ELSE company_phone[1:4] END AS value, count(*) AS n, min(ord) AS first FROM ({_TAGGED}) WHERE first_failed IS NOT NULL GROUP BY 1, 2)) WHERE rank <= 10""",
)(lambda t: L.top_removed(_chain(t), {s: {"title": F.col("title"), "industry_in": F.col("industry"), "country": F.col("country")}.get(s, F.substring("company_phone", 1, 4)) for s in _STAGES}, 10))
_keep("flt_titles_in", "lower(title) = '' OR contains(lower(title), 'ceo') OR contains(lower(title), 'sales')", lambda d: L.contains_any(F.col("title"), ["CEO", "sales"], True))
_keep("flt_seniority", "title = '' OR regexp_matches(lower(title), '\\b(ceo|founder|chief|head of)\\b')", lambda d: (X.key(F.col("title")) == "") | F.arrays_overlap(classify.seniority(F.col("title")), F.array(*map(F.lit, ["c_suite", "founder", "head"]))))
_keep("flt_person_loc", "contains(lower(city || ' ' || country), 'latvia') OR contains(lower(city || ' ' || country), 'berlin')", lambda d: L.contains_any(F.concat_ws(" ", "city", "country"), ["Latvia", "berlin"], False))
_keep("flt_org_loc", "contains(lower(company_country || ' ' || country), 'germany')", lambda d: L.contains_any(F.concat_ws(" ", "company_country", "country"), ["Germany"], False))
_keep("flt_industry_sub", "industry = '' OR contains(lower(industry), 'mach') OR contains(lower(industry), 'build')", lambda d: L.contains_any(F.col("industry"), ["mach", "BUILD"], True))
query(
    "flt_enforce",
    """SELECT source, coalesce(CASE WHEN source IN ('feed_c') AND NOT (lower(title) = '' OR contains(lower(title), 'ceo')) THEN 'titles' WHEN source IN ('feed_b', 'feed_c') AND NOT (industry = '' OR contains(lower(industry), 'mach')) THEN 'industry' END, 'kept') AS outcome, count(*) AS n FROM fx_leads GROUP BY 1, 2""",
)(lambda t: L.enforced(t("fx_leads"), t("cfg_source_filter"), {"titles": L.contains_any(F.col("title"), ["ceo"], True), "industry": L.contains_any(F.col("industry"), ["mach"], True)}).groupBy("source", F.coalesce("first_failed", F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("n")))
_LAST = "(SELECT arg_max({0}, nth) FROM cfg_score s WHERE {1})"
_REL = f"SELECT l.*, coalesce({_LAST.format('score', 's.industry = l.industry')}, {_LAST.format('score', 'lower(s.industry) = lower(l.industry)')}) AS relevance, coalesce({_LAST.format('reason', 'lower(s.industry) = lower(l.industry)')}, '') AS why FROM fx_leads l"
query("flt_relevance", f"SELECT ord, coalesce(relevance, '') AS relevance, why AS reason, coalesce(relevance IN ('relevant', 'maybe'), true) OR industry = '' AS kept FROM ({_REL})")(
    lambda t: L.by_relevance(t("fx_leads"), t("cfg_score"), True, order=("nth",)).select("ord", X.blank_if_null(F.col("relevance")).alias("relevance"), X.blank_if_null(F.col("reason")).alias("reason"), "kept")
)
query("snk_rejects", f"SELECT CASE WHEN coalesce(relevance = 'relevant', true) OR industry = '' THEN 'accepted' ELSE 'rejected' END AS status, why AS _removal_reason, count(*) AS n FROM ({_REL}) GROUP BY 1, 2")(
    lambda t: L.by_relevance(t("fx_leads"), t("cfg_score"), False, order=("nth",)).groupBy(F.when(F.col("kept"), "accepted").otherwise("rejected").alias("status"), X.blank_if_null(F.col("reason")).alias("_removal_reason")).agg(F.count(F.lit(1)).alias("n"))
)
query("flt_no_website", "SELECT ord FROM fx_places WHERE website IS NULL OR website = ''")(lambda t: t("fx_places").filter(~X.present(X.blank_if_null(F.col("website")))).select("ord"))
_keep("flt_needs_industry", "industry = ''", lambda d: L.needs_industry())
_keep("flt_needs_email", "email = '' OR email_status IN ('missing', 'invalid', 'verification_failed')", lambda d: L.needs_email())
query("flt_needs_profile", "SELECT ord FROM fx_profiles WHERE linkedin_url <> '' AND bio IS NULL")(lambda t: t("fx_profiles").filter(L.needs_profile()).select("ord"))
query("flt_needs_casual", "SELECT ord FROM fx_leads WHERE company_name <> '' AND ord % 2 = 0")(lambda t: t("fx_leads").withColumn("casual", F.when(F.col("ord") % 2 == 1, "x")).filter(L.needs_value("casual", F.col("company_name"))).select("ord"))
query("flt_needs_icebreaker", "SELECT ord FROM fx_leads WHERE company_website <> '' AND ord % 3 <> 0")(lambda t: t("fx_leads").withColumn("icebreaker", F.when(F.col("ord") % 3 == 0, "x")).filter(L.needs_value("icebreaker", F.col("company_website"))).select("ord"))
query("flt_needs_summary", "SELECT page_id AS ord FROM pages WHERE html <> '' AND page_id % 4 <> 0")(lambda t: t("pages").withColumn("summary", F.when(F.col("page_id") % 4 == 0, "x")).filter(L.needs_value("summary", F.col("html"))).select(F.col("page_id").alias("ord")))
query("flt_match_all", "SELECT count(*) AS rows, CAST(sum(h::INT) AS BIGINT) AS matched, avg(h::INT) AS share FROM (SELECT (contains(lower(title), 'ceo') OR contains(lower(title), 'head')) AND (contains(lower(country), 'latvia') OR contains(lower(country), 'est')) AS h FROM fx_leads)")(lambda t: L.match_all(t("fx_leads"), {"title": ["CEO", "head"], "country": ["Latvia", "est"], "industry": []}))
query(
    "flt_match_any",
    "SELECT count(*) AS rows, CAST(sum(h::INT) AS BIGINT) AS matched, avg(h::INT) AS share, avg(h::INT) >= 0.8 AS passed, (SELECT string_agg(ord, ',' ORDER BY ord) FROM (SELECT ord FROM fx_leads WHERE NOT (contains(lower(title), 'ceo') OR contains(lower(industry), 'build')) ORDER BY ord LIMIT 3)) AS sample FROM (SELECT contains(lower(title), 'ceo') OR contains(lower(industry), 'build') AS h FROM fx_leads)",
)(lambda t: L.match_any(t("fx_leads"), ["title", "industry"], ["CEO", "build"]))
