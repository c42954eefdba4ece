"""Queries of profiles, windows and set operations, classes, scores and segments."""

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import classify as C, filters as L, joins as J, profiles as P, sets as S
from .q_filters import _REL
from .q_joins import _KEPT
from .registry import query

_pct = lambda a, b: f"coalesce(round_even(100.0 * {a} / {b}, 1), 0)"
query(
    "agg_coverage",
    " UNION ALL ".join(f"SELECT '{k}' AS field, count(*) FILTER ({c} <> '') AS has, count(*) FILTER ({c} = '') AS missing, {_pct(f"count(*) FILTER ({c} <> '')", 'count(*)')} AS share FROM fx_leads" for k, c in (("email", "email"), ("phone", "company_phone"), ("profile", "linkedin_url"))),
)(lambda t: P.coverage(t("fx_leads"), {"email": F.col("email"), "phone": F.col("company_phone"), "profile": F.col("linkedin_url")}))
_top = lambda f, v, k: f"SELECT '{f}' AS field, value, n, rank FROM (SELECT *, row_number() OVER (ORDER BY n DESC, first) AS rank FROM (SELECT CASE WHEN trim({v}) = '' THEN 'EMPTY' ELSE {v} END AS value, count(*) AS n, min(ord) AS first FROM fx_leads GROUP BY 1)) WHERE rank <= {k}"
query("agg_phone_codes", "SELECT 'code' AS field, value, n, rank FROM (SELECT *, row_number() OVER (ORDER BY n DESC, first) AS rank FROM (SELECT CASE WHEN company_phone = '' THEN 'no_code' WHEN starts_with(company_phone, '+371') THEN '+371' ELSE company_phone[1:3] END AS value, count(*) AS n, min(ord) AS first FROM fx_leads GROUP BY 1)) WHERE rank <= 10")(
    lambda t: P.top_counts(t("fx_leads"), {"code": (X.phone_code(F.col("company_phone"), ["371", "372", "49", "44", "1"]), 10)})
)
query("agg_value_counts", " UNION ALL ".join(_top(f, f, k) for f, k in (("country", 10), ("city", 15), ("title", 25), ("industry", 1000000), ("company_name", 10))))(
    lambda t: P.top_counts(t("fx_leads"), {"country": (F.col("country"), 10), "city": (F.col("city"), 15), "title": (F.col("title"), 25), "industry": (F.col("industry"), None), "company_name": (F.col("company_name"), 10)})
)
query("win_topk_counts", _top("company_name", "company_name", 10))(lambda t: P.top_counts(t("fx_leads"), {"company_name": (F.col("company_name"), 10)}))
query("agg_unique_counts", "SELECT 'city' AS field, count(DISTINCT city) AS n FROM fx_leads UNION ALL SELECT 'company', count(DISTINCT company_name) FROM fx_leads")(lambda t: P.distinct_counts(t("fx_leads"), {"city": F.col("city"), "company": F.col("company_name")}))
_CLASSES = [("C-Level", r"\b(ceo|cfo|cto|coo|cmo|cio|cpo|chief)\b"), ("VP / SVP", r"\b(vp|vice president|svp)\b"), ("Director", r"\bdirector\b"), ("Head of", r"\bhead of\b|\bhead\b"), ("Manager", r"\bmanager\b|\bmanaging\b"), ("Owner / Founder", r"\b(owner|founder|co-founder|partner|principal)\b"), ("Board / Chair", r"\b(board|chairman|chairwoman|chairperson|member of the board)\b"), ("Specialist / Expert", r"\b(specialist|expert|advisor|consultant)\b"), ("Coordinator", r"\bcoordinator\b"), ("Analyst", r"\banalyst\b"), ("Engineer / Developer", r"\b(engineer|developer|programmer|devops|architect)\b")]
_CLASS = "CASE WHEN title = '' THEN 'No title' " + " ".join(f"WHEN regexp_matches(lower(title), '{p}') THEN '{k}'" for k, p in _CLASSES) + " ELSE 'Other IC' END"
query(
    "agg_title_categories",
    f"SELECT 'class' AS kind, {_CLASS} AS value, count(*) AS n FROM fx_leads GROUP BY 2 UNION ALL SELECT 'other', title, n FROM (SELECT title, count(*) AS n, min(ord) AS first FROM fx_leads WHERE {_CLASS} = 'Other IC' GROUP BY 1 ORDER BY n DESC, first LIMIT 15)",
)(lambda t: P.title_classes(t("fx_leads")))
query("win_priority_pick", f"SELECT ord, {_CLASS} AS class FROM fx_leads")(lambda t: t("fx_leads").select("ord", C.title_class(F.col("title")).alias("class")))
query(
    "agg_expected_country",
    "SELECT word, code AS phone_code, (SELECT count(*) FROM fx_leads WHERE starts_with(company_phone, code)) AS leads FROM (SELECT DISTINCT w.word FROM cfg_country_word w JOIN fx_leads l ON regexp_matches(lower(l.city || ' ' || l.country), '\\b' || w.word || '\\b')) x JOIN cfg_phone p ON p.country = x.word",
)(lambda t: P.expected_countries(t("fx_leads"), t("fx_leads").select(F.concat_ws(" ", "city", "country").alias("location")), t("cfg_country_word"), t("cfg_phone")))
query(
    "agg_recommend",
    f"SELECT * FROM (SELECT 1 AS place, 'email' AS filter, count(*) FILTER (email = '') AS removed FROM fx_leads UNION ALL SELECT 2, 'phone', count(*) FILTER (NOT starts_with(company_phone, '+371') AND NOT starts_with(company_phone, '+49')) FROM fx_leads UNION ALL SELECT 3, 'individual', count(*) FILTER ({_CLASS} IN ('Specialist / Expert', 'Coordinator', 'Analyst', 'Engineer / Developer', 'Other IC', 'No title')) FROM fx_leads) WHERE removed > 0 UNION ALL SELECT 4, 'industry', -1",
)(lambda t: P.recommendations(t("fx_leads"), ["+371", "+49"], ["371", "372", "49", "44", "1"]).withColumn("removed", F.coalesce("removed", F.lit(-1))))
query("agg_approval", f"SELECT CASE WHEN industry = '' THEN 'EMPTY' ELSE industry END AS industry, count(*) AS total, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS removed, {_pct('count(*) FILTER (kept)', 'count(*)')} AS approval FROM ({_KEPT}) GROUP BY 1")(lambda t: P.approval(J.kept_or_removed(t("fx_leads"), t("fx_reviewed"))))
query("agg_email_status", f"SELECT CASE WHEN email = '' THEN 'missing' ELSE email_status END AS status, count(*) AS n, {_pct('count(*)', '(SELECT count(*) FROM fx_leads)')} AS share FROM fx_leads GROUP BY 1")(lambda t: P.shares(t("fx_leads"), F.when(F.col("email") == "", "missing").otherwise(F.col("email_status")), "status"))
query(
    "agg_quality_report",
    "SELECT s AS stage, count(*) AS rows, count(*) FILTER (email <> '') AS with_email, count(*) FILTER (email_status IN ('verified', 'deliverable')) AS deliverable, count(DISTINCT source) AS sources FROM (SELECT 'raw' AS s, * FROM fx_leads UNION ALL SELECT 'reachable', * FROM fx_leads WHERE email <> '') GROUP BY 1",
)(lambda t: P.stages({"raw": t("fx_leads"), "reachable": t("fx_leads").filter("email <> ''")}))
query("agg_enrich_stats", "SELECT CASE WHEN industry = '' THEN '' ELSE 'codes' END AS industry_source, CASE WHEN industry = '' THEN 'no_data' ELSE '' END AS industry_error, count(*) AS n FROM fx_leads GROUP BY 1, 2")(
    lambda t: t("fx_leads").groupBy(F.when(L.needs_industry(), "").otherwise("codes").alias("industry_source"), F.when(L.needs_industry(), "no_data").otherwise("").alias("industry_error")).agg(F.count(F.lit(1)).alias("n"))
)
query("agg_country_dist", "SELECT company_country AS country, count(*) AS n FROM fx_leads WHERE company_country <> '' GROUP BY 1")(lambda t: t("fx_leads").filter("company_country <> ''").groupBy(F.col("company_country").alias("country")).agg(F.count(F.lit(1)).alias("n")))
query(
    "agg_place_coverage",
    "SELECT n, emails, website, phone, 100 * emails // n AS emails_pct, 100 * website // n AS website_pct, 100 * phone // n AS phone_pct FROM (SELECT count(*) AS n, count(*) FILTER (len(emails) > 0) AS emails, count(*) FILTER (website <> '') AS website, count(*) FILTER (phone <> '') AS phone FROM fx_places)",
)(lambda t: P.place_coverage(t("fx_places")))
query("agg_term_test", f"SELECT coalesce(niche, 'all') AS term, count(*) AS total, count(*) FILTER (website <> '') AS with_site, count(*) FILTER (website = '') AS no_site, {_pct("count(*) FILTER (website = '')", 'count(*)')} AS no_site_pct, count(*) FILTER (phone <> '') AS with_phone FROM fx_places GROUP BY ROLLUP (niche)")(lambda t: P.term_report(t("fx_places"), "niche"))
query(
    "agg_term_categories",
    "SELECT term, x.niche IS NOT NULL AS passed, coalesce(x.cs, '') AS categories FROM (SELECT DISTINCT niche AS term FROM fx_places UNION ALL SELECT 'nothing') LEFT JOIN (SELECT niche, string_agg(categoryName, '|' ORDER BY n DESC, first) AS cs FROM (SELECT niche, categoryName, count(*) AS n, min(ord) AS first FROM fx_places GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY niche ORDER BY n DESC, first) <= 3) GROUP BY 1) x ON x.niche = term",
)(lambda t: P.term_categories(t("fx_places"), t("fx_places").select(F.col("niche").alias("term")).distinct().unionByName(t.spark.range(1).select(F.lit("nothing").alias("term"))), "niche", "categoryName"))
_STREAM = "CASE WHEN len(emails) > 0 AND ord % 4 <> 3 THEN 'email' WHEN phone <> '' THEN 'call' ELSE 'none' END"
_stream = lambda: S.stream(F.when(F.col("ord") % 4 != 3, F.col("emails")), F.col("phone"))
query("set_split3", f"SELECT ord, {_STREAM} AS stream FROM fx_places")(lambda t: t("fx_places").select("ord", _stream().alias("stream")))
query("agg_split_summary", f"SELECT {_STREAM} AS stream, website <> '' AS has_web, count(*) AS n FROM fx_places GROUP BY 1, 2")(lambda t: t("fx_places").groupBy(_stream().alias("stream"), (F.col("website") != "").alias("has_web")).agg(F.count(F.lit(1)).alias("n")))
# --- web scores
_VALS = [("performance_score", "performance_score", 0.35), ("is_mobile_friendly", "CASE WHEN is_mobile_friendly THEN 100 WHEN NOT is_mobile_friendly THEN 20 END", 0.20), ("has_ssl", "CASE WHEN has_ssl THEN 100 ELSE 0 END", 0.15), ("seo_score", "seo_score", 0.15), ("best_practices_score", "best_practices_score", 0.15)]
_NUM = "0.0::DOUBLE" + "".join(f" + coalesce(({v})::DOUBLE * {w}::DOUBLE, 0)" for _, v, w in _VALS)
_DEN = "0.0::DOUBLE" + "".join(f" + CASE WHEN ({v}) IS NULL THEN 0 ELSE {w}::DOUBLE END" for _, v, w in _VALS)
_SCORED = f"SELECT *, CAST(trunc(({_NUM}) / nullif({_DEN}, 0)) AS INT) AS score FROM fx_web_eval"
_scored = lambda t: t("fx_web_eval").withColumn("score", C.web_score())
query("scr_web_overall", f"SELECT ord, coalesce(score, -1) AS score FROM ({_SCORED})")(lambda t: _scored(t).select("ord", F.coalesce("score", F.lit(-1)).alias("score")))
_TAKES = "printf('Main content takes %.1f seconds', lcp_seconds)"
_INSIGHTS = f"""list_filter([CASE WHEN lcp_seconds > 4 THEN {_TAKES} WHEN lcp_seconds > 2.5 THEN {_TAKES} || ', 2.5 is good' END, CASE WHEN NOT coalesce(has_ssl, false) THEN 'No secure connection' END, CASE WHEN NOT is_mobile_friendly THEN 'Hard to use on phones' END,
    CASE WHEN performance_score < 40 AND NOT coalesce(lcp_seconds > 4, false) THEN 'Speed score ' || performance_score || ' of 100' END, CASE WHEN seo_score < 60 THEN 'Search score ' || seo_score || ' of 100' END, CASE WHEN cms IS NOT NULL AND score < 50 THEN 'Dated ' || cms || ' site, score ' || score || ' of 100' END], lambda x: x IS NOT NULL)[1:3]"""
query("scr_web_insights", f"SELECT ord, array_to_string({_INSIGHTS}, '|') AS insights FROM ({_SCORED})")(lambda t: _scored(t).select("ord", F.array_join(C.web_insights(F.col("score")), "|").alias("insights")))
query(
    "scr_web_metrics",
    """SELECT p_partkey AS ord, CASE WHEN p_partkey % 6 <> 0 THEN CAST(p_size AS INT) ELSE -1 END AS performance_score, CASE WHEN p_partkey % 6 <> 0 THEN 80 ELSE -1 END AS accessibility_score, CASE WHEN p_partkey % 6 <> 0 THEN 90 ELSE -1 END AS seo_score, -1 AS best_practices_score,
    CASE WHEN p_partkey % 6 <> 0 THEN round_even(p_partkey * 10.0 / 1000, 2)::DOUBLE END AS fcp_seconds, CASE WHEN p_partkey % 6 <> 0 THEN round_even(p_partkey * 20.0 / 1000, 2)::DOUBLE END AS lcp_seconds, CASE WHEN p_partkey % 6 <> 0 THEN 0.125::DOUBLE END AS cls, CASE WHEN p_partkey % 6 <> 0 THEN CAST(p_size AS INT) ELSE -1 END AS tbt_ms,
    CASE WHEN p_partkey % 6 <> 0 THEN round_even(p_partkey * 30.0 / 1000, 2)::DOUBLE END AS speed_index_seconds, CASE WHEN p_partkey % 6 <> 0 THEN p_partkey % 2 = 1 ELSE false END AS is_mobile_friendly FROM part""",
)(
    lambda t: t("part").select(F.col("p_partkey").alias("ord"), C.web_metrics(F.when(F.col("p_partkey") % 6 == 0, F.lit('{"error":{}}')).otherwise(F.format_string(
        '{"lighthouseResult":{"categories":{"performance":{"score":%s},"accessibility":{"score":0.8},"seo":{"score":0.9},"best-practices":{"score":null}},"audits":{"first-contentful-paint":{"numericValue":%s},"largest-contentful-paint":{"numericValue":%s},"cumulative-layout-shift":{"numericValue":0.1250004},"total-blocking-time":{"numericValue":%d.7},"speed-index":{"numericValue":%s},"viewport":{"score":%d}}}}',
        ((F.col("p_size") + 0.5) / 100).cast("string"), (F.col("p_partkey") * 10.0).cast("string"), (F.col("p_partkey") * 20.0).cast("string"), F.col("p_size"), (F.col("p_partkey") * 30.0).cast("string"), F.col("p_partkey") % 2))).alias("m")).select("ord", "m.*").withColumns({c: F.coalesce(c, F.lit(-1)) for c in ("performance_score", "accessibility_score", "seo_score", "best_practices_score", "tbt_ms")} | {"is_mobile_friendly": F.coalesce("is_mobile_friendly", F.lit(False))})
)
def _attached(t):
    """Each site was evaluated twice, with another result the first time."""
    now = t("fx_web_eval")
    twice = now.withColumn("nth", F.lit(2)).unionByName(now.withColumns({"performance_score": F.lit(1), "has_ssl": F.lit(False), "nth": F.lit(1)}))
    leads = t("customer").select(F.col("c_custkey").alias("ord"), F.when(F.col("c_custkey") % 3 != 0, F.format_string("https://site%d.example", 2 * F.col("c_custkey"))).alias("web"))
    return C.with_evaluation(leads, twice, F.col("web"), {"score": C.web_score()}, ("nth",)).select("ord", "web_status", F.coalesce("score", F.lit(-1)).alias("score"))


query(
    "scr_web_attach",
    f"SELECT c_custkey AS ord, CASE WHEN c_custkey % 3 = 0 THEN 'no_website' WHEN e.site IS NULL THEN 'not_evaluated' ELSE 'success' END AS web_status, coalesce(e.score, -1) AS score FROM customer LEFT JOIN ({_SCORED}) e ON c_custkey % 3 <> 0 AND e.site = 'https://site' || (2 * c_custkey) || '.example'",
)(_attached)
query("agg_score_summary", f"SELECT coalesce(cms, 'Unknown') AS cms, count(*) AS sites, count(score) AS scored, coalesce(round_even(avg(score), 1), 0)::DOUBLE AS average, count(*) FILTER (score < 50) AS below_50, coalesce(100 * count(*) FILTER (score < 50) // nullif(count(score), 0), 0) AS below_50_pct FROM ({_SCORED}) GROUP BY 1")(
    lambda t: P.score_summary(_scored(t).withColumn("cms", F.coalesce("cms", F.lit("Unknown"))), F.col("score"), "cms")
)
# From score to segment and message. Some niches are unknown, some written with other letters.
_NICHED = f"SELECT * REPLACE (CASE ord % 10 WHEN 0 THEN NULL WHEN 1 THEN 'būvnieki' ELSE niche END AS niche) FROM ({_SCORED})"
_SEGMENT = "CASE ord % 10 WHEN 0 THEN 'unknown' WHEN 1 THEN 'buvnieki' ELSE niche END || CASE WHEN score >= 70 THEN '_decent' ELSE '_poor' END"
_niched = lambda t: _scored(t).withColumn("niche", F.when(F.col("ord") % 10 == 0, None).when(F.col("ord") % 10 == 1, "būvnieki").otherwise(F.col("niche")))
query("seg_assign", f"SELECT ord, {_SEGMENT} AS segment FROM ({_NICHED})")(lambda t: _niched(t).select("ord", C.segment(F.col("niche"), F.col("score")).alias("segment")))
_SAID = {
    "contains(first, 'takes')": "'I opened ' || shop || ' on my phone and waited ' || regexp_extract(first, 'takes ([0-9.]+) seconds', 1) || ' seconds.'",
    "first = 'No secure connection'": "'My browser warned me of ' || shop || ': the connection is not secure.'",
    "first = 'Hard to use on phones'": "'On my phone the site of ' || shop || ' is hard to use.'",
    "starts_with(first, 'Speed')": "'In a speed test ' || shop || ' got ' || performance_score || ' of 100 points.'",
    "starts_with(first, 'Search')": "'In a search test ' || shop || ' got ' || seo_score || ' of 100 points.'",
    "starts_with(first, 'Dated')": "'Tests gave the site of ' || shop || ' ' || score || ' of 100 points.'",
}
_SHOP = "CASE WHEN ord % 7 = 0 THEN 'the very small shop on the corner of street number ' || ord WHEN ord % 11 = 0 THEN 'Shop — ' || ord ELSE 'Shop ' || ord END"
_MESSAGE = f"SELECT *, CASE {' '.join(f'WHEN {k} THEN {v}' for k, v in _SAID.items())} ELSE 'I had a look at the site of ' || shop || '.' END AS message FROM (SELECT *, {_INSIGHTS}[1] AS first, {_SHOP} AS shop FROM ({_NICHED}))"


def _messages(t):
    n = F.col("ord").cast("string")
    shop = F.when(F.col("ord") % 7 == 0, F.concat(F.lit("the very small shop on the corner of street number "), n)).when(F.col("ord") % 11 == 0, F.concat(F.lit("Shop — "), n)).otherwise(F.concat(F.lit("Shop "), n))
    return _niched(t).withColumn("message", C.message(F.get(C.web_insights(F.col("score")), F.lit(0)), shop))


query("seg_message", f"SELECT ord, message FROM ({_MESSAGE})")(lambda t: _messages(t).select("ord", "message"))
query("agg_segment", f"SELECT coalesce(segment, 'all') AS segment, count(*) AS n, count(*) FILTER (len(string_split(message, ' ')) > 15) AS too_long, count(*) FILTER (contains(message, '—')) AS em_dash FROM (SELECT {_SEGMENT} AS segment, message FROM ({_MESSAGE})) GROUP BY ROLLUP (segment)")(
    lambda t: P.segment_summary(_messages(t), C.segment(F.col("niche"), F.col("score")), "message")
)
_TEXT = "CASE ord % 5 WHEN 0 THEN '' WHEN 1 THEN 'one — two' WHEN 2 THEN 'a b c d e f g h i j k l m n o p q' ELSE 'short text' END"
_said = lambda: F.when(F.col("ord") % 5 == 0, "").when(F.col("ord") % 5 == 1, "one — two").when(F.col("ord") % 5 == 2, "a b c d e f g h i j k l m n o p q").otherwise("short text")
_WARNED = f"SELECT list_filter([CASE WHEN x = '' THEN 'empty' END, CASE WHEN len(string_split(x, ' ')) > 15 THEN 'too_long' END, CASE WHEN contains(x, '—') THEN 'em_dash' END], lambda v: v IS NOT NULL) AS ws FROM (SELECT {_TEXT} AS x FROM fx_leads)"
query("agg_qa", f"SELECT w AS warning, count(*) AS n FROM (SELECT unnest(ws) AS w FROM ({_WARNED})) GROUP BY 1 UNION ALL SELECT 'all warnings', CAST(sum(len(ws)) AS BIGINT) FROM ({_WARNED}) UNION ALL SELECT 'any warning', count(*) FROM ({_WARNED}) WHERE len(ws) > 0")(lambda t: P.warning_counts(t("fx_leads").select("ord", _said().alias("x")), "x"))
query("agg_relevance_report", f"SELECT CASE WHEN industry = '' THEN 'EMPTY' ELSE industry END AS industry, coalesce(relevance, '') AS score, min(why) AS reason, count(*) AS n FROM ({_REL}) GROUP BY 1, 2")(
    lambda t: L.by_relevance(t("fx_leads"), t("cfg_score"), False, order=("nth",)).groupBy(F.when(F.col("industry") == "", "EMPTY").otherwise(F.col("industry")).alias("industry"), X.blank_if_null(F.col("relevance")).alias("score")).agg(F.min(X.blank_if_null(F.col("reason"))).alias("reason"), F.count(F.lit(1)).alias("n"))
)
# --- top-k, sorts, limits
_best = lambda t: P.best_leads(t("fx_profiles").withColumn("bio", F.when(F.col("ord") % 3 == 1, F.repeat(F.lit("b"), 101)).otherwise(F.col("bio"))).join(t("fx_leads").select(F.col("ord").alias("o"), "email"), F.col("ord") == F.col("o")).withColumns({"content": F.repeat(F.lit("x"), (F.col("ord") % 3000).cast("int")), "n_jobs": (F.col("ord") % 4).cast("int")}), 50)
query(
    "topk_best_leads",
    """SELECT p.ord, (CASE WHEN p.ord % 3000 > 2000 THEN 30 WHEN p.ord % 3000 > 500 THEN 15 ELSE 0 END + CASE WHEN p.ord % 3 = 1 THEN 25 WHEN length(bio) > 100 THEN 25 WHEN bio <> '' THEN 10 ELSE 0 END + CASE p.ord % 4 WHEN 3 THEN 25 WHEN 0 THEN 0 ELSE 10 END + CASE WHEN professional_title <> '' THEN 10 ELSE 0 END + CASE WHEN email <> '' THEN 10 ELSE 0 END)::INT AS score
    FROM fx_profiles p JOIN fx_leads l ON p.ord = l.ord ORDER BY score DESC, p.ord LIMIT 50""",
)(lambda t: _best(t).select("ord", "score"))
query("srt_campaign", "SELECT campaign_id, row_number() OVER (ORDER BY coalesce(nullif(created_at, ''), '9999'), campaign_id) AS place FROM fx_campaigns")(lambda t: P.sorted_campaigns(t("fx_campaigns")).select("campaign_id", "place"))
query("lim_n", "SELECT ord FROM fx_leads WHERE linkedin_url <> '' ORDER BY ord LIMIT 25")(lambda t: t("fx_leads").filter("linkedin_url <> ''").orderBy("ord").limit(25).select("ord"))
# --- sets
query("set_concat", "SELECT ord, email, source FROM fx_leads UNION ALL SELECT ord, \"Email\", '' FROM fx_reviewed")(lambda t: S.concatenated(t("fx_leads").select("ord", "email", "source"), t("fx_reviewed").select("ord", F.col("Email").alias("email"))))
query("set_new_emails", "SELECT count(*) AS n FROM (SELECT DISTINCT lower(\"Email\") FROM fx_reviewed WHERE \"Email\" <> '' EXCEPT SELECT lower(email) FROM fx_leads)")(lambda t: S.new_emails(t("fx_leads"), t("fx_reviewed")))
query("set_union_sources", "SELECT ord, array_to_string(list_sort(list_distinct(list_concat(string_split(source, ','), ['feed_a', 'feed_z']))), ',') AS sources FROM fx_leads")(lambda t: t("fx_leads").select("ord", S.union_sources(F.col("source"), F.lit("feed_z,feed_a")).alias("sources")))
# --- classes
_LABELS = {"owner": "owner", "founder": "founder", "c_suite": r"ceo|cto|cfo|coo|cmo|cio|chief|c\.e\.o|c\.t\.o", "vp": "vp|vice president|vice-president", "director": "director", "manager": "manager|managing", "partner": "partner"}
_labels = [f"CASE WHEN regexp_matches(lower(title), '\\b({p})\\b') THEN '{k}' END" for k, p in _LABELS.items()]
_labels.insert(5, r"CASE WHEN regexp_matches(lower(title), '\bhead of\b|\bhead,\b|\bhead\s') THEN 'head' END")
_labels += [r"CASE WHEN regexp_matches(lower(title), '\bsenior\b|\bsr\.\b|\bsr\s|\blead\b') THEN 'senior' END", r"CASE WHEN regexp_matches(lower(title), '\b(junior|intern|trainee)\b') THEN 'entry' END"]  # DuckDB has no lookahead; no title here says assistant
query("cls_seniority", f"SELECT ord, array_to_string(list_filter([{', '.join(_labels)}], lambda x: x IS NOT NULL), ',') AS labels FROM fx_leads")(lambda t: t("fx_leads").select("ord", F.array_join(C.seniority(F.col("title")), ",").alias("labels")))
query(
    "cls_gap",
    """SELECT source, coalesce(string_agg(filter_key, ',' ORDER BY filter_key) FILTER (state = 'supported'), '') AS supported, coalesce(string_agg(filter_key, ',' ORDER BY filter_key) FILTER (state = 'enforceable'), '') AS enforceable, coalesce(string_agg(filter_key, ',' ORDER BY filter_key) FILTER (state = 'lost'), '') AS lost,
    least(round_even(1.0 / exp(sum(CASE WHEN state = 'supported' THEN 0 ELSE ln(CASE filter_key WHEN 'titles' THEN 0.7 WHEN 'industry' THEN 0.6 ELSE 1.0 END) END)), 1), 4.0)::DOUBLE AS oversample FROM cfg_source_filter WHERE filter_key IN (SELECT CASE k WHEN 0 THEN 'titles' WHEN 1 THEN 'industry' ELSE 'revenue' END FROM (SELECT DISTINCT c_custkey % 3 AS k FROM customer)) GROUP BY source""",
)(lambda t: C.filter_gaps(t("customer").select(F.when(F.col("c_custkey") % 3 == 0, "titles").when(F.col("c_custkey") % 3 == 1, "industry").otherwise("revenue").alias("filter_key")).distinct(), t("cfg_source_filter"), {"titles": 0.7, "industry": 0.6}))


def _searches(t):
    from ..operators import searches

    return searches.parsed(t("fx_searches"))


query("cls_size_bucket", "SELECT search_id, CASE search_id % 3 WHEN 0 THEN '1-10' WHEN 1 THEN '11-20|21-50' ELSE '51-100|101-200' END AS sizes FROM fx_searches")(lambda t: C.mapped_values(_searches(t), "search_id", "sizes", t("cfg_size"), "code", "bucket", "pos", False).withColumn("sizes", F.array_join("sizes", "|")))
query("cls_seniority_map", "SELECT search_id, CASE search_id % 2 WHEN 0 THEN 'C-Level' ELSE 'vp' END AS seniorities FROM fx_searches")(lambda t: C.mapped_values(_searches(t), "search_id", "seniorities", t.spark.range(1).select(F.lit("c_suite").alias("code"), F.lit("C-Level").alias("label"), F.lit(1).alias("pos")), "code", "label", "pos", True).withColumn("seniorities", F.array_join("seniorities", "|")))
query(
    "cls_revenue_bucket",
    """SELECT search_id, string_agg(bucket, '|' ORDER BY b.low) AS buckets FROM (SELECT search_id, (search_id % 7) * 1000000 AS lo, CASE WHEN search_id % 2 = 0 THEN NULL ELSE (1 + search_id % 9) * 5000000 END AS hi FROM fx_searches WHERE search_id % 5 <> 0) s
    JOIN cfg_revenue b ON CASE WHEN hi IS NULL THEN b.high > lo AND b.low < lo * 100 ELSE b.high > lo AND b.low < hi END GROUP BY search_id""",
)(lambda t: C.revenue_buckets(_searches(t).withColumn("revenue_max", F.when(F.col("search_id") % 2 != 0, F.col("revenue_max"))), "search_id", "revenue_min", "revenue_max", t("cfg_revenue")))
query("cls_industry_src", "SELECT page_id AS ord, CASE WHEN page_id % 3 = 0 THEN 'codes' WHEN length(html) >= 50 THEN 'website' ELSE 'none' END AS src FROM pages")(lambda t: t("pages").select(F.col("page_id").alias("ord"), C.industry_source(F.col("page_id") % 3 == 0, F.col("html")).alias("src")))
query("cls_industry_pref", "SELECT ord, CASE WHEN lower(trim(industry)) IN ('', 'unknown', 'n/a') THEN 'model' ELSE industry END AS industry FROM fx_labels")(lambda t: t("fx_labels").select("ord", C.industry_preferred(F.col("industry"), F.lit("model")).alias("industry")))
