"""Queries of lookups, anti joins and deduplication."""

from pyspark.sql import functions as F

from ..cluster import shared_folder
from ..functions import text as X
from ..operators import classify, dedup as D, joins as J, normalize as N
from ..sources import readers as R
from .registry import query

_old = lambda t: t("fx_leads").filter("ord % 5 = 2")
query(
    "join_new_only",
    """SELECT ord FROM fx_leads n WHERE NOT (email <> '' AND lower(email) IN (SELECT lower(email) FROM fx_leads WHERE ord % 5 = 2 AND email <> '')) AND NOT (name <> '' AND company_name <> '' AND EXISTS (SELECT 1 FROM fx_leads o WHERE o.ord % 5 = 2 AND lower(o.name) = lower(n.name) AND lower(o.company_name) = lower(n.company_name)))""",
)(lambda t: J.new_only(t("fx_leads"), _old(t)).select("ord"))
query("join_ref_csv", """SELECT ord FROM fx_leads WHERE email = '' OR lower(email) NOT IN (SELECT lower(trim("Email")) FROM fx_reference)""")(lambda t: J.without_reference(t("fx_leads"), t("fx_reference")).select("ord"))
_KEPT = """SELECT l.*, CASE WHEN email <> '' THEN lower(email) IN (SELECT lower("Email") FROM fx_reviewed) ELSE name <> '' AND company_name <> '' AND EXISTS (SELECT 1 FROM fx_reviewed r WHERE lower(r."Name") = lower(l.name) AND lower(r."Company") = lower(l.company_name)) END AS kept FROM fx_leads l"""
query("join_kept_removed", f"SELECT ord, kept FROM ({_KEPT})")(lambda t: J.kept_or_removed(t("fx_leads"), t("fx_reviewed")).select("ord", "kept"))
query(
    "join_sheet_seen",
    """WITH p AS (SELECT ord, CASE WHEN title <> '' AND address <> '' THEN md5(trim(lower(title || '|' || address))) END AS id FROM fx_places), u AS (SELECT * FROM p WHERE id IS NULL OR id NOT IN (SELECT id FROM p WHERE ord % 3 = 1 AND id IS NOT NULL))
    SELECT min(ord) AS ord FROM u GROUP BY coalesce(id, 'row:' || ord)""",
)(lambda t: J.unseen_places(t("fx_places"), t("fx_places").filter("ord % 3 = 1"), True).select("ord"))
# Each domain is answered twice, the earlier time in capitals.
_ANSWERS = "SELECT lower(domain) AS domain, arg_max(country, nth) AS country FROM (SELECT domain, CASE WHEN hq_country <> '' THEN hq_country ELSE 'Estonia' END AS country, 2 AS nth FROM fx_company UNION ALL SELECT upper(domain), 'Earlier', 1 FROM fx_company) GROUP BY 1"
_FILLED = f"""SELECT l.ord, CASE WHEN l.company_country <> '' THEN 'had' WHEN l.company_domain = '' THEN 'no_domain' WHEN c.domain IS NULL THEN 'not_found' ELSE 'filled' END AS filled, CASE WHEN l.company_country = '' AND c.domain IS NOT NULL THEN c.country ELSE l.company_country END AS company_country
  FROM fx_leads l LEFT JOIN ({_ANSWERS}) c ON l.company_domain = c.domain"""


def _filled(t):
    now = N.company_country(t("fx_company"))
    answers = now.withColumn("nth", F.lit(2)).unionByName(now.select(F.upper("domain").alias("domain"), F.lit("Earlier").alias("country"), F.lit(1).alias("nth")))
    return J.filled_country(t("fx_leads"), answers, ("nth",))


query("join_domain_lookup", _FILLED)(lambda t: _filled(t).select("ord", "filled", "company_country"))
_TLD = "CASE WHEN ends_with({0}, '.co.uk') THEN '.co.uk' WHEN contains({0}, '.') THEN '.' || string_split({0}, '.')[-1] ELSE '' END"
_signs = lambda test: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {test.format(k)} THEN '{n}=' || {k} END" for k, n in (("d", "domain"), ("e", "email"), ("f", "phone"))) + "], lambda x: x IS NOT NULL), ',')"
_CLASS = f"""SELECT ord, CASE WHEN cc <> '' THEN CASE WHEN cc IN ('LV', 'LATVIA') THEN 'domestic' ELSE 'foreign' END WHEN p <> '' AND m = '' THEN 'domestic' WHEN m <> '' AND p = '' THEN 'foreign' ELSE 'uncertain' END AS verdict,
  CASE WHEN cc IN ('LV', 'LATVIA') THEN 'company_country' WHEN cc <> '' THEN 'company_country=' || cc WHEN p = '' AND m = '' THEN 'no_signals' WHEN m = '' THEN p WHEN p = '' THEN m ELSE 'conflict:domestic=' || p || '|foreign=' || m END AS why FROM (
  SELECT ord, cc, {_signs("CASE WHEN '{0}' = 'f' THEN starts_with({0}, '+371') ELSE {0} = '.lv' END")} AS p, {_signs("CASE WHEN '{0}' = 'f' THEN {0} <> '' AND NOT starts_with({0}, '+371') ELSE {0} IN ('.de', '.ee', '.co.uk') END")} AS m FROM (
  SELECT ord, cc, d, CASE WHEN e = d THEN '' ELSE e END AS e, f FROM (
  SELECT ord, upper(trim({{cc}})) AS cc, {_TLD.format("company_domain")} AS d, CASE WHEN contains(email, '@') THEN {_TLD.format("string_split(lower(email), '@')[-1]")} ELSE '' END AS e, CASE WHEN starts_with(company_phone, '+') THEN company_phone[1:4] ELSE '' END AS f FROM {{src}})))"""
_classify = lambda d: classify.country_class(d, "LV", "Latvia", ".lv", "+371", [".de", ".ee", ".co.uk"], [".co.uk"])
query("cls_country", _CLASS.format(cc="company_country", src="fx_leads"))(lambda t: _classify(t("fx_leads")).select("ord", "verdict", "why"))
query(
    "join_country_recheck",
    f"WITH f AS ({_FILLED}), l AS (SELECT x.* REPLACE (f.company_country AS company_country) FROM fx_leads x JOIN f ON x.ord = f.ord) " + _CLASS.format(cc="company_country", src="l"),
)(lambda t: _classify(_filled(t)).select("ord", "verdict", "why"))
query("agg_country_stats", f"SELECT coalesce(verdict, 'all') AS verdict, coalesce(why, 'all') AS why, count(*) AS n FROM ({_CLASS.format(cc='company_country', src='fx_leads')}) GROUP BY ROLLUP (verdict, why)")(
    lambda t: _classify(t("fx_leads")).rollup("verdict", "why").agg(F.count(F.lit(1)).alias("n")).select(F.coalesce("verdict", F.lit("all")).alias("verdict"), F.coalesce("why", F.lit("all")).alias("why"), "n")
)
query("join_taxonomy_v2_v1", "SELECT ord, coalesce((SELECT arg_min(v1, prio) FROM cfg_taxonomy WHERE v2 = lower(industry)), industry) AS v1 FROM fx_leads")(lambda t: J.to_v1(t("fx_leads"), t("cfg_taxonomy"), "industry").select("ord", "v1"))
query(
    "join_taxonomy_v1_v2",
    "SELECT ord, CASE source WHEN 'feed_a' THEN 'automobile|vehicles|machinery' WHEN 'feed_b' THEN 'household|furniture|unknown thing' ELSE 'building' END AS vs FROM fx_leads",
)(
    lambda t: classify.mapped_values(
        t("fx_leads").select("ord", F.when(F.col("source") == "feed_a", F.array(F.lit("automotive"), F.lit("machinery"))).when(F.col("source") == "feed_b", F.array(F.lit("consumer goods"), F.lit("unknown thing"))).otherwise(F.array(F.lit("construction"))).alias("vs")),
        "ord", "vs", t("cfg_taxonomy"), "v1", "v2", "prio", True,
    ).withColumn("vs", F.array_join("vs", "|"))
)
query("join_taxonomy_whitelist", "SELECT DISTINCT unnest([x, replace(x, ' and ', ' & '), replace(x, ' & ', ' and ')]) AS industry FROM (SELECT lower(industry) AS x FROM fx_labels UNION SELECT v2 FROM cfg_taxonomy WHERE v1 IN (SELECT lower(industry) FROM fx_labels))")(lambda t: J.spellings(t("fx_labels").select("industry").distinct(), t("cfg_taxonomy")))
_ids = lambda t: t("fx_leads").select("ord", F.array(F.concat(F.lit("5567cd4773696439b10b000"), (F.col("ord") % 6).cast("string")), F.lit("5567cd4773696439b10b0001")).alias("ids"))
query("join_id_resolve", "SELECT ord, CASE ord % 6 WHEN 0 THEN 'Building|Automobile' WHEN 1 THEN 'Automobile' WHEN 2 THEN 'Machinery|Automobile' WHEN 3 THEN 'BUILDING|Automobile' ELSE 'Automobile' END AS names, CASE WHEN ord % 6 > 3 THEN '5567cd4773696439b10b000' || ord % 6 ELSE '' END AS unresolved FROM fx_leads")(lambda t: J.resolved_ids(_ids(t), "ord", "ids", t("cfg_industry_id")))
def _id_map(t):
    """Learned pairs in a JSON file, over pairs in memory."""
    import uuid

    path = f"{shared_folder(t.spark).rstrip('/')}/ids-{uuid.uuid4().hex}"
    t("part").filter("p_partkey % 2 = 0").select(F.concat(F.lit("id"), F.col("p_partkey").cast("string")).alias("id"), F.concat(F.lit("learned "), "p_name").alias("name")).write.json(path)
    return R.id_map(t.spark, path, t("part").filter("p_partkey % 3 = 0").select(F.concat(F.lit("id"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name")))


query("src_id_map", "SELECT 'id' || p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'learned ' || p_name ELSE p_name END AS name FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0")(_id_map)
query("join_name_to_id", "SELECT ord, coalesce((SELECT arg_max(id, c.ord) FROM cfg_industry_id c WHERE lower(name) = lower(industry)), '') AS id FROM fx_leads")(lambda t: J.name_ids(t("fx_leads"), "industry", t("cfg_industry_id")).select("ord", X.blank_if_null(F.col("id")).alias("id")))
query("join_valid_industry", "SELECT ord, lower(industry) IN (SELECT lower(name) FROM cfg_industry_id) AS valid FROM fx_leads")(lambda t: J.name_ids(t("fx_leads"), "industry", t("cfg_industry_id")).select("ord", F.col("id").isNotNull().alias("valid")))
_known = lambda t: t("part").filter("p_partkey % 3 <> 0").select(F.concat(F.lit("id"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name"))
_fresh = lambda t: t("part").filter("p_partkey % 4 <> 1").select(F.concat(F.lit("id"), F.col("p_partkey").cast("string")).alias("id"), F.when(F.col("p_partkey") % 5 == 0, F.concat("p_name", F.lit(" two"))).otherwise(F.upper("p_name")).alias("name"))
query(
    "join_id_merge",
    """WITH k AS (SELECT 'id' || p_partkey AS id, p_name AS name FROM part WHERE p_partkey % 3 <> 0), n AS (SELECT 'id' || p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN p_name || ' two' ELSE upper(p_name) END AS name FROM part WHERE p_partkey % 4 <> 1)
    SELECT coalesce(k.id, n.id) AS id, coalesce(k.name, n.name) AS name, CASE WHEN n.id IS NULL THEN 'known' WHEN k.id IS NULL THEN 'new' WHEN lower(k.name) = lower(n.name) THEN 'same' ELSE 'conflict' END AS status FROM k FULL OUTER JOIN n ON k.id = n.id""",
)(lambda t: J.merged_ids(_known(t), _fresh(t)))
query("join_intent", "SELECT DISTINCT industry FROM (SELECT name AS industry FROM cfg_industry_id UNION ALL SELECT industry FROM fx_leads WHERE source = 'feed_a' AND industry <> '')")(lambda t: t("cfg_industry_id").select(F.col("name").alias("industry")).unionByName(t("fx_leads").filter("source = 'feed_a' and industry <> ''").select("industry")).distinct())
query("join_score_back", "SELECT ord, CASE WHEN industry = '' THEN '' ELSE coalesce((SELECT nullif(arg_max(score, nth), 'bogus') FROM cfg_score s WHERE lower(s.industry) = lower(l.industry)), 'maybe') END AS score FROM fx_leads l")(lambda t: J.scored_industries(t("fx_leads"), t("cfg_score"), order=("nth",)).select("ord", X.blank_if_null(F.col("score")).alias("score")))
query("join_score_exact", "SELECT ord, CASE WHEN lower(trim(industry)) IN (SELECT lower(trim(name)) FROM cfg_industry_id) THEN 'relevant' ELSE 'irrelevant' END AS score FROM fx_leads")(lambda t: J.name_ids(t("fx_leads"), "industry", t("cfg_industry_id")).select("ord", F.when(F.col("id").isNotNull(), "relevant").otherwise("irrelevant").alias("score")))

# --- duplicates
_COLS = "first_name, last_name, name, title, email, email_status, linkedin_url, city, country, company_name, company_website, company_linkedin, company_phone, company_domain, company_country, industry, source"
_RICH = " + ".join(f"(trim({c.strip()}) <> '')::INT" for c in _COLS.split(","))
query("dd_richness", f"SELECT ord, {_RICH} AS n FROM fx_leads")(lambda t: t("fx_leads").select("ord", D.richness().alias("n")))
_KEY = "CASE WHEN email <> '' THEN 'e:' || lower(email) WHEN name <> '' AND company_name <> '' THEN 'n:' || lower(name) || '|' || lower(company_name) ELSE 'u:' || ord END"
_fold = lambda c: f"CASE WHEN ({_RICH_N}) > ({_RICH_B}) THEN CASE WHEN trim(n.{c}) <> '' THEN n.{c} ELSE b.{c} END ELSE CASE WHEN trim(b.{c}) <> '' THEN b.{c} ELSE n.{c} END END AS {c}"
_NAMES = [c.strip() for c in _COLS.split(",")]
_RICH_N, _RICH_B = (" + ".join(f"(trim({x}.{c}) <> '')::INT" for c in _NAMES) for x in ("n", "b"))
_MERGE = f"""WITH RECURSIVE s AS (SELECT {_KEY} AS key, row_number() OVER (PARTITION BY {_KEY} ORDER BY ord) AS i, ord, {_COLS} FROM fx_leads), m AS (
  SELECT key, i, ord, {_COLS} FROM s WHERE i = 1 UNION ALL
  SELECT b.key, n.i, b.ord, {", ".join(_fold(c) for c in _NAMES if c != "source")}, array_to_string(list_sort(list_distinct(list_concat(string_split(b.source, ','), string_split(n.source, ',')))), ',') AS source FROM m b JOIN s n ON n.key = b.key AND n.i = b.i + 1)
  SELECT ord, {_COLS} FROM m QUALIFY i = max(i) OVER (PARTITION BY key)"""
query("dd_merge_email", _MERGE)(lambda t: D.merged_by_email(t("fx_leads")))
query("dd_merge_stats", _MERGE.replace(f"SELECT ord, {_COLS} FROM m QUALIFY", "SELECT (SELECT count(*) FROM fx_leads) AS raw_rows, count(*) AS unique_rows, CAST(sum((source = 'feed_a')::INT) AS BIGINT) AS only_first, CAST(sum((source = 'feed_b')::INT) AS BIGINT) AS only_second, CAST(sum(contains(source, ',')::INT) AS BIGINT) AS several, (SELECT count(*) FROM fx_leads) - count(*) AS duplicates FROM (SELECT * FROM m QUALIFY") + ")")(
    lambda t: D.merge_stats(t("fx_leads"), D.merged_by_email(t("fx_leads")), "feed_a", "feed_b")
)
query("dd_merge_simple", f"SELECT ord FROM fx_leads WHERE email <> '' QUALIFY row_number() OVER (PARTITION BY lower(email) ORDER BY {_RICH} DESC, ord) = 1")(lambda t: D.merged_simple(t("fx_leads")).select("ord"))
query("win_first_seen", "SELECT min(ord) AS ord FROM fx_leads GROUP BY lower(company_name)")(lambda t: D.first_seen(t("fx_leads"), X.key(F.col("company_name")), "ord").select("ord"))
query("dd_place", "SELECT min(ord) AS ord FROM fx_places GROUP BY CASE WHEN placeId <> '' THEN placeId ELSE md5(trim(lower(title || '|' || address))) END")(lambda t: D.deduped_places(t("fx_places")).select("ord"))
_campaigns = lambda t: t("fx_leads").withColumn("rank", F.col("campaign_no") + 1)
# Row by row: a row stays in the baseline, or if none of its keys was seen on a row that stayed.
_CROSS = """WITH RECURSIVE k AS (SELECT row_number() OVER (ORDER BY campaign_no, ord) AS i, ord, campaign_no + 1 AS rank, list_filter([
    CASE WHEN email <> '' THEN 'e:' || lower(email) END, CASE WHEN linkedin_url <> '' THEN 'u:' || string_split(regexp_replace(regexp_replace(regexp_replace(lower(linkedin_url), '^https?://', ''), '^www[.]', ''), '/+$', ''), '?')[1] END,
    CASE WHEN name <> '' AND company_name <> '' THEN 'n:' || lower(name) || '|' || lower(company_name) END], lambda x: x IS NOT NULL) AS keys FROM fx_leads),
  s AS (SELECT 0::BIGINT AS i, 0::BIGINT AS ord, 0 AS rank, NULL::VARCHAR AS hit, []::VARCHAR[] AS seen UNION ALL
  SELECT k.i, k.ord, k.rank, CASE WHEN k.rank > 1 THEN list_filter(k.keys, lambda x: list_contains(s.seen, x))[1] END, CASE WHEN k.rank > 1 AND list_has_any(s.seen, k.keys) THEN s.seen ELSE list_concat(s.seen, k.keys) END FROM s JOIN k ON k.i = s.i + 1)
  SELECT ord, rank, CASE hit[1] WHEN 'e' THEN 'email' WHEN 'u' THEN 'url' WHEN 'n' THEN 'name_org' ELSE '' END AS reason FROM s WHERE i > 0"""
query("dd_cross_campaign", _CROSS)(lambda t: D.cross_campaign(_campaigns(t), "rank").select("ord", "rank", X.blank_if_null(F.col("reason")).alias("reason")))
query(
    "dd_cross_counts",
    _CROSS.replace("SELECT ord, rank, CASE hit[1]", "SELECT coalesce(rank, 0) AS rank, count(*) AS rows, count(*) FILTER (reason = 'email') AS by_email, count(*) FILTER (reason = 'url') AS by_url, count(*) FILTER (reason = 'name_org') AS by_name_org, count(*) FILTER (reason = '') AS kept, round_even(100.0 * count(*) FILTER (reason <> '') / count(*), 1) AS rate FROM (SELECT ord, rank, CASE hit[1]") + ") GROUP BY ROLLUP (rank)",
)(lambda t: D.cross_counts(D.cross_campaign(_campaigns(t), "rank"), "rank").withColumn("rank", F.coalesce("rank", F.lit(0))))
