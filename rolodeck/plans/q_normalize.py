"""Queries of the normalising projections."""

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import normalize as N
from ..schemas import LEAD
from .registry import query

_KEEP = ("ord",)
_LEAD_A = """SELECT ord, first_name, last_name, name, title, email, email_status, linkedin_url, city, country, organization.name AS company_name, organization.website_url AS company_website, organization.linkedin_url AS company_linkedin,
  CASE WHEN organization.phone <> '' THEN organization.phone ELSE organization.primary_phone.number END AS company_phone, organization.primary_domain AS company_domain, '' AS company_country,
  list_filter([organization.naics_codes[1].naics_description, organization.naics_codes[2].naics_description], lambda x: x <> '')[1] AS industry, 'feed_a' AS source FROM fx_feed_a"""
_LEAD_B = "SELECT ord, first_name, last_name, full_name AS name, job_title AS title, email, '' AS email_status, linkedin AS linkedin_url, city, country, company_name, company_website, company_linkedin, company_phone, company_domain, '' AS company_country, industry, 'feed_b' AS source FROM fx_feed_b"
_LEAD_C = """SELECT ord, firstName AS first_name, lastName AS last_name, fullName AS name, position AS title, email, '' AS email_status, linkedinUrl AS linkedin_url, '' AS city, country, organizationName AS company_name, organizationWebsite AS company_website,
  organizationLinkedinUrl AS company_linkedin, '' AS company_phone, CASE WHEN organizationWebsite = '' THEN '' ELSE string_split(replace(regexp_extract(organizationWebsite, '://([^/?#]*)', 1), 'www.', ''), '/')[1] END AS company_domain, '' AS company_country,
  coalesce((SELECT arg_min(v1, prio) FROM cfg_taxonomy WHERE v2 = organizationIndustry), organizationIndustry) AS industry, 'feed_c' AS source FROM fx_feed_c"""
_LEAD_PRE = "SELECT ord, first_name, last_name, name, title, email, email_status, linkedin_url, city, country, org_name AS company_name, website_url AS company_website, company_linkedin, organization_phone AS company_phone, company_domain, '' AS company_country, industry, source FROM fx_pre"

query("nrm_vendor_a", _LEAD_A)(lambda t: N.vendor_a(t("fx_feed_a"), _KEEP))
query("nrm_vendor_b", _LEAD_B)(lambda t: N.vendor_b(t("fx_feed_b"), _KEEP))
query("nrm_vendor_c", _LEAD_C)(lambda t: N.vendor_c(t("fx_feed_c"), t("cfg_taxonomy"), _KEEP))
query("nrm_pre_detect", "SELECT ord, ord % 3 <> 0 AND ord % 5 <> 0 AS pre FROM fx_raw")(lambda t: t("fx_raw").select("ord", N.is_pre_normalized(F.col("raw")).alias("pre")))
query("nrm_pre", _LEAD_PRE)(lambda t: N.pre_normalized(t("fx_pre"), _KEEP))
query("nrm_dispatch", f"SELECT * FROM ({_LEAD_A} UNION ALL {_LEAD_B} UNION ALL {_LEAD_C} UNION ALL {_LEAD_PRE}) WHERE NOT contains(name, 'Scanning pages')")(lambda t: N.dispatched({"feed_a": t("fx_feed_a"), "feed_b": t("fx_feed_b"), "feed_c": t("fx_feed_c"), "pre": t("fx_pre")}, t("cfg_taxonomy"), _KEEP))
query(
    "nrm_shape_bc",
    """SELECT ord, firstName AS first_name, lastName AS last_name, CASE WHEN fullName <> '' THEN fullName ELSE firstName || ' ' || lastName END AS name, '' AS organization_phone, linkedinUrl AS linkedin_url, position AS title, '' AS email_status, email, '' AS city, country,
    organizationName AS org_name, organizationWebsite AS website_url, organizationLinkedinUrl AS company_linkedin, CASE WHEN organizationWebsite = '' THEN '' ELSE replace(regexp_extract(organizationWebsite, '://([^/?#]*)', 1), 'www.', '') END AS company_domain, organizationIndustry AS industry, 'feed_c' AS source FROM fx_feed_c""",
)(
    lambda t: N.scraper_shape(
        t("fx_feed_c"),
        {"first_name": "firstName", "last_name": "lastName", "name": "fullName", "linkedin_url": "linkedinUrl", "title": "position", "email": "email", "country": "country", "org_name": "organizationName", "website_url": "organizationWebsite", "company_linkedin": "organizationLinkedinUrl", "industry": "organizationIndustry"},
        "feed_c",
        _KEEP,
    )
)
query(
    "nrm_shape_a",
    """SELECT ord, first_name, last_name, CASE WHEN name <> '' THEN name ELSE trim(first_name || ' ' || last_name) END AS name, CASE WHEN organization_phone <> '' THEN organization_phone WHEN phone <> '' THEN phone ELSE organization.phone END AS organization_phone,
    linkedin_url, title, coalesce(email_status, 'unknown') AS email_status, email, city, country, CASE WHEN organization_name <> '' THEN organization_name ELSE organization.name END AS org_name, CASE WHEN website_url <> '' THEN website_url ELSE organization.website_url END AS website_url,
    CASE WHEN len(organization.industries) = 0 THEN '' ELSE upper(organization.industries[1][1]) || string_split(organization.industries[1], ' ')[1][2:] || ' Goods' END AS industry, array_to_string(organization.keywords[1:10], '|') AS org_keywords, organization.linkedin_url AS org_linkedin,
    coalesce(organization.facebook_url, '') AS org_facebook, organization.estimated_num_employees AS org_employee_count, coalesce(organization.founded_year, -1) AS org_founded_year, seniority, array_to_string(departments, '|') AS departments, headline, 'feed_d' AS source FROM fx_feed_d""",
)(lambda t: N.extended_shape(t("fx_feed_d"), "feed_d", _KEEP).withColumns({c: F.array_join(c, "|") for c in ("org_keywords", "departments")} | {"org_founded_year": F.coalesce("org_founded_year", F.lit(-1))}))
query("nrm_shape_archived", "SELECT ord, full_name AS name, CASE WHEN email <> '' THEN email ELSE linkedin END AS contact, company_name AS org FROM fx_feed_b")(lambda t: N.configured_shape(t("fx_feed_b"), {"name": ["full_name"], "contact": ["email", "linkedin"], "org": ["company_name"]}, _KEEP))
_FREE = "'gmail.com', 'outlook.com', 'hotmail.com', 'yahoo.com', 'inbox.lv', 'one.lv', 'mail.ru'"
_OWN = f"list_concat(list_filter(es, lambda e: d <> '' AND ends_with(e, '@' || d)), list_filter(es, lambda e: string_split(e, '@')[-1] IN ({_FREE}) AND NOT (d <> '' AND ends_with(e, '@' || d))))"
_PLACE = f"""SELECT ord, placeId AS place_id, title AS business_name, categoryName AS category, array_to_string(categories, '|') AS categories, address, street, city, postalCode AS postal_code, countryCode AS country, phone, "phoneUnformatted" AS phone_unformatted,
  CASE WHEN website <> '' AND domain NOT IN ('instagram', 'facebook', 'youtube', 'tiktok', 'delfi.lv') THEN website END AS website, nullif(d, '') AS domain,
  CASE WHEN placeId <> '' THEN 'https://www.google.com/maps/search/?api=1&query=' || replace(title, ' ', '%20') || '&query_place_id=' || placeId ELSE url END AS google_maps_url, totalScore AS rating, reviewsCount AS review_count,
  array_to_string({_OWN}, '|') AS emails, array_to_string(phones, '|') AS phones_extra, facebooks[1] AS facebook, instagrams[1] AS instagram, "linkedIns"[1] AS linkedin, twitters[1] AS twitter, youtubes[1] AS youtube, tiktoks[1] AS tiktok, whatsapps[1] AS whatsapp
  FROM (SELECT *, CASE WHEN domain = 'delfi.lv' THEN []::VARCHAR[] ELSE emails END AS es, CASE WHEN domain IN ('delfi.lv', 'facebook') THEN '' ELSE domain END AS d FROM fx_places WHERE NOT permanentlyClosed)"""
_flat = lambda d: d.withColumns({c: F.array_join(c, "|") for c in ("emails", "phones_extra", "categories")})
query("nrm_place", _PLACE)(lambda t: _flat(N.places(t("fx_places"), _KEEP)))
query("src_places", f"SELECT ord, place_id, business_name, website, country FROM ({_PLACE})")(lambda t: N.places(t("fx_places"), _KEEP).select("ord", "place_id", "business_name", "website", "country"))
query("nrm_place_basic", "SELECT ord, title, categoryName, address, street, city, postalCode, countryCode, phone, website, url, totalScore, reviewsCount, array_to_string(categories, ', ') AS categories FROM fx_places WHERE NOT permanentlyClosed")(lambda t: N.places_basic(t("fx_places"), _KEEP))
query("nrm_email_own_domain", f"SELECT ord, array_to_string({_OWN}, '|') AS emails FROM (SELECT ord, emails AS es, domain AS d FROM fx_places)")(
    lambda t: t("fx_places").select("ord", F.array_join(N.emails_by_domain(F.col("emails"), F.col("domain")), "|").alias("emails"))
)
_GOT = "c.site IS NOT NULL AND c.error IS NULL"
_TEAM = """CASE WHEN ord % 3 = 0 THEN '[{"name": "Ann \\"A\\" ' || ord || '", "title": "Baker", "email": "ann@shop' || ord || '.lv"}, {"name": "Bob", "title": "", "email": ""}]' ELSE '[{"name": "Eve", "title": "Clerk", "email": "eve@shop' || ord || '.lv"}]' END"""
_LEAD34 = f"""SELECT ord, '2026-01-02' AS scraped_at, 'shops in Riga' AS search_query, business_name, category, address, city, state, zip_code, country, phone, website, google_maps_url, rating, review_count, price_level,
  CASE WHEN {_GOT} THEN array_to_string(c.emails, ', ') ELSE '' END AS emails, CASE WHEN {_GOT} THEN array_to_string(c.phone_numbers, ', ') ELSE '' END AS additional_phones, CASE WHEN {_GOT} THEN coalesce(c.business_hours, '') ELSE b.business_hours END AS business_hours,
  {', '.join(f"CASE WHEN {_GOT} THEN c.social.{x} ELSE '' END AS {x}" for x in ('facebook', 'twitter', 'linkedin', 'instagram', 'youtube', 'tiktok'))},
  {', '.join(f"CASE WHEN {_GOT} THEN c.owner.{x} ELSE '' END AS owner_{x}" for x in ('name', 'title', 'email', 'phone', 'linkedin'))},
  CASE WHEN {_GOT} THEN {_TEAM} ELSE '' END AS team_contacts, CASE WHEN {_GOT} THEN 'chat, form' ELSE '' END AS additional_contact_methods, CASE WHEN {_GOT} THEN c.pages_scraped ELSE 0 END AS pages_scraped, CASE WHEN {_GOT} THEN c.search_enriched ELSE false END AS search_enriched,
  CASE WHEN website = '' THEN 'no_website' WHEN c.site IS NULL THEN 'skipped' WHEN c.error IS NOT NULL THEN 'error: ' || c.error[1:50] ELSE 'success' END AS enrichment_status
  FROM fx_business b LEFT JOIN fx_contacts c ON b.website <> '' AND b.website = c.site"""
_leads34 = lambda t: N.place_leads(t("fx_business"), t("fx_contacts"), "shops in Riga", F.lit("2026-01-02"), _KEEP)
query("nrm_place_lead", _LEAD34)(_leads34)
query("nrm_company_resp", "SELECT domain, CASE WHEN hq_country <> '' THEN hq_country ELSE 'Estonia' END AS country FROM fx_company")(lambda t: N.company_country(t("fx_company")))
_JOBS = ", ".join(f"x[{i}].position_title || ' @ ' || x[{i}].company_name || ' (' || x[{i}].employment_period || ')'" for i in range(1, 6))
def _profiles(t):
    """Each profile answered twice."""
    now = t("fx_profiles").filter("ord % 10 <> 0").drop("linkedin_url").withColumn("nth", F.lit(2))
    return now.unionByName(now.withColumns({"bio": F.lit("an older bio"), "location": F.lit("elsewhere"), "nth": F.lit(1)}))


query(
    "nrm_profile_resp",
    f"""SELECT ord, CASE WHEN has THEN CASE WHEN bio <> '' THEN bio ELSE 'old bio' END ELSE 'old bio' END AS linkedin_bio, CASE WHEN has THEN professional_title ELSE '' END AS linkedin_headline, CASE WHEN has THEN coalesce(company_name, '') ELSE '' END AS linkedin_company,
    CASE WHEN has THEN company_industry ELSE '' END AS linkedin_industry, CASE WHEN has THEN location ELSE '' END AS linkedin_location, CASE WHEN has THEN total_tenure_years::VARCHAR ELSE '' END AS linkedin_tenure_years, CASE WHEN has THEN followers_range ELSE '' END AS linkedin_followers,
    CASE WHEN has THEN array_to_string([{_JOBS}], ';') ELSE '' END AS jobs, CASE WHEN has THEN 'S1 BSc 2010;S2 MSc 2012;S3 PhD 2015' ELSE '' END AS schools, CASE WHEN has THEN '2026-01-02T00:00:00Z' END AS linkedin_enriched_at, CASE WHEN has THEN 1 ELSE 0 END AS linkedin_enrichment_credits
    FROM (SELECT ord, ord % 10 <> 0 AS has, bio, professional_title, company_name, company_industry, location, total_tenure_years, followers_range, work_experience AS x FROM fx_profiles)""",
)(
    lambda t: N.profile_filled(t("fx_leads").select("ord", F.lit("old bio").alias("linkedin_bio")), _profiles(t), "2026-01-02T00:00:00Z", 1, order=("nth",))
    .withColumns({"jobs": X.blank_if_null(F.array_join(F.transform("linkedin_experience", lambda x: F.concat(x["title"], F.lit(" @ "), x["company"], F.lit(" ("), x["period"], F.lit(")"))), ";")), "schools": X.blank_if_null(F.array_join(F.transform("linkedin_education", lambda x: F.concat_ws(" ", x["school"], x["degree"], x["period"])), ";"))})
    .withColumn("linkedin_enrichment_credits", F.coalesce("linkedin_enrichment_credits", F.lit(0)))
    .drop("linkedin_experience", "linkedin_education")
)
query("nrm_tag_resp", "SELECT DISTINCT lpad(CAST(c_custkey AS VARCHAR), 24, 'a') AS id, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' Goods' AS name FROM customer")(
    lambda t: N.tag_pairs(t("customer").select(F.format_string('{"tags":[{"id":"%s","name":"%s goods"},{"id":"short","name":"x"}]}', F.lpad(F.col("c_custkey").cast("string"), 24, "a"), F.lower("c_mktsegment")).alias("raw")))
)
query("nrm_model_json", """SELECT c_custkey AS ord, CASE WHEN c_custkey % 5 = 4 THEN NULL ELSE '{"score":' || c_custkey || '}' END AS json FROM customer""")(
    lambda t: t("customer").select(
        F.col("c_custkey").alias("ord"),
        N.model_json(
            F.when(F.col("c_custkey") % 5 == 0, F.format_string('{"score": %d}', "c_custkey"))
            .when(F.col("c_custkey") % 5 == 1, F.format_string('Sure!\n```json\n{"score": %d}\n```\nDone.', "c_custkey"))
            .when(F.col("c_custkey") % 5 == 4, F.lit("no object here"))
            .otherwise(F.format_string('It is {"score": %d} I think.', "c_custkey"))
        ).alias("json"),
    )
)
assert (len(LEAD), len(N.EXTENDED_SHAPE), len(N.PLACE), len(N.PLACE_LEAD)) == (17, 22, 25, 34)
