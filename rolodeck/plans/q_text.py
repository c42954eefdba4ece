"""Queries of the scalar text, URL, phone and name functions."""

from pyspark.sql import functions as F

from ..functions import names, text
from ..operators import searches
from .registry import query

LEGAL_FORMS = [", Inc.", " LLC", " GmbH", " Ltd"]
PHONE_CODES = ["371", "372", "49", "44", "1"]
COMPOUND_TLDS = [".co.uk", ".com.au"]
ACCENTS, PLAIN = "āčēģīķļņšūžĀČĒĢĪĶĻŅŠŪŽ", "acegiklnsuzACEGIKLNSUZ"
_TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def over(table, name, column):
    return lambda t: t(table).select("ord", column().alias(name))


query("str_key", "SELECT ord, lower(trim(email)) AS key FROM fx_leads")(over("fx_leads", "key", lambda: text.key(F.col("email"))))
query("str_industry_key", "SELECT ord, replace(lower(trim(industry)), ' and ', ' & ') AS key FROM fx_labels")(over("fx_labels", "key", lambda: text.industry_key(F.col("industry"))))
query(
    "str_industry_title",
    """SELECT ord, CASE WHEN industry = lower(industry) THEN array_to_string(list_transform(string_split(industry, ' '), lambda w: CASE WHEN w IN ('&', 'or') THEN w
    ELSE array_to_string(list_transform(string_split(w, '/'), lambda p: upper(substr(p, 1, 1)) || lower(substr(p, 2))), '/') END), ' ') ELSE industry END AS title FROM fx_labels""",
)(over("fx_labels", "title", lambda: text.industry_title(F.col("industry"))))
query(
    "url_domain",
    r"""SELECT ord, replace(CASE WHEN regexp_matches(site, '^[a-zA-Z]+://') THEN regexp_extract(site, '://([^/?#]*)', 1) ELSE site END, 'www.', '') AS domain FROM fx_labels""",
)(lambda t: t("fx_labels").select("ord", text.domain(F.col("site")).alias("domain")))
query("url_domain_simple", "SELECT ord, string_split(replace(replace(replace(site, 'https://', ''), 'http://', ''), 'www.', ''), '/')[1] AS domain FROM fx_labels")(over("fx_labels", "domain", lambda: text.domain_simple(F.col("site"))))
query("url_clean", "SELECT ord, CASE WHEN trim(site) = '' OR trim(site) LIKE 'http://%' OR trim(site) LIKE 'https://%' THEN trim(site) ELSE 'https://' || trim(site) END AS url FROM fx_labels")(over("fx_labels", "url", lambda: text.with_scheme(F.col("site"))))
query(
    "url_profile_key",
    "SELECT ord, string_split(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^https?://', ''), '^www[.]', ''), '/+$', ''), '?')[1] AS key FROM (SELECT ord, url FROM fx_labels UNION ALL SELECT 10000000 + ord, linkedin_url FROM fx_leads)",
)(lambda t: t("fx_labels").select("ord", "url").union(t("fx_leads").select(F.col("ord") + 10000000, "linkedin_url")).select("ord", text.profile_key(F.col("url")).alias("key")))
query(
    "url_profile_api",
    r"SELECT ord, CASE WHEN contains(lower(url), 'linkedin.com') THEN 'linkedin.com' || regexp_replace(regexp_extract(url, 'linkedin\.com(/[^?#]*)', 1), '/+$', '') END AS url FROM fx_labels",
)(over("fx_labels", "url", lambda: text.profile_canonical(F.col("url"))))
query(
    "dom_tld",
    r"SELECT ord, CASE WHEN ends_with(lower(domain), '.co.uk') THEN '.co.uk' WHEN ends_with(lower(domain), '.com.au') THEN '.com.au' WHEN contains(domain, '.') THEN '.' || string_split(lower(domain), '.')[-1] ELSE '' END AS tld FROM fx_labels",
)(over("fx_labels", "tld", lambda: text.tld(F.col("domain"), COMPOUND_TLDS)))
query(
    "phone_any",
    """SELECT l.ord, coalesce(nullif(trim(company_phone), ''), nullif(trim(b.phone), ''), '') AS phone FROM fx_leads l JOIN fx_labels b ON l.ord = b.ord""",
)(lambda t: t("fx_leads").join(t("fx_labels").select(F.col("ord").alias("o"), "phone"), F.col("ord") == F.col("o")).select("ord", text.first_nonblank(F.col("company_phone"), F.col("phone")).alias("phone")))
query("phone_prefix4", "SELECT ord, CASE WHEN starts_with(company_phone, '+') THEN substr(company_phone, 1, 4) ELSE '' END AS prefix FROM fx_leads")(over("fx_leads", "prefix", lambda: text.phone_prefix4(F.col("company_phone"))))
query(
    "phone_code",
    """SELECT ord, CASE WHEN NOT starts_with(phone, '+') THEN 'no_code' WHEN substr(d, 1, 3) IN ('371', '372') THEN '+' || substr(d, 1, 3) WHEN substr(d, 1, 2) IN ('49', '44') THEN '+' || substr(d, 1, 2)
    WHEN substr(d, 1, 1) = '1' THEN '+1' ELSE '+' || substr(d, 1, 2) END AS code FROM (SELECT ord, phone, regexp_replace(phone, '[^0-9]', '', 'g') AS d FROM fx_labels)""",
)(over("fx_labels", "code", lambda: text.phone_code(F.col("phone"), PHONE_CODES)))
_SLUG = r"""SELECT ord, CASE WHEN contains(url, '/in/') THEN url_decode(regexp_replace(regexp_extract(url, '/in/([^?#]*)', 1), '/+$', '')) END AS slug FROM fx_labels"""
query("name_slug", _SLUG)(over("fx_labels", "slug", lambda: text.name_slug(F.col("url"))))
_TRIMMED = rf"""SELECT ord, CASE WHEN len(q) > 2 AND regexp_matches(q[-1], '^[0-9]{{{{3,}}}}$') THEN q[:-2] ELSE q END AS parts FROM (
  SELECT ord, CASE WHEN len(p) > 2 AND length(p[-1]) >= 6 AND regexp_matches(p[-1], '[0-9]') THEN p[:-2] ELSE p END AS q FROM (SELECT ord, string_split(slug, '-') AS p FROM ({_SLUG})))""".replace("{{", "{").replace("}}", "}")
query("name_slug_trim", f"SELECT ord, array_to_string(parts, '-') AS slug FROM ({_TRIMMED})")(over("fx_labels", "slug", lambda: text.slug_trimmed(text.name_slug(F.col("url")))))
_title = lambda c: f"array_to_string(list_transform(regexp_extract_all({c}, '[^ '']+|[ '']'), lambda v: upper(v[1]) || v[2:]), '')"
query(
    "name_slug_split",
    f"""SELECT ord, {_title('first')} AS first, {_title('last')} AS last FROM (SELECT ord, CASE WHEN n IS NULL THEN NULL WHEN n <= 1 THEN parts[1] ELSE array_to_string(parts[:s - 1], ' ') END AS first, CASE WHEN n IS NULL THEN NULL WHEN n <= 1 THEN '' ELSE array_to_string(parts[s:], ' ') END AS last FROM (
    SELECT ord, parts, len(parts) AS n, coalesce(list_filter(range(2, len(parts)), lambda i: list_contains(['van', 'von', 'de', 'der', 'den', 'la', 'le', 'di', 'da', 'du'], parts[i]))[1], len(parts)) AS s FROM ({_TRIMMED})))""",
)(lambda t: t("fx_labels").select("ord", text.name_slug(F.col("url")).alias("slug")).select("ord", text.slug_names(F.col("slug"), list(names.PARTICLES)).alias("n"), "slug").select("ord", *[names.name_title(F.when(F.col("slug").isNotNull(), F.col(f"n.{x}"))).alias(x) for x in ("first", "last")]))


def _restored(t):
    """First and last name replaced by the slug's where they differ in diacritics alone."""
    rows = t("fx_labels").select("ord", text.slug_names(text.name_slug(F.col("url")), list(names.PARTICLES)).alias("n"), F.lit("Arturs").alias("first_name"), F.lit("Berzins").alias("last_name"))
    rows = rows.withColumns({x: names.name_case(F.coalesce(F.col(f"n.{x}"), F.lit(""))) for x in ("first", "last")})
    for x in ("first", "last"):
        rows = rows.withColumn(f"{x}_fixed", F.when(names.same_folded(F.col(f"{x}_name"), F.col(x)), F.col(x)).otherwise(F.col(f"{x}_name")))
    return rows.select("ord", F.col("first_fixed").alias("first_name"), F.col("last_fixed").alias("last_name"), F.concat_ws(" ", "first_fixed", "last_fixed").alias("name"), ((F.col("first_fixed") != F.col("first_name")) | (F.col("last_fixed") != F.col("last_name"))).alias("changed"))


query(
    "name_restore",
    "SELECT ord, CASE WHEN ord % 6 = 1 THEN 'Artūrs' ELSE 'Arturs' END AS first_name, CASE WHEN ord % 6 = 1 THEN 'Bērziņš' ELSE 'Berzins' END AS last_name, CASE WHEN ord % 6 = 1 THEN 'Artūrs Bērziņš' ELSE 'Arturs Berzins' END AS name, ord % 6 = 1 AS changed FROM fx_labels",
)(_restored)
query("name_case", "SELECT ord, array_to_string(list_transform(string_split(lower(name), ' '), lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ') AS name FROM fx_leads")(lambda t: t("fx_leads").select("ord", names.name_case(F.upper("name")).alias("name")))
query("name_fold_eq", "SELECT ord, strip_accents(lower(label)) = lower(company) AND label <> '' AND company <> '' AS same FROM fx_labels")(lambda t: t("fx_labels").select("ord", names.same_folded(F.col("label"), F.col("company")).alias("same")))
query(
    "name_legal_strip",
    r"""SELECT ord, regexp_replace(CASE WHEN ends_with(lower(company), ', inc.') THEN trim(company[:-7]) WHEN ends_with(lower(company), ' llc') THEN trim(company[:-5]) WHEN ends_with(lower(company), ' gmbh') THEN trim(company[:-6])
    WHEN ends_with(lower(company), ' ltd') THEN trim(company[:-5]) ELSE company END, '[., ]+$', '') AS company FROM fx_labels""",
)(over("fx_labels", "company", lambda: text.without_legal_form(F.col("company"), LEGAL_FORMS)))
query(
    "name_casual",
    "SELECT ord, CASE ord % 6 WHEN 0 THEN 'Acme ' || ord WHEN 1 THEN 'Beta ' || ord WHEN 2 THEN 'Gamma' WHEN 3 THEN 'Delta ' || ord WHEN 4 THEN '' ELSE 'Plain ' || ord END AS casual, CASE ord % 4 WHEN 0 THEN label WHEN 1 THEN 'Frizētava' WHEN 2 THEN '!!!' ELSE label END AS brand FROM fx_labels",
)(lambda t: t("fx_labels").select("ord", names.casual_name(F.col("company"), (r"\bsalons?\b",), ("SIA", "LLC", "GmbH", "Inc"), "You").alias("casual"), names.casual_name(F.col("label"), (r"\bsalons?\b",), ("SIA",), "You").alias("brand")))
query("id_hash", "SELECT ord, md5(trim(lower(title || '|' || address))) AS id FROM fx_places")(over("fx_places", "id", lambda: text.hash_id(F.col("title"), F.col("address"))))
query("id_hash_safe", "SELECT ord, CASE WHEN title = '' AND address = '' THEN md5('row:' || ord) ELSE md5(trim(lower(title || '|' || address))) END AS id FROM fx_places")(over("fx_places", "id", lambda: text.hash_id_safe(F.col("ord"), F.col("title"), F.col("address"))))
query("id_client", r"SELECT ord, regexp_replace(trim(regexp_replace(lower(label), '[^\p{L}\p{N}\s]', '', 'g')), '\s+', '_', 'g') AS id FROM fx_labels")(over("fx_labels", "id", lambda: text.client_id(F.col("label"))))
query(
    "id_client_ascii",
    """SELECT ord, coalesce(nullif(substr(regexp_replace(regexp_replace(lower(label), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 30), ''), nullif(substr(regexp_replace(regexp_replace(lower(string_split(domain, '.')[1]), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 30), ''),
    'client_' || substr(md5(label), 1, 8)) AS id FROM fx_labels""",
)(over("fx_labels", "id", lambda: text.client_id_ascii(F.col("label"), F.col("domain"))))
query("id_campaign", "SELECT o_orderkey AS ord, replace(lower(o_orderpriority), ' ', '_') || '_' || strftime(o_orderdate, '%Y%m%d') AS id FROM orders")(lambda t: t("orders").select(F.col("o_orderkey").alias("ord"), text.campaign_id(F.col("o_orderpriority"), F.col("o_orderdate")).alias("id")))
query("str_translit", f"SELECT ord, trim(regexp_replace(translate(label, '{ACCENTS}', '{PLAIN}'), '[^A-Za-z0-9 _-]', '', 'g')) AS tab FROM fx_labels")(over("fx_labels", "tab", lambda: text.transliterated(F.col("label"), ACCENTS, PLAIN)))
query(
    "str_stringify",
    """SELECT ord, array_to_string(emails, ', ') AS emails, array_to_string(phones, ', ') AS phones, coalesce(CAST(reviewsCount AS VARCHAR), '') AS reviews FROM fx_places""",
)(lambda t: t("fx_places").select("ord", text.stringify(F.col("emails"), "array<string>").alias("emails"), text.stringify(F.col("phones"), "array<string>").alias("phones"), text.stringify(F.col("reviewsCount"), "bigint").alias("reviews")))
query(
    "arr_format",
    """SELECT ord, array_to_string(list_transform(work_experience[:3], lambda x: x.position_title || ' @ ' || x.company_name || ' (' || x.employment_period || ')'), ' | ') AS jobs,
    array_to_string(list_transform(education[:2], lambda x: x.institution_name || ' - ' || x.degree), ' | ') AS schools FROM fx_profiles""",
)(
    lambda t: t("fx_profiles").select(
        "ord",
        F.array_join(F.transform(F.slice("work_experience", 1, 3), lambda x: F.concat(x["position_title"], F.lit(" @ "), x["company_name"], F.lit(" ("), x["employment_period"], F.lit(")"))), " | ").alias("jobs"),
        F.array_join(F.transform(F.slice("education", 1, 2), lambda x: F.concat(x["institution_name"], F.lit(" - "), x["degree"])), " | ").alias("schools"),
    )
)
query(
    "tpl_icebreaker",
    """SELECT ord, CASE WHEN company_name <> '' AND title <> '' THEN 'Saw your work as ' || title || ' at ' || company_name || '.' WHEN company_name <> '' THEN 'Saw what ' || company_name || ' does.' WHEN title <> '' THEN 'Saw your work as ' || title || '.' ELSE 'Saw your profile.' END AS icebreaker, 'generic_fallback' AS generated_by FROM fx_leads""",
)(
    lambda t: t("fx_leads").select(
        "ord",
        F.when((F.col("company_name") != "") & (F.col("title") != ""), F.format_string("Saw your work as %s at %s.", "title", "company_name"))
        .when(F.col("company_name") != "", F.format_string("Saw what %s does.", "company_name"))
        .when(F.col("title") != "", F.format_string("Saw your work as %s.", "title"))
        .otherwise(F.lit("Saw your profile."))
        .alias("icebreaker"),
        F.lit("generic_fallback").alias("generated_by"),
    )
)
# --- saved search URLs
_PAIRS = """SELECT search_id, pos, string_split(p, '=')[1] AS key, url_decode(replace(substr(p, instr(p, '=') + 1), '+', '%20')) AS value FROM (
  SELECT search_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS p FROM (SELECT search_id, string_split(string_split(url, '?')[2], '&') AS parts FROM fx_searches))"""
query(
    "url_search_parse",
    f"""SELECT search_id, coalesce(string_agg(value, '|' ORDER BY pos) FILTER (key = 'personTitles[]'), '') AS titles, coalesce(string_agg(value, '|' ORDER BY pos) FILTER (key = 'personLocations[]'), '') AS locations,
    coalesce(string_agg(value, '|' ORDER BY pos) FILTER (key = 'personSeniorities[]'), '') AS seniorities, coalesce(string_agg(value, '|' ORDER BY pos) FILTER (key = 'organizationNumEmployeesRanges[]'), '') AS sizes, coalesce(string_agg(value, '|' ORDER BY pos) FILTER (key = 'qKeywords'), '') AS keywords,
    CAST(coalesce(max(value) FILTER (key = 'revenueRange[min]'), '-1') AS BIGINT) AS revenue_min, CAST(coalesce(max(value) FILTER (key = 'revenueRange[max]'), '-1') AS BIGINT) AS revenue_max FROM ({_PAIRS}) GROUP BY search_id""",
)(lambda t: searches.parsed(t("fx_searches")).select("search_id", *[F.array_join(c, "|").alias(c) for c in ("titles", "locations", "seniorities", "sizes", "keywords")], *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("revenue_min", "revenue_max")]))
query("url_search_build", "SELECT search_id, url FROM fx_searches")(lambda t: searches.built(searches.parsed(t("fx_searches")), "https://app.example.com/#/people?page=1"))
query("url_search_clean", "SELECT search_id, url FROM fx_searches")(lambda t: searches.built(searches.parsed(t("fx_searches").withColumn("url", F.replace("url", F.lit("[]="), F.lit("[]=%20")))), "https://app.example.com/#/people?page=1"))
query(
    "url_search_country",
    "SELECT search_id, CASE search_id % 4 WHEN 0 THEN 'LV' WHEN 1 THEN 'DE' WHEN 2 THEN 'US' ELSE 'GB' END AS code FROM fx_searches",
)(lambda t: searches.country(searches.parsed(t("fx_searches")), t("cfg_country_word"), "US"))
query(
    "url_search_keywords",
    f"SELECT search_id, string_agg(value, ', ' ORDER BY k, pos) AS keywords FROM (SELECT *, CASE key WHEN 'personTitles[]' THEN 1 WHEN 'qKeywords' THEN 3 WHEN 'personSeniorities[]' THEN 4 END AS k FROM ({_PAIRS})) WHERE k IS NOT NULL GROUP BY search_id",
)(lambda t: searches.parsed(t("fx_searches")).select("search_id", F.array_join(F.concat("titles", "keywords", "seniorities"), ", ").alias("keywords")))
query("set_roundtrip", "SELECT search_id, true AS titles, true AS locations, true AS seniorities, true AS sizes, true AS keywords FROM fx_searches")(lambda t: searches.round_trip(searches.parsed(t("fx_searches"))))
