"""From the feeds' shapes to the canonical lead, and from places, companies, profiles and tags to tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names, text as X
from ..schemas import BLOCKED_DOMAINS, FREE_PROVIDERS, JUNK_MARKERS, LEAD, SOCIAL_DOMAINS
from .lookup import looked_up


def shaped(df: DataFrame, columns: dict[str, Column | str], target: tuple[str, ...] = LEAD, keep: tuple[str, ...] = ()) -> DataFrame:
    """The target's columns, each from an expression or a column's name, empty where there is none; null becomes empty."""
    get = lambda c: X.blank_if_null((F.col(v) if isinstance(v := columns.get(c, F.lit("")), str) else v).cast("string"))
    return df.select(*keep, *[get(c).alias(c) for c in target])


def is_junk(name: Column, markers: tuple[str, ...] = JUNK_MARKERS) -> Column:
    return X.any_contains(X.blank_if_null(name), list(markers))


def vendor_a(feed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested organisation flattened; phone and industry from the first place that has one."""
    o = "organization."
    described = lambda codes, f: F.get(F.filter(F.transform(F.col(o + codes), lambda x: x[f]), X.present), F.lit(0))
    own = {"company_name": o + "name", "company_website": o + "website_url", "company_linkedin": o + "linkedin_url", "company_domain": o + "primary_domain", "source": F.lit("feed_a")}
    own |= {"company_phone": X.first_present(F.col(o + "phone"), F.col(o + "primary_phone.number")), "industry": F.coalesce(described("naics_codes", "naics_description"), described("sic_codes", "sic_description"))}
    same = ("first_name", "last_name", "name", "title", "email", "email_status", "linkedin_url", "city", "country")
    return shaped(feed, {c: c for c in same} | own, keep=keep)


def vendor_b(feed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    same = ("first_name", "last_name", "email", "city", "country", "company_name", "company_website", "company_linkedin", "company_phone", "company_domain", "industry")
    return shaped(feed, {c: c for c in same} | {"name": "full_name", "title": "job_title", "linkedin_url": "linkedin", "source": F.lit("feed_b")}, keep=keep)


def vendor_c(feed: DataFrame, taxonomy: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Camel-case feed; the industry goes through the taxonomy (v1, v2, prio), unknown ones stay."""
    named = {"first_name": "firstName", "last_name": "lastName", "name": "fullName", "title": "position", "email": "email", "linkedin_url": "linkedinUrl", "country": "country", "company_name": "organizationName", "company_website": "organizationWebsite", "company_linkedin": "organizationLinkedinUrl"}
    domain = F.when(F.col("organizationWebsite") != "", F.split_part(X.domain(X.with_scheme(F.col("organizationWebsite"))), F.lit("/"), F.lit(1)))
    first = taxonomy.groupBy(F.lower("v2").alias("v2_")).agg(F.min(F.struct("prio", "v1")).alias("best"))
    joined = feed.join(first, F.lower("organizationIndustry") == F.col("v2_"), "left")
    return shaped(joined, named | {"company_domain": domain, "industry": F.coalesce("best.v1", "organizationIndustry"), "source": F.lit("feed_c")}, keep=keep)


def is_pre_normalized(raw: Column) -> Column:
    """Whether a raw record (JSON text) has linkedin_url, a text as org_name, and neither full_name nor fullName."""
    v = F.try_parse_json(raw)
    has = lambda k: F.try_variant_get(v, f"$.{k}", "variant").isNotNull()
    return F.coalesce(has("linkedin_url") & (F.schema_of_variant(F.try_variant_get(v, "$.org_name", "variant")) == "STRING") & ~has("full_name") & ~has("fullName"), F.lit(False))


def pre_normalized(leads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    same = ("first_name", "last_name", "name", "title", "email", "email_status", "linkedin_url", "city", "country", "company_linkedin", "company_domain", "industry", "source")
    phone = X.first_present(*[F.col(c) for c in ("company_phone", "organization_phone") if c in leads.columns])
    return shaped(leads, {c: c for c in same} | {"company_name": "org_name", "company_website": "website_url", "company_phone": phone}, keep=keep)


def dispatched(feeds: dict[str, DataFrame], taxonomy: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All feeds as one lead table, without junk. Feeds are named feed_a, feed_b, feed_c or pre; another name is an error."""
    forms = {"feed_a": vendor_a, "feed_b": vendor_b, "feed_c": lambda d, keep: vendor_c(d, taxonomy, keep), "pre": pre_normalized}
    unknown = set(feeds) - set(forms)
    if unknown:
        raise ValueError(f"unknown feeds {sorted(unknown)}")
    every = reduce(DataFrame.unionByName, [forms[k](d, keep=keep) for k, d in feeds.items()])
    return every.filter(~is_junk(F.col("name")))


SCRAPER_SHAPE = ("first_name", "last_name", "name", "organization_phone", "linkedin_url", "title", "email_status", "email", "city", "country", "org_name", "website_url", "company_linkedin", "company_domain", "industry", "source")


def scraper_shape(feed: DataFrame, columns: dict[str, str], source: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 16-column shape: full name or first and last; domain from the website, with a scheme added."""
    full = F.col(columns["name"])
    name = F.when(X.present(full), full).otherwise(F.trim(F.concat_ws(" ", columns["first_name"], columns["last_name"])))
    site = F.col(columns["website_url"])
    domain = F.when(X.present(site), F.split_part(X.domain(X.with_scheme(site)), F.lit("/"), F.lit(1)))
    return shaped(feed, columns | {"name": name, "company_domain": domain, "source": F.lit(source)}, SCRAPER_SHAPE, keep)


EXTENDED_SHAPE = ("first_name", "last_name", "name", "organization_phone", "linkedin_url", "title", "email_status", "email", "city", "country", "org_name", "website_url", "industry", "org_keywords", "org_linkedin", "org_facebook", "org_employee_count", "org_founded_year", "seniority", "departments", "headline", "source")


def extended_shape(feed: DataFrame, source: str, keep: tuple[str, ...] = (), keywords: int = 10) -> DataFrame:
    """The 22-column shape of a nested feed with lists: first industry in title case, so many keywords at most.

    Lists stay lists, counts stay numbers; a missing e-mail status is "unknown". Values of the lead go before those of its organization.
    """
    o = "organization."
    same = ("first_name", "last_name", "linkedin_url", "title", "email", "city", "country", "seniority", "headline")
    full = F.trim(F.concat_ws(" ", X.blank_if_null(F.col("first_name")), X.blank_if_null(F.col("last_name"))))
    values = {c: X.blank_if_null(F.col(c)) for c in same}
    values |= {"name": X.first_present(F.col("name"), full), "email_status": F.coalesce("email_status", F.lit("unknown")), "source": F.lit(source)}
    values |= {"organization_phone": X.first_present(F.col("organization_phone"), F.col("phone"), F.col(o + "phone")), "org_name": X.first_present(F.col("organization_name"), F.col(o + "name")), "website_url": X.first_present(F.col("website_url"), F.col(o + "website_url"))}
    values |= {"industry": X.blank_if_null(names.name_title(F.get(o + "industries", F.lit(0)))), "org_keywords": F.coalesce(F.slice(F.col(o + "keywords"), 1, keywords), F.array().cast("array<string>"))}
    values |= {"org_linkedin": X.blank_if_null(F.col(o + "linkedin_url")), "org_facebook": X.blank_if_null(F.col(o + "facebook_url")), "org_employee_count": F.col(o + "estimated_num_employees"), "org_founded_year": F.col(o + "founded_year"), "departments": F.coalesce("departments", F.array().cast("array<string>"))}
    return feed.select(*keep, *[values[c].alias(c) for c in EXTENDED_SHAPE])


def configured_shape(feed: DataFrame, paths: dict[str, list[str]], keep: tuple[str, ...] = ()) -> DataFrame:
    """One projection for any old feed: each target column from the first of its source paths that is present."""
    return shaped(feed, {t: X.first_present(*map(F.col, ps)) for t, ps in paths.items()}, tuple(paths), keep)


# --- places

PLACE = ("place_id", "business_name", "category", "categories", "address", "street", "city", "postal_code", "country", "phone", "phone_unformatted", "website", "domain", "google_maps_url", "rating", "review_count", "emails", "phones_extra", "facebook", "instagram", "linkedin", "twitter", "youtube", "tiktok", "whatsapp")


def emails_by_domain(emails: Column, domain: Column, providers: tuple[str, ...] = FREE_PROVIDERS) -> Column:
    """Own-domain e-mails first, then those of free providers that are not among them; without a domain only the latter."""
    mine = F.filter(emails, lambda e: (F.coalesce(domain, F.lit("")) != "") & e.endswith(F.concat(F.lit("@"), domain)))
    free = F.filter(emails, lambda e: F.element_at(F.split(e, "@"), -1).isin(*providers) & ~F.coalesce(F.array_contains(mine, e), F.lit(False)))
    return F.concat(mine, free)


def maps_url(title: Column, place_id: Column) -> Column:
    """A search address of a place; the title is percent-encoded but for slashes."""
    quoted = F.url_encode(title)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        quoted = F.replace(quoted, F.lit(a), F.lit(b))
    return F.concat(F.lit("https://www.google.com/maps/search/?api=1&query="), quoted, F.lit("&query_place_id="), place_id)


def places(feed: DataFrame, keep: tuple[str, ...] = (), country: str = "lv", social: tuple[str, ...] = SOCIAL_DOMAINS, blocked: tuple[str, ...] = BLOCKED_DOMAINS, providers: tuple[str, ...] = FREE_PROVIDERS) -> DataFrame:
    """The 25-column row of each open place (PLACE).

    Pages of social networks are no website; where the domain is a blocked one, website, domain and e-mails go. E-mails are ordered by domain, of each
    list of social pages the first stays, and the maps address is built of title and place id. Texts are empty where missing; website, domain, rating,
    review_count and social pages are null. country: what a place without a country code gets.
    """
    text = lambda c: X.blank_if_null(F.col(c))
    some = lambda c: F.when(X.present(F.col(c)), F.col(c))
    listed = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    on_blocked = F.coalesce(F.col("domain").isin(*blocked), F.lit(False))
    on_social = some("website").isNotNull() & F.coalesce(F.col("domain").isin(*social), F.lit(False))
    own = F.when(~on_blocked & ~on_social, some("domain"))
    known = F.when(F.coalesce(F.col("domain").isin(*social), F.lit(False)), F.lit(None)).otherwise(own)
    renamed = {"business_name": "title", "category": "categoryName", "address": "address", "street": "street", "city": "city", "postal_code": "postalCode", "phone": "phone", "phone_unformatted": "phoneUnformatted", "place_id": "placeId"}
    values = {k: text(c) for k, c in renamed.items()}
    values |= {"categories": listed("categories"), "country": X.first_present(F.col("countryCode"), F.lit(country)), "website": F.when(~on_blocked & ~on_social, some("website")), "domain": own, "rating": F.col("totalScore"), "review_count": F.col("reviewsCount")}
    values |= {"google_maps_url": F.when(text("placeId") != "", maps_url(text("title"), F.col("placeId"))).otherwise(text("url"))}
    values |= {"emails": emails_by_domain(F.when(on_blocked, F.array().cast("array<string>")).otherwise(listed("emails")), known, providers), "phones_extra": listed("phones")}
    values |= {one: F.get(c, F.lit(0)) for one, c in {"facebook": "facebooks", "instagram": "instagrams", "linkedin": "linkedIns", "twitter": "twitters", "youtube": "youtubes", "tiktok": "tiktoks", "whatsapp": "whatsapps"}.items()}
    return feed.filter(~F.coalesce("permanentlyClosed", F.lit(False))).select(*keep, *[values[c].alias(c) for c in PLACE])


def places_basic(feed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    same = ("title", "categoryName", "address", "street", "city", "postalCode", "countryCode", "phone", "website", "url")
    return feed.filter(~F.col("permanentlyClosed")).select(*keep, *same, "totalScore", "reviewsCount", F.array_join("categories", ", ").alias("categories"))


PLACE_LEAD = (
    "scraped_at", "search_query", "business_name", "category", "address", "city", "state", "zip_code", "country", "phone", "website", "google_maps_url", "rating", "review_count", "price_level",
    "emails", "additional_phones", "business_hours", "facebook", "twitter", "linkedin", "instagram", "youtube", "tiktok", "owner_name", "owner_title", "owner_email", "owner_phone", "owner_linkedin",
    "team_contacts", "additional_contact_methods", "pages_scraped", "search_enriched", "enrichment_status",
)


def _spaced_json(list_: Column, fields: list[str]) -> Column:
    """A list of objects as JSON with a blank behind each comma and colon; empty for an empty list."""
    text = lambda v: F.regexp_replace(F.to_json(F.array(v)), r"^\[|\]$", "")
    one = lambda x: F.concat(F.lit("{"), F.concat_ws(", ", *[F.concat(F.lit(f'"{f}": '), F.when(x[f].isNull(), "null").otherwise(text(x[f]))) for f in fields]), F.lit("}"))
    return F.when(F.size(list_) > 0, F.concat(F.lit("["), F.array_join(F.transform(list_, one), ", "), F.lit("]")))


def place_leads(rows: DataFrame, contacts: DataFrame, query: str, scraped_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 34-column lead of each place (PLACE_LEAD): its own values, and what its site's contacts (of several rows of a site the last, see ``lookup``) say.

    contacts: site, status, error (null: none), emails, phone_numbers, business_hours, social struct<facebook, twitter, linkedin, instagram, youtube, tiktok>, owner struct<name, title, email,
    phone, linkedin>, team array<struct>, additional_contacts, pages_scraped, search_enriched. enrichment_status: no_website, skipped (nothing looked up), error: .. (cut to 50 characters
    behind the colon) or the contacts' own. Hours found on the site replace the place's, even by nothing.
    """
    own = [f.name for f in contacts.schema["team"].dataType.elementType.fields]
    joined = looked_up(rows, contacts, F.when(X.present(F.col("website")), F.col("website")), F.col("site"), {x: F.col(x) for x in contacts.columns if x != "site"}, "c_")
    got = F.col("c_").isNotNull() & F.col("c_.error").isNull()
    found = lambda f: F.when(got, F.col(f"c_.{f}"))
    status = F.when(~X.present(F.col("website")), "no_website").when(F.col("c_").isNull(), "skipped").when(F.col("c_.error").isNotNull(), F.concat(F.lit("error: "), F.substring("c_.error", 1, 50))).otherwise(F.col("c_.status"))
    plain = ("business_name", "category", "address", "city", "state", "zip_code", "country", "phone", "website", "google_maps_url", "rating", "review_count", "price_level")
    values = {k: F.col(k) if k in rows.columns else F.lit("") for k in plain}
    hours = F.col("business_hours") if "business_hours" in rows.columns else F.lit("")
    values |= {"scraped_at": scraped_at, "search_query": F.lit(query), "emails": F.array_join(found("emails"), ", "), "additional_phones": F.array_join(found("phone_numbers"), ", "), "business_hours": F.when(got, F.col("c_.business_hours")).otherwise(hours)}
    values |= {s: found(f"social.{s}") for s in ("facebook", "twitter", "linkedin", "instagram", "youtube", "tiktok")} | {f"owner_{o}": found(f"owner.{o}") for o in ("name", "title", "email", "phone", "linkedin")}
    values |= {"team_contacts": _spaced_json(found("team"), own), "additional_contact_methods": F.array_join(found("additional_contacts"), ", "), "pages_scraped": F.coalesce(found("pages_scraped"), F.lit(0)), "search_enriched": F.coalesce(found("search_enriched"), F.lit(False)), "enrichment_status": status}
    return joined.select(*keep, *[(values[k] if k in ("rating", "review_count", "pages_scraped", "search_enriched") else X.blank_if_null(values[k].cast("string"))).alias(k) for k in PLACE_LEAD])


# --- answers of look-up services


def company_country(answers: DataFrame) -> DataFrame:
    """(domain, country): headquarters, else the location flagged so, else the first with a country."""
    has = lambda x: X.present(x["country"])
    at = lambda f: F.get(F.filter("locations", f), F.lit(0))["country"]
    return answers.select("domain", F.coalesce(F.when(X.present(F.col("hq_country")), F.col("hq_country")), at(lambda x: x["headquarter"] & has(x)), at(has), F.lit("")).alias("country"))


#: Columns of a lead and the parts of a profile answer that fill them.
PROFILE = {"linkedin_bio": "bio", "linkedin_headline": "professional_title", "linkedin_company": "company_name", "linkedin_industry": "company_industry", "linkedin_location": "location", "linkedin_tenure_years": "total_tenure_years", "linkedin_followers": "followers_range"}


def profile_filled(leads: DataFrame, answers: DataFrame, enriched_at: str, credits: int, key: str = "ord", order: tuple[str, ...] = ()) -> DataFrame:
    """leads with nine profile columns: what is present in the answer overwrites what was there, anything else stays; up to five jobs and three schools.

    Of several answers the last counts (see ``lookup``). linkedin_enriched_at and linkedin_enrichment_credits are set where there is an answer. leads may have any of these columns already, as texts and lists.
    """
    jobs, schools = {"title": "position_title", "company": "company_name", "period": "employment_period"}, {"school": "institution_name", "degree": "degree", "period": "attendance_period"}
    joined = looked_up(leads, answers, F.col(key), F.col(key), {c: F.col(c) for c in answers.columns if c != key and c not in order}, "a_", order)
    before = lambda c: F.col(c) if c in leads.columns else F.lit(None)
    filled = {c: X.first_present(F.col(f"a_.{p}").cast("string"), before(c).cast("string")) for c, p in PROFILE.items()}

    def shaped_list(list_: Column, fields: dict[str, str]) -> Column:
        return F.transform(list_, lambda x: F.struct(*[X.blank_if_null(x[p]).alias(c) for c, p in fields.items()]))

    for into, c, fields, most in (("linkedin_experience", "work_experience", jobs, 5), ("linkedin_education", "education", schools, 3)):
        filled[into] = F.when(F.size(F.col(f"a_.{c}")) > 0, shaped_list(F.slice(F.col(f"a_.{c}"), 1, most), fields)).otherwise(before(into))
    filled |= {"linkedin_enriched_at": F.when(F.col("a_").isNotNull(), F.lit(enriched_at)).otherwise(before("linkedin_enriched_at")), "linkedin_enrichment_credits": F.when(F.col("a_").isNotNull(), F.lit(credits)).otherwise(before("linkedin_enrichment_credits"))}
    return joined.withColumns(filled).drop("a_")


def tag_pairs(raw: DataFrame, column: str = "raw") -> DataFrame:
    """(id, name) from JSON answers of four shapes: a list, or an object with tags, results or data; ids have 24 hex digits; lower-case names get title case."""
    kind = "array<struct<id string, _id string, name string, cleaned_name string>>"
    doc = F.col(column)
    bare = F.when(F.ltrim(doc).startswith("["), F.from_json(doc, kind))  # an object would be read as a list of itself
    shapes = F.coalesce(bare, *[F.from_json(F.get_json_object(doc, f"$.{k}"), kind) for k in ("tags", "results", "data")])
    pairs = raw.select(F.explode(shapes).alias("x")).select(F.coalesce("x.id", "x._id").alias("id"), F.coalesce("x.cleaned_name", "x.name").alias("name"))
    return pairs.filter(F.col("id").rlike("^[0-9a-f]{24}$") & X.present(F.col("name"))).select("id", X.industry_title(F.col("name")).alias("name")).distinct()


def model_json(answer: Column) -> Column:
    """The JSON object in a model's answer, as text: the whole, else a fenced block, else from the first brace to the last; null if there is none."""
    fenced = F.regexp_extract(answer, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    braces = F.regexp_extract(answer, r"(?s)\{.*\}", 0)
    whole = F.try_parse_json(answer)
    is_object = lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v)
    return F.coalesce(*[F.to_json(is_object(v)) for v in (whole, F.try_parse_json(fenced), F.try_parse_json(braces))])
