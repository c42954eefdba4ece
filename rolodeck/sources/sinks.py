"""Export layouts and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..operators.normalize import PLACE_LEAD, is_junk
from ..schemas import SHEET_MARKERS


def layout(df: DataFrame, columns: dict[str, Column | str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns as text, null as empty; values are expressions, or columns that may be missing."""

    def value(c: Column | str) -> Column:
        if isinstance(c, str):
            c = F.col(c) if c in df.columns else F.lit("")
        return X.blank_if_null(c.cast("string"))

    return df.select(*keep, *[value(c).alias(k) for k, c in columns.items()])


def falsy_blank(df: DataFrame, c: str) -> Column:
    """A column as text: a number that is zero, false and null are empty, true is written True. Texts stay as they are, whatever they say; a missing column is empty."""
    kind = df.schema[c].dataType if c in df.columns else None
    if isinstance(kind, T.NumericType):
        return X.blank_if_null(F.when(F.col(c) != 0, F.col(c).cast("string")))
    if isinstance(kind, T.BooleanType):
        return F.when(F.col(c), "True").otherwise("")
    return _of(df, c)


def _of(df: DataFrame, c: str) -> Column:
    """A column as text, empty if null or missing."""
    return X.blank_if_null(F.col(c).cast("string")) if c in df.columns else F.lit("")


def org_text(leads: DataFrame) -> Column:
    """The organization's name: ``org_name`` if that is a text, its ``name`` if it is an object (a struct, or a variant that holds one)."""
    kind = leads.schema["org_name"].dataType if "org_name" in leads.columns else None
    if isinstance(kind, T.StructType):
        return X.blank_if_null(F.col("org_name.name"))
    if isinstance(kind, T.VariantType):
        return X.first_present(F.try_variant_get("org_name", "$.name", "string"), F.when(F.schema_of_variant("org_name") == "STRING", F.try_variant_get("org_name", "$", "string")))
    return _of(leads, "org_name")


def organization(leads: DataFrame) -> DataFrame:
    """leads with company columns filled from ``org_name``, which may be a text, a struct, or a variant that holds either.

    An object fills company_name, company_website, company_linkedin, company_phone and company_domain; a text company_name, and then website_url and organization_phone count too. Where org_name is
    null (or there is no such column) only website_url and organization_phone count. What a lead has stays.
    """
    kind = leads.schema["org_name"].dataType if "org_name" in leads.columns else None
    parts = {"company_name": "name", "company_website": "website_url", "company_linkedin": "linkedin_url", "company_phone": "phone", "company_domain": "primary_domain"}
    part, is_text = lambda k: F.lit(None).cast("string"), F.lit(kind is not None)
    if isinstance(kind, T.StructType):
        part, is_text = (lambda k: F.col(f"org_name.{k}").cast("string") if k in kind.names else F.lit(None).cast("string")), F.lit(False)
    elif isinstance(kind, T.VariantType):
        part, is_text = (lambda k: F.try_variant_get("org_name", f"$.{k}", "string")), F.coalesce(F.schema_of_variant("org_name") == "STRING", F.lit(False))
    by_text, missing = is_text & (org_text(leads) != ""), F.col("org_name").isNull() if kind is not None else F.lit(True)
    values = {c: X.first_present(_of(leads, c), *([_of(leads, "organization_phone")] if c == "company_phone" else []), part(k)) for c, k in parts.items()}
    values["company_name"] = X.first_present(values["company_name"], F.when(by_text, org_text(leads)))
    values["company_website"] = X.first_present(values["company_website"], F.when(by_text | missing, _of(leads, "website_url")))
    return leads.withColumns(values)


SHEET28 = (
    "First Name", "Last Name", "Full Name", "Job Title", "Email", "Email Status", "LinkedIn URL", "City", "Country", "Company Name", "Casual Company Name", "Company Website", "Company LinkedIn", "Company Phone",
    "Company Domain", "Company Country", "Industry", "Company Summary", "Icebreaker", "LinkedIn Headline", "LinkedIn Bio", "LinkedIn Industry", "LinkedIn Location", "LinkedIn Followers", "LinkedIn Experience",
    "LinkedIn Education", "Website Content", "Source",
)


def sheet28(leads: DataFrame, longest: int = 1000, keep: tuple[str, ...] = ()) -> DataFrame:
    """28 columns with fallbacks (see ``organization``), junk rows left out; three jobs, two schools, and so many characters of the site's text."""
    d = organization(leads)
    get = lambda *cs: X.first_present(*[_of(d, c) for c in cs])
    each = lambda c, most, one: F.array_join(F.transform(F.slice(F.col(c), 1, most), one), " | ") if c in d.columns else F.lit("")
    t = X.blank_if_null
    experience = each("linkedin_experience", 3, lambda x: F.concat(t(x["title"]), F.lit(" @ "), t(x["company"]), F.lit(" ("), t(x["period"]), F.lit(")")))
    education = each("linkedin_education", 2, lambda x: F.concat(t(x["degree"]), F.lit(" @ "), t(x["school"])))
    content = _of(d, "website_content")
    values = [
        get("first_name"), get("last_name"), get("full_name", "name"), get("title", "job_title"), get("email"), get("email_status"), get("linkedin_url"), get("city"), get("country"), get("company_name"), get("casual_org_name"),
        get("company_website"), get("company_linkedin"), get("company_phone"), get("company_domain"), get("company_country"), get("industry"), get("company_summary"), get("icebreaker"), get("linkedin_headline"), get("linkedin_bio"),
        get("linkedin_industry"), get("linkedin_location"), get("linkedin_followers"), experience, education,
        F.when(F.length(content) > longest, F.concat(F.substring(content, 1, longest), F.lit("..."))).otherwise(content), get("source"),
    ]
    return layout(d.filter(~is_junk(get("full_name", "name"), SHEET_MARKERS)), dict(zip(SHEET28, values, strict=True)), keep)


CSV20 = ("first_name", "last_name", "name", "title", "email", "email_status", "linkedin_url", "city", "country", "company_name", "casual_org_name", "company_website", "company_linkedin", "company_phone", "company_domain", "company_country", "industry", "company_summary", "icebreaker", "source")


def csv20(leads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """20 columns; the company's name from org_name (a text or an object's name), website and phone from website_url and organization_phone where missing."""
    fallbacks = {"company_name": org_text(leads), "company_website": _of(leads, "website_url"), "company_phone": _of(leads, "organization_phone")}
    return layout(leads, {c: X.first_present(_of(leads, c), fallbacks[c]) if c in fallbacks else c for c in CSV20}, keep)


OUTREACH10 = ("email", "company_name", "casual_name", "icebreaker", "niche", "city", "score", "segment", "website", "phone")


def outreach10(places: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Ten columns for a mail merge. The e-mail is the list's first, or email_1 where there is no list; an empty list drops the row."""
    one = F.col("email_1") if "email_1" in places.columns else F.lit(None).cast("string")
    mail = F.when(F.col("emails").isNotNull(), F.get("emails", F.lit(0))).otherwise(one) if "emails" in places.columns else one
    name = _of(places, "business_name")
    casual = F.coalesce(F.col("casual_name").cast("string"), name) if "casual_name" in places.columns else name
    values = [mail, name, casual, *[_of(places, c) for c in ("insight_lv", "niche", "city", "overall_score", "segment_id", "website", "phone")]]
    return layout(places.filter(X.present(mail)), dict(zip(OUTREACH10, values, strict=True)), keep)


CALLING9 = ("niche", "business_name", "category", "address", "city", "phone", "google_maps_url", "rating", "review_count")


def calling9(places: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nine columns for calls; a rating or number of reviews of zero is empty."""
    return layout(places, {c: falsy_blank(places, c) if c in ("rating", "review_count") else _of(places, c) for c in CALLING9}, keep)


EMAIL24 = ("niche", "business_name", "category", "address", "city", "phone", "website", "email_1", "email_2", "facebook", "instagram", "linkedin", "google_maps_url", "rating", "review_count", "overall_score", "performance_score", "seo_score", "is_mobile_friendly", "has_ssl", "cms", "insight_1", "insight_2", "insight_3")


def email24(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """24 columns with two e-mails, three insights and the scores; zero and false are empty, true is written True."""
    at = lambda c, i: F.get(c, F.lit(i)) if c in rows.columns else F.lit("")
    numbers = ("rating", "review_count", "overall_score", "performance_score", "seo_score", "is_mobile_friendly", "has_ssl")
    lists = {f"email_{i + 1}": at("emails", i) for i in range(2)} | {f"insight_{i + 1}": at("insights", i) for i in range(3)}
    return layout(rows, {c: lists[c] if c in lists else falsy_blank(rows, c) if c in numbers else _of(rows, c) for c in EMAIL24}, keep)


PLACE10 = ("scraped_at", "niche", "business_name", "category", "address", "city", "phone", "google_maps_url", "rating", "review_count")


def place10(places: DataFrame, scraped_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Ten texts of each place; a number that is zero is empty."""
    return layout(places, {"scraped_at": scraped_at} | {c: _of(places, c) if c == "niche" else falsy_blank(places, c) for c in PLACE10[1:]}, keep)


def place34(leads: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 34 columns of ``normalize.place_leads`` as texts; numbers that are zero and false are empty, true is written True."""
    return layout(leads, {c: falsy_blank(leads, c) for c in PLACE_LEAD}, keep)


def cleaned(df: DataFrame, drop: tuple[str, ...], content: str, summary: str = "company_summary", longest: int = 150) -> DataFrame:
    """df without its metadata columns; the summary is the content's start."""
    return df.withColumn(summary, F.trim(F.substring(X.blank_if_null(F.col(content)), 1, longest))).drop(*drop)


# --- writers


def write_run(df: DataFrame, path: str, run_id: str) -> int:
    """Appends a run as a partition of its own; returns its number of rows, observed while writing."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("run_id", F.lit(run_id)).write.partitionBy("run_id").mode("append").parquet(path)
    return seen.get["rows"]


def write_mode(df: DataFrame, path: str, mode: str) -> None:
    """create (an existing table is an error), append, or replace."""
    df.write.mode({"create": "errorifexists", "append": "append", "replace": "overwrite"}[mode]).parquet(path)


def fan_out(df: DataFrame, path: str, niche: str = "niche", keep_others: bool = False) -> DataFrame:
    """Writes a partition for each niche, all together being the combined output; returns the summary (niche, rows).

    Niches written before and not in df are dropped, or stay with keep_others; those in df are replaced. df is worked out once: the summary is read from what was written, where files' footers tell their rows. Rows are dealt by
    niche, small niches together and a large one to several tasks, as adaptive execution sees their sizes, so that a niche has few files.
    """
    from pyspark.sql import Observation

    safe = F.regexp_replace(F.lower(X.blank_if_null(F.col(niche))), "[^a-z0-9]+", "_")
    seen = Observation()
    tagged = df.withColumn("niche_safe", safe).hint("rebalance", "niche_safe").observe(seen, F.collect_set("niche_safe").alias("niches"))
    tagged.write.partitionBy("niche_safe").option("partitionOverwriteMode", "dynamic" if keep_others else "static").mode("overwrite").parquet(path)
    niches = sorted(seen.get["niches"])  # a folder each
    written = df.sparkSession.read.schema("niche_safe string").parquet(path).filter(F.col("niche_safe").isin(niches))
    return written.groupBy("niche_safe").agg(F.count(F.lit(1)).alias("rows"))


def write_scores(scores: DataFrame, path: str, run_id: str) -> DataFrame:
    """Keeps a run's scores beside the list, and returns the run's counts by score, read from what was written. A run that is written again is replaced."""
    folder = f"{path}/run_id={run_id}"
    scores.write.mode("overwrite").parquet(folder)
    return scores.sparkSession.read.schema("score string").parquet(folder).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
