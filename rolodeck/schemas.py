"""The canonical lead and the layouts it is exported in."""

from pyspark.sql import types as T

#: 17 text columns; what is missing is an empty text, never null.
LEAD = ("first_name", "last_name", "name", "title", "email", "email_status", "linkedin_url", "city", "country", "company_name", "company_website", "company_linkedin", "company_phone", "company_domain", "company_country", "industry", "source")
LEAD_SCHEMA = T.StructType([T.StructField(c, T.StringType(), False) for c in LEAD])
#: Parts of status lines that feeds deliver as names; in all feeds, in sheets, and when lists are cleaned.
JUNK_MARKERS = ("👀", "⏳", "📈", "🟢", "Actor", "Scanning pages", "enhance scraping", "check the log", "monitor", "Refer to the log", "To enhance scraping")
SHEET_MARKERS = ("👀", "⏳", "📈", "🟢", "Scanning pages")
INVALID_MARKERS = ("👀", "⏳", "📈", "✅", "🚀", "Actor", "Scanning pages", "enhance scraping", "split URLs", "Use employee sizes")
#: Providers whose e-mail addresses anyone may have.
FREE_PROVIDERS = ("gmail.com", "outlook.com", "hotmail.com", "yahoo.com", "inbox.lv", "one.lv", "mail.ru")
#: What a place's domain is if its page is one of a social network.
SOCIAL_DOMAINS = ("instagram", "facebook", "youtube", "tiktok")
#: News sites, directories and review sites, which are no place's own.
BLOCKED_DOMAINS = (
    "db.lv", "delfi.lv", "apollo.lv", "tvnet.lv", "lsm.lv", "la.lv", "nra.lv", "diena.lv", "kas.lv", "jauns.lv", "leta.lv",
    "firmas.lv", "zl.lv", "1188.lv", "infolapa.zl.lv", "pasts.lv", "lursoft.lv", "company.lursoft.lv", "yellowpages.lv",
    "yelp.com", "tripadvisor.com", "trustpilot.com", "glassdoor.com", "booking.com", "airbnb.com",
)
