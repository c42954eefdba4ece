"""Classes, scores and segments of leads and sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..cluster import fresh
from ..functions import text as X
from .filters import lead_domain, own
from .lookup import looked_up
from .matching import overlapping

#: Labels and, of each, the patterns that give it, in order.
SENIORITY = [
    ("owner", [r"\bowner\b", r"\bco-owner\b", r"\bco owner\b"]),
    ("founder", [r"\bfounder\b", r"\bco-founder\b", r"\bco founder\b"]),
    (
        "c_suite",
        [
            r"\bceo\b",
            r"\bcto\b",
            r"\bcfo\b",
            r"\bcoo\b",
            r"\bcmo\b",
            r"\bcio\b",
            r"\bchief\b",
            r"\bc\.e\.o\b",
            r"\bc\.t\.o\b",
        ],
    ),
    ("vp", [r"\bvp\b", r"\bvice president\b", r"\bvice-president\b"]),
    ("director", [r"\bdirector\b"]),
    ("head", [r"\bhead of\b", r"\bhead,\b", r"\bhead\s"]),
    ("manager", [r"\bmanager\b", r"\bmanaging\b"]),
    ("partner", [r"\bpartner\b"]),
    ("senior", [r"\bsenior\b", r"\bsr\.\b", r"\bsr\s", r"\blead\b"]),
    ("entry", [r"\bjunior\b", r"\bintern\b", r"\btrainee\b", r"\bassistant\b(?!.*director|.*manager)"]),
]
#: Classes of titles, in order; what has none of them is "Other IC", a blank title "No title".
TITLE_CLASSES = [
    ("C-Level", r"\b(ceo|cfo|cto|coo|cmo|cio|cpo|chief)\b"),
    ("VP / SVP", r"\b(vp|vice president|svp)\b"),
    ("Director", r"\bdirector\b"),
    ("Head of", r"\bhead of\b|\bhead\b"),
    ("Manager", r"\bmanager\b|\bmanaging\b"),
    ("Owner / Founder", r"\b(owner|founder|co-founder|partner|principal)\b"),
    ("Board / Chair", r"\b(board|chairman|chairwoman|chairperson|member of the board)\b"),
    ("Specialist / Expert", r"\b(specialist|expert|advisor|consultant)\b"),
    ("Coordinator", r"\bcoordinator\b"),
    ("Analyst", r"\banalyst\b"),
    ("Engineer / Developer", r"\b(engineer|developer|programmer|devops|architect)\b"),
]
OTHER_TITLE, NO_TITLE = "Other IC", "No title"
#: Classes of people who contribute alone.
INDIVIDUAL = ("Specialist / Expert", "Coordinator", "Analyst", "Engineer / Developer", OTHER_TITLE, NO_TITLE)


def seniority(title: Column, groups: list[tuple[str, list[str]]] = SENIORITY) -> Column:
    """All labels of which the lower-cased title has a pattern, in order."""
    low = F.lower(X.blank_if_null(title))
    return F.array_compact(F.array(*[F.when(low.rlike("|".join(ps)), F.lit(k)) for k, ps in groups]))


def title_class(title: Column, classes: list[tuple[str, str]] = TITLE_CLASSES) -> Column:
    """The first class whose pattern the title has."""
    low = X.key(title)
    out = F.lit(OTHER_TITLE)
    for k, p in reversed(classes):
        out = F.when(low.rlike(p), F.lit(k)).otherwise(out)
    return F.when(low == "", F.lit(NO_TITLE)).otherwise(out)


def country_class(df: DataFrame, code: str, name: str, tld: str, phone: str, foreign: list[str], compound: list[str]) -> DataFrame:
    """df with ``verdict`` (domestic, foreign, uncertain) and ``why``.

    The company's country decides, as code or name; else signals of domain, e-mail domain (if its ending differs) and phone are weighed: all domestic or all foreign
    decide, a mix and none are uncertain. Endings that are neither the country's own nor on its foreign list give no signal.
    """
    # Step by step, so that each part is worked out once for all that use it.
    found = df.withColumns(
        {
            "_ending": X.tld(lead_domain(df.columns), compound),
            "_mail": X.tld(X.email_domain(F.col("email")), compound),
            "_prefix": X.phone_prefix4(*map(X.blank_if_null, own(df.columns, ("organization_phone", "company_phone", "phone")))),
            "_known": F.upper(X.strip(X.blank_if_null(F.col("company_country")))),
        }
    )
    ending, mail, prefix, known = (F.col(c) for c in ("_ending", "_mail", "_prefix", "_known"))
    signals = {"domain": (ending, ending == tld, ending.isin(*foreign)), "email": (mail, (mail == tld) & (mail != ending), mail.isin(*foreign) & (mail != ending)), "phone": (prefix, prefix.startswith(phone), (prefix != "") & ~prefix.startswith(phone))}
    listed = lambda side: F.array_join(F.array_compact(F.array(*[F.when(s[side], F.concat(F.lit(f"{k}="), s[0])) for k, s in signals.items()])), ",")
    found = found.withColumns({"_plus": listed(1), "_minus": listed(2)})
    p, m, told = F.col("_plus"), F.col("_minus"), known.isin(code.upper(), name.upper())
    verdict = F.when(known != "", F.when(told, "domestic").otherwise("foreign")).when((p != "") & (m == ""), "domestic").when((m != "") & (p == ""), "foreign").otherwise("uncertain")
    why = (
        F.when(known != "", F.when(told, F.lit("company_country")).otherwise(F.concat(F.lit("company_country="), known)))
        .when((p != "") & (m == ""), p)
        .when((m != "") & (p == ""), m)
        .when(p != "", F.concat(F.lit("conflict:domestic="), p, F.lit("|foreign="), m))
        .otherwise("no_signals")
    )
    return found.withColumns({"verdict": verdict, "why": why}).drop("_ending", "_mail", "_prefix", "_known", "_plus", "_minus")


def industry_source(codes: Column, content: Column, least: int = 50) -> Column:
    """What an industry can be told from: codes, else a website with so many characters, else none."""
    return F.when(codes, "codes").when(F.length(X.blank_if_null(content)) >= least, "website").otherwise("none")


def industry_preferred(own: Column, model: Column, unknown: tuple[str, ...] = ("", "unknown", "n/a")) -> Column:
    """The lead's own industry unless it says nothing; else the model's."""
    return F.when(X.key(own).isin(*unknown), model).otherwise(own)


def filter_gaps(active: DataFrame, capabilities: DataFrame, keep_rates: dict[str, float], most: float = 4.0) -> DataFrame:
    """Per source: filters it supports, drops but can be enforced, or loses; and how many times more rows to ask for.

    active: filter_key of the filters in use; capabilities: source, filter_key, state.
    """
    rate = F.lit(1.0)
    for k, v in keep_rates.items():
        rate = F.when(F.col("filter_key") == k, F.lit(v)).otherwise(rate)
    joined = capabilities.join(active, "filter_key", "left_semi")
    of = lambda s: F.array_join(F.array_sort(F.collect_set(F.when(F.col("state") == s, F.col("filter_key")))), ",")
    product = F.exp(F.sum(F.when(F.col("state") == "supported", F.lit(0.0)).otherwise(F.log(rate))))
    out = joined.groupBy("source").agg(of("supported").alias("supported"), of("enforceable").alias("enforceable"), of("lost").alias("lost"), product.alias("keep"))
    return out.select("source", "supported", "enforceable", "lost", F.least(F.bround(F.lit(1.0) / F.col("keep"), 1), F.lit(most)).alias("oversample"))


def mapped_values(df: DataFrame, key: str, values: str, dim: DataFrame, code: str, label: str, pos: str, keep_unknown: bool) -> DataFrame:
    """(key, values): each value of a list replaced by its labels, in order, each once; unknown ones stay or go."""
    exploded = df.select(key, F.posexplode(values).alias("i", "v"))
    d = dim.select(F.col(code).alias("c_"), F.col(label).alias("l_"), F.col(pos).alias("p_"))
    joined = exploded.join(d, F.col("v") == F.col("c_"), "left" if keep_unknown else "inner").withColumn("out", F.coalesce("l_", "v"))
    firsts = joined.groupBy(key, "out").agg(F.min(F.struct("i", F.coalesce("p_", F.lit(0)).alias("p"))).alias("at"))
    lists = firsts.groupBy(F.col(key).alias("k_")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "out"))), lambda x: x["out"]).alias(values))
    return df.select(key).join(lists, F.col(key) == F.col("k_"), "left").select(key, F.coalesce(values, F.array().cast("array<string>")).alias(values))


def revenue_buckets(df: DataFrame, key: str, low: str, high: str, buckets: DataFrame) -> DataFrame:
    """(key, buckets) that the range from low to high touches; without high a bucket counts if it ends above low and starts below a hundred times low."""
    b = buckets.select("bucket", F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    lists = overlapping(df, F.col(low), F.coalesce(F.col(high), F.col(low) * 100), b, "b_low", "b_high").groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("b_low", "bucket"))), lambda x: x["bucket"]).alias("buckets"))
    return lists.select(key, F.array_join("buckets", "|").alias("buckets"))


# --- web scores

#: Parts of a site's score and their weights.
WEIGHTS = [("performance_score", 0.35), ("is_mobile_friendly", 0.20), ("has_ssl", 0.15), ("seo_score", 0.15), ("best_practices_score", 0.15)]


def web_score() -> Column:
    """The weighted mean of what is known, cut to a whole number. Mobile counts 100 or 20, SSL 100 or 0, and 0 if it isn't known."""
    value = {"is_mobile_friendly": F.when(F.col("is_mobile_friendly"), 100).when(~F.col("is_mobile_friendly"), 20), "has_ssl": F.when(F.col("has_ssl"), 100).otherwise(0)}
    total, weight = F.lit(0.0), F.lit(0.0)
    for c, w in WEIGHTS:
        v = value.get(c, F.col(c)).cast("double")
        total = total + F.coalesce(v * w, F.lit(0.0))
        weight = weight + F.when(v.isNotNull(), F.lit(w)).otherwise(F.lit(0.0))
    return (total / weight).cast("int")


def web_insights(score: Column, most: int = 3) -> Column:
    """The first few of the site's problems, in our own words."""
    seconds = F.format_string("Main content takes %.1f seconds", "lcp_seconds")
    slow = F.when(F.col("lcp_seconds") > 4, seconds).when(F.col("lcp_seconds") > 2.5, F.concat(seconds, F.lit(", 2.5 is good")))
    every = [
        slow,
        F.when(~F.coalesce("has_ssl", F.lit(False)), F.lit("No secure connection")),
        F.when(~F.col("is_mobile_friendly"), F.lit("Hard to use on phones")),
        F.when((F.col("performance_score") < 40) & ~F.coalesce(F.col("lcp_seconds") > 4, F.lit(False)), F.format_string("Speed score %d of 100", "performance_score")),
        F.when(F.col("seo_score") < 60, F.format_string("Search score %d of 100", "seo_score")),
        F.when(F.col("cms").isNotNull() & (score < 50), F.format_string("Dated %s site, score %d of 100", "cms", score)),
    ]
    return F.slice(F.array_compact(F.array(*every)), 1, most)


def web_metrics(answer: Column) -> Column:
    """The ten values of a page-speed answer (JSON text): whole scores, seconds, layout shift, blocking time, and whether it fits phones; null where the answer has none."""
    names = {"first-contentful-paint": "fcp_seconds", "largest-contentful-paint": "lcp_seconds", "cumulative-layout-shift": "cls", "total-blocking-time": "tbt_ms", "speed-index": "speed_index_seconds"}
    categories = {"performance": "performance_score", "accessibility": "accessibility_score", "seo": "seo_score", "best-practices": "best_practices_score"}
    kind = f"lighthouseResult struct<categories: struct<{', '.join(f'`{c}`: struct<score: double>' for c in categories)}>, audits: struct<{', '.join(f'`{c}`: struct<numericValue: double>' for c in names)}, viewport: struct<score: double>>>"
    doc = F.from_json(answer, kind)["lighthouseResult"]
    score = {v: F.floor(doc["categories"][k]["score"] * 100).cast("int") for k, v in categories.items()}
    value = {v: doc["audits"][k]["numericValue"] for k, v in names.items()}
    value = {k: F.bround(v / 1000, 2) if k.endswith("_seconds") else F.bround(v, 3) if k == "cls" else v.cast("int") for k, v in value.items()}
    phones = {"is_mobile_friendly": F.when(doc.isNotNull(), F.coalesce(doc["audits"]["viewport"]["score"] == 1, F.lit(False)))}
    return F.struct(*[v.alias(k) for k, v in (score | value | phones).items()])


def with_evaluation(leads: DataFrame, evaluations: DataFrame, site: Column, result: dict[str, Column], order: tuple[str, ...] = ()) -> DataFrame:
    """leads with their site's last evaluation (see ``lookup``) and a status: no_website, not_evaluated or success."""
    got = fresh(leads.columns, "_got")
    s = X.blank_if_null(site)
    joined = looked_up(leads, evaluations, s, F.col("site"), result, got, order)
    status = F.when(s == "", "no_website").when(F.col(got).isNull(), "not_evaluated").otherwise("success")
    return joined.withColumns({"web_status": status} | {k: F.col(f"{got}.{k}") for k in result}).drop(got)


#: Niche names that are written otherwise in segments' names.
ASCII_NICHES = {"būvnieki": "buvnieki"}


def segment(niche: Column, score: Column, names: dict[str, str] = ASCII_NICHES, least: int = 70) -> Column:
    """niche_decent from so many points on, else niche_poor, also without a score; a niche that is not known is "unknown"."""
    name = F.coalesce(niche, F.lit("unknown"))
    for k, v in names.items():
        name = F.when(niche == k, F.lit(v)).otherwise(name)
    return F.concat(name, F.when(score >= least, "_decent").otherwise("_poor"))


#: What is said of a site's first problem, as ``web_insights`` words it: pattern, text, and the pattern's group that {value} stands for. The first that fits counts.
MESSAGES = [
    (r"takes ([\d.]+) seconds", "I opened {casual_name} on my phone and waited {value} seconds.", 1),
    (r"^no secure connection", "My browser warned me of {casual_name}: the connection is not secure.", 0),
    (r"^hard to use on phones", "On my phone the site of {casual_name} is hard to use.", 0),
    (r"^speed score (\d+)", "In a speed test {casual_name} got {value} of 100 points.", 1),
    (r"^search score (\d+)", "In a search test {casual_name} got {value} of 100 points.", 1),
    (r"^dated .* site, score (\d+)", "Tests gave the site of {casual_name} {value} of 100 points.", 1),
]
NO_MESSAGE = "I had a look at the site of {casual_name}."


def message(insight: Column, casual_name: Column, templates: list[tuple[str, str, int]] = MESSAGES, fallback: str = NO_MESSAGE) -> Column:
    """The text of the first template whose pattern the insight has, in any case; the fallback for other and missing insights."""
    out = F.lit(fallback)
    for pattern, said, group in reversed(templates):
        value = F.regexp_extract(insight, f"(?i){pattern}", group)
        out = F.when(F.coalesce(insight.rlike(f"(?i){pattern}"), F.lit(False)), F.replace(F.lit(said), F.lit("{value}"), value)).otherwise(out)
    return F.replace(out, F.lit("{casual_name}"), X.blank_if_null(casual_name))
