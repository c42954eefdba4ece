"""Column functions for cleaning text, names, URLs and phones."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), with value computed once a row. A column that is named several times in an expression is written and computed as often, and steps upon steps of that multiply."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def blank_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def present(c: Column) -> Column:
    """Neither null nor empty; white space counts as present."""
    return c.isNotNull() & (c != "")


def strip(c: Column) -> Column:
    """Without white space at both ends, of any Unicode kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def nonblank(c: Column) -> Column:
    """Present even after stripping: some character is no white space."""
    return c.isNotNull() & c.rlike(r"(?U)\S")


def first_present(*cs: Column) -> Column:
    """The first that is present, else an empty string."""
    return F.coalesce(*[F.when(present(c), c) for c in cs], F.lit(""))


def first_nonblank(*cs: Column) -> Column:
    return F.coalesce(*[F.when(nonblank(c), c) for c in cs], F.lit(""))


def key(c: Column) -> Column:
    """Lower case, stripped; null becomes empty."""
    return blank_if_null(F.lower(strip(c)))


def industry_key(c: Column) -> Column:
    """A key in which "and" is spelt "&"."""
    return F.replace(key(c), F.lit(" and "), F.lit(" & "))


def industry_title(c: Column) -> Column:
    """Words capitalised if all is lower case; "&" and "or" stay; parts beside "/" are capitalised too."""
    word = lambda w: F.when(w.isin("&", "or"), w).otherwise(F.array_join(F.transform(F.split(w, "/"), _capital), "/"))
    return F.when(c == F.lower(c), F.array_join(F.transform(F.split(c, " "), word), " ")).otherwise(c)


def _capital(w: Column) -> Column:
    return F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))


def stringify(c: Column, kind: str) -> Column:
    """Lists joined by commas, structs and maps as JSON, null as empty."""
    if kind.startswith("array<string"):
        return blank_if_null(F.array_join(c, ", "))
    if kind.startswith(("struct", "map", "array")):
        return blank_if_null(F.to_json(c))
    return blank_if_null(c.cast("string"))


def any_contains(c: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(p)) for p in parts], F.lit(False))


def transliterated(c: Column, accents: str, plain: str) -> Column:
    """Accents replaced one for one, then only word characters, blanks, _ and - kept; a name for a tab or a folder."""
    return strip(F.regexp_replace(F.translate(c, accents, plain), r"[^A-Za-z0-9 _-]", ""))


# --- URLs and domains


def domain(url: Column) -> Column:
    """Host and port of a URL, or all of a text without scheme, without www. anywhere."""
    return F.replace(F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.try_parse_url(url, F.lit("PATH")), url), F.lit("www."), F.lit(""))


def domain_simple(url: Column) -> Column:
    """Schemes and www. cut away, up to the first slash."""
    bare = url
    for part in ("https://", "http://", "www."):
        bare = F.replace(bare, F.lit(part), F.lit(""))
    return F.split_part(bare, F.lit("/"), F.lit(1))


def with_scheme(url: Column) -> Column:
    """Stripped, with https:// before it if it has no scheme; blank stays blank."""
    u = strip(url)
    return F.when(u == "", u).when(u.startswith("http://") | u.startswith("https://"), u).otherwise(F.concat(F.lit("https://"), u))


def profile_key(url: Column) -> Column:
    """Lower case, no scheme, www. or trailing slash; then cut at the question mark."""
    u = F.regexp_replace(key(url), r"^https?://", "")
    u = F.regexp_replace(F.regexp_replace(u, r"^www\.", ""), "/+$", "")
    return F.split_part(u, F.lit("?"), F.lit(1))


def profile_canonical(url: Column, host: str = "linkedin.com") -> Column:
    """host and path of a profile URL without query and trailing slash; null if it is of another host."""
    u = strip(url)
    path = F.regexp_extract(u, rf"{host.replace('.', chr(92) + '.')}(/[^?#]*)", 1)
    return F.when(F.contains(F.lower(u), F.lit(host)), F.concat(F.lit(host), F.regexp_replace(path, "/+$", "")))


def tld(domain_: Column, compound: list[str]) -> Column:
    """The compound ending if there is one, else the last label with its dot; empty without a dot."""
    d = key(domain_)
    out = F.when(F.contains(d, F.lit(".")), F.concat(F.lit("."), F.element_at(F.split(d, r"\."), -1))).otherwise(F.lit(""))
    for c in reversed(compound):
        out = F.when(d.endswith(c), F.lit(c)).otherwise(out)
    return out


def email_domain(email: Column) -> Column:
    e = key(email)
    return F.when(F.contains(e, F.lit("@")), F.element_at(F.split(e, "@"), -1)).otherwise(F.lit(""))


# --- phones


def phone_prefix4(*phones: Column) -> Column:
    """The first four characters of the first phone there is, if it starts with a plus; else empty."""
    p = strip(first_present(*phones))
    return F.when(p.startswith("+"), F.substring(p, 1, 4)).otherwise(F.lit(""))


def phone_code(phone: Column, known: list[str]) -> Column:
    """The longest known code of three to one digits, else the first two digits; ``no_code`` without a plus."""
    digits = F.regexp_replace(phone, "[^0-9]", "")
    found = [F.when(F.substring(digits, 1, n).isin(*[k for k in known if len(k) == n]), F.substring(digits, 1, n)) for n in (3, 2, 1) if any(len(k) == n for k in known)]
    return F.when(~phone.startswith("+"), F.lit("no_code")).otherwise(F.concat(F.lit("+"), F.coalesce(*found, F.substring(digits, 1, 2))))


# --- names


def name_slug(url: Column) -> Column:
    """The decoded last part of a profile URL behind /in/; null without one. A plus stays a plus, a broken code stays as it is."""

    def decoded(raw: Column) -> Column:
        return F.coalesce(F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B"))), raw)

    def behind(path: Column) -> Column:
        return F.when(F.contains(path, F.lit("/in/")), bound(F.regexp_replace(F.element_at(F.split(path, "/in/"), -1), "^/+|/+$", ""), decoded))

    return bound(bound(strip(url), lambda u: F.coalesce(F.try_parse_url(u, F.lit("PATH")), u)), behind)


def slug_trimmed(slug: Column) -> Column:
    """Without a trailing id: of more than two parts the last, if it has a digit and six characters; then, still of more than two, an all-digit one of three."""

    def without_id(parts: Column, long: int, like: str) -> Column:
        last = F.element_at(parts, -1)
        drop = (F.size(parts) > 2) & (F.length(last) >= long) & last.rlike(like)
        return F.when(drop, F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1)))).otherwise(parts)

    shorter = bound(F.split(slug, "-"), lambda parts: without_id(parts, 6, "[0-9]"))
    return F.array_join(bound(shorter, lambda parts: without_id(parts, 3, "^[0-9]+$")), "-")


def slug_names(slug: Column, particles: list[str]) -> Column:
    """struct(first, last), in lower case as in the slug: the surname starts at the first particle that is neither first nor last part, else it is the last part."""

    def split(parts: Column) -> Column:
        n = F.size(parts)
        inner = F.filter(F.sequence(F.lit(2), F.greatest(n - 1, F.lit(2))), lambda i: (i < n) & F.get(parts, i - 1).isin(*particles))

        def at(start: Column) -> Column:
            first = F.when(n <= 1, F.coalesce(F.get(parts, F.lit(0)), F.lit(""))).otherwise(F.array_join(F.slice(parts, F.lit(1), F.greatest(start - 1, F.lit(1))), " "))
            last = F.when(n <= 1, F.lit("")).otherwise(F.array_join(F.slice(parts, F.greatest(start, F.lit(1)), F.greatest(n - start + 1, F.lit(1))), " "))
            return F.struct(first.alias("first"), last.alias("last"))

        return bound(F.coalesce(F.get(inner, F.lit(0)), n), at)

    return bound(F.filter(F.split(slug_trimmed(slug), "-"), lambda p: p != ""), split)


def without_legal_form(name: Column, forms: list[str]) -> Column:
    """Without the first form of the list that ends the name, whatever its case; then without trailing dots and commas."""
    n = strip(name)
    out = n
    for form in reversed(forms):
        hit = F.lower(n).endswith(form.lower())
        out = F.when(hit, strip(F.substr(n, F.lit(1), F.greatest(F.length(n) - len(form), F.lit(0))))).otherwise(out)
    return F.regexp_replace(out, "[., ]+$", "")


# --- identifiers


def hash_id(*cs: Column) -> Column:
    """MD5 of the lower-cased values joined by bars."""
    return F.md5(strip(F.lower(F.concat_ws("|", *map(blank_if_null, cs)))).cast("binary"))


def hash_id_safe(row: Column, *cs: Column) -> Column:
    """hash_id, but of the row's own number where all values are empty, so that empty rows never meet."""
    empty = reduce(lambda a, b: a & b, [~nonblank(blank_if_null(c)) for c in cs])
    return F.when(empty, F.md5(F.concat(F.lit("row:"), row.cast("string")).cast("binary"))).otherwise(hash_id(*cs))


def client_id(name: Column) -> Column:
    """Lower case, letters, digits and blanks of any script; blanks become underscores."""
    return F.regexp_replace(strip(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}\s]", "")), r"\s+", "_")


def client_id_ascii(name: Column, domain_: Column) -> Column:
    """ASCII letters and digits joined by underscores, 30 characters; else the domain's first label; else a hash."""
    slug = lambda c: F.substring(F.regexp_replace(F.regexp_replace(F.lower(blank_if_null(c)), "[^a-z0-9]+", "_"), "^_+|_+$", ""), 1, 30)
    one, two = slug(name), slug(F.split_part(blank_if_null(domain_), F.lit("."), F.lit(1)))
    return F.coalesce(F.when(one != "", one), F.when(two != "", two), F.concat(F.lit("client_"), F.substring(F.md5(blank_if_null(name).cast("binary")), 1, 8)))


def campaign_id(name: Column, day: Column) -> Column:
    return F.concat(F.replace(F.lower(name), F.lit(" "), F.lit("_")), F.lit("_"), F.date_format(day, "yyyyMMdd"))
