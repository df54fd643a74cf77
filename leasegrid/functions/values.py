"""Scalar rules of rental records as Column expressions: missing values, rounding, money, dates, identity, text.

Functions take and return Columns; nothing here touches data. Casts are `try_` casts, so dirty values become null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The three vocabularies of missing text (fixed values).
NULL_WORDS = {"alias": ("null", "none", "n/a", "na", ""), "record": ("null", "none", "n/a", ""), "pick": ("null", "None", "")}
RENT_LEAST, RENT_MOST = 200, 50_000
#: Street words and directions with their short forms (fixed values).
STREET = {
    "street": "st", "avenue": "ave", "road": "rd", "boulevard": "blvd", "drive": "dr", "lane": "ln", "court": "ct", "place": "pl",
    "av": "ave", "terrace": "ter", "parkway": "pkwy", "highway": "hwy", "circle": "cir", "square": "sq",
    "north": "n", "south": "s", "east": "e", "west": "w", "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw",
    "apartment": "apt", "suite": "ste", "floor": "fl",
}


# Missing values -----------------------------------------------------------------------------------------------------
def clean(c: Column, words: str = "alias") -> Column:
    """Trimmed text, or null for a missing word."""
    t = F.trim(c)
    same = t if words == "pick" else F.lower(t)
    return F.when(~same.isin(*NULL_WORDS[words]), t)


def first_clean(*cols: Column, words: str = "alias") -> Column:
    return F.coalesce(*[clean(c, words) for c in cols])


def truthy(*cols: Column) -> Column:
    """The first value that is neither null nor zero nor empty; numbers and texts by their own rule."""
    return F.coalesce(*[F.when(~c.cast("string").isin("", "0", "0.0", "false"), c) for c in cols])


# Rounding and percentiles ---------------------------------------------------------------------------------------------
def half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c, digits)


def half_up(c: Column, digits: int = 0) -> Column:
    """Towards plus infinity at .5."""
    scale = 10**digits
    return F.floor(c * scale + 0.5) / scale


def _sorted(c: Column) -> Column:
    return F.sort_array(F.collect_list(c))


def upper_median(c: Column) -> Column:
    """sorted[floor(n / 2)], 0 for none."""
    xs = _sorted(c)
    return F.coalesce(F.try_element_at(xs, (F.floor(F.size(xs) / 2) + 1).cast("int")), F.lit(0.0))


def index_percentile(c: Column, p: float) -> Column:
    """sorted[int(n * p)]."""
    xs = _sorted(c)
    return F.try_element_at(xs, (F.floor(F.size(xs) * p) + 1).cast("int"))


def nearest_percentile(c: Column, p: float) -> Column:
    """sorted[round half even(p / 100 * (n - 1))]."""
    xs = _sorted(c)
    return F.try_element_at(xs, (F.bround(F.lit(p / 100) * (F.size(xs) - 1)) + 1).cast("int"))


# Money, numbers -------------------------------------------------------------------------------------------------------
def money_to_int(c: Column) -> Column:
    """Digits and dots kept, then truncated; two dots make null."""
    return F.floor(F.regexp_replace(c, r"[^0-9.]", "").try_cast("double")).cast("bigint")


def rent_tokens(c: Column) -> Column:
    """Whole numbers in a text that can be rents."""
    raw = F.transform(F.regexp_extract_all(F.regexp_replace(c, ",", ""), F.lit(r"(\d+)"), F.lit(1)), lambda x: x.try_cast("bigint"))
    return F.filter(raw, lambda x: x.between(RENT_LEAST, RENT_MOST))


def rent_low(c: Column) -> Column:
    return F.array_min(rent_tokens(c))


def rent_high(c: Column) -> Column:
    return F.array_max(rent_tokens(c))


def rent_range_text(lo: Column, hi: Column) -> Column:
    dollars = lambda c: F.concat(F.lit("$"), F.format_number(c, 0))
    return F.when(lo.isNotNull() & hi.isNotNull() & (lo != hi), F.concat(dollars(lo), F.lit(" - "), dollars(hi))).when(lo.isNotNull(), dollars(lo)).when(hi.isNotNull(), dollars(hi)).otherwise("")


def rent_is_sane(c: Column) -> Column:
    return c.isNull() | c.between(RENT_LEAST, RENT_MOST)


def safe_int(c: Column) -> Column:
    return F.regexp_replace(c, ",", "").try_cast("double").cast("bigint")


def rent_value(c: Column) -> Column:
    """Over 1, else null; $ and commas may be in it."""
    x = F.regexp_replace(c, r"[$,]", "").try_cast("double")
    return F.when(x > 1, x)


def beds(c: Column) -> Column:
    t = F.lower(F.trim(c))
    return F.when(t.isin("studio", "s"), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(7), F.floor(t.try_cast("double")).cast("int"))) * F.when(t.try_cast("double").isNotNull(), 1))


def baths(c: Column) -> Column:
    x = c.try_cast("double")
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(10.0), F.bround(x * 2) / 2)))


def area(c: Column) -> Column:
    """Whole number from 150 to 10000, else -1."""
    x = F.floor(c.try_cast("double")).cast("int")
    return F.coalesce(F.when(x.between(150, 10_000), x), F.lit(-1))


def bed_label(n: Column, name: Column) -> Column:
    return F.when((n == 0) | F.lower(F.coalesce(name, F.lit(""))).contains("studio"), "Studio").when(n.isNotNull(), F.concat(n.cast("string"), F.lit(" Bedroom"))).otherwise("")


def mix_label(n: Column) -> Column:
    return F.when(n == 0, "Studio").otherwise(F.concat(n.cast("string"), F.lit("BR")))


def lease_term(c: Column) -> Column:
    x = F.floor(c.try_cast("double")).cast("int")
    return F.when(x > 1, x)


def clamp01(c: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


# Places and identity --------------------------------------------------------------------------------------------------
def zip_leading(c: Column) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"^(\d{5})", 1)


def zip_any(c: Column) -> Column:
    digits = F.regexp_replace(c, r"\D", "")
    run = F.regexp_extract(c, r"(\d{5})", 1)
    return F.when(run != "", run).when(digits != "", F.lpad(digits, 5, "0"))


def address(c: Column) -> Column:
    words = F.filter(F.split(F.regexp_replace(F.lower(c), r"(?U)[^\w]+", " "), " "), lambda w: w != "")
    short = F.create_map(*[F.lit(x) for pair in STREET.items() for x in pair])
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.try_element_at(short, w), w)), " ")


def host(url: Column) -> Column:
    """Lower-cased authority (port kept) without `www.` and outer dots; a missing scheme is no hindrance."""
    full = F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), url).otherwise(F.concat(F.lit("http://"), url))
    return F.regexp_replace(F.btrim(F.lower(F.regexp_extract(full, r"^[^:]+://([^/?#]*)", 1)), F.lit(".")), r"^www\.", "")


def short_sha1(c: Column) -> Column:
    return F.substring(F.sha1(c), 1, 16)


def address_fingerprint(street: Column, city: Column, state: Column, code: Column) -> Column:
    a, z = address(F.coalesce(street, F.lit(""))), zip_leading(code)
    parts = F.concat_ws("|", a, F.lower(F.coalesce(city, F.lit(""))), F.lower(F.coalesce(state, F.lit(""))), z)
    return F.when((a != "") & ((F.coalesce(city, F.lit("")) != "") | (z != "")), F.concat(F.lit("addr_"), short_sha1(parts))).otherwise("")


def geo_fingerprint(lat: Column, lng: Column) -> Column:
    ok = lat.between(-90, 90) & lng.between(-180, 180) & ~((lat == 0) & (lng == 0))
    return F.when(ok, F.concat(F.lit("geo_"), F.format_string("%.4f", lat), F.lit("_"), F.format_string("%.4f", lng))).otherwise("")


def website_fingerprint(url: Column) -> Column:
    h = host(F.coalesce(url, F.lit("")))
    return F.when(h != "", F.concat(F.lit("web_"), short_sha1(h))).otherwise("")


#: Order of identity sources with their confidence (fixed values).
IDENTITY = (("unique", 1.0), ("property", 0.95), ("address", 0.80), ("geo", 0.65), ("website", 0.45))


def identity(found: dict[str, Column]) -> tuple[Column, Column, Column]:
    """(id, source, confidence) of the first source with a value; unresolved has confidence 0."""
    value = {k: clean(found[k]) for k, _ in IDENTITY if k in found}
    pick = lambda what: reduce(lambda w, kv: w.when(value[kv[0]].isNotNull(), what(kv)), [kv for kv in IDENTITY if kv[0] in value][1:], F.when(value[[k for k, _ in IDENTITY if k in value][0]].isNotNull(), what([kv for kv in IDENTITY if kv[0] in value][0])))
    return F.coalesce(*value.values()), pick(lambda kv: F.lit(kv[0])).otherwise("unresolved"), pick(lambda kv: F.lit(kv[1])).otherwise(0.0)


def inferred_unit_id(plan: Column, n_beds: Column, n_baths: Column, sqft: Column, rent: Column) -> Column:
    """Stable id of a unit without one: plan, beds, baths, area to 10, rent to 25."""
    near = lambda c, step: F.coalesce((F.bround(c / step) * step).cast("bigint").cast("string"), F.lit(""))
    key = F.concat_ws("|", F.lower(F.trim(plan)), n_beds.cast("string"), F.coalesce(n_baths.cast("string"), F.lit("0")), near(sqft, 10), near(rent, 25))
    return F.when((F.trim(plan) != "") & n_beds.isNotNull() & (n_beds != 0), F.concat(F.lit("inferred_"), F.substring(F.sha2(key, 256), 1, 12)))


# Dates ----------------------------------------------------------------------------------------------------------------
DATE_FORMATS = ("M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "M-d-yyyy", "d-M-yyyy")


def iso_date(c: Column) -> Column:
    """ISO text kept by shape, else the first format that fits."""
    t = F.trim(c)
    iso = F.regexp_extract(t, r"^(\d{4}-\d{2}-\d{2})", 1)
    return F.coalesce(F.when(iso != "", iso), *[F.date_format(F.try_to_date(t, f), "yyyy-MM-dd") for f in DATE_FORMATS])


def us_date(c: Column) -> Column:
    """ISO prefix, or m/d/yy(yy) without a calendar check."""
    t, us = F.trim(c), r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})$"
    iso = F.regexp_extract(t, r"^(\d{4}-\d{2}-\d{2})", 1)
    year = F.regexp_extract(t, us, 3)
    made = F.concat_ws("-", F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year), F.lpad(F.regexp_extract(t, us, 1), 2, "0"), F.lpad(F.regexp_extract(t, us, 2), 2, "0"))
    return F.when(iso != "", iso).when(year != "", made)


# Decisions ------------------------------------------------------------------------------------------------------------
def availability(c: Column) -> Column:
    """Null for null; any text with "un" in it can't be available, unless one of the plain words says so."""
    t = F.lower(F.trim(c))
    return (
        F.when(t.isin("true", "1", "yes", "y", "available"), "AVAILABLE")
        .when(t.isin("false", "0", "no", "n", "unavailable", "leased"), "UNAVAILABLE")
        .when(t.contains("avail") & ~t.contains("un"), "AVAILABLE")
        .when(t.contains("unavail") | t.contains("leased"), "UNAVAILABLE")
        .when(t.isNotNull(), "UNKNOWN")
    )


def property_status(c: Column) -> Column:
    t = F.upper(F.coalesce(c, F.lit("")))
    return F.when(t.contains("LEASE"), "LEASE_UP").when(t.contains("STAB"), "STABILISED").when(t.contains("OFFLINE") | t.contains("CLOSED"), "OFFLINE").otherwise("ACTIVE")


def hash_sample(key: Column, rate: float = 0.075) -> Column:
    """A fixed share of keys by the first 32 bits of their SHA-256."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double") / 4294967295 < rate


def change_percent(now: Column, before: Column) -> Column:
    return F.when(before != 0, F.abs(now - before) / F.abs(before) * 100)


def swing_flag(now: Column, before: Column) -> Column:
    p = change_percent(now, before)
    return F.when(p > 50, "rent_swing_gt_50pct").when(p > 20, "rent_swing_gt_20pct")


def tier_confidence(n: Column, cap: float, base: float, step: float) -> Column:
    return F.least(F.lit(cap), F.lit(base) + F.lit(step) * n)


def mask_credentials(c: Column) -> Column:
    return F.regexp_replace(c, r"://[^/@\s]+@", "://***@")


def retry_delay_ms(attempt: Column, base: int = 1000) -> Column:
    return F.lit(base) * F.pow(F.lit(2), attempt - 1)


def maturity(successes: Column, failures: Column) -> Column:
    return F.when(failures >= 3, "COLD").when(successes >= 3, "HOT").when(successes >= 1, "WARM").otherwise("COLD")
