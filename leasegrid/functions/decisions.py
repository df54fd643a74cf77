"""Decision rules of a run as Column expressions: fetch outcomes, carry-forward, verdicts, routes, drift, retries, providers, text facts.

Like values.py: Columns in, Columns out, no data and no Python per row. A decision with a reason is a struct.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks of challenge pages by provider, looked for in the first 4096 bytes.
CAPTCHA = {
    "cloudflare": ("challenge-platform", "__cf_chl_", "Just a moment..."),
    "recaptcha": ("g-recaptcha", "www.google.com/recaptcha"),
    "hcaptcha": ("hcaptcha.com", "h-captcha"),
    "perimeterx": ("_pxhd", "PerimeterX"),
}
# Hosts (by suffix) and path parts that never carry units, hosts that do all the same, and parts of URLs that may.
DENIED_HOSTS = (
    "googleapis.com", "go-mpulse.net", "visitor-analytics.io", "google-analytics.com", "googletagmanager.com", "doubleclick.net",
    "facebook.com", "hotjar.com", "sentry.io", "meetelise.com", "sierra.chat", "theconversioncloud.com", "nestiolistings.com",
    "rentgrata.com", "g5marketingcloud.com", "userway.org", "omni.cafe", "comms.entrata.com",
)
DENIED_PARTS = (
    "/tag-manager/", "/mapsjs/", "/gen_204", "/analytics/", "/gtag/", "/pixel", "/beacon", "/widget/inbox_members", "/widget/contact",
    "/widget/messages", "/widget/conversations", "/widget/campaigns", "/tour/availabilities", "/html_forms/", "/yext_reviews/", "/blurb/v1/",
)
ALLOWED_HOSTS = ("api.ws.realpage.com", "onlineleasing.realpage.com")
UNIT_PARTS = ("/api/", "/availabilities", "/floor-plans", "floorplan", "availability", "/pricing", "/units", "/apartments", "getfloorplans", "getavailabilities", "propertyinfo")
# Words in the path of a page about units.
PROPERTY_WORDS = ("floor-plan", "floorplan", "apartment", "unit", "bedroom", "studio", "availability", "lease", "rent", "plan", "conventional", "pricing", "available")
# Paths that never lead to units.
NON_PROPERTY = (
    r"/(?:contact|help|support|faq|about|career|job|press|news|blog|media"
    r"|privacy|terms|legal|policy|cookie|accessibility|sitemap"
    r"|login|sign-?in|register|account|profile|password|reset"
    r"|gallery|photo|video|virtual-tour|tour|3d"
    r"|amenit|neighborhood|area|location|direction|map|nearby"
    r"|resident|portal|pay|maintenance|apply|application"
    r"|review|testimonial|team|staff|management"
    r"|pet|parking|storage|gym|pool|fitness"
    r"|schedule|appointment|call|request"
    r"|thank|confirm|success|error|404|403"
    r"|wp-content|wp-admin|wp-json|assets|static|cdn"
    r"|\.pdf|\.jpg|\.png|\.svg|\.gif|\.css|\.js)(?:/|$|\?|#)"
)
# Providers by host, by marks in a page (first match wins), by company, and the names a hint may use.
PROVIDER_HOSTS = (
    (r"^\d{3,9}\.onlineleasing\.realpage\.com$", "onesite", 0.95),
    (r"(^|\.)rentcafe\.com$", "rentcafe", 0.95),
    (r"(^|\.)sightmap\.com$", "sightmap", 0.95),
    (r"(^|\.)avaloncommunities\.com$", "avalonbay", 0.95),
    (r"(^|\.)entrata\.com$", "entrata", 0.95),
    (r"(^|\.)appfolio\.com$", "appfolio", 0.95),
    (r"(^|\.)realpage\.com$", "realpage_oll", 0.80),
)
PROVIDER_MARKS = (
    (("static.parastorage.com", "wix.com"), "wix_nopms", 0.85),
    (("squarespace.com",), "squarespace_nopms", 0.85),
    (("entrata.com", "/apartments/module/", "entrata-widget"), "entrata", 0.85),
    (("rentcafe", "yardi"), "rentcafe", 0.80),
    (("onlineleasing.realpage.com",), "onesite", 0.85),
    (("sightmap.com",), "sightmap", 0.80),
    ((".appfolio.com",), "appfolio", 0.80),
)
COMPANY_PROVIDERS = {"mark-taylor": "entrata", "mark taylor": "entrata", "lindsey management": "rentcafe", "avalonbay communities": "avalonbay"}
PROVIDERS = ("rentcafe", "entrata", "appfolio", "onesite", "sightmap", "realpage_oll", "avalonbay", "squarespace_nopms", "wix_nopms")
# Time zones by state, and patterns of facts in a unit's text.
STATE_ZONES = {
    "NY": "America/New_York", "NJ": "America/New_York", "PA": "America/New_York", "MA": "America/New_York", "CT": "America/New_York",
    "FL": "America/New_York", "IL": "America/Chicago", "TX": "America/Chicago", "CO": "America/Denver", "CA": "America/Los_Angeles",
    "WA": "America/Los_Angeles", "OR": "America/Los_Angeles", "AZ": "America/Phoenix",
}
OTHER_ZONE = "America/New_York"
RENT = r"\$\s*([\d,]+)(?:\.\d+)?"
SQFT = r"(?i)([\d,]+)\s*(?:sq\.?\s*ft|sqft|sf)\b"
BED = r"(?i)(\d+(?:\.\d)?)\s*(?:bed|bd|bedroom)s?"
BATH = r"(?i)(\d+(?:\.\d)?)\s*(?:bath|ba)s?"
STUDIO = r"(?i)\bstudio\b"
UNIT_NUMBER = r"(?i)(?:unit|apt\.?|suite|ste\.?|#)\s*#?\s*([A-Za-z]?\d{1,5}[A-Za-z]?)"
FLOOR = r"(?i)(?:floor|level)\s*:?\s*(\d{1,3})"
NUMERIC_DATE = r"\b(\d{1,2}/\d{1,2}/\d{2,4})\b"
NAMED_DATE = r"(?i)(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?\s+(\d{1,2}),?\s*(\d{4})?"
CONCESSION = r"(?i)(\d+)\s+(?:week|month)s?\s+free"


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, or null."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def _told(value: Column, reason: Column | str, first: str = "yes", second: str = "reason") -> Column:
    return F.struct(value.alias(first), (F.lit(reason) if isinstance(reason, str) else reason).alias(second))


# Fetching -------------------------------------------------------------------------------------------------------------
def captcha(body: Column) -> Column:
    """Provider of a challenge page, or null."""
    head = F.substring(body.cast("binary"), 1, 4096)
    return F.coalesce(*[F.when(_any([F.contains(head, F.lit(m).cast("binary")) for m in marks]), name) for name, marks in CAPTCHA.items()])


def classify_response(status: Column, body: Column, error: Column) -> Column:
    """struct(outcome, signature). `error` names the exception, if there was one; with a status, unknown ones don't count."""
    made = lambda outcome, signature: _told(F.lit(outcome), signature if isinstance(signature, Column) else F.lit(signature).cast("string"), "outcome", "signature")
    http = F.concat(F.lit("HTTP_"), status.cast("string"))
    provider = captcha(body)
    blocked = F.when(provider == "cloudflare", "CF_CHALLENGE").otherwise(F.concat(F.lit("CAPTCHA_"), F.upper(provider)))
    return (
        F.when(error.isin("SSLError", "SSLCertVerificationError"), made("HARD_FAIL", "ERR_SSL_PROTOCOL_ERROR"))
        .when(error == "gaierror", made("HARD_FAIL", "ERR_DNS"))
        .when(error == "TimeoutError", made("TRANSIENT", "timeout"))
        .when(error.startswith("Connection"), made("TRANSIENT", F.concat(F.lit("connection_"), error)))
        .when(status.isNull(), made("TRANSIENT", F.coalesce(error, F.lit("no_response"))))
        .when(status == 304, made("NOT_MODIFIED", None))
        .when(status == 407, made("PROXY_ERROR", http))
        .when(status == 429, made("RATE_LIMITED", http))
        .when((status == 403) & provider.isNotNull(), made("BOT_BLOCKED", blocked))
        .when(status.between(200, 299), made("OK", None))
        .when(status.between(400, 499), made("HARD_FAIL", http))
        .otherwise(made("TRANSIENT", http))
    )


def fetch_mode(force: Column, days: Column, maturity: Column, modified: Column, attempted: Column) -> Column:
    """struct(mode, reason): whole pages unless a cheap fetch is known to do. `days` is the age of the last whole fetch."""
    said = lambda mode, reason: _told(F.lit(mode), reason, "mode", "reason")
    return (
        F.when(force, said("RENDER", "manual_force"))
        .when(days.isNull() | (days > 7), said("RENDER", "stale_render_7d"))
        .when((maturity == "HOT") & (days < 1), said("GET", "hot_profile_fresh"))
        .when(modified < attempted, said("GET", "sitemap_unchanged"))
        .when((maturity == "WARM") & (days < 3), said("GET", "warm_profile_static"))
        .otherwise(said("RENDER", "default_render"))
    )


def next_retry(parked: Column, now: Column) -> Column:
    """An hour on for what was parked less than six hours ago, else a day."""
    seconds = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(parked.cast("timestamp"))
    return F.when(seconds < 6 * 3600, now + F.expr("INTERVAL 1 HOUR")).otherwise(now + F.expr("INTERVAL 1 DAY"))


def schedule_due(kind: Column, state: Column, now: Column) -> Column:
    """Stabilised: from 02:00 local time; lease-up: in the hours 8, 12, 16 and 20 between 08:00 and 21:00. `now` is UTC."""
    zones = F.create_map(*[F.lit(x) for pair in STATE_ZONES.items() for x in pair])
    zone = F.coalesce(F.try_element_at(zones, F.upper(state)), F.lit(OTHER_ZONE))
    hour = F.hour(F.from_utc_timestamp(now, zone))
    return F.when(kind == "STABILISED", hour >= 2).otherwise(hour.isin(8, 12, 16, 20))


# Results --------------------------------------------------------------------------------------------------------------
def carry_forward(outcome: Column, has_result: Column, tier: Column, n_units: Column) -> Column:
    """struct(carry, reason); the reason is empty when fresh data stands."""
    failed = outcome.isin("HARD_FAIL", "BOT_BLOCKED", "PROXY_ERROR", "NOT_MODIFIED", "TRANSIENT")
    reason = (
        F.when(failed, F.concat(F.lit("fetch_"), outcome))
        .when(~has_result, "no_scrape_result")
        .when(F.upper(tier).contains("FAIL"), "extraction_failed")
        .when((F.coalesce(n_units, F.lit(0)) == 0) & (tier != ""), "empty_units")
        .otherwise("")
    )
    return _told(reason != "", reason, "carry", "reason")


def verdict(carried: Column, outcome: Column, n_records: Column, accepted: Column, rejected: Column) -> Column:
    """struct(verdict, source). Null counts stand for a step that did not run."""
    said = lambda what, source: _told(F.lit(what), source, "verdict", "source")
    return (
        F.when(carried, said("CARRY_FORWARD", "carry_forward"))
        .when((outcome != "") & ~outcome.isin("OK", "NOT_MODIFIED"), said("FAILED_UNREACHABLE", "fetch"))
        .when(F.coalesce(n_records, F.lit(0)) == 0, said("FAILED_NO_DATA", "extract"))
        .when(rejected > accepted, said("PARTIAL", "validate"))
        .otherwise(said("SUCCESS", "extract"))
    )


def route(maturity: Column, preferred_tier: Column, timeout_ms: Column) -> Column:
    """struct(skip_to_tier, full_cascade, timeout_ms): what a profile has learned shortens the next run."""
    known = maturity.isin("HOT", "WARM")
    return F.struct(
        F.when(known, preferred_tier).alias("skip_to_tier"),
        F.coalesce(maturity != "HOT", F.lit(True)).alias("full_cascade"),
        F.when(known | (timeout_ms != 60_000), timeout_ms).alias("timeout_ms"),
    )


def drift(maturity: Column, expected: Column, n_units: Column, n_rentless: Column, timed_out: Column, failures: Column) -> Column:
    """struct(reasons, maturity after). Cold profiles expect nothing."""
    reasons = F.filter(
        F.array(
            F.when((expected > 0) & (n_units < expected * 0.7), "unit_count_drop"),
            F.when((n_units > 0) & (n_rentless == n_units), "all_rents_null"),
            F.when(timed_out & (failures >= 2), "timeout_pattern"),
        ),
        lambda x: x.isNotNull(),
    )
    kept = F.when(maturity == "COLD", F.array().cast("array<string>")).otherwise(reasons)
    severe = F.arrays_overlap(kept, F.array(F.lit("all_rents_null"), F.lit("timeout_pattern")))
    after = F.when(severe, "COLD").when((F.size(kept) > 0) & (maturity == "HOT"), "WARM").otherwise(maturity)
    return F.struct(kept.alias("reasons"), after.alias("maturity"))


def scrape_status(has_units: Column, carried: Column, failed: Column, indexed: Column) -> Column:
    """The first of: no units, carried, failed, the index's word, success."""
    return F.when(~has_units, "FAILED").when(carried, "CARRIED_FORWARD").when(failed, "FAILED").otherwise(F.coalesce(F.nullif(indexed, F.lit("")), F.lit("SUCCESS")))


# URLs and providers ---------------------------------------------------------------------------------------------------
def unit_api(url: Column) -> Column:
    """Whether a URL can carry units: no denied host or part, and a part that speaks of units."""
    low = F.lower(url)
    netloc = F.regexp_extract(low, r"^[^:]+://([^/?#]*)", 1)
    denied = ~netloc.isin(*ALLOWED_HOSTS) & _any([(netloc == h) | netloc.endswith(f".{h}") for h in DENIED_HOSTS])
    return F.coalesce(~denied & ~_any([low.contains(p) for p in DENIED_PARTS]) & _any([low.contains(p) for p in UNIT_PARTS]), F.lit(False))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def property_link(url: Column) -> Column:
    path = F.lower(url_path(url))
    return F.coalesce(_any([path.contains(w) for w in PROPERTY_WORDS]), F.lit(False))


def exploratory_link(url: Column, base: Column) -> Column:
    """A link worth a visit when all else failed: same host, not the base page itself, not about units, not a page that never has any."""
    host = lambda c: F.regexp_replace(F.lower(F.regexp_extract(c, r"^[^:]+://([^/?#]*)", 1)), r"^www\.", "")
    path = F.lower(url_path(url))
    return F.coalesce((host(url) == host(base)) & ~path.isin("", "/") & (path != F.lower(url_path(base))) & ~property_link(url) & ~path.rlike(NON_PROPERTY), F.lit(False))


def needs_retry(tier: Column, verdict: Column, units: Column, errors: Column) -> Column:
    """A failed tier or verdict, no units, or any error; a resumed run passes no errors."""
    failed = lambda c: F.coalesce(F.upper(c).contains("FAIL"), F.lit(False))
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    return failed(tier) | failed(verdict) | (size(units) <= 0) | (size(errors) > 0)


def smoke_problems(outcome: Column, found: Column, units: Column, tier: Column, banner: Column, confidence: Column) -> Column:
    """What is wrong with an event and its output (found, with so many units); a success must have units, a tier, a banner and a confidence."""
    full = F.coalesce(found & (outcome == "SUCCESS"), F.lit(False))
    tests = [
        ("outcome", ~F.coalesce(outcome.isin("SUCCESS", "SKIPPED"), F.lit(False))), ("missing output", ~F.coalesce(found, F.lit(False))), ("no units", full & (F.coalesce(units, F.lit(0)) == 0)),
        ("tier", full & ~F.coalesce(tier.between(1, 5), F.lit(False))), ("banner", full & ~F.coalesce(banner, F.lit(False))), ("confidence", full & ~F.coalesce(confidence.between(0, 1), F.lit(False))),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))


def absolute_url(base: Column, href: Column) -> Column:
    """The link as an absolute URL, or null: pseudo-links, other schemes and foreign hosts have none. Dot segments stay as they are."""
    link = F.trim(href)
    root, origin = F.regexp_extract(base, r"^([^:]+)://", 1), F.regexp_extract(base, r"^([^:]+://[^/?#]*)", 1)
    bare = lambda c: F.regexp_replace(F.btrim(F.lower(F.regexp_extract(c, r"^[^:]+://([^/?#]*)", 1)), F.lit(".")), r"^www\.", "")
    same = (bare(link) == bare(base)) | F.endswith(bare(link), F.concat(F.lit("."), bare(base)))
    folder = F.regexp_replace(url_path(base), r"[^/]*$", "")
    return (
        F.when((link == "") | link.rlike(r"^(?:mailto:|tel:|javascript:|#|data:)"), None)
        .when(link.rlike(r"(?i)^https?://"), F.when(same, link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(link.startswith("//"), F.concat(root, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("?"), F.concat(origin, url_path(base), link))
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), link))
    )


def provider_votes(url: Column, low_page: Column, company: Column) -> dict[str, Column]:
    """What host, page, path and company each say: structs of pms and confidence, or null. `low_page` is the page in lower case."""
    said = lambda name, sure: _told(name if isinstance(name, Column) else F.lit(name), F.lit(sure), "pms", "confidence")
    host = F.lower(F.regexp_extract(F.trim(url), r"^[^:]+://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    foreign = _any([host.endswith(h) for h in ("microsoft.com", "live.com", "sharepoint.com")])
    companies = F.create_map(*[F.lit(x) for pair in COMPANY_PROVIDERS.items() for x in pair])
    of_company = F.try_element_at(companies, F.lower(F.trim(company)))
    return {
        "_host": F.coalesce(*[F.when(host.rlike(p), said(name, sure)) for p, name, sure in PROVIDER_HOSTS]),
        "_page": F.coalesce(*[F.when(_any([low_page.contains(m) for m in marks]), said(name, sure)) for marks, name, sure in PROVIDER_MARKS]),
        "_path": F.when(F.lower(url_path(F.trim(url))).endswith(".aspx") & ~foreign, said("rentcafe", 0.70)),
        "_company": F.when(of_company.isNotNull(), said(of_company, 0.70)),
    }


def provider(hint: Column) -> Column:
    """struct(pms, confidence) from the columns of provider_votes(): a hint, else the host, else the vote of page, path and company.

    Votes for a provider add up; the winner's confidence is its surest vote plus 0.10 for each further one, 0.95 at most. Ties go to
    the page, then the path, then the company.
    """
    given = F.nullif(F.lower(F.trim(hint)), F.lit(""))
    said = lambda name, sure: _told(name if isinstance(name, Column) else F.lit(name), F.lit(sure) if isinstance(sure, float) else sure, "pms", "confidence")
    voters = [F.col(n) for n in ("_page", "_path", "_company")]

    def tally(at: int) -> Column:
        mine = [F.when(x["pms"] == voters[at]["pms"], x["confidence"]) for x in voters]
        total = sum((F.coalesce(m, F.lit(0.0)) for m in mine[1:]), F.coalesce(mine[0], F.lit(0.0)))
        others = sum((m.isNotNull().cast("int") for m in mine[1:]), mine[0].isNotNull().cast("int")) - 1
        combined = F.least(F.lit(0.95), F.greatest(*mine) + 0.10 * others)
        return F.when(voters[at].isNotNull(), F.struct(total.alias("total"), F.lit(-at).alias("turn"), voters[at]["pms"].alias("pms"), combined.alias("confidence")))

    best = F.greatest(*[tally(at) for at in range(3)])
    return (
        F.when(given.isin(*PROVIDERS), said(given, 0.95))
        .when(given.isNotNull(), said("custom", 0.75))
        .when(F.col("_host").isNotNull(), F.col("_host"))
        .when(best.isNotNull(), said(best["pms"], best["confidence"]))
        .otherwise(said("unknown", 0.0))
    )


# Facts in a unit's text -----------------------------------------------------------------------------------------------
def availability_text(text: Column) -> Column:
    t = F.lower(text)
    gone = _any([t.contains(w) for w in ("unavailable", "leased", "waitlist", "not available")])
    return F.when(gone, "UNAVAILABLE").when(t.contains("available") | t.contains("now") | t.rlike(r"\d{1,2}/\d{1,2}"), "AVAILABLE").otherwise("UNKNOWN")


def numeric_date(found: Column) -> Column:
    """The date of a NUMERIC_DATE; years of two digits are in this century, impossible days null."""
    parts = F.split(found, "/")
    y = parts[2].try_cast("int")
    return _day(F.when(y < 100, y + 2000).otherwise(y), parts[0], parts[1])


def named_date(month: Column, day: Column, year: Column) -> Column:
    """The date of the parts of a NAMED_DATE."""
    return _day(year, (F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(month)) + 2) / 3, day)


def _day(year: Column, month: Column, day: Column) -> Column:
    padded = lambda c, n: F.lpad(c.cast("int").cast("string"), n, "0")
    return F.try_to_date(F.concat(padded(year, 4), F.lit("-"), padded(month, 2), F.lit("-"), padded(day, 2)), "yyyy-MM-dd")


def text_matches(text: Column) -> dict[str, Column]:
    """What each pattern finds in a unit's text, for text_facts()."""
    return {
        "_unit": _found(text, UNIT_NUMBER), "_rent": _found(text, RENT), "_sqft": _found(text, SQFT), "_bed": _found(text, BED), "_bath": _found(text, BATH),
        "_studio": text.rlike(STUDIO), "_floor": _found(text, FLOOR), "_status": availability_text(text), "_now": text.rlike(r"(?i)\bnow\b"),
        "_numeric": _found(text, NUMERIC_DATE), "_named": _found(text, NAMED_DATE, 0), "_offer": _found(text, CONCESSION, 0),
    }


def text_facts(year: int) -> dict[str, Column]:
    """The facts of a unit's text out of the columns of text_matches(). A date without a year has the given one; `now` has none."""
    c, whole = F.col, lambda x: F.regexp_replace(x, ",", "").try_cast("bigint")
    rent = F.regexp_replace("_rent", ",", "").try_cast("double")
    plan = F.when(c("_studio"), "Studio").when(c("_bed").isNotNull() & c("_bath").isNotNull(), F.concat("_bed", F.lit("/"), "_bath")).when(c("_bed").isNotNull(), F.concat("_bed", F.lit(" Bed")))
    part = lambda n: F.nullif(F.regexp_extract("_named", NAMED_DATE, n), F.lit(""))
    named = named_date(part(1), part(2), F.coalesce(part(3), F.lit(str(year))))
    return {
        "unit_number": c("_unit"),
        "asking_rent": F.when(rent != 0, rent),
        "sqft": whole("_sqft"),
        "floor_plan_type": plan,
        "floor": c("_floor").try_cast("int"),
        "availability_status": c("_status"),
        "availability_date": F.when(c("_now"), None).when(c("_numeric").isNotNull(), numeric_date(c("_numeric"))).when(c("_named").isNotNull(), named),
        "concession_text": c("_offer"),
    }
