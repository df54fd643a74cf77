"""Records as runs put them out: property and unit projections of both schemas, stubs of failures, gates, and exact ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasegrid.functions import values as v

# Fixed values -----------------------------------------------------------------------------------------------------
PLATFORMS = {
    "entrata": "Powered by Entrata", "rentcafe": "Powered by RentCafe", "appfolio": "Powered by AppFolio", "yardi": "Powered by RentCafe (Yardi)",
    "realpage": "Powered by RealPage", "sightmap": "Powered by SightMap", "knock": "Powered by Knock", "respage": "Powered by Respage",
}
V1_PASSED_ON = [
    "Census Block Id", "Tract Code", "Construction Start Date", "Construction Finish Date", "Renovation Start", "Renovation Finish", "Development Company", "Property Owner",
    "Region", "Market Name", "Submarket Name", "Asset Grade in Submarket", "Asset Grade in Market", "Lease Start Date",
]
V2_PROPERTY = ["apartment_id", "proj_name", "address", "city", "state", "zip_code", "country", "phone", "email_address", "website", "pmc", "website_design", "concessions"]
UNREACHABLE = ["ERR_SSL_PROTOCOL_ERROR", "ERR_CONNECTION_TIMED_OUT", "ERR_CONNECTION_REFUSED", "ERR_NAME_NOT_RESOLVED", "ERR_CONNECTION_RESET", "ERR_CERT_AUTHORITY_INVALID", "ERR_CERT_DATE_INVALID", "NS_ERROR_UNKNOWN_HOST", "net::ERR_"]
CTA_WORDS = {"availab": 100, "floor": 80, "pricing": 70, "apply": 50, "lease": 40, "unit": 60, "apartment": 55, "resident": 30}
UNIT_SIGNALS = [
    "rent", "minRent", "maxRent", "min_rent", "max_rent", "price", "askingRent", "monthlyRent", "baseRent", "bedrooms", "beds", "bedRooms", "bed", "sqft", "squareFeet",
    "square_footage", "sq_ft", "minimumSquareFeet", "no_of_bedroom", "unitNumber", "unit_number", "unitId", "unit_id", "floorPlanName", "floor_plan_name", "floorplan_name",
    "floorplan-name", "availableDate", "available_date", "availableCount", "minimumRent", "maximumRent", "minimumMarketRent", "maximumMarketRent", "rentRange", "depositAmount",
    "numberOfUnitsDisplay",
]
REQUIRED_UNIT = ["unit_id", "market_rent_low", "market_rent_high", "available_date", "lease_link", "concessions", "amenities"]
RENT_MOST, AREA_MOST = 50_000, 20_000


# Projections ------------------------------------------------------------------------------------------------------
def _col(df: DataFrame, name: str, kind: str = "string") -> Column:
    """A column that may be absent."""
    return F.col(f"`{name}`").cast(kind) if name in df.columns else F.lit(None).cast(kind)


def _first(df: DataFrame, *names: str) -> Column:
    """As text, the first value that is neither null nor empty nor the number 0, of columns that may be absent; a text "0" is a value."""
    empty = lambda n: F.lit("") if df.schema[n].dataType.typeName() in ("string", "void") else F.lit(0).cast(df.schema[n].dataType)
    found = [F.nullif(F.col(f"`{n}`"), empty(n)).cast("string") for n in names if n in df.columns]
    return F.coalesce(*found, F.lit(None).cast("string"))


def unit_v2(df: DataFrame, captured: Column) -> Column:
    """A unit row as the V2 struct. Rents come from rent_range only where both are missing."""
    low, high = (_first(df, f"market_rent_{end}", "asking_rent") for end in ("low", "high"))
    neither = low.isNull() & high.isNull()
    span = _col(df, "rent_range")
    low, high = F.when(neither, v.rent_low(span).cast("string")).otherwise(low), F.when(neither, v.rent_high(span).cast("string")).otherwise(high)
    return F.struct(
        v.beds(_first(df, "_bedrooms", "bedrooms", "beds")).alias("beds"),
        v.baths(_first(df, "_bathrooms", "bathrooms", "baths")).alias("baths"),
        _first(df, "_floor_plan", "floor_plan_name", "floorplan_name").alias("floor_plan_name"),
        v.area(_first(df, "_sqft", "sqft", "area")).alias("area"),
        F.nullif(_first(df, "unit_id", "unit_number", "_unit_number"), F.lit("null")).alias("unit_id"),
        v.rent_value(low).alias("rent_low"),
        v.rent_value(high).alias("rent_high"),
        captured.alias("date_captured"),
        v.us_date(_col(df, "available_date")).alias("available_date"),
        v.lease_term(_first(df, "lease_term", "_lease_term")).alias("lease_term"),
        v.us_date(_first(df, "move_in_date", "_move_in_date")).alias("move_in_date"),
    )


def _pick(*found: Column) -> Column:
    """The first text that is no missing word; the owner's file comes before the page."""
    return v.first_clean(*found, words="pick")


def record_v2(props: DataFrame, units: DataFrame, key: str) -> DataFrame:
    """Property rows (file columns plain, page columns md_*) with their units; units: key and a struct column `unit`."""
    own = units.groupBy(key).agg(F.sort_array(F.collect_list("unit")).alias("units"))
    platform = F.coalesce(_first(props, "platform_detected", "md_api_provider"), F.lit(""))
    label = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in PLATFORMS.items() for x in pair]), F.lower(platform)), F.nullif(platform, F.lit("")))
    fields = {
        "apartment_id": v.safe_int(_col(props, "id")),
        "proj_name": _pick(_col(props, "name"), _first(props, "md_name", "md_title")),
        "address": _pick(_col(props, "address"), _col(props, "md_address")),
        "city": _pick(_col(props, "city"), _col(props, "md_city")),
        "state": _pick(_col(props, "state"), _col(props, "md_state")),
        "zip_code": v.zip_any(_pick(_col(props, "zip"), _col(props, "md_zip"))),
        "country": _first(props, "md_country"),
        "phone": _pick(_col(props, "phone"), _col(props, "md_telephone")),
        "email_address": _first(props, "md_email", "md_email_address"),
        "website": _first(props, "website", "base_url"),
        "pmc": _pick(_col(props, "pmc"), _col(props, "md_management_company")),
        "website_design": label,
        "concessions": _first(props, "concessions_text", "md_concessions"),
    }
    return props.select(key, *[c.alias(n) for n, c in fields.items() if n != key]).join(own, key, "left")


def record_v1(props: DataFrame, stats: DataFrame, key: str, today: Column) -> DataFrame:
    """All fields of the first schema: what units of the run come to wins over the file, the file over the page.

    stats: key, average_unit_size, total_units, unit_mix, first_move_in.
    """
    df = props.join(stats, key, "left")
    page = lambda n: _col(df, f"md_{n}")
    fields = {
        "Unique ID": _first(df, "Unique ID", "canonical_id"), "Property ID": _first(df, "Property ID", "canonical_id"),
        "Property Name": _pick(_col(df, "Property Name"), _first(df, "md_name", "md_title")), "Type": _first(df, "Type"), "Property Type": _first(df, "Property Type"),
        "Property Style": _first(df, "Property Style", "Building Type"), "Property Status": F.coalesce(_first(df, "Property Status"), F.lit("Active")),
        "Property Address": _pick(_col(df, "Property Address"), page("address")), "City": _pick(_col(df, "City"), page("city")), "State": _pick(_col(df, "State"), page("state")),
        "ZIP Code": _pick(_col(df, "ZIP Code"), page("zip")), "Latitude": F.coalesce(_col(df, "Latitude").try_cast("double"), page("latitude").try_cast("double")),
        "Longitude": F.coalesce(_col(df, "Longitude").try_cast("double"), page("longitude").try_cast("double")),
        "Year Built": _first(df, "Year Built", "md_year_built").try_cast("double"), "Stories": _first(df, "Stories", "md_stories").try_cast("double"),
        "Management Company": _first(df, "Management Company"), "Phone": _pick(_col(df, "Phone"), page("telephone")), "Website": _first(df, "Website", "base_url"),
        "Property Image URL": _first(df, "md_image_url"), "Property Gallery URLs": F.coalesce(_col(df, "md_gallery_urls", "array<string>"), F.array().cast("array<string>")),
        "Average Unit Size (SF)": _first(df, "average_unit_size", "Average Unit Size (SF)").try_cast("double"), "Total Units": _first(df, "total_units", "Total Units").try_cast("double"),
        "Unit Mix": _first(df, "unit_mix", "Unit Mix"), "First Move-In Date": _first(df, "first_move_in", "First Move-In Date"),
        **{n: _first(df, n) for n in V1_PASSED_ON}, "Update Date": today,
    }
    meta = F.struct(*[_col(df, n).alias(n) for n in ("canonical_id", "identity_source", "scrape_tier_used", "address_fp", "geo_fp", "website_fp")], _col(df, "carry_forward_used", "boolean").alias("carry_forward_used"), _col(df, "was_known", "boolean").alias("was_known"))
    return df.select(key, *[c.alias(n) for n, c in fields.items() if n != key], meta.alias("_meta"))


def failed_records(df: DataFrame, key: str, url: str, error: str, version: int) -> DataFrame:
    """A run's row for a property that failed: nulls, its address and why."""
    meta = F.struct(F.col(key).cast("string").alias("canonical_id"), F.lit("FAILED").alias("scrape_tier_used"), F.array(error).alias("scrape_errors"), F.lit(False).alias("carry_forward_used"))
    if version == 1:
        return df.select(F.col(url).alias("Website"), F.array().cast("array<string>").alias("units"), meta.alias("_meta"))
    fields = {n: F.lit(None).cast("string") for n in V2_PROPERTY} | {"apartment_id": F.col(key).cast("string").try_cast("long"), "website": F.col(url)}
    return df.select(*[c.alias(n) for n, c in fields.items()], F.array().cast("array<string>").alias("units"), meta.alias("_meta"))


def public_columns(df: DataFrame) -> DataFrame:
    """Without internal columns, whose names begin with an underscore."""
    return df.select([F.col(f"`{c}`") for c in df.columns if not c.startswith("_")])


# Gates ------------------------------------------------------------------------------------------------------------
def schema_gate(df: DataFrame) -> DataFrame:
    """df with reasons (why a unit is turned away), accepted, and unit_id, inferred from the plan where there is none."""
    rent, sqft, day = _first(df, "asking_rent", "market_rent_low", "rent"), _first(df, "sqft", "square_feet"), _first(df, "availability_date", "available_date")
    rent_value, area = rent.try_cast("double"), sqft.try_cast("double")
    given = _first(df, "unit_id", "unit_number")
    inferred = v.inferred_unit_id(_first(df, "floor_plan_name", "floor_plan_type"), _first(df, "beds", "bedrooms").try_cast("double").cast("int"), _first(df, "baths", "bathrooms").try_cast("double"), area, rent_value)
    whole = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{3}(\d{3})?)?)?(Z|[+-]\d{2}:\d{2})?)?$"
    is_day = day.rlike(whole) & F.try_to_date(F.substring(day, 1, 10), "yyyy-MM-dd").isNotNull()
    reasons = [
        F.when(rent.isNotNull() & (rent_value.isNull() | (rent_value < 0)), "INVALID_RENT_NEGATIVE").when(rent_value > RENT_MOST, "INVALID_RENT_ABSURD"),
        F.when(area < 0, "INVALID_SQFT_NEGATIVE").when(area > AREA_MOST, "INVALID_SQFT_ABSURD"),
        F.when(day.isNotNull() & ~is_day, "INVALID_DATE_FORMAT"),
        F.when(given.isNull() & inferred.isNull(), "IDENTITY_FALLBACK_INSUFFICIENT"),
    ]
    out = df.withColumns({"reasons": F.array_compact(F.array(*reasons)), "_given": given, "_inferred": inferred})
    out = out.withColumns({"accepted": F.size("reasons") == 0, "inferred_id": F.col("_given").isNull() & F.col("_inferred").isNotNull(), "unit_id": F.coalesce("_given", "_inferred")})
    return out.drop("_given", "_inferred")


def unit_issues(unit: Column, keys: Column) -> Column:
    """Issues (severity, code, field) of a unit: a map of texts and its list of keys; numbers are texts that are JSON numbers."""
    number = lambda name: F.element_at(unit, name).try_cast("double")
    issue = lambda severity, code, field: F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.lit(field).alias("field"))
    low, high, day = number("market_rent_low"), number("market_rent_high"), F.element_at(unit, "available_date")
    found = [
        F.when(F.size(F.array_except(F.array(*map(F.lit, REQUIRED_UNIT)), keys)) > 0, issue("ERROR", "UNIT_INVALID_SCHEMA", "")),
        F.when(F.coalesce(F.trim(F.element_at(unit, "unit_id")), F.lit("")) == "", issue("ERROR", "UNIT_MISSING_ID", "unit_id")),
    ]
    for name, x in (("market_rent_low", low), ("market_rent_high", high)):
        found.append(F.when(F.element_at(unit, name).isNotNull() & ~F.coalesce(x.between(v.RENT_LEAST, v.RENT_MOST), F.lit(False)), issue("WARNING", "UNIT_INVALID_RENT", name)))
    found.append(F.when(low > high, issue("WARNING", "UNIT_INVALID_RENT", "market_rent_low > market_rent_high")))
    found.append(F.when(day.isNotNull() & ~day.rlike(r"^\d{4}-\d{2}-\d{2}$"), issue("WARNING", "UNIT_INVALID_DATE", "available_date")))
    return F.array_compact(F.array(*found))


def sanity_flags(now_rent: Column, rent: Column, now_area: Column, area: Column, now_plan: Column, plan: Column) -> Column:
    """What changed too much against the last accepted row of a unit; flags turn nothing away."""
    swing = F.when(rent > 0, F.abs(now_rent - rent) / rent * 100)
    bare = lambda c: F.nullif(F.lower(F.trim(c)), F.lit(""))
    return F.array_compact(F.array(
        F.when(swing > 50, "rent_swing_>50pct").when(swing > 20, "rent_swing_>20pct"),
        F.when((area > 0) & (F.abs(now_area - area) / area * 100 > 5), "sqft_changed"),
        F.when(bare(now_plan) != bare(plan), "floor_plan_renamed"),
    ))


def has_unit_signals(first: Column) -> Column:
    """Whether a list's first object (JSON text) has at least two keys of units."""
    return F.coalesce(F.size(F.array_intersect(F.json_object_keys(first), F.array(*map(F.lit, UNIT_SIGNALS)))) >= 2, F.lit(False))


def cta_priority(text: Column) -> Column:
    """The most of the weights of the words that an anchor's text holds; 0 for none."""
    return F.greatest(F.lit(0), *[F.when(F.lower(text).contains(word), weight).otherwise(0) for word, weight in CTA_WORDS.items()])


def is_unreachable(error: Column) -> Column:
    hit = F.lit(False)
    for mark in UNREACHABLE:
        hit = hit | F.coalesce(error.contains(mark), F.lit(False))
    return hit


# Ranks and folds --------------------------------------------------------------------------------------------------
def exact_ranks(df: DataFrame, key: str, value: str, picks: dict[str, Column], splits: int = 256) -> DataFrame:
    """(key, picks) where a pick is the value at a place (from 1, an expression over the count `n`) among a key's sorted values.

    Equal values are counted first. Approximate splits deal a key's values to buckets, counts of buckets tell the one that holds the
    place, and only that bucket's distinct values are ranked; so no key is sorted or gathered as a whole, and ranks are exact.
    Splits differ from one evaluation to the next, so a bucket is handed on as its least and most value, never as its number.
    """
    each = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("c"))
    cuts = each.groupBy(key).agg(F.sum("c").alias("n"), F.percentile_approx(value, [i / splits for i in range(1, splits)], 10 * splits).alias("cuts"))
    cuts = cuts.select(F.col(key).alias("_key"), "n", F.array_distinct("cuts").alias("cuts"))
    dealt = each.join(cuts, each[key].eqNullSafe(F.col("_key"))).select(key, value, "c", "n", F.size(F.filter("cuts", lambda x: x < F.col(value))).alias("bucket"))
    upto = Window.partitionBy(key).orderBy("bucket")
    sizes = dealt.groupBy(key, "bucket", "n").agg(F.sum("c").alias("c"), F.min(value).alias("low"), F.max(value).alias("high")).withColumn("before", F.sum("c").over(upto) - F.col("c"))
    wanted = sizes.select(key, "low", "high", "before", F.explode(F.array(*[F.struct(F.lit(name).alias("pick"), place.cast("long").alias("place")) for name, place in picks.items()])).alias("w"), "c")
    wanted = wanted.where((F.col("w.place") > F.col("before")) & (F.col("w.place") <= F.col("before") + F.col("c"))).select(F.col(key).alias("_key"), "low", "high", "before", "w.pick", "w.place")
    near = each.join(wanted, each[key].eqNullSafe(wanted["_key"]) & each[value].between(F.col("low"), F.col("high")))
    rank = F.col("before") + F.sum("c").over(Window.partitionBy(key, "pick").orderBy(value))
    hit = near.withColumn("rank", rank).where((F.col("place") <= F.col("rank")) & (F.col("place") > F.col("rank") - F.col("c")))
    return hit.groupBy(key).agg(*[F.max(F.when(F.col("pick") == name, F.col(value))).alias(name) for name in picks])


def clamped_walk(df: DataFrame, key: str, order: list[str], step: Column, least: int, most: int, start: int, chunk: Column) -> DataFrame:
    """(key, last): start plus the steps in order, kept within least..most after each.

    A run of clamped steps is one clamped step, min(max(x + a, lo), hi); so a key's rows are folded chunk by chunk (`chunk` grows
    with the order and bounds how many rows meet), then the chunks.
    """
    fit = lambda x, lo, hi: F.greatest(lo, F.least(hi, x))
    one = F.struct(*[F.col(c) for c in order], step.cast("long").alias("a"))
    rows = df.groupBy(key, chunk.alias("_chunk")).agg(F.sort_array(F.collect_list(one)).alias("rows"))
    lo, hi = F.lit(least).cast("long"), F.lit(most).cast("long")
    same = F.struct(F.lit(0).cast("long").alias("a"), lo.alias("lo"), hi.alias("hi"))
    then = lambda s, a, low, high: F.struct((s["a"] + a).alias("a"), fit(s["lo"] + a, low, high).alias("lo"), fit(s["hi"] + a, low, high).alias("hi"))
    folded = rows.select(key, "_chunk", F.aggregate("rows", same, lambda s, x: then(s, x["a"], lo, hi)).alias("f"))
    chunks = folded.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_chunk", "f"))).alias("fs"))
    return chunks.select(key, F.aggregate("fs", F.lit(start).cast("long"), lambda x, s: fit(x + s["f"]["a"], s["f"]["lo"], s["f"]["hi"])).alias("last"))
