"""What follows from an attempt or a run: retries, validated records, metrics against targets, readers by name, kinds of payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leasegrid.operators import payloads, records

# Retries, targets of a day's run, and providers that have no units of their own.
MOST_ATTEMPTS, BASE_MS, AFTER_MS, LEAST_MS = 3, 500, 5000, 1000
FINAL = ("OK", "NOT_MODIFIED", "HARD_FAIL")
TARGETS = {
    "properties": (">=", 500.0), "success_rate": (">=", 0.95), "tier12_share": (">=", 0.40), "skip_rate": (">=", 0.50), "vision_rate": ("<=", 0.05), "banner_rate": (">=", 1.0),
    "p95_page_load_ms": ("<", 30_000.0), "bad_domains": ("<=", 0.0),
}
DOMAIN_FAILURE = 0.05
NO_DATA = {
    "squarespace_nopms": ("SYNDICATION_ONLY_SQUARESPACE", "Squarespace site detected — no PMS backend, syndication_only strategy"),
    "wix_nopms": ("SYNDICATION_ONLY_WIX", "Wix site detected — no PMS backend, syndication_only strategy"),
}
READERS = {"rentcafe": "rentcafe", "entrata": "entrata", "appfolio": "appfolio", "onesite": "onesite", "realpage_oll": "onesite", "sightmap": "sightmap", "avalonbay": "avalonbay"}


def retry(outcome: Column, attempt: Column, retry_after: Column, key: Column, most: int = MOST_ATTEMPTS, base_ms: int = BASE_MS) -> Column:
    """STRUCT(should_retry, wait_ms, rotate_identity) after the attempt of that number. Jitter, a quarter either way, is drawn from the key."""
    limit = F.when(outcome == "BOT_BLOCKED", 2).when(outcome == "PROXY_ERROR", 3)
    no = outcome.isin(*FINAL) | (attempt >= most) | (F.coalesce(attempt >= limit, F.lit(False)) & (outcome != "RATE_LIMITED"))
    drawn = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("double") / 2**32
    backoff = (base_ms * F.pow(F.lit(2.0), attempt - 1) * (0.75 + drawn / 2)).cast("bigint")
    seconds = F.trim(retry_after).try_cast("bigint")
    wait = F.when(outcome == "RATE_LIMITED", F.when(seconds.isNull(), AFTER_MS).otherwise(F.greatest(seconds * 1000, F.lit(LEAST_MS)))).otherwise(backoff)
    return F.struct((~no).alias("should_retry"), F.when(no, 0).otherwise(wait).cast("bigint").alias("wait_ms"), (~no & outcome.isin("BOT_BLOCKED", "PROXY_ERROR")).alias("rotate_identity"))


def validated(units: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """units of properties (key) with unit_id, status (rejected, flagged or accepted), reasons, flags, and next_tier of their property.

    history: (key, unit_id, rent, area, plan), a row a unit. Flags turn nothing away; a property's next tier is asked for where more
    than half of its units are rejected. Counts of a property are joined back by their few rows, so a large one is no single task.
    """
    gated = records.schema_gate(units)
    known = history.select(key, "unit_id", F.struct("rent", "area", "plan").alias("_known"))
    both = gated.join(known, [key, "unit_id"], "left")
    first = lambda *names: records._first(gated, *names)
    flags = records.sanity_flags(first("asking_rent", "market_rent_low", "rent").try_cast("double"), F.col("_known.rent"), first("sqft", "square_feet").try_cast("double"), F.col("_known.area"), first("floor_plan_name", "floor_plan_type"), F.col("_known.plan"))
    flags = F.when(F.col("accepted") & F.col("_known").isNotNull(), flags).otherwise(F.array().cast("array<string>"))
    told = both.withColumn("flags", flags).withColumn("status", F.when(~F.col("accepted"), "rejected").when(F.size("flags") > 0, "flagged").otherwise("accepted")).drop("_known", "accepted")
    ratio = gated.groupBy(key).agg((F.count_if(~F.col("accepted")) / F.count(F.lit(1)) > 0.5).alias("next_tier"))
    return told.join(ratio, key)


def daily_metrics(events: DataFrame, now: Column) -> DataFrame:
    """(metric, value, target, ok) of the last 24 hours, and of the last seven days for domains that fail too often.

    events: property_id, ts, outcome (SUCCESS, SKIPPED, FAILED), tier, domain, vision, banner, page_load_ms. One row of sums comes out
    of each aggregation; the load's percentile is the nearest rank.
    """
    day = events.where(F.col("ts") >= now - F.expr("INTERVAL 24 HOURS"))
    good, seen = F.col("outcome") == "SUCCESS", F.col("outcome") != "SKIPPED"
    share = lambda hit, of: F.coalesce(F.count_if(hit & of) / F.nullif(F.count_if(of), F.lit(0)), F.lit(0.0))
    every = F.lit(True)
    sums = day.agg(
        F.countDistinct("property_id").cast("double").alias("properties"), share(good, every).alias("success_rate"), share(F.col("tier").isin(1, 2), good).alias("tier12_share"), share(~seen, every).alias("skip_rate"),
        share(F.coalesce("vision", F.lit(False)), every).alias("vision_rate"), share(F.coalesce("banner", F.lit(False)), seen).alias("banner_rate"),
        F.coalesce(F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY page_load_ms)"), F.lit(0.0)).alias("p95_page_load_ms"),
    )
    week = events.where((F.col("ts") >= now - F.expr("INTERVAL 7 DAYS")) & F.col("domain").isNotNull())
    bad = week.groupBy("domain").agg((F.count_if(F.col("outcome") == "FAILED") / F.count(F.lit(1))).alias("rate")).where(F.col("rate") > DOMAIN_FAILURE)
    rows = lambda df, names: df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])).alias("m")).select("m.metric", "m.value")
    found = rows(sums, sums.columns).unionByName(rows(bad.agg(F.count(F.lit(1)).cast("double").alias("bad_domains")), ["bad_domains"]))
    held = {">=": lambda v, t: v >= t, "<=": lambda v, t: v <= t, "<": lambda v, t: v < t}
    ok, target = F.lit(None).cast("boolean"), F.lit(None).cast("string")
    for metric, (sign, most) in TARGETS.items():
        ok = F.when(F.col("metric") == metric, held[sign](F.col("value"), most)).otherwise(ok)
        target = F.when(F.col("metric") == metric, f"{sign} {most:g}").otherwise(target)
    return found.select("metric", "value", target.alias("target"), ok.alias("ok"))


def reader_of(provider: Column) -> Column:
    """STRUCT(reader, tier, error): the layout that reads a provider's payloads, generic for unknown names; none for those without data."""
    name = F.coalesce(F.lower(F.trim(provider)), F.lit(""))
    reader, tier, error = F.lit("generic"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for known, layout in READERS.items():
        reader = F.when(name == known, layout).otherwise(reader)
    for known, (label, text) in NO_DATA.items():
        reader = F.when(name == known, F.lit(None).cast("string")).otherwise(reader)
        tier, error = F.when(name == known, label).otherwise(tier), F.when(name == known, text).otherwise(error)
    return F.struct(reader.alias("reader"), tier.alias("tier"), error.alias("error"))


def provider_units(bodies: DataFrame) -> DataFrame:
    """Units of (payload_id, provider, body) by the reader of each provider; providers without data give none, whatever they send."""
    read = bodies.withColumn("_reader", reader_of(F.col("provider"))["reader"])
    parts = [payloads.unit_rows(read.where(F.col("_reader") == layout).select("payload_id", "body"), layout) for layout in [*dict.fromkeys(READERS.values()), "generic"]]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def body_kind(body: Column) -> Column:
    """STRUCT(kind, preview) of a JSON text: what it is, and how it begins. Keys of objects are in order of name."""
    value = F.try_parse_json(body)
    keys = F.map_keys(F.try_variant_get(value, "$", "map<string,variant>"))
    items = F.try_variant_get(value, "$", "array<variant>")
    inner = F.map_keys(F.try_variant_get(value, "$[0]", "map<string,variant>"))
    joined = lambda xs, n: F.array_join(F.slice(xs, 1, n), ", ")
    quoted = lambda xs, n: F.concat(F.lit("["), F.array_join(F.transform(F.slice(xs, 1, n), lambda k: F.concat(F.lit("'"), k, F.lit("'"))), ", "), F.lit("]"))
    n = F.size(items).cast("string")
    kind = (
        F.when(value.isNull() | F.is_variant_null(value), "null").when(inner.isNotNull() & items.isNotNull(), F.concat(F.lit("list[dict] ("), n, F.lit(" items, keys: "), quoted(inner, 5), F.lit(")")))
        .when(items.isNotNull(), F.concat(F.lit("list ("), n, F.lit(" items)"))).when(keys.isNotNull(), F.concat(F.lit("dict (keys: "), quoted(keys, 8), F.lit(")")))
        .when(F.schema_of_variant(value) == "STRING", "str").when(F.schema_of_variant(value) == "BOOLEAN", "bool").when(F.schema_of_variant(value) == "BIGINT", "int").otherwise("float")
    )
    preview = (
        F.when(value.isNull() | F.is_variant_null(value), "null").when(inner.isNotNull() & items.isNotNull(), F.concat(F.lit("[{"), joined(inner, 4), F.lit("...}] ("), n, F.lit(" items)")))
        .when(items.isNotNull(), F.concat(F.lit("[...] ("), n, F.lit(" items)"))).when(keys.isNotNull(), F.concat(F.lit("{"), joined(keys, 5), F.lit("...}")))
        .otherwise(F.substring(F.try_variant_get(value, "$", "string"), 1, 60))
    )
    return F.struct(kind.alias("kind"), preview.alias("preview"))
