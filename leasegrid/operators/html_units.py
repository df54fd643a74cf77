"""Unit rows from HTML pages: JSON-LD blocks and visible containers.

A page frame holds (page_id, html STRING). Only finding containers needs an HTML parser; it runs in Arrow batches, a page at a
time, and hands texts on to Column expressions.
"""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leasegrid.functions import values as v
from leasegrid.operators import walk
from leasegrid.operators.page_tree import read_marks

# Containers looked for, specific ones first; how many of one kind a page may hold; patterns of unit facts.
CONTAINERS = (
    ".unit-card", ".unit-row", ".unit-item", ".unitContainer", ".floorplan", ".floor-plan", ".floorplan-card", ".floor-plan-card",
    ".floorplan-row", ".floor-plan-row", ".floorplanItem", ".fp-card", ".apartment", ".apartment-card", ".apartment-row", ".listing",
    ".listing-card", ".listing-item", ".pricing-card", ".pricing-item", ".pricing-row", ".plan-card", "[data-unit]", "[data-floorplan]",
    "[data-floor-plan]", "[data-apartment]", "article.unit", "article.floorplan", "article.apartment", "div.unit", "div.floorplan",
    "div.apartment", "div.listing",
)
PLACE = {selector: at for at, selector in enumerate(CONTAINERS)}
MOST_CONTAINERS, TEXT_LEAST, TEXT_MOST = 80, 10, 3000
RENT = r"\$\s*(\d{1,3}(?:,\d{3})*|\d{3,5})(?:\.\d{2})?"
SQFT = r"(?i)(\d{2,5})\s*(?:sq\.?\s*ft\.?|sqft|square\s*feet)"
BEDS = r"(?i)(\d+(?:\.\d+)?)\s*(?:bed|br\b|bedroom)"
BATHS = r"(?i)(\d+(?:\.\d+)?)\s*(?:bath|ba\b|bathroom)"
UNIT_NUMBER = r"(?i)(?:unit|apt|apartment|#)\s*#?\s*([A-Za-z0-9][A-Za-z0-9\-]{0,10})"
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Containers(HTMLParser):
    """Collects the text of every element that one of CONTAINERS selects."""

    def __init__(self) -> None:
        super().__init__()
        self.found: list[tuple[int, list[str]]] = []
        self._size: list[int] = []
        self._open: list[tuple[str, list[int]]] = []

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        mine = []
        if attrs:
            names = {f".{c}" for k, value in attrs if k == "class" for c in (value or "").split()}
            signs = names | {f"{tag}{n}" for n in names} | {f"[{k}]" for k, _ in attrs}
            for at in sorted(PLACE[s] for s in signs if s in PLACE):
                mine.append(len(self.found))
                self.found.append((at, []))
                self._size.append(0)
        self._open.append((tag, mine))

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self._open):
            while self._open.pop()[0] != tag:
                pass

    handle_closed = handle_endtag

    def handle_data(self, data):
        if (text := data.strip()) and not (self._open and self._open[-1][0] in ("script", "style")):
            for _, mine in self._open:
                for i in mine:
                    # What is too long to be read stays too long; more text makes nested pages cost the square of their depth.
                    if self._size[i] <= TEXT_MOST:
                        self.found[i][1].append(text)
                        self._size[i] += len(text) + 1


def containers(pages: DataFrame) -> DataFrame:
    """(page_id, selector INT, pos INT, text) of the containers of each page; selectors with too many are left out."""
    id_type = pages.schema["page_id"].dataType.simpleString()

    def scan(batches):
        for batch in batches:
            ids, rows = [], []
            for i, html in enumerate(batch.column(1).to_pylist()):
                parser = _Containers()
                read_marks(parser, html)
                many = Counter(at for at, _ in parser.found)
                for pos, (at, texts) in enumerate(parser.found):
                    if many[at] <= MOST_CONTAINERS:
                        ids.append(i)
                        rows.append((at, pos, " ".join(texts)))
            columns = zip(*rows, strict=True) if rows else [()] * 3
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), *arrays], names=["page_id", "selector", "pos", "text"])

    return pages.select("page_id", F.col("html").cast("string").alias("html")).dropna().mapInArrow(scan, f"page_id {id_type}, selector int, pos int, text string")


def dom_units(pages: DataFrame) -> DataFrame:
    """Units of the first selector that gives any: a container needs a rent, and beds, an area or the word studio."""
    text = F.col("text")
    one = lambda pattern: F.regexp_extract(text, pattern, 1)
    rents = F.filter(F.transform(F.regexp_extract_all(text, F.lit(RENT), F.lit(1)), lambda r: F.regexp_replace(r, ",", "").try_cast("int")), lambda r: r.between(v.RENT_LEAST, v.RENT_MOST))
    studio = text.rlike(r"(?i)\bstudio\b")
    beds = F.when(one(BEDS) != "", one(BEDS)).when(studio, "0").otherwise("")
    seen = containers(pages).where(F.length("text").between(TEXT_LEAST, TEXT_MOST))
    # A generator keeps the optimizer from reading a text again for the filter and for each use of a column.
    read = seen.select("page_id", "selector", "pos", F.inline(F.array(F.struct(
        rents.alias("_rents"), one(SQFT).alias("sqft"), beds.alias("bedrooms"), one(BATHS).alias("bathrooms"), one(UNIT_NUMBER).alias("unit_number"), studio.alias("_studio"),
    )))).where("size(_rents) > 0 and (sqft <> '' or bedrooms <> '')")
    told = read.select("page_id", "selector", "pos", F.array_min("_rents").alias("rent_low"), F.array_max("_rents").alias("rent_high"), "sqft", "bedrooms", "bathrooms", "unit_number", "_studio")
    same = F.when(F.col("unit_number") != "", F.col("unit_number")).otherwise(F.concat_ws("|", "rent_low", "rent_high", "sqft", "bedrooms"))
    best = told.withColumn("_best", F.min("selector").over(Window.partitionBy("page_id"))).where("selector = _best")
    turn = F.row_number().over(Window.partitionBy("page_id", same).orderBy("pos"))
    label = F.when(~F.col("bedrooms").isin("", "0"), F.concat("bedrooms", F.lit("BR"))).when(F.col("_studio"), "Studio").otherwise("")
    return best.withColumn("_turn", turn).where("_turn = 1").select("page_id", "pos", "unit_number", "rent_low", "rent_high", "sqft", "bedrooms", "bathrooms", label.alias("bed_label"))


def jsonld_nodes(pages: DataFrame, not_types: tuple[str, ...] = (), keys: tuple[str, ...] | None = None) -> DataFrame:
    """(page_id, node VARIANT) of every object that has @type in a page's JSON-LD blocks, however deep it is nested.

    Objects whose only type is one of not_types, as a text, are left out before they are written again; of others `keys` are kept, if given.
    """
    block = r'(?is)<script[^>]*type\s*=\s*["\']application/ld\+json["\'][^>]*>(.*?)</script>'
    texts = pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(block), F.lit(1))).alias("_raw"))
    return walk.every_node(texts, "_raw", wanted=lambda x: isinstance(x, dict) and (kind := x.get("@type")) is not None and not (isinstance(kind, str) and kind in not_types), keys=keys)


def jsonld_units(pages: DataFrame) -> DataFrame:
    """A row for each JSON-LD object whose type ends in Apartment: number, rent, status, area and plan type."""
    node = jsonld_nodes(pages)
    text = lambda path: F.nullif(F.trim(F.try_variant_get("node", path, "string")), F.lit(""))
    number = lambda c: F.nullif(F.regexp_replace(c, "[^0-9.]", ""), F.lit("")).try_cast("double")
    types = F.coalesce(F.try_variant_get("node", "$['@type']", "array<string>"), F.array(text("$['@type']")))
    offers = F.coalesce(F.try_variant_get("node", "$.offers", "array<variant>"), F.array(F.try_variant_get("node", "$.offers", "variant")))
    first = lambda key: F.get(F.filter(F.transform(offers, lambda o: F.try_variant_get(o, f"$.{key}", "string")), lambda s: s.isNotNull()), F.lit(0))
    stock = F.regexp_extract(first("availability"), r"(?:^|schema\.org/)(InStock|OutOfStock)$", 1)
    status = F.when(stock == "InStock", "AVAILABLE").when(stock == "OutOfStock", "UNAVAILABLE").otherwise("UNKNOWN")
    return node.where(F.exists(types, lambda t: t.endswith("Apartment"))).select(
        "page_id", F.coalesce(text("$.name"), text("$.identifier")).alias("unit_number"), number(first("price")).alias("asking_rent"), status.alias("availability_status"),
        number(F.coalesce(F.try_variant_get("node", "$.floorSize.value", "string"), text("$.floorSize"))).cast("int").alias("sqft"),
        F.coalesce(text("$.accommodationCategory"), text("$.numberOfRooms")).alias("floor_plan_type"),
    )


# Words a script with units holds, the form of an assignment, and globals that frameworks fill.
UNIT_WORDS = r"(?i)floor.?plan|floorPlan|units|avail|rent|bedroom|sqft|pricing"
ASSIGNMENT = r"(?:var|let|const|window\.)\s*(\w+)\s*=\s*(\[\s*\{[\s\S]*?\}\s*\]|\{[\s\S]*?\})\s*;"
GLOBALS = ("__NEXT_DATA__", "__INITIAL_STATE__", "__NUXT__", "__remixContext", "__APP_DATA__", "pageData", "__data__", "initialState", "serverData")
BLOCK_LEAST, BLOCK_MOST, SCRIPT_LEAST, SCRIPT_MOST = 200, 1_000_000, 300, 500_000


def embedded_json(pages: DataFrame) -> DataFrame:
    """(page_id, url, body) of JSON inside scripts: typed blocks, assignments next to unit words, and known globals.

    `url` names where the text was found, `body` is the JSON text. Texts that don't parse give no rows; a global that is also an
    assignment gives two. A narrow map of every page, without a shuffle.
    """
    script = r"(?is)<script\b([^>]*)>(.*?)</script>"
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit(script), F.lit(1)).alias("attrs"), F.regexp_extract_all("html", F.lit(script), F.lit(2)).alias("text"))
    named = lambda name: F.regexp_extract("attrs", rf"(?i)(?:^|\s){name}\s*=\s*[\"']?([^\"'\s>]+)", 1)
    found = pages.select("page_id", F.explode(both).alias("s")).select("page_id", F.col("s.attrs").alias("attrs"), F.col("s.text").alias("text"))
    found = found.select("page_id", "text", F.lower(named("type")).alias("type"), named("src").alias("src"), F.coalesce(F.nullif(named("id"), F.lit("")), F.nullif(named("data-id"), F.lit("")), F.lit("anon")).alias("id"))
    n = F.length("text")
    made = lambda url, body: F.struct(url.alias("url"), body.alias("body"))
    block = F.when((F.col("type") == "application/json") & n.between(BLOCK_LEAST, BLOCK_MOST), F.array(made(F.concat(F.lit("embedded:json-block:"), "id"), F.col("text"))))
    plain = (F.col("src") == "") & F.col("type").isin("", "text/javascript", "application/javascript") & n.between(SCRIPT_LEAST, SCRIPT_MOST) & F.col("text").rlike(UNIT_WORDS)
    pairs = F.arrays_zip(F.regexp_extract_all("text", F.lit(ASSIGNMENT), F.lit(1)).alias("name"), F.regexp_extract_all("text", F.lit(ASSIGNMENT), F.lit(2)).alias("body"))
    assigned = F.transform(F.filter(pairs, lambda x: F.length(x["body"]) >= BLOCK_LEAST), lambda x: made(F.concat(F.lit("embedded:script-var:"), x["name"]), x["body"]))
    known = F.array(*[made(F.lit(f"embedded:js:{g}"), F.regexp_extract("text", rf"window\.{g}\s*=\s*(\{{[\s\S]*?\}})\s*;", 1)) for g in GLOBALS])
    rows = found.select("page_id", F.explode(F.coalesce(block, F.when(plain, F.concat(assigned, known)))).alias("r")).select("page_id", "r.url", "r.body")
    return rows.where((F.col("body") != "") & F.try_parse_json("body").isNotNull())


# Marks of frameworks in a page, and the form of a rent.
FRAMEWORKS = (
    ("__NEXT_DATA__", "next"), ("__NUXT__", "nuxt"), ("ng-app", "angular"), ("data-reactroot", "react"), ("__svelte", "svelte"),
    ("data-v-app", "vue"), ("static.parastorage.com", "wix"), ("squarespace.com", "squarespace"), ("cdn.shopify.com", "shopify"),
)
RENT_SIGN = r"(?i)\$\s?\d{3,4}(?:[,.]\d{3})?(?:/mo|\s*/\s*month)?"


def page_shape(pages: DataFrame) -> DataFrame:
    """page_id, sizes in bytes, counts, framework marks and how likely scripts draw the page (0 to 1). Null pages count as empty."""
    html = F.coalesce("html", F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", ""), r"<[^>]+>", "")
    n = lambda pattern: F.regexp_count(html, F.lit(pattern))
    seen = pages.select(
        "page_id",
        F.octet_length(html).alias("body_bytes"),
        F.octet_length(bare).alias("text_bytes"),
        n(r"(?i)<script\b").alias("n_scripts"),
        n(r"(?i)<iframe\b").alias("n_iframes"),
        n(RENT_SIGN).alias("n_rents"),
        F.filter(F.array(*[F.when(html.contains(mark), name) for mark, name in FRAMEWORKS]), lambda x: x.isNotNull()).alias("frameworks"),
    )
    drawn = F.arrays_overlap("frameworks", F.array(F.lit("next"), F.lit("nuxt")))
    share = F.when(F.col("body_bytes") > 0, 0.4 * (1.0 - F.least(F.lit(1.0), F.col("text_bytes") / F.greatest(F.lit(1), F.col("body_bytes"))))).otherwise(0.0)
    score = share + F.when(drawn, 0.3).otherwise(0.0) + F.when((F.col("n_rents") == 0) & (F.col("text_bytes") < 5000), 0.3).otherwise(0.0)
    return seen.withColumn("spa", F.bround(F.least(F.lit(1.0), score), 2))


# What makes a link likely to lead to units, by its text, path and host, and what no such link holds.
LINK_TEXT = (
    ("availability", 100), ("floor plan", 90), ("floor-plan", 90), ("floorplan", 85), ("pricing", 80), ("rent", 70), ("apartment", 60),
    ("unit", 55), ("lease", 50), ("tour", 40), ("apply", 30), ("schedule", 20),
)
LINK_PATH = (
    ("/floor-plan", 95), ("/floorplan", 90), ("/availability", 95), ("/pricing", 80), ("/apartments", 70), ("/rent", 60), ("/units", 85),
    ("/leasing", 50), ("/lease", 45), ("/floorplans", 90), ("/availabilities", 95),
)
LINK_HOST = (
    (".rentcafe.com", 120), (".appfolio.com", 120), (".onlineleasing.realpage.com", 120), ("sightmap.com", 110), (".entrata.com", 115), ("commoncf.entrata.com", 115),
)
LINK_NEVER = (
    "tel:", "mailto:", "javascript:", "#", ".pdf", ".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".mp4", ".mov", "/blog/", "/news/", "/privacy", "/terms",
    "/accessibility", "/sitemap", "facebook.com/", "twitter.com/", "instagram.com/", "linkedin.com/", "youtube.com/", "/contact", "/careers", "/jobs",
)
ANCHOR = r"""(?is)<a\s(?:[^>]*\s)?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""


def ranked_links(pages: DataFrame, limit: int = 5) -> DataFrame:
    """(page_id, href, score, anchor, place): a page's best internal links, by the weights of their text, path and host.

    Links stay on the page's site or lead to a known portal. Of equal scores the link that comes first is better; of repeated
    links the best score counts. References are made absolute without resolving `..`.
    """
    href, trimmed = F.col("_href"), F.trim(F.regexp_replace(F.regexp_replace("text", "<[^>]*>", " "), r"\s+", " "))
    low = F.lower(href)
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(2)).alias("text"))
    site = F.regexp_extract("url", r"^(https?)://", 1), F.regexp_extract("url", r"^https?://([^/?#]*)", 1), F.regexp_extract("url", r"^https?://[^/?#]*([^?#]*/)", 1)
    links = pages.select("page_id", "url", F.posexplode(both).alias("pos", "l")).select("page_id", "url", "pos", F.trim("l.href").alias("_href"), F.col("l.text").alias("text"))
    links = links.where((href != "") & ~F.array_contains(F.array(*[low.contains(x) for x in LINK_NEVER]), True))
    full = (
        F.when(low.rlike("^[a-z][a-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(site[0], F.lit(":"), href)).when(href.startswith("/"), F.concat(site[0], F.lit("://"), site[1], href))
        .otherwise(F.concat(site[0], F.lit("://"), site[1], F.coalesce(F.nullif(site[2], F.lit("")), F.lit("/")), href))
    )
    host = lambda c: F.lower(F.regexp_extract(c, r"^https?://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    # Generators keep the optimizer from copying these expressions into every use of their columns.
    once = lambda df, **new: df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in new.items()]))))
    links = once(links, href=full, anchor=F.substring(F.lower(trimmed), 1, 120)).where(F.col("href").rlike("^https?://"))
    links = once(links, own=host(F.col("url")), host=host(F.col("href")), path=F.lower(F.regexp_extract("href", r"^https?://[^/?#]*([^?#]*)", 1)))
    dotted = lambda c: F.concat(F.lit("."), c)
    same = (F.col("host") == F.col("own")) | F.endswith("host", dotted("own")) | F.endswith("own", dotted("host"))
    portal = F.array_contains(F.array(*[F.col("host").endswith(x) for x, _ in LINK_HOST]), True)
    of = lambda c, hit, weights: sum((F.when(hit(F.col(c), x), n).otherwise(0) for x, n in weights), F.lit(0))
    score = of("anchor", lambda c, x: c.contains(x), LINK_TEXT) + of("path", lambda c, x: c.contains(x), LINK_PATH) + of("host", lambda c, x: c.endswith(x), LINK_HOST)
    kept = links.where((same | portal) & (F.regexp_replace("href", "/+$", "") != F.regexp_replace("url", "/+$", ""))).withColumn("score", score).where("score > 0")
    best = kept.groupBy("page_id", "href").agg(F.max("score").alias("score"), F.min("pos").alias("pos"), F.min_by("anchor", F.struct(-F.col("score"), F.col("pos"))).alias("anchor"))
    place = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("score"), "pos"))
    return best.withColumn("place", place).where(F.col("place") <= limit).select("page_id", "href", "score", "anchor", "place")


# JSON-LD types that describe homes or offers, and those of them that are units by type alone.
JSONLD_TYPES = ("Apartment", "ApartmentComplex", "Offer", "FloorPlan", "Residence", "SingleFamilyResidence")
JSONLD_UNITS = ("Apartment", "FloorPlan", "Residence", "Offer", "SingleFamilyResidence")


def jsonld_offers(pages: DataFrame) -> DataFrame:
    """A row for each JSON-LD home with offers, rooms or a size: plan name, bedrooms, sqft, lowest and highest rent.

    Offers by themselves are read with their home only, summaries of all offers are no unit, and homes that name nothing go.
    Of a list of offers the smallest and largest price count; a price or number of 0 counts as none.
    """
    node = F.col("node")
    text = lambda path, of=node: F.nullif(F.try_variant_get(of, path, "string"), F.lit(""))
    some = lambda path, of=node: F.nullif(text(path, of), F.lit("0"))
    types = F.coalesce(F.try_variant_get(node, "$['@type']", "array<string>"), F.array(text("$['@type']")))
    rooms = F.coalesce(text("$.numberOfRooms.value"), F.when(F.try_variant_get(node, "$.numberOfRooms", "map<string,variant>").isNull(), text("$.numberOfRooms")))
    size = F.coalesce(text("$.floorSize.value"), F.when(F.try_variant_get(node, "$.floorSize", "map<string,variant>").isNull(), text("$.floorSize")))
    listed = F.filter(F.transform(F.col("_offers"), lambda o: v.money_to_int(F.coalesce(some("$.price", o), some("$.lowPrice", o)))), lambda p: p.isNotNull())
    home = F.arrays_overlap("_types", F.array(*map(F.lit, JSONLD_TYPES))) & ~F.array_contains("_types", "AggregateOffer") & (F.col("_types") != F.array(F.lit("Offer")))
    nodes = jsonld_nodes(pages, ("Offer", "AggregateOffer"), ("@type", "name", "numberOfRooms", "floorSize", "offers"))
    read = nodes.select("page_id", "node", F.inline(F.array(F.struct(types.alias("_types"))))).where(home)
    read = read.select("page_id", "_types", F.inline(F.array(F.struct(
        text("$.name").alias("name"), rooms.alias("rooms"), size.alias("size"), F.try_variant_get(node, "$.offers", "array<variant>").alias("_offers"),
        some("$.offers.price").alias("price"), some("$.offers.lowPrice").alias("low"), some("$.offers.highPrice").alias("high"),
    ))))
    priced = F.coalesce("price", "low", "high").isNotNull() | F.coalesce(F.size("_offers") > 0, F.lit(False))
    signal = priced | F.coalesce(F.col("rooms").try_cast("double") > 0, F.lit(False)) | F.nullif("size", F.lit("0")).isNotNull() | F.arrays_overlap("_types", F.array(*map(F.lit, JSONLD_UNITS)))
    named = F.coalesce("name", F.nullif("size", F.lit("0")), F.nullif("rooms", F.lit("0"))).isNotNull()
    read = read.where(signal & (priced | named)).select("page_id", "name", "rooms", "size", "low", "price", "high", "_offers", F.inline(F.array(F.struct(listed.alias("_listed")))))
    low = F.when(F.col("_offers").isNotNull(), F.array_min("_listed")).otherwise(v.money_to_int(F.coalesce("low", "price")))
    high = F.when(F.col("_offers").isNotNull(), F.array_max("_listed")).otherwise(v.money_to_int(F.col("high")))
    read = read.select("page_id", "name", "rooms", "size", low.alias("rent_low"), F.coalesce(high, low).alias("rent_high"))
    dollars = lambda c: F.concat(F.lit("$"), F.format_number(c, 0))
    span = F.when(F.col("rent_low") != F.col("rent_high"), F.concat(dollars("rent_low"), F.lit(" - "), dollars("rent_high"))).otherwise(dollars("rent_low"))
    empty = lambda c: F.coalesce(c, F.lit(""))
    return read.select("page_id", empty("name").alias("floor_plan_name"), empty("rooms").alias("bedrooms"), empty("size").alias("sqft"), "rent_low", "rent_high", empty(span).alias("rent_range"))
