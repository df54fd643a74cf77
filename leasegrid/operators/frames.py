"""Table-agnostic operators: latest row, first-wins dedup, merge, diff, carry-forward, streaks, paging, duplicates, issues.

Each takes and returns DataFrames and states its keys and a total order as parameters; none collects.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leasegrid.functions import decisions


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The row of each key that comes last; null keys are dropped. `order` ascends and should be total."""
    w = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
    return df.dropna(subset=keys).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_by_struct(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """latest() by aggregation: partial results before the shuffle, so a hot key costs one row a task."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.dropna(subset=keys).groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in [*order, *rest]]).select(*df.columns)


def first_wins(df: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The first row of each key in arrival order; null and empty keys are dropped."""
    keyed = df.withColumn("_key", key).where("_key is not null and _key <> ''")
    return keyed.withColumn("_rn", F.row_number().over(Window.partitionBy("_key").orderBy(*order))).where("_rn = 1").drop("_rn", "_key")


def override_merge(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace old ones of the same key; keys only in one side stay."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """keys, change (new, updated, unchanged, disappeared), changed (tracked columns that differ), and both values of each."""
    a = before.select(*keys, F.lit(True).alias("_a"), *[F.col(c).alias(f"old_{c}") for c in tracked])
    b = after.select(*keys, F.lit(True).alias("_b"), *[F.col(c).alias(f"new_{c}") for c in tracked])
    changed = F.filter(F.array(*[F.when(~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")), c) for c in tracked]), lambda x: x.isNotNull())
    both = a.join(b, keys, "full")
    change = F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "disappeared").when(F.size(changed) > 0, "updated").otherwise("unchanged")
    return both.select(*keys, change.alias("change"), F.when(change == "updated", F.array_join(changed, ",")).otherwise("").alias("changed"), *[f"{s}_{c}" for c in tracked for s in ("old", "new")])


def carry_forward(state: DataFrame, seen: DataFrame, keys: list[str], counter: str = "carried") -> DataFrame:
    """Rows of state not seen this time are carried with their counter up by one; seen rows start at 0."""
    kept = state.join(seen.select(*keys), keys, "left_anti").withColumn(counter, F.col(counter) + 1)
    return seen.withColumn(counter, F.lit(0).cast(state.schema[counter].dataType)).unionByName(kept, allowMissingColumns=True)


def streaks(df: DataFrame, keys: list[str], bad: Column, *order: Column) -> DataFrame:
    """Adds `streak`: how many bad rows in a row end here, 0 on a good row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = df.withColumn("_bad", F.coalesce(bad, F.lit(False))).withColumn("_island", F.sum(F.when(F.col("_bad"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*keys, "_island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("streak", F.sum(F.when(F.col("_bad"), 1).otherwise(0)).over(run).cast("bigint")).drop("_bad", "_island")


def round_robin(df: DataFrame, group: str, within: list[Column], seed: int = 0) -> DataFrame:
    """Adds `turn` (the row's place in its group) and a seeded group order; read by (turn, group_order)."""
    return df.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*within))).withColumn("group_order", F.xxhash64(F.col(group), F.lit(seed)))


def sort_nulls_last(df: DataFrame, by: str, descending: bool, tie: str) -> DataFrame:
    c = F.col(by)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last(), F.col(tie))


def page(df: DataFrame, by: str, descending: bool, tie: str, number: int = 1, size: int = 25) -> DataFrame:
    """One page of a sorted table; the size is 100 at most."""
    if number < 1:
        raise ValueError("pages start at 1")
    size = max(1, min(100, size))
    return sort_nulls_last(df, by, descending, tie).offset((number - 1) * size).limit(size)


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie)).limit(k)


def property_filter(df: DataFrame, search: str | None = None, cities=(), tiers=(), statuses=(), least_rent=None, most_rent=None, has_concession: bool | None = None, search_in=("name", "city")) -> DataFrame:
    """All given predicates together; an empty list or None is no filter. Plain predicates, so they reach the scan."""
    tests: list[Column] = []
    if search:
        tests.append(_any([F.coalesce(F.lower(F.col(c)).contains(search.lower()), F.lit(False)) for c in search_in]))
    for name, wanted in (("city", cities), ("tier", tiers), ("status", statuses)):
        if wanted:
            tests.append(F.col(name).isin(*wanted))
    if least_rent is not None:
        tests.append(F.col("avg_rent") >= least_rent)
    if most_rent is not None:
        tests.append(F.col("avg_rent") <= most_rent)
    if has_concession is not None:
        tests.append(F.coalesce(F.col("concession") != "", F.lit(False)) == F.lit(has_concession))
    for t in tests:
        df = df.where(t)
    return df


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def duplicates(df: DataFrame, ident: str, prints: list[str]) -> DataFrame:
    """(kind, value, n_ids, n_rows): ids on several rows (hard), and fingerprints shared by several ids (soft)."""
    hard = df.where(F.col(ident).isNotNull()).groupBy(F.col(ident).cast("string").alias("value")).agg(F.lit(1).cast("bigint").alias("n_ids"), F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1").select(F.lit("hard").alias("kind"), "value", "n_ids", "n_rows")
    for c in prints:
        soft = df.where(F.coalesce(F.col(c), F.lit("")) != "").groupBy(F.col(c).alias("value")).agg(F.countDistinct(ident).alias("n_ids"), F.count(F.lit(1)).alias("n_rows")).where("n_ids > 1")
        hard = hard.union(soft.select(F.lit(c).alias("kind"), "value", "n_ids", "n_rows"))
    return hard


def issues(df: DataFrame, keys: list[str], rules: list[tuple[str, str, Column]]) -> DataFrame:
    """One row a finding: keys, severity, code. A rule whose test is null finds nothing."""
    found = F.filter(F.array(*[F.when(test, F.struct(F.lit(sev).alias("severity"), F.lit(code).alias("code"))) for sev, code, test in rules]), lambda x: x.isNotNull())
    return df.select(*keys, F.explode(found).alias("_f")).select(*keys, "_f.severity", "_f.code")


def property_issues_v2(df: DataFrame, key: str, required: tuple[str, ...]) -> DataFrame:
    """(key, severity, code, field): required fields that are null or blank, apartment ids under 1, ZIP codes of other than five digits."""
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    finding = lambda severity, code, field, test: F.when(test, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.lit(field).alias("field")))
    found = [finding("ERROR", "V2_MISSING_REQUIRED", c, blank(c)) for c in required]
    found += [finding("ERROR", "V2_INVALID_APARTMENT_ID", "apartment_id", F.col("apartment_id") < 1), finding("WARNING", "V2_INVALID_ZIP", "zip_code", ~F.col("zip_code").rlike(r"^\d{5}$"))]
    return df.select(key, F.explode(F.array_compact(F.array(*found))).alias("_f")).select(key, "_f.*")


def tier_cascade(tiers: list[DataFrame], key: str) -> DataFrame:
    """Rows of the first tier that has any for a key."""
    out = None
    for k, df in enumerate(tiers):
        df = df.withColumn("tier", F.lit(k + 1))
        out = df if out is None else out.unionByName(df.join(out.select(key).distinct(), key, "left_anti"))
    return out


def with_text_facts(df: DataFrame, text: str, year: int) -> DataFrame:
    """Adds the facts that patterns find in a unit's text. Every pattern runs once: its match is a column before facts use it."""
    found = df.withColumns(decisions.text_matches(F.col(text)))
    return found.withColumns(decisions.text_facts(year)).drop(*decisions.text_matches(F.col(text)))


def with_provider(df: DataFrame, url: str, page: str, company: str, hint: str) -> DataFrame:
    """Adds struct `provider` (pms, confidence). The page is lowered and each signal read once."""
    votes = decisions.provider_votes(F.col(url), F.col("_low"), F.col(company))
    return df.withColumn("_low", F.lower(page)).withColumns(votes).withColumn("provider", decisions.provider(F.col(hint))).drop("_low", *votes)


#: Longest lists a profile keeps (fixed values).
MOST_BLOCKED, MOST_MAPPINGS, MOST_EXPLORED = 50, 20, 50


def migrate_profiles(df: DataFrame) -> DataFrame:
    """Profiles of version 1 as version 2: defaults set, lists cut, dropped fields gone, unknown providers read from the entry URL.

    Takes api_hints (api_provider, blocked_endpoints, llm_field_mappings), dom_hints (platform_detected and others), navigation
    (entry_url, explored_links), cluster_id and any other columns.
    """
    nothing = F.lit(None).cast("string")
    seen = with_provider(df.withColumns({"_url": F.col("navigation.entry_url"), "_none": nothing}), "_url", "_none", "_none", "_none")
    given = F.nullif(F.col("api_hints.api_provider"), F.lit(""))
    sure = (F.coalesce(given, F.lit("unknown")) == "unknown") & (F.col("provider.pms") != "unknown") & (F.col("provider.confidence") >= 0.5)
    first = lambda c, n: F.slice(c, 1, n)
    hints = F.col("api_hints").withField("api_provider", F.when(sure, F.col("provider.pms")).otherwise(F.coalesce(given, F.lit("unknown"))))
    hints = hints.withField("blocked_endpoints", first("api_hints.blocked_endpoints", MOST_BLOCKED)).withField("llm_field_mappings", first("api_hints.llm_field_mappings", MOST_MAPPINGS))
    made = {
        "api_hints": hints,
        "dom_hints": F.col("dom_hints").dropFields("platform_detected"),
        "navigation": F.col("navigation").withField("explored_links", first("navigation.explored_links", MOST_EXPLORED)),
        "last_success_detection": F.when(sure, F.col("provider")),
        "version": F.lit(2),
    }
    return seen.withColumns(made).drop("cluster_id", "provider", "_url", "_none")


def durable(df: DataFrame) -> DataFrame:
    """df as it is now, written to the checkpoint folder (spark.checkpoint.dir) that the cluster shares; local sessions get one of their own."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="leasegrid-"))
    return df.checkpoint()


def placed(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """df with each row's place in the order, from 1: rows are counted inside the parts of one sort, and parts get what lies before them."""
    # Another run of the sort could draw other parts.
    parts = durable(df.orderBy(*order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")))
    # A row for each part of the sort.
    own = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    moves = own.select("_part", (before - F.col("_first") + 1).alias("_move"))
    return parts.join(F.broadcast(moves), "_part").select(*df.columns, (F.col("_at") + F.col("_move")).alias(name))
