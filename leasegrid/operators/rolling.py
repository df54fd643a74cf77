"""Failure rates of trailing spans and profile maturity; windows stream over sorted rows and spill, no group is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_failures(df: DataFrame, key: str, seconds: str, bad: str, span: int, threshold: float) -> DataFrame:
    """df with n and errors of each key's last `span` seconds up to and with a row, and forced: was the rate ever above threshold so far?

    A key may hold a third of all rows: rows are counted by (key, second) before the shuffle by key, and the windows run over these
    counts. Rows of one second see each other. Null times and null keys count as keys and times of their own; a null `bad` is no error.
    A frame with a moving start is summed anew at every row; so each count comes again as a loss when it leaves, and running sums do.
    """
    counts = df.groupBy(key, seconds).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(bad)).alias("_e")).withColumn("_own", F.lit(True))
    lost = counts.where(F.col(seconds).isNotNull()).select(key, (F.col(seconds).cast("bigint") + span + 1).alias(seconds), (-F.col("_n")).alias("_n"), (-F.col("_e")).alias("_e"), F.lit(False).alias("_own"))
    sofar = Window.partitionBy(key).orderBy(seconds).rangeBetween(Window.unboundedPreceding, 0)
    # Rows without a time come first, and see each other only.
    near = lambda c: F.when(F.col(seconds).isNull(), F.col(c)).otherwise(F.sum(F.when(F.col(seconds).isNotNull(), F.col(c))).over(sofar))
    rates = counts.unionByName(lost).select(key, seconds, "_own", near("_n").alias("n"), near("_e").alias("errors")).where("_own").drop("_own")
    rates = rates.withColumn("forced", F.max(F.col("errors") > threshold * F.col("n")).over(sofar))
    right = rates.select(F.col(key).alias("_key"), F.col(seconds).alias("_at"), "n", "errors", "forced")
    return df.join(right, F.col(key).eqNullSafe(F.col("_key")) & F.col(seconds).eqNullSafe(F.col("_at"))).drop("_key", "_at")


def maturity_steps(df: DataFrame, key: str, order: list[str], ok: Column, tier: Column) -> DataFrame:
    """df with the state of each key's profile after each row: successes, failures, maturity and preferred_tier.

    Three successes in a row make it HOT, one WARM, three failures in a row COLD; fewer failures keep what it was. It starts COLD.
    """
    by = Window.partitionBy(key).orderBy(*order)
    sofar = by.rowsBetween(Window.unboundedPreceding, 0)
    # The place of the last row of the other kind; a streak is the distance to it.
    at = df.withColumn("_ok", F.coalesce(ok, F.lit(False))).withColumn("_k", F.row_number().over(by).cast("long"))
    ends = at.withColumn("_bad", F.max(F.when(~F.col("_ok"), F.col("_k"))).over(sofar)).withColumn("_good", F.max(F.when(F.col("_ok"), F.col("_k"))).over(sofar))
    since = lambda c: F.col("_k") - F.coalesce(c, F.lit(0))
    s = ends.withColumn("successes", F.when(F.col("_ok"), since(F.col("_bad"))).otherwise(0)).withColumn("failures", F.when(~F.col("_ok"), since(F.col("_good"))).otherwise(0))
    made = F.when(F.col("successes") >= 3, "HOT").when(F.col("successes") >= 1, "WARM").when(F.col("failures") >= 3, "COLD")
    s = s.withColumn("maturity", F.coalesce(F.last(made, ignorenulls=True).over(sofar), F.lit("COLD")))
    return s.withColumn("preferred_tier", F.min(F.when(F.col("_ok"), tier)).over(sofar)).drop("_ok", "_k", "_bad", "_good")


def last_attempts(df: DataFrame, key: str, seconds: str, order: str, bad: str, span: int, most: int, threshold: float, grain: int = 3600) -> DataFrame:
    """df with n and errors of each key's last `most` rows that are also of its last `span` seconds, each row with those before it, and
    forced: was the rate above threshold at this row or any before it?

    Rows are in order of (seconds, order), which has to be unique in a key. No key is a task: rows are numbered in pieces of `grain`
    seconds, pieces get the sums before them, and both ends of a row's window are then rows of running counts, met by number. Rows
    without key or time get nulls.
    """
    told = df.where(F.col(key).isNotNull() & F.col(seconds).isNotNull())
    piece = lambda at: F.floor(at / grain)
    at, first = F.col(seconds), F.col(seconds) - span
    own = told.select(key, piece(at).alias("_piece"), at.alias("_at"), F.lit(1).alias("_row"), F.col(order).alias("_order"), F.coalesce(F.col(bad).cast("int"), F.lit(0)).alias("_bad"))
    # A probe stands before the rows of the second its row's window begins with.
    probe = told.select(key, piece(first).alias("_piece"), first.alias("_at"), F.lit(0).alias("_row"), F.col(order).alias("_order"), F.lit(0).alias("_bad"))
    every = own.unionByName(probe)
    before = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = every.groupBy(key, "_piece").agg(F.sum("_row").alias("_n"), F.sum("_bad").alias("_e"))
    pieces = pieces.select(key, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_e").over(before), F.lit(0)).alias("_e0"))
    inside = Window.partitionBy(key, "_piece").orderBy("_at", "_row", "_order").rowsBetween(Window.unboundedPreceding, 0)
    counted = every.select("*", F.sum("_row").over(inside).alias("_k"), F.sum("_bad").over(inside).alias("_f")).join(pieces, [key, "_piece"])
    counted = counted.select(key, "_piece", "_row", "_order", (F.col("_k") + F.col("_n0")).alias("_k"), (F.col("_f") + F.col("_e0")).alias("_f"))
    ends = counted.where("_row = 1").select(key, "_piece", "_order", F.col("_k").alias("_to"), F.col("_f").alias("_to_e"))
    starts = counted.where("_row = 0").select(F.col(key).alias("_key"), F.col("_order").alias("_own"), F.col("_k").alias("_from"))
    spans = ends.join(starts, (F.col(key) == F.col("_key")) & (F.col("_order") == F.col("_own"))).withColumn("_from", F.greatest("_from", F.col("_to") - most))
    left = ends.select(F.col(key).alias("_left"), F.col("_to").alias("_at"), F.col("_to_e").alias("_before"))
    rates = spans.join(left, (F.col(key) == F.col("_left")) & (F.col("_from") == F.col("_at")), "left")
    rates = rates.select(key, "_piece", "_order", "_to", (F.col("_to") - F.col("_from")).alias("n"), (F.col("_to_e") - F.coalesce("_before", F.lit(0))).alias("errors"))
    # The first row over the threshold, brought to rows by their pieces.
    since = rates.where(F.col("errors") > threshold * F.col("n")).groupBy(key).agg(F.min("_to").alias("_since"))
    since = pieces.select(key, "_piece").join(since, key)
    rates = rates.join(since, [key, "_piece"], "left").select(F.col(key).alias("_key"), "_order", "n", "errors", F.coalesce(F.col("_to") >= F.col("_since"), F.lit(False)).alias("forced"))
    return df.join(rates, (df[key] == F.col("_key")) & (df[order] == F.col("_order")), "left").drop("_key", "_order")
