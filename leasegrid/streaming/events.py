"""Structured Streaming over the event ledger: windowed failure rates with a watermark, and failure streaks per key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STREAK = "user_id long, n_events long, streak long, longest long"


def failure_rates(events: DataFrame, window: str = "7 days", slide: str = "1 day", late: str = "1 day") -> DataFrame:
    """(window, n, errors, rate) by sliding windows; rows later than `late` are dropped by the watermark."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    n = e.groupBy(F.window("ts", window, slide)).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return n.select(F.col("window.start").alias("first"), "n", "errors", F.round(F.col("errors") / F.col("n"), 6).alias("rate"))


def failure_streaks(events: DataFrame) -> DataFrame:
    """(user_id, n_events, streak, longest) after each batch: consecutive failures now, and the longest so far."""

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, streak, longest = state.get if state.exists else (0, 0, 0)
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        for bad in (rows["event_type"] == "error").tolist():
            streak = streak + 1 if bad else 0
            longest = max(longest, streak)
        n += len(rows)
        state.update((n, streak, longest))
        yield pd.DataFrame({"user_id": [key[0]], "n_events": [n], "streak": [streak], "longest": [longest]})

    return events.select("user_id", "ts", "event_id", "event_type").groupBy("user_id").applyInPandasWithState(advance, STREAK, "n long, streak long, longest long", "update", GroupStateTimeout.NoTimeout)
