"""Events of a stream, written once each: a batch is a partition of its own, so a batch that runs again replaces what it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery


def write_batch(rows: DataFrame, batch: int, root: str, trouble: Column) -> None:
    """Rows whose `trouble` is null or empty go to <root>/events, all others with it to <root>/dead, both below batch=<number>.

    trouble: a text that says what is wrong with a row. A row that can't be read ends in dead and stops no other.
    """
    told = rows.withColumn("trouble", F.coalesce(trouble, F.lit("")))
    for name, part in (("events", told.where("trouble = ''").drop("trouble")), ("dead", told.where("trouble <> ''"))):
        part.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")


def deliver(stream: DataFrame, root: str, checkpoint: str, trouble: Callable[[DataFrame], Column]) -> StreamingQuery:
    """Starts writing all that is there to events and dead letters below root. Both tables are keyed by the batch's number, which the checkpoint keeps."""

    def each(rows: DataFrame, batch: int) -> None:
        write_batch(rows, batch, root, trouble(rows))

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_trouble(rows: DataFrame) -> Column:
    """What is wrong with an event (event_id, ts, event_type, props): no id, no time, or a payload that is no JSON object."""
    payload = F.try_variant_get(F.try_parse_json("props"), "$", "map<string,variant>")
    return F.when(F.col("event_id").isNull(), "no id").when(F.col("ts").isNull(), "no time").when(F.nullif("event_type", F.lit("")).isNull(), "no kind").when(F.col("props").isNotNull() & payload.isNull(), "payload is no object")
