"""Texts for people: currency, cost, numbers, percent, dates, durations, sizes, cut texts and file names; as Column expressions.

Halves are rounded away from zero, on a number's shortest decimal form. Nulls are an em dash where the rule has one, else null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NONE = "—"


def _told(value: Column, text: Column) -> Column:
    return F.when(value.isNull(), NONE).otherwise(text)


def _fixed(value: Column, places: int) -> Column:
    """With so many decimals and no thousands marks."""
    return F.regexp_replace(F.format_number(F.round(value, places), places), ",", "")


def currency(value: Column, places: int = 0) -> Column:
    return _told(value, F.concat(F.when(value < 0, "-$").otherwise("$"), F.format_number(F.abs(F.round(value, places)), places)))


def cost(value: Column) -> Column:
    """More decimals the smaller it is: four below a cent, three below a dollar."""
    small = F.when(value == 0, "$0.00").when(value < 0.01, F.concat(F.lit("$"), _fixed(value, 4))).when(value < 1, F.concat(F.lit("$"), _fixed(value, 3)))
    return _told(value, F.coalesce(small, currency(value, 2)))


def number(value: Column) -> Column:
    """With thousands marks and at most three decimals."""
    return _told(value, F.regexp_replace(F.regexp_replace(F.format_number(F.round(value, 3), 3), r"(\.\d*?)0+$", "$1"), r"\.$", ""))


def percent(share: Column, places: int = 1) -> Column:
    return _told(share, F.concat(_fixed(share * 100, places), F.lit("%")))


def date(at: Column, style: str = "short", now: Column | None = None) -> Column:
    """at: a timestamp. style: short (Jan 5, 2026), long (January 5, 2026) or relative to now, in whole days of 24 hours."""
    if style == "relative":
        days = F.floor((F.unix_seconds(F.current_timestamp() if now is None else now) - F.unix_seconds(at)) / 86_400)
        text = F.when(days == 0, "Today").when(days == 1, "Yesterday").when(days < 7, F.concat(days, F.lit("d ago"))).otherwise(F.concat(F.floor(days / 7), F.lit("w ago")))
    else:
        text = F.date_format(at, {"short": "MMM d, yyyy", "long": "MMMM d, yyyy"}[style])
    return _told(at, text)


def duration(seconds: Column) -> Column:
    """12s, 3m 5s or 2h 7m."""
    minutes, whole = F.floor(seconds / 60), lambda c: F.round(c).cast("bigint")
    short = F.when(seconds < 60, F.concat(whole(seconds), F.lit("s"))).when(minutes < 60, F.concat(minutes, F.lit("m "), whole(seconds % 60), F.lit("s")))
    return _told(seconds, F.coalesce(short, F.concat(F.floor(minutes / 60), F.lit("h "), minutes % 60, F.lit("m"))))


def size(n_bytes: Column) -> Column:
    return F.when(n_bytes < 1 << 10, F.concat(n_bytes, F.lit("B"))).when(n_bytes < 1 << 20, F.concat(_fixed(n_bytes / (1 << 10), 1), F.lit("KB"))).otherwise(F.concat(_fixed(n_bytes / (1 << 20), 1), F.lit("MB")))


def shortened(text: Column, most: int) -> Column:
    """At most so many characters, the last three of a cut text dots."""
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.substring(text, 1, most - 3), F.lit("...")))


def file_name(text: Column, most: int = 80) -> Column:
    """Letters and digits of any script, - and _ stay; every other character is a _."""
    return F.substring(F.regexp_replace(text, r"[^\p{L}\p{N}_-]", "_"), 1, most)
