"""Change detection as state: what a property's probes said at its last full scrape, and when that was.

A probe is a row (property_id, ts, status, etag, last_modified, sitemap_lastmod, api_hash); each of its three mechanisms says UNCHANGED,
CHANGED or INCONCLUSIVE. A property is skipped if some mechanism is conclusive, all conclusive ones say UNCHANGED, and its last full
scrape is less than seven days old; else it is scraped, and what the probe said becomes what is known. A timer gives a row for each
property whose last full scrape gets seven days old without a probe.
"""

from __future__ import annotations

import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Days after which a property is scraped whatever its probes say.
FORCED_DAYS = 7
DAY_MS = 86_400_000
PROBE = ("property_id", "ts", "status", "etag", "last_modified", "sitemap_lastmod", "api_hash")
KNOWN = "etag string, last_modified string, sitemap_lastmod string, api_hash string, scraped long, carried long"
DECISION = "property_id long, ts timestamp, etag_result string, sitemap_result string, api_result string, skip boolean, forced boolean, carried long, overall string"


def _told(probe: dict, known: dict | None) -> tuple[str, str, str]:
    """What the three mechanisms say of a probe; empty texts are none."""
    old = known or dict.fromkeys(("etag", "last_modified", "sitemap_lastmod", "api_hash"))
    if probe["status"] == 304:
        head = "UNCHANGED"
    elif not probe["etag"] and not probe["last_modified"]:
        head = "INCONCLUSIVE"
    else:
        head = "UNCHANGED" if any(probe[c] and probe[c] == old[c] for c in ("etag", "last_modified")) else "CHANGED"
    rest = ("INCONCLUSIVE" if not probe[c] else "UNCHANGED" if probe[c] == old[c] else "CHANGED" for c in ("sitemap_lastmod", "api_hash"))
    return (head, *rest)


def step(probe: dict, known: dict | None) -> tuple[tuple, dict]:
    """(decision, what is known after it). Days are UTC days."""
    results = _told(probe, known)
    day = int(probe["ts"].timestamp() // 86_400)
    forced = known is None or day - known["scraped"] >= FORCED_DAYS
    conclusive = [r for r in results if r != "INCONCLUSIVE"]
    skip = bool(conclusive) and all(r == "UNCHANGED" for r in conclusive) and not forced
    if skip:
        known = known | {"carried": known["carried"] + 1}
    else:
        old = known or {}
        known = {c: probe[c] or old.get(c) for c in ("etag", "last_modified", "sitemap_lastmod", "api_hash")} | {"scraped": day, "carried": 0}
    overall = "UNCHANGED" if skip else "CHANGED" if "CHANGED" in results else "INCONCLUSIVE"
    return (probe["property_id"], probe["ts"], *results, skip, forced, known["carried"], overall), known


class _Probes(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", KNOWN)

    def handleInputRows(self, key, rows, timerValues):
        at = self.known.get()
        names = [x.split()[0] for x in KNOWN.split(", ")]
        known = dict(zip(names, at, strict=True)) if at is not None else None
        before = known["scraped"] if known else None
        # A batch holds the probes of one property since the last one; a key's rows come in pieces.
        frame = pd.concat(list(rows)).sort_values("ts", kind="stable")
        out = []
        for probe in frame.astype(object).where(frame.notna(), None).to_dict("records"):
            probe["property_id"], probe["ts"] = key[0], probe["ts"].to_pydatetime().replace(tzinfo=datetime.UTC)
            decision, known = step(probe, known)
            out.append(decision)
        self.known.update(tuple(known[n] for n in names))
        if known["scraped"] != before:
            if before is not None:
                self.handle.deleteTimer((before + FORCED_DAYS) * DAY_MS)
            self.handle.registerTimer((known["scraped"] + FORCED_DAYS) * DAY_MS)
        yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        at = datetime.datetime.fromtimestamp(expiredTimerInfo.getExpiryTimeInMs() / 1000, datetime.UTC)
        carried = self.known.get()[5] if self.known.exists() else 0
        yield _frame([(key[0], at, None, None, None, False, True, carried, "DUE")])

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[x.split()[0] for x in DECISION.split(", ")])
    frame["ts"] = pd.to_datetime(frame["ts"], utc=True).dt.tz_localize(None)
    return frame


def decisions(probes: DataFrame, late: str = "1 hour") -> DataFrame:
    """A row for each probe of a stream of PROBE columns, and one `DUE` row where a property is overdue. Probes later than `late` go.

    Needs the RocksDB state store (spark.sql.streaming.stateStore.providerClass).
    """
    rows = probes.select(*PROBE).withWatermark("ts", late)
    return rows.groupBy("property_id").transformWithStateInPandas(statefulProcessor=_Probes(), outputStructType=DECISION, outputMode="append", timeMode="eventTime")


def decided(probes: DataFrame) -> DataFrame:
    """The same for all probes of a table: each property's probes in order of time, a property a group."""

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        known, out = None, []
        for probe in frame.sort_values("ts", kind="stable").astype(object).where(frame.notna(), None).to_dict("records"):
            probe["ts"] = probe["ts"].to_pydatetime().replace(tzinfo=datetime.UTC)
            decision, known = step(probe, known)
            out.append(decision)
        return _frame(out)

    return probes.select(*PROBE).groupBy("property_id").applyInPandas(fold, DECISION)
