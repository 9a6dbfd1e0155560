"""Reuse of daily tables: a manifest for each day, keyed by all that the day was made from."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping
from datetime import date, timedelta
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.config import Settings
from pairloom.operators.cleaning import clean_events
from pairloom.operators.pairs import DailyPairStats, item_pairs, stats_of_pairs
from pairloom.operators.sessions import HEAVY_EVENTS, build_sessions_of_all
from pairloom.output.writers import write_daily, write_manifest
from pairloom.sources.files import delete, exists, joined, listed, read_text, session, staged

SCHEMA_VERSION = 1
TABLES = ("counts", "widget_counts", "user_keys", "session_keys")


def fingerprint(values: Mapping[str, Any]) -> str:
    """SHA-256 of canonical JSON."""
    return hashlib.sha256(json.dumps(values, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def input_identity(paths: Iterable[str]) -> list[dict[str, Any]]:
    """Names, sizes and times of Parquet files, in any store, so that a late or replaced file is noticed."""
    return [f for p in paths for f in listed(p) if f["path"].endswith(".parquet")]


def _manifest(folder: str, kind: str, day: str) -> str:
    return joined(folder, "_manifests", kind, f"{day}.json")


def record(folder: str, kind: str, day: str, key: Mapping[str, Any], files: Iterable[str]) -> None:
    write_manifest(_manifest(folder, kind, day), {"schema_version": SCHEMA_VERSION, "artifact_type": kind, "date": day, "fingerprint": fingerprint(key), "files": [str(f) for f in files]})


def is_valid(folder: str, kind: str, day: str, key: Mapping[str, Any]) -> bool:
    """Whether the day's table was made from this very key and is still there."""
    path = _manifest(folder, kind, day)
    if not exists(path):
        return False
    try:
        m = json.loads(read_text(path))
    except ValueError:
        return False
    return m.get("schema_version") == SCHEMA_VERSION and m.get("artifact_type") == kind and m.get("date") == day and m.get("fingerprint") == fingerprint(key) and all(exists(f) for f in m.get("files", ()))


def stale_days(folder: str, kind: str, keys: Mapping[str, Mapping[str, Any]]) -> list[str]:
    """Days from the first that isn't valid on: sessions carry over midnight, so later days depend on it."""
    days = sorted(keys)
    first = next((k for k, d in enumerate(days) if not is_valid(folder, kind, d, keys[d])), len(days))
    return days[first:]


def state_date_matches(processed_through: str, window_end: str) -> None:
    """A state that has seen later days would leak them into training."""
    if processed_through != window_end:
        raise ValueError(f"the session state ends at {processed_through}, not at {window_end}")


def cache_key(metadata: Mapping[str, Any]) -> str:
    """Short key of a validation cache entry."""
    return fingerprint(metadata)[:24]


def cached(folder: str, metadata: Mapping[str, Any], made: Callable[[], DataFrame]) -> DataFrame:
    """A table from the validation cache: what ``made`` gives is written once for each metadata, then read.

    An entry counts only with its manifest, which is written last and says what it was made from.
    """
    entry = joined(folder, cache_key(metadata))
    table, manifest = joined(entry, "table.parquet"), joined(entry, "manifest.json")
    there = exists(manifest) and json.loads(read_text(manifest)).get("metadata") == json.loads(json.dumps(metadata, default=str))
    if not there:
        made().write.mode("overwrite").parquet(table)
        write_manifest(manifest, {"schema_version": SCHEMA_VERSION, "metadata": metadata})
    return session().read.parquet(table)


def day_inputs(raw: DataFrame) -> dict[str, list[dict[str, Any]]]:
    """Files of each day's partition, from the table's list of files."""
    of: dict[str, set[str]] = {}
    for f in raw.inputFiles():
        folder, name, _ = f.partition("/date=")
        day = f[len(folder) + len("/date=") :].partition("/")[0]
        if not name:
            raise ValueError("incremental runs need events in partitions by date")
        of.setdefault(day, set()).add(f"{folder}/date={day}")
    return {day: input_identity(sorted(folders)) for day, folders in of.items()}


def _days(start: str, end: str) -> list[str]:
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    return [str(first + timedelta(days=k)) for k in range((last - first).days + 1)]


def daily_tables(raw: DataFrame, settings: Settings, start: str, end: str, folder: str) -> DailyPairStats:
    """The compact daily tables of a window, of which only days are built anew that were made from something else.

    A day has the sessions that start on it. They depend on its own events, on those of the day before, which say where
    one starts, and on those of the day after, to which they may go on; the first day of a window has none before. So a
    day's key has the files of all three. Where a session goes on beyond a whole day, days are built from an earlier one
    on. Sessions are told apart by their first moment, which stays the same whatever else is built. The result equals
    that of a full run, whose events are those of the window alone. Dates of partitions must be those of timestamps.
    """
    if settings.timeout_minutes > 24 * 60:
        raise ValueError("incremental runs need a session timeout of a day at most")
    days, inputs = _days(start, end), day_inputs(raw)
    made_from = {"actions": settings.actions, "timeout": settings.timeout_minutes, "pairs": repr(settings.pairs)}
    around = lambda k: [inputs.get(days[i], []) if 0 <= i < len(days) else None for i in (k - 1, k, k + 1)]
    keys = {d: made_from | {"inputs": around(k)} for k, d in enumerate(days)}
    stale = [k for k, d in enumerate(days) if not is_valid(folder, "pairs", d, keys[d])]
    if stale:
        first = min(stale)
        while True:
            events = clean_events(raw.filter(F.col("date").cast("string").between(days[max(0, first - 1)], end)), settings.actions)
            events = events.filter(F.col("event_date").between(F.lit(days[max(0, first - 1)]).cast("date"), F.lit(end).cast("date")))
            sessions = build_sessions_of_all(events, settings.timeout_minutes)
            by = Window.partitionBy("user_id", "session_index")
            sessions = staged(sessions.withColumn("session_index", F.unix_micros(F.min("timestamp").over(by).cast("timestamp"))))
            over = (F.col("session_start_date") < F.lit(days[first]).cast("date")) & (F.col("event_date") > F.lit(days[first]).cast("date"))
            if not first or sessions.filter(over).isEmpty():
                break
            first -= 1
        begun = sessions.filter(F.col("session_start_date") >= F.lit(days[first]).cast("date"))
        stats = stats_of_pairs(staged(item_pairs(begun, settings.pairs, heavy_events=HEAVY_EVENTS)))
        for name in TABLES:
            table = joined(folder, name)
            for d in days[first:]:
                delete(joined(table, f"pair_date={d}"))
            write_daily(getattr(stats, name), table)
        for d in days[first:]:
            parts = [p for p in (joined(folder, name, f"pair_date={d}") for name in TABLES) if exists(p)]
            record(folder, "pairs", d, keys[d], parts)
    read = {name: session().read.parquet(joined(folder, name)) for name in TABLES}
    inside = F.col("pair_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return DailyPairStats(**{name: df.filter(inside) for name, df in read.items()})
