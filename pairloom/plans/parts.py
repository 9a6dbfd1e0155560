"""Daily pair tables that grow by parts: late files, batches of users, micro-batches of a stream.

A part is what one set of sessions adds to the four tables, a folder of its own in each. A ledger, one file that is
replaced as a whole, says which parts count. So a part that comes twice counts once, one that was broken off counts not at
all and is written anew, and readers see all of a part or nothing. Counts of parts add up and keys are made distinct again,
in any order of parts; that a session is whole in one part is all that is asked. Compaction makes one part of all, as soon
as reading many small files costs more than writing one large; its sources stay until the next one, for readers that have
begun.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.pairs import PAIR, DailyPairStats, PairSettings, item_pairs, stats_of_pairs
from pairloom.output.writers import write_daily, write_manifest
from pairloom.schemas import RAW_COUNTS, WEIGHTED_COUNTS
from pairloom.sources.files import delete, exists, joined, read_text, session, staged, staging

TABLES = ("counts", "widget_counts", "user_keys", "session_keys")
KEYS = {"counts": ("pair_date", *PAIR), "widget_counts": ("pair_date", *PAIR, "target_widget_name"), "user_keys": ("pair_date", *PAIR, "user_id"), "session_keys": ("pair_date", *PAIR, "user_id", "session_index")}


def merged(name: str, parts: DataFrame) -> DataFrame:
    """A table from the rows of its parts."""
    if name.endswith("keys"):
        return parts.select(*KEYS[name]).distinct()
    return parts.groupBy(*KEYS[name]).agg(*(F.sum(c).alias(c) for c in (*RAW_COUNTS, *WEIGHTED_COUNTS)))


class DailyParts:
    """The tables below a folder; one writer at a time, any number of readers."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def ledger(self) -> dict[str, Any]:
        """``live``: the folders that count, by part; ``within``: parts that a compacted one holds; ``retired``: folders to delete."""
        path = joined(self.folder, "ledger.json")
        return json.loads(read_text(path)) if exists(path) else {"live": {}, "within": [], "retired": []}

    def _write(self, stats: DailyPairStats) -> str:
        name = f"part-{uuid.uuid4().hex}"
        for table in TABLES:
            write_daily(getattr(stats, table), joined(self.folder, table, name))
        return name

    def add(self, part: str, sessions: DataFrame, settings: PairSettings = PairSettings()) -> bool:
        """Add the pairs of whole sessions under a name; whether it was new. Pairs are made once for all tables."""
        ledger = self.ledger()
        if part in ledger["live"] or part in ledger["within"]:
            return False
        with staging():
            written = self._write(stats_of_pairs(staged(item_pairs(sessions, settings))))
        ledger["live"][part] = written
        write_manifest(joined(self.folder, "ledger.json"), ledger)
        return True

    def read(self, more: DailyPairStats | None = None) -> DailyPairStats:
        """The tables of all parts, and of ``more`` that isn't kept, such as the sessions that are still open."""
        live = list(self.ledger()["live"].values())

        def table(name: str) -> DataFrame | None:
            read = [self._part(name, p) for p in live]
            there = [df for df in (*read, getattr(more, name) if more else None) if df is not None]
            if not there:
                return None
            rows = there[0]
            for df in there[1:]:
                rows = rows.unionByName(df)
            return merged(name, rows)

        found = {name: table(name) for name in TABLES}
        if any(df is None for df in found.values()):
            raise FileNotFoundError(f"no part in {self.folder}")
        return DailyPairStats(**found)

    def _part(self, table: str, name: str) -> DataFrame | None:
        path = joined(self.folder, table, name)
        kinds = {"pair_date": "date", "target_widget_name": "string", **dict.fromkeys(WEIGHTED_COUNTS, "double")}
        columns = [*KEYS[table][1:], *(() if table.endswith("keys") else (*RAW_COUNTS, *WEIGHTED_COUNTS)), "pair_date"]
        return session().read.schema(", ".join(f"{c} {kinds.get(c, 'long')}" for c in columns)).parquet(path) if exists(path) else None

    def compact(self) -> None:
        """All parts as one."""
        ledger = self.ledger()
        if len(ledger["live"]) > 1:
            written = self._write(self.read())
            for name in ledger["retired"]:
                for table in TABLES:
                    delete(joined(self.folder, table, name))
            within = sorted({*ledger["within"], *ledger["live"]} - {"compacted"})
            write_manifest(joined(self.folder, "ledger.json"), {"live": {"compacted": written}, "within": within, "retired": list(ledger["live"].values())})


def parts_sink(folder: str, settings: PairSettings = PairSettings(), name: str = "batch", compact_every: int = 100) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch`` of a stream of finished sessions: each batch is a part named by its number, so a replayed one changes nothing.

    A batch is computed once and in any case, as the stream's state is only kept if all of it has been read.
    """
    parts = DailyParts(folder)

    def add(batch: DataFrame, number: int) -> None:
        with staging():
            if parts.add(f"{name}-{number:09d}", staged(batch), settings) and number % compact_every == compact_every - 1:
                parts.compact()

    return add
