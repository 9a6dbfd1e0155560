"""A catalogue of what runs have made, found again by window and settings.

An entry is a manifest: kind, window, a fingerprint of the settings that shape the table, the files that it was made from
and where it lies. Scores, lists and outputs of other parameters then need no events. A table counts only while it is
there; of several for the same window and settings the last one recorded is taken.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame

from pairloom.config import Settings
from pairloom.output.writers import write_manifest
from pairloom.plans.incremental import SCHEMA_VERSION, fingerprint
from pairloom.sources.files import exists, joined, listed, read_text, session

KINDS = ("pair_aggregates", "item_popularity", "action_type_distribution")


def shaping(settings: Settings, kind: str) -> dict[str, Any]:
    """The settings that a kind of table depends on; those of scoring, lists and fallback are none of them."""
    about: dict[str, Any] = {"actions": list(settings.actions)}
    if kind == "pair_aggregates":
        about |= {"timeout": settings.timeout_minutes, "pairs": repr(settings.pairs), "time_decay": repr(settings.time_decay)}
    return about


@dataclass(frozen=True)
class Entry:
    kind: str
    start: str
    end: str
    path: str
    rows: int
    inputs: str
    recorded: float


class Catalogue:
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def _entries(self, kind: str, start: str, end: str) -> str:
        return joined(self.folder, kind, f"window_start={start}_window_end={end}")

    def record(self, kind: str, window: tuple[str, str], settings: Settings, path: str, rows: int, inputs: Any = None) -> None:
        """Note a table that has been written; ``inputs`` says what it was made from."""
        about = shaping(settings, kind)
        values = {"schema_version": SCHEMA_VERSION, "kind": kind, "window_start": window[0], "window_end": window[1], "settings": fingerprint(about), "shaped_by": about, "inputs": fingerprint({"files": inputs}), "path": path, "rows": rows, "recorded": time.time()}
        write_manifest(joined(self._entries(kind, *window), f"{fingerprint({'path': path, 'settings': about})[:24]}.json"), values)

    def find(self, kind: str, window: tuple[str, str], settings: Settings, inputs: Any = None) -> Entry | None:
        """The last table of a window and settings, and of these very inputs if some are given."""
        wanted, found = fingerprint(shaping(settings, kind)), []
        for file in listed(self._entries(kind, *window)):
            if not file["path"].endswith(".json"):
                continue
            m = json.loads(read_text(file["path"]))
            if m.get("schema_version") == SCHEMA_VERSION and m["settings"] == wanted and (inputs is None or m["inputs"] == fingerprint({"files": inputs})) and exists(m["path"]):
                found.append(Entry(kind, *window, m["path"], m["rows"], m["inputs"], m["recorded"]))
        return max(found, key=lambda e: (e.recorded, e.path), default=None)

    def tables(self, window: tuple[str, str], settings: Settings, inputs: Any = None) -> dict[str, DataFrame] | None:
        """All that scoring needs, made from the same inputs; None if a part isn't there."""
        first = self.find("pair_aggregates", window, settings, inputs)
        found = {kind: self.find(kind, window, settings, inputs) for kind in KINDS}
        if first is None or any(e is None or e.inputs != first.inputs for e in found.values()):
            return None
        return {kind: session().read.parquet(e.path) for kind, e in found.items()}


def missing(catalogue: Catalogue, window: tuple[str, str], settings: Settings) -> str:
    """What a run must make before scores can be had without events."""
    lacking = [kind for kind in KINDS if catalogue.find(kind, window, settings) is None]
    return f"{', '.join(lacking) or 'tables of the same inputs'} from {window[0]} to {window[1]} with these settings"

