"""Sessions of a stream that go on from batch to batch: keyed state with timers.

A user's events stay in the state until their session can get no more: once the watermark is beyond its last event by
more than the timeout. Then its rows leave with the session's number in the user's whole history, which the state keeps
too, and exact copies leave once. Whatever the batches and restarts, finished sessions and those still open in the
checkpoint (``open_sessions``) together are those of ``build_sessions`` over all events, but for events that came later than
the watermark allows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from pairloom.operators.cleaning import readable_events
from pairloom.operators.sessions import TIMEOUT_MINUTES
from pairloom.plans.incremental import state_date_matches
from pairloom.schemas import ACTIONS, CONTRACTS

#: The state store that timers need; a setting of the session.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_OPEN = "us long, item_id long, action_type string, widget_name string, copy string"
_FINISHED = "user_id long, session_index long, session_start_us long, us long, action_type string, item_id long, widget_name string"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _micros(timestamp: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), timestamp)


def _timestamp(micros: str) -> Column:
    return F.expr(f"timestampadd(MICROSECOND, {micros}, {_EPOCH})")


def _gap(timeout_minutes: float) -> int:
    """Microseconds after which an event starts a session: gaps count in whole seconds, an equal one goes on."""
    return (int(timeout_minutes * 60) + 1) * 1_000_000


def split_sessions(events: list[tuple], gap: int) -> list[list[tuple]]:
    """Events (us, …), each once, as sessions in order."""
    sessions: list[list[tuple]] = []
    for event in sorted(set(events), key=lambda e: (e[0], repr(e))):
        if sessions and event[0] - sessions[-1][-1][0] < gap:
            sessions[-1].append(event)
        else:
            sessions.append([event])
    return sessions


class SessionCarrier(StatefulProcessor):
    """State of a user: the events of sessions that may go on, and how many sessions are finished."""

    def __init__(self, timeout_minutes: float) -> None:
        self.gap = _gap(timeout_minutes)

    def init(self, handle: Any) -> None:
        self.handle = handle
        self.open = handle.getListState("open", _OPEN)
        self.finished = handle.getValueState("finished", "n long")

    def _wake(self, sessions: list[list[tuple]]) -> None:
        """A timer for when the first session may be over."""
        if sessions:
            self.handle.registerTimer(-(-(sessions[0][-1][0] + self.gap) // 1000))

    def handleInputRows(self, key: Any, rows: Iterator[Any], timerValues: Any) -> Iterator[Any]:
        new: list[tuple] = []
        for batch in rows:
            new += zip(*(batch[c.split()[0]].tolist() for c in _OPEN.split(", ")), strict=True)
        if new:
            new = [(int(us), int(item), action, None if widget != widget else widget, copy) for us, item, action, widget, copy in new]
            self.open.appendList(new)
            if next(iter(self.handle.listTimers()), None) is None:
                self._wake(split_sessions(new, self.gap))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Any]:
        import pandas as pd

        now = timerValues.getCurrentWatermarkInMs() * 1000
        sessions = split_sessions([tuple(e) for e in self.open.get()], self.gap)
        over = [s for s in sessions if now - s[-1][0] >= self.gap]  # the first ones: later sessions end later
        if over:
            before = self.finished.get()[0] if self.finished.exists() else 0
            self.finished.update((before + len(over),))
            made = [(key[0], before + n, s[0][0], us, action, item, widget) for n, s in enumerate(over, 1) for us, item, action, widget, _ in s]
            yield pd.DataFrame(made, columns=[c.split()[0] for c in _FINISHED.split(", ")])
        rest = sessions[len(over) :]
        if rest:
            self.open.put([e for s in rest for e in s])
            self._wake(rest)
        else:
            self.open.clear()

    def close(self) -> None:
        pass


def _as_sessions(df: DataFrame) -> DataFrame:
    """Contract columns from microseconds; the widget is filled as in clean events."""
    widget = F.coalesce("widget_name", F.lit("unknown"))
    found = df.withColumns({"timestamp": _timestamp("us"), "session_start_date": F.to_date(_timestamp("session_start_us")), "widget_name": widget})
    return found.withColumn("event_date", F.to_date("timestamp")).select(*CONTRACTS["sessions"])


def carried_sessions(raw: DataFrame, timeout_minutes: float = TIMEOUT_MINUTES, lateness: str = "0 seconds", actions: Sequence[str] = ACTIONS) -> DataFrame:
    """Rows of finished sessions of a stream of raw events, each with its session's number and first date.

    Needs the RocksDB state store (``STATE_STORE``) and the append mode. Events may come in any order within ``lateness``.
    """
    if timeout_minutes <= 0:
        raise ValueError("timeout_minutes must be positive")
    copy = F.md5(F.to_json(F.struct(*CONTRACTS["raw_events"])))
    events = readable_events(raw.withColumn("copy", copy), actions, "copy").withColumn("us", _micros(F.col("timestamp")))
    events = events.select("user_id", "us", F.col("item_id").cast("long").alias("item_id"), "action_type", "widget_name", "copy", F.timestamp_micros("us").alias("at")).withWatermark("at", lateness)
    done = events.groupBy("user_id").transformWithStateInPandas(SessionCarrier(timeout_minutes), _FINISHED, "append", "eventtime")
    return _as_sessions(done)


def open_sessions(spark: SparkSession, checkpoint: str, timeout_minutes: float = TIMEOUT_MINUTES) -> DataFrame:
    """Rows of the sessions that the state of a checkpoint holds, as they would leave it if no event came any more."""
    state = lambda name: spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()
    events = state("open").select(F.col("key.user_id").alias("user_id"), "list_element.*").distinct()
    finished = state("finished").select(F.col("key.user_id").alias("user_id"), F.col("value.n").alias("n"))
    gap = _gap(timeout_minutes)

    def split(key: tuple, rows: Any) -> Any:
        import pandas as pd

        found = split_sessions(list(rows[["us", "item_id", "action_type", "widget_name", "copy"]].itertuples(index=False, name=None)), gap)
        made = [(key[0], n, s[0][0], us, action, item, widget) for n, s in enumerate(found, 1) for us, item, action, widget, _ in s]
        return pd.DataFrame(made, columns=[c.split()[0] for c in _FINISHED.split(", ")])

    later = events.groupBy("user_id").applyInPandas(split, _FINISHED).join(finished, "user_id", "left")
    return _as_sessions(later.withColumn("session_index", F.col("session_index") + F.coalesce("n", F.lit(0))))


def sessions_through(finished: DataFrame, spark: SparkSession, checkpoint: str, window_end: str, timeout_minutes: float = TIMEOUT_MINUTES) -> DataFrame:
    """All sessions up to a date: finished ones and those in the state, which must have seen that day and none after it."""
    found = finished.unionByName(open_sessions(spark, checkpoint, timeout_minutes))
    state_date_matches(str(found.agg(F.max("event_date")).first()[0]), window_end)
    return found
