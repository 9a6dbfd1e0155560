import os
import random

import pytest
from helpers import ts

from pairloom.operators.cleaning import clean_events
from pairloom.operators.sessions import build_sessions
from pairloom.schemas import CONTRACTS
from pairloom.streaming.carry_over import STATE_STORE, carried_sessions, open_sessions, sessions_through, split_sessions

RAW = "user_id long, date date, timestamp timestamp_ntz, action_type string, widget_name string, search_query string, item_id long"


def day_rows(day, users=8, seed=0):
    """A day's raw events: sessions over midnight, exact copies, search rows, missing values."""
    r = random.Random(1000 * seed + day)
    rows = []
    for user in range(users):
        times = [ts(day, f"{r.randint(0, 23):02d}:{r.randint(0, 59):02d}") for _ in range(r.randint(0, 12))] + ([ts(day, "00:05"), ts(day, "23:50")] if user % 2 else [])
        rows += [(user, t.date(), t, r.choice(["view", "click", "to_cart", "search"]), r.choice(["w", None]), None, r.randint(1, 9)) for t in times]
    return [*rows, *rows[:5], (None, ts(day, "10:00").date(), ts(day, "10:00"), "view", "w", None, 1), (1, ts(day, "10:00").date(), None, "view", "w", None, 1)]


@pytest.fixture
def stream(spark, tmp_path):
    before = spark.conf.get(STATE_STORE[0])
    spark.conf.set(*STATE_STORE)
    folder = {name: str(tmp_path / name) for name in ("in", "out", "state")}
    os.makedirs(folder["in"])
    yield folder
    spark.conf.set(STATE_STORE[0], before)


def feed(spark, folder, name, rows):
    spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(f"{folder['in']}/{name}")


def go_on(spark, folder, timeout=30, lateness="0 seconds"):
    """All that is new in the folder, from the checkpoint on: a restart each time."""
    raw = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(f"{folder['in']}/*")
    query = carried_sessions(raw, timeout, lateness).writeStream.format("parquet").option("path", folder["out"]).option("checkpointLocation", folder["state"]).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(folder["out"])


def rows_of(df):
    return sorted(map(tuple, df.select(*CONTRACTS["sessions"]).collect()), key=repr)


def test_days_one_by_one_equal_a_batch_of_all(spark, stream):
    rows = []
    for day in (1, 2, 3, 4):
        feed(spark, stream, day, new := day_rows(day))
        rows += new
        finished = go_on(spark, stream)
        expected = rows_of(build_sessions(clean_events(spark.createDataFrame(rows, RAW)), 30))
        assert rows_of(finished.unionByName(open_sessions(spark, stream["state"]))) == expected
        assert set(rows_of(finished)) <= set(expected)
    assert finished.count() > len(expected) / 2
    assert rows_of(sessions_through(finished, spark, stream["state"], "2024-03-04")) == expected
    for other in ("2024-03-03", "2024-03-05"):
        with pytest.raises(ValueError, match="session state"):
            sessions_through(finished, spark, stream["state"], other)


def test_late_events_within_the_lateness(spark, stream):
    """Every third event of a day comes with the next day's."""
    days, rows = {d: day_rows(d, seed=7) for d in (1, 2, 3)}, []
    for d in days:
        late = days[d - 1][::3] if d > 1 else []
        new = [r for k, r in enumerate(days[d]) if k % 3 or d == 3] + late
        feed(spark, stream, d, new)
        rows += new
        finished = go_on(spark, stream, 60, "2 days")
    both = finished.unionByName(open_sessions(spark, stream["state"], 60))
    assert rows_of(both) == rows_of(build_sessions(clean_events(spark.createDataFrame(rows, RAW)), 60))


def test_a_gap_of_the_timeout_goes_on():
    second = 1_000_000
    events = [(0,), (60 * second,), (121 * second - 1,), (182 * second,), (182 * second,)]
    assert [len(s) for s in split_sessions(events, 61 * second)] == [3, 1]  # whole seconds count, copies don't
