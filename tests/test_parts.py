import os
import random

import pytest
from helpers import same_rows
from pyspark.sql import functions as F
from test_carry_over import RAW, day_rows, feed, stream  # noqa: F401

from pairloom.operators.cleaning import clean_events
from pairloom.operators.pairs import daily_pair_stats
from pairloom.operators.sessions import build_sessions
from pairloom.plans.parts import TABLES, DailyParts, parts_sink
from pairloom.streaming.carry_over import carried_sessions, open_sessions


def all_sessions(spark, days=(1, 2, 3)):
    return build_sessions(clean_events(spark.createDataFrame([r for d in days for r in day_rows(d)], RAW)), 30)


def same_tables(got, expected):
    for name in TABLES:
        a, b = getattr(got, name), getattr(expected, name)
        same_rows([tuple(r) for r in a.collect()], a.columns, [tuple(r) for r in b.collect()], b.columns)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_and_repetition_equals_one_build(spark, tmp_path, seed):
    """Parts by user, shuffled, some twice, compacted on the way."""
    sessions, r = all_sessions(spark), random.Random(seed)
    order = [0, 1, 2, 3] + r.choices(range(4), k=3)
    r.shuffle(order)
    parts, seen = DailyParts(str(tmp_path / "p")), set()
    for n, k in enumerate(order):
        assert parts.add(f"users-{k}", sessions.filter(F.col("user_id") % 4 == k)) == (k not in seen)
        seen.add(k)
        if n in (2, 4):
            parts.compact()
    same_tables(parts.read(), daily_pair_stats(sessions))
    parts.compact()
    assert list(parts.ledger()["live"]) == ["compacted"]
    same_tables(parts.read(), daily_pair_stats(sessions))
    assert not parts.add("users-1", sessions.filter(F.col("user_id") % 4 == 1))


def test_a_part_of_a_day_that_exists_is_merged(spark, tmp_path):
    """Late sessions of days that have tables: counts add up, users' keys stay distinct."""
    sessions = all_sessions(spark)
    parts = DailyParts(str(tmp_path / "p"))
    parts.add("first", sessions.filter(F.col("session_index") % 2 == 0))
    late = sessions.filter(F.col("session_index") % 2 == 1)
    same_tables(parts.read(daily_pair_stats(late)), daily_pair_stats(sessions))
    parts.add("late", late)
    same_tables(parts.read(), daily_pair_stats(sessions))


def test_a_part_that_was_broken_off_counts_not_at_all(spark, tmp_path, monkeypatch):
    sessions, parts = all_sessions(spark), DailyParts(str(tmp_path / "p"))
    parts.add("one", sessions.filter("user_id < 3"))
    before = {name: getattr(parts.read(), name).count() for name in TABLES}
    with monkeypatch.context() as m:
        m.setattr("pairloom.plans.parts.write_manifest", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            parts.add("two", sessions.filter("user_id >= 3"))
    assert {name: getattr(parts.read(), name).count() for name in TABLES} == before
    assert parts.add("two", sessions.filter("user_id >= 3"))
    same_tables(parts.read(), daily_pair_stats(sessions))


def test_nothing_there(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        DailyParts(str(tmp_path / "none")).read()
    parts = DailyParts(str(tmp_path / "p"))
    parts.add("empty", all_sessions(spark).limit(0))
    parts.compact()


def test_a_killed_and_replayed_batch_changes_nothing(spark, stream, tmp_path):  # noqa: F811
    """The sink dies after the tables are written and before the stream has noted the batch."""
    folder, rows, calls = str(tmp_path / "tables"), [], []
    add = parts_sink(folder, compact_every=2)

    def dying(batch, number):
        add(batch, number)
        calls.append(number)
        if len(calls) == 3:
            raise RuntimeError("killed")

    def go_on():
        raw = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(f"{stream['in']}/*")
        query = carried_sessions(raw, 30).writeStream.foreachBatch(dying).option("checkpointLocation", stream["state"]).trigger(availableNow=True).start()
        query.awaitTermination()

    for day in (1, 2, 3):
        feed(spark, stream, day, new := day_rows(day))
        rows += new
        try:
            go_on()
        except Exception:
            assert len(calls) == 3
            go_on()
    assert len(calls) > len(set(calls))  # a batch came twice
    expected = daily_pair_stats(build_sessions(clean_events(spark.createDataFrame(rows, RAW)), 30))
    same_tables(DailyParts(folder).read(daily_pair_stats(open_sessions(spark, stream["state"]))), expected)
    assert os.path.exists(f"{folder}/ledger.json")
