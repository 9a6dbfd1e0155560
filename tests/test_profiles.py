import csv

from helpers import clean, ts

from pairloom.operators import diagnostics, eda
from pairloom.output.tracking import append_record, for_display


def test_gap_summary(spark):
    events = clean(spark, [(1, ts(1, "00:00"), "view", 1), (1, ts(1, "00:10"), "view", 2), (1, ts(1, "00:45"), "view", 3), (2, ts(1, "00:00"), "view", 1)])
    row = diagnostics.gap_summary(events, 30, quantiles=(0.5,)).first()
    assert (row["events"], row["diffs"], row["over_timeout"], row["sessions"], row["p50"]) == (4, 2, 1, 3, 1350.0)
    assert diagnostics.gap_summary(events.limit(0), 30).first()["events"] == 0


def test_null_profile_of_rows_and_of_none(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, `b.c` string")
    got = {r["column_name"]: (r["row_count"], r["null_count"], r["null_share"]) for r in diagnostics.null_profile(df).collect()}
    assert got == {"a": (2, 0, 0.0), "b.c": (2, 1, 0.5)}
    assert [r["null_share"] for r in diagnostics.null_profile(df.limit(0)).collect()] == [None, None]


def test_partition_profile(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "n long, k string")
    df.coalesce(1).write.partitionBy("k").parquet(f"{tmp_path}/t")
    got = {r["k"]: (r["files"], r["rows"]) for r in diagnostics.partition_profile(spark.read.parquet(f"{tmp_path}/t"), ["k"]).collect()}
    assert got == {"a": (1, 2), "b": (1, 1)}


def test_search(spark):
    items = spark.createDataFrame([(12, "Red Cup"), (3, None), (4, "cup 12")], "item_id long, item_name string")
    assert [r["item_id"] for r in eda.search_items(items, " 12 ").collect()] == [12]
    assert sorted(r["item_id"] for r in eda.search_items(items, "CUP").collect()) == [4, 12]


def test_records_and_labels(spark, tmp_path):
    append_record(f"{tmp_path}/t.csv", {"id": 1, "hit": 0.5})
    append_record(f"{tmp_path}/t.csv", {"id": 2, "ndcg": 0.1})
    with open(f"{tmp_path}/t.csv") as f:
        assert list(csv.DictReader(f)) == [{"id": "1", "hit": "0.5", "ndcg": ""}, {"id": "2", "hit": "", "ndcg": "0.1"}]
    append_record(f"file://{tmp_path}/deep/t.csv", {"id": 3, "note": "a, \"b\"\nc"})
    append_record(f"file://{tmp_path}/deep/t.csv", {"id": 4})
    with open(f"{tmp_path}/deep/t.csv", newline="") as f:
        assert [r["note"] for r in csv.DictReader(f)] == ['a, "b"\nc', ""]
    shown = for_display(spark.createDataFrame([(1, 2, "fallback_category_type_popular"), (1, 3, None), (1, 4, "behavioral")], "item_id int, similar_item_id int, source string"))
    assert [r["source_label"] for r in shown.orderBy("similar_item_id").collect()] == ["popular by category and type", "unknown", "seen together"]
