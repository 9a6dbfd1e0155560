import pytest
from helpers import same_rows
from pyspark.sql import functions as F

from pairloom.output.writers import write_lookup
from pairloom.serving.lookup import SimilarItems
from pairloom.sources.events import counted_from_footers, file_rows


def recommendations(spark, items=2000):
    df = spark.range(items).select((F.col("id") * 3).alias("item_id"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(4).cast("long"))).alias("rank"))
    return df.select("item_id", (F.col("item_id") + F.col("rank")).alias("similar_item_id"), F.lit(1.0).alias("score"), "rank", F.lit("behavioral").alias("source"))


def metric(df, name):
    """A metric of the plan's scan after ``df`` has run."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get(name).get().value()


def test_a_look_up_reads_one_file_and_one_row_group(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pairloom.output.writers.ROW_GROUP_BYTES", 1024)
    path = f"{tmp_path}/lookup.parquet"
    write_lookup(recommendations(spark), path, 4)
    lookup = SimilarItems(spark, path)
    assert len(lookup._files) == 4
    for item in (0, 2997, 5997):
        assert lookup.get(item, 3) == [item + 1, item + 2, item + 3]
        row = lookup.of(item)
        assert metric(row, "numFiles") == 1
        assert metric(row, "numOutputRows") <= 200  # of the 500 or so of the file
    assert lookup.get(1) == lookup.get(-5) == lookup.get(10**6) == []
    assert spark.read.parquet(path).count() == 2000  # the file of ranges is no data


def test_many_at_once(spark, tmp_path):
    path = f"{tmp_path}/lookup.parquet"
    write_lookup(recommendations(spark), path)
    asked = spark.createDataFrame([(3,), (3,), (4,), (None,), (5997,)], "item_id long")
    got = {r[0]: r[1] for r in SimilarItems(spark, path).get_many(asked, 2).collect()}
    assert got == {3: [4, 5], 4: [], 5997: [5998, 5999]}
    with pytest.raises(ValueError, match="positive"):
        SimilarItems(spark, path).get_many(asked, 0)


def test_tables_without_ranges_or_rows(spark, tmp_path):
    spark.createDataFrame([(1, [5])], "item_id long, similar_items_sku_list array<long>").write.parquet(f"{tmp_path}/plain")
    assert SimilarItems(spark, f"{tmp_path}/plain").get(1) == [5]
    write_lookup(recommendations(spark, 0), f"{tmp_path}/none")
    assert SimilarItems(spark, f"{tmp_path}/none").get(1) == []


def test_rows_come_from_footers(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 3).alias("k")).repartition(4).write.partitionBy("k").parquet(f"{tmp_path}/t")
    all_, by_part = counted_from_footers(spark, f"{tmp_path}/t"), counted_from_footers(spark, f"{tmp_path}/t", ["k"])
    assert all_.first()["rows"] == 100 == file_rows(spark, f"{tmp_path}/t").agg(F.sum("rows")).first()[0]
    same_rows([tuple(r) for r in by_part.collect()], by_part.columns, [(0, 34), (1, 33), (2, 33)], ["k", "rows"])
    for df in (all_, by_part):
        assert "PushedAggregation: [COUNT(*)]" in df._jdf.queryExecution().toString()
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
