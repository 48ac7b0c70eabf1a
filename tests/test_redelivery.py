"""First deliveries over many micro-batches, with gathered keys; draws and merges that SQL can't show."""

import pytest
from pyspark.sql import functions as F

from tendril.operators import grouping, joins, profile
from tendril.sources import tables as tb
from tendril.streaming import ingest as ig


@pytest.mark.parametrize("every", [1, 2, 16])
def test_first_delivery_of_each_key(spark, tmp_path, every):
    batches = [[(1, "a"), (2, "b"), (2, "b2")], [(2, "late"), (3, "c")], [(None, "n1"), (1, "again")], [(None, "n2"), (4, "d")], [(3, "c2"), (5, "e"), (1, "x")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "k int, v string").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = lambda: spark.readStream.schema("k int, v string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    for _ in range(2):
        ig.run_once_per_key(stream(), ["k"], f"{tmp_path}/out", f"{tmp_path}/checkpoint", ["v"], every)
    got = sorted(((r.k is None, r.k or 0), r.v) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [((False, 1), "a"), ((False, 2), "b"), ((False, 3), "c"), ((False, 4), "d"), ((False, 5), "e"), ((True, 0), "n1")]
    # a later delivery finds the keys, gathered or not
    spark.createDataFrame([(5, "old"), (6, "new")], "k int, v string").coalesce(1).write.parquet(f"{tmp_path}/in/9")
    ig.run_once_per_key(stream(), ["k"], f"{tmp_path}/out", f"{tmp_path}/checkpoint", ["v"], every)
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/out").where("k > 4").collect()) == ["e", "new"]


def test_files_without_rows_are_not_broken(spark, tmp_path):
    path = str(tmp_path)
    spark.range(3).write.parquet(f"{path}/a")
    spark.range(0).write.parquet(f"{path}/b")
    tb.put_file(spark, f"{path}/c/broken.parquet", b"PAR1 and then nothing")
    assert [r.path.split("/")[-1] for r in tb.unreadable(spark, path).collect()] == ["broken.parquet"]


def test_draws(spark):
    rows = spark.range(50).select("id", F.when(F.col("id") == 7, 1000).otherwise(F.col("id") % 2).cast("long").alias("w"))
    plain = grouping.draw_with_replacement(rows, 400, ["id"], 3)
    assert plain.count() == 400 and plain.select("draw").distinct().count() == 400
    again = grouping.draw_with_replacement(rows.repartition(7), 400, ["id"], 3)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, again.collect()))
    weighted = grouping.draw_with_replacement(rows, 400, ["id"], 3, "w").groupBy("id").count().collect()
    assert {r.id: r["count"] for r in weighted}[7] > 350 and all(r.id % 2 for r in weighted)
    assert grouping.draw_with_replacement(rows.limit(0), 5, ["id"]).count() == 0
    assert grouping.draw_with_replacement(rows.withColumn("w", F.lit(0)), 5, ["id"], 0, "w").count() == 0
    some = grouping.draw_weighted_fraction(rows, 0.1, ["id"], F.col("w"), 5).collect()
    assert len(some) == 5 and 7 in {r.id for r in some}


def test_ordered_merge_by_group_with_a_null_group(spark):
    left = spark.createDataFrame([("a", 1, 1.0), ("a", 4, 2.0), (None, 2, 5.0)], "g string, k int, v double")
    right = spark.createDataFrame([(2, 10), (3, 20)], "k int, n int")
    got = sorted(((r.g or "~"), r.k, r.v, r.n) for r in joins.ordered_merge(left, right, "k", left_by=["g"]).collect())
    assert got == [("a", 1, 1.0, None), ("a", 2, 1.0, 10), ("a", 3, 1.0, 20), ("a", 4, 2.0, 20), ("~", 2, 5.0, 10), ("~", 3, 5.0, 20)]


def test_redundant_columns_of_all_kinds(spark):
    rows = [(i, i % 3, ["x", "y", None][i % 3], [i % 3], None, i % 2, "c") for i in range(40)]
    df = spark.createDataFrame(rows, "i int, a int, b string, c array<int>, d string, e int, f string")
    got = {tuple(r) for r in profile.redundant_columns(df, list("abcdef")).collect()}
    assert got == {(x, y) for group in ("abc", "df") for x in group for y in group if x != y}
    assert profile.redundant_columns(df.unionByName(df), list("abe")).count() == 2
    # in an empty table all columns are alike
    assert profile.redundant_columns(df.limit(0), ["a", "b"]).count() in (0, 2)


@pytest.mark.parametrize(("rule", "freq"), [("MS", "MS"), ("QE", "QE"), ("YS", "YS"), ("BME", "BME"), ("BMS", "BMS"), ("BQE", "BQE"), ("BYE", "BYE"), ("SMS", "SMS"), ("SME", "SME"), ("W-SUN", "W-SUN"), ("WOM-2TUE", "WOM-2TUE"), ("LWOM-FRI", None), ("B", "B")])
def test_calendar_rules_equal_pandas(spark, rule, freq):
    import pandas as pd

    from tendril.operators.resample import anchored_dates

    want = [x.date() for x in pd.date_range("2019-01-15", "2022-12-31", freq=freq or pd.offsets.LastWeekOfMonth(weekday=4))]
    assert sorted(r.date for r in anchored_dates(spark, rule, "2019-01-15", "2022-12-31").collect()) == want
    if rule in ("YS", "SME"):
        assert [r.date for r in anchored_dates(spark, rule, "2019-01-15", periods=3).collect()] == want[:3]
