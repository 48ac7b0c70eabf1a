"""Streaming ingestion over the events table read as a file stream, and over notice documents."""

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import ingest as ig
from . import notices
from .registry import query


def _stream(t):
    """The events table as a stream of files, with routing flags."""
    return t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.root).withColumns({
        "batch": F.col("event_type") != "error", "test": F.col("event_type") == "signup"})


def _run(t, stream, routes, root, prepare_rows=None, times=2):
    for _ in range(times):  # a second run finds nothing new
        ig.run_routed(stream, routes, f"{root}/checkpoint", prepare_rows=prepare_rows)


@query("a83_incremental_ingestion", "SELECT event_id, user_id, value FROM events")
def incremental_ingestion(t):
    root = scratch_path(t.spark, "incremental")
    _run(t, _stream(t), {"all": (F.lit(True), f"{root}/out")}, root)
    return t.spark.read.parquet(f"{root}/out").select("event_id", "user_id", "value")


@query("a83_incremental_notices", notices.SRC + "SELECT file AS FILE, lg AS LG, amount AS VALUES__VALUE FROM f")
def incremental_notices(t):
    """Documents flattened inside the stream by the plan the batch job uses."""
    root = scratch_path(t.spark, "notices")
    notices.composed(t).write.parquet(f"{root}/in")
    stream = t.spark.readStream.schema("file string, date string, value string").parquet(f"{root}/in")
    rates = notices.rates(t.spark)
    _run(t, stream, {"all": (F.lit(True), f"{root}/out")}, root, lambda batch: ig.notice_table(batch, rates, ["FILE", "LG", "VALUES__VALUE"]))
    return t.spark.read.parquet(f"{root}/out").select("FILE", "LG", "VALUES__VALUE")


@query("a84_scheduled_pull", "SELECT count(*) AS first_run, 0::BIGINT AS second_run FROM events")
def scheduled_pull(t):
    """What a scheduler does: start, take what is new, stop; the second run takes nothing."""
    root = scratch_path(t.spark, "pull")
    stream = _stream(t)
    taken = []
    for _ in range(2):
        ig.run_routed(stream, {"all": (F.lit(True), f"{root}/out")}, f"{root}/checkpoint")
        taken.append(t.spark.read.parquet(f"{root}/out").count())
    return t.spark.read.parquet(f"{root}/out").agg(F.lit(taken[0]).cast("long").alias("first_run"), (F.count("*") - taken[0]).alias("second_run"))


@query("a85_batch_and_late_routing", "SELECT CASE WHEN event_type = 'error' THEN 'late' ELSE 'batch' END AS route, count(*) AS n FROM events GROUP BY 1")
def batch_and_late(t):
    root = scratch_path(t.spark, "routing")
    _run(t, _stream(t), ig.batch_routes(root), root)
    part = lambda folder, name: t.spark.read.parquet(f"{root}/{folder}").select(F.lit(name).alias("route"))
    return part("years", "batch").unionByName(part("merged/new_data", "late")).groupBy("route").agg(F.count("*").alias("n"))


@query("a86_trial_routing", "SELECT CASE WHEN event_type = 'signup' THEN 'trial' ELSE 'month' END AS route, count(*) AS n FROM events GROUP BY 1")
def trial_routing(t):
    root = scratch_path(t.spark, "trial")
    _run(t, _stream(t), ig.trial_routes(root), root)
    part = lambda folder, name: t.spark.read.parquet(f"{root}/{folder}").select(F.lit(name).alias("route"))
    return part("months", "month").unionByName(part("trials", "trial")).groupBy("route").agg(F.count("*").alias("n"))


@query("a87_redelivery", "SELECT event_id, value, CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS delivery FROM events")
def redelivery(t):
    """Every event in a second delivery, some of it (the errors) for the first time, days behind the newest event of the first."""
    root = scratch_path(t.spark, "redelivery")
    events = t.events.select("event_id", "value", "event_type")
    files = 4
    for n, part in ((1, events.filter("event_type <> 'error'")), (2, events)):
        part.withColumn("delivery", F.lit(n)).repartition(files).write.parquet(f"{root}/in/{n}")
    # as many files a micro-batch as a delivery has: the second one comes in a micro-batch of its own
    schema = t.spark.read.parquet(f"{root}/in/1").schema
    stream = t.spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{root}/in/*")
    for _ in range(2):  # a second run finds nothing new
        ig.run_once_per_key(stream, ["event_id"], f"{root}/out", f"{root}/checkpoint", ["delivery"])
    return t.spark.read.parquet(f"{root}/out").select("event_id", "value", "delivery")
