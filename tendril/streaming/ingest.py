"""Incremental ingestion: new documents flow through the batch plan and are routed to their folders."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..operators.flatten import notice_columns
from ..operators.grouping import drop_duplicates
from ..operators.normalize import extracted
from ..operators.ordered import equi_join
from ..session import prepare


def document_stream(spark: SparkSession, root: str, files_per_trigger: int = 1000) -> DataFrame:
    """New XML files below a folder, whole text per row; files already taken are remembered by the checkpoint."""
    reader = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml")
    text = reader.option("maxFilesPerTrigger", files_per_trigger).text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    return text.select(F.col("_metadata.file_name").alias("file"), F.regexp_extract(path, r"(\d{8})_[^/]*/[^/]*$", 1).alias("date"), "value")


def notice_table(docs: DataFrame, rates: DataFrame, columns: list[str] | None = None, **choice) -> DataFrame:
    """The extracted table of a document table or stream, or the named columns of it; stateless, so batch and stream share it."""
    return extracted(notice_columns(docs, S.source_paths(columns), **choice), rates, columns)


def run_routed(
    stream: DataFrame, routes: dict[str, tuple[Column, str]], checkpoint: str, partition: list[str] = (), prepare_rows: Callable | None = None
) -> StreamingQuery:
    """Take what is new, write each row to the folder of its route, stop.

    ``routes`` maps a name to (condition, folder). Files lie under the micro-batch number, and a repeated micro-batch
    replaces its own files, so a retry after a lost executor or driver adds nothing.
    """
    prepare(stream.sparkSession)

    def write(batch: DataFrame, number: int) -> None:
        rows = prepare_rows(batch) if prepare_rows else batch
        rows = rows.persist() if len(routes) > 1 else rows  # several routes read one flattened batch
        for condition, folder in routes.values():
            part = rows.filter(condition).withColumn("batch_no", F.lit(number))
            part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_no", *partition).parquet(folder)
        rows.unpersist()

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def batch_routes(root: str, flag: str = "batch") -> dict[str, tuple[Column, str]]:
    """Batch rows (flag missing or true) to the yearly folder, late ones to a folder queryable at once and merged later."""
    late = F.coalesce(~F.col(flag), F.lit(False))
    return {"batch": (~late, f"{root}/years"), "late": (late, f"{root}/merged/new_data")}


def trial_routes(root: str, flag: str = "test") -> dict[str, tuple[Column, str]]:
    """Trial rows to daily files of their own, the rest to the month table."""
    trial = F.coalesce(F.col(flag), F.lit(False))
    return {"month": (~trial, f"{root}/months"), "trial": (trial, f"{root}/trials")}


def without_redelivery(stream: DataFrame, keys: list[str], event_time: str | None = None, window: str = "15 minutes") -> DataFrame:
    """First delivery of each key. With an event time the state is dropped once ``window`` has passed, and later rows with it."""
    if event_time:
        return stream.withWatermark(event_time, window).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


def run_once_per_key(stream: DataFrame, keys: list[str], folder: str, checkpoint: str, order: list[str] = (), compact_every: int = 16, **trigger) -> StreamingQuery:
    """Write the first delivery of each key to ``folder``, however much later a second one comes; nothing is too late to be kept.

    There is no state to outgrow memory: a micro-batch is held against the keys already written by an anti join. Within a
    micro-batch the first row along ``order`` stays. Rows and keys lie under the micro-batch's number, and a repeated micro-batch
    looks at earlier numbers only and replaces its own files. Every ``compact_every`` micro-batches the keys so far are gathered
    into one set, so their files do not grow in number.
    """
    spark = prepare(stream.sparkSession)
    log = f"{folder}_keys"

    def known(number: int, like: DataFrame) -> DataFrame:
        # sets hold all keys below their number; the newest one that this micro-batch may see is enough, with what came after it
        base = max((n for n in range(0, number + 1, compact_every) if n), default=0)
        sets = _read_if(spark, f"{log}/sets", like, base).filter(F.col("upto") == base) if base else None
        after = _read_if(spark, f"{log}/batches", like, 0, "batch_no").filter((F.col("batch_no") >= base) & (F.col("batch_no") < number))
        after = after.select(*keys)
        return after if sets is None else sets.select(*keys).unionByName(after)

    def write(batch: DataFrame, number: int) -> None:
        like = batch.select(*keys)
        if number and number % compact_every == 0:
            before = number - compact_every
            older = [_read_if(spark, f"{log}/sets", like, before).filter(F.col("upto") == before).select(*keys)] if before else []
            newer = _read_if(spark, f"{log}/batches", like, 0, "batch_no").filter((F.col("batch_no") >= before) & (F.col("batch_no") < number)).select(*keys)
            _put(reduce(DataFrame.unionByName, [*older, newer]), f"{log}/sets", "upto", number)
        first = drop_duplicates(batch, keys, list(order) or [c for c in batch.columns if c not in keys] or keys)
        fresh = equi_join(first, known(number, like).distinct(), keys, "left_anti", null_safe=True)
        _put(fresh, folder, "batch_no", number)
        _put(spark.read.parquet(f"{folder}/batch_no={number}").select(*keys), f"{log}/batches", "batch_no", number)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    query.awaitTermination()
    return query


def _put(rows: DataFrame, folder: str, name: str, number: int) -> None:
    """Rows under ``name=number``, in place of what lies there."""
    rows.write.mode("overwrite").parquet(f"{folder}/{name}={number}")


def _read_if(spark: SparkSession, folder: str, like: DataFrame, least: int, name: str = "upto") -> DataFrame:
    """What lies in ``folder``, by number; no rows where nothing has been written yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    schema = T.StructType([*like.schema.fields, T.StructField(name, T.LongType())])
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder).filter(F.col(name) >= least)
