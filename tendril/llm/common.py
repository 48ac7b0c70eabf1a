"""Shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    What lies above it runs once, and a lost executor takes nothing of it along.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, label: str, by: list[str]) -> DataFrame:
    """Write ``df`` as a table bucketed by ``by``, in as many buckets as shuffles have partitions, and read it back.

    Rows that come out of a shuffle by the same columns go straight to their bucket, and joins on them don't shuffle the
    table again.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), *by).saveAsTable(name)
    return spark.table(name)


def record_batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int = 512) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), types, strict=True)], names)
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once per row, however often later expressions read it.

    The optimizer would copy an expression into each of its readers; it doesn't do so through a generator.
    """
    return df.drop(name).select("*", F.explode(F.array(value)).alias(name))


def components(edges: DataFrame, left: str, right: str, most_rounds: int = 60) -> DataFrame:
    """(node, root) of an undirected graph: root is the smallest node connected to it. Only nodes with edges have rows.

    Alternates the large-star and small-star steps: every node's larger neighbours, then its smaller ones, are hung on
    the smallest of them. Edges never grow in number, a step is one aggregation and one join, and the number of rounds
    follows the logarithm of the longest path. Each round is written to the scratch folder.
    """
    def star(e: DataFrame) -> DataFrame:
        # hang on the smallest neighbour: first everything larger than the node itself, then everything smaller
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        return (large.join(small, "a").select(F.col("b").alias("x"), "m", "a")
                .select(F.explode(F.array(F.struct(F.col("x").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
                .select("e.a", "e.b").where("a <> b").distinct())

    e = stored(edges.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).where("a <> b").distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        nxt = stored(star(e), "edges")
        now = nxt.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        e, last, mark = nxt, mark, tuple(now)
        if last == mark:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
