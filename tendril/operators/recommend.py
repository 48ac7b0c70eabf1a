"""Service and contractor pairs, and recommendations from implicit feedback."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_root
from .ordered import col, position, settle

# Fixed values of the award filter.
AWARD_CATEGORY = "ORIGINAL"
AWARD_TYPE = "Contract award notice"


def filled(items: Column) -> Column:
    """All items of a list are present and not empty."""
    return F.coalesce(F.forall(items, lambda x: x.isNotNull() & (x != "")), F.lit(False))


def award_pairs(df: DataFrame, services: str, contractors: str, category: str = "category", kind: str = "td_document_type") -> DataFrame:
    """(service, contractor) of original award notices with exactly one contractor, one row per service."""
    awards = df.filter((col(category) == AWARD_CATEGORY) & (col(kind) == AWARD_TYPE))
    awards = awards.filter(filled(col(services)) & filled(col(contractors)) & (F.size(col(contractors)) == 1))
    return awards.select(F.explode(col(services)).alias("service"), F.get(col(contractors), 0).alias("contractor"))


def listed_pairs(df: DataFrame, services: str = "service", contractors: str = "contractor") -> DataFrame:
    """Pairs from '[a,b]' texts: one service goes to every contractor, several pair by position, other rows are dropped."""
    items = lambda c: F.split(F.expr(f"substring(`{c}`, 2, length(`{c}`) - 2)"), ",")
    rows = df.filter(col(contractors) != "[null]").select(items(services).alias("s"), items(contractors).alias("c"))
    rows = rows.filter((F.size("s") == 1) | (F.size("s") == F.size("c")))
    same = F.when(F.size("s") == 1, F.transform("c", lambda x: F.struct(F.get("s", 0).alias("service"), x.alias("contractor"))))
    by_place = F.transform(F.arrays_zip("s", "c"), lambda z: F.struct(z["s"].alias("service"), z["c"].alias("contractor")))
    return rows.select(F.inline(F.coalesce(same, by_place)))


def label_index(df: DataFrame, column: str) -> DataFrame:
    """(label, id): ids by descending frequency, ties alphabetical, as a string indexer gives.

    The labels stay in a table; an indexer would gather every label on the driver.
    """
    counts = df.filter(col(column).isNotNull()).groupBy(col(column)).agg((-F.count(F.lit(1))).alias("_n"))
    ranked = position(settle(counts, "labels"), [], ["_n", column], f"{column}_id")
    return ranked.select(col(column), F.col(f"{column}_id").cast("int"))


def indexed_pairs(pairs: DataFrame, services: DataFrame, contractors: DataFrame) -> DataFrame:
    """Every pair row (duplicates kept) as ids with rating 1."""
    return pairs.join(services, "service").join(contractors, "contractor").select("service_id", "contractor_id", F.lit(1.0).cast("float").alias("rating"))


def fit(indexed: DataFrame, rank: int = 10, max_iter: int = 5, reg: float = 0.01, seed: int = 42) -> ALSModel:
    """Implicit-feedback factors, services as users and contractors as items; long lineages are checkpointed."""
    context = indexed.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(indexed.sparkSession))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol="service_id", itemCol="contractor_id", ratingCol="rating",
              implicitPrefs=True, coldStartStrategy="drop", seed=seed)
    return als.fit(indexed)


def top_services(model: ALSModel, services: DataFrame, contractors: DataFrame, n: int = 10, only: DataFrame | None = None) -> DataFrame:
    """(rating, contractor, service): the n best services of every contractor, or of those in ``only`` (contractor_id)."""
    factors = model.itemFactors.select(F.col("id").alias("contractor_id"), "features")
    if only is not None:
        factors = factors.join(only, "contractor_id", "left_semi")
    found = best_products(factors, "contractor_id", model.userFactors.select(F.col("id").alias("service_id"), "features"), "service_id", n)
    named = found.join(contractors, "contractor_id").join(services, "service_id")
    return named.select("rating", "contractor", "service")


BLOCK = 4096


def best_products(rows: DataFrame, row_id: str, candidates: DataFrame, candidate_id: str, n: int, block: int = BLOCK) -> DataFrame:
    """(row_id, candidate_id, rating): for each row the n candidates with the largest inner product of ``features``.

    Candidates go by falling norm, in blocks of ``block``; one block at a time meets the rows that are still open. A row is closed
    once its n-th best product is above its norm times the next block's largest norm: no later candidate can reach it. So long
    tails of small candidates are scored for few rows only. Ties go to the smaller id.
    """
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    placed = position(settle(candidates.select(col(candidate_id).cast("long").alias("_id"), "features", (-norm).alias("_less")), "candidates"), [], ["_less", "_id"], "_place")
    placed = settle(placed.withColumn("_block", F.floor(col("_place") / block)), "candidates")
    largest = [-r["_less"] for r in placed.groupBy("_block").agg(F.min("_less").alias("_less")).orderBy("_block").collect()]  # a number a block
    kind = rows.schema[row_id].dataType.simpleString()
    schema = f"id {kind}, features array<float>, best_ids array<bigint>, best array<float>, closed boolean"
    found = rows.select(col(row_id).alias("id"), F.col("features").cast("array<float>"), F.array().cast("array<bigint>").alias("best_ids"), F.array().cast("array<float>").alias("best"), F.lit(False).alias("closed"))
    done = found.limit(0)
    for number in range(len(largest)):
        held = placed.filter(col("_block") == number).select("_id", "features").collect()  # at most ``block`` rows of a model's rank
        shared = rows.sparkSession.sparkContext.broadcast((np.array([r["_id"] for r in held]), np.array([r["features"] for r in held], np.float32)))
        after = largest[number + 1] if number + 1 < len(largest) else None
        found = settle(found.mapInArrow(_best(shared, n, after), schema), "scored")
        done = done.unionByName(found.filter("closed"))
        if after is None:
            break
        found = found.filter("NOT closed")
        if found.isEmpty():
            break
    return done.select(F.col("id").alias(row_id), F.explode(F.arrays_zip("best_ids", "best")).alias("_x")).select(row_id, F.col("_x.best_ids").cast(candidates.schema[candidate_id].dataType).alias(candidate_id), F.col("_x.best").alias("rating"))


def _best(shared, n: int, after: float | None):
    def run(batches):
        ids, matrix = shared.value
        for batch in batches:
            features, old_ids, old = (batch.column(c).to_pylist() for c in (1, 2, 3))
            new_ids, new, closed = [], [], []
            for at in range(0, len(batch), 256):
                own = np.array(features[at:at + 256], np.float32)
                norms = np.sqrt((own.astype(float) ** 2).sum(axis=1))
                for i, scores in enumerate(own @ matrix.T):
                    some = np.concatenate([old[at + i], scores]).astype(np.float32)
                    named = np.concatenate([np.array(old_ids[at + i], np.int64), ids])
                    # all that could be among the n best, ties included
                    if len(some) > n:
                        likely = np.flatnonzero(some >= np.partition(some, len(some) - n)[len(some) - n])
                        some, named = some[likely], named[likely]
                    order = np.lexsort((named, -some))[:n]
                    new_ids.append(named[order])
                    new.append(some[order])
                    # a little room for the rounding of products
                    closed.append(after is None or (len(order) == n and some[order[-1]] > norms[i] * after * (1 + 1e-5)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(new_ids, pa.list_(pa.int64())), pa.array(new, pa.list_(pa.float32())), pa.array(closed, pa.bool_())], ["id", "features", "best_ids", "best", "closed"])
    return run


def recommendations(pairs: DataFrame, n: int = 10, **settings) -> DataFrame:
    """The whole job: index labels, fit, score, and give names back."""
    pairs = settle(pairs, "pairs")
    services, contractors = (settle(label_index(pairs, c), c) for c in ("service", "contractor"))
    model = fit(indexed_pairs(pairs, services, contractors), **settings)
    return top_services(model, services, contractors, n)


def incidence(pairs: DataFrame) -> DataFrame:
    """Distinct pairs: the non-zero cells of the service by contractor matrix."""
    return pairs.distinct().withColumn("present", F.lit(1))


def sample_of_contractors(recs: DataFrame, n: int = 10) -> DataFrame:
    """All rows of the first n contractors in name order."""
    few = recs.select("contractor").distinct().orderBy("contractor").limit(n)
    return recs.join(few, "contractor", "left_semi")
