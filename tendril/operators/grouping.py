"""Per-group row operators: transform, filter, apply, nth, de-duplicate, sample, open/high/low/close."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import col, equi_join, position, running, settle


def transform(df: DataFrame, by: list[str], **outs: Column) -> DataFrame:
    """Group aggregates put on every row: partial aggregation, then a join that adaptive execution can split."""
    totals = df.groupBy(*[col(k) for k in by]).agg(*[v.alias(n) for n, v in outs.items()])
    return equi_join(df, totals, by)


def keep_groups(df: DataFrame, by: list[str], predicate: Column) -> DataFrame:
    """Rows of the groups whose aggregate ``predicate`` holds."""
    kept = df.groupBy(*[col(k) for k in by]).agg(predicate.alias("_keep")).filter("_keep").drop("_keep")
    return equi_join(df, kept, by, "left_semi")


def apply_in_parts(
    df: DataFrame, by: list[str], part: Callable, part_schema: str, combine: Callable, finish: Callable, schema: str, slices: int = 64, held_rows: int = 50_000
) -> DataFrame:
    """A mergeable pandas function per group of any size.

    ``part`` turns the rows of one group in one batch into a few summary rows (group columns included), ``combine`` merges
    summary rows of a group into fewer ones of the same form, ``finish`` makes the result. Rows are first brought together by
    group, so ``part`` is called about once per group however the table lies; adaptive execution splits what is large, so a
    group may be met by many tasks. A task holds one batch and at most ``held_rows`` summary rows of one group; summaries meet
    in slices of a group, then per group.
    """

    def merged(held: list) -> pd.DataFrame:
        whole = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
        # a single row has nothing to be merged with
        return combine(whole) if len(whole) > 1 else whole

    def result(held: list) -> pd.DataFrame:
        whole = combine(pd.concat(held, ignore_index=True))
        # a group that the merge drops has no result
        return finish(whole) if len(whole) else whole.iloc[:0]

    def per_group(first: Callable | None, last: Callable):
        def run(batches):
            key, held = None, []
            for batch in batches:
                ready = []
                for own, rows in batch.groupby(by, sort=False, dropna=False):
                    own = tuple(None if pd.isna(k) else k for k in own)
                    if held and own != key:
                        ready.append(last(held))
                        held = []
                    key = own
                    held.append(first(rows) if first else rows)
                    if len(held) > 1 and sum(map(len, held)) > held_rows:
                        held = [merged(held)]
                if ready := [r for r in ready if len(r)]:
                    yield pd.concat(ready, ignore_index=True)
            if held and len(rest := last(held)):
                yield rest
        return run

    groups = [col(k) for k in by]
    # counts that adaptive execution keeps: summaries are few bytes, but a call each
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = df.hint("rebalance", *groups).sortWithinPartitions(*groups)
    summaries = near.mapInPandas(per_group(part, merged), part_schema).withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(slices)))
    sliced = summaries.repartition(tasks, *groups, "_slice").sortWithinPartitions(*groups, "_slice")
    sliced = sliced.drop("_slice").mapInPandas(per_group(None, merged), part_schema)
    return sliced.repartition(tasks, *groups).sortWithinPartitions(*groups).mapInPandas(per_group(None, result), schema)


def apply_with_summary(df: DataFrame, by: list[str], part: Callable, part_schema: str, combine: Callable, func: Callable, schema: str) -> DataFrame:
    """A pandas function on the rows of groups of any size, each row next to its group's merged summary.

    ``part`` and ``combine`` make the summary as in ``apply_in_parts`` (one row per group); ``func`` turns batches of rows,
    widened by the summary's columns, into result rows. No task holds a group.
    """
    summary = apply_in_parts(df, by, part, part_schema, combine, lambda pdf: pdf, part_schema)
    return equi_join(df, summary, by, null_safe=True).mapInPandas(lambda batches: (func(b) for b in batches if len(b)), schema)


def _numbered(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_row", F.row_number().over(Window.partitionBy(*[col(k) for k in by]).orderBy(*order)))


def head(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """First n rows of each group; the row limit is applied before the shuffle as well as after it."""
    return _numbered(df, by, [col(c).asc() for c in order]).filter(col("_row") <= n).drop("_row")


def tail(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    return _numbered(df, by, [col(c).desc() for c in order]).filter(col("_row") <= n).drop("_row")


def nth(df: DataFrame, by: list[str], order: list[str], n: int) -> DataFrame:
    """Row number n (from 0; negative from the end) of each group that has one."""
    ends = [col(c).asc() if n >= 0 else col(c).desc() for c in order]
    k = n + 1 if n >= 0 else -n
    return _numbered(df, by, ends).filter(col("_row") <= k).filter(col("_row") == k).drop("_row")


def drop_duplicates(df: DataFrame, subset: list[str], order: list[str], keep: str | bool = "first") -> DataFrame:
    """One row per distinct ``subset`` (the first or last along ``order``), or with ``keep=False`` only the unrepeated ones.

    A min/max of the whole row struct is combined before the shuffle; null values count as equal.
    """
    rest = [c for c in df.columns if c not in subset]
    row, place = F.struct(*[col(c) for c in rest]), F.struct(*[col(c) for c in order])
    pick = (F.max_by if keep == "last" else F.min_by)(row, place)
    out = df.groupBy(*[col(c) for c in subset]).agg(pick.alias("_row"), F.count(F.lit(1)).alias("_n"))
    if keep is False:
        out = out.filter("_n = 1")
    return out.select(*[col(c) if c in subset else col("_row").getField(c).alias(c) for c in df.columns])


def flag_duplicates(df: DataFrame, subset: list[str], order: list[str], keep: str | bool = "first", name: str = "duplicated") -> DataFrame:
    """Mark every row that ``drop_duplicates`` would remove; ``order`` identifies a row within equal ``subset`` values."""
    place = F.struct(*[col(c) for c in order])
    pick = (F.max if keep == "last" else F.min)(place)
    kept = df.groupBy(*[col(c) for c in subset]).agg(pick.alias("_kept"), F.count(F.lit(1)).alias("_n"))
    marked = equi_join(df, kept, subset, null_safe=True)
    flag = (col("_n") > 1) if keep is False else (place != col("_kept"))
    return marked.withColumn(name, flag).drop("_kept", "_n")


def open_high_low_close(df: DataFrame, by: list[str], order: list[str], column: str) -> DataFrame:
    place, x = F.struct(*[col(c) for c in order]), col(column)
    return df.groupBy(*[col(k) for k in by]).agg(
        F.min_by(x, place).alias("open"), F.max(x).alias("high"), F.min(x).alias("low"), F.max_by(x, place).alias("close")
    )


def hash_sample(df: DataFrame, n: int, keys: list[str], seed: int = 0, weight: Column | None = None) -> DataFrame:
    """n rows without replacement, reproducible from ``seed`` and the row keys; weighted by exponential order if asked.

    The smallest n of -log(u)/weight are kept by a top-n plan, never a full sort.
    """
    # 52 hash bits give u in (0, 1)
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[col(k) for k in keys]), 12).cast("double") + 0.5) / float(1 << 52)
    draw = -F.log(u) / (F.lit(1.0) if weight is None else weight)
    usable = df if weight is None else df.filter(weight > 0)
    return usable.withColumn("_draw", draw).orderBy("_draw", *[col(k) for k in keys]).limit(n).drop("_draw")


def sample_fraction(df: DataFrame, fraction: float, seed: int = 0, replace: bool = False) -> DataFrame:
    return df.sample(withReplacement=replace, fraction=fraction, seed=seed)


def drawn(seed: int, *parts: Column | str) -> Column:
    """A number between 0 and 1 from the digest of seed and parts: the same on every engine and for every partitioning."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def draw_fraction(df: DataFrame, fraction: float, keys: list[str], seed: int = 0) -> DataFrame:
    """Each row with probability ``fraction``, decided by its keys alone."""
    return df.filter(drawn(seed, *[col(k) for k in keys]) < fraction)


def draw_weighted_fraction(df: DataFrame, fraction: float, keys: list[str], weight: Column, seed: int = 0) -> DataFrame:
    """Exactly round(fraction * rows) rows without replacement, by weight; rows of no weight are never drawn.

    Rows are numbered along -log(u) / weight by the chunked scan, so no task sorts all of them and nothing is gathered.
    """
    marked = df.withColumn("_draw", F.when(weight > 0, -F.log(drawn(seed, *[col(k) for k in keys])) / weight)).filter("_draw IS NOT NULL")
    n = df.count()
    return position(settle(marked, "draws"), [], ["_draw", *keys], "_place").filter(col("_place") < F.round(F.lit(n) * fraction)).drop("_draw", "_place")


def draw_with_replacement(df: DataFrame, n: int, keys: list[str], seed: int = 0, weight: str | None = None) -> DataFrame:
    """Exactly ``n`` draws (column ``draw`` from 0) with replacement; with ``weight``, a column of whole numbers, in proportion to it.

    Draw number i falls on a point of the rows laid end to end along ``keys``, settled by the digest of seed and i. The points and
    the rows' ends meet in one chunked scan (the next row's end after a point), so a draw of any size is spread over all tasks.
    """
    size = F.lit(1).cast("long") if weight is None else F.coalesce(F.greatest(col(weight).cast("long"), F.lit(0)), F.lit(0).cast("long"))
    ends = settle(running(df.withColumn("_size", size), [], keys, {"_end": ("sum", col("_size"))}).filter("_size > 0"), "ends")
    whole = ends.agg(F.max("_end")).first()[0]
    if not whole:
        return ends.drop("_size", "_end").limit(0).withColumn("draw", F.lit(0).cast("long"))
    points = df.sparkSession.range(n).select(F.col("id").alias("draw"), F.floor(drawn(seed, F.col("id")) * whole).cast("long").alias("_at"))
    row = F.struct(*[col(c) for c in df.columns])
    # a row covers the points from its start up to the one before its end
    both = points.select("draw", "_at").unionByName(ends.select((col("_end") - 1).alias("_at"), row.alias("_row")), allowMissingColumns=True)
    both = both.withColumn("_kind", F.when(col("_row").isNull(), 0).otherwise(1))
    found = running(settle(both, "points"), [], ["_at", "_kind", "draw"], {"_hit": ("next", col("_row"))}).filter("_kind = 0")
    return found.select("draw", "_hit.*")
