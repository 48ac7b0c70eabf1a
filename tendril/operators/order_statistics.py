"""Quantiles over growing and over long sliding windows.

Rows are cut into blocks of positions. Within a block the window gains and loses at most two blocks of rows, so the quantile
wanted by any of its rows lies among few ranks of what all these windows share (their core: the rows before the block). Of the
core, a block gets only the values around those ranks, and one row with a count for each cell of values elsewhere:

* values fall into cells at even cut points; counts by (block of rows, cell) are summed over each block's core;
* cells that hold one of the ranks in question are asked for their values, distinct ones with their counts, cut by position to
  the core; of the others the count is enough, as no quantile can lie there.

A window of up to ``MOST_NEAR`` rows needs no core: blocks of its length, with the rows before them, hold all of it.

A task then holds a few blocks' rows, never a longer window. There the windows are ranges of one sequence (rows that leave, core, own
rows), and all their quantiles are found together, descending the bits of the values' ranks with prefix sums of counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .ordered import col, cut_points, equi_join, has_group, position, settle, with_number
from .scans import _group_number, key_array, starts, whole_keys

LEAST_BLOCK = 4096
MOST_CELLS = 16384
MOST_NEAR = 1 << 18
GRID_ROWS = 1 << 20


def kth_in_ranges(ranks: np.ndarray, counts: np.ndarray, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
    """For each query, the rank of the k-th smallest (from 0) of the sequence's elements low..high-1, each standing ``counts`` times."""
    low, high, k, found = low.copy(), high.copy(), k.copy(), np.zeros(len(k), np.int64)
    for bit in reversed(range(int(ranks.max(initial=0)).bit_length())):
        upper = (ranks >> bit & 1).astype(bool)
        places = np.concatenate([[0], np.cumsum(~upper)])
        weight = np.concatenate([[0], np.cumsum(np.where(upper, 0, counts))])
        below = weight[high] - weight[low]
        up = k >= below
        k -= np.where(up, below, 0)
        found |= up.astype(np.int64) << bit
        # stable split: lower halves first, each in the order it had
        low0, high0, n_low = places[low], places[high], places[-1]
        low, high = np.where(up, n_low + low - low0, low0), np.where(up, n_low + high - high0, high0)
        order = np.concatenate([np.flatnonzero(~upper), np.flatnonzero(upper)])
        ranks, counts = ranks[order], counts[order]
    return found


def _window_quantiles(table: pa.Table, block: int, window: int | None, shares: list[float]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(indexes of own rows, their quantiles per share, known values in each window) of rows sorted by block, kind and place."""
    kind, place, number = (table[c].to_numpy() for c in ("_kind", "_pos", "_block"))
    values, counts = table["_x"].to_numpy(zero_copy_only=False).astype(float), table["_count"].to_numpy()
    counts = np.where(np.isnan(values), 0, counts)
    known = np.unique(values[counts > 0])
    ranks = np.where(counts > 0, np.searchsorted(known, values), 0).astype(np.int64)
    first = starts(key_array(table, ["_group", "_block"]))
    own = np.flatnonzero(kind == 2)
    index = np.arange(len(kind))
    own_first = np.full(len(kind), -1)
    own_starts = own[np.flatnonzero(np.concatenate([[True], first[own][1:] != first[own][:-1]]))] if len(own) else own
    own_first[first[own_starts]] = own_starts
    own_first = own_first[first]
    low = first[own]
    if window:
        begin = place[own] - window + 1
        start = number[own] * block
        leaving = np.maximum(0, start - window + 1)
        low = np.where(begin >= start, own_first[own] + begin - start, low + np.maximum(0, begin - leaving))
    high = index[own] + 1
    total = np.concatenate([[0], np.cumsum(counts)])
    n = total[high] - total[low]
    out = []
    for share in shares:
        at = share * np.maximum(n - 1, 0)
        k = np.floor(at).astype(np.int64)
        both = kth_in_ranges(ranks, counts, np.tile(low, 2), np.tile(high, 2), np.concatenate([k, np.minimum(k + 1, np.maximum(n - 1, 0))]))
        # windows without values point nowhere; their results are masked
        picked = known[np.minimum(both, len(known) - 1)] if len(known) else np.full(len(both), np.nan)
        a, b = picked[:len(k)], picked[len(k):]
        # no difference of equal infinities, and no rounding where both are one value
        out.append(np.where(a == b, a, a + np.where(a == b, 0, b - a) * (at - k)))
    return own, out, n


def running_quantiles(df: DataFrame, by: list[str], order: list[str], column: str, outs: dict[str, float], window: int | None = None, min_periods: int = 1, block: int | None = None) -> DataFrame:
    """Add quantiles (name: share, linear between values) over all rows of the group so far, or over its last ``window`` rows.

    Null and NaN are no values; below ``min_periods`` values, and for null groups, the result is null. ``block`` sets the rows
    of a block; by default it follows the number of rows. It does not change the results.
    """
    x = col(column).cast("double")
    x = F.when(~F.isnan(x), x)
    shares = list(dict.fromkeys(outs.values()))
    placed = settle(position(df.filter(has_group(by)), by, order, "_pos").withColumns({"_x": x, "_group": _group_number(by)}), "positions")
    size = placed.agg(F.count(F.lit(1)).alias("n"), F.max("_pos").alias("last")).first()
    near = window is not None and window <= MOST_NEAR
    block = block or max(LEAST_BLOCK, window if near else 2 * math.isqrt(size["n"]))
    placed = placed.withColumn("_block", F.floor(col("_pos") / block))
    rows = placed.withColumns({"_kind": F.lit(2), "_count": F.lit(1).cast("long")})
    key = [*by, "_group"]
    # block b's core: the whole blocks from b - reach to b - 1 (all earlier ones for a growing window)
    reach = max(0, window // block - 1) if window else None
    ends = placed.groupBy(*[col(k) for k in key]).agg(F.max("_block").alias("_end"))
    if window:
        # rows before the core, in the windows of some rows of these blocks only
        first, last = col("_block") + reach + 1, F.floor((col("_pos") + window - 1) / block)
        leaving = placed.select(*[col(c) for c in [*key, "_pos", "_x"]], F.explode(F.when(last >= first, F.sequence(first, last))).alias("_block"))
        leaving = equi_join(leaving, ends, key).filter("_block <= _end").drop("_end")
        rows = rows.unionByName(leaving.withColumns({"_kind": F.lit(0), "_count": F.lit(1).cast("long")}), allowMissingColumns=True)
    if (size["last"] or 0) >= block and (reach is None or reach > 0):
        core = _cores(placed.filter("_x IS NOT NULL"), ends, key, block, reach, shares, size["n"])
        rows = rows.unionByName(core.withColumns({"_kind": F.lit(1), "_pos": F.lit(-1).cast("long")}), allowMissingColumns=True)
    names = [c for c in df.columns if c not in outs]
    kept = rows.select(*[col(c) for c in dict.fromkeys([*names, *by])], *[col(c) for c in ("_group", "_block", "_kind", "_pos", "_x", "_count") if c not in names])
    types = [to_arrow_type(kept.schema[c].dataType) for c in names]
    schema = ", ".join([*[f"`{c.replace('`', '``')}` {kept.schema[c].dataType.simpleString()}" for c in names], *[f"`{c.replace('`', '``')}` double" for c in outs]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, ["_group", "_block"]):
            own, found, n = _window_quantiles(table, block, window, shares)
            values = dict(zip(shares, found, strict=True))
            mine = table.select(names).take(pa.array(own))
            made = [pa.array(values[s], pa.float64(), mask=(n < max(min_periods, 1)) | (n == 0)) for s in outs.values()]
            yield from pa.table([*[mine[c].cast(t) for c, t in zip(names, types, strict=True)], *made], names=[*names, *outs]).to_batches(max_chunksize=1 << 14)
    parts = [col(k) for k in [*key, "_block"]]
    made = kept.repartition(*parts).sortWithinPartitions(*parts, "_kind", "_pos").mapInArrow(run, schema)
    made = made.select(*[col(c) for c in dict.fromkeys([*df.columns, *outs])])
    return made.unionByName(df.filter(~has_group(by)).drop(*outs), allowMissingColumns=True) if by else made


def _cores(known: DataFrame, ends: DataFrame, key: list[str], block: int, reach: int | None, shares: list[float], n: int) -> DataFrame:
    """(key, _block, _x, _count): of each block's core the values near its quantiles with their counts, elsewhere a count per cell."""
    points, _, _ = cut_points(known, "_x", max(8, min(MOST_CELLS, n // block)))
    known = with_number(known, "_cell", col("_x"), points).select(*[col(k) for k in key], "_block", "_cell", "_x")
    keys = [col(k) for k in key]
    # equal values of a block are one row from here on
    values = settle(known.groupBy(*keys, "_block", "_cell", "_x").agg(F.count(F.lit(1)).alias("_n")), "values")
    counts = values.groupBy(*keys, "_block", "_cell").agg(F.sum("_n").alias("_n"))
    cells = values.groupBy(*keys, "_cell").agg(F.min("_x").alias("_least"))
    # every block with every cell of its group: summaries, a block's worth of rows each; dealt by cell, as a group may be all there is
    parts = max(8, n // GRID_ROWS)
    grid = equi_join(cells, ends, key, "inner").repartition(parts, *keys, "_cell")
    grid = grid.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), col("_end")))).drop("_end")
    grid = equi_join(grid, counts.repartition(parts, *keys, "_cell"), [*key, "_block", "_cell"])
    before = Window.partitionBy(*keys, "_cell").orderBy("_block").rowsBetween(Window.unboundedPreceding if reach is None else -reach, -1)
    grid = grid.withColumn("_in", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    across = Window.partitionBy(*keys, "_block").orderBy("_cell")
    grid = grid.withColumn("_upto", F.sum("_in").over(across.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_total", F.sum("_in").over(Window.partitionBy(*keys, "_block")))
    # what a window may hold beside the core: own rows and rows that leave
    more = block if reach is None else 3 * block
    hit: Column = F.lit(False)
    for q in shares:
        hit = hit | ((col("_upto") > F.floor(q * (col("_total") - 1)) - more - 1) & (col("_upto") - col("_in") <= F.ceil(q * (col("_total") - 1)) + more + 2))
    grid = settle(grid.filter("_in > 0").select(*keys, "_block", "_cell", "_least", "_in", hit.alias("_hit")), "cells")
    apart = grid.filter("NOT _hit").select(*keys, "_block", col("_least").alias("_x"), col("_in").alias("_count"))
    asked = grid.filter("_hit").select(*keys, "_cell", col("_block").alias("_b"))
    if reach is None:
        found = equi_join(asked, values, [*key, "_cell"], "inner").filter("_block < _b")
    else:
        # two stretches as long as the reach hold every core, so that only values of its time meet a block
        asked = asked.withColumn("_stretch", F.explode(F.array_distinct(F.array(F.floor((col("_b") - reach) / reach), F.floor((col("_b") - 1) / reach)))))
        found = equi_join(asked, values.withColumn("_stretch", F.floor(col("_block") / reach)), [*key, "_cell", "_stretch"], "inner").filter(f"_block < _b AND _block >= _b - {reach}")
    near = found.groupBy(*keys, "_b", "_x").agg(F.sum("_n").alias("_count")).withColumnRenamed("_b", "_block")
    return near.unionByName(apart)
