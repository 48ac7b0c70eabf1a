"""Running and sliding results of a caller's own function over groups of any size.

The function is a merge of two summaries, written for whole arrays: ``merge(a, b)`` takes two dicts of numpy arrays (one entry
per state column), a's rows standing before b's, and returns the merged dict. It must be associative. Each row starts as a
summary of itself, given by columns that hold no nulls. Nothing else is asked for, so a growing window is never collected:

* ``scan`` merges within chunks of rows, scans one summary per chunk, and merges what is carried in with each row;
* ``slide`` cuts each group into stretches of the window's length: every window is the end of one stretch and the beginning of
  the next, so a running merge from both sides and one more merge give it, at a cost that does not depend on its length.

Rows of null groups get null states. Equal order values are taken in any one order; ``order`` should be total.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .ordered import CHUNK, col, equi_join, has_group, position, running, settle, with_chunk

Merge = Callable[[dict[str, np.ndarray], dict[str, np.ndarray]], dict[str, np.ndarray]]
BATCH = 1 << 17
LOCAL = 1 << 14


def _where(take: np.ndarray, a: dict, b: dict) -> dict:
    return {k: np.where(take, a[k], b[k]) for k in a}


def _at(state: dict, index) -> dict:
    return {k: v[index] for k, v in state.items()}


def segment_scan(state: dict, first: np.ndarray, merge: Merge, reverse: bool = False) -> dict:
    """Running merge within segments, by doubling: ``first`` is each row's segment start (the last row, if ``reverse``)."""
    n, step = len(first), 1
    place = np.arange(n)
    while step < n:
        reached = place + step <= first if reverse else place - step >= first
        if not reached.any():
            break
        other = _at(state, np.minimum(place + step, n - 1) if reverse else np.maximum(place - step, 0))
        state = _where(reached, merge(state, other) if reverse else merge(other, state), state)
        step *= 2
    return state


def starts(keys: np.ndarray) -> np.ndarray:
    """Index of the first row of each row's stretch of equal keys (rows of ``keys`` are compared whole)."""
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
    return np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))


def whole_keys(batches: Iterator[pa.RecordBatch], names: list[str], rows: int = BATCH) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows (but the last) that end where the columns ``names`` change."""
    held, n, limit = [], 0, rows
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= limit:
            table = pa.Table.from_batches(held)
            cut = starts(key_array(table, names))[-1]
            if cut:
                yield table.slice(0, cut)
                table = table.slice(cut)
            held, n = table.to_batches(), len(table)
            # a long stretch is not looked through again for every batch
            limit = max(rows, 2 * n)
    if n:
        yield pa.Table.from_batches(held)


def key_array(table: pa.Table, names: list[str]) -> np.ndarray:
    return np.stack([table[c].to_numpy() for c in names], axis=1)


def _state(table: pa.Table, names: list[str]) -> dict:
    return {c: table[c].to_numpy() for c in names}


def _group_number(by: list[str]) -> Column:
    return F.xxhash64(*[col(k) for k in by]) if by else F.lit(0).cast("long")


def _shape(df: DataFrame) -> tuple[str, list[pa.DataType], list[str]]:
    """Schema text, Arrow types and names of the columns."""
    fields = df.schema.fields
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields), [to_arrow_type(f.dataType) for f in fields], [f.name for f in fields]


def _local(df: DataFrame, by: list[str], part: list[str], ordered: list[Column], change: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """``change`` applied to tables that hold whole parts (by ``by`` and the long columns ``part``), rows sorted by ``ordered`` within.

    ``_group`` is a hash of ``by``. It only tells neighbours in the sort apart; rows are brought together by the columns themselves.
    """
    schema, types, names = _shape(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_keys(batches, ["_group", *part]):
            made = change(table)
            yield from pa.table([made[c].cast(t) for c, t in zip(names, types, strict=True)], names=names).to_batches(max_chunksize=1 << 14)
    keys = [col(k) for k in [*by, "_group", *part]]
    return df.repartition(*keys).sortWithinPartitions(*keys, *ordered).mapInArrow(run, schema)


def _replaced(table: pa.Table, state: dict) -> pa.Table:
    for c, v in state.items():
        table = table.set_column(table.column_names.index(c), c, pa.array(v, table.schema.field(c).type))
    return table


def _scanned(df: DataFrame, by: list[str], part: list[str], ordered: list[Column], names: list[str], merge: Merge) -> DataFrame:
    """The states ``names`` merged from the first row of each part on, rows sorted by ``ordered`` within.

    Tables of ``BATCH`` rows pass by, whatever the length of a part: the last row's state is carried into the next.
    """
    schema, types, columns = _shape(df)
    rows = BATCH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, carried = None, {}
        for table in _pieces(batches, rows):
            own = key_array(table, ["_group", *part])
            first = starts(own)
            state = segment_scan(_state(table, names), first, merge)
            if key is not None and (own[0] == key).all():
                n = int(np.searchsorted(first, 1))
                going_on = merge({c: np.repeat(v, n) for c, v in carried.items()}, _at(state, slice(0, n)))
                state = {c: np.concatenate([going_on[c], state[c][n:]]) for c in names}
            key, carried = own[-1], {c: v[-1:].copy() for c, v in state.items()}
            made = _replaced(table, state)
            yield from pa.table([made[c].cast(t) for c, t in zip(columns, types, strict=True)], names=columns).to_batches(max_chunksize=1 << 14)
    keys = [col(k) for k in [*by, "_group", *part]]
    return df.repartition(*keys).sortWithinPartitions(*keys, *ordered).mapInArrow(run, schema)


def _pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows, wherever they end."""
    held, n = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            n += len(batch)
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def scan(df: DataFrame, by: list[str], order: list[str], state: dict[str, Column], merge: Merge, reverse: bool = False) -> DataFrame:
    """Add the columns of ``state``, merged from the first row of the group to the current one (from the last, if ``reverse``)."""
    names = list(state)
    work = with_chunk(df.filter(has_group(by)).withColumns({**state, "_group": _group_number(by)}), order)

    # from the last row on: sorted the other way, and what was met before stands after
    along = [col(c).desc() if reverse else col(c).asc() for c in order]
    ahead = (lambda a, b: merge(b, a)) if reverse else merge
    # read for the summaries and for the rows: stored, so that what lies above runs once
    work = settle(_scanned(work, by, [CHUNK], along, names, ahead), "scanned")

    # one summary a chunk: the state of its last row (its first, if reverse)
    pick = F.min_by if reverse else F.max_by
    keys = [col(k) for k in [*by, "_group", CHUNK]]
    totals = work.groupBy(*keys).agg(pick(F.struct(*names), F.struct(*[col(c) for c in order])).alias("_s")).select(*keys, "_s.*")

    def carried(table: pa.Table) -> pa.Table:
        first = starts(key_array(table, ["_group"]))
        place = np.arange(len(first))
        if reverse:
            first = _ends(first)
        done = segment_scan(_state(table, names), first, merge, reverse)
        moved = _at(done, np.clip(place + (1 if reverse else -1), 0, len(first) - 1))
        return _replaced(table, moved).set_column(table.column_names.index("_any"), "_any", pa.array(place != first))
    carry = _local(totals.withColumn("_any", F.lit(False)), by, [], [col(CHUNK)], carried).filter("_any").drop("_group")
    carry = carry.withColumnsRenamed({c: f"_c_{c}" for c in names})
    out = _merged(equi_join(work, carry, [*by, CHUNK]), names, "_c_", merge, reverse).select(*[col(c) for c in [*df.columns, *names]])
    return _with_null_groups(df, by, out)


def _merged(joined: DataFrame, names: list[str], prefix: str, merge: Merge, after: bool = False) -> DataFrame:
    """The states ``names``, merged with those of the same names behind ``prefix`` where ``_any`` is not null; these go first, unless ``after``."""
    schema, types, columns = _shape(joined)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rows = np.flatnonzero(table["_any"].is_valid().to_numpy())
            if len(rows):
                own, other = _state(table, names), {c: table[prefix + c].to_numpy()[rows] for c in names}
                here = _at(own, rows)
                new = merge(here, other) if after else merge(other, here)
                full = {c: own[c].copy() for c in names}
                for c in names:
                    full[c][rows] = new[c]
                table = _replaced(table, full)
            yield from pa.table([table[c].cast(t) for c, t in zip(columns, types, strict=True)], names=columns).to_batches()
    return joined.mapInArrow(run, schema)


def _ends(first: np.ndarray) -> np.ndarray:
    """Last index of each row's segment, from the first ones."""
    n = len(first)
    new = np.append(np.flatnonzero(first == np.arange(n))[1:], n) - 1
    return np.repeat(new, np.diff(np.append(np.flatnonzero(first == np.arange(n)), n)))


def _with_null_groups(df: DataFrame, by: list[str], out: DataFrame) -> DataFrame:
    return out.unionByName(df.filter(~has_group(by)), allowMissingColumns=True) if by else out


def slide(df: DataFrame, by: list[str], order: list[str], window: int, state: dict[str, Column], merge: Merge) -> DataFrame:
    """Add the columns of ``state``, merged over the last ``window`` rows of the group (fewer at its beginning)."""
    names = list(state)
    placed = position(df.filter(has_group(by)), by, order, "_pos").withColumns({**state, "_group": _group_number(by)})
    if window > LOCAL:
        placed = settle(placed, "placed")
    made = _slide_near(placed, by, window, names, merge) if window <= LOCAL else _slide_far(placed, by, window, names, merge)
    return _with_null_groups(df, by, made.select(*[col(c) for c in [*df.columns, *names]]))


def _slide_near(placed: DataFrame, by: list[str], window: int, names: list[str], merge: Merge) -> DataFrame:
    size = max(LOCAL, 4 * window)
    block = F.floor(col("_pos") / size)
    # rows near a block's end are copied to the next one, before its own
    copies = F.when(col("_pos") % size > size - window, F.array(block, block + 1)).otherwise(F.array(block))
    work = placed.withColumn("_home", block).withColumn("_block", F.explode(copies))

    def sliding(table: pa.Table) -> pa.Table:
        place, own = table["_pos"].to_numpy(), _state(table, names)
        first = starts(key_array(table, ["_group", "_block"]))
        stretch = starts(np.stack([first, place // window], axis=1))
        prefix, suffix = segment_scan(own, stretch, merge), segment_scan(own, _ends(stretch), merge, True)
        index = np.arange(len(first))
        begin = np.maximum(index - window + 1, first)
        both = merge(_at(suffix, begin), prefix)
        return _replaced(table, _where(begin >= stretch, prefix, both))
    return _local(work, by, ["_block"], [col("_pos")], sliding).filter("_block = _home")


def _slide_far(placed: DataFrame, by: list[str], window: int, names: list[str], merge: Merge) -> DataFrame:
    columns = placed.columns
    keys = [*by, "_stretch"]
    work = placed.withColumn("_stretch", F.floor(col("_pos") / window))
    one = {f"_x_{c}": col(c) for c in names}
    renamed = lambda fn: lambda a, b: {f"_x_{k}": v for k, v in fn({k[3:]: v for k, v in a.items()}, {k[3:]: v for k, v in b.items()}).items()}
    prefix = scan(work, keys, ["_pos"], one, renamed(merge)).select(*[col(c) for c in columns if c not in names], *[col(f"_x_{c}").alias(c) for c in names])
    narrow = work.select(*[col(k) for k in keys], "_pos", *names)
    suffix = scan(narrow, keys, ["_pos"], one, renamed(merge), True)
    # the window of row p begins at p - window + 1; rows at the end of a stretch need their own stretch only
    suffix = suffix.filter(col("_pos") % window != 0).select(*[col(k) for k in by], (col("_pos") + window - 1).alias("_pos"), *[col(f"_x_{c}").alias(f"_c_{c}") for c in names], F.lit(True).alias("_any"))
    # in a group's first stretch windows begin at its first row
    return _merged(equi_join(prefix, suffix, [*by, "_pos"]), names, "_c_", merge).select(*[col(c) for c in columns])


def slide_time(points: DataFrame, by: list[str], at: str, length: int, end: int, names: list[str], empty: dict, merge: Merge) -> DataFrame:
    """The states ``names`` of ``points`` (one row per group and value of the long column ``at``) merged over ``length`` units of it.

    The window of a row at t ends at t + ``end`` (0, or -1 to leave the row out). Time is cut into stretches as long as a window:
    a window is the end of one and the beginning of the next, so however many rows it holds, two running merges and two lookups of
    nearest rows give it. ``empty`` is the state of a window without rows.
    """
    names, columns = list(names), points.columns
    stretch = lambda t: ((t - F.pmod(t, F.lit(length))) / length).cast("long")
    led = lambda p: lambda a, b: {p + k: v for k, v in merge({k[len(p):]: v for k, v in a.items()}, {k[len(p):]: v for k, v in b.items()}).items()}
    keys = [*by, "_stretch"]
    work = settle(points.filter(has_group(by)).withColumn("_stretch", stretch(col(at))), "points")
    for p, reverse in (("_p_", False), ("_s_", True)):
        work = settle(scan(work, keys, [at], {p + c: col(c) for c in names}, led(p), reverse), "points")
    # the beginning of the window's last stretch, up to the window's end
    mine = F.struct(col("_stretch").alias("stretch"), *[col(f"_p_{c}").alias(c) for c in names])
    if end:
        work = settle(running(work, by, [at], {"_before": ("before_at", mine)}), "points")
        mine = F.when(F.col("_before.v.stretch") == stretch(col(at) + end), F.col("_before.v"))
    work = work.withColumn("_head", mine)
    # the end of the stretch before, from the window's first row on
    first = col(at) + end - length + 1
    asked = work.select(*[col(k) for k in by], first.alias("_t"), F.lit(0).alias("_kind"), col(at).alias("_own"), F.lit(None).cast(work.select(mine.alias("x")).schema["x"].dataType).alias("_tail"))
    data = work.select(*[col(k) for k in by], col(at).alias("_t"), F.lit(1).alias("_kind"), col(at).alias("_own"), F.struct(col("_stretch").alias("stretch"), *[col(f"_s_{c}").alias(c) for c in names]).alias("_tail"))
    found = running(settle(asked.unionByName(data), "asked"), by, ["_t", "_kind", "_own"], {"_next": ("next", col("_tail"))}).filter("_kind = 0")
    fits = (F.col("_next.stretch") == stretch(col("_t"))) & (stretch(col("_t")) < stretch(col("_own") + end))
    found = found.filter(fits).select(*[col(k) for k in by], col("_own").alias(at), *[col("_next")[c].alias(f"_c_{c}") for c in names], F.lit(True).alias("_any"))
    headed = work.select(*[col(c) for c in columns if c not in names], *[F.coalesce(col("_head")[c], F.lit(empty[c])).alias(c) for c in names])
    return _merged(equi_join(headed, found, [*by, at]), names, "_c_", merge).select(*[col(c) for c in columns])


def moments(a: dict, b: dict) -> dict:
    """Merge of counts, sums, means, sums of squared deviations, and ends of two sets of values."""
    n = a["_n"] + b["_n"]
    share = np.divide(b["_n"], n, out=np.zeros_like(n), where=n > 0)
    d = b["_mean"] - a["_mean"]
    return {"_n": n, "_sum": a["_sum"] + b["_sum"], "_mean": a["_mean"] + d * share, "_dev": a["_dev"] + b["_dev"] + d * d * a["_n"] * share,
            "_least": np.minimum(a["_least"], b["_least"]), "_most": np.maximum(a["_most"], b["_most"])}


EMPTY = {"_n": 0.0, "_sum": 0.0, "_mean": 0.0, "_dev": 0.0, "_least": float("inf"), "_most": float("-inf")}
MOMENTS = {
    "count": lambda: col("_n").cast("long"), "sum": lambda: col("_sum"), "mean": lambda: col("_mean"), "min": lambda: col("_least"), "max": lambda: col("_most"),
    "var": lambda: F.when(col("_n") > 1, col("_dev") / (col("_n") - 1)), "std": lambda: F.sqrt(F.when(col("_n") > 1, col("_dev") / (col("_n") - 1)))}


def _co_moments(a: dict, b: dict) -> dict:
    """Merge of counts, means and sums of products of deviations of two sets of pairs."""
    n = a["_n"] + b["_n"]
    share = np.divide(b["_n"], n, out=np.zeros_like(n), where=n > 0)
    dx, dy = b["_mx"] - a["_mx"], b["_my"] - a["_my"]
    weight = a["_n"] * share
    return {"_n": n, "_mx": a["_mx"] + dx * share, "_my": a["_my"] + dy * share,
            "_xx": a["_xx"] + b["_xx"] + dx * dx * weight, "_yy": a["_yy"] + b["_yy"] + dy * dy * weight, "_xy": a["_xy"] + b["_xy"] + dx * dy * weight}


def running_pairs(df: DataFrame, by: list[str], order: list[str], x: str, y: str, outs: dict[str, str], min_periods: int = 2, window: int | None = None) -> DataFrame:
    """Sample covariance (``cov``) and correlation (``corr``) of two columns over all rows so far, or the last ``window``.

    Rows where either is null do not count. Co-moments about the means of what they cover are merged pairwise, so an offset that
    is large against the spread costs no digits.
    """
    both = col(x).isNotNull() & col(y).isNotNull()
    zero = F.lit(0.0)
    state = {"_n": F.when(both, 1.0).otherwise(zero), "_mx": F.when(both, col(x).cast("double")).otherwise(zero),
             "_my": F.when(both, col(y).cast("double")).otherwise(zero), "_xx": zero, "_yy": zero, "_xy": zero}
    made = scan(df, by, order, state, _co_moments) if window is None else slide(df, by, order, window, state, _co_moments)
    values = {"cov": F.when(col("_n") > 1, col("_xy") / (col("_n") - 1)), "corr": F.when((col("_n") > 1) & (col("_xx") > 0) & (col("_yy") > 0), col("_xy") / F.sqrt(col("_xx") * col("_yy")))}
    return made.withColumns({name: F.when(col("_n") >= min_periods, values[fn]) for name, fn in outs.items()}).select(*[col(c) for c in dict.fromkeys([*df.columns, *outs])])
