"""Ranks, cumulative values, shifts and order statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import BLOCK, col, drop_halo, equi_join, halo_blocks, position, running, settle


def rank(
    df: DataFrame, by: list[str], column: str, name: str = "rank", method: str = "average", ascending: bool = True,
    pct: bool = False, nulls: str = "keep", tie: list[str] = (),
) -> DataFrame:
    """Rank of ``column`` within the group: average, min, max, dense or first (``tie`` gives the order of appearance).

    ``nulls``: keep (null rank), top (before all others) or bottom.
    """
    if method == "first":
        return _rank_first(df, by, column, name, ascending, pct, nulls, tie)
    return rank_by_methods(df, by, column, {name: method}, ascending, pct, nulls)


def rank_by_methods(
    df: DataFrame, by: list[str], column: str, methods: dict[str, str], ascending: bool = True, pct: bool = False, nulls: str = "keep"
) -> DataFrame:
    """Several rank methods (name -> average, min, max or dense) from one scan.

    Equal values are counted before anything is ordered, so a value repeated a billion times is one row of the scan.
    """
    keys = [*by, column]
    known = df if nulls != "keep" else df.filter(col(column).isNotNull())
    counts = known.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    counts = settle(counts.withColumn("_class", _null_class(column, nulls, ascending)), "rank")
    aggs = {"_upto": ("sum", col("_n")), "_dense": ("count", F.lit(1))}
    scanned = running(counts, by, [column] if nulls == "keep" else ["_class", column], aggs, reverse=not ascending)
    low, high = col("_upto") - col("_n") + 1, col("_upto")
    value = {"average": (low + high) / 2, "min": low, "max": high, "dense": col("_dense")}
    table = scanned.select(*[col(k) for k in keys], *[value[m].alias(n) for n, m in methods.items()])
    if pct:
        # dense pct divides by the number of distinct values, the others by the number of rows
        sizes = counts.groupBy(*[col(k) for k in by]).agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_values"))
        table = equi_join(table, sizes, by) if by else table.join(F.broadcast(sizes))  # one row without groups
        shares = {n: col(n) / (col("_values") if m == "dense" else col("_rows")) for n, m in methods.items()}
        table = table.withColumns(shares).drop("_rows", "_values")
    if nulls == "keep":
        return equi_join(df, table, keys)
    return equi_join(df, table, keys, null_safe=True)


def _null_class(column: str, nulls: str, ascending: bool):
    lowest = (nulls == "top") == ascending
    return F.when(col(column).isNull(), 0 if lowest else 2).otherwise(1)


def _rank_first(df, by, column, name, ascending, pct, nulls, tie):
    work = df.withColumn("_class", _null_class(column, "bottom" if nulls == "keep" else nulls, ascending))
    if not ascending:
        # the scan runs backwards over values while ties still count from their first row
        counts = rank(df, by, column, "_min", "min", False, nulls=nulls)
        # a struct is never null itself, so rows without a value are a group of ties too
        inside = position(counts.withColumn("_v", F.struct(col(column))), [*by, "_v"], list(tie), "_in")
        out = inside.withColumn(name, col("_min") + col("_in")).drop("_min", "_in", "_v")
    else:
        out = position(work, by, ["_class", column, *tie], name).withColumn(name, col(name) + 1).drop("_class")
        if nulls == "keep":
            out = out.withColumn(name, F.when(col(column).isNotNull(), col(name)))
    if pct:
        sizes = df.groupBy(*[col(k) for k in by]).agg(F.count(col(column)).alias("_size"))
        out = equi_join(out, sizes, by) if by else out.join(F.broadcast(sizes))
        out = out.withColumn(name, col(name) / col("_size")).drop("_size")
    return out


def cumulative(df: DataFrame, by: list[str], order: list[str], **outs: tuple[str, str]) -> DataFrame:
    """Running sum, product, min, max or count; nulls are skipped and stay null in the result."""
    aggs = {name: (kind, col(c)) for name, (kind, c) in outs.items()}
    work = running(df, by, order, aggs)
    return work.withColumns({n: F.when(col(c).isNotNull(), col(n)) for n, (_, c) in outs.items()})


def group_number(df: DataFrame, by: list[str], name: str = "ngroup") -> DataFrame:
    """Number of the row's group in the sorted order of group keys, from 0."""
    keys = df.select(*[col(k) for k in by]).na.drop().distinct()
    keys = settle(keys, "keys")
    return equi_join(df, position(keys, [], by, name), by)


def first_seen_codes(df: DataFrame, column: str, order: str, name: str = "code") -> DataFrame:
    """Integer code per distinct value in order of first appearance; null gets -1."""
    seen = df.filter(col(column).isNotNull()).groupBy(col(column)).agg(F.min(col(order)).alias("_first"))
    codes = position(settle(seen, "seen"), [], ["_first"], name).drop("_first")
    return equi_join(df, codes, [column]).withColumn(name, F.coalesce(col(name), F.lit(-1)))


def shift(df: DataFrame, by: list[str], order: list[str], outs: dict[str, tuple[str, int]]) -> DataFrame:
    """Value ``periods`` rows earlier (later, if negative) within the group: ``outs`` maps name to (column, periods)."""
    before = max([p for _, p in outs.values() if p > 0], default=0)
    after = max([-p for _, p in outs.values() if p < 0], default=0)
    work = halo_blocks(position(df, by, order), col("_pos"), max(4096, 4 * (before + after)), before, after)
    w = Window.partitionBy(*[col(k) for k in by], BLOCK).orderBy("_pos")
    shifted = {n: F.lag(col(c), p).over(w) if p >= 0 else F.lead(col(c), -p).over(w) for n, (c, p) in outs.items()}
    return drop_halo(work, df.columns, shifted)


def order_statistics(df: DataFrame, by: list[str], column: str, shares: list[float]) -> DataFrame:
    """Exact values at rank floor and ceil of ``share * (n - 1)``: one row per group and share.

    Columns: share, n, lo, hi and frac. Repeated values are pre-counted and ranks come from a chunked scan, so no task
    holds a whole group (the built-in exact percentile keeps every distinct value of a group in one buffer).
    """
    counts = df.filter(col(column).isNotNull()).groupBy(*[col(k) for k in by], col(column))
    counts = settle(counts.agg(F.count(F.lit(1)).alias("_n")), "counts")
    sizes = counts.groupBy(*[col(k) for k in by]).agg(F.sum("_n").alias("n"))
    scanned = running(counts, by, [column], {"_upto": ("sum", col("_n"))})
    sized = equi_join(scanned, sizes, by) if by else scanned.join(F.broadcast(sizes))
    wanted = F.transform(
        F.array(*[F.lit(float(s)) for s in shares]),
        lambda s: F.struct(s.alias("share"), F.floor(s * (col("n") - 1)).alias("a"), F.ceil(s * (col("n") - 1)).alias("b"),
                           (s * (col("n") - 1) - F.floor(s * (col("n") - 1))).alias("frac")),
    )
    start = col("_upto") - col("_n")
    holds = lambda r: (r >= start) & (r < col("_upto"))
    hits = F.filter(wanted, lambda s: holds(s["a"]) | holds(s["b"]))
    rows = sized.select("*", F.explode(hits).alias("_s"))
    return rows.groupBy(*[col(k) for k in by], F.col("_s.share").alias("share")).agg(
        F.max("n").alias("n"),
        F.max(F.when(holds(F.col("_s.a")), col(column))).alias("lo"),
        F.max(F.when(holds(F.col("_s.b")), col(column))).alias("hi"),
        F.max("_s.frac").alias("frac"),
    )


def quantiles(df: DataFrame, by: list[str], column: str, shares: list[float], interpolation: str = "linear") -> DataFrame:
    """Exact quantiles, long form (group, share, quantile); linear, lower, higher, midpoint or nearest."""
    stats = order_statistics(df, by, column, shares)
    value = {
        "linear": col("lo") + (col("hi") - col("lo")) * col("frac"),
        "lower": col("lo"),
        "higher": col("hi"),
        "midpoint": (col("lo") + col("hi")) / 2,
        # a half-way rank goes to the even neighbour
        "nearest": F.when(F.bround(col("share") * (col("n") - 1), 0) == F.floor(col("share") * (col("n") - 1)), col("lo"))
        .otherwise(col("hi")),
    }[interpolation]
    return stats.select(*[col(k) for k in by], "share", value.alias("quantile"))
