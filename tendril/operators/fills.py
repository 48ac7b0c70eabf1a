"""Missing-value fills along an order, and interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import asof_join
from .ordered import col, running, sort_image


def fill(
    df: DataFrame, by: list[str], order: list[str], columns: list[str], direction: str = "forward",
    limit: int | None = None,
) -> DataFrame:
    """Replace nulls by the last (forward) or next (backward) known value, at most ``limit`` rows away."""
    reverse = direction == "backward"
    if limit is None:
        aggs = {f"_f_{c}": ("last", col(c)) for c in columns}
        work = running(df, by, order, aggs, reverse)
        return work.select(*[col(f"_f_{c}").alias(c) if c in columns else col(c) for c in df.columns])
    kind = "next_at" if reverse else "last_at"
    work = running(df, by, order, {"_pos": ("position", None), **{f"_f_{c}": (kind, col(c)) for c in columns}})
    near = {c: F.when(F.abs(col("_pos") - col(f"_f_{c}")["p"]) <= limit, col(f"_f_{c}")["v"]) for c in columns}
    return work.select(*[near[c].alias(c) if c in columns else col(c) for c in df.columns])


def interpolate(df: DataFrame, by: list[str], order: list[str], column: str, method: str = "linear") -> DataFrame:
    """Fill nulls from the known neighbours.

    ``linear`` treats rows as evenly spaced, ``time`` uses the distance along the first order column, ``nearest`` takes
    the closer neighbour (the earlier one on a tie). After the last known value, linear and time repeat it; before the
    first one nothing is filled.
    """
    if method == "linear":
        aggs = {"_pos": ("position", None), "_prev": ("last_at", col(column)), "_next": ("next_at", col(column))}
        work = running(df, by, order, aggs)
    else:
        work = df.withColumn("_pos", sort_image(df, order[0]))
        known = F.when(col(column).isNotNull(), F.struct(col(column).alias("v"), col("_pos").alias("p")))
        work = running(work, by, order, {"_prev": ("last", known), "_next": ("next", known)})
    share = (col("_pos") - F.col("_prev.p")) / (F.col("_next.p") - F.col("_prev.p"))
    if method == "nearest":
        between = F.when(share <= 0.5, F.col("_prev.v")).otherwise(F.col("_next.v"))
        value = F.when(col("_prev").isNotNull() & col("_next").isNotNull(), between)
    else:
        between = F.col("_prev.v") + (F.col("_next.v") - F.col("_prev.v")) * share
        value = F.when(col("_next").isNull(), F.col("_prev.v")).when(col("_prev").isNotNull(), between)
    filled = F.coalesce(col(column), value)
    return work.select(*[filled.alias(c) if c == column else col(c) for c in df.columns])


def asof_lookup(df: DataFrame, where: DataFrame, on: str, subset: list[str], by: list[str] = ()) -> DataFrame:
    """Last row with no null in ``subset`` at or before each value of ``where``."""
    return asof_join(where, df.na.drop(subset=subset), on, by)
