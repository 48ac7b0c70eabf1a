"""Join and combine operators with the table library's null, suffix and ordering rules."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import col, equi_join, running, sort_image


def _same(left: list[str], right: list[str], null_safe: bool) -> Column:
    pairs = [
        col(f"_k{i}").eqNullSafe(col(f"_j{i}")) if null_safe else col(f"_k{i}") == col(f"_j{i}")
        for i in range(len(left))
    ]
    return reduce(lambda a, b: a & b, pairs)


def merge(
    left: DataFrame, right: DataFrame, on: list[str] | None = None, how: str = "inner",
    left_on: list[str] | None = None, right_on: list[str] | None = None, suffixes: tuple[str, str] = ("_x", "_y"),
    indicator: str | None = None, null_keys_match: bool = True,
) -> DataFrame:
    """Equi-join in which null keys match each other and equally named value columns get suffixes.

    With ``on`` the key appears once; with ``left_on``/``right_on`` both sides' keys are kept. ``indicator`` names a
    column telling where a row came from.
    """
    lk, rk = (on, on) if on else (left_on, right_on)
    shared = set(on or ())
    clash = (set(left.columns) & set(right.columns)) - shared
    lcols = {c: c + suffixes[0] if c in clash else c for c in left.columns}
    rcols = {c: c + suffixes[1] if c in clash else c for c in right.columns if c not in shared}
    a = left.select(*[col(k).alias(f"_k{i}") for i, k in enumerate(lk)], *[col(c).alias(f"_a{i}") for i, c in enumerate(lcols)],
                    F.lit(1).alias("_in_left"))
    b = right.select(*[col(k).alias(f"_j{i}") for i, k in enumerate(rk)], *[col(c).alias(f"_b{i}") for i, c in enumerate(rcols)],
                     F.lit(1).alias("_in_right"))
    joined = a.join(b, _same(lk, rk, null_keys_match), how)
    out = []
    for i, (c, name) in enumerate(lcols.items()):
        value = col(f"_a{i}")
        if c in shared:
            k = lk.index(c)
            value = F.when(col("_in_left").isNull(), col(f"_j{k}")).otherwise(col(f"_k{k}"))
        out.append(value.alias(name))
    out += [col(f"_b{i}").alias(name) for i, name in enumerate(rcols.values())]
    if indicator:
        out.append(
            F.when(col("_in_left").isNull(), "right_only").when(col("_in_right").isNull(), "left_only")
            .otherwise("both").alias(indicator)
        )
    return joined.select(*out)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def checked_merge(left: DataFrame, right: DataFrame, on: list[str], validate: str, **kw) -> DataFrame:
    """Merge after checking the declared cardinality: 1:1, 1:m or m:1 (m:m needs no check)."""
    l_one, r_one = (part == "1" for part in validate.split(":"))
    for one, side, name in ((l_one, left, "left"), (r_one, right, "right")):
        if one and not repeated_keys(side, on).isEmpty():
            raise ValueError(f"merge keys are not unique in the {name} table; not a {validate} merge")
    return merge(left, right, on, **kw)


def asof_join(
    left: DataFrame, right: DataFrame, on: str, by: list[str] = (), direction: str = "backward",
    tolerance: float | timedelta | None = None, exact: bool = True, tie: str | None = None,
) -> DataFrame:
    """Give each left row the right row with the closest ``on`` value in the given direction.

    Both tables are stacked and the last right row seen is carried along the order, so the work is one sort whatever
    the density of either side. ``tie`` orders right rows that share an ``on`` value; the largest wins.
    Right columns keep their names (``on`` of the right row becomes ``<on>_right``).
    """
    by = list(by)
    values = [c for c in right.columns if c not in (on, *by)]
    tie_type = right.schema[tie].dataType if tie else "int"
    payload = F.struct(col(on).alias("_at"), *[col(c) for c in values])
    right = right.filter(col(on).isNotNull())

    def stacked(left_rank: int, right_rank: int) -> DataFrame:
        a = left.select(
            *[col(k) for k in by], col(on).alias("_on"), F.lit(left_rank).alias("_side"),
            F.lit(None).cast(tie_type).alias("_tie"), F.struct(*[col(c) for c in left.columns]).alias("_l"),
        )
        b = right.select(
            *[col(k) for k in by], col(on).alias("_on"), F.lit(right_rank).alias("_side"),
            (col(tie) if tie else F.lit(None).cast(tie_type)).alias("_tie"), payload.alias("_r"),
        )
        return a.unionByName(b, allowMissingColumns=True)

    def matched(df: DataFrame, forward: bool, name: str) -> DataFrame:
        return running(df, by, ["_on", "_side", "_tie"], {name: ("last", col("_r"))}, reverse=forward)

    if direction == "backward":
        hits = matched(stacked(1, 0) if exact else stacked(0, 1), False, "_m").filter("_l is not null")
    elif direction == "forward":
        hits = matched(stacked(0, 1) if exact else stacked(1, 0), True, "_m").filter("_l is not null")
    elif direction == "nearest":
        # side 1 sits between right copies at 0 and 2, so both scans can see, or both skip, equal values
        both = stacked(1, 0).unionByName(stacked(1, 2).filter("_r is not null"), allowMissingColumns=True)
        low, high = (0, 2) if exact else (2, 0)
        seen = {
            "_b": ("last", F.when(col("_side") == low, col("_r"))),
            "_f": ("next", F.when(col("_side") == high, col("_r"))),
        }
        hits = running(both, by, ["_on", "_side", "_tie"], seen).filter("_l is not null")
        images = hits.select("_on", *[F.col(f"{m}._at").alias(m + "_at") for m in ("_b", "_f")])
        gap = {m: F.abs(_image(images, "_on", col("_on")) - _image(images, m + "_at", F.col(m + "._at"))) for m in ("_b", "_f")}
        nearer = F.when(col("_b").isNull() | (gap["_f"] < gap["_b"]), col("_f")).otherwise(col("_b"))
        hits = hits.withColumn("_m", nearer)
    else:
        raise ValueError(direction)
    if tolerance is not None:
        limit = tolerance // timedelta(microseconds=1) if isinstance(tolerance, timedelta) else tolerance
        probe = hits.select("_on", F.col("_m._at").alias("_at"))
        gap = F.abs(_image(probe, "_on", col("_on")) - _image(probe, "_at", F.col("_m._at")))
        hits = hits.withColumn("_m", F.when(gap <= limit, col("_m")))
    return hits.select("_l.*", F.col("_m._at").alias(f"{on}_right"), *[col("_m").getField(c).alias(c) for c in values])


def _image(df: DataFrame, name: str, value: Column) -> Column:
    """Numeric image of ``value``, typed as column ``name`` of ``df``."""
    probe = sort_image(df, name)
    if probe is None:
        raise TypeError(f"{name} has no numeric distance")
    kind = df.schema[name].dataType.typeName()
    if kind.startswith("timestamp"):
        return F.unix_micros(value.cast("timestamp"))
    return F.unix_date(value) if kind == "date" else value


def ordered_merge(left: DataFrame, right: DataFrame, on: str, fill: bool = True, suffixes=("_x", "_y"), left_by: list[str] = ()) -> DataFrame:
    """Full outer merge on an ordered key with value columns filled forward along it.

    With ``left_by`` each of the left table's groups is merged with the whole right table: the right keys are completed with the
    groups present (the result holds each of these pairs), and fills stay within a group. Null groups count as one.
    """
    by = list(left_by)
    if by:
        groups = left.select(*[col(k) for k in by]).distinct()
        # every row made here is a row of the result
        right = groups.join(right.withColumnsRenamed({k: f"{k}{suffixes[1]}" for k in by if k in right.columns}), F.lit(True))
    out = merge(left, right, [*by, on], "outer", suffixes=suffixes)
    if not fill:
        return out
    values = [c for c in out.columns if c != on and c not in by]
    # null groups are filled like any other: the ordered scan sees the group as never null
    marks = [F.struct(col(k)).alias(f"_g_{k}") for k in by]
    filled = running(out.select("*", *marks), [f"_g_{k}" for k in by], [on], {f"_f_{c}": ("last", col(c)) for c in values})
    return filled.select(*[col(k) for k in by], on, *[col(f"_f_{c}").alias(c) for c in values])


def concat_keyed(parts: dict[str, DataFrame], key: str = "source", inner: bool = False) -> DataFrame:
    """Stack tables by column name with a column naming the input; ``inner`` keeps only the columns all share."""
    common = set.intersection(*[set(p.columns) for p in parts.values()]) if inner else None
    tagged = [
        (df.select(*[c for c in df.columns if c in common]) if inner else df).withColumn(key, F.lit(name))
        for name, df in parts.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def concat_columns(left: DataFrame, right: DataFrame, key: list[str], how: str = "outer") -> DataFrame:
    """Put two tables side by side, aligned on a key."""
    return merge(left, right, key, how)


def combine(left: DataFrame, right: DataFrame, key: list[str], func) -> DataFrame:
    """Cell-wise ``func(left_column, right_column)`` over the shared columns of two tables aligned on ``key``.

    A column only one side has is passed as null on the other.
    """
    names = [c for c in left.columns if c not in key] + [c for c in right.columns if c not in key and c not in left.columns]
    a = left.withColumnsRenamed({c: f"_a_{c}" for c in left.columns if c not in key})
    b = right.withColumnsRenamed({c: f"_b_{c}" for c in right.columns if c not in key})
    both = merge(a, b, key, "outer")
    kinds = {**{f.name: f.dataType for f in right.schema}, **{f.name: f.dataType for f in left.schema}}

    def side(prefix: str, c: str) -> Column:
        return col(prefix + c) if prefix + c in both.columns else F.lit(None).cast(kinds[c])

    return both.select(*[col(k) for k in key], *[func(side("_a_", c), side("_b_", c)).alias(c) for c in names])


def combine_first(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Left values where present, else the right table's value at the same key."""
    return combine(left, right, key, F.coalesce)


def update(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Overwrite left values by the right table's non-null ones; keys and columns of left only. Right keys are unique."""
    shared = [c for c in left.columns if c in right.columns and c not in key]
    fresh = right.select(*[col(k) for k in key], *[col(c).alias(f"_new_{c}") for c in shared])
    joined = equi_join(left, fresh, key)
    return joined.select(*[F.coalesce(col(f"_new_{c}"), col(c)).alias(c) if c in shared else col(c) for c in left.columns])
