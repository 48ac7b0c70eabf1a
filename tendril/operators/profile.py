"""Column profiles: value counts, null shares, buckets, common columns and redundant columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import col, equi_join, settle


def _is_empty(c: str) -> Column:
    return col(c).isNull()


def null_shares(df: DataFrame, by: list[str] = (), columns: list[str] | None = None) -> DataFrame:
    """Share of nulls per column (and group), long form: one aggregation over all columns, then unpivot."""
    columns = columns or [c for c in df.columns if c not in by]
    shares = [F.avg(_is_empty(c).cast("double")).alias(c) for c in columns]
    wide = df.groupBy(*[col(k) for k in by]).agg(*shares)
    return wide.unpivot([col(k) for k in by], [col(c) for c in columns], "column", "null_share")


def profile_bucket(share: Column) -> Column:
    """never, rarely (0, 0.25), sometimes (0.25, 0.5), usually (0.95, 1]; boundaries belong to no bucket."""
    return (
        F.when(share == 0, "never").when((share > 0) & (share < 0.25), "rarely")
        .when((share > 0.25) & (share < 0.5), "sometimes").when(share > 0.95, "usually")
    )


def useful_columns(profile: DataFrame, limit: float = 0.5) -> DataFrame:
    """Columns filled often enough in at least one group of a grouped profile."""
    return profile.filter(col("null_share") < limit).select("column").distinct()


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Remove columns without any value; one aggregated row decides."""
    counts = df.agg(*[F.count(col(c)).alias(c) for c in df.columns]).first().asDict()
    return df.select(*[col(c) for c in df.columns if counts[c]])


def column_presence(df: DataFrame, by: str, columns: list[str] | None = None) -> DataFrame:
    """(group, column) for each column that has a value in the group."""
    profile = null_shares(df, [by], columns)
    return profile.filter("null_share < 1").select(by, "column")


def common_columns(presence: DataFrame, by: str, groups: list[str]) -> DataFrame:
    """Columns present in every one of the groups."""
    hit = presence.filter(col(by).isin(groups)).groupBy("column").agg(F.count_distinct(col(by)).alias("n"))
    return hit.filter(col("n") == len(groups)).select("column")


def only_columns(presence: DataFrame, by: str, group: str) -> DataFrame:
    """Columns present in one group only."""
    found = presence.groupBy("column").agg(F.min(col(by)).alias("_least"), F.max(col(by)).alias("_most"))
    return found.filter((col("_least") == group) & (col("_most") == group)).select("column")


def small_value_shares(df: DataFrame, columns: list[str], below: int = 25) -> DataFrame:
    """Share of each value, for columns with fewer than ``below`` distinct values."""
    long = df.unpivot([], [col(c).cast("string").alias(c) for c in columns], "column", "value").filter("value is not null")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("column").agg(F.sum("n").alias("_total"), F.count(F.lit(1)).alias("_distinct"))
    kept = equi_join(counts, totals.filter(col("_distinct") < below), ["column"], "inner")
    return kept.select("column", "value", (col("n") / col("_total")).alias("share"))


def list_columns(df: DataFrame, paths: str = "paths") -> DataFrame:
    """Paths of a map column that ever hold more than one value."""
    entries = df.select(F.explode(col(paths)).alias("path", "items"))
    return entries.groupBy("path").agg(F.max(F.size("items")).alias("longest")).filter("longest > 1").select("path")


def _as_text(df: DataFrame, name: str):
    """Text that is equal for equal values only; null has one of its own."""
    plain = not isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))
    text = col(name).cast("string") if plain else F.to_json(F.struct(col(name).alias("v")))
    return F.when(col(name).isNotNull(), F.concat(F.lit("v"), text)).otherwise(F.lit("n"))


def redundant_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Ordered pairs of columns whose values map one to one (null counts as a value).

    Such columns split the rows into the same classes. A class gets a fingerprint from the hashes of its rows, a column from those
    of its classes: one long aggregation over all columns, then one over classes. Only columns with equal fingerprints are compared
    value by value, all of a set with its first; as they have equally many classes, one way determines the other.
    """
    low, high = (lambda h: h.bitwiseAND(F.lit(0x7FFFFFFF))), (lambda h: F.shiftrightunsigned(h, 33))
    row = F.xxhash64(*[col(c) for c in columns])
    cells = df.select(row.alias("_h"), F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), _as_text(df, c).alias("_v")) for i, c in enumerate(columns)])).alias("_x")).select("_h", "_x.*")
    classes = cells.groupBy("_c", "_v").agg(F.sum(low(col("_h"))).alias("_a"), F.sum(high(col("_h"))).alias("_b"), F.count(F.lit(1)).alias("_n"))
    mark = F.xxhash64("_a", "_b", "_n")
    prints = classes.groupBy("_c").agg(F.sum(low(mark)).alias("_a"), F.sum(high(mark)).alias("_b"), F.count(F.lit(1)).alias("_n")).collect()  # a row per column
    alike: dict[tuple, list[str]] = {}
    for r in sorted(prints):
        alike.setdefault(tuple(r)[1:], []).append(columns[r["_c"]])
    passes = []
    for first, *others in alike.values():
        if others:
            texts = {c: _as_text(df, c) for c in (first, *others)}
            spread = df.groupBy(texts[first].alias("_first")).agg(*[(F.min(texts[c]) == F.max(texts[c])).alias(f"_{i}") for i, c in enumerate(others)])
            wide = spread.agg(*[F.min(f"_{i}").alias(f"_{i}") for i in range(len(others))])
            passes.append(wide.select(F.array_compact(F.array(F.lit(first), *[F.when(F.col(f"_{i}"), c) for i, c in enumerate(others)])).alias("_set")))
    if not passes:
        return df.sparkSession.createDataFrame([], "a string, b string")
    sets = reduce(DataFrame.unionByName, passes)
    return sets.select(F.explode("_set").alias("a"), "_set").select("a", F.explode("_set").alias("b")).filter("a <> b")


def distinct_items(df: DataFrame, column: str) -> DataFrame:
    """Distinct scalars of an array column."""
    return df.select(F.explode(col(column)).alias("item")).distinct()


def columns_like(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part in c]


def select_types(df: DataFrame, *kinds: str) -> DataFrame:
    return df.select(*[col(f.name) for f in df.schema if f.dataType.typeName() in kinds])
