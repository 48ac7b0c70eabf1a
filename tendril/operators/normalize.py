"""Flattened notices to the fixed extracted table, and that table to the typed merged one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from .ordered import col


def as_declared(values: Column, column: str) -> Column:
    """A list column stays a list; any other holds its values joined by a semicolon."""
    return values if S.is_list(column) else F.array_join(values, ";")


def with_fallback(value: Column, single: Column, range_: Column) -> Column:
    """The value itself, else the older single value, else the first of the older range."""
    return F.coalesce(value, single, F.slice(range_, 1, 1))


def to_eur(df: DataFrame, rates: DataFrame, value: str, currency: str, name: str = "VALUE_EUR") -> DataFrame:
    """Amount text in euro by a (currency, rate) table of units per euro.

    Euro amounts pass through unchanged; an unknown or missing currency or a bad number gives an empty string. The rate table has
    one row per currency and is broadcast whatever Catalyst knows of its size: rows dealt by currency would be a few tasks.
    """
    known = rates.select(F.col("currency").alias("_cur"), F.col("rate").alias("_rate"))
    joined = df.join(F.broadcast(known), col(currency) == F.col("_cur"), "left")
    converted = F.try_divide(col(value).try_cast("double"), F.col("_rate")).cast("string")
    text = F.when(col(currency) == "EUR", col(value)).otherwise(F.coalesce(converted, F.lit("")))
    return joined.withColumn(name, text).drop("_cur", "_rate")


def extracted(rows: DataFrame, rates: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The fixed columns, then the MAIN_ columns, from ``notice_columns`` output over ``schema.source_paths()``.

    With ``columns`` only these, from the output over ``schema.source_paths(columns)``.
    """
    if columns is not None:
        absent = [c for c in S.source_paths() if c not in rows.columns]
        table = extracted(rows.withColumns({c: F.lit(None).cast("array<string>") for c in absent}), rates if "VALUE_EUR" in columns else rates.limit(0))
        return table.select(*[col(c) for c in columns])
    values = {c: col(c) for c in S.COLUMNS if c not in S.DERIVED}
    single, range_ = S.OLD_SINGLE_VALUE, S.OLD_RANGE_VALUE
    values["VALUES__VALUE"] = with_fallback(col("VALUES__VALUE"), col(single), col(range_))
    older = F.coalesce(col(single + "__CURRENCY"), F.slice(col(range_ + "__CURRENCY"), 1, 1))
    values["VALUES__VALUE__CURRENCY"] = F.when(col("VALUES__VALUE").isNull(), older).otherwise(col("VALUES__VALUE__CURRENCY"))
    values["ORIGINAL_CPV_CODE"], values["ORIGINAL_CPV_TEXT"] = col("ORIGINAL_CPV__CODE"), col("ORIGINAL_CPV")
    flat = {c: as_declared(v, c) for c, v in values.items()}
    flat["DATE"], flat["YEAR"], flat["FILE"] = F.col("date"), F.substring("date", 1, 4), F.col("file")
    flat["REF_NO"] = F.coalesce(F.array_join("REF_NOTICE__NO_DOC_OJS", ";"), F.lit(""))
    table = rows.select(*[v.alias(c) for c, v in flat.items()])
    table = to_eur(table, rates, "VALUES__VALUE", "VALUES__VALUE__CURRENCY")
    return table.select(*[col(c) for c in S.COLUMNS], *[F.try_element_at(col(c), F.lit(1)).alias(n) for c, n in S.FIRST_NAMES.items()])


def fixed_projection(df: DataFrame, kind: T.StructType) -> DataFrame:
    """Exactly the columns of ``kind`` in order, null where the table lacks one."""
    have = set(df.columns)
    return df.select(*[(col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in kind])


def map_columns(df: DataFrame, mapping: list[tuple[str, str, str]]) -> DataFrame:
    """Rename and cast by (source, target, type); values that do not fit become null, other columns disappear.

    Sources the table lacks are skipped, so files with different columns can share one mapping.
    """
    have = set(df.columns)
    return df.select(*[F.try_to_date(col(s)).alias(t) if k == "date" and s in have else col(s).try_cast(k).alias(t) for s, t, k in mapping if s in have])


def by_type(value: Column, kinds: dict[str, str]) -> Column:
    """A column seen with several types as a struct with one field per type; a value fills the fields it fits."""
    return F.struct(*[value.try_cast(kind).alias(name) for name, kind in kinds.items()])


def stack(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def safe_names(df: DataFrame) -> DataFrame:
    """Lower-case names without colons."""
    return df.toDF(*[S.merged_name(c) for c in df.columns])


def merged(df: DataFrame) -> DataFrame:
    return map_columns(df, S.merged_mapping())
