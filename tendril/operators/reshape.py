"""Pivots, long/wide conversions, binning and indicator columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import repeated_keys
from .ordered import col, equi_join
from .ranks import quantiles

ALL = "All"


def cells(df: DataFrame, index: list[str], column: str, aggs: dict[str, Column]) -> DataFrame:
    """The cells of a pivot in long form, (index, column, aggregates): for values that the caller does not know."""
    return df.filter(col(column).isNotNull()).groupBy(*[col(k) for k in index], col(column)).agg(*[a.alias(n) for n, a in aggs.items()])


def pivot_table(
    df: DataFrame, index: list[str], column: str, aggs: dict[str, Column], values: list, fill_value=None, margins: bool = False,
) -> DataFrame:
    """Wide table of aggregates with a column per member of ``values``, the values of ``column`` (part of the output schema, so
    the caller names them; ``cells`` gives the long form without); ``margins`` adds an ``All`` row and column computed from the rows, not from the cells.

    Cells and margins come from one aggregation; the pivot then only moves finished values.
    """
    names = list(aggs)
    known = df.filter(col(column).isNotNull())
    if not margins:
        # cells are aggregated first, so the pivot sees one row per cell
        long = known.groupBy(*[col(k) for k in index], col(column).cast("string").alias("_c")).agg(*[a.alias(n) for n, a in aggs.items()])
        values = [str(v) for v in values]
    else:
        tagged = known.select("*", F.explode(F.array(col(column).cast("string"), F.lit(ALL))).alias("_c"))
        tagged = tagged.withColumn("_all", F.explode(F.array(F.lit(False), F.lit(True))))
        keys = [F.when(col("_all"), F.lit(ALL)).otherwise(col(k).cast("string")).alias(k) for k in index]
        long = tagged.select(*keys, "_c", *[c for c in df.columns if c not in index])
        long = long.groupBy(*[col(k) for k in index], "_c").agg(*[a.alias(n) for n, a in aggs.items()])
        values = [*map(str, values), ALL]
    wide = long.groupBy(*[col(k) for k in index]).pivot("_c", values).agg(*[F.first(n, True).alias(n) for n in names])
    if fill_value is not None:
        wide = wide.na.fill(fill_value, [c for c in wide.columns if c not in index])
    return wide


def pivot(df: DataFrame, index: list[str], column: str, value: str, values: list) -> DataFrame:
    """Long to wide without aggregation; a repeated (index, column) pair is an error."""
    if not repeated_keys(df, [*index, column]).isEmpty():
        raise ValueError("index contains duplicate entries, cannot reshape")
    return df.groupBy(*[col(k) for k in index]).pivot(column, values).agg(F.first(col(value)))


def crosstab(df: DataFrame, row: str, column: str, values: list, normalize: str | None = None, margins: bool = False) -> DataFrame:
    """Frequency table; ``normalize`` divides by the row (index), column or table (all) total."""
    counts = df.groupBy(col(row), col(column)).agg(F.count(F.lit(1)).alias("_n"))  # margins add up cells, not rows
    wide = pivot_table(counts, [row], column, {"n": F.sum("_n")}, values, fill_value=0, margins=margins)
    counted = [c for c in wide.columns if c != row]
    inner = [c for c in counted if c != ALL]
    if normalize is None:
        return wide
    if normalize == "index":
        total = sum((col(c) for c in inner), F.lit(0))
        return wide.select(row, *[(col(c) / total).alias(c) for c in counted])
    sums = wide.filter(col(row) != ALL) if margins else wide
    totals = sums.agg(*[F.sum(col(c)).alias(f"_t_{c}") for c in inner])
    both = wide.join(F.broadcast(totals))  # one row
    whole = sum((col(f"_t_{c}") for c in inner), F.lit(0))
    divisor = lambda c: whole if normalize == "all" or c == ALL else col(f"_t_{c}")
    return both.select(row, *[(col(c) / divisor(c)).alias(c) for c in counted])


def wide_to_long(df: DataFrame, stubs: list[str], i: list[str], j: str, sep: str = "_", suffix: list | None = None) -> DataFrame:
    """Columns named stub+sep+suffix become rows with the suffix in column ``j``."""
    found = suffix or sorted({c[len(s) + len(sep) :] for c in df.columns for s in stubs if c.startswith(s + sep)})
    missing = lambda s: df.schema[next(c for c in df.columns if c.startswith(s + sep))].dataType
    cell = lambda s, x: col(f"{s}{sep}{x}") if f"{s}{sep}{x}" in df.columns else F.lit(None).cast(missing(s))
    rows = F.array(*[F.struct(F.lit(x).alias(j), *[cell(s, x).alias(s) for s in stubs]) for x in found])
    fixed = [c for c in df.columns if not any(c.startswith(s + sep) for s in stubs) and c not in i]
    return df.select(*[col(c) for c in [*i, *fixed]], F.inline(rows))


def long_by_groups(df: DataFrame, groups: dict[str, list[str]], dropna: bool = True) -> DataFrame:
    """Several sets of equally long column lists stacked in parallel; rows null in any of them are dropped."""
    size = len(next(iter(groups.values())))
    rows = F.array(*[F.struct(*[col(cols[k]).alias(name) for name, cols in groups.items()]) for k in range(size)])
    used = {c for cols in groups.values() for c in cols}
    out = df.select(*[col(c) for c in df.columns if c not in used], F.inline(rows))
    return out.na.drop(subset=list(groups)) if dropna else out


def cut(x: Column, edges: list[float], right: bool = True, include_lowest: bool = False) -> Column:
    """0-based interval number of x among sorted edges, null outside; intervals are (a, b] or, with right=False, [a, b)."""
    out = F.lit(None).cast("int")
    for k in range(len(edges) - 1, 0, -1):
        a, b = edges[k - 1], edges[k]
        inside = ((x > a) & (x <= b)) if right else ((x >= a) & (x < b))
        if include_lowest and k == 1 and right:
            inside = (x >= a) & (x <= b)
        out = F.when(inside, k - 1).otherwise(out)
    return out


def equal_width_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """bins + 1 edges over the range; the lowest is moved out by 0.1 % so that the minimum is inside (a, b].

    A range of one value is widened by 0.1 % of it on both sides (by 0.001 around 0). Without a value it is an error.
    """
    lo, hi = df.agg(F.min(col(column)), F.max(col(column))).first()
    if lo is None:
        raise ValueError(f"{column} has no values to cut")
    if lo == hi:
        margin = 0.001 * abs(lo) or 0.001
        return [lo - margin + 2 * margin * k / bins for k in range(bins + 1)]
    step = (hi - lo) / bins
    edges = [lo + k * step for k in range(bins)] + [hi]
    edges[0] -= 0.001 * (hi - lo)
    return edges


def quantile_edges(df: DataFrame, column: str, q: int) -> list[float]:
    rows = quantiles(df, [], column, [k / q for k in range(q + 1)]).orderBy("share").collect()  # q + 1 numbers
    return [r["quantile"] for r in rows]


def qcut(df: DataFrame, column: str, q: int, name: str = "bin") -> DataFrame:
    """Quantile bins: exact linear-interpolated edges, right-closed, minimum included. Equal edges are an error."""
    edges = quantile_edges(df, column, q)
    if not edges:
        raise ValueError(f"{column} has no values to cut")
    if len(set(edges)) < len(edges):
        raise ValueError(f"quantiles of {column} coincide: {edges}")
    return df.withColumn(name, cut(col(column), edges, include_lowest=True))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width counts over [min, max], last bin closed on the right; empty bins are kept.

    A range of one value is taken as 0.5 to either side of it, no values as the range from 0 to 1.
    """
    lo, hi = df.agg(F.min(col(column)), F.max(col(column))).first()
    if lo is None:
        lo, hi = 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    number = F.least(F.width_bucket(col(column), F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins)) - 1
    counts = df.filter(col(column).isNotNull()).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    out = every.join(counts, "bin", "left").na.fill(0, ["n"])
    return out.withColumns({"lo": lo + col("bin") * width, "hi": lo + (col("bin") + 1) * width})


def dummies(df: DataFrame, column: str, values: list, prefix: str | None = None, drop_first: bool = False) -> DataFrame:
    """One 0/1 column per member of ``values``."""
    flags = [F.when(col(column) == F.lit(v), 1).otherwise(0).alias(f"{prefix or column}_{v}") for v in values[1 if drop_first else 0 :]]
    return df.select(*[col(c) for c in df.columns if c != column], *flags)


def split_dummies(df: DataFrame, column: str, values: list[str], sep: str = "|") -> DataFrame:
    """One 0/1 column per member of ``values``, the items of a separated string."""
    items = F.array_distinct(F.split(col(column), "\\Q" + sep + "\\E"))
    return df.select("*", *[F.when(F.array_contains(items, v), 1).otherwise(0).alias(v) for v in values])


def normalize_json(df: DataFrame, column: str, schema: str, path: str | None = None, meta: list[str] = (), sep: str = "_") -> DataFrame:
    """JSON text to flat columns; with ``path`` one row per record of that list, repeated with the ``meta`` fields."""
    keep = [c for c in df.columns if c != column]
    parsed = df.select(*[col(c) for c in keep], F.from_json(col(column), schema).alias("_j"))
    if path:
        taken = [F.col(f"_j.{m}").alias(m.replace(".", sep)) for m in meta]
        parsed = parsed.select(*[col(c) for c in keep], *taken, F.explode(F.col(f"_j.{path}")).alias("_j"))
        keep = [*keep, *[m.replace(".", sep) for m in meta]]
    return parsed.select(*[col(c) for c in keep], *flat_fields(parsed.schema["_j"].dataType, "_j", sep))


def flat_fields(kind, path: str, sep: str = "_", prefix: str = "") -> list[Column]:
    """Leaf columns of a struct, named by their joined path."""
    out = []
    for f in kind.fields:
        name, at = f"{prefix}{f.name}", f"{path}.`{f.name}`"
        out += flat_fields(f.dataType, at, sep, name + sep) if hasattr(f.dataType, "fields") else [F.col(at).alias(name)]
    return out


def align(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Exactly the rows of a key list, null where the table has none."""
    return equi_join(keys, df, on)


def lookup(df: DataFrame, requests: DataFrame, key: list[str], field: str, name: str = "value") -> DataFrame:
    """Cell per (row key, column name) request. Each request meets its row once and picks the named column there."""
    wanted = [c for c in df.columns if c not in key]
    values = df.select(*[col(k) for k in key], *[col(c).cast("string").alias(f"_v_{c}") for c in wanted])
    joined = equi_join(requests, values, key)
    pick = F.coalesce(*[F.when(col(field) == c, col(f"_v_{c}")) for c in wanted])
    return joined.withColumn(name, pick).select(*[col(c) for c in [*requests.columns, name]])
