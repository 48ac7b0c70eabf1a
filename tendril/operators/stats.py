"""Moments, descriptions, modes, value counts and correlations."""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from .ordered import col, equi_join, has_group, running, settle


def unbiased_skewness(g1: Column, n: Column) -> Column:
    """Sample skewness from the population one."""
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def unbiased_kurtosis(g2: Column, n: Column) -> Column:
    """Sample excess kurtosis from the population one."""
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def correlation(x: Column, y: Column, over: WindowSpec | None = None) -> Column:
    """Correlation of the rows where both are known, as an aggregate or over a window: NaN if either does not vary, null for one row.

    ``corr`` divides by the product of the deviations, which stops the job with an error where a column does not vary.
    """
    of = (lambda c: c) if over is None else (lambda c: c.over(over))
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    square = of(F.var_pop(a)) * of(F.var_pop(b))
    value = F.when(square > 0, of(F.covar_pop(a, b)) / F.sqrt(square)).otherwise(F.lit(float("nan")))
    return F.when(of(F.count(a)) > 1, value)


def moments(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """sum, prod, mean, min, max, var, std, sem, skew and kurt (bias-corrected) per group in one aggregation."""
    x, n = col(column), F.count(col(column))
    return df.groupBy(*[col(k) for k in by]).agg(
        n.alias("n"), F.sum(x).alias("sum"), F.avg(x).alias("mean"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.product(x).alias("prod"), F.var_samp(x).alias("var"), F.stddev_samp(x).alias("std"),
        (F.stddev_samp(x) / F.sqrt(n)).alias("sem"), unbiased_skewness(F.skewness(x), n).alias("skew"),
        unbiased_kurtosis(F.kurtosis(x), n).alias("kurt"),
    )


def mean_abs_deviation(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """Mean absolute deviation from the group mean; rows of null groups are left out."""
    df = df.filter(has_group(by))
    means = df.groupBy(*[col(k) for k in by]).agg(F.avg(col(column)).alias("_mean"))
    joined = equi_join(df, means, by) if by else df.join(F.broadcast(means))
    return joined.groupBy(*[col(k) for k in by]).agg(F.avg(F.abs(col(column) - col("_mean"))).alias("mad"))


def describe(df: DataFrame, by: list[str], column: str, shares=(0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std, min, exact quantiles and max per group; rows of null groups are left out."""
    from .ranks import quantiles

    df = df.filter(has_group(by))
    x = col(column)
    basic = df.groupBy(*[col(k) for k in by]).agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")
    )
    q = quantiles(df, by, column, list(shares)).groupBy(*[col(k) for k in by]).agg(
        *[F.max(F.when(F.abs(col("share") - s) < 1e-12, col("quantile"))).alias(f"q{round(100 * s)}") for s in shares]
    )
    return equi_join(basic, q, by) if by else basic.join(F.broadcast(q))


def describe_labels(df: DataFrame, column: str) -> DataFrame:
    """count, unique, top and freq of a label column (ties: smallest label)."""
    counts = df.filter(col(column).isNotNull()).groupBy(col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-col("n")).alias("m"), col("v").alias("top")))
    return counts.agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best["top"].alias("top"), F.max("n").alias("freq"))


def value_counts(df: DataFrame, by: list[str], column: str, dropna: bool = True) -> DataFrame:
    """Count and share of each value, per group if ``by`` is given; rows of null groups are left out."""
    df = df.filter(has_group(by))
    base = df.filter(col(column).isNotNull()) if dropna else df
    counts = base.groupBy(*[col(k) for k in by], col(column)).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*[col(k) for k in by]).agg(F.sum("n").alias("_total"))
    out = equi_join(counts, totals, by) if by else counts.join(F.broadcast(totals))
    return out.withColumn("share", col("n") / col("_total")).drop("_total")


def modes(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """All most frequent values per group."""
    known = df.filter(has_group(by) & col(column).isNotNull())
    counts = known.groupBy(*[col(k) for k in by], col(column)).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*[col(k) for k in by]).agg(F.max("n").alias("_best"))
    out = equi_join(counts, best, by, "inner") if by else counts.join(F.broadcast(best))
    return out.filter("n = _best").drop("_best")


def correlation_pairs(df: DataFrame, columns: list[str], by: list[str] = (), min_periods: int = 1, fn: str = "pearson") -> DataFrame:
    """Pairwise correlation and covariance of columns (rows where both are known), long form; every pair in one scan."""
    if fn == "spearman":
        return _spearman(df, columns, list(by), min_periods)
    cells = []
    for a, b in combinations_with_replacement(columns, 2):
        both = col(a).isNotNull() & col(b).isNotNull()
        x, y = F.when(both, col(a)), F.when(both, col(b))
        enough = F.count(x) >= min_periods
        cells.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.when(enough, correlation(x, y)).alias("corr"),
                              F.when(enough, F.covar_samp(x, y)).alias("cov")))
    wide = df.groupBy(*[col(k) for k in by]).agg(F.array(*cells).alias("_cells"))
    return wide.select(*[col(k) for k in by], F.inline("_cells"))


def correlate_with(left: DataFrame, right: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """Correlation of each column with the column of the same name in another frame, over rows of equal keys: (column, corr)."""
    other = right.select(*[col(k) for k in on], *[col(c).alias(f"_r{i}") for i, c in enumerate(columns)])
    joined = left.join(other, on)
    cells = [F.struct(F.lit(c).alias("column"), correlation(col(c), col(f"_r{i}")).alias("corr")) for i, c in enumerate(columns)]
    return joined.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def _spearman(df: DataFrame, columns: list[str], by: list[str], min_periods: int) -> DataFrame:
    from .ranks import rank

    parts = []
    for a, b in combinations_with_replacement(columns, 2):
        both = df.filter(col(a).isNotNull() & col(b).isNotNull()).select(*[col(k) for k in by], col(a).alias("x"), col(b).alias("y"))
        ranked = rank(rank(both, by, "x", "rx"), by, "y", "ry")
        value = F.when(F.count(F.lit(1)) >= min_periods, correlation(col("rx"), col("ry")))
        parts.append(ranked.groupBy(*[col(k) for k in by]).agg(value.alias("corr")).withColumns({"a": F.lit(a), "b": F.lit(b)}))
    return reduce(DataFrame.unionByName, parts)


def kendall(df: DataFrame, x: str, y: str) -> DataFrame:
    """Kendall's tau-b of two columns, without forming pairs.

    Pairs in opposite order are counted bit by bit: two values of y first differ at one bit of their dense rank, so at
    each level rows that agree on the higher bits are grouped, and a row with a 0 there is passed by the earlier-in-x rows
    with a 1. That is one running sum over (rows x bits), chunked like any other.
    """
    from .ranks import rank

    known = df.filter(col(x).isNotNull() & col(y).isNotNull()).select(col(x).alias("x"), col(y).alias("y"))
    cells = known.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    cells = settle(rank(rank(cells, [], "x", "rx", "dense"), [], "y", "ry", "dense").select("rx", "ry", "n"), "kendall")
    top = cells.agg(F.max("ry").alias("m")).first()["m"] or 1
    levels = F.sequence(F.lit(0), F.lit(int(top).bit_length() - 1))
    bits = cells.withColumn("level", F.explode(levels))
    bits = bits.withColumn("group", F.expr("shiftright(ry, level + 1)")).withColumn("bit", F.expr("shiftright(ry, level) & 1"))
    # rows with one x value are merged first: they must not count against each other
    merged = bits.groupBy("level", "group", "rx").agg(
        F.sum(F.when(col("bit") == 1, col("n")).otherwise(0)).alias("ones"),
        F.sum(F.when(col("bit") == 0, col("n")).otherwise(0)).alias("zeros"),
    )
    seen = running(settle(merged, "kendall"), ["level", "group"], ["rx"], {"upto": ("sum", col("ones"))})
    crossing = seen.agg(F.sum((col("upto") - col("ones")) * col("zeros")).cast("double").alias("discordant"))

    def ties(keys):
        n = F.sum("n").cast("double")
        return cells.groupBy(*keys).agg(n.alias("t")).agg(F.sum(col("t") * (col("t") - 1) / 2).alias("_".join(["tied", *keys])))

    parts = [crossing, ties(["rx"]), ties(["ry"]), ties(["rx", "ry"]), cells.agg(F.sum("n").cast("double").alias("rows"))]
    one = reduce(lambda a, b: a.join(F.broadcast(b)), parts)  # five one-row tables
    pairs = col("rows") * (col("rows") - 1) / 2
    concordant = pairs - col("discordant") - col("tied_rx") - col("tied_ry") + col("tied_rx_ry")
    scale = F.sqrt((pairs - col("tied_rx")) * (pairs - col("tied_ry")))
    return one.select(((concordant - col("discordant")) / scale).alias("kendall"))
