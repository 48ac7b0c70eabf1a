"""Rolling, expanding, weighted and exponentially weighted statistics.

Fixed-length windows work on blocks of positions (or of time) with a halo of neighbouring rows, so a group of any size is
spread over its blocks. Rows of null groups are kept with null results.
"""

from __future__ import annotations

import math
from datetime import timedelta

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scans
from .ordered import BLOCK, col, drop_halo, equi_join, halo_blocks, has_group, position, running, settle, sort_image
from .order_statistics import running_quantiles
from .stats import correlation, unbiased_kurtosis, unbiased_skewness


LONG = 512  # rows from which quantiles of a window no longer look at all of its rows


def _reducer(fn: str, args: list, w) -> tuple[Column, Column]:
    """(value, number of usable rows) of one statistic over a window."""
    x = col(args[0])
    n = F.count(x).over(w)
    if fn in ("cov", "corr"):
        y = col(args[1])
        both = x.isNotNull() & y.isNotNull()
        a, b = F.when(both, x), F.when(both, y)
        return F.covar_samp(a, b).over(w) if fn == "cov" else correlation(a, b, w), F.count(a).over(w)
    if fn == "quantile":
        return F.percentile(x, args[1]).over(w), n
    if fn == "skew":
        return unbiased_skewness(F.skewness(x).over(w), n), n
    if fn == "kurt":
        return unbiased_kurtosis(F.kurtosis(x).over(w), n), n
    plain = {"count": F.count, "sum": F.sum, "mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev_samp,
             "var": F.var_samp, "median": lambda c: F.percentile(c, 0.5)}
    return plain[fn](x).over(w), n


def _outputs(outs: dict[str, tuple], w, min_periods: int) -> dict[str, Column]:
    made = {}
    for name, (fn, *args) in outs.items():
        value, n = _reducer(fn, args, w)
        made[name] = F.when(n >= min_periods, value)
    return made


def rolling_rows(
    df: DataFrame, by: list[str], order: list[str], window: int, outs: dict[str, tuple], min_periods: int | None = None,
    center: bool = False,
) -> DataFrame:
    """Statistics over the last ``window`` rows (or centred on the row) of each group.

    ``outs`` maps a name to (statistic, column[, second column or share]). The result is null until ``min_periods``
    non-null values (default: the window length) are in sight.
    """
    ranked = {name: args for name, (fn, *args) in outs.items() if fn in ("median", "quantile")}
    if ranked and window > LONG and not center:
        least = window if min_periods is None else min_periods
        rest = {name: how for name, how in outs.items() if name not in ranked}
        made = rolling_rows(df, by, order, window, rest, min_periods) if rest else df
        for column in dict.fromkeys(args[0] for args in ranked.values()):
            own = {name: args[1] if len(args) > 1 else 0.5 for name, args in ranked.items() if args[0] == column}
            made = running_quantiles(made, by, order, column, own, window, least)
        return made.select(*[col(c) for c in dict.fromkeys([*df.columns, *outs])])
    after = (window - 1) // 2 if center else 0
    before = window - 1 - after
    work = halo_blocks(position(df, by, order), col("_pos"), max(4096, 4 * window), before, after)
    w = Window.partitionBy(*[col(k) for k in by], BLOCK).orderBy("_pos").rowsBetween(-before, after)
    made = _outputs(outs, w, window if min_periods is None else min_periods)
    return drop_halo(work, df.columns, made)


def rolling_time(
    df: DataFrame, by: list[str], on: str, window: timedelta | int, outs: dict[str, tuple], min_periods: int = 1,
    closed: str = "right",
) -> DataFrame:
    """Statistics over the rows at most ``window`` before each row's time (microseconds, days or the column's own unit).

    ``closed`` says which ends of (t - window, t] belong to it: right, left, both or neither. Rows at the same instant
    see each other. Rows without a time or group get null.

    Where a stretch of 8 windows' length holds more than ``DENSE`` rows of a group, that group's counts, sums, means, extremes and
    variances come from merged summaries of its distinct times, so no task holds such a stretch.
    """
    width = window // timedelta(microseconds=1) if isinstance(window, timedelta) else window
    low = -width if closed in ("left", "both") else -(width - 1)
    high = 0 if closed in ("right", "both") else -1
    work = df.withColumn("_pos", F.when(has_group(by), sort_image(df, on).cast("long")))
    if all(fn in scans.MOMENTS for fn, *_ in outs.values()) and high >= low:
        counts = work.filter("_pos IS NOT NULL").groupBy(*[col(k) for k in by], F.floor(col("_pos") / (8 * width)).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
        dense = settle(counts.filter(col("_n") > DENSE).select(*[col(k) for k in by], F.lit(True).alias("_dense")).distinct(), "dense")
        if not dense.isEmpty():
            marked = equi_join(work, dense, by) if by else work.withColumn("_dense", F.lit(True))
            rest = rolling_time(marked.filter("_dense IS NULL").select(*[col(c) for c in df.columns]), by, on, window, outs, min_periods, closed) if by else None
            made = _dense_time(marked.filter("_dense").drop("_dense"), by, width + (closed == "both") - (closed == "neither"), high, outs, min_periods)
            made = made.select(*[col(c) for c in dict.fromkeys([*df.columns, *outs])])
            return made if rest is None else made.unionByName(rest)
    work = halo_blocks(work, col("_pos"), 8 * width, width, 0)
    w = Window.partitionBy(*[col(k) for k in by], BLOCK).orderBy("_pos").rangeBetween(low, high)
    return drop_halo(work, df.columns, _outputs(outs, w, min_periods))


DENSE = 4_000_000


def _dense_time(work: DataFrame, by: list[str], length: int, end: int, outs: dict[str, tuple], min_periods: int) -> DataFrame:
    """``outs`` of rows with a time ``_pos``: summaries per distinct time, merged over the windows, joined back."""
    groups = [col(k) for k in by]
    for column in dict.fromkeys(column for _, column in outs.values()):
        x = col(column).cast("double")
        n = F.count(x).cast("double")
        points = work.filter("_pos IS NOT NULL").groupBy(*groups, "_pos").agg(
            n.alias("_n"), F.coalesce(F.sum(x), F.lit(0.0)).alias("_sum"), F.coalesce(F.avg(x), F.lit(0.0)).alias("_mean"), F.coalesce(F.var_pop(x) * n, F.lit(0.0)).alias("_dev"),
            F.coalesce(F.min(x), F.lit(scans.EMPTY["_least"])).alias("_least"), F.coalesce(F.max(x), F.lit(scans.EMPTY["_most"])).alias("_most"))
        merged = scans.slide_time(points, by, "_pos", length, end, list(scans.EMPTY), scans.EMPTY, scans.moments)
        own = {name: F.when(col("_n") >= min_periods, F.when((col("_n") > 0) | F.lit(fn == "count"), scans.MOMENTS[fn]())) for name, (fn, c) in outs.items() if c == column}
        merged = merged.select(*groups, "_pos", *[value.alias(name) for name, value in own.items()])
        work = equi_join(work.drop(*own), merged, [*by, "_pos"])
    return work


def rolling_weighted(
    df: DataFrame, by: list[str], order: list[str], column: str, weights: list[float], name: str, mean: bool = True,
) -> DataFrame:
    """Weighted sum or mean of the last ``len(weights)`` rows, oldest weight first; null while a row is missing."""
    return rolling_shapes(df, by, order, column, {name: weights}, mean)


def rolling_shapes(df: DataFrame, by: list[str], order: list[str], column: str, shapes: dict[str, list[float]], mean: bool = True) -> DataFrame:
    """Several weighted sums or means of one column, by name, in one pass."""
    longest = max(map(len, shapes.values()))
    work = halo_blocks(position(df, by, order), col("_pos"), max(4096, 4 * longest), longest - 1, 0)
    w = Window.partitionBy(*[col(k) for k in by], BLOCK).orderBy("_pos")
    work = work.withColumns({f"_lag{i}": F.lag(col(column), i).over(w) for i in range(longest)})
    total = lambda weights: sum((col(f"_lag{len(weights) - 1 - i}") * float(x) for i, x in enumerate(weights)), F.lit(0.0))
    return drop_halo(work, df.columns, {name: total(weights) / (sum(weights) if mean else 1.0) for name, weights in shapes.items()})


def triangular_weights(n: int) -> list[float]:
    half = [2 * i / (n + 1) if n % 2 else (2 * i - 1) / n for i in range(1, (n + 1) // 2 + 1)]
    return half + half[::-1][n % 2 :]


def gaussian_weights(n: int, std: float) -> list[float]:
    return [math.exp(-0.5 * ((i - (n - 1) / 2) / std) ** 2) for i in range(n)]


def window_weights(shape: str, n: int, *parameters: float) -> list[float]:
    """The n weights of a named shape, symmetric.

    boxcar, triang, bartlett, cosine sums (hamming, blackman, blackmanharris, nuttall), barthann, bohman, parzen; kaiser(beta),
    gaussian(std), general_gaussian(power, width).
    """
    if n == 1:
        return [1.0]
    turn = [2 * math.pi * i / (n - 1) for i in range(n)]
    off = [abs(2 * i / (n - 1) - 1) for i in range(n)]  # distance from the middle, 1 at the ends
    # Coefficients of the cosine sums.
    sums = {"hamming": (0.54, 0.46), "blackman": (0.42, 0.5, 0.08), "blackmanharris": (0.35875, 0.48829, 0.14128, 0.01168), "nuttall": (0.3635819, 0.4891775, 0.1365995, 0.0106411)}
    if shape in sums:
        return [sum((-1) ** k * a * math.cos(k * x) for k, a in enumerate(sums[shape])) for x in turn]
    if shape == "boxcar":
        return [1.0] * n
    if shape == "triang":
        return triangular_weights(n)
    if shape == "bartlett":
        return [1 - x for x in off]
    if shape == "barthann":
        return [0.62 - 0.24 * x + 0.38 * math.cos(math.pi * x) for x in off]
    if shape == "bohman":
        return [(1 - x) * math.cos(math.pi * x) + math.sin(math.pi * x) / math.pi if x < 1 else 0.0 for x in off]
    if shape == "parzen":
        far = [abs(2 * i - (n - 1)) / n for i in range(n)]
        return [1 - 6 * x * x * (1 - x) if x <= 0.5 else 2 * (1 - x) ** 3 for x in far]
    if shape == "kaiser":
        return [float(np.i0(parameters[0] * math.sqrt(max(0.0, 1 - x * x))) / np.i0(parameters[0])) for x in off]
    if shape == "gaussian":
        return gaussian_weights(n, *parameters)
    if shape == "general_gaussian":
        power, width = parameters
        return [math.exp(-0.5 * abs((i - (n - 1) / 2) / width) ** (2 * power)) for i in range(n)]
    raise ValueError(shape)


def expanding(df: DataFrame, by: list[str], order: list[str], column: str, outs: dict[str, str | tuple], min_periods: int = 1) -> DataFrame:
    """Statistics over all rows up to the current one: count, sum, mean, min, max, var, std, skew or kurt (bias-corrected),
    median, or ("quantile", share). Pairs of columns: ``scans.running_pairs``; functions of the caller's own: ``scans.scan``.

    Moments are merged from powers of deviations from the column's overall mean, which keeps them well conditioned.
    Skew and kurt of values without variance are null.
    """
    ranked = {name: 0.5 if how == "median" else how[1] for name, how in outs.items() if how == "median" or isinstance(how, tuple)}
    if ranked:
        rest = {name: how for name, how in outs.items() if name not in ranked}
        made = expanding(df, by, order, column, rest, min_periods) if rest else df
        return running_quantiles(made, by, order, column, ranked, None, min_periods).select(*[col(c) for c in dict.fromkeys([*df.columns, *outs])])
    x = col(column)
    aggs = {"_n": ("count", x), "_s": ("sum", x), "_lo": ("min", x), "_hi": ("max", x)}
    if {"var", "std", "skew", "kurt"} & set(outs.values()):
        centre = df.agg(F.avg(x)).first()[0] or 0.0
        aggs |= {"_d": ("sum", x - centre), "_q": ("sum", (x - centre) * (x - centre))}
    if {"skew", "kurt"} & set(outs.values()):
        aggs |= {"_p3": ("sum", F.pow(x - centre, F.lit(3))), "_p4": ("sum", F.pow(x - centre, F.lit(4)))}
    work = running(df, by, order, aggs)
    var = F.when(col("_n") > 1, F.greatest(F.lit(0.0), (col("_q") - col("_d") * col("_d") / col("_n"))) / (col("_n") - 1)) \
        if "_q" in aggs else None
    values = {"count": col("_n"), "sum": col("_s"), "mean": col("_s") / col("_n"), "min": col("_lo"), "max": col("_hi"),
              "var": var, "std": None if var is None else F.sqrt(var)}
    if "_p3" in aggs:
        n, m, s2, s3, s4 = col("_n"), col("_d") / col("_n"), col("_q") / col("_n"), col("_p3") / col("_n"), col("_p4") / col("_n")
        m2 = s2 - m * m
        m3, m4 = s3 - 3 * m * s2 + 2 * F.pow(m, F.lit(3)), s4 - 4 * m * s3 + 6 * m * m * s2 - 3 * F.pow(m, F.lit(4))
        values |= {"skew": F.when(m2 > 0, unbiased_skewness(m3 / F.pow(m2, F.lit(1.5)), n)), "kurt": F.when(m2 > 0, unbiased_kurtosis(m4 / (m2 * m2) - 3, n))}
    made = {name: F.when(col("_n") >= min_periods, values[fn]) for name, fn in outs.items()}
    return work.withColumns(made).select(*[col(c) for c in [*df.columns, *outs]])


def decay(com: float | None = None, span: float | None = None, halflife: float | None = None, alpha: float | None = None) -> float:
    """Smoothing factor from any one of the four usual parameters."""
    if com is not None:
        return 1 / (1 + com)
    if span is not None:
        return 2 / (span + 1)
    if halflife is not None:
        return 1 - math.exp(math.log(0.5) / halflife)
    return alpha


def exponential(
    df: DataFrame, by: list[str], order: list[str], outs: dict[str, tuple], adjust: bool = True, min_periods: int = 0,
    bias: bool = False, ignore_na: bool = False, **parameter: float,
) -> DataFrame:
    """Exponentially weighted mean, var, std, cov and corr; ``outs`` maps a name to (statistic, column[, column]).

    Nulls carry the last result on. They count as steps of the decay, unless ``ignore_na``. Results are null before the first
    known value, below ``min_periods`` known ones, and for null groups.

    Weighted sums of a stretch of rows are a summary that can be merged: what stands before is shrunk by the steps of the stretch.
    All columns go through one scan.
    """
    alpha = decay(**parameter)
    sets = list(dict.fromkeys(tuple(args) for _, *args in outs.values()))
    state, zero = {}, F.lit(0.0)
    for i, args in enumerate(sets):
        x, y = col(args[0]).cast("double"), col(args[-1]).cast("double")
        usable = x.isNotNull() & y.isNotNull()
        known = lambda v, ok=usable: F.when(ok, v).otherwise(zero)
        one = known(F.lit(1.0))
        # n: known rows; lead and tail: steps before the first and after the last of them; first: share that the first one still has
        state |= {f"_n{i}": one, f"_lead{i}": zero if ignore_na else 1.0 - one, f"_tail{i}": zero if ignore_na else 1.0 - one, f"_share{i}": one, f"_fx{i}": known(x), f"_fy{i}": known(y)}
        state |= {f"_{k}{i}": known(v) for k, v in {"s0": F.lit(1.0), "s2": F.lit(1.0), "sx": x, "sy": y, "sxy": x * y, "sxx": x * x, "syy": y * y}.items()}

    def merge(a: dict, b: dict) -> dict:
        out = {}
        for i in range(len(sets)):
            out |= {f"{k}{i}": v for k, v in _decayed({k: a[f"{k}{i}"] for k in _EWM}, {k: b[f"{k}{i}"] for k in _EWM}, alpha, adjust).items()}
        return out
    work = scans.scan(df, by, order, state, merge)

    made = {}
    for name, (fn, *args) in outs.items():
        i = sets.index(tuple(args))
        seen, weight = col(f"_n{i}"), col(f"_s0{i}")
        mean = lambda k, i=i, weight=weight: col(f"_{k}{i}") / weight
        if fn == "mean":
            value = mean("sx")
        else:
            cov = mean("sxy") - mean("sx") * mean("sy")
            square = weight * weight
            debias = F.lit(1.0) if bias else F.when((seen > 1) & (square > col(f"_s2{i}")), square / (square - col(f"_s2{i}")))
            if fn == "corr":
                vx, vy = mean("sxx") - mean("sx") * mean("sx"), mean("syy") - mean("sy") * mean("sy")
                value = F.when((vx > 0) & (vy > 0) & (seen > 1), cov / F.sqrt(vx * vy))
            else:
                value = F.sqrt(F.greatest(cov, zero) * debias) if fn == "std" else cov * debias
        made[name] = F.when(seen >= max(min_periods, 1), value)
    return work.withColumns(made).select(*[col(c) for c in dict.fromkeys([*df.columns, *outs])])


_SUMS = {"_s0": None, "_sx": "x", "_sy": "y", "_sxy": "xy", "_sxx": "xx", "_syy": "yy"}
_EWM = ["_n", "_lead", "_tail", "_share", "_fx", "_fy", "_s2", *_SUMS]


def _decayed(a: dict, b: dict, alpha: float, adjust: bool) -> dict:
    """Weighted sums of rows a followed by rows b.

    With ``adjust`` a's weights shrink by 1 - alpha for each step from its last known row to b's last one. Without, weights add up
    to 1 after each known row: where a known row follows, old and new share that mass, so what b's first known row still holds of
    it (``share``) is dealt out anew between a and that row.
    """
    has_a, has_b = a["_n"] > 0, b["_n"] > 0
    steps = a["_tail"] + b["_lead"] + 1
    old = (1 - alpha) ** steps
    if adjust:
        # share: (1 - alpha) to the steps from b's first known row to its last
        from_a = old * b["_share"]
        sums = {k: a[k] * from_a + b[k] for k in _SUMS}
        square = a["_s2"] * from_a * from_a + b["_s2"]
    else:
        keep, new = old / (old + alpha), alpha / (old + alpha)
        fx, fy = b["_fx"], b["_fy"]
        first = {None: 1.0, "x": fx, "y": fy, "xy": fx * fy, "xx": fx * fx, "yy": fy * fy}
        sums = {k: b[k] + b["_share"] * (keep * a[k] + (new - 1) * first[v]) for k, v in _SUMS.items()}
        square = b["_s2"] + b["_share"] ** 2 * (keep * keep * a["_s2"] + new * new - 1)
    both = {"_n": a["_n"] + b["_n"], "_lead": a["_lead"], "_tail": b["_tail"], "_fx": a["_fx"], "_fy": a["_fy"], "_s2": square, **sums}
    both["_share"] = a["_share"] * (old * b["_share"] if adjust else b["_share"] * keep)
    only_a = {**a, "_tail": a["_tail"] + b["_lead"]}
    only_b = {**b, "_lead": a["_lead"] + b["_lead"]}
    # where neither has a known row, lead and tail both count all steps
    none = {**a, "_lead": a["_lead"] + b["_lead"], "_tail": a["_tail"] + b["_tail"]}
    return {k: np.where(has_a & has_b, both[k], np.where(has_a, only_a[k], np.where(has_b, only_b[k], none[k]))) for k in _EWM}


def autocorrelation(df: DataFrame, by: list[str], order: list[str], column: str, lag: int = 1) -> DataFrame:
    """Correlation of the column with itself ``lag`` rows earlier, one row per group."""
    from .ranks import shift

    pairs = shift(df, by, order, {"_lag": (column, lag)})
    return pairs.filter(has_group(by)).groupBy(*[col(k) for k in by]).agg(correlation(col(column), col("_lag")).alias("autocorr"))
