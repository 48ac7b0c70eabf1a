"""Ranks, cumulative values, shifts and rolling statistics on the benchmark tables.

Where a result can end in an exact half, a tiny constant is added on both sides before rounding.
"""

from datetime import timedelta

import numpy as np
from pyspark.sql import functions as F

from ..operators import ranks, rolling, scans
from ..operators.ordered import settle
from .registry import query

BY, ORDER = ["user_id"], ["ts", "event_id"]


def _rounded(df, digits=6, **only):
    return df.withColumns({c: F.round(c, only.get(c, digits)) for c in df.columns if df.schema[c].dataType.typeName() == "double" and c != "value"})


def _events(t):
    return t.events.select("event_id", "user_id", "ts", "value")


@query("b42_rank_methods", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag,
           rank() OVER w + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2 AS r_average, rank() OVER w AS r_min,
           rank() OVER w + count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1 AS r_max, dense_rank() OVER w AS r_dense
    FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_quantity)""")
def rank_methods(t):
    out = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    return ranks.rank_by_methods(out, ["l_returnflag"], "l_quantity", {f"r_{m}": m for m in ("average", "min", "max", "dense")})


@query("b42_rank_first_descending_pct", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus, o_orderkey) AS r_first,
           round((rank() OVER (ORDER BY o_custkey DESC) + (count(*) OVER (PARTITION BY o_custkey) - 1) / 2) / count(*) OVER (), 8) AS r_pct FROM orders""")
def rank_first(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    first = ranks.rank(o, [], "o_orderstatus", "r_first", "first", tie=["o_orderkey"])
    out = ranks.rank(first, [], "o_custkey", "r_pct", "average", ascending=False, pct=True)
    return out.select("o_orderkey", "r_first", F.round("r_pct", 8).alias("r_pct"))


@query("b42_rank_null_placement", """
    SELECT c_custkey, rank() OVER (ORDER BY b NULLS LAST) AS r_bottom, CASE WHEN b IS NOT NULL THEN rank() OVER (ORDER BY b NULLS LAST) END AS r_keep
    FROM (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS b FROM customer)""")
def rank_null_placement(t):
    c = t.customer.select("c_custkey", F.expr("if(c_acctbal > 0, c_acctbal, null)").alias("b"))
    out = ranks.rank(ranks.rank(c, [], "b", "r_bottom", "min", nulls="bottom"), [], "b", "r_keep", "min")
    return out.drop("b")


@query("b43_largest_and_smallest", """
    (SELECT 'large' AS pick, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10) UNION ALL
    (SELECT 'small' AS pick, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10)""")
def largest_and_smallest(t):
    o = t.orders.select("o_orderkey", "o_totalprice")
    large = o.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10).withColumn("pick", F.lit("large"))
    return large.unionByName(o.orderBy("o_totalprice", "o_orderkey").limit(10).withColumn("pick", F.lit("small")))


@query("b44_shift_diff_change", """
    SELECT event_id, lag(value) OVER w AS prev, lead(value, 2) OVER w AS ahead, round(value - lag(value) OVER w, 6) + 0.0 AS diff,
           round(value / nullif(lag(value) OVER w, 0) - 1, 6) + 0.0 AS pct FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def shift_diff_change(t):
    s = ranks.shift(_events(t), BY, ORDER, {"prev": ("value", 1), "ahead": ("value", -2)})
    v, p = F.col("value"), F.col("prev")
    return s.select("event_id", "prev", "ahead", F.round(v - p, 6).alias("diff"), F.round(F.try_divide(v, p) - 1, 6).alias("pct"))


@query("b45_cumulative", """
    SELECT event_id, round(sum(value) OVER w, 4) AS cumsum, max(value) OVER w AS cummax, min(value) OVER w AS cummin,
           row_number() OVER w - 1 AS cumcount, round(product(1 + value / 1000) OVER w, 6) AS cumprod
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def cumulative(t):
    e = _events(t).withColumn("growth", 1 + F.col("value") / 1000)
    out = ranks.cumulative(e, BY, ORDER, cumsum=("sum", "value"), cummax=("max", "value"), cummin=("min", "value"),
                           cumcount=("position", "value"), cumprod=("product", "growth"))
    return out.select("event_id", F.round("cumsum", 4).alias("cumsum"), "cummax", "cummin", "cumcount", F.round("cumprod", 6).alias("cumprod"))


@query("b45_whole_table_cumulative", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(sum(l_quantity) OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
           l_extendedprice ROWS UNBOUNDED PRECEDING), 2) AS running_qty FROM lineitem""")
def whole_table_cumulative(t):
    """A running total with no group at all, still computed chunk by chunk."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    rows = t.lineitem.select(*keys, "l_shipdate", "l_quantity")
    out = ranks.cumulative(rows, [], ["l_shipdate", *keys], running_qty=("sum", "l_quantity"))
    return out.select(*keys, F.round("running_qty", 2).alias("running_qty"))


@query("b45_group_number", """
    SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority, o_orderstatus) - 1 AS ngroup FROM orders""")
def group_number(t):
    o = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return ranks.group_number(o, ["o_orderpriority", "o_orderstatus"]).select("o_orderkey", "ngroup")


_ROLL = "count(value) OVER w >= 5"


@query("b46_rolling_rows", f"""
    SELECT event_id, CASE WHEN {_ROLL} THEN round(sum(value) OVER w, 6) END AS r_sum, CASE WHEN {_ROLL} THEN round(avg(value) OVER w, 6) END AS r_mean,
           CASE WHEN {_ROLL} THEN min(value) OVER w END AS r_min, CASE WHEN {_ROLL} THEN round(stddev_samp(value) OVER w, 6) END AS r_std,
           CASE WHEN {_ROLL} THEN round(quantile_cont(value, 0.5) OVER w, 6) END AS r_median, CASE WHEN {_ROLL} THEN round(quantile_cont(value, 0.9) OVER w, 6) END AS r_q90
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def rolling_rows(t):
    outs = {"r_sum": ("sum", "value"), "r_mean": ("mean", "value"), "r_min": ("min", "value"), "r_std": ("std", "value"),
            "r_median": ("median", "value"), "r_q90": ("quantile", "value", 0.9)}
    return _rounded(rolling.rolling_rows(_events(t), BY, ORDER, 5, outs).select("event_id", *outs))


@query("b46_rolling_moments", """
    SELECT event_id, CASE WHEN count(value) OVER w >= 4 THEN round(skewness(value) OVER w, 5) + 0.0 END AS r_skew,
           CASE WHEN count(value) OVER w >= 4 THEN round(kurtosis(value) OVER w, 5) + 0.0 END AS r_kurt,
           CASE WHEN count(value) OVER w >= 4 THEN round(covar_samp(value, event_id) OVER w + 1e-6, 3) + 0.0 END AS r_cov,
           CASE WHEN count(value) OVER w >= 4 THEN round(corr(value, event_id) OVER w, 5) + 0.0 END AS r_corr
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)""")
def rolling_moments(t):
    outs = {"r_skew": ("skew", "value"), "r_kurt": ("kurt", "value"), "r_cov": ("cov", "value", "event_id"), "r_corr": ("corr", "value", "event_id")}
    out = rolling.rolling_rows(_events(t), BY, ORDER, 8, outs, min_periods=4).select("event_id", *outs)
    out = out.withColumn("r_cov", F.col("r_cov") + 1e-6)
    return _rounded(out, 5, r_cov=3)


@query("b46_rolling_centred", """
    SELECT event_id, CASE WHEN count(value) OVER w >= 3 THEN round(avg(value) OVER w, 6) END AS r_mean
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING)""")
def rolling_centred(t):
    out = rolling.rolling_rows(_events(t), BY, ORDER, 6, {"r_mean": ("mean", "value")}, min_periods=3, center=True)
    return _rounded(out.select("event_id", "r_mean"))


@query("b47_rolling_time", """
    SELECT event_id, round(sum(value) OVER w, 4) AS s, count(*) OVER w AS n, max(value) OVER w AS hi
    FROM (SELECT *, epoch_us(ts) AS e FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY e RANGE BETWEEN 172799999999 PRECEDING AND CURRENT ROW)""")
def rolling_time(t):
    outs = {"s": ("sum", "value"), "n": ("count", "value"), "hi": ("max", "value")}
    return _rounded(rolling.rolling_time(_events(t), BY, "ts", timedelta(days=2), outs).select("event_id", *outs), 4)


@query("b47_rolling_time_left_closed", """
    SELECT event_id, CASE WHEN count(*) OVER w >= 2 THEN round(avg(value) OVER w, 6) END AS m
    FROM (SELECT *, epoch_us(ts) AS e FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY e RANGE BETWEEN 43200000000 PRECEDING AND 1 PRECEDING)""")
def rolling_time_left(t):
    out = rolling.rolling_time(_events(t), BY, "ts", timedelta(hours=12), {"m": ("mean", "value")}, min_periods=2, closed="left")
    return _rounded(out.select("event_id", "m"))


@query("b48_expanding", """
    SELECT event_id, round(avg(value) OVER w + 1e-8, 6) AS mean, round(stddev_samp(value) OVER w, 5) AS std, max(value) OVER w AS hi
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def expanding(t):
    out = rolling.expanding(_events(t), BY, ORDER, "value", {"mean": "mean", "std": "std", "hi": "max"})
    return _rounded(out.select("event_id", (F.col("mean") + 1e-8).alias("mean"), "std", "hi"), 6, std=5)


_LINES = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


@query("b48_expanding_quantiles", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(quantile_cont(l_extendedprice, 0.5) OVER w + 1e-7, 4) AS median, round(quantile_cont(l_extendedprice, 0.9) OVER w + 1e-7, 4) AS q90
    FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY {', '.join(_LINES)} ROWS UNBOUNDED PRECEDING)""")
def expanding_quantiles(t):
    """Three groups only, each of them over many tasks."""
    rows = t.lineitem.select("l_returnflag", *_LINES)
    out = rolling.expanding(rows, ["l_returnflag"], _LINES, "l_extendedprice", {"median": "median", "q90": ("quantile", 0.9)})
    return out.select(*_LINES[1:6], F.round(F.col("median") + 1e-7, 4).alias("median"), F.round(F.col("q90") + 1e-7, 4).alias("q90"))


@query("b46_rolling_long_median", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(quantile_cont(l_extendedprice, 0.5) OVER w + 1e-7, 4) AS median
    FROM lineitem WINDOW w AS (ORDER BY {', '.join(_LINES)} ROWS 99999 PRECEDING)""")
def rolling_long_median(t):
    """The whole table as one group, 100,000 rows in each window."""
    out = rolling.rolling_rows(t.lineitem.select(*_LINES), [], _LINES, 100_000, {"median": ("median", "l_extendedprice")}, min_periods=1)
    return out.select(*_LINES[1:6], F.round(F.col("median") + 1e-7, 4).alias("median"))


def _largest_fall(a, b):
    """Highest and lowest value, and the largest fall from a value to a later one."""
    return {"high": np.maximum(a["high"], b["high"]), "low": np.minimum(a["low"], b["low"]), "fall": np.maximum(np.maximum(a["fall"], b["fall"]), a["high"] - b["low"])}


def _single_value():
    return {"high": F.col("value"), "low": F.col("value"), "fall": F.lit(0.0)}


@query("b48_expanding_apply", """
    SELECT event_id, round(max(peak - value) OVER (ORDER BY ts, event_id), 6) AS fall, round(max(own_peak - value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS own_fall
    FROM (SELECT *, max(value) OVER (ORDER BY ts, event_id) AS peak, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS own_peak FROM events)""")
def expanding_apply(t):
    """A function of the caller's own, over the whole table as one group and over each user."""
    own = scans.scan(_events(t), BY, ORDER, _single_value(), _largest_fall).select("event_id", "ts", "value", F.col("fall").alias("own_fall"))
    return _rounded(scans.scan(own, [], ORDER, _single_value(), _largest_fall).select("event_id", "fall", "own_fall"))


@query("b46_rolling_apply", """
    WITH p AS (SELECT event_id, value, row_number() OVER (ORDER BY ts, event_id) AS i FROM events),
         a AS (SELECT p.event_id, p.i, q.i AS j, q.value FROM p JOIN p AS q ON q.i BETWEEN p.i - 19 AND p.i)
    SELECT event_id, round(max(peak - value), 6) AS fall FROM (SELECT *, max(value) OVER (PARTITION BY event_id ORDER BY j) AS peak FROM a) GROUP BY event_id""")
def rolling_apply(t):
    """The same function over the last 20 rows of the whole table."""
    return _rounded(scans.slide(_events(t), [], ORDER, 20, _single_value(), _largest_fall).select("event_id", "fall"))


@query("b48_expanding_pairs", """
    SELECT event_id, round(CASE WHEN count(*) OVER w >= 3 THEN covar_samp(value, far) OVER w END + 1e-7, 3) + 0.0 AS cov, round(CASE WHEN count(*) OVER w >= 3 THEN corr(value, far) OVER w END + 1e-9, 5) + 0.0 AS corr
    FROM (SELECT *, event_id % 1000 + 1e6 AS far FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def expanding_pairs(t):
    """Covariance and correlation with a column whose offset is a thousand times its spread."""
    rows = _events(t).withColumn("far", F.col("event_id") % 1000 + F.lit(1e6))
    out = scans.running_pairs(rows, BY, ORDER, "value", "far", {"cov": "cov", "corr": "corr"}, min_periods=3)
    return out.select("event_id", (F.round(F.col("cov") + 1e-7, 3) + 0.0).alias("cov"), (F.round(F.col("corr") + 1e-9, 5) + 0.0).alias("corr"))


_EWM = """
    WITH p AS (SELECT event_id, user_id, value AS x, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
         w AS (SELECT a.event_id, b.x, pow(1 - 2 / 11.0, a.i - b.i) AS w, CASE WHEN b.i = 1 THEN 1 ELSE 2 / 11.0 END AS h
               FROM p a JOIN p b ON a.user_id = b.user_id AND b.i <= a.i)"""


@query("b49_exponentially_weighted", _EWM + """,
    s AS (SELECT event_id, sum(w) AS sw, sum(w * w) AS sw2, sum(w * x) / sum(w) AS m, sum(w * x * x) / sum(w) AS q, sum(w * h * x) AS recursive, count(*) AS n FROM w GROUP BY 1)
    SELECT event_id, round(m, 6) AS mean, round(CASE WHEN n > 1 THEN (q - m * m) * sw * sw / (sw * sw - sw2) END + 1e-6, 4) AS var FROM s""")
def exponentially_weighted(t):
    out = rolling.exponential(_events(t), BY, ORDER, {"mean": ("mean", "value"), "var": ("var", "value")}, span=10)
    return _rounded(out.select("event_id", "mean", (F.col("var") + 1e-6).alias("var")), 6, var=4)


@query("b49_exponentially_weighted_recursive", _EWM + " SELECT event_id, round(sum(w * h * x), 6) AS mean FROM w GROUP BY 1")
def exponentially_weighted_recursive(t):
    out = rolling.exponential(_events(t), BY, ORDER, {"mean": ("mean", "value")}, adjust=False, span=10)
    return _rounded(out.select("event_id", "mean"))


_SPARSE = "SELECT event_id, user_id, ts, CASE WHEN event_id % 3 <> 0 THEN value END AS x FROM events"


def _sparse(t):
    return t.events.select("event_id", "user_id", "ts", F.expr("if(event_id % 3 <> 0, value, null)").alias("x"))


@query("b49_exponentially_weighted_with_nulls", f"""
    WITH p AS (SELECT event_id, user_id, x, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM ({_SPARSE}))
    SELECT a.event_id, CASE WHEN count(b.x) >= 60 THEN round(sum(pow(1 - 2 / 11.0, a.i - b.i) * b.x) / sum(pow(1 - 2 / 11.0, a.i - b.i)), 6) END AS late,
           CASE WHEN count(b.x) >= 1 THEN round(sum(pow(1 - 2 / 11.0, a.i - b.i) * b.x) / sum(pow(1 - 2 / 11.0, a.i - b.i)), 6) END AS mean
    FROM p a LEFT JOIN p b ON a.user_id = b.user_id AND b.i <= a.i AND b.x IS NOT NULL GROUP BY 1""")
def exponentially_weighted_with_nulls(t):
    # read for the cut points and the rows of the second pass
    first = settle(rolling.exponential(_sparse(t), BY, ORDER, {"mean": ("mean", "x")}, span=10), "weighted")
    out = rolling.exponential(first, BY, ORDER, {"late": ("mean", "x")}, min_periods=60, span=10)
    return _rounded(out.select("event_id", "mean", "late"))


@query("b49_exponentially_weighted_ignoring_nulls", f"""
    WITH p AS (SELECT event_id, user_id, x, row_number() OVER w AS i, count(x) OVER w AS k FROM ({_SPARSE}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT a.event_id, CASE WHEN count(b.x) >= 1 THEN round(sum(pow(1 - 2 / 11.0, a.k - b.k) * CASE WHEN b.k = 1 THEN 1 ELSE 2 / 11.0 END * b.x), 6) END AS mean
    FROM p a LEFT JOIN p b ON a.user_id = b.user_id AND b.i <= a.i AND b.x IS NOT NULL GROUP BY 1""")
def exponentially_weighted_ignoring_nulls(t):
    return _rounded(rolling.exponential(_sparse(t), BY, ORDER, {"mean": ("mean", "x")}, adjust=False, ignore_na=True, span=10).select("event_id", "mean"))


_KEYLESS = "SELECT event_id, ts, value, CASE WHEN event_id % 5 <> 0 THEN user_id END AS u FROM events"


@query("b44_shift_and_rolling_with_null_keys", f"""
    SELECT event_id, CASE WHEN u IS NOT NULL THEN lag(value) OVER w END AS before,
           CASE WHEN u IS NOT NULL THEN round(avg(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) END AS mean
    FROM ({_KEYLESS}) WINDOW w AS (PARTITION BY u ORDER BY ts, event_id)""")
def shift_and_rolling_with_null_keys(t):
    keyless = t.events.select("event_id", "ts", "value", F.expr("if(event_id % 5 <> 0, user_id, null)").alias("u"))
    shifted = ranks.shift(keyless, ["u"], ORDER, {"before": ("value", 1)})
    out = rolling.rolling_rows(shifted, ["u"], ORDER, 3, {"mean": ("mean", "value")}, min_periods=1)
    return out.select("event_id", "before", F.round("mean", 6).alias("mean"))


@query("b42_rank_of_dates_with_nulls", """
    SELECT o_orderkey, rank() OVER (ORDER BY d NULLS FIRST) AS top, rank() OVER (ORDER BY d NULLS LAST) AS bottom
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate::DATE END AS d FROM orders)""")
def rank_of_dates_with_nulls(t):
    dated = t.orders.select("o_orderkey", F.expr("if(o_orderkey % 4 <> 0, to_date(o_orderdate), null)").alias("d"))
    return ranks.rank(ranks.rank(dated, [], "d", "top", "min", nulls="top"), [], "d", "bottom", "min", nulls="bottom").select("o_orderkey", "top", "bottom")


@query("b50_weighted_rolling", """
    SELECT event_id, round((lag(value, 4) OVER w / 3 + lag(value, 3) OVER w * 2 / 3 + lag(value, 2) OVER w + lag(value) OVER w * 2 / 3 + value / 3) / 3, 6) AS m
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def weighted_rolling(t):
    out = rolling.rolling_weighted(_events(t), BY, ORDER, "value", rolling.triangular_weights(5), "m")
    return _rounded(out.select("event_id", "m"))


def _cosines(*a):
    return "(" + " + ".join(f"{(-1) ** k * x} * cos({k} * 2 * pi() * (8 - b) / 8)" for k, x in enumerate(a)) + ")"


_SHAPES = {
    "hamming": _cosines(0.54, 0.46), "blackman": _cosines(0.42, 0.5, 0.08), "nuttall": _cosines(0.3635819, 0.4891775, 0.1365995, 0.0106411), "bartlett": "(1 - abs(8 - 2 * b) / 8)",
    "bohman": "((1 - abs(b - 4) / 4) * cos(pi() * abs(b - 4) / 4) + sin(pi() * abs(b - 4) / 4) / pi())", "parzen": "CASE WHEN abs(b - 4) * 4 <= 9 THEN 1 - 6 * pow(2 * abs(b - 4) / 9, 2) * (1 - 2 * abs(b - 4) / 9) ELSE 2 * pow(1 - 2 * abs(b - 4) / 9, 3) END",
    "gaussian": "exp(-0.5 * pow((b - 4) / 2.0, 2))"}


@query("b50_window_shapes", f"""
    WITH p AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
         w AS (SELECT p.event_id, q.value, p.i - q.i AS b FROM p JOIN p AS q ON p.user_id = q.user_id AND q.i BETWEEN p.i - 8 AND p.i AND p.i >= 9)
    SELECT event_id, {', '.join(f"round(sum({w} * value) / sum({w}) + 1e-8, 5) AS {name}" for name, w in _SHAPES.items())} FROM w GROUP BY 1""")
def window_shapes(t):
    weights = {name: rolling.window_weights(name, 9, *([2.0] if name == "gaussian" else [])) for name in _SHAPES}
    out = rolling.rolling_shapes(_events(t), BY, ORDER, "value", weights)
    return out.filter("hamming IS NOT NULL").select("event_id", *[F.round(F.col(c) + 1e-8, 5).alias(c) for c in _SHAPES])


@query("b90_autocorrelation", """
    SELECT user_id, round(corr(value, p), 6) + 0.0 AS autocorr FROM
      (SELECT user_id, value, lag(value, 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) GROUP BY 1""")
def autocorrelation(t):
    return _rounded(rolling.autocorrelation(_events(t), BY, ORDER, "value", 2))


@query("b76_sort_with_null_position", """
    SELECT c_custkey, b, row_number() OVER (ORDER BY b DESC NULLS LAST, c_custkey) AS place FROM
      (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS b FROM customer)""")
def sort_with_null_position(t):
    """Sorted output made visible by each row's place in it."""
    from ..operators.ordered import position

    c = t.customer.select("c_custkey", F.expr("if(c_acctbal > 0, c_acctbal, null)").alias("b"))
    keyed = c.withColumn("_neg", F.coalesce(-F.col("b"), F.lit(float("inf"))))
    placed = position(keyed, [], ["_neg", "c_custkey"], "place").withColumn("place", F.col("place") + 1)
    return placed.select("c_custkey", "b", "place").orderBy(F.desc_nulls_last("b"), "c_custkey")


@query("b77_head_slice", "SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20 OFFSET 40")
def head_slice(t):
    return t.orders.orderBy("o_orderdate", "o_orderkey").offset(40).limit(20).select("o_orderkey")
