"""Group-by, reducers, quantiles, modes, counts and correlations on the benchmark tables.

Where a mean of short decimals can end in an exact half, a tiny constant is added on both sides before rounding.
"""

import pandas as pd
from pyspark.sql import functions as F

from ..operators import grouping, ranks, stats
from .registry import query

_NET = "l_extendedprice * (1 - l_discount)"


@query("b25_group_by_without_null_keys", """
    SELECT nullif(l_returnflag, 'N') AS flag, l_linestatus, round(sum(l_quantity), 2) AS qty FROM lineitem
    WHERE l_returnflag <> 'N' GROUP BY 1, 2""")
def group_by_without_null_keys(t):
    rows = t.lineitem.withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    return rows.filter("flag is not null").groupBy("flag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("qty"))


@query("b26_sum_min_max_first_last", """
    SELECT user_id, round(sum(value), 2) AS total, min(value) AS low, max(value) AS high, arg_min(value, ts) AS first_value,
           arg_max(value, ts) AS last_value, round(product(1 + value / 1000), 6) AS growth FROM events GROUP BY 1""")
def sum_min_max(t):
    return t.events.groupBy("user_id").agg(
        F.round(F.sum("value"), 2).alias("total"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.min_by("value", "ts").alias("first_value"), F.max_by("value", "ts").alias("last_value"),
        F.round(F.product(1 + F.col("value") / 1000), 6).alias("growth"))


@query("b27_mean_spread_by_group", """
    SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 4) AS mean, round(var_samp(l_quantity), 4) AS var,
           round(stddev_samp(l_quantity), 6) AS std, round(stddev_samp(l_quantity) / sqrt(count(l_quantity)), 6) AS sem FROM lineitem GROUP BY 1, 2""")
def mean_spread(t):
    x = F.col("l_quantity")
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.avg(x), 4).alias("mean"), F.round(F.var_samp(x), 4).alias("var"), F.round(F.stddev_samp(x), 6).alias("std"),
        F.round(F.stddev_samp(x) / F.sqrt(F.count(x)), 6).alias("sem"))


@query("b27_grouped_median", """
    SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS quantile, 0.5::DOUBLE AS share FROM lineitem GROUP BY 1""")
def grouped_median(t):
    return ranks.quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", [0.5])


@query("b28_size_count_nunique_any_all", """
    SELECT o_custkey, count(*) AS size, count(nullif(o_orderstatus, 'P')) AS n, count(DISTINCT o_orderpriority) AS n_priorities,
           bool_or(o_totalprice > 400000) AS any_big, bool_and(o_totalprice > 50000) AS all_big FROM orders GROUP BY 1""")
def size_count(t):
    return t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("size"), F.count(F.nullif("o_orderstatus", F.lit("P"))).alias("n"), F.count_distinct("o_orderpriority").alias("n_priorities"),
        F.bool_or(F.col("o_totalprice") > 400000).alias("any_big"), F.bool_and(F.col("o_totalprice") > 50000).alias("all_big"))


@query("b29_multi_aggregate", f"""
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum({_NET}), 2) AS revenue,
           round(avg(l_discount), 6) AS avg_discount, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-09-02' GROUP BY 1, 2""")
def multi_aggregate(t):
    kept = t.lineitem.filter(F.col("l_shipdate") <= F.expr("timestamp_ntz'2000-09-02'"))
    return kept.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.expr(_NET)), 2).alias("revenue"),
        F.round(F.avg("l_discount"), 6).alias("avg_discount"), F.count("*").alias("n"))


@query("b30_group_transform", """
    SELECT o_orderkey, round(o_totalprice / sum(o_totalprice) OVER (PARTITION BY o_custkey), 8) AS share,
           round(o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_custkey) + 1e-6, 4) + 0.0 AS centred FROM orders""")
def group_transform(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    w = grouping.transform(o, ["o_custkey"], total=F.sum("o_totalprice"), mean=F.avg("o_totalprice"))
    return w.select("o_orderkey", F.round(F.col("o_totalprice") / F.col("total"), 8).alias("share"),
                    F.round(F.col("o_totalprice") - F.col("mean") + 1e-6, 4).alias("centred"))


@query("b31_group_filter", """
    SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN
      (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING sum(l_quantity) > 150)""")
def group_filter(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return grouping.keep_groups(rows, ["l_orderkey"], F.sum("l_quantity") > 150)


@query("b32_group_apply", """
    SELECT user_id, round(regr_slope(value, epoch(ts) / 86400), 5) + 0.0 AS slope FROM events GROUP BY 1""")
def group_apply(t):
    """Least-squares slope per user, from per-batch sums merged per user."""
    rows = t.events.select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 86400e6 - 19700).alias("x"), F.col("value").alias("y"))

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf.x, pdf.y
        return pd.DataFrame({"user_id": [pdf.user_id.iloc[0]], "n": [len(pdf)], "sx": [x.sum()], "sy": [y.sum()], "sxx": [(x * x).sum()], "sxy": [(x * y).sum()]})

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby("user_id", as_index=False).sum()

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        s = pdf.iloc[0]
        slope = (s.n * s.sxy - s.sx * s.sy) / (s.n * s.sxx - s.sx**2) if s.n > 1 else None
        return pd.DataFrame({"user_id": [int(s.user_id)], "slope": [slope]})

    sums = "user_id long, n long, sx double, sy double, sxx double, sxy double"
    out = grouping.apply_in_parts(rows, ["user_id"], part, sums, combine, finish, "user_id long, slope double")
    return out.select("user_id", F.round("slope", 5).alias("slope"))


@query("b32_whole_group_apply", """
    SELECT user_id, round(value - avg(value) OVER (PARTITION BY user_id) + 1e-8, 5) + 0.0 AS centred, event_id FROM events""")
def whole_group_apply(t):
    """Each row against its whole group: per-batch sums are merged per user, rows are centred next to them."""
    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"user_id": [pdf.user_id.iloc[0]], "n": [len(pdf)], "total": [pdf.value.sum()]})

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby("user_id", as_index=False).sum()

    def centre(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf[["user_id", "event_id"]].assign(centred=(pdf["value"] - pdf["total"] / pdf["n"] + 1e-8).round(5) + 0.0)

    rows = t.events.select("user_id", "event_id", "value")
    return grouping.apply_with_summary(rows, ["user_id"], part, "user_id long, n long, total double", combine, centre, "user_id long, event_id long, centred double")


@query("b33_head_per_group", """
    SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 2""")
def head_per_group(t):
    return grouping.head(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 2).drop("o_orderdate")


@query("b33_tail_and_nth", """
    SELECT 'tail' AS pick, o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 2
    UNION ALL
    SELECT 'third' AS pick, o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 3""")
def tail_and_nth(t):
    o, order = t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"]
    last = grouping.tail(o, ["o_custkey"], order, 2).withColumn("pick", F.lit("tail"))
    third = grouping.nth(o, ["o_custkey"], order, 2).withColumn("pick", F.lit("third"))
    return last.unionByName(third).drop("o_orderdate")


@query("b34_open_high_low_close", """
    SELECT date_trunc('day', ts) AS day, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close FROM events GROUP BY 1""")
def open_high_low_close(t):
    daily = t.events.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    return grouping.open_high_low_close(daily, ["day"], ["ts", "event_id"], "value")


@query("b35_describe", """
    SELECT l_linestatus, count(l_quantity) AS count, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS std, min(l_quantity) AS min,
           max(l_quantity) AS max, quantile_cont(l_quantity, 0.25) AS q25, quantile_cont(l_quantity, 0.5) AS q50, quantile_cont(l_quantity, 0.75) AS q75
    FROM lineitem GROUP BY 1""")
def describe(t):
    return stats.describe(t.lineitem, ["l_linestatus"], "l_quantity").withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query("b35_describe_labels", """
    WITH c AS (SELECT c_mktsegment AS v, count(*) AS n FROM customer GROUP BY 1)
    SELECT sum(n)::BIGINT AS count, count(*) AS "unique", arg_min(v, (-n, v)) AS top, max(n) AS freq FROM c""")
def describe_labels(t):
    return stats.describe_labels(t.customer, "c_mktsegment")


@query("b35_describe_leaves_out_null_groups", """
    SELECT o_orderpriority, count(*) AS count, round(avg(o_totalprice), 4) AS mean, min(o_totalprice) AS min, max(o_totalprice) AS max, round(quantile_cont(o_totalprice, 0.5), 4) AS q50
    FROM (SELECT o_totalprice, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders) WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def describe_leaves_out_null_groups(t):
    rows = t.orders.select("o_totalprice", F.expr("if(o_orderkey % 3 <> 0, o_orderpriority, null)").alias("o_orderpriority"))
    out = stats.describe(rows, ["o_orderpriority"], "o_totalprice")
    return out.select("o_orderpriority", "count", F.round("mean", 4).alias("mean"), "min", "max", F.round("q50", 4).alias("q50"))


@query("b36_whole_table_reducers", """
    SELECT count(o_totalprice) AS n, round(sum(o_totalprice), 2) AS sum, round(avg(o_totalprice), 4) AS mean, min(o_totalprice) AS min, max(o_totalprice) AS max,
           round(stddev_samp(o_totalprice), 4) AS std, round(stddev_samp(o_totalprice) / sqrt(count(*)), 4) AS sem,
           round(skewness(o_totalprice), 6) + 0.0 AS skew, round(kurtosis(o_totalprice), 6) AS kurt,
           (SELECT round(avg(abs(o_totalprice - m)), 4) FROM orders, (SELECT avg(o_totalprice) AS m FROM orders)) AS mad FROM orders""")
def whole_table_reducers(t):
    # both sides of this join are one row
    out = stats.moments(t.orders, [], "o_totalprice").join(F.broadcast(stats.mean_abs_deviation(t.orders, [], "o_totalprice")))
    digits = {"sum": 2, "mean": 4, "std": 4, "sem": 4, "skew": 6, "kurt": 6, "mad": 4}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()}).drop("prod", "var")


@query("b36_grouped_moments", """
    SELECT event_type, round(skewness(value), 6) AS skew, round(kurtosis(value), 6) AS kurt, round(product(1 + value / 1000), 4) AS growth FROM events GROUP BY 1""")
def grouped_moments(t):
    out = stats.moments(t.events, ["event_type"], "value").select("event_type", F.round("skew", 6).alias("skew"), F.round("kurt", 6).alias("kurt"))
    growth = t.events.groupBy("event_type").agg(F.round(F.product(1 + F.col("value") / 1000), 4).alias("growth"))
    return out.join(growth, "event_type")


@query("b37_quantiles_by_group", """
    SELECT event_type, share, round(CASE share WHEN 0.1 THEN a WHEN 0.5 THEN b ELSE c END, 6) AS quantile FROM
      (SELECT event_type, quantile_cont(value, 0.1) AS a, quantile_cont(value, 0.5) AS b, quantile_cont(value, 0.99) AS c FROM events GROUP BY 1),
      (SELECT unnest([0.1, 0.5, 0.99]::DOUBLE[]) AS share)""")
def quantiles_by_group(t):
    return ranks.quantiles(t.events, ["event_type"], "value", [0.1, 0.5, 0.99]).withColumn("quantile", F.round("quantile", 6))


@query("b37_quantile_interpolations", """
    WITH n AS (SELECT list(p_retailprice ORDER BY p_retailprice) AS v, count(*) AS n FROM part),
         r AS (SELECT v, 0.37 * (n - 1) AS r FROM n)
    SELECT v[floor(r)::INT + 1] AS lower, v[ceil(r)::INT + 1] AS higher, round((v[floor(r)::INT + 1] + v[ceil(r)::INT + 1]) / 2, 6) AS midpoint,
           v[round_even(r, 0)::INT + 1] AS nearest FROM r""")
def quantile_interpolations(t):
    kinds = ("lower", "higher", "midpoint", "nearest")
    long = None
    for kind in kinds:
        one = ranks.quantiles(t.part, [], "p_retailprice", [0.37], kind).select(F.lit(kind).alias("kind"), F.round("quantile", 6).alias("quantile"))
        long = one if long is None else long.unionByName(one)
    return long.groupBy().pivot("kind", list(kinds)).agg(F.first("quantile"))


@query("b38_mode", """
    SELECT l_returnflag, l_quantity, n FROM (SELECT l_returnflag, l_quantity, count(*) AS n, rank() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC) AS r
      FROM lineitem GROUP BY 1, 2) WHERE r = 1""")
def mode(t):
    return stats.modes(t.lineitem, ["l_returnflag"], "l_quantity")


@query("b39_key_of_extreme", """
    SELECT c_nationkey, arg_min(c_custkey, (c_acctbal, c_custkey)) AS idxmin, arg_max(c_custkey, (c_acctbal, -c_custkey)) AS idxmax FROM customer GROUP BY 1""")
def key_of_extreme(t):
    key, bal = F.col("c_custkey"), F.col("c_acctbal")
    return t.customer.groupBy("c_nationkey").agg(
        F.min_by(key, F.struct(bal, key)).alias("idxmin"), F.max_by(key, F.struct(bal, -key)).alias("idxmax"))


@query("b40_value_counts", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY o_orderstatus), 8) AS share FROM orders GROUP BY 1, 2""")
def value_counts(t):
    return stats.value_counts(t.orders, ["o_orderstatus"], "o_orderpriority").withColumn("share", F.round("share", 8))


@query("b40_value_counts_binned", """
    SELECT CASE WHEN p_size <= 10 THEN 0 WHEN p_size <= 20 THEN 1 WHEN p_size <= 50 THEN 2 END AS bin, count(*) AS n FROM part WHERE p_size > 0 GROUP BY 1""")
def value_counts_binned(t):
    from ..operators.reshape import cut

    binned = t.part.select(cut(F.col("p_size"), [0, 10, 20, 50]).alias("bin"))
    return stats.value_counts(binned, [], "bin").select("bin", "n")


_PAIRS = [("l_quantity", "l_quantity"), ("l_quantity", "l_discount"), ("l_quantity", "l_extendedprice"), ("l_discount", "l_discount"),
          ("l_discount", "l_extendedprice"), ("l_extendedprice", "l_extendedprice")]


@query("b41_correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) + 0.0 AS corr, round(covar_samp({a}, {b}), 4) + 0.0 AS cov FROM lineitem" for a, b in _PAIRS))
def correlation_matrix(t):
    out = stats.correlation_pairs(t.lineitem, ["l_quantity", "l_discount", "l_extendedprice"])
    return out.withColumns({"corr": F.round("corr", 8), "cov": F.round("cov", 4)})


@query("b41_spearman", """
    WITH r AS (SELECT (rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2) AS rx,
                      (rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2) AS ry FROM lineitem)
    SELECT round(corr(rx, ry), 8) AS corr FROM r""")
def spearman(t):
    out = stats.correlation_pairs(t.lineitem, ["l_quantity", "l_extendedprice"], fn="spearman")
    return out.filter("a <> b").select(F.round("corr", 8).alias("corr"))


@query("b41_kendall", """
    WITH c AS (SELECT round(c_acctbal / 500) AS x, c_nationkey AS y, c_custkey AS k FROM customer),
         p AS (SELECT sign(a.x - b.x) AS dx, sign(a.y - b.y) AS dy FROM c a JOIN c b ON a.k < b.k)
    SELECT round(sum(dx * dy) / sqrt(sum(dx * dx) * sum(dy * dy)), 10) + 0.0 AS kendall FROM p""")
def kendall(t):
    rows = t.customer.select(F.round(F.col("c_acctbal") / 500).alias("x"), F.col("c_nationkey").alias("y"))
    return stats.kendall(rows, "x", "y").withColumn("kendall", F.round("kendall", 10))


@query("b75_vector_dot", """
    SELECT e.vec_id, e.label, round(list_dot_product(e.embedding::DOUBLE[], m.c), 6) + 0.0 AS dot FROM embeddings e JOIN
      (SELECT label, list(a ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS a FROM (SELECT label, unnest(embedding)::DOUBLE AS x,
         generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY 1) m USING (label)""")
def vector_dot(t):
    """Dot product of each vector with the mean vector of its label: means in long form, products row-wise."""
    e = t.embeddings
    long = e.select("label", F.posexplode("embedding").alias("i", "x"))
    means = long.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("a"))
    # one array per label, its length is the vector's dimension
    centre = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "a"))).alias("c"))
    joined = e.join(centre, "label")
    dot = F.aggregate(F.zip_with("embedding", F.col("c.a"), lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, v: s + v)
    return joined.select("vec_id", "label", F.round(dot, 6).alias("dot"))


@query("b75_matrix_product", """
    WITH m AS (SELECT c_nationkey AS i, c_mktsegment AS k, sum(c_acctbal) AS a FROM customer GROUP BY 1, 2),
         n AS (SELECT c_mktsegment AS k, o_orderpriority AS j, count(*) AS b FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
    SELECT i, j, round(sum(a * b), 2) AS v FROM m JOIN n USING (k) GROUP BY 1, 2""")
def matrix_product(t):
    m = t.customer.groupBy(F.col("c_nationkey").alias("i"), F.col("c_mktsegment").alias("k")).agg(F.sum("c_acctbal").alias("a"))
    both = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    n = both.groupBy(F.col("c_mktsegment").alias("k"), F.col("o_orderpriority").alias("j")).agg(F.count("*").alias("b"))
    return m.join(n, "k").groupBy("i", "j").agg(F.round(F.sum(F.col("a") * F.col("b")), 2).alias("v"))


@query("b74_null_arithmetic", """
    SELECT c_custkey, round(abs(c_acctbal), 0) AS a, CASE WHEN c_acctbal > 0 THEN c_acctbal END + c_nationkey AS b,
           (c_acctbal > 100) AS c, round_even(c_acctbal, 1) AS d FROM customer""")
def null_arithmetic(t):
    bal = F.col("c_acctbal")
    return t.customer.select("c_custkey", F.round(F.abs(bal), 0).alias("a"), (F.when(bal > 0, bal) + F.col("c_nationkey")).alias("b"),
                             (bal > 100).alias("c"), F.bround(bal, 1).alias("d"))


@query("b79_vectorised_user_function", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / l_quantity AS unit FROM lineitem")
def vectorised_user_function(t):
    @F.pandas_udf("double")
    def unit(price: pd.Series, quantity: pd.Series) -> pd.Series:
        return price / quantity

    return t.lineitem.transform(lambda df: df.select(
        "l_orderkey", "l_linenumber", "l_partkey", unit("l_extendedprice", "l_quantity").alias("unit")))


@query("b41_correlate_with", """
    WITH j AS (SELECT c_acctbal, s_acctbal, c_nationkey, s_nationkey FROM customer JOIN supplier ON c_custkey = s_suppkey)
    SELECT 'acctbal' AS "column", round(corr(c_acctbal, s_acctbal), 8) AS corr FROM j UNION ALL SELECT 'nationkey', round(corr(c_nationkey, s_nationkey), 8) FROM j""")
def correlate_with(t):
    left = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("nationkey"))
    right = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey"))
    return stats.correlate_with(left, right, ["k"], ["acctbal", "nationkey"]).withColumn("corr", F.round("corr", 8))
