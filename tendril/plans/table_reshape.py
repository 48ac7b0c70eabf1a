"""Pivots, reshaping, binning, indicators and nested records on the benchmark tables."""

from pyspark.sql import functions as F

from ..operators import ranks, reshape
from .registry import query


@query("b57_pivot_table_margins", """
    WITH l AS (SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem)
    SELECT coalesce(l_returnflag, 'All') AS l_returnflag, round(avg(l_quantity) FILTER (l_linestatus = 'F'), 6) AS F,
           round(avg(l_quantity) FILTER (l_linestatus = 'O'), 6) AS O, round(avg(l_quantity), 6) AS "All" FROM l GROUP BY ROLLUP (l_returnflag)""")
def pivot_table_margins(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity")
    return reshape.pivot_table(rows, ["l_returnflag"], "l_linestatus", {"mean": F.round(F.avg("l_quantity"), 6)}, ["F", "O"], margins=True)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_SEGMENT_COLUMNS = ", ".join(f"count(*) FILTER (c_mktsegment = '{s}') AS {s}_n, round(sum(c_acctbal) FILTER (c_mktsegment = '{s}'), 2) AS {s}_total" for s in SEGMENTS)


@query("b57_pivot_table_two_aggregates", f"SELECT c_nationkey, {_SEGMENT_COLUMNS} FROM customer GROUP BY 1")
def pivot_table_two(t):
    aggs = {"n": F.count("*"), "total": F.round(F.sum("c_acctbal"), 2)}
    wide = reshape.pivot_table(t.customer, ["c_nationkey"], "c_mktsegment", aggs, SEGMENTS)
    return wide.na.fill(0, [f"{s}_n" for s in SEGMENTS])


@query("b58_pivot_unique", """
    SELECT user_id, max(v) FILTER (event_type = 'click') AS click, max(v) FILTER (event_type = 'error') AS error, max(v) FILTER (event_type = 'purchase') AS purchase,
           max(v) FILTER (event_type = 'signup') AS signup, max(v) FILTER (event_type = 'view') AS "view"
    FROM (SELECT user_id, event_type, max(value) AS v FROM events GROUP BY 1, 2) GROUP BY 1""")
def pivot_unique(t):
    long = t.events.groupBy("user_id", "event_type").agg(F.max("value").alias("v"))
    return reshape.pivot(long, ["user_id"], "event_type", "v", ["click", "error", "purchase", "signup", "view"])


@query("b59_crosstab_margins", """
    SELECT coalesce(o_orderpriority, 'All') AS o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
           count(*) FILTER (o_orderstatus = 'P') AS P, count(*) AS "All" FROM orders GROUP BY ROLLUP (o_orderpriority)""")
def crosstab_margins(t):
    return reshape.crosstab(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"], margins=True)


@query("b59_crosstab_normalised", """
    SELECT o_orderpriority, round(count(*) FILTER (o_orderstatus = 'F') / sum(count(*)) OVER (), 8) AS F, round(count(*) FILTER (o_orderstatus = 'O') / sum(count(*)) OVER (), 8) AS O,
           round(count(*) FILTER (o_orderstatus = 'P') / sum(count(*)) OVER (), 8) AS P FROM orders GROUP BY 1""")
def crosstab_normalised(t):
    out = reshape.crosstab(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"], normalize="all")
    return out.withColumns({c: F.round(c, 8) for c in ("F", "O", "P")})


@query("b60_melt", """
    SELECT l_orderkey, l_linenumber, l_partkey, measure, v FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax FROM lineitem)
    UNPIVOT (v FOR measure IN (l_quantity, l_discount, l_tax))""")
def melt(t):
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    return t.lineitem.unpivot(ids, ["l_quantity", "l_discount", "l_tax"], "measure", "v")


def _yearly(t):
    y = lambda n, a: F.round(F.sum(F.when(F.year("o_orderdate") == n, F.col("o_totalprice") if a else F.lit(1.0))), 2)
    return t.orders.groupBy("o_custkey").agg(*[y(n, a).alias(f"{'spend' if a else 'orders'}_{n}") for n in (1996, 1997) for a in (0, 1)])


_YEARLY = " UNION ALL ".join(
    f"SELECT o_custkey, '{n}' AS year, round(sum(CASE WHEN year(o_orderdate) = {n} THEN 1.0::DOUBLE END), 2) AS orders, "
    f"round(sum(CASE WHEN year(o_orderdate) = {n} THEN o_totalprice END), 2) AS spend FROM orders GROUP BY 1" for n in (1996, 1997))


@query("b61_wide_to_long", _YEARLY)
def wide_to_long(t):
    return reshape.wide_to_long(_yearly(t), ["orders", "spend"], ["o_custkey"], "year")


@query("b61_long_by_groups", f"SELECT o_custkey, n, s FROM (SELECT o_custkey, orders AS n, spend AS s FROM ({_YEARLY})) WHERE n IS NOT NULL AND s IS NOT NULL")
def long_by_groups(t):
    return reshape.long_by_groups(_yearly(t), {"n": ["orders_1996", "orders_1997"], "s": ["spend_1996", "spend_1997"]})


@query("b62_cut_equal_width", """
    WITH e AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
    SELECT c_custkey, CASE WHEN c_acctbal <= lo + (hi - lo) / 4 THEN 0 WHEN c_acctbal <= lo + 2 * ((hi - lo) / 4) THEN 1
           WHEN c_acctbal <= lo + 3 * ((hi - lo) / 4) THEN 2 ELSE 3 END AS bin FROM customer, e""")
def cut_equal_width(t):
    edges = reshape.equal_width_edges(t.customer, "c_acctbal", 4)
    return t.customer.select("c_custkey", reshape.cut(F.col("c_acctbal"), edges).alias("bin"))


@query("b62_cut_left_closed", """
    SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_quantity >= 1 AND l_quantity < 10 THEN 0 WHEN l_quantity >= 10 AND l_quantity < 30 THEN 1
           WHEN l_quantity >= 30 AND l_quantity < 45 THEN 2 END AS bin FROM lineitem""")
def cut_left_closed(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", reshape.cut(F.col("l_quantity"), [1, 10, 30, 45], right=False).alias("bin"))


@query("b63_quantile_bins", """
    WITH e AS (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS q FROM orders)
    SELECT o_orderkey, CASE WHEN o_totalprice <= q[1] THEN 0 WHEN o_totalprice <= q[2] THEN 1 WHEN o_totalprice <= q[3] THEN 2 ELSE 3 END AS bin FROM orders, e""")
def quantile_bins(t):
    return reshape.qcut(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 4).select("o_orderkey", "bin")


@query("b64_dummies", """
    SELECT o_orderkey, (o_orderstatus = 'O')::INT AS status_O, (o_orderstatus = 'P')::INT AS status_P FROM orders""")
def dummies(t):
    return reshape.dummies(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O", "P"], "status", drop_first=True)


# All words of the part names.
WORDS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new", "old", "plate", "red", "ring", "rod", "small", "widget"]


@query("b64_split_dummies", f"""
    SELECT p_partkey, {', '.join(f"list_contains(w, '{x}')::INT AS {x}" for x in WORDS)} FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""")
def split_dummies(t):
    return reshape.split_dummies(t.part.select("p_partkey", "p_name"), "p_name", WORDS, " ").select("p_partkey", *WORDS)


@query("b65_factorize", """
    WITH f AS (SELECT p_brand, row_number() OVER (ORDER BY min(p_partkey)) - 1 AS code FROM part WHERE p_size > 10 GROUP BY 1)
    SELECT p_partkey, coalesce(code, -1) AS code FROM part LEFT JOIN f ON part.p_brand = f.p_brand AND p_size > 10""")
def factorize(t):
    parts = t.part.select("p_partkey", F.expr("if(p_size > 10, p_brand, null)").alias("brand"))
    return ranks.first_seen_codes(parts, "brand", "p_partkey").select("p_partkey", "code")


@query("b66_json_normalise", "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def json_normalise(t):
    return reshape.normalize_json(t.events.select("event_id", "props"), "props", "k long")


@query("b66_json_records", """
    SELECT o_orderkey, o_orderstatus AS head_status, line AS n, o_totalprice * line AS price_amount FROM orders, (SELECT unnest([1, 2]::BIGINT[]) AS line)""")
def json_records(t):
    """Record path and meta fields, from JSON text built out of each order."""
    record = lambda n: F.struct(F.lit(n).cast("long").alias("n"), F.struct((F.col("o_totalprice") * n).alias("amount")).alias("price"))
    nested = F.struct(F.struct(F.col("o_orderstatus").alias("status")).alias("head"), F.array(record(1), record(2)).alias("lines"))
    docs = t.orders.select("o_orderkey", F.to_json(nested).alias("doc"))
    schema = "head struct<status: string>, lines array<struct<n: bigint, price: struct<amount: double>>>"
    return reshape.normalize_json(docs, "doc", schema, path="lines", meta=["head.status"])
