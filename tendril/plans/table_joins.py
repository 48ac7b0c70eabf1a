"""Joins, set operations, filters and missing data on the benchmark tables."""

from pyspark.sql import functions as F

from ..operators import fills, grouping, joins, ranks, reshape
from ..operators.profile import select_types
from .registry import query

NULLED = "if({0} < 0, null, {0})"


@query("b01_merge_null_keys", """
    SELECT l.k, l.total AS total_x, r.total AS total_y FROM
      (SELECT nullif(c_nationkey, 7) AS k, round(sum(c_acctbal), 2) AS total FROM customer GROUP BY 1) l
      JOIN (SELECT nullif(s_nationkey, 7) AS k, round(sum(s_acctbal), 2) AS total FROM supplier GROUP BY 1) r
      ON l.k IS NOT DISTINCT FROM r.k""")
def merge_null_keys(t):
    left = t.customer.groupBy(F.nullif("c_nationkey", F.lit(7)).alias("k")).agg(F.round(F.sum("c_acctbal"), 2).alias("total"))
    right = t.supplier.groupBy(F.nullif("s_nationkey", F.lit(7)).alias("k")).agg(F.round(F.sum("s_acctbal"), 2).alias("total"))
    return joins.merge(left, right, ["k"])


@query("b01_merge_two_key_names", """
    SELECT o_orderkey, o_custkey, c_custkey, c_mktsegment FROM orders LEFT JOIN
      (SELECT * FROM customer WHERE c_acctbal > 5000) ON o_custkey = c_custkey""")
def merge_two_key_names(t):
    rich = t.customer.filter("c_acctbal > 5000").select("c_custkey", "c_mktsegment")
    return joins.merge(t.orders.select("o_orderkey", "o_custkey"), rich, how="left", left_on=["o_custkey"], right_on=["c_custkey"])


@query("b02_merge_indicator", """
    WITH o AS (SELECT o_custkey AS custkey, count(*) AS n_orders FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
         c AS (SELECT c_custkey AS custkey, c_name FROM customer WHERE c_acctbal > 0)
    SELECT custkey, n_orders, c_name,
           CASE WHEN n_orders IS NULL THEN 'right_only' WHEN c_name IS NULL THEN 'left_only' ELSE 'both' END AS _merge
    FROM o FULL JOIN c USING (custkey)""")
def merge_indicator(t):
    o = t.orders.filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("custkey")).agg(F.count("*").alias("n_orders"))
    c = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("custkey"), "c_name")
    return joins.merge(o, c, ["custkey"], "outer", indicator="_merge")


@query("b03_repeated_keys", """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def repeated_keys(t):
    return joins.repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("b03_checked_merge", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def checked_merge(t):
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return joins.checked_merge(t.orders.select("o_orderkey", "o_custkey"), c, ["o_custkey"], "m:1").select("o_orderkey", "c_name")


def _sides(t):
    left = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = t.events.filter("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click_id"), F.col("value").alias("click_value"))
    return left, right


_ASOF = """
    WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
         r AS (SELECT user_id, ts, event_id AS click_id, value AS click_value FROM events WHERE event_type = 'click')"""


@query("b04_asof_backward", _ASOF + """
    SELECT l.*, r.ts AS ts_right, click_id, click_value FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts""")
def asof_backward(t):
    return joins.asof_join(*_sides(t), "ts", ["user_id"], tie="click_id")


@query("b04_asof_forward", _ASOF + """
    SELECT l.*, r.ts AS ts_right, click_id, click_value FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts <= r.ts""")
def asof_forward(t):
    return joins.asof_join(*_sides(t), "ts", ["user_id"], "forward", tie="click_id")


@query("b04_asof_nearest_tolerance", _ASOF + """,
    b AS (SELECT l.event_id, r.ts AS bts, click_id AS bid, click_value AS bv FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts),
    f AS (SELECT l.event_id, r.ts AS fts, click_id AS fid, click_value AS fv FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts <= r.ts),
    p AS (SELECT l.*, bts IS NULL OR (epoch_us(fts) - epoch_us(ts)) < (epoch_us(ts) - epoch_us(bts)) AS ahead, bts, bid, bv, fts, fid, fv
          FROM l JOIN b USING (event_id) JOIN f USING (event_id)),
    q AS (SELECT event_id, user_id, ts, CASE WHEN ahead THEN fts ELSE bts END AS m, CASE WHEN ahead THEN fid ELSE bid END AS i,
                 CASE WHEN ahead THEN fv ELSE bv END AS v FROM p),
    k AS (SELECT *, abs(epoch_us(m) - epoch_us(ts)) <= 21600000000 AS near FROM q)
    SELECT event_id, user_id, ts, CASE WHEN near THEN m END AS ts_right, CASE WHEN near THEN i END AS click_id,
           CASE WHEN near THEN v END AS click_value FROM k""")
def asof_nearest(t):
    from datetime import timedelta

    return joins.asof_join(*_sides(t), "ts", ["user_id"], "nearest", timedelta(hours=6), tie="click_id")


_HOURLY = """
    WITH c AS (SELECT date_trunc('hour', ts) AS h, round(sum(value), 2) AS v FROM events WHERE event_type = 'click' GROUP BY 1),
         p AS (SELECT date_trunc('hour', ts) AS h, round(sum(value), 2) AS v FROM events WHERE event_type = 'purchase' GROUP BY 1)"""


def _hourly(t, kind):
    return t.events.filter(F.col("event_type") == kind).groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")).agg(
        F.round(F.sum("value"), 2).alias("v"))


@query("b05_ordered_merge", _HOURLY + """
    SELECT h, last_value(c.v IGNORE NULLS) OVER w AS v_x, last_value(p.v IGNORE NULLS) OVER w AS v_y
    FROM c FULL JOIN p USING (h) WINDOW w AS (ORDER BY h)""")
def ordered_merge(t):
    return joins.ordered_merge(_hourly(t, "click"), _hourly(t, "purchase"), "h")


@query("b05_ordered_merge_by_group", """
    WITH c AS (SELECT event_type AS g, date_trunc('hour', ts) AS h, sum(value) AS v FROM events WHERE event_type <> 'click' GROUP BY 1, 2),
         p AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1),
         r AS (SELECT * FROM p, (SELECT DISTINCT g FROM c))
    SELECT g, h, round(last_value(c.v IGNORE NULLS) OVER w, 6) AS v, last_value(r.n IGNORE NULLS) OVER w AS n FROM c FULL JOIN r USING (g, h) WINDOW w AS (PARTITION BY g ORDER BY h)""")
def ordered_merge_by_group(t):
    """Every other type's hours merged with the hours of all clicks."""
    hours = t.events.withColumn("h", F.date_trunc("hour", "ts"))
    left = hours.filter("event_type <> 'click'").groupBy(F.col("event_type").alias("g"), "h").agg(F.sum("value").alias("v"))
    right = hours.filter("event_type = 'click'").groupBy("h").agg(F.count("*").alias("n"))
    return joins.ordered_merge(left, right, "h", left_by=["g"]).withColumn("v", F.round("v", 6))


@query("b06_index_join", "SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def index_join(t):
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "n_name", "r_name")


@query("b07_cartesian_product", """
    SELECT n_name, o_orderpriority FROM nation, (SELECT DISTINCT o_orderpriority FROM orders)""")
def cartesian_product(t):
    """All combinations: the product is what is asked for; both factors are reduced first."""
    return t.nation.select("n_name").crossJoin(t.orders.select("o_orderpriority").distinct())


@query("b08_concat_keyed", """
    SELECT 'open' AS source, o_orderkey, o_totalprice, NULL AS o_orderdate FROM orders WHERE o_orderstatus = 'O'
    UNION ALL BY NAME SELECT 'final' AS source, o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'
    UNION ALL BY NAME SELECT 'partial' AS source, o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'P'""")
def concat_keyed(t):
    return joins.concat_keyed({
        "open": t.orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice"),
        "final": t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderdate"),
        "partial": t.orders.filter("o_orderstatus = 'P'").select("o_orderkey", "o_totalprice", "o_orderdate"),
    })


@query("b08_concat_inner_columns", """
    SELECT 'customer' AS source, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
    UNION ALL SELECT 'supplier', s_nationkey, s_acctbal FROM supplier""")
def concat_inner(t):
    strip = lambda df: df.toDF(*[c.split("_", 1)[1] for c in df.columns])
    c, s = strip(t.customer).drop("name"), strip(t.supplier).drop("name")
    return joins.concat_keyed({"customer": c, "supplier": s}, inner=True)


@query("b08_concat_columns", """
    SELECT k, n_customers, n_suppliers FROM (SELECT c_nationkey AS k, count(*) AS n_customers FROM customer GROUP BY 1)
    FULL JOIN (SELECT s_nationkey AS k, count(*) AS n_suppliers FROM supplier GROUP BY 1) USING (k)""")
def concat_columns(t):
    c = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n_customers"))
    s = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("n_suppliers"))
    return joins.concat_columns(c, s, ["k"])


@query("b09_append", """
    SELECT c_name AS name, c_acctbal AS acctbal FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier""")
def append(t):
    c = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    return c.unionByName(t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal")))


def _balances(t):
    left = t.customer.select(F.col("c_custkey").alias("k"), F.expr("if(c_acctbal < 2000, null, c_acctbal)").alias("bal"), F.col("c_name").alias("name"))
    right = t.supplier.select(F.col("s_suppkey").alias("k"), F.expr("if(s_acctbal > 5000, null, s_acctbal)").alias("bal"), F.col("s_nationkey").alias("nation"))
    return left, right


_BALANCES = """
    WITH l AS (SELECT c_custkey AS k, CASE WHEN c_acctbal >= 2000 THEN c_acctbal END AS bal, c_name AS name FROM customer),
         r AS (SELECT s_suppkey AS k, CASE WHEN s_acctbal <= 5000 THEN s_acctbal END AS bal, s_nationkey AS nation FROM supplier)"""


@query("b10_combine_first", _BALANCES + """
    SELECT k, coalesce(l.bal, r.bal) AS bal, name, nation FROM l FULL JOIN r USING (k)""")
def combine_first(t):
    return joins.combine_first(*_balances(t), ["k"])


@query("b10_update", _BALANCES + "SELECT k, coalesce(r.bal, l.bal) AS bal, name FROM l LEFT JOIN r USING (k)")
def update(t):
    left, right = _balances(t)
    return joins.update(left, right, ["k"])


@query("b88_combine_cells", _BALANCES + """
    SELECT k, greatest(l.bal, r.bal) AS bal FROM l FULL JOIN r USING (k)""")
def combine_cells(t):
    left, right = _balances(t)
    return joins.combine(left.select("k", "bal"), right.select("k", "bal"), ["k"], F.greatest)


@query("b11_membership", """
    SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS is_urgent FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def membership(t):
    keys = t.customer.filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(keys, "o_custkey", "left_semi").select("o_orderkey", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_urgent"))


@query("b12_expression_filter", """
    SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem
    WHERE l_quantity > 40 AND l_returnflag = 'R'""")
def expression_filter(t):
    return t.lineitem.filter("l_quantity > 40 AND l_returnflag = 'R'").selectExpr(
        "l_orderkey", "l_linenumber", "round(l_extendedprice * (1 - l_discount), 4) AS net")


@query("b13_assign_rename_astype", """
    SELECT p_partkey AS id, upper(p_name) AS label, CAST(p_size AS DOUBLE) AS size, round(p_retailprice * 1.2, 2) AS gross FROM part""")
def assign_rename(t):
    return (t.part.withColumns({"label": F.upper("p_name"), "size": F.col("p_size").cast("double"), "gross": F.round(F.col("p_retailprice") * 1.2, 2)})
            .withColumnRenamed("p_partkey", "id").select("id", "label", "size", "gross"))


@query("b14_select_by_type_and_name", "SELECT c_custkey, c_nationkey, c_acctbal, c_name FROM customer")
def select_by_type(t):
    numbers = select_types(t.customer, "long", "integer", "double").columns
    names = t.customer.select(t.customer.colRegex("`.*_name`")).columns
    return t.customer.select(*numbers, *names)


@query("b15_conditional_replace", """
    SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_discount > 0.05 THEN l_discount END AS kept,
           CASE WHEN l_tax > 0.05 THEN 0 ELSE l_tax END AS masked, least(greatest(l_quantity, 10), 40) AS clipped FROM lineitem""")
def conditional_replace(t):
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("kept"),
        F.when(F.col("l_tax") > 0.05, 0.0).otherwise(F.col("l_tax")).alias("masked"),
        F.least(F.greatest(q, F.lit(10.0)), F.lit(40.0)).alias("clipped"))


@query("b16_value_replace", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'final' ELSE o_orderstatus END AS status,
           regexp_replace(o_orderpriority, '^\\d-', '') AS priority FROM orders""")
def value_replace(t):
    renamed = t.orders.withColumnRenamed("o_orderstatus", "status").na.replace({"O": "open", "F": "final"}, subset=["status"])
    return renamed.select("o_orderkey", "status", F.regexp_replace("o_orderpriority", r"^\d-", "").alias("priority"))


def _gappy(t):
    return t.customer.select(
        "c_custkey", F.expr("if(c_acctbal < 0, null, c_acctbal)").alias("bal"), F.expr("if(c_nationkey < 5, null, c_nationkey)").alias("nation"),
        F.expr("if(c_mktsegment = 'FURNITURE', null, c_mktsegment)").alias("segment"))


_GAPPY = """WITH g AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal, CASE WHEN c_nationkey >= 5 THEN c_nationkey END AS nation,
                   CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS segment FROM customer)"""


@query("b17_drop_missing", _GAPPY + """
    SELECT * FROM g WHERE (bal IS NOT NULL)::INT + (nation IS NOT NULL)::INT + (segment IS NOT NULL)::INT >= 2""")
def drop_missing(t):
    return _gappy(t).na.drop(thresh=2, subset=["bal", "nation", "segment"])


@query("b18_fill_constant", _GAPPY + """
    SELECT c_custkey, coalesce(bal, 0.0) AS bal, coalesce(nation, -1) AS nation, coalesce(segment, 'none') AS segment FROM g""")
def fill_constant(t):
    return _gappy(t).na.fill({"bal": 0.0, "nation": -1, "segment": "none"})


_SPARSE = """WITH g AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'click' THEN value END AS v,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)"""


def _sparse(t):
    return t.events.select("event_id", "user_id", "ts", F.expr("if(event_type = 'click', value, null)").alias("v"))


@query("b19_forward_backward_fill", _SPARSE + """
    SELECT event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn) AS fwd,
           last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS fwd2,
           first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bwd FROM g""")
def forward_backward_fill(t):
    from ..operators.ordered import col, running

    kinds = {"_pos": ("position", None), "_f": ("last_at", F.col("v")), "_b": ("next", F.col("v"))}
    both = running(_sparse(t), ["user_id"], ["ts", "event_id"], kinds)
    near = F.when(col("_pos") - F.col("_f.p") <= 2, F.col("_f.v"))
    return both.select("event_id", F.col("_f.v").alias("fwd"), near.alias("fwd2"), F.col("_b").alias("bwd"))


@query("b19_fill_with_limit", _SPARSE + """
    SELECT event_id, user_id, ts, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS v FROM g""")
def fill_with_limit(t):
    return fills.fill(_sparse(t), ["user_id"], ["ts", "event_id"], ["v"], limit=3)


_NEIGHBOURS = _SPARSE + """, k AS (SELECT *, CASE WHEN v IS NOT NULL THEN rn END AS krn, CASE WHEN v IS NOT NULL THEN epoch_us(ts) END AS kt FROM g),
    n AS (SELECT *, last_value(v IGNORE NULLS) OVER a AS pv, last_value(krn IGNORE NULLS) OVER a AS pr, last_value(kt IGNORE NULLS) OVER a AS pt,
                 first_value(v IGNORE NULLS) OVER z AS nv, first_value(krn IGNORE NULLS) OVER z AS nr, first_value(kt IGNORE NULLS) OVER z AS nt FROM k
          WINDOW a AS (PARTITION BY user_id ORDER BY rn), z AS (PARTITION BY user_id ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query("b20_interpolate_linear", _NEIGHBOURS + """
    SELECT event_id, user_id, ts, round(CASE WHEN v IS NOT NULL THEN v WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (rn - pr) / (nr - pr) END, 6) AS v FROM n""")
def interpolate_linear(t):
    return fills.interpolate(_sparse(t), ["user_id"], ["ts", "event_id"], "v").withColumn("v", F.round("v", 6))


@query("b20_interpolate_time", _NEIGHBOURS + """
    SELECT event_id, user_id, ts, round(CASE WHEN v IS NOT NULL THEN v WHEN nv IS NULL THEN pv
           ELSE pv + (nv - pv) * (epoch_us(ts) - pt) / (nt - pt) END, 6) AS v FROM n""")
def interpolate_time(t):
    return fills.interpolate(_sparse(t), ["user_id"], ["ts", "event_id"], "v", "time").withColumn("v", F.round("v", 6))


@query("b20_interpolate_nearest", _NEIGHBOURS + """
    SELECT event_id, user_id, ts, CASE WHEN v IS NOT NULL THEN v WHEN pv IS NOT NULL AND nv IS NOT NULL THEN CASE WHEN (epoch_us(ts) - pt) * 2 <= nt - pt THEN pv ELSE nv END END AS v FROM n""")
def interpolate_nearest(t):
    return fills.interpolate(_sparse(t), ["user_id"], ["ts", "event_id"], "v", "nearest")


@query("b21_asof_lookup", """
    WITH w AS (SELECT DISTINCT date_trunc('day', ts) + INTERVAL 12 HOUR AS ts FROM events),
         k AS (SELECT ts, event_id, value FROM events WHERE event_type = 'signup')
    SELECT w.ts, k.ts AS ts_right, event_id, value FROM w ASOF LEFT JOIN k ON w.ts >= k.ts""")
def asof_lookup(t):
    where = t.events.select((F.date_trunc("day", "ts") + F.expr("interval 12 hours")).cast("timestamp_ntz").alias("ts")).distinct()
    known = t.events.select("ts", F.expr("if(event_type = 'signup', event_id, null)").alias("event_id"), "value")
    return fills.asof_lookup(known, where, "ts", ["event_id"])


@query("b22_drop_duplicates_first", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""")
def drop_duplicates_first(t):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return grouping.drop_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("b22_drop_all_repeated", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1""")
def drop_all_repeated(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return grouping.drop_duplicates(rows, ["l_orderkey", "l_linenumber"], ["l_partkey"], keep=False)


@query("b22_flag_duplicates", """
    SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) > 1 AS duplicated FROM orders""")
def flag_duplicates(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return grouping.flag_duplicates(rows, ["o_custkey", "o_orderstatus"], ["o_orderkey"]).select("o_orderkey", "duplicated")


@query("b23_weighted_sample")
def weighted_sample(t):
    return grouping.hash_sample(t.orders, 100, ["o_orderkey"], seed=3, weight=F.col("o_totalprice"))


_DRAWN = "(('0x' || substr(md5('7:' || {0}), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0"


@query("b23_sample_fraction", f"""
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE {_DRAWN.format("l_orderkey || ':' || l_linenumber || ':' || l_partkey")} < 0.1""")
def sample_fraction(t):
    """About a tenth of the rows, the same ones however they are partitioned."""
    return grouping.draw_fraction(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), 0.1, ["l_orderkey", "l_linenumber", "l_partkey"], 7)


@query("b23_sample_with_replacement", f"""
    WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders),
         d AS (SELECT draw, floor({_DRAWN.format("draw")} * (SELECT count(*) FROM orders))::BIGINT AS i FROM (SELECT unnest(range(20000)) AS draw))
    SELECT draw, o_orderkey FROM d JOIN n USING (i)""")
def sample_with_replacement(t):
    return grouping.draw_with_replacement(t.orders.select("o_orderkey"), 20000, ["o_orderkey"], 7)


@query("b23_weighted_with_replacement", f"""
    WITH n AS (SELECT o_orderkey, sum(w) OVER (ORDER BY o_orderkey) AS hi, w FROM (SELECT o_orderkey, round(o_totalprice * 100)::BIGINT AS w FROM orders)),
         d AS (SELECT draw, floor({_DRAWN.format("draw")} * (SELECT max(hi) FROM n))::BIGINT AS at FROM (SELECT unnest(range(5000)) AS draw))
    SELECT draw, o_orderkey FROM d ASOF JOIN n ON d.at < n.hi""")
def weighted_with_replacement(t):
    """Orders drawn in proportion to their price in cents."""
    orders = t.orders.select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("w"))
    return grouping.draw_with_replacement(orders, 5000, ["o_orderkey"], 7, weight="w").select("draw", "o_orderkey")


@query("b23_weighted_fraction", f"""
    WITH k AS (SELECT o_orderkey, -ln({_DRAWN.format("o_orderkey")}) / o_totalprice AS d FROM orders)
    SELECT o_orderkey FROM (SELECT *, row_number() OVER (ORDER BY d, o_orderkey) AS r, count(*) OVER () AS n FROM k) WHERE r <= round(n * 0.25)""")
def weighted_fraction(t):
    """A quarter of the orders without replacement, dearer ones more likely."""
    return grouping.draw_weighted_fraction(t.orders.select("o_orderkey", "o_totalprice"), 0.25, ["o_orderkey"], F.col("o_totalprice"), 7).select("o_orderkey")


@query("b24_parse_numbers_and_dates", """
    SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level, TRY_CAST(substr(o_orderpriority, 3) AS DOUBLE) AS bad,
           try_strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d')::DATE AS day FROM orders""")
def parse_numbers(t):
    return t.orders.select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).try_cast("int").alias("level"), F.expr("try_cast(substring(o_orderpriority, 3) as double)").alias("bad"),
        F.try_to_timestamp(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("yyyyMMdd")).cast("date").alias("day"))


@query("b87_align_to_keys", """
    SELECT n_nationkey, n FROM nation LEFT JOIN (SELECT s_nationkey AS n_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 9000 GROUP BY 1) USING (n_nationkey)""")
def align_to_keys(t):
    counts = t.supplier.filter("s_acctbal > 9000").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return reshape.align(counts, t.nation.select("n_nationkey"), ["n_nationkey"])


@query("b89_between_and_lookup", """
    SELECT p_partkey, CASE WHEN p_size > 25 THEN 'p_brand' ELSE 'p_type' END AS field,
           CASE WHEN p_size > 25 THEN p_brand ELSE p_type END AS value FROM part WHERE p_retailprice BETWEEN 950 AND 1050""")
def between_and_lookup(t):
    requests = t.part.filter(F.col("p_retailprice").between(950, 1050)).select("p_partkey", F.expr("if(p_size > 25, 'p_brand', 'p_type')").alias("field"))
    return reshape.lookup(t.part.select("p_partkey", "p_brand", "p_type"), requests, ["p_partkey"], "field")


@query("b78_map_values", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 END AS code FROM orders""")
def map_values(t):
    codes = F.create_map(F.lit("O"), F.lit(1), F.lit("F"), F.lit(2))
    return t.orders.select("o_orderkey", F.try_element_at(codes, F.col("o_orderstatus")).alias("code"))
