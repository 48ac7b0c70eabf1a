"""Column profiles and value distributions on the benchmark tables."""

from pyspark.sql import functions as F

from ..operators import profile as pf
from ..operators import ranks, reshape, stats
from ..operators.ordered import col
from .registry import query

KIND = "kind"


def wide(t):
    """Orders with columns filled always, often, seldom, almost never, or for one document type only."""
    return t.orders.selectExpr(
        "o_orderstatus AS kind", "o_orderkey", "if(o_totalprice < 100000, null, o_totalprice) AS often", "if(o_orderpriority = '1-URGENT', o_custkey, null) AS urgent_cust",
        "if(o_totalprice > 495000, o_totalprice, null) AS huge", "if(o_orderstatus = 'F', o_custkey, null) AS final_only", "if(o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW'), o_orderpriority, null) AS prio")


_WIDE = """WITH w AS (SELECT o_orderstatus AS kind, o_orderkey, CASE WHEN o_totalprice >= 100000 THEN o_totalprice END AS often, CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END AS urgent_cust,
    CASE WHEN o_totalprice > 495000 THEN o_totalprice END AS huge, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS final_only,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') THEN o_orderpriority END AS prio FROM orders)"""
_COLUMNS = ["o_orderkey", "often", "urgent_cust", "huge", "final_only", "prio"]
_SHARES = _WIDE + ", s AS (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", avg(({c} IS NULL)::INT) AS null_share FROM w" for c in ["kind", *_COLUMNS]) + ")"
_BY_KIND = _WIDE + ", s AS (" + " UNION ALL ".join(f"SELECT kind, '{c}' AS \"column\", avg(({c} IS NULL)::INT) AS null_share FROM w GROUP BY 1" for c in _COLUMNS) + ")"


def _round(df):
    return df.withColumn("null_share", F.round("null_share", 8))


@query("a49_row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(t):
    return t.lineitem.agg(F.count("*").alias("n"))


@query("a50_value_counts", _WIDE + " SELECT prio, count(*) AS n FROM w WHERE prio IS NOT NULL GROUP BY 1")
def value_counts(t):
    return stats.value_counts(wide(t), [], "prio").select("prio", "n").orderBy(F.desc("n"), "prio")


@query("a51_shares_of_small_columns", """
    WITH l AS (SELECT 'l_returnflag' AS "column", l_returnflag AS value FROM lineitem UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem
               UNION ALL SELECT 'l_linenumber', l_linenumber::VARCHAR FROM lineitem UNION ALL SELECT 'l_suppkey', l_suppkey::VARCHAR FROM lineitem)
    SELECT "column", value, round(count(*) / (SELECT count(*) FROM lineitem), 8) AS share FROM l WHERE "column" IN (SELECT "column" FROM l GROUP BY 1 HAVING count(DISTINCT value) < 25) GROUP BY 1, 2""")
def small_shares(t):
    out = pf.small_value_shares(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"])
    return out.withColumn("share", F.round("share", 8))


@query("a52_distinct_values", _WIDE + " SELECT DISTINCT prio FROM w")
def distinct_values(t):
    return wide(t).select("prio").distinct()


@query("a53_distinct_list_items", "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS item FROM part")
def distinct_list_items(t):
    return pf.distinct_items(t.part.select(F.split("p_name", " ").alias("words")), "words")


@query("a54_list_column_detection", "SELECT unnest(['p_name', 'p_both']) AS path")
def list_column_detection(t):
    paths = F.create_map(F.lit("p_name"), F.split("p_name", " "), F.lit("p_both"), F.array("p_brand", "p_type"), F.lit("p_type"), F.array("p_type"))
    return pf.list_columns(t.part.select(paths.alias("paths")))


@query("a55_null_shares", _SHARES + " SELECT \"column\", round(null_share, 8) AS null_share FROM s")
def null_shares(t):
    return _round(pf.null_shares(wide(t)))


@query("a56_null_shares_by_type", _BY_KIND + " SELECT kind, \"column\", round(null_share, 8) AS null_share FROM s")
def null_shares_by_type(t):
    return _round(pf.null_shares(wide(t), [KIND]))


@query("a57_profile_buckets", _BY_KIND + """ SELECT kind, "column", CASE WHEN null_share = 0 THEN 'never' WHEN null_share > 0 AND null_share < 0.25 THEN 'rarely'
    WHEN null_share > 0.25 AND null_share < 0.5 THEN 'sometimes' WHEN null_share > 0.95 THEN 'usually' END AS bucket FROM s""")
def profile_buckets(t):
    return pf.null_shares(wide(t), [KIND]).select(KIND, "column", pf.profile_bucket(F.col("null_share")).alias("bucket"))


@query("a58_selected_columns", _BY_KIND + ' SELECT DISTINCT "column" FROM s WHERE null_share < 0.5')
def selected_columns(t):
    return pf.useful_columns(pf.null_shares(wide(t), [KIND]))


@query("a66_sorted_profile", _SHARES + ' SELECT "column", round(null_share, 8) AS null_share FROM s WHERE null_share > 0.5')
def sorted_profile(t):
    return _round(pf.null_shares(wide(t)).filter("null_share > 0.5")).orderBy(F.desc("null_share"), "column")


@query("a47_common_columns", _BY_KIND + """, p AS (SELECT kind, "column" FROM s WHERE null_share < 1)
    SELECT 'all' AS part, "column" FROM p GROUP BY 2 HAVING count(*) = 3 UNION ALL SELECT 'final only', "column" FROM p GROUP BY 2 HAVING count(*) = 1 AND min(kind) = 'F'""")
def common_columns(t):
    present = pf.column_presence(wide(t), KIND)
    everywhere = pf.common_columns(present, KIND, ["F", "O", "P"]).withColumn("part", F.lit("all"))
    return everywhere.unionByName(pf.only_columns(present, KIND, "F").withColumn("part", F.lit("final only")))


@query("a48_reported_columns", _BY_KIND + ' SELECT DISTINCT "column" FROM s WHERE null_share < 0.25 OR (null_share > 0.25 AND null_share < 0.5)')
def reported_columns(t):
    """Columns reported by the always, rarely and sometimes steps, each once; a share of just a quarter is in none of them."""
    profile = pf.null_shares(wide(t), [KIND])
    bucket = pf.profile_bucket(col("null_share"))
    steps = [profile.filter(bucket == b).select("column") for b in ("never", "rarely", "sometimes")]
    return steps[0].union(steps[1]).union(steps[2]).dropDuplicates()


@query("a59_histogram", """
    WITH v AS (SELECT o_totalprice AS x FROM orders WHERE o_totalprice < 400000), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
         c AS (SELECT least(floor((x - lo) / (hi - lo) * 50), 49)::INT AS bin, count(*) AS n FROM v, e GROUP BY 1)
    SELECT b::INT AS bin, coalesce(n, 0) AS n, round(lo + b * ((hi - lo) / 50), 4) AS lo, round(lo + (b + 1) * ((hi - lo) / 50), 4) AS hi FROM (SELECT unnest(generate_series(0, 49)) AS b) LEFT JOIN c ON b = bin, e""")
def histogram(t):
    out = reshape.histogram(t.orders.filter("o_totalprice < 400000"), "o_totalprice", 50)
    return out.withColumns({c: F.round(c, 4) for c in ("lo", "hi")})


@query("a60_factor_codes", """
    WITH f AS (SELECT c_mktsegment, row_number() OVER (ORDER BY min(c_custkey)) - 1 AS code FROM customer GROUP BY 1) SELECT c_custkey, code FROM customer JOIN f USING (c_mktsegment)""")
def factor_codes(t):
    return ranks.first_seen_codes(t.customer, "c_mktsegment", "c_custkey").select("c_custkey", "code")


def _mirrored(t):
    return t.orders.selectExpr("o_orderstatus AS a", "lower(o_orderstatus) AS b", "o_orderpriority AS c", "substring(o_orderpriority, 1, 1) AS d", "o_custkey % 3 AS e")


@query("a61_redundant_columns", """
    WITH m AS (SELECT o_orderstatus AS a, lower(o_orderstatus) AS b, o_orderpriority AS c, o_orderpriority[1:1] AS d, (o_custkey % 3)::VARCHAR AS e FROM orders),
         l AS (SELECT x.k AS a, y.k AS b, count(DISTINCT x.v) AS na, count(DISTINCT y.v) AS nb, count(DISTINCT x.v || '|' || y.v) AS nab
               FROM (SELECT row_number() OVER () AS i, * FROM m) m1, LATERAL (SELECT unnest(['a', 'b', 'c', 'd', 'e']) AS k, unnest([a, b, c, d, e]) AS v) x,
                    LATERAL (SELECT unnest(['a', 'b', 'c', 'd', 'e']) AS k, unnest([a, b, c, d, e]) AS v) y WHERE x.k <> y.k GROUP BY 1, 2)
    SELECT a, b FROM l WHERE na = nb AND na = nab""")
def redundant_columns(t):
    return pf.redundant_columns(_mirrored(t), ["a", "b", "c", "d", "e"])


@query("a61_factor_correlation", """
    WITH s AS (SELECT o_orderkey AS i, o_orderstatus AS a, o_orderpriority AS c FROM orders),
         fa AS (SELECT a, row_number() OVER (ORDER BY min(i)) - 1 AS ca FROM s GROUP BY 1), fc AS (SELECT c, row_number() OVER (ORDER BY min(i)) - 1 AS cc FROM s GROUP BY 1)
    SELECT round(corr(ca, cc), 8) + 0.0 AS corr FROM s JOIN fa USING (a) JOIN fc USING (c)""")
def factor_correlation(t):
    """Correlation of factor codes, the optional numeric form of the redundancy test."""
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    coded = ranks.first_seen_codes(ranks.first_seen_codes(o, "o_orderstatus", "o_orderkey", "ca"), "o_orderpriority", "o_orderkey", "cc")
    return stats.correlation_pairs(coded, ["ca", "cc"]).filter("a <> b").select(F.round("corr", 8).alias("corr"))
