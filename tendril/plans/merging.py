"""Scans, sinks, anti joins, unions and award pairs on the benchmark tables."""

import uuid

from pyspark.sql import functions as F

from ..operators import normalize as nz
from ..operators import quality as ql
from ..operators import recommend as rec
from ..operators.ordered import settle
from ..session import scratch_path
from ..sources import tables as tb
from ..sources.html import html_tables
from .registry import query


def _store(df, label):
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return path


def _by_year(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))


_BY_YEAR = "SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate)::INT AS year FROM orders"


@query("a04_prefix_scan_by_year", _BY_YEAR + " WHERE year(o_orderdate) = 1997")
def prefix_scan(t):
    """Partitioned table written, one year read back: the filter prunes partitions."""
    path = scratch_path(t.spark, "years")
    tb.append_years(_by_year(t), path)
    return tb.read_prefix(t.spark, path, 1997)


@query("a05_file_list_scan", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def file_list_scan(t):
    path = scratch_path(t.spark, "files")
    for status, folder in (("F", "2019/01"), ("O", "2019/02"), ("P", "merged")):
        t.orders.filter(F.col("o_orderstatus") == status).select("o_orderkey", "o_totalprice").write.parquet(f"{path}/{folder}")
    return tb.read_files(t.spark, path)


@query("a06_fault_tolerant_scan", """
    SELECT o_orderkey::VARCHAR AS id, o_totalprice::VARCHAR AS price, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS cust, NULL AS broken FROM orders
    UNION ALL SELECT NULL, NULL, NULL, f FROM (SELECT unnest(['a/cut.parquet', 'd/text.parquet']) AS f)""")
def fault_tolerant_scan(t):
    """Files with different columns under one mapping, beside one cut short and one that never was a table; both are reported."""
    path = scratch_path(t.spark, "mixed")
    t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", "o_custkey").write.parquet(f"{path}/a")
    t.orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice").write.parquet(f"{path}/b")
    t.orders.filter("o_orderstatus = 'P'").select("o_totalprice", "o_orderpriority", "o_orderkey").write.parquet(f"{path}/c")
    tb.put_file(t.spark, f"{path}/a/cut.parquet", b"PAR1" + bytes(64))
    tb.put_file(t.spark, f"{path}/d/text.parquet", b"not a table at all, but long enough to be one")
    good, bad = tb.read_tolerant(t.spark, path, [("o_orderkey", "id", "string"), ("o_totalprice", "price", "string"), ("o_custkey", "cust", "bigint")])
    return good.unionByName(bad.select(F.regexp_extract("path", "[^/]+/[^/]+$", 0).alias("broken")), allowMissingColumns=True)


@query("a07_catalog_scan", _BY_YEAR)
def catalog_scan(t):
    """Tables under a prefix of their own, so that those of another run aren't picked up."""
    prefix = f"years_{uuid.uuid4().hex}_"
    for name, part in (("early", "year < 1995"), ("late", "year >= 1995")):
        tb.register_table(t.spark, prefix + name, _store(_by_year(t).filter(part), name))
    return tb.catalog_tables(t.spark, prefix)


@query("a08_list_scan", "SELECT p_partkey::VARCHAR AS id, p_name AS name FROM part")
def list_scan(t):
    path = scratch_path(t.spark, "list")
    t.part.select("p_partkey", "p_name").write.csv(path)
    return tb.read_list(t.spark, path, "id", "name")


@query("a09_package_sink", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m01') AS package, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month FROM orders""")
def package_sink(t):
    path = scratch_path(t.spark, "packages")
    rows = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMM'01'").alias("p"))
    for _ in range(2):  # the second run replaces the packages it writes
        tb.write_packages(rows, path, F.col("p"))
    return t.spark.read.parquet(path).select("o_orderkey", F.col("package").cast("string").alias("package"), "year", "month")


@query("a10_year_append_sink", _BY_YEAR)
def year_append(t):
    path = scratch_path(t.spark, "append")
    tb.append_years(_by_year(t).filter("o_totalprice < 200000"), path)
    tb.append_years(_by_year(t).filter("o_totalprice >= 200000"), path)
    return tb.read_prefix(t.spark, path)


@query("a11_one_file_per_year", "SELECT year, 1::BIGINT AS n_files, count(*) AS n_rows FROM (" + _BY_YEAR + ") GROUP BY 1")
def one_file_per_year(t):
    path = scratch_path(t.spark, "single")
    tb.append_years(_by_year(t), path, files_per_year=1)
    return t.spark.read.parquet(path).groupBy("year").agg(F.count_distinct(F.col("_metadata.file_name")).alias("n_files"), F.count("*").alias("n_rows"))


@query("a12_overwrite_sink", _BY_YEAR + " WHERE year(o_orderdate) > 1997")
def overwrite_sink(t):
    path = scratch_path(t.spark, "overwrite")
    tb.overwrite(_by_year(t), path)
    tb.overwrite(t.spark.read.parquet(path).filter("year > 1997"), path)
    return t.spark.read.parquet(path)


@query("a13_monthly_compaction", """
    SELECT o_orderkey, o_totalprice, CASE WHEN year(o_orderdate) < 1995 THEN '199412' ELSE '199812' END AS month FROM orders""")
def monthly_compaction(t):
    """All orders in two months, one of them filled in parts; a part delivered twice adds nothing."""
    path = scratch_path(t.spark, "months")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.when(F.year("o_orderdate") < 1995, "199412").otherwise("199812").alias("m"), F.dayofmonth("o_orderdate").alias("d"))
    for month, part in (("199412", "d <= 15"), ("199412", "d > 15"), ("199412", "d > 15"), ("199812", "d > 0")):
        tb.compact_month(t.spark, path, rows.filter(F.col("m") == month).filter(part).drop("m", "d"), month, ["o_orderkey"], ["o_totalprice"])
    return t.spark.read.parquet(path).withColumn("month", F.col("month").cast("string"))


@query("a14_table_registration", _BY_YEAR)
def table_registration(t):
    path = scratch_path(t.spark, "registered")
    tb.append_years(_by_year(t), path)
    tb.register_table(t.spark, "registered_orders", path)
    return t.spark.sql("SELECT o_orderkey, o_custkey, o_totalprice, year FROM registered_orders")


@query("a15_json_rows", """
    SELECT '{"rating":"' || c_custkey || '","contractor":"' || c_name || '","service":"' || c_mktsegment || '"}' AS json FROM customer""")
def json_rows(t):
    rows = t.customer.select(F.col("c_custkey").alias("rating"), F.col("c_name").alias("contractor"), F.col("c_mktsegment").alias("service"))
    return tb.json_rows(rows, ["rating", "contractor", "service"])


@query("a37_header_times_forms", """
    SELECT o_orderkey, o_orderpriority, l_linenumber, l_partkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def header_times_forms(t):
    """Notice header with its list of forms, exploded in place."""
    both = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    # an order's lines, as a notice's forms: a handful each
    nested = both.groupBy("o_orderkey", "o_orderpriority").agg(F.collect_list(F.struct("l_linenumber", "l_partkey")).alias("forms"))
    return nested.select(F.struct("o_orderkey", "o_orderpriority").alias("header"), "forms").select("header.*", F.inline("forms"))


@query("a40_already_seen", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def already_seen(t):
    return t.orders.join(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey")


@query("a41_missing_directories", """
    SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS d FROM orders WHERE strftime(o_orderdate, '%Y%m%d') NOT IN (SELECT strftime(l_shipdate, '%Y%m%d') FROM lineitem WHERE l_quantity > 48)""")
def missing_directories(t):
    day = lambda c: F.date_format(c, "yyyyMMdd").alias("d")
    return t.orders.select(day("o_orderdate")).distinct().join(t.lineitem.filter("l_quantity > 48").select(day("l_shipdate")), "d", "left_anti")


@query("a42_limited_semi_join", """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT DISTINCT o_custkey FROM orders ORDER BY 1 LIMIT 10)""")
def limited_semi_join(t):
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("contractor"))
    return rec.sample_of_contractors(o, 10).withColumnRenamed("contractor", "o_custkey")


_UNION = """
    SELECT o_orderkey, o_totalprice, NULL AS o_orderstatus FROM orders WHERE year(o_orderdate) < 1994
    UNION ALL BY NAME SELECT o_orderkey, o_orderstatus FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1996
    UNION ALL BY NAME SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE year(o_orderdate) > 1996"""


@query("a45_union_of_year_tables", _UNION)
def union_of_years(t):
    years = lambda a, b: t.orders.filter(F.year("o_orderdate").between(a, b))
    return nz.stack([years(0, 1993).select("o_orderkey", "o_totalprice"), years(1994, 1996).select("o_orderkey", "o_orderstatus"),
                     years(1997, 9999).select("o_orderkey", "o_totalprice", "o_orderstatus")])


@query("a44_union_of_mapped_files", """
    SELECT o_orderkey::VARCHAR AS id, o_totalprice AS amount FROM orders UNION ALL SELECT c_custkey::VARCHAR, c_acctbal FROM customer""")
def union_of_mapped_files(t):
    one = nz.map_columns(t.orders, [("o_orderkey", "id", "string"), ("o_totalprice", "amount", "double")])
    two = nz.map_columns(t.customer, [("c_acctbal", "amount", "double"), ("c_custkey", "id", "string")])
    return nz.stack([one, two])


@query("a46_row_concatenation", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem")
def row_concatenation(t):
    pick = lambda f: t.lineitem.filter(F.col("l_returnflag") == f).select("l_orderkey", "l_linenumber", "l_partkey")
    return nz.stack([pick("A"), pick("N"), pick("R")])


def awards(t):
    """Award notices from line items: two services and one contractor, some of them blank, doubled or translated."""
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.select(
        F.expr("if(l_linestatus = 'O', 'ORIGINAL', 'TRANSLATION')").alias("category"),
        F.expr("if(l_returnflag = 'R', 'Contract notice', 'Contract award notice')").alias("td_document_type"),
        F.expr("array(p_type, if(l_linenumber = 7, '', p_brand))").alias("services"),
        F.expr("if(l_linenumber = 6, array(s_name, s_name), array(s_name))").alias("contractors"))


PAIRS = """pairs AS (SELECT unnest([p_type, p_brand]) AS service, s_name AS contractor FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    WHERE l_linestatus = 'O' AND l_returnflag <> 'R' AND l_linenumber NOT IN (6, 7))"""


def pairs(t):
    return rec.award_pairs(awards(t), "services", "contractors")


@query("a67_award_pairs", f"WITH {PAIRS} SELECT service, contractor, count(*) AS n FROM pairs GROUP BY 1, 2")
def award_pairs(t):
    return pairs(t).groupBy("service", "contractor").agg(F.count("*").alias("n"))


@query("a62_top_services_per_contractor", f"""
    WITH {PAIRS} SELECT service, contractor, n FROM (SELECT service, contractor, count(*) AS n FROM pairs GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY contractor ORDER BY n DESC, service) <= 5""")
def top_services(t):
    """Flagship: the five most frequent services of each contractor."""
    from pyspark.sql import Window

    counts = pairs(t).groupBy("service", "contractor").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("contractor").orderBy(F.desc("n"), "service"))
    return counts.withColumn("_p", place).filter("_p <= 5").drop("_p")


@query("a62_top_categories", "SELECT lang, count(*) AS n FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def top_categories(t):
    return t.documents.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(15)


@query("a68_listed_pairs", """
    WITH r AS (SELECT l_linenumber % 3 + 1 AS n, CASE WHEN l_linenumber = 5 THEN NULL WHEN l_linenumber = 4 THEN ['x', 'y'] ELSE [l_returnflag, l_linestatus, 'Z'][:l_linenumber % 3 + 1] END AS s,
                      ['A' || l_suppkey, 'B' || l_suppkey, 'C' || l_suppkey][:l_linenumber % 3 + 1] AS c FROM lineitem),
         p AS (SELECT CASE WHEN len(s) = 1 THEN list_transform(c, lambda x: {'service': s[1], 'contractor': x})
                           WHEN len(s) = len(c) THEN list_transform(c, lambda x, i: {'service': s[i], 'contractor': x}) END AS z FROM r WHERE s IS NOT NULL)
    SELECT q.service AS service, q.contractor AS contractor, count(*) AS n FROM (SELECT unnest(z) AS q FROM p) GROUP BY 1, 2""")
def listed_pairs(t):
    text = lambda items: F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    size = F.expr("cast(l_linenumber % 3 + 1 as int)")
    services = F.when(F.col("l_linenumber") == 4, F.array(F.lit("x"), F.lit("y"))).otherwise(F.slice(F.array("l_returnflag", "l_linestatus", F.lit("Z")), F.lit(1), size))
    names = F.slice(F.array(*[F.concat(F.lit(p), "l_suppkey") for p in "ABC"]), F.lit(1), size)
    listed = t.spread("lineitem").select(text(services).alias("service"), F.when(F.col("l_linenumber") == 5, "[null]").otherwise(text(names)).alias("contractor"))
    return rec.listed_pairs(listed).groupBy("service", "contractor").agg(F.count("*").alias("n"))


@query("a69_award_predicate", "SELECT l_linestatus = 'O' AND l_returnflag <> 'R' AND l_linenumber NOT IN (6, 7) AS kept, count(*) AS n FROM lineitem GROUP BY 1")
def award_predicate(t):
    c = F.col
    kept = (c("category") == rec.AWARD_CATEGORY) & (c("td_document_type") == rec.AWARD_TYPE) & rec.filled(c("services")) & rec.filled(c("contractors")) & (F.size("contractors") == 1)
    return awards(t).groupBy(kept.alias("kept")).agg(F.count("*").alias("n"))


@query("a70_select_and_rename", "SELECT p_type AS service, s_name AS contractor, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2")
def select_and_rename(t):
    return awards(t).select(F.get("services", 0).alias("service"), F.get("contractors", 0).alias("contractor")).groupBy("service", "contractor").agg(F.count("*").alias("n"))


@query("a72_membership_list", "SELECT n_nationkey, n_name IN ('NATION_1', 'NATION_3', 'NATION_21') AS is_member FROM nation")
def membership_list(t):
    return t.nation.select("n_nationkey", F.col("n_name").isin("NATION_1", "NATION_3", "NATION_21").alias("is_member"))


@query("a65_directory_slice", "SELECT DISTINCT o_orderdate::DATE AS d FROM orders ORDER BY 1 LIMIT 15 OFFSET 30")
def directory_slice(t):
    return t.orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct().orderBy("d").offset(30).limit(15)


@query("b80_csv_and_fixed_width", "SELECT p_partkey::VARCHAR AS key, p_type AS kind, p_size::VARCHAR AS size FROM part")
def csv_and_fixed_width(t):
    """CSV written and read back, then written as fixed-width lines and cut again."""
    csv, lines = scratch_path(t.spark, "csv"), scratch_path(t.spark, "fixed")
    t.part.select("p_partkey", "p_type", "p_size").write.csv(csv, header=True)
    back = t.spark.read.csv(csv, header=True, schema="p_partkey string, p_type string, p_size string")
    back.select(F.concat(F.rpad("p_partkey", 12, " "), F.rpad("p_type", 20, " "), F.lpad("p_size", 4, " "))).write.text(lines)
    return tb.read_fixed_width(t.spark, lines, {"key": (1, 12), "kind": (13, 20), "size": (33, 4)})


@query("b81_json_files", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def json_files(t):
    path = scratch_path(t.spark, "json")
    t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice").write.json(path)
    return t.spark.read.json(path, schema="o_orderkey long, o_orderpriority string, o_totalprice double")


@query("b82_parquet_columns", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45")
def parquet_columns(t):
    return t.lineitem.filter("l_quantity > 45").select("l_orderkey", "l_quantity")


@query("b83_partition_filters", "SELECT o_orderkey, year(o_orderdate)::INT AS year FROM orders WHERE (year(o_orderdate) = 1996 AND o_orderstatus = 'F') OR year(o_orderdate) IN (1998, 1999)")
def partition_filters(t):
    path = scratch_path(t.spark, "dataset")
    t.orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year")).write.partitionBy("year").parquet(path)
    return tb.read_partitions(t.spark, path, [[("year", "=", 1996), ("o_orderstatus", "=", "F")], [("year", "in", [1998, 1999])]], ["o_orderkey", "year"])


@query("b84_orc_files", "SELECT c_custkey, c_acctbal FROM customer")
def orc_files(t):
    path = scratch_path(t.spark, "orc")
    t.customer.select("c_custkey", "c_acctbal").write.orc(path)
    return t.spark.read.orc(path)


@query("b86_html_tables", """
    SELECT o_orderkey, 0 AS table_no, r::INT AS row_no, r = 0 AS is_header, CASE r WHEN 0 THEN ['Field', 'Value'] WHEN 1 THEN ['Status & kind', o_orderstatus] ELSE ['Priority', o_orderpriority] END AS cells
    FROM orders, (SELECT unnest([0, 1, 2]) AS r)""")
def html_tables_of_orders(t):
    """One page per order with a small table, read back row by row."""
    page = F.concat(F.lit("<html><body><p>x</p><table><tr><th>Field</th><th>Value</th></tr><tr><td>Status &amp; kind</td><td>"), "o_orderstatus",
                    F.lit("</td></tr><tr><td>Priority</td><td><b>"), "o_orderpriority", F.lit("</b></td></tr></table></body></html>"))
    return html_tables(t.spread("orders").select("o_orderkey", page.alias("html")), "o_orderkey", "html")


@query("b86_html_tables_of_pages", """
    SELECT count(*) AS n_pages, sum(len(regexp_extract_all(lower(html), '<table[ >]')))::BIGINT AS n_tables FROM pages""")
def html_tables_of_pages(t):
    found = html_tables(t.spread("pages"), "page_id", "html").select("page_id", "table_no").distinct()
    # two one-row counts
    return t.pages.agg(F.count("*").alias("n_pages")).join(F.broadcast(found.agg(F.count("*").alias("n_tables"))))


@query("a88_pattern_checks", """
    SELECT 'url' AS rule, count(*) AS n_checked, count(*) FILTER (NOT regexp_full_match(url, '(((http|HTTP|https|HTTPS|ftp|FTP|ftps|FTPS|sftp|SFTP)://)|((w|W){3}(\\d)?\\.))[\\w\\?!\\./:;,\\-_=#+*%@"\\(\\)&]+')) AS n_bad FROM pages
    UNION ALL SELECT 'date', count(*), count(*) FILTER (NOT regexp_full_match(strftime(o_orderdate, '%Y%m%d'), '(20)[0-9]{2}(1[0-2]|0[1-9])((3[0-1])|([1-2][0-9])|(0[1-9]))')) FROM orders
    UNION ALL SELECT 'full_date', count(*), 0 FROM orders
    UNION ALL SELECT 'notice_number', count(*), count(*) FILTER (length(o_custkey::VARCHAR) > 3) FROM orders
    UNION ALL SELECT 'amount', count(*), count(*) FILTER (c_acctbal <= 0) FROM customer
    UNION ALL SELECT 'datetime', count(*), 0 FROM events
    UNION ALL SELECT 'time', count(*), count(*) FILTER (event_type = 'error') FROM events
    UNION ALL SELECT 'document_number', count(*), count(*) FILTER (length(o_orderkey::VARCHAR) > 4) FROM orders
    UNION ALL SELECT 'phone', count(*), count(*) FILTER (c_acctbal < 0) FROM customer
    UNION ALL SELECT 'e_mail', count(*), count(*) FILTER (c_mktsegment = 'BUILDING') FROM customer""")
def pattern_checks(t):
    o = t.orders.select(F.date_format("o_orderdate", "yyyyMMdd").alias("date"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("full_date"),
                        F.concat(F.year("o_orderdate"), F.lit("/S "), F.expr("if(length(cast(o_custkey as string)) > 3, cast(o_custkey as string), lpad(cast(o_custkey as string), 3, '0'))"),
                                 F.lit("-"), F.lpad(F.col("o_orderkey").cast("string"), 6, "0")).alias("notice_number"),
                        F.concat(F.col("o_orderkey") * 100, F.lit("-"), F.year("o_orderdate")).alias("document_number"))
    rules = {r: ql.matches(F.col(r), r) for r in ("date", "full_date", "notice_number", "document_number")}
    at = F.when(F.col("event_type") == "error", F.date_format("ts", "HH:mm:ss")).otherwise(F.date_format("ts", "H:mm"))
    e = t.events.select(F.concat(F.lit("2019"), F.date_format("ts", "MMdd HH:mm")).alias("datetime"), at.alias("time"))
    phone = F.concat(F.when(F.col("c_acctbal") < 0, "00").otherwise("+"), (F.col("c_nationkey") + 1).cast("string"), F.lit(" "), F.col("c_custkey").cast("string"), F.lit("-7 / +49 12"))
    mail = F.concat(F.col("c_custkey").cast("string"), F.when(F.col("c_mktsegment") == "BUILDING", " at ").otherwise("@"), F.lit("host.eu"))
    c = t.customer.select(phone.alias("phone"), mail.alias("e_mail"))
    parts = [ql.rule_counts(t.pages, {"url": ql.matches(F.col("url"), "url")}), ql.rule_counts(o, rules),
             ql.rule_counts(t.customer.select(F.col("c_acctbal").cast("decimal(15,2)").cast("string").alias("a")), {"amount": ql.amount_rule(F.col("a"))})]
    parts += [ql.rule_counts(df, {r: ql.matches(F.col(r), r) for r in df.columns}) for df in (e, c)]
    return nz.stack(parts)


@query("a89_code_list_check", """
    SELECT 'segment' AS list, c_mktsegment AS code, count(*) AS n_rows FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') GROUP BY 2
    UNION ALL SELECT 'nation', n_name, count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey > 2 GROUP BY 2""")
def code_list_check(t):
    """Codes held against the enumerations of two schema files, which the XML reader turns into one table of codes."""
    path = scratch_path(t.spark, "schemas")
    nations = t.nation.filter("n_regionkey <= 2").select("n_name").orderBy("n_name")
    lists = {"segment": t.spark.createDataFrame([("BUILDING",), ("MACHINERY",)], "code string"), "nation": nations}
    for name, codes in lists.items():
        values = "".join(f'<xs:enumeration value="{r[0]}"/>' for r in codes.collect())  # a schema file of a few lines
        body = f'<xs:simpleType name="{name}"><xs:annotation/><xs:restriction base="xs:string">{values}</xs:restriction></xs:simpleType><xs:simpleType name="other"><xs:restriction base="xs:int"/></xs:simpleType>'
        tb.put_file(t.spark, f"{path}/{name}.xsd", f'<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">{body}</xs:schema>'.encode())
    known = settle(tb.read_named_code_lists(t.spark, path), "codes")
    held = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation"))
    return nz.stack([ql.unknown_codes(held, name, known.filter(F.col("list") == name)).select(F.lit(name).alias("list"), F.col(name).alias("code"), "n_rows") for name in lists])


@query("a90_range_and_presence", """
    SELECT 'balance' AS rule, count(*) AS n_checked, count(*) FILTER (c_acctbal <= 0) AS n_bad FROM customer
    UNION ALL SELECT 'name', count(*), count(*) FILTER (c_name IS NULL OR c_name = '') FROM customer
    UNION ALL SELECT 'discount', count(*), count(*) FILTER (NOT (l_discount * 100 > 0 AND l_discount * 100 <= 100)) FROM lineitem""")
def range_and_presence(t):
    c = ql.rule_counts(t.customer, {"balance": F.col("c_acctbal") > 0, "name": F.coalesce(F.col("c_name") != "", F.lit(False))})
    return nz.stack([c, ql.rule_counts(t.lineitem, {"discount": ql.percent_rule(F.col("l_discount") * 100)})])


@query("a91_uniqueness_check", "SELECT l_orderkey, l_linenumber, l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1")
def uniqueness_check(t):
    return ql.repeated(t.lineitem, ["l_orderkey", "l_linenumber", "l_suppkey"])


@query("a91_one_form_per_language", """
    SELECT l_orderkey, ['DE', 'EN', 'FR'][l_linenumber % 3 + 1] AS language, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def one_form_per_language(t):
    """Lines as the forms of a notice, which may have one in each language."""
    language = F.element_at(F.array(*[F.lit(x) for x in ("DE", "EN", "FR")]), F.col("l_linenumber") % 3 + 1)
    return ql.repeated(t.lineitem.select("l_orderkey", language.alias("language")), ["l_orderkey", "language"])


@query("a92_change_log_rows", """
    SELECT o_orderkey, n AS change_no, CASE n WHEN 1 THEN 'status' ELSE 'priority' END AS "where", CASE n WHEN 1 THEN o_orderstatus ELSE o_orderpriority END AS old_value,
           CASE n WHEN 1 THEN 'X' ELSE lower(o_orderpriority) END AS new_value FROM orders, (SELECT unnest([1, 2]) AS n)""")
def change_log_rows(t):
    change = lambda where, old, new: F.struct(F.lit(where).alias("where"), old.alias("old_value"), new.alias("new_value"))
    p = F.col("o_orderpriority")
    return ql.change_rows(t.orders.select("o_orderkey", F.array(change("status", F.col("o_orderstatus"), F.lit("X")), change("priority", p, F.lower(p))).alias("changes")), "changes")


@query("a93_award_rows", """
    SELECT o_orderkey, lot, value, CASE WHEN lot = 1 THEN 'C' || o_custkey WHEN o_orderstatus = 'F' THEN 'D' || o_custkey END AS contractor,
           (lot = 1 OR o_orderstatus = 'F') AS awarded FROM (SELECT *, unnest([1, 2]) AS lot, o_totalprice AS value FROM orders)
    UNION ALL SELECT o_orderkey, 1, o_totalprice, 'E' || o_custkey, true FROM orders""")
def award_rows(t):
    name = lambda p: F.concat(F.lit(p), "o_custkey")
    lot = lambda n, who: F.struct(F.lit(n).alias("lot"), F.col("o_totalprice").alias("value"), who.alias("contractors"))
    second = F.when(F.col("o_orderstatus") == "F", F.array(name("D")))
    nested = t.orders.select("o_orderkey", F.array(lot(1, F.array(name("C"), name("E"))), lot(2, second)).alias("awards"))
    return ql.award_rows(nested, "awards")


@query("a94_duration_normalisation", """
    SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber % 3 WHEN 0 THEN l_quantity WHEN 1 THEN l_quantity * 30.4375 ELSE l_quantity * 365.25 END AS days,
           CASE l_linenumber % 3 WHEN 0 THEN l_shipdate::DATE + l_quantity::INT WHEN 1 THEN (l_shipdate::DATE + to_months(l_quantity::INT))::DATE ELSE (l_shipdate::DATE + to_months(12 * l_quantity::INT))::DATE END AS ends FROM lineitem""")
def duration_normalisation(t):
    unit = F.expr("element_at(array('DAY', 'MONTH', 'YEAR'), cast(l_linenumber % 3 + 1 as int))")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", ql.duration_days(F.col("l_quantity"), unit).alias("days"),
                             ql.duration_end(F.col("l_shipdate").cast("date"), F.col("l_quantity"), unit).alias("ends"))
