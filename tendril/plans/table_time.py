"""Time bins, calendars, date parts and time filters on the benchmark tables."""

from datetime import timedelta
from functools import reduce

from pyspark.sql import functions as F

from ..operators import resample as rs
from .registry import query


@query("b51_resample_with_empty_bins", """
    WITH b AS (SELECT user_id, date_trunc('day', ts) AS ts, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2),
         e AS (SELECT user_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM b GROUP BY 1)
    SELECT user_id, ts, coalesce(n, 0) AS n, total FROM e LEFT JOIN b USING (user_id, ts)""")
def resample_daily(t):
    out = rs.resample(t.events, ["user_id"], "ts", timedelta(days=1), {"n": F.count("*"), "total": F.round(F.sum("value"), 2)})
    return out.na.fill(0, ["n"])


@query("b51_resample_right_closed_offset", """
    WITH b AS (SELECT time_bucket(INTERVAL 6 HOUR, ts - INTERVAL 1 MICROSECOND, INTERVAL 2 HOUR) + INTERVAL 6 HOUR AS ts, value, ts AS t FROM events)
    SELECT ts, count(*) AS n, arg_min(value, t) AS open, arg_max(value, t) AS close FROM b GROUP BY 1""")
def resample_right_closed(t):
    aggs = {"n": F.count("*"), "open": F.min_by("value", "ts"), "close": F.max_by("value", "ts")}
    return rs.resample(t.events, [], "ts", timedelta(hours=6), aggs, closed="right", label="right", base=timedelta(hours=2), empty_bins=False)


@query("b51_monthly_grouper", """
    WITH b AS (SELECT o_orderstatus, date_trunc('month', o_orderdate)::TIMESTAMP AS o_orderdate, round(avg(o_totalprice) + 1e-6, 4) AS mean FROM orders GROUP BY 1, 2),
         e AS (SELECT o_orderstatus, unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 MONTH)) AS o_orderdate FROM b GROUP BY 1)
    SELECT * FROM e LEFT JOIN b USING (o_orderstatus, o_orderdate)""")
def monthly_grouper(t):
    return rs.resample(t.orders, ["o_orderstatus"], "o_orderdate", "month", {"mean": F.round(F.avg("o_totalprice") + 1e-6, 4)})


_ENDS = {  # rule, its label in SQL
    "week_end": "date_trunc('week', d) + INTERVAL 6 DAY",
    "month_end": "last_day(d)",
    "quarter_end": "date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY",
    "work_day": "d - greatest(isodow(d) - 5, 0)::INT",
    "work_month_end": """CASE WHEN d > last_day(d) - greatest(isodow(last_day(d)) - 5, 0)::INT THEN last_day(d + 7) - greatest(isodow(last_day(d + 7)) - 5, 0)::INT
        ELSE last_day(d) - greatest(isodow(last_day(d)) - 5, 0)::INT END""",
}


_UNIT_ENDS = " UNION ALL ".join(f"""
    SELECT o_orderstatus, '{rule}' AS rule, g.bin, coalesce(n, 0) AS n, top
    FROM (SELECT DISTINCT ({label})::TIMESTAMP AS bin FROM days) g
    JOIN (SELECT o_orderstatus, min(({label})::TIMESTAMP) AS lo, max(({label})::TIMESTAMP) AS hi FROM o GROUP BY 1) e ON g.bin BETWEEN lo AND hi
    LEFT JOIN (SELECT o_orderstatus, ({label})::TIMESTAMP AS bin, count(*) AS n, max(o_totalprice) AS top FROM o GROUP BY 1, 2) b USING (o_orderstatus, bin)""" for rule, label in _ENDS.items())


@query("b51_unit_ends", f"""
    WITH o AS (SELECT o_orderstatus, o_orderdate::DATE AS d, o_totalprice FROM orders),
         days AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM o)
    {_UNIT_ENDS}""")
def unit_ends(t):
    """Bins of weeks, months, quarters, working days and months of working days, labelled as their rule says."""
    parts = []
    for rule in _ENDS:
        out = rs.resample(t.orders, ["o_orderstatus"], "o_orderdate", rule, {"n": F.count("*"), "top": F.max("o_totalprice")}).na.fill(0, ["n"])
        parts.append(out.select("o_orderstatus", F.lit(rule).alias("rule"), F.col("o_orderdate").alias("bin"), "n", "top"))
    return reduce(lambda a, b: a.unionByName(b), parts)


_UP = """
    WITH h AS (SELECT user_id, date_trunc('day', ts) AS ts, max(value) AS v FROM events WHERE event_type = 'signup' GROUP BY 1, 2),
         g AS (SELECT user_id, unnest(generate_series(min(ts), max(ts), INTERVAL 12 HOUR)) AS ts FROM h GROUP BY 1),
         j AS (SELECT user_id, ts, v FROM g LEFT JOIN h USING (user_id, ts))"""


def _signups(t):
    e = t.events.filter("event_type = 'signup'")
    return e.groupBy("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ts")).agg(F.max("value").alias("v"))


@query("b52_upsample_pad", _UP + " SELECT user_id, ts, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts) AS v FROM j")
def upsample_pad(t):
    return rs.upsample(_signups(t), ["user_id"], "ts", timedelta(hours=12), ["v"])


@query("b52_upsample_backfill_limit", _UP + """
    SELECT user_id, ts, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS v FROM j""")
def upsample_backfill(t):
    return rs.upsample(_signups(t), ["user_id"], "ts", timedelta(hours=12), ["v"], "backfill", limit=2)


@query("b52_upsample_interpolate", _UP + """,
    n AS (SELECT *, last_value(v IGNORE NULLS) OVER a AS pv, max(CASE WHEN v IS NOT NULL THEN ts END) OVER a AS pt,
                 first_value(v IGNORE NULLS) OVER z AS nv, min(CASE WHEN v IS NOT NULL THEN ts END) OVER z AS nt FROM j
          WINDOW a AS (PARTITION BY user_id ORDER BY ts), z AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT user_id, ts, round(CASE WHEN v IS NOT NULL THEN v ELSE pv + (nv - pv) * (epoch(ts) - epoch(pt)) / (epoch(nt) - epoch(pt)) END + 1e-8, 6) AS v FROM n""")
def upsample_interpolate(t):
    out = rs.upsample(_signups(t), ["user_id"], "ts", timedelta(hours=12), ["v"], "interpolate")
    return out.withColumn("v", F.round(F.col("v") + 1e-8, 6))


@query("b52_upsample_nearest", _UP + """,
    n AS (SELECT *, last_value(v IGNORE NULLS) OVER a AS pv, max(CASE WHEN v IS NOT NULL THEN ts END) OVER a AS pt,
                 first_value(v IGNORE NULLS) OVER z AS nv, min(CASE WHEN v IS NOT NULL THEN ts END) OVER z AS nt FROM j
          WINDOW a AS (PARTITION BY user_id ORDER BY ts), z AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT user_id, ts, CASE WHEN v IS NOT NULL THEN v WHEN (epoch(ts) - epoch(pt)) * 2 <= epoch(nt) - epoch(pt) THEN pv ELSE nv END AS v FROM n""")
def upsample_nearest(t):
    return rs.upsample(_signups(t), ["user_id"], "ts", timedelta(hours=12), ["v"], "nearest")


@query("b52_upsample_asfreq", _UP + " SELECT user_id, ts, v FROM j")
def upsample_asfreq(t):
    return rs.upsample(_signups(t), ["user_id"], "ts", timedelta(hours=12), ["v"], "asfreq")


@query("b53_date_ranges", """
    SELECT d AS date, n FROM (SELECT unnest(generate_series(date_trunc('day', min(o_orderdate)), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)
    LEFT JOIN (SELECT date_trunc('day', o_orderdate) AS d, count(*) AS n FROM orders GROUP BY 1) USING (d) WHERE isodow(d) < 6""")
def date_ranges(t):
    lo, hi = t.orders.agg(F.date_trunc("day", F.min("o_orderdate")).cast("string"), F.max("o_orderdate").cast("string")).first()
    days = rs.date_range(t.spark, lo, hi, business=True)
    counts = t.orders.groupBy(F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("date")).agg(F.count("*").alias("n"))
    return days.join(counts, "date", "left")


_MONTH_END_WORKING = "(CASE WHEN isodow(last_day(d)) > 5 THEN last_day(d) - (isodow(last_day(d)) - 5)::INT ELSE last_day(d) END)"
_RULES = {
    "ME": "d = last_day(d)", "QS": "day(d) = 1 AND month(d) % 3 = 1", "YE": "month(d) = 12 AND day(d) = 31", "BME": f"d = {_MONTH_END_WORKING}", "BQE": f"d = {_MONTH_END_WORKING} AND month(d) % 3 = 0",
    "BMS": "d = (date_trunc('month', d)::DATE + (CASE isodow(date_trunc('month', d)) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END)::INT)", "SME": "day(d) = 15 OR d = last_day(d)",
    "W-WED": "isodow(d) = 3", "WOM-2TUE": "isodow(d) = 2 AND day(d) BETWEEN 8 AND 14", "LWOM-FRI": "isodow(d) = 5 AND month(d + 7) <> month(d)"}


@query("b53_anchored_dates", "WITH n AS (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1), days AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM n)\n" + " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, d AS date, n FROM days LEFT JOIN n USING (d) WHERE {sql}" for rule, sql in _RULES.items()))
def anchored_dates(t):
    """Orders of the days that calendar rules name, from the first order's day to the last one's."""
    lo, hi = t.orders.agg(F.min("o_orderdate").cast("date").cast("string"), F.max("o_orderdate").cast("date").cast("string")).first()
    dates = [rs.anchored_dates(t.spark, rule, lo, hi).select(F.lit(rule).alias("rule"), "date") for rule in _RULES]
    counts = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count("*").alias("n"))
    return reduce(lambda a, b: a.unionByName(b), dates).join(counts, "date", "left").select("rule", "date", "n")


@query("b54_date_parts_and_flags", """
    SELECT o_orderkey, year(o_orderdate)::INT AS y, quarter(o_orderdate)::INT AS q, dayofyear(o_orderdate)::INT AS doy, weekofyear(o_orderdate)::INT AS wk,
           isodow(o_orderdate)::INT - 1 AS wd, dayname(o_orderdate) AS dname, monthname(o_orderdate) AS mname, day(o_orderdate) = 1 AS month_start,
           o_orderdate::DATE = last_day(o_orderdate) AS month_end, (month(o_orderdate) % 3 = 1 AND day(o_orderdate) = 1) AS quarter_start,
           dayofyear(make_date(year(o_orderdate), 12, 31)) = 366 AS leap, day(last_day(o_orderdate))::INT AS month_days FROM orders""")
def date_parts(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.year(d).alias("y"), F.quarter(d).alias("q"), F.dayofyear(d).alias("doy"), F.weekofyear(d).alias("wk"), F.weekday(d).alias("wd"),
        F.date_format(d, "EEEE").alias("dname"), F.date_format(d, "MMMM").alias("mname"), (F.dayofmonth(d) == 1).alias("month_start"),
        (d.cast("date") == F.last_day(d)).alias("month_end"), ((F.month(d) % 3 == 1) & (F.dayofmonth(d) == 1)).alias("quarter_start"),
        (F.dayofyear(F.make_date(F.year(d), F.lit(12), F.lit(31))) == 366).alias("leap"), F.dayofmonth(F.last_day(d)).alias("month_days"))


@query("b54_time_parts_and_rounding", """
    SELECT event_id, hour(ts)::INT AS h, minute(ts)::INT AS m, (epoch_us(ts) % 1000000)::BIGINT AS micro, date_trunc('day', ts) AS normalised,
           time_bucket(INTERVAL 15 MINUTE, ts) AS quarter_hour FROM events""")
def time_parts(t):
    ts = F.col("ts")
    return t.events.select("event_id", F.hour(ts).alias("h"), F.minute(ts).alias("m"), (rs.micros(ts) % 1000000).alias("micro"),
                           F.date_trunc("day", ts).cast("timestamp_ntz").alias("normalised"), rs.time_bin(ts, timedelta(minutes=15)).alias("quarter_hour"))


@query("b55_between_time", "SELECT event_id FROM events WHERE ts::TIME >= TIME '22:30:00' OR ts::TIME <= TIME '01:15:00'")
def between_time(t):
    return rs.between_time(t.events, "ts", "22:30", "01:15").select("event_id")


@query("b55_at_time_and_truncate", """
    SELECT o_orderkey, date_trunc('month', o_orderdate)::TIMESTAMP AS month FROM orders WHERE o_orderdate::TIME = TIME '00:00:00'""")
def at_time(t):
    return rs.at_time(t.orders, "o_orderdate", "00:00:00").select("o_orderkey", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month"))


@query("b55_first_and_last_span", """
    SELECT 'first' AS pick, event_id FROM events WHERE epoch_us(ts) < (SELECT epoch_us(min(ts)) + 3 * 86400000000 FROM events)
    UNION ALL SELECT 'last' AS pick, event_id FROM events WHERE epoch_us(ts) > (SELECT epoch_us(max(ts)) - 86400000000 FROM events)""")
def first_and_last_span(t):
    e = t.events.select("event_id", "ts")
    first = rs.first_span(e, "ts", timedelta(days=3)).withColumn("pick", F.lit("first"))
    return first.unionByName(rs.last_span(e, "ts", timedelta(days=1)).withColumn("pick", F.lit("last"))).drop("ts")


@query("b56_time_zones", """
    SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris' AS paris,
           (ts AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS from_new_york FROM events""")
def time_zones(t):
    return t.events.select("event_id", F.convert_timezone(F.lit("UTC"), F.lit("Europe/Paris"), "ts").alias("paris"),
                           F.convert_timezone(F.lit("America/New_York"), F.lit("UTC"), "ts").alias("from_new_york"))
