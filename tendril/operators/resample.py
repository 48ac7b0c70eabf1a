"""Fixed-frequency time bins, calendars and time filters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fills import fill, interpolate
from .ordered import col, equi_join

NTZ = "timestamp_ntz"


def micros(value: Column) -> Column:
    return F.unix_micros(value.cast("timestamp"))


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value).cast(NTZ)


@dataclass(frozen=True)
class Rule:
    """A calendar unit: the label of the bin that holds a time, the start of the unit, and the months or days to the next one."""

    start: Callable[[Column], Column]
    label: Callable[[Column], Column]  # of a start
    months: int = 0
    days: int = 0


def _trunc(unit: str) -> Callable[[Column], Column]:
    return lambda ts: F.date_trunc(unit, ts).cast("date")


def _unit_end(months: int) -> Callable[[Column], Column]:
    return lambda start: F.last_day(F.add_months(start, months - 1))


def _work_day_before(day: Column) -> Column:
    """The day itself, or the Friday before a weekend."""
    return F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0)))


def _work_month(ts: Column) -> Column:
    """The first day of the month whose last working day is the next at or after ``ts``."""
    month = F.date_trunc("month", ts).cast("date")
    return F.when(ts.cast("date") > _work_day_before(F.last_day(month)), F.add_months(month, 1)).otherwise(month)


_SAME = lambda start: start

# Units labelled by their first day, and those closed and labelled on the right, by their last.
RULES = {
    "week": Rule(_trunc("week"), _SAME, days=7),
    "month": Rule(_trunc("month"), _SAME, months=1),
    "quarter": Rule(_trunc("quarter"), _SAME, months=3),
    "year": Rule(_trunc("year"), _SAME, months=12),
    "week_end": Rule(_trunc("week"), lambda start: F.date_add(start, 6), days=7),
    "month_end": Rule(_trunc("month"), _unit_end(1), months=1),
    "quarter_end": Rule(_trunc("quarter"), _unit_end(3), months=3),
    "year_end": Rule(_trunc("year"), _unit_end(12), months=12),
    "work_month_end": Rule(_work_month, lambda start: _work_day_before(F.last_day(start)), months=1),
    "work_day": Rule(lambda ts: _work_day_before(ts.cast("date")), _SAME, days=1),  # a weekend belongs to its Friday
}
BLOCK = 4096


def time_bin(ts: Column, rule: timedelta | str, closed: str = "left", label: str = "left", base: timedelta = timedelta(0)) -> Column:
    """Label of the bin holding ``ts``: a fixed width, or the name of one of ``RULES``."""
    if isinstance(rule, str):
        return RULES[rule].label(RULES[rule].start(ts)).cast(NTZ)
    width, shift = rule // timedelta(microseconds=1), base // timedelta(microseconds=1)
    t = micros(ts) - shift
    start = F.floor(t / width) if closed == "left" else F.ceil(t / width) - 1
    return from_micros(((start + (1 if label == "right" else 0)) * width + shift).cast("long"))


def _numbers(df: DataFrame, n: Column) -> DataFrame:
    """Each row once per number ``_i`` from 0 to n, dealt out in blocks: one row's numbers may be many."""
    blocks = df.withColumn("_n", n.cast("long")).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(col("_n") / BLOCK))).alias("_block"))
    first = col("_block") * BLOCK
    dealt = blocks.repartition(*[col(c) for c in df.columns], col("_block"))
    return dealt.select(*[col(c) for c in df.columns], F.explode(F.sequence(first, F.least(first + BLOCK - 1, col("_n")))).alias("_i"))


def calendar(df: DataFrame, by: list[str], on: str, rule: timedelta | str) -> DataFrame:
    """Every bin label between the first and last label of each group."""
    ends = df.groupBy(*[col(k) for k in by]).agg(F.min(col(on)).alias("_lo"), F.max(col(on)).alias("_hi")).filter(col("_lo").isNotNull())
    i = col("_i").cast("int")
    if not isinstance(rule, str):
        width = rule // timedelta(microseconds=1)
        made = _numbers(ends, F.floor((micros(col("_hi")) - micros(col("_lo"))) / width))
        return made.select(*[col(k) for k in by], from_micros(micros(col("_lo")) + col("_i") * width).alias(on))
    unit = RULES[rule]
    lo, hi = unit.start(col("_lo")), unit.start(col("_hi"))
    steps = (F.months_between(hi, lo) / unit.months) if unit.months else F.datediff(hi, lo) / unit.days
    # months are counted from the start of a unit, so no day is out of range
    at = F.add_months(lo, i * unit.months) if unit.months else F.date_add(lo, i * unit.days)
    made = _numbers(ends, F.round(steps)).withColumn("_at", at)
    if rule == "work_day":
        made = made.filter(F.weekday(col("_at")) < 5)
    return made.select(*[col(k) for k in by], unit.label(col("_at")).cast(NTZ).alias(on))


def resample(
    df: DataFrame, by: list[str], on: str, rule: timedelta | str, aggs: dict[str, Column], empty_bins: bool = True, **bins
) -> DataFrame:
    """Aggregate into time bins; bins without rows appear with nulls (fill counts and sums with 0 as wanted)."""
    binned = df.withColumn("_bin", time_bin(col(on), rule, **bins))
    out = binned.groupBy(*[col(k) for k in by], "_bin").agg(*[v.alias(n) for n, v in aggs.items()]).withColumnRenamed("_bin", on)
    if not empty_bins:
        return out
    return equi_join(calendar(out, by, on, rule), out, [*by, on])


def upsample(
    df: DataFrame, by: list[str], on: str, rule: timedelta | str, columns: list[str], method: str = "pad", limit: int | None = None
) -> DataFrame:
    """Rows at every step between the first and last time: asfreq, pad, backfill, nearest or interpolate.

    Pad and backfill see the original rows between the steps, as an as-of lookup would.
    """
    grid = calendar(df, by, on, rule)
    marked = df.select(*[col(k) for k in by], col(on), *[col(c) for c in columns]).withColumn("_src", F.lit(1))
    both = equi_join_outer(grid.withColumn("_grid", F.lit(1)), marked, [*by, on])
    if method in ("pad", "backfill"):
        both = fill(both, by, [on], columns, "forward" if method == "pad" else "backward", limit)
    elif method in ("nearest", "interpolate"):
        for c in columns:
            both = interpolate(both, by, [on], c, "nearest" if method == "nearest" else "time")
    elif method != "asfreq":
        raise ValueError(method)
    return both.filter("_grid = 1").select(*[col(k) for k in by], col(on), *[col(c) for c in columns])


def equi_join_outer(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "full_outer")


def date_range(spark, start: str, end: str | None = None, periods: int | None = None, freq: str = "1 day", name: str = "date",
               business: bool = False) -> DataFrame:
    """Evenly spaced timestamps from start to end, or ``periods`` of them; ``business`` keeps Monday to Friday."""
    first, step = f"timestamp_ntz'{start}'", f"interval {freq}"
    if end is not None:
        one, all_ = spark.range(1).selectExpr(*[f"unix_micros(cast({x} as timestamp)) - unix_micros(cast({first} as timestamp))" for x in (f"{first} + {step}", f"timestamp_ntz'{end}'")]).first()
        # no month is shorter than the first by more than a tenth, no year by more than a day
        periods = max(0, int(1.15 * all_ / one) + 2)
    out = spark.range(periods).selectExpr(f"{first} + id * {step} AS {name}")
    if end is not None:
        out = out.filter(col(name) <= F.expr(f"timestamp_ntz'{end}'"))
    return out.filter(F.weekday(col(name)) < 5) if business else out


WEEKDAYS = ["MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN"]


def on_rule(day: Column, rule: str) -> Column:
    """Whether a date is one of those a calendar rule names.

    MS, ME, QS, QE, YS, YE: first or last day of month, quarter or year; the same behind a B: its first or last day from Monday to
    Friday; SMS: the 1st and the 15th; SME: the 15th and the last; W-MON ... W-SUN: that weekday; WOM-2TUE: the second Tuesday of
    each month, LWOM-FRI: the last Friday; B: Monday to Friday; D: every day.
    """
    weekday, last = F.weekday(day), F.last_day(day)
    if rule in ("D", "B"):
        return F.lit(True) if rule == "D" else weekday < 5
    if rule.startswith("W-"):
        return weekday == WEEKDAYS.index(rule[2:])
    if rule.startswith("WOM-"):
        return (weekday == WEEKDAYS.index(rule[5:])) & (F.ceil(F.dayofmonth(day) / 7) == int(rule[4]))
    if rule.startswith("LWOM-"):
        return (weekday == WEEKDAYS.index(rule[5:])) & (F.datediff(last, day) < 7)
    if rule in ("SMS", "SME"):
        return (F.dayofmonth(day) == 15) | ((F.dayofmonth(day) == 1) if rule == "SMS" else (day == last))
    working, unit, start = rule[0] == "B", rule[-2], rule[-1] == "S"
    if unit not in "MQY" or rule[-1] not in "SE" or len(rule) != 2 + working:
        raise ValueError(rule)
    edge = F.trunc(day, "month") if start else last
    if working:
        # the nearest day from Monday to Friday inside the month
        off = F.weekday(edge)
        edge = F.date_add(edge, F.when(off > 4, 7 - off).otherwise(0)) if start else F.date_sub(edge, F.when(off > 4, off - 4).otherwise(0))
    month = F.month(day)
    held = {"M": F.lit(True), "Q": month % 3 == (1 if start else 0), "Y": month == (1 if start else 12)}[unit]
    return held & (day == edge)


def anchored_dates(spark, rule: str, start: str, end: str | None = None, periods: int | None = None, name: str = "date") -> DataFrame:
    """The dates from ``start`` that a calendar rule names (see ``on_rule``), up to ``end`` or ``periods`` of them."""
    if end is None:
        # no rule leaves out more than a year and a few days
        days = spark.range(periods * 373 + 373)
    else:
        days = spark.range(1).selectExpr(f"explode(sequence(0, greatest(datediff(date'{end}', date'{start}'), 0))) AS id")
    out = days.select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias(name))
    out = out.filter(on_rule(col(name), rule) & (F.lit(True) if end is None else col(name) <= F.lit(end).cast("date")))
    return out if end is not None else out.orderBy(name).limit(periods)


def at_time(df: DataFrame, on: str, time: str) -> DataFrame:
    return df.filter(F.date_format(col(on), "HH:mm:ss") == time)


def between_time(df: DataFrame, on: str, start: str, end: str) -> DataFrame:
    """Rows whose time of day lies in [start, end] (HH:mm:ss.SSSSSS); a start after the end wraps over midnight."""
    t = F.date_format(col(on), "HH:mm:ss.SSSSSS")
    pad = lambda s: s + "00:00:00.000000"[len(s) :]
    a, b = t >= pad(start), t <= pad(end)
    return df.filter((a & b) if pad(start) <= pad(end) else (a | b))


def first_span(df: DataFrame, on: str, span: timedelta) -> DataFrame:
    """Rows less than ``span`` after the earliest time."""
    start = df.agg(F.min(micros(col(on))).alias("m")).first()["m"]
    return df.filter(micros(col(on)) < F.lit(start + span // timedelta(microseconds=1)))


def last_span(df: DataFrame, on: str, span: timedelta) -> DataFrame:
    """Rows less than ``span`` before the latest time."""
    end = df.agg(F.max(micros(col(on))).alias("m")).first()["m"]
    return df.filter(micros(col(on)) > F.lit(end - span // timedelta(microseconds=1)))
