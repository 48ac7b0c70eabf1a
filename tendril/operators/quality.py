"""Data contract checks: patterns, code lists, ranges, presence and uniqueness; change, award and duration rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import col

# Text patterns of the notice format.
PATTERNS = {
    "date": r"(20)[0-9]{2}(1[0-2]|0[1-9])((3[0-1])|([1-2][0-9])|(0[1-9]))",
    "datetime": r"(20)[0-9]{2}(1[0-2]|0[1-9])((3[0-1])|([1-2][0-9])|(0[1-9]))( ((2[0-3])|([0-1][0-9])):[0-5][0-9])?",
    "document_number": r"[0-9][0-9]{0,5}\-(19|20)[0-9]{2}",
    "notice_number": r"(19|20)\d{2}/S \d{3}-\d{6}",
    "amount": r"\d{1,13}(\.\d{1,2})?",
    "time": r"(([0-1]?[0-9])|(2[0-3])):[0-5][0-9]",
    "full_date": r"(19|20).{8}",
    "phone": r"(\+\d{1,3}\s\d+(\-\d+)*((\s)?/(\s)?(\+\d{1,3}\s)?\d+(\-\d+)*)*)",
    "e_mail": r"[^@]+@[^\.]+\..+",
    "url": r"""(((http|HTTP|https|HTTPS|ftp|FTP|ftps|FTPS|sftp|SFTP)://)|((w|W){3}(\d)?\.))[\w\?!\./:;,\-_=#+*%@"\(\)&]+""",
}


def matches(value: Column, rule: str) -> Column:
    """Whole-value pattern test."""
    return value.rlike(f"^(?:{PATTERNS[rule]})$")


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Checked and violating values per rule, all rules in one aggregation; a null test result is not checked."""
    aggs = []
    for name, holds in rules.items():
        aggs += [F.count(holds).alias(f"{name}|n_checked"), F.count_if(~holds).alias(f"{name}|n_bad")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), col(f"{n}|n_checked").alias("n_checked"), col(f"{n}|n_bad").alias("n_bad")) for n in rules])
    return wide.select(F.inline(rows))


def pattern_rules(columns: dict[str, str]) -> dict[str, Column]:
    """Rules by name from a (column -> pattern name) map."""
    return {f"{c}:{p}": matches(col(c), p) for c, p in columns.items()}


def amount_rule(value: Column) -> Column:
    return matches(value, "amount") & (value.try_cast("decimal(15,2)") > 0)


def percent_rule(value: Column) -> Column:
    return (value > 0) & (value <= 100)


def unknown_codes(df: DataFrame, column: str, codes: DataFrame, code: str = "code") -> DataFrame:
    """Values outside a code list with their number of rows; counted first, so the list meets each value once."""
    counts = df.filter(col(column).isNotNull()).groupBy(col(column)).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(codes.select(col(code).alias(column)), column, "left_anti")


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that must be unique but are not."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def change_rows(df: DataFrame, changes: str) -> DataFrame:
    """One row per correction (location, old value, new value) of a corrigendum, numbered from 1."""
    rows = df.select(*[col(c) for c in df.columns if c != changes], F.posexplode(col(changes)).alias("_i", "_c"))
    return rows.select(*[col(c) for c in df.columns if c != changes], (col("_i") + 1).alias("change_no"), "_c.*").drop("_i")


def award_rows(df: DataFrame, awards: str) -> DataFrame:
    """One row per (award, contractor), the pairing kept; an award without contractors stays as one row."""
    keep = [c for c in df.columns if c != awards]
    lots = df.select(*[col(c) for c in keep], F.explode(col(awards)).alias("_a"))
    fields = [f for f in lots.schema["_a"].dataType.fieldNames() if f != "contractors"]
    rows = lots.select(*[col(c) for c in keep], *[col("_a")[f].alias(f) for f in fields], F.explode_outer(col("_a")["contractors"]).alias("contractor"))
    return rows.withColumn("awarded", col("contractor").isNotNull())


def duration_days(value: Column, unit: Column) -> Column:
    """Comparable length in days; months and years by average length."""
    return F.when(unit == "DAY", value).when(unit == "MONTH", value * 30.4375).when(unit == "YEAR", value * 365.25)


def duration_end(start: Column, value: Column, unit: Column) -> Column:
    """Calendar end of a duration."""
    v = value.cast("int")
    return F.when(unit == "DAY", F.date_add(start, v)).when(unit == "MONTH", F.add_months(start, v)).when(unit == "YEAR", F.add_months(start, v * 12))
