"""Table scans and sinks: Parquet by prefix or file list, catalog tables, lists, code lists, text formats and databases."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.grouping import drop_duplicates
from ..operators.normalize import map_columns, stack
from ..operators.ordered import col, settle
from ..operators.profile import drop_empty_columns


def read_prefix(spark: SparkSession, path: str, year: int | str | None = None) -> DataFrame:
    """All Parquet below a prefix, columns of differing files merged; a year becomes a partition filter."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    return df if year is None else df.filter(col("year") == year)


def read_files(spark: SparkSession, root: str, exclude: str = "merged") -> DataFrame:
    """Parquet files below a root whose path does not contain a word."""
    df = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(root)
    return df.filter(~F.col("_metadata.file_path").contains(exclude))


def put_file(spark: SparkSession, path: str, content: bytes) -> None:
    """One small file of given bytes, on whatever file system the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(content))
    out.close()


def list_files(spark: SparkSession, root: str, exclude: str = "merged") -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    return files.filter(~col("path").contains(exclude)).select("path", "length")


def unreadable(spark: SparkSession, root: str, exclude: str = "merged") -> DataFrame:
    """(path, error) of the Parquet files below a root that give no rows although they should.

    Spark's reader is the judge: it passes over what it can't open, so files that are listed but gave no row are suspects. Of these
    only the first and last bytes are looked at, to tell files without rows from broken ones.
    """
    reader = spark.read.option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    gave = reader.schema("_no_such_column string").parquet(root).select(F.col("_metadata.file_path").alias("given")).distinct()
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    suspects = list_files(spark, root, exclude).join(gave, plain(F.col("path")) == plain(F.col("given")), "left_anti").select("path")
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root).select(F.col("path").alias("at"), "length", F.substring("content", 1, 4).alias("head"), F.expr("right(content, 4)").alias("tail"))
    known = suspects.join(content, F.col("path") == F.col("at"))
    magic = F.lit(b"PAR1")
    error = F.when(F.col("length") < 12, "shorter than an empty file").when((F.col("head") != magic) | (F.col("tail") != magic), "no marks at its ends")
    return known.select("path", error.alias("error")).filter("error IS NOT NULL")


def read_tolerant(spark: SparkSession, root: str, mapping: list[tuple[str, str, str]], exclude: str = "merged") -> tuple[DataFrame, DataFrame]:
    """(rows of all readable files under one mapping, quarantined files)."""
    bad = settle(unreadable(spark, root, exclude), "quarantine")
    df = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True)
    df = df.option("pathGlobFilter", "*.parquet").parquet(root).filter(~F.col("_metadata.file_path").contains(exclude))
    return map_columns(df, mapping), bad


def catalog_tables(spark: SparkSession, prefix: str, database: str | None = None) -> DataFrame:
    """All catalog tables whose name starts with a prefix, stacked by column name."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if t.name.startswith(prefix))
    if not names:
        raise AnalysisException(f"no table named {prefix}*")
    return stack([spark.table(f"`{database}`.`{n}`" if database else f"`{n}`") for n in names])


def read_list(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """Headerless CSV or a plain list of lines."""
    df = spark.read.csv(path, header=False, schema=", ".join(f"`{n}` string" for n in names))
    return df


def read_code_list(spark: SparkSession, path: str) -> DataFrame:
    """Values of the enumerations in a schema file, as text."""
    df = spark.read.format("xml").option("rowTag", "xs:enumeration").schema("_value string").load(path)
    return df.select(F.col("_value").alias("code")).distinct()


def read_named_code_lists(spark: SparkSession, path: str) -> DataFrame:
    """(list, code) of the simple types with enumerations in schema files, one row per value."""
    declared = "_name string, `xs:restriction` struct<_base: string, `xs:enumeration`: array<struct<_value: string>>>"
    df = spark.read.format("xml").option("rowTag", "xs:simpleType").schema(declared).load(path)
    return df.select(F.col("_name").alias("list"), F.explode("`xs:restriction`.`xs:enumeration`._value").alias("code")).distinct()


def read_fixed_width(spark: SparkSession, path: str, fields: dict[str, tuple[int, int]]) -> DataFrame:
    """Lines cut at 1-based (start, length) positions, trimmed."""
    lines = spark.read.text(path)
    return lines.select(*[F.trim(F.substring("value", a, n)).alias(name) for name, (a, n) in fields.items()])


def read_partitions(spark: SparkSession, path: str, filters: list[list[tuple[str, str, object]]] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Partitioned dataset with a disjunction of conjunctions of (column, operator, value); partitions are pruned."""
    df = spark.read.parquet(path)
    if filters:
        test = {"=": lambda c, v: c == v, "==": lambda c, v: c == v, "!=": lambda c, v: c != v, "<": lambda c, v: c < v, ">": lambda c, v: c > v,
                "<=": lambda c, v: c <= v, ">=": lambda c, v: c >= v, "in": lambda c, v: c.isin(list(v)), "not in": lambda c, v: ~c.isin(list(v))}
        conj = [reduce(lambda a, b: a & b, [test[op](col(c), v) for c, op, v in group]) for group in filters]
        df = df.filter(reduce(lambda a, b: a | b, conj))
    return df.select(*[col(c) for c in columns]) if columns else df


def read_database(spark: SparkSession, url: str, table: str, key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 32, **options: str) -> DataFrame:
    """Database table; with a numeric key and its bounds the read is split into parallel ranges."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts)
    return reader.load()


def write_database(df: DataFrame, url: str, table: str, mode: str = "append", parts: int = 16, **options: str) -> None:
    df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).option("numPartitions", parts).options(**options).save()


def write_packages(df: DataFrame, path: str, package: Column) -> None:
    """Extracted rows under package=<id> within year and month; a rerun of a package replaces only its own files."""
    keyed = df.withColumn("package", package)
    keyed = keyed.withColumns({"year": F.substring("package", 1, 4), "month": F.substring("package", 5, 2)})
    parts = ["year", "month", "package"]
    # rebalancing gathers a package's rows but splits a package that would be one huge task
    keyed.hint("rebalance", *[F.col(p) for p in parts]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def append_years(df: DataFrame, path: str, year: str = "year", files_per_year: int | None = None, max_records: int = 5_000_000) -> None:
    """Append to a table partitioned by year.

    By default rows are rebalanced by year: small years become one file each, a large year is split over many tasks.
    ``files_per_year`` fixes the number of files instead; one is the single-file output.
    """
    if files_per_year is None:
        spread = df.hint("rebalance", F.col(year))
    else:
        slot = F.pmod(F.xxhash64(*[col(c) for c in df.columns]), F.lit(files_per_year))
        spread = df.withColumn("_slot", slot).repartition(F.col(year), F.col("_slot")).drop("_slot")
    spread.write.mode("append").option("maxRecordsPerFile", max_records).partitionBy(year).parquet(path)


def merge_year(spark: SparkSession, source: str, target: str, year: str, mapping: list[tuple[str, str, str]]) -> DataFrame:
    """Merge the extracted files of a year into the yearly table: typed columns, empty ones left out at the sink."""
    typed = map_columns(read_prefix(spark, source, year), mapping)
    out = drop_empty_columns(typed)
    out = out if "year" in out.columns else out.withColumn("year", F.lit(year))
    append_years(out, target)
    return out


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a whole table. The result is complete before the old one goes."""
    settle(df, "result").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def compact_month(spark: SparkSession, path: str, new: DataFrame, month: str, keys: list[str], order: list[str]) -> DataFrame:
    """Add rows to a month of a month-partitioned table and rewrite it; rows already there (by key) are not doubled.

    The combined month is settled in scratch before the partition is replaced, so a lost job leaves one full copy.
    """
    new = new.withColumn("month", F.lit(month))
    try:
        old = spark.read.parquet(path).withColumn("month", F.col("month").cast("string")).filter(F.col("month") == month)
        both = stack([old, new])
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem) and "UNABLE_TO_INFER_SCHEMA" not in str(problem):
            raise
        both = new
    full = settle(drop_duplicates(both, keys, order, keep="last"), "month")
    full.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    return full


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Expose a Parquet folder, with its partitions, as a catalog table."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    try:
        spark.catalog.recoverPartitions(name)
    except AnalysisException:
        pass  # a folder without partitions


def json_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """One JSON object of strings per row."""
    return df.select(F.to_json(F.struct(*[col(c).cast("string").alias(c) for c in columns])).alias("json"))
