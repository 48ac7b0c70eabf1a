"""Daily archives of notice documents: inventory, names and members."""

from __future__ import annotations

import io
import tarfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NAME = r"(\d{4})(\d{2})(\d{2})_(\d{4})(\d{3})\.tar(?:\.gz)?$"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def package_id(path: Column) -> Column:
    """Base name without extensions, dashes for underscores: the key shared by archives and extracted files."""
    return F.translate(F.substring_index(base_name(path), ".", 1), "_", "-")


def member_directory(path: Column) -> Column:
    """Directory an archive unpacks to: its date and its three-digit issue number."""
    return F.concat(F.regexp_extract(path, r"(\d{8})_", 1), F.lit("_"), F.regexp_extract(path, NAME, 5))


def month_file(path: Column) -> Column:
    """Name of the file that collects a package's month."""
    return F.concat(F.substring(base_name(path), 1, 6), F.lit("00_ALL.parquet"))


def describe_packages(listing: DataFrame, path: str = "path") -> DataFrame:
    """Name, date, year, month and issue of each package path; other files are left out."""
    p = F.col(path)
    found = listing.filter(p.rlike(NAME))
    part = lambda i: F.regexp_extract(p, NAME, i)
    return found.select(
        base_name(p).alias("name"), F.try_to_date(F.concat(part(1), part(2), part(3)), "yyyyMMdd").alias("date"),
        part(1).cast("int").alias("year"), part(2).cast("int").alias("month"), part(5).alias("issue"), package_id(p).alias("package"))


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """Packages below a folder; the content column is pruned, so no archive is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.tar*").load(root)
    listing = files.select("path", "length", "modificationTime")
    return describe_packages(listing.select("path")).join(
        listing.select(base_name(F.col("path")).alias("name"), "path", "length", "modificationTime"), "name")


def year_month_folders(spark: SparkSession, first_year: int = 2011, last_year: int | None = None, year: int | None = None, month: int | None = None) -> DataFrame:
    """(year, month) folders to visit; a month without a year is ignored."""
    last = F.year(F.current_date()) if last_year is None else F.lit(last_year)
    years = F.sequence(F.lit(first_year), last) if year is None else F.array(F.lit(year))
    months = F.array(F.lit(month)) if year is not None and month is not None else F.sequence(F.lit(1), F.lit(12))
    pairs = spark.range(1).select(F.explode(years).alias("year")).select("year", F.explode(months).alias("month"))
    return pairs.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))


MEMBERS = "package string, member string, value string, error string"


def unpack(archives: DataFrame, suffix: str = ".xml") -> DataFrame:
    """Text of each archive member; ``archives`` has ``path`` and ``content``.

    An archive is one compressed stream, so one task reads it, member by member. An archive or member that cannot be read
    gives a row with an error instead of ending the job. The result is spread over the cluster again.
    """

    def members(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                package = path.rsplit("/", 1)[-1]
                rows = []
                try:
                    with tarfile.open(fileobj=io.BytesIO(content), mode="r:*") as tar:
                        for item in tar:
                            if item.isfile() and item.name.endswith(suffix):
                                try:
                                    rows.append((package, item.name, tar.extractfile(item).read().decode("utf-8"), None))
                                except UnicodeDecodeError as problem:
                                    rows.append((package, item.name, None, str(problem)))
                            if len(rows) >= 256:
                                yield pd.DataFrame(rows, columns=["package", "member", "value", "error"])
                                rows = []
                except (tarfile.TarError, OSError, EOFError, TypeError) as problem:
                    rows.append((package, None, None, str(problem)))
                if rows:
                    yield pd.DataFrame(rows, columns=["package", "member", "value", "error"])

    found = archives.select("path", "content").mapInPandas(members, MEMBERS)
    return found.repartition(F.xxhash64("package", "member"))


def documents(members: DataFrame) -> DataFrame:
    """file, date and value of readable members; the date is the directory part before the underscore."""
    good = members.filter("error is null")
    return good.select(base_name(F.col("member")).alias("file"), F.regexp_extract("member", r"(\d{8})_[^/]*/[^/]*$", 1).alias("date"), "value")


def read_archives(spark: SparkSession, root: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.tar*").load(root)
    return unpack(files)


def read_documents(spark: SparkSession, root: str, glob: str = "*.xml") -> DataFrame:
    """Documents already unpacked to ``<date>_<issue>/<name>.xml`` folders, one row per file."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    return text.select(F.col("_metadata.file_name").alias("file"), F.regexp_extract(path, r"(\d{8})_[^/]*/[^/]*$", 1).alias("date"), "value")


def not_extracted(raw: DataFrame, done: DataFrame, raw_path: str = "path", done_path: str = "path") -> DataFrame:
    """Raw packages without an extracted file."""
    keyed = raw.withColumn("_id", package_id(F.col(raw_path)))
    seen = done.select(package_id(F.col(done_path)).alias("_id")).distinct()
    return keyed.join(seen, "_id", "left_anti").drop("_id")


def newest(packages: DataFrame, n: int, name: str = "name") -> DataFrame:
    return packages.orderBy(F.desc(name)).limit(n)
