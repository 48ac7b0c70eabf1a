"""Ordered computations that stay parallel when one group is huge.

``Window.partitionBy(group)`` sends a whole group to one task. The helpers here cut a group into chunks along the order
columns instead: each (group, chunk) pair is a window of its own, one small summary row per chunk is scanned to get the
state carried into it, and the two are joined back on the same (group, chunk) hash partitioning. A group holding a third
of all rows is thus spread over all chunks, and the result is the one the plain window would give.

Rows whose group key is null belong to no group and get null results.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

CHUNK = "_chunk"
BLOCK = "_block"
CHUNK_ROWS = 16_000_000
SAMPLED = 32


def col(name: str) -> Column:
    """Column by exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def chunk_count(df: DataFrame, rows: int) -> int:
    """Enough chunks for every task of a shuffle, and so many that none is much over ``CHUNK_ROWS``."""
    return max(8, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // CHUNK_ROWS)


def sort_image(df: DataFrame, name: str) -> Column | None:
    """Order-preserving numeric image of a column, or None where there is none (strings)."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col(name).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(col(name))
    if isinstance(kind, T.BooleanType):
        return col(name).cast("int")
    if isinstance(kind, T.NumericType):
        return col(name)
    return None


def cut_points(df: DataFrame, name: str, chunks: int | None = None) -> tuple[list, dict[int, int], int]:
    """Distinct values splitting the column into even parts, which chunk numbers are heavy, and the number of parts.

    Heavy is a value standing at several of the even splits, with the number of them; nulls count like a value. Cut points
    are only hints: any list gives the same result, a good one balances the work. They come from a sample over the whole
    column, of ``SAMPLED`` values a chunk on average.
    """
    image = sort_image(df, name)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count(col(name)).alias("known")).first()
    chunks = chunks or chunk_count(df, row["n"])
    known = df.select((col(name) if image is None else image).alias("v")).filter("v is not null")
    sample = known.sample(min(1.0, SAMPLED * chunks / max(row["known"], 1)), 7).collect()
    values = sorted(r["v"] for r in sample if r["v"] == r["v"])
    splits = [values[i * len(values) // chunks] for i in range(1, chunks)] if values else []
    times = Counter(splits)
    points = sorted(times)
    heavy = {2 * i + 1: times[p] for i, p in enumerate(points) if times[p] > 1}
    nulls = (row["n"] - row["known"]) * chunks // max(row["n"], 1)
    return points, heavy | ({-1: nulls} if nulls else {}), chunks


def _at_least(x: Column, points: list, strict: bool) -> Column:
    terms = [((x > F.lit(p)) if strict else (x >= F.lit(p))).cast("int") for p in points]
    return reduce(lambda a, b: a + b, terms)


def chunk_number(x: Column, points: list) -> Column:
    """2i for values strictly between two cut points, 2i-1 for the i-th cut point itself, -1 for null.

    A heavy value is always a cut point, so it gets a chunk holding nothing else.
    """
    if not points:
        number = F.lit(0)
    elif len(points) <= 48:
        number = _at_least(x, points, True) + _at_least(x, points, False)
    else:  # two-level lookup keeps the comparisons per row near 2*sqrt(n)
        width = math.ceil(math.sqrt(len(points)))
        heads = F.array(*[F.lit(p) for p in points[::width]])
        groups = F.array(*[F.array(*[F.lit(p) for p in points[i : i + width]]) for i in range(0, len(points), width)])
        block = F.size(F.filter(heads, lambda b: b <= x))
        part = F.get(groups, block - 1)
        inner = F.size(F.filter(part, lambda b: b <= x)) + F.size(F.filter(part, lambda b: b < x))
        number = F.when(block == 0, 0).otherwise(2 * width * (block - 1) + inner)
    return F.when(x.isNull(), -1).otherwise(number).cast("long")


def with_number(df: DataFrame, name: str, x: Column, points: list) -> DataFrame:
    """Add ``chunk_number`` of ``x`` as the column ``name``; by binary search where doubles hold the cut points exactly.

    A long that is no double is then beyond all cut points, and stays on its side of them when rounded.
    """
    bounds = [float(p) + 0.0 for p in points if isinstance(p, float) or isinstance(p, int) and abs(p) < 1 << 53]
    splits = [-math.inf, *[b for p in bounds for b in (p, math.nextafter(p, math.inf))], math.inf]
    if not points or len(bounds) < len(points) or any(a >= b for a, b in zip(splits, splits[1:])):
        return df.withColumn(name, chunk_number(x, points))
    # each cut point is a bucket of its own; -0.0 is 0.0, and NaN is above all others
    imaged = df.withColumn("_image", x.cast("double") + F.lit(0.0))
    found = Bucketizer(splits=splits, inputCol="_image", outputCol="_bucket", handleInvalid="keep").transform(imaged)
    number = F.when(col("_image").isNull(), -1).otherwise(F.least(col("_bucket"), F.lit(2.0 * len(points))))
    return found.withColumn(name, number.cast("long")).drop("_image", "_bucket")


def with_chunk(df: DataFrame, order: list[str], chunks: int | None = None) -> DataFrame:
    """Add an order-preserving chunk number.

    A heavy value of the first column is a chunk of its own; such chunks are cut again along the next column, and so on,
    so ties are split as far as the order columns can split them.
    """
    columns = df.columns
    numbers = 1
    for depth, name in enumerate(order):
        points, heavy, chunks = cut_points(df.filter("_heavy") if depth else df, name, chunks)
        numbers *= 2 * len(points) + 3
        if numbers >= 1 << 62:  # a chunk number is a long
            break
        image = sort_image(df, name)
        df = with_number(df, "_number", col(name) if image is None else image, points)
        number = col("_number")
        if depth == 0:
            df = df.withColumn(CHUNK, number).withColumn("_heavy", col(CHUNK).isin(list(heavy)))
        else:
            df = df.withColumn("_part", F.when(col("_heavy"), number + 1).otherwise(F.lit(0)))
            df = df.withColumns({CHUNK: col(CHUNK) * F.lit(2 * len(points) + 3) + col("_part"), "_heavy": col("_heavy") & (col("_part") - 1).isin(list(heavy))})
        if not heavy:
            break
        chunks = max(8, min(chunks, 2 * max(heavy.values())))
    return df.select(*[col(c) for c in columns], CHUNK)


def has_group(by: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [col(k).isNotNull() for k in by], F.lit(True))


def equi_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", null_safe: bool = False) -> DataFrame:
    """Join on equally named keys keeping the left copy."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    match = lambda k: col(k).eqNullSafe(col(f"_r_{k}")) if null_safe else col(k) == col(f"_r_{k}")
    cond = reduce(lambda a, b: a & b, [match(k) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def _order(order: list[str], reverse: bool) -> list[Column]:
    return [col(c).desc() if reverse else col(c).asc() for c in order]


def running(
    df: DataFrame, by: list[str], order: list[str], aggs: dict[str, tuple[str, Column | None]], reverse: bool = False,
    chunks: int | None = None,
) -> DataFrame:
    """Add aggregates running from the first row of the group to the current one (from the last, if ``reverse``).

    ``aggs`` maps an output name to (kind, column). ``order`` should be a total order within a group. Kinds:

    * sum, count, min, max, product;
    * last / next: nearest non-null value at or before / at or after the row, of any type;
    * last_at / next_at: the same as ``struct(v, p)`` with the 0-based group position ``p`` of that value;
    * before_at: like last_at, but strictly before the row;
    * position: 0-based position of the row in the group (column ignored).

    All kinds share one shuffle of the rows.
    """
    work = with_chunk(df.withColumns({f"_in_{i}": F.lit(1) if x is None else x for i, (_, x) in enumerate(aggs.values())}), order, chunks)
    ties = F.struct(*[col(c) for c in order])
    groups = [col(k) for k in by]

    def local(rev: bool):
        w = Window.partitionBy(*groups, CHUNK).orderBy(*_order(order, rev))
        return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def earlier(rev: bool):
        return Window.partitionBy(*groups).orderBy(*_order([CHUNK], rev)).rowsBetween(Window.unboundedPreceding, -1)

    counted = any(kind == "position" or kind.endswith("_at") for kind, _ in aggs.values())
    totals, carries, locals_, outputs = [F.count(F.lit(1)).alias("_rows")], [], {}, {}
    base = F.coalesce(F.sum("_rows").over(earlier(reverse)), F.lit(0)).alias("_base")
    if counted:
        ahead = Window.partitionBy(*groups, CHUNK).orderBy(*_order(order, reverse))
        work = work.withColumn("_rn", F.row_number().over(local(reverse)).cast("long") - 1)
    place = col("_rn") + F.coalesce(col("_base"), F.lit(0))
    for i, (name, (kind, _)) in enumerate(aggs.items()):
        x, t, c, v = col(f"_in_{i}"), f"_t{i}", f"_c{i}", f"_l{i}"
        rev = reverse != kind.startswith("next")
        total = None
        if kind == "position":
            both = place
        elif kind in ("sum", "count", "product"):
            fn = {"sum": F.sum, "count": F.count, "product": F.product}[kind]
            total, scan, roll = fn(x), (F.product(t) if kind == "product" else F.sum(t)), fn(x)
            joint = col(c) * col(v) if kind == "product" else col(c) + col(v)
            both = F.when(col(c).isNull(), col(v)).when(col(v).isNull(), col(c)).otherwise(joint)
        elif kind in ("min", "max"):
            fn, pick = (F.min, F.least) if kind == "min" else (F.max, F.greatest)
            total, scan, roll, both = fn(x), fn(t), fn(x), pick(col(c), col(v))
        elif kind in ("last", "next", "last_at", "next_at", "before_at"):
            at = kind.endswith("_at")
            value = F.when(x.isNotNull(), F.struct(x.alias("v"), col("_rn").alias("p"))) if at else x
            total = (F.min_by if rev else F.max_by)(value, F.when(x.isNotNull(), ties))
            moved = lambda name, by_: F.struct(col(name)["v"].alias("v"), (col(name)["p"] + by_).alias("p"))
            scan = F.last(F.when(col(t).isNotNull(), moved(t, col("_base"))) if at else col(t), True)
            roll = F.last(F.lag(value).over(ahead) if kind == "before_at" else value, True)
            here = F.when(col(v).isNotNull(), moved(v, F.coalesce(col("_base"), F.lit(0)))) if at else col(v)
            both = F.coalesce(here, col(c))
        else:
            raise ValueError(kind)
        if total is not None:
            totals.append(total.alias(t))
            carries.append(scan.over(earlier(rev)).alias(c))
            locals_[v] = roll.over(local(rev))
        outputs[name] = F.when(has_group(by), both) if by else both

    keys = [*by, CHUNK]
    summary = work.groupBy(*[col(k) for k in keys]).agg(*totals)
    if counted:
        summary = summary.select("*", base)
    summary = summary.select(*[col(k) for k in keys], *([col("_base")] if counted else []), *carries)
    joined = equi_join(work.withColumns(locals_), summary, keys)
    return joined.withColumns(outputs).select(*[col(c) for c in dict.fromkeys([*df.columns, *aggs])])


def position(df: DataFrame, by: list[str], order: list[str], name: str = "_pos", reverse: bool = False) -> DataFrame:
    """0-based row position within the group, without putting the group into one task."""
    return running(df, by, order, {name: ("position", None)}, reverse)


def settle(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a small intermediate table to the shared scratch folder and read it back.

    Used where a result is read several times (cut points, summary, rows), so what lies above it runs once.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def halo_blocks(df: DataFrame, pos: Column, size: int, before: int, after: int) -> DataFrame:
    """Copy each row into every block of ``size`` positions whose windows can see it; ``_own`` marks its home block.

    A window reaching ``before`` positions back and ``after`` ahead is complete within the block. Copies per row are
    1 + (before + after) / size on average. Rows without a position are kept, dealt over blocks of their own.
    """
    home = F.floor(pos / size)
    blocks = F.sequence(F.floor((pos - after) / size), F.floor((pos + before) / size))
    apart = F.lit(-(1 << 62)) + F.pmod(F.xxhash64(*[col(c) for c in df.columns]), F.lit(1024))
    work = df.withColumn("_home", F.coalesce(home, apart)).withColumn(BLOCK, F.explode_outer(blocks))
    return work.withColumn(BLOCK, F.coalesce(col(BLOCK), col("_home"))).withColumn("_own", col(BLOCK) == col("_home"))


def drop_halo(df: DataFrame, keep: list[str], made: dict[str, Column]) -> DataFrame:
    """Columns ``keep`` and ``made`` of the home rows; a row without a position gets null."""
    placed = {name: F.when(col("_pos").isNotNull(), value) for name, value in made.items()}
    return df.withColumns(placed).filter("_own").select(*[col(c) for c in dict.fromkeys([*keep, *made])])
