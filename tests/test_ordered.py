"""Chunked scans against pandas, with one key holding a third of the rows and one order value holding another third."""

import math
from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tendril.operators import fills, grouping, joins, order_statistics, ranks, resample, reshape, rolling, scans, stats
from tendril.operators import ordered as od

N = 1500
KINDS = "g string, t long, i long, x double"


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(0)
    return pd.DataFrame({
        "g": np.where(rng.random(N) < 0.4, "hot", rng.integers(0, 20, N).astype(str)), "t": np.where(rng.random(N) < 0.3, 500, rng.integers(0, 1000, N)),
        "i": np.arange(N), "x": np.where(rng.random(N) < 0.5, np.nan, rng.random(N).round(3))})


def to_spark(spark, pdf, kinds):
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), kinds)


@pytest.fixture(scope="module")
def df(spark, pdf):
    return to_spark(spark, pdf, KINDS).repartition(5).persist()


def same(got, want):
    np.testing.assert_allclose(np.array(got, dtype=float), np.array(want, dtype=float), equal_nan=True, rtol=1e-9, atol=1e-12)


def by_i(df):
    return df.toPandas().sort_values("i")


def groups(pdf):
    return pdf.sort_values(["t", "i"]).groupby("g")


@pytest.mark.parametrize("chunks", [2, 200])
def test_running_aggregates(df, pdf, chunks):
    x = F.col("x")
    aggs = {"n": ("count", F.lit(1)), "last": ("last", x), "next": ("next", x), "hi": ("max", x), "p": ("position", None), "at": ("last_at", x)}
    out, g = by_i(od.running(df, ["g"], ["t", "i"], aggs, chunks=chunks)), groups(pdf)
    same(out.n, (g.cumcount() + 1).sort_index())
    same(out.p, g.cumcount().sort_index())
    same(out["last"], g.x.ffill().sort_index())
    same(out["next"], g.x.bfill().sort_index())
    same(out.hi, g.x.transform(lambda s: s.cummax().ffill()).sort_index())
    same([a["v"] if a is not None else np.nan for a in out["at"]], g.x.ffill().sort_index())


def test_running_backwards(df, pdf):
    out = by_i(od.running(df, ["g"], ["t", "i"], {"s": ("sum", F.col("x")), "p": ("position", None)}, reverse=True))
    g = pdf.sort_values(["t", "i"], ascending=False).groupby("g")
    same(out.p, g.cumcount().sort_index())
    same(out.s, g.x.transform(lambda s: s.fillna(0).cumsum().where(s.ffill().notna())).sort_index())


def test_string_order_is_chunked(spark):
    words = [f"w{k:05d}" for k in range(700)]
    out = od.position(spark.createDataFrame([(w,) for w in reversed(words)], "w string"), [], ["w"]).toPandas().sort_values("w")
    same(out._pos, range(700))


def test_chunk_numbers_keep_order_and_isolate_heavy_values(spark):
    points = [10 * k for k in range(60)]
    out = spark.range(-5, 700).select("id", od.chunk_number(F.col("id"), points).alias("c")).toPandas()
    few = spark.range(-5, 700).select("id", od.chunk_number(F.col("id"), points[:40]).alias("c")).toPandas()
    for table in (out, few):
        assert table.sort_values("id").c.is_monotonic_increasing
    assert out[out.c % 2 == 1].groupby("c").id.nunique().eq(1).all()
    assert out[out.c % 2 == 1].id.tolist() == points


def test_numbers_by_binary_search_equal_comparisons(spark):
    """Among doubles with NaN, both zeros and infinities, and longs that are no doubles."""
    odd = [float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 5e-324, 1.5, math.nextafter(1.5, 2), 1e300, None]
    points = [0.0, 1.5, 1e300]
    numbers = od.with_number(spark.createDataFrame([(x,) for x in odd], "x double"), "n", F.col("x"), points)
    assert all(r.n == r.c for r in numbers.withColumn("c", od.chunk_number(F.col("x"), points)).collect())
    assert "bucketizer" in numbers._jdf.queryExecution().optimizedPlan().toString()
    large = (1 << 53) + 1
    rows = spark.createDataFrame([(x,) for x in (-large, -1, 0, 1, large - 2, large - 1, large, 1 << 60, (1 << 60) + 1, None)], "x long")
    for points in ([0, 1], [0, large - 2], [1, large], [1 << 60]):
        assert all(r.n == r.c for r in od.with_number(rows, "n", F.col("x"), points).withColumn("c", od.chunk_number(F.col("x"), points)).collect())


def test_no_chunk_holds_the_hot_group(df, pdf):
    sizes = od.with_chunk(df, ["t", "i"]).groupBy("g", od.CHUNK).count().toPandas()
    assert sizes["count"].max() < 0.25 * (pdf.g == "hot").sum()


def test_ties_are_cut_along_later_columns(spark):
    """One value of the first column, a string second, a number third: still many chunks, in order."""
    rows = [(1, "same" if k % 3 else f"w{k:04d}", k) for k in range(900)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    chunked = od.with_chunk(df, ["a", "b", "c"])
    assert chunked.groupBy(od.CHUNK).count().agg(F.max("count")).first()[0] < 300
    out = od.position(df, [], ["a", "b", "c"]).toPandas().sort_values(["a", "b", "c"])
    same(out._pos, range(900))


@pytest.mark.parametrize("limit", [1, 3, None])
@pytest.mark.parametrize("direction", ["forward", "backward"])
def test_fill(df, pdf, limit, direction):
    out = by_i(fills.fill(df, ["g"], ["t", "i"], ["x"], direction, limit))
    g = groups(pdf).x
    same(out.x, (g.ffill(limit=limit) if direction == "forward" else g.bfill(limit=limit)).sort_index())


def test_interpolate(df, pdf):
    same(by_i(fills.interpolate(df, ["g"], ["t", "i"], "x")).x, groups(pdf).x.transform(lambda v: v.interpolate()).sort_index())


@pytest.mark.parametrize("method", ["average", "min", "max", "dense", "first"])
@pytest.mark.parametrize("ascending", [True, False])
def test_rank(df, pdf, method, ascending):
    for nulls in ("keep", "top", "bottom"):
        out = by_i(ranks.rank(df, ["g"], "x", "r", method, ascending, False, nulls, ["i"]))
        same(out.r, pdf.groupby("g").x.rank(method=method, ascending=ascending, na_option=nulls))


def test_rank_pct(df, pdf):
    same(by_i(ranks.rank(df, ["g"], "x", "r", pct=True)).r, pdf.groupby("g").x.rank(pct=True))


def test_shift(df, pdf):
    out = by_i(ranks.shift(df, ["g"], ["t", "i"], {"a": ("x", 2), "b": ("x", -1)}))
    same(out.a, groups(pdf).x.shift(2).sort_index())
    same(out.b, groups(pdf).x.shift(-1).sort_index())


def test_quantiles_and_codes(df, pdf):
    out = ranks.quantiles(df, ["g"], "x", [0.1, 0.5, 0.9]).toPandas().sort_values(["g", "share"])
    same(out["quantile"], pdf.groupby("g").x.quantile([0.1, 0.5, 0.9]).values)
    same(by_i(ranks.group_number(df, ["g"])).ngroup, pdf.groupby("g").ngroup())
    same(by_i(ranks.first_seen_codes(df, "g", "i")).code, pd.factorize(pdf.g)[0])


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("tolerance", [None, 3])
def test_asof(spark, pdf, direction, exact, tolerance):
    left = pdf[["g", "t", "i"]].iloc[::3].sort_values("t")
    right = pdf[["g", "t", "x", "i"]].iloc[1::3].rename(columns={"i": "j"}).sort_values(["t", "j"])
    out = by_i(joins.asof_join(to_spark(spark, left, "g string, t long, i long"), to_spark(spark, right, "g string, t long, x double, j long"),
                               "t", ["g"], direction, tolerance, exact, tie="j"))
    want = pd.merge_asof(left, right, on="t", by="g", direction=direction, tolerance=tolerance, allow_exact_matches=exact).sort_values("i")
    same(out.t_right, want.j.map(right.set_index("j").t))
    if direction == "backward":
        same(out.j, want.j)


def test_small_asof(spark):
    left = spark.createDataFrame([(1, "a"), (5, "b"), (10, "c")], "a int, left_val string")
    right = spark.createDataFrame([(k, k) for k in (1, 2, 3, 6, 7)], "a int, right_val int")
    assert [r.right_val for r in joins.asof_join(left, right, "a").orderBy("a").collect()] == [1, 3, 7]


@pytest.mark.parametrize("center", [True, False])
def test_rolling_rows_across_blocks(df, pdf, center, monkeypatch):
    monkeypatch.setattr(rolling, "halo_blocks", lambda d, pos, size, before, after: od.halo_blocks(d, pos, 7, before, after))
    outs = {"m": ("mean", "x"), "s": ("std", "x"), "k": ("skew", "x"), "q": ("median", "x")}
    out = by_i(rolling.rolling_rows(df, ["g"], ["t", "i"], 9, outs, min_periods=3, center=center))
    roll = groups(pdf).x.rolling(9, min_periods=3, center=center)
    for name, want in {"m": roll.mean(), "s": roll.std(), "k": roll.skew(), "q": roll.median()}.items():
        np.testing.assert_allclose(out[name].astype(float), want.reset_index(level=0, drop=True).sort_index(), rtol=1e-6, atol=1e-8, equal_nan=True)


def test_exponential_across_blocks(df, pdf):
    clean = df.withColumn("x", F.coalesce("x", F.lit(0.25)))
    g = pdf.assign(x=pdf.x.fillna(0.25)).sort_values(["t", "i"]).groupby("g").x
    for adjust in (True, False):
        out = by_i(rolling.exponential(clean, ["g"], ["t", "i"], {"m": ("mean", "x")}, adjust=adjust, alpha=0.9))
        same(out.m, g.transform(lambda s: s.ewm(alpha=0.9, adjust=adjust).mean()).sort_index())
    out = by_i(rolling.exponential(clean, ["g"], ["t", "i"], {"v": ("var", "x"), "s": ("std", "x")}, alpha=0.3))
    want = g.transform(lambda s: s.ewm(alpha=0.3).var()).sort_index()
    np.testing.assert_allclose(out.v.astype(float), want, rtol=1e-6, atol=1e-9, equal_nan=True)


@pytest.mark.parametrize("adjust", [True, False])
@pytest.mark.parametrize("ignore_na", [True, False])
def test_exponential_with_nulls(df, pdf, adjust, ignore_na, monkeypatch):
    monkeypatch.setattr(scans, "BATCH", 16)
    g = groups(pdf).x
    for alpha in (0.05, 0.5, 0.9):
        outs = {"m": ("mean", "x"), "v": ("var", "x")}
        out = by_i(rolling.exponential(df, ["g"], ["t", "i"], outs, adjust=adjust, ignore_na=ignore_na, alpha=alpha, min_periods=3))
        ewm = lambda s: s.ewm(alpha=alpha, adjust=adjust, ignore_na=ignore_na, min_periods=3)
        same(out.m, g.transform(lambda s: ewm(s).mean()).sort_index())
        np.testing.assert_allclose(out.v.astype(float), g.transform(lambda s: ewm(s).var()).sort_index(), rtol=1e-6, atol=1e-9, equal_nan=True)


def test_exponential_long_gaps_and_many_periods(spark):
    x = np.random.default_rng(5).random(2000).round(3)
    x[0] = np.nan
    x[300:900] = np.nan
    pdf = pd.DataFrame({"i": np.arange(2000), "x": x})
    df = to_spark(spark, pdf, "i long, x double")
    for adjust in (True, False):
        out = by_i(rolling.exponential(df, [], ["i"], {"m": ("mean", "x")}, adjust=adjust, alpha=0.5, min_periods=100))
        same(out.m, pdf.x.ewm(alpha=0.5, adjust=adjust, min_periods=100).mean())


def test_null_groups_and_times_keep_their_rows(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), (None, 1, 5.0), ("a", None, 7.0)], "g string, t long, x double")
    known = df.filter("t is not null")
    for out in (ranks.shift(known, ["g"], ["t"], {"r": ("x", 1)}), rolling.rolling_rows(known, ["g"], ["t"], 2, {"r": ("sum", "x")}, 1),
                rolling.rolling_weighted(known, ["g"], ["t"], "x", [1.0], "r"), rolling.exponential(known, ["g"], ["t"], {"r": ("mean", "x")}, alpha=0.5),
                rolling.rolling_time(known, ["g"], "t", 5, {"r": ("sum", "x")})):
        rows = out.collect()
        assert len(rows) == 3 and [r.r for r in rows if r.g is None] == [None]
    timed = rolling.rolling_time(df, ["g"], "t", 5, {"r": ("sum", "x")}).collect()
    assert sorted((r.x, r.r) for r in timed if r.r is not None) == [(1.0, 1.0), (2.0, 3.0)] and len(timed) == 4
    assert [r.g for r in rolling.autocorrelation(known, ["g"], ["t"], "x").collect()] == ["a"]


def test_rank_of_dates_with_nulls(spark):
    df = spark.createDataFrame([(0, "2024-02-01"), (1, None), (2, "2024-01-01"), (3, None), (4, "2024-01-01")], "i long, d string").withColumn("d", F.col("d").cast("date"))
    values = pd.Series([2.0, np.nan, 1.0, np.nan, 1.0])
    for method in ("average", "first"):
        for ascending in (True, False):
            for nulls in ("keep", "top", "bottom"):
                same(by_i(ranks.rank(df, [], "d", "r", method, ascending, False, nulls, ["i"])).r, values.rank(method=method, ascending=ascending, na_option=nulls))


def test_null_groups_in_statistics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0)], "g string, x double")
    for out in (stats.describe(df, ["g"], "x"), stats.value_counts(df, ["g"], "x"), stats.mean_abs_deviation(df, ["g"], "x"), stats.modes(df, ["g"], "x")):
        assert {r.g for r in out.collect()} == {"a"}


def test_bins_of_empty_and_constant_columns(spark):
    empty, constant = (spark.createDataFrame(rows, "x double") for rows in ([(None,)], [(4.0,), (4.0,)]))
    assert [r.n for r in reshape.histogram(empty, "x", 3).orderBy("bin").collect()] == [0, 0, 0]
    assert sum(r.n for r in reshape.histogram(constant, "x", 3).collect()) == 2
    assert constant.select(reshape.cut(F.col("x"), reshape.equal_width_edges(constant, "x", 3)).alias("b")).distinct().collect()[0].b == 1
    for frame, reason in ((empty, "no values"), (constant, "coincide")):
        with pytest.raises(ValueError, match=reason):
            reshape.qcut(frame, "x", 2)
    with pytest.raises(ValueError, match="no values"):
        reshape.equal_width_edges(empty, "x", 3)


def test_rolling_time_ends(spark):
    pdf = pd.DataFrame({"ts": pd.to_datetime("2024-01-01") + pd.to_timedelta(np.sort(np.random.default_rng(1).choice(5000, 400, replace=False)), "min")})
    pdf["x"], pdf["i"] = np.arange(400.0), np.arange(400)
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    for closed in ("right", "left", "both", "neither"):
        out = by_i(rolling.rolling_time(df, [], "ts", timedelta(hours=2), {"s": ("sum", "x")}, closed=closed))
        same(out.s, pdf.set_index("ts").x.rolling("2h", closed=closed).sum())


def test_kendall_and_moments(spark, pdf):
    small = pdf.iloc[:250].assign(x=lambda d: d.x.fillna(0.5).round(1))
    a, b = small.x.values, small.t.values // 100
    dx, dy = np.sign(a[:, None] - a), np.sign(b[:, None] - b)
    want = (dx * dy).sum() / np.sqrt((dx**2).sum() * (dy**2).sum())
    df = spark.createDataFrame(pd.DataFrame({"x": a, "y": b}))
    same([stats.kendall(df, "x", "y").first()[0]], [want])
    row = stats.moments(df, [], "x").first()
    same([row["skew"], row["kurt"], row["sem"]], [small.x.skew(), small.x.kurt(), small.x.sem()])


def test_duplicates(df, pdf):
    for keep in ("first", "last", False):
        got = grouping.drop_duplicates(df, ["g", "t"], ["i"], keep).toPandas().i.sort_values()
        want = pdf.drop_duplicates(["g", "t"], keep=keep).i
        assert got.tolist() == want.tolist()
        assert by_i(grouping.flag_duplicates(df, ["g", "t"], ["i"], keep))["duplicated"].tolist() == pdf.duplicated(["g", "t"], keep=keep).tolist()


def test_apply_with_summary(df, pdf):
    part = lambda p: pd.DataFrame({"g": [p.g.iloc[0]], "n": [len(p)], "s": [p.i.sum()]})
    merge = lambda p: p.groupby("g", as_index=False, dropna=False).sum()
    out = grouping.apply_with_summary(df, ["g"], part, "g string, n long, s long", merge, lambda p: pd.DataFrame({"i": p.i, "c": p.i - p.s / p.n}), "i long, c double")
    same(by_i(out).c, pdf.i - pdf.groupby("g").i.transform("mean"))


def test_checks_that_raise(df):
    with pytest.raises(ValueError, match="not unique"):
        joins.checked_merge(df, df.select("g"), ["g"], "m:1")
    with pytest.raises(ValueError, match="duplicate"):
        reshape.pivot(df, ["g"], "t", "x", [500])


def test_weighted_sample_is_reproducible(df):
    weight = F.when(F.col("g") == "hot", 50.0).otherwise(1.0)
    a, b = (grouping.hash_sample(df, 60, ["i"], 1, weight).toPandas().i.tolist() for _ in range(2))
    assert a == b and len(set(a)) == 60
    assert grouping.hash_sample(df, 60, ["i"], 1, weight).filter("g = 'hot'").count() > 45


def test_apply_in_parts_over_many_batches(spark, df, pdf):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        part = lambda p: pd.DataFrame({"g": [p.g.iloc[0]], "n": [len(p)], "s": [p.i.sum()]})
        merge = lambda p: p.groupby("g", as_index=False).sum()
        kinds = "g string, n long, s long"
        for held in (5, 1000):
            out = grouping.apply_in_parts(df, ["g"], part, kinds, merge, lambda p: p, kinds, slices=3, held_rows=held).toPandas().sort_values("g")
            want = pdf.groupby("g").i.agg(["size", "sum"])
            assert out.n.tolist() == want["size"].tolist() and out.s.tolist() == want["sum"].tolist()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("rule,alias", [("week_end", "W"), ("month_end", "ME"), ("quarter_end", "QE"), ("year_end", "YE"), ("work_day", "B"), ("work_month_end", "BME"), ("month", "MS"), (timedelta(hours=1), "h")])
def test_resample_bins_are_those_of_pandas(spark, rule, alias):
    times = pd.to_datetime(["2023-12-29 05:00", "2023-12-31 23:30", "2024-01-06 12:00", "2024-02-29 00:00", "2024-03-31 08:00", "2024-06-30 17:00"])
    want = pd.Series(1, index=times).resample(alias).sum()
    got = resample.resample(spark.createDataFrame([(x.to_pydatetime(),) for x in times], "ts timestamp_ntz"), [], "ts", rule, {"n": F.count("*")}).na.fill(0, ["n"]).toPandas().sort_values("ts")
    assert list(got["ts"]) == list(want.index) and list(got["n"]) == list(want)


def test_expanding_shapes(df, pdf):
    got = by_i(rolling.expanding(df, ["g"], ["t", "i"], "x", {"s": "skew", "k": "kurt"}))
    for name, fn in (("s", "skew"), ("k", "kurt")):
        want = getattr(groups(pdf)["x"].expanding(), fn)().reset_index(level=0, drop=True).sort_index()
        known = want.notna().to_numpy()
        np.testing.assert_allclose(got[name].to_numpy(float)[known], want.to_numpy()[known], rtol=1e-6, atol=1e-6)


def test_apply_in_parts_calls_once_per_small_group(spark, tmp_path):
    """Rows of 400 groups dealt over all partitions and batches; each call of ``part`` leaves a file."""
    import uuid

    calls = str(tmp_path)

    def part(p):
        open(f"{calls}/{uuid.uuid4().hex}", "w").close()
        return pd.DataFrame({"g": [p.g.iloc[0]], "n": [len(p)], "s": [p.i.sum()]})
    rows = spark.range(8000, numPartitions=8).select((F.col("id") % 400).alias("g"), F.col("id").alias("i"))
    kinds = "g long, n long, s long"
    got = grouping.apply_in_parts(rows, ["g"], part, kinds, lambda p: p.groupby("g", as_index=False).sum(), lambda p: p, kinds).toPandas().sort_values("g")
    assert got.g.tolist() == list(range(400)) and got.n.tolist() == [20] * 400
    assert got.s.tolist() == [sum(range(g, 8000, 400)) for g in range(400)]
    # 3,200 before
    assert len(list(tmp_path.iterdir())) <= 500


def test_correlations_of_constant_values(spark):
    """Windows and groups in which a column does not vary: no error, and other rows keep their results."""
    rows = spark.createDataFrame([("a", i, 5.0 if i < 4 else float(i), float(i * i)) for i in range(8)] + [("b", i, 1.0, float(i)) for i in range(4)], "g string, i long, x double, y double")
    got = rolling.rolling_rows(rows, ["g"], ["i"], 3, {"r": ("corr", "x", "y"), "c": ("cov", "x", "y")}, 2).toPandas().sort_values(["g", "i"])
    a = got[got.g == "a"]
    plain = pd.Series([5.0] * 4 + [4.0, 5.0, 6.0, 7.0]).rolling(3, 2).corr(pd.Series([float(i * i) for i in range(8)]))
    np.testing.assert_allclose(a.r.to_numpy(float)[4:], plain.to_numpy()[4:], rtol=1e-9)
    assert np.isnan(a.r.to_numpy(float)[:4]).all() and np.isnan(got[got.g == "b"].r.to_numpy(float)).all()
    pairs = {(r["a"], r["b"]): r["corr"] for r in stats.correlation_pairs(rows.filter("g = 'b'"), ["x", "y"]).collect()}
    assert np.isnan(pairs["x", "y"]) and pairs["y", "y"] == pytest.approx(1)


def test_windows_of_one_block_have_no_core(spark, monkeypatch):
    """A window much longer than the blocks that follow from the number of rows, over several of its lengths."""
    monkeypatch.setattr(order_statistics, "_cores", lambda *args: pytest.fail("values looked up beside the rows"))
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 70_000), "i": np.arange(70_000), "x": np.where(rng.random(70_000) < 0.1, np.nan, rng.integers(0, 500, 70_000))})
    out = order_statistics.running_quantiles(spark.createDataFrame(pdf), ["g"], ["i"], "x", {"m": 0.5}, window=9_000).toPandas().sort_values("i")
    want = pdf.groupby("g").x.transform(lambda s: s.rolling(9_000, min_periods=1).median())
    same(out.m, want)


def test_cells_of_one_group_are_spread(spark, monkeypatch):
    """Blocks by cells are dealt by cell into a number of parts that is kept, also where a single group is all there is."""
    plans, settle = {}, order_statistics.settle

    def kept(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return settle(df, label)
    monkeypatch.setattr(order_statistics, "settle", kept)
    rows = spark.range(20_000).select("id", ((F.col("id") * 7919) % 20_011).cast("double").alias("x"))
    out = order_statistics.running_quantiles(rows, [], ["id"], "x", {"m": 0.5}, block=1_000).toPandas().sort_values("id")
    same(out.m, pd.Series((np.arange(20_000) * 7919) % 20_011).expanding().median())
    assert any("_cell" in line and "REPARTITION_BY_NUM" in line for line in plans["cells"].splitlines())
