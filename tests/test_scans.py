"""Quantiles, functions of the caller's own and pairs of columns over growing and sliding windows, against pandas and plain loops."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tendril.operators import scans
from tendril.operators.order_statistics import kth_in_ranges, running_quantiles

N = 1500


@pytest.fixture(scope="module")
def frame():
    draw = np.random.default_rng(3)
    # one group holds most rows, values have many ties, drift and gaps
    x = np.round(draw.normal(size=N) * 4 + np.arange(N) / 400, 1)
    x[draw.random(N) < 0.3] = 1.5
    x[draw.random(N) < 0.1] = np.nan
    x[:7] = np.nan
    return pd.DataFrame({"i": np.arange(N), "g": np.where(draw.random(N) < 0.8, "hot", np.where(draw.random(N) < 0.5, "b", "c")), "x": x, "y": draw.normal(size=N) + 1e8})


@pytest.fixture(scope="module")
def table(spark, frame):
    rows = [(int(i), g, None if x != x else float(x), float(y)) for i, g, x, y in frame.itertuples(index=False)] + [(N, None, 3.0, 1.0)]
    return spark.createDataFrame(rows, "i long, g string, x double, y double").repartition(5)


def values(df, *names):
    got = df.filter("g IS NOT NULL").orderBy("i").toPandas()
    return [got[n].to_numpy(float) for n in names]


def test_kth_in_ranges():
    draw = np.random.default_rng(1)
    ranks, counts = draw.integers(0, 37, 300), draw.integers(0, 4, 300)
    low = draw.integers(0, 299, 500)
    high = np.minimum(300, low + draw.integers(1, 200, 500))
    spelled = [np.sort(np.repeat(ranks[a:b], counts[a:b])) for a, b in zip(low, high)]
    some = [i for i, s in enumerate(spelled) if len(s)]
    k = np.array([draw.integers(0, len(spelled[i])) for i in some])
    assert (kth_in_ranges(ranks, counts, low[some], high[some], k) == [spelled[i][j] for i, j in zip(some, k)]).all()


@pytest.mark.parametrize("block", [7, 64, 5000])
@pytest.mark.parametrize("window", [None, 1, 5, 64, 65, 200, 449, 2000])
def test_quantiles_equal_pandas(table, frame, block, window):
    if window in (1, 5, 200) and block == 5000:
        pytest.skip("covered by the others")
    got = values(running_quantiles(table, ["g"], ["i"], "x", {"m": 0.5, "hi": 0.95, "lo": 0.0}, window, 3, block), "m", "hi", "lo")
    for have, share in zip(got, (0.5, 0.95, 0.0)):
        grouped = frame.groupby("g")["x"]
        rolled = grouped.expanding(3) if window is None else grouped.rolling(window, min_periods=min(3, window))
        want = rolled.quantile(share).reset_index(level=0, drop=True).sort_index().to_numpy()
        if window in (1, 2):
            want = np.full(N, np.nan)
        np.testing.assert_allclose(have, want, rtol=1e-9)


def test_quantiles_without_groups_nulls_and_rows(spark, table, frame):
    one = running_quantiles(table.filter("g IS NOT NULL"), [], ["i"], "x", {"m": 0.25}, None, 1, 50)
    np.testing.assert_allclose(values(one, "m")[0], frame["x"].expanding().quantile(0.25).to_numpy(), rtol=1e-9)
    out = running_quantiles(table, ["g"], ["i"], "x", {"m": 0.5}, 100, 1, 10)
    assert out.count() == N + 1 and out.filter("g IS NULL").first()["m"] is None
    assert running_quantiles(table.limit(0), ["g"], ["i"], "x", {"m": 0.5}).count() == 0
    assert running_quantiles(table.withColumn("x", F.lit(None).cast("double")), ["g"], ["i"], "x", {"m": 0.5}, None, 1, 10).filter("m IS NOT NULL").count() == 0


def longest_run():
    def longest(a, b):
        """Longest run of equal neighbours, from runs at both ends; not commutative."""
        same = a["last"] == b["first"]
        joined = np.where(same, a["tail"] + b["head"], 0)
        return {"first": a["first"], "last": b["last"], "n": a["n"] + b["n"], "best": np.maximum(np.maximum(a["best"], b["best"]), joined),
                "head": np.where(same & (a["head"] == a["n"]), a["n"] + b["head"], a["head"]), "tail": np.where(same & (b["tail"] == b["n"]), b["n"] + a["tail"], b["tail"])}
    return longest


def run_lengths(xs):
    best = now = 0
    for i, x in enumerate(xs):
        now = now + 1 if i and x == xs[i - 1] else 1
        best = max(best, now)
    return best


def single():
    return {"first": F.col("v"), "last": F.col("v"), **{c: F.lit(1).cast("long") for c in ("n", "best", "head", "tail")}}


@pytest.mark.parametrize("window", [None, 3, 40, 333])
def test_own_function(table, frame, window, monkeypatch):
    monkeypatch.setattr(scans, "LOCAL", 50)
    monkeypatch.setattr(scans, "BATCH", 64)
    rows = table.withColumn("v", F.floor(F.coalesce("x", F.lit(0.0)) / 3).cast("long"))
    made = scans.scan(rows, ["g"], ["i"], single(), longest_run()) if window is None else scans.slide(rows, ["g"], ["i"], window, single(), longest_run())
    got = dict(made.select("i", "best").collect())
    assert len(got) == N + 1 and got[N] is None
    for _, part in frame.groupby("g"):
        v = np.floor(part["x"].fillna(0) / 3).tolist()
        for j, i in enumerate(part["i"]):
            if j % 13 == 0:
                assert got[i] == run_lengths(v[max(0, j + 1 - (window or N)):j + 1]), (i, window)


def test_scan_from_the_end(table, frame):
    made = scans.scan(table, ["g"], ["i"], {"s": F.col("i").cast("double")}, lambda a, b: {"s": a["s"] + b["s"]}, True)
    want = frame.iloc[::-1].groupby("g")["i"].cumsum().sort_index()
    np.testing.assert_allclose(values(made, "s")[0], want)
    assert scans.scan(table.limit(0), ["g"], ["i"], {"s": F.lit(1.0)}, lambda a, b: a).count() == 0


@pytest.mark.parametrize("window", [None, 30])
def test_pairs_with_a_large_offset(table, frame, window):
    out = scans.running_pairs(table, ["g"], ["i"], "x", "y", {"c": "cov", "r": "corr"}, 4, window)
    # the offset is taken off before pandas sees the column
    plain = frame.assign(y=frame["y"] - 1e8)
    plain.loc[plain["x"].isna(), "y"] = np.nan
    for have, fn in zip(values(out, "c", "r"), ("cov", "corr")):
        parts = []
        for _, part in plain.groupby("g"):
            rolled = part["x"].expanding(4) if window is None else part["x"].rolling(window, min_periods=4)
            parts.append(getattr(rolled, fn)(part["y"]))
        np.testing.assert_allclose(have, pd.concat(parts).sort_index().to_numpy(), rtol=1e-6, atol=1e-7)


@pytest.mark.parametrize("closed", ["right", "left", "both", "neither"])
def test_dense_time_windows(spark, monkeypatch, closed):
    from tendril.operators import rolling

    draw = np.random.default_rng(5)
    rows = [(i, "hot" if i % 5 else "b", int(t), None if i % 11 == 0 else float(x)) for i, (t, x) in enumerate(zip(draw.integers(-300, 300, 900), draw.normal(size=900) + 1e5))]
    rows += [(900, "hot", None, 1.0), (901, None, 3, 1.0)]
    table = spark.createDataFrame(rows, "i long, g string, t long, x double")
    outs = {"n": ("count", "x"), "s": ("sum", "x"), "m": ("mean", "x"), "v": ("var", "x"), "sd": ("std", "x"), "lo": ("min", "x"), "hi": ("max", "x")}
    plain = {r.i: r for r in rolling.rolling_time(table, ["g"], "t", 17, outs, 2, closed).collect()}
    monkeypatch.setattr(rolling, "DENSE", 30)
    dense = {r.i: r for r in rolling.rolling_time(table, ["g"], "t", 17, outs, 2, closed).collect()}
    if closed != "left":
        whole = whole_plain = {}
    else:
        monkeypatch.setattr(rolling, "DENSE", 5)
        whole = {r.i: r for r in rolling.rolling_time(table.filter("g IS NOT NULL"), [], "t", 17, outs, 2, closed).collect()}
        monkeypatch.setattr(rolling, "DENSE", 10**9)
        whole_plain = {r.i: r for r in rolling.rolling_time(table.filter("g IS NOT NULL"), [], "t", 17, outs, 2, closed).collect()}
    assert plain.keys() == dense.keys() and len(whole) in (0, 901)
    for got, want in ((dense, plain), (whole, whole_plain)):
        for i, r in want.items():
            for name in outs:
                assert (got[i][name] is None) == (r[name] is None), (i, name, got[i], r)
                if r[name] is not None:
                    assert got[i][name] == pytest.approx(r[name], rel=1e-7, abs=1e-7), (i, name)


@pytest.mark.parametrize("n", [1, 2, 7, 8])
def test_window_shapes(n):
    from tendril.operators.rolling import window_weights

    for shape, own in {"hamming": np.hamming, "blackman": np.blackman, "bartlett": np.bartlett}.items():
        np.testing.assert_allclose(window_weights(shape, n), own(n), atol=1e-12)
    np.testing.assert_allclose(window_weights("kaiser", n, 6.0), np.kaiser(n, 6.0), atol=1e-12)
    np.testing.assert_allclose(window_weights("general_gaussian", n, 1.0, 2.5), window_weights("gaussian", n, 2.5) if n > 1 else [1.0])
    for shape in ("boxcar", "triang", "barthann", "bohman", "parzen", "blackmanharris", "nuttall"):
        weights = window_weights(shape, n)
        assert len(weights) == n and weights == pytest.approx(weights[::-1], abs=1e-12) and max(weights) <= 1 + 1e-9
        if n == 7:
            assert weights[3] == pytest.approx(1, abs=1e-9)
    with pytest.raises(ValueError, match="unknown"):
        window_weights("unknown", 3)


@pytest.mark.parametrize("reverse", [False, True])
def test_a_scan_holds_no_whole_chunk(spark, monkeypatch, reverse):
    """One group of equal times: its chunk is longer than a piece; no merge sees more rows than a piece has."""
    monkeypatch.setattr(scans, "BATCH", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        rows = spark.range(3000, numPartitions=3).select(F.lit("a").alias("g"), F.lit(1).alias("t"), F.col("id").alias("i"))

        def longest(a, b):
            seen = np.maximum(np.maximum(a["most"], b["most"]), float(len(a["n"])))
            return {"n": a["n"] + b["n"], "last": b["last"], "first": a["first"], "most": seen}
        state = {"n": F.lit(1.0), "first": F.col("i").cast("double"), "last": F.col("i").cast("double"), "most": F.lit(0.0)}
        got = scans.scan(rows, ["g"], ["t"], state, longest, reverse).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got.n) == list(range(1, 3001))
    assert got.most.max() <= 200
