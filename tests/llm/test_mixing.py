"""Rates against a plain projected gradient, and drawn shares against the stated weights."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tendril.llm import mixing

ROOT = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def members(spark):
    draw = np.random.default_rng(2)
    p = draw.dirichlet([0.6, 0.15, 0.05], 1500)
    n = draw.integers(1, 3000, 1500)
    return p, n, spark.createDataFrame([(i, int(t), *map(float, x)) for i, (t, x) in enumerate(zip(n, p))], "i long, n_tokens long, p_clean double, p_low double, p_toxic double").cache()


def plain(p, n, wanted, rounds=40_000):
    """Rates by ordinary projected gradient steps from 1."""
    a = p * n[:, None] / n.sum()
    b = wanted / n.sum()
    r = np.ones(len(p))
    step = 1 / np.linalg.norm(a, 2) ** 2
    for _ in range(rounds):
        r = np.maximum(0, r - step * (a @ (a.T @ r - b)))
    return r


@pytest.mark.parametrize(("targets", "scarce"), [((0.96, 0.03, 0.01), "repeat"), ((0.5, 0.4, 0.1), "repeat"), ((0.5, 0.4, 0.1), "thin"), ((0.9, 0.05, 0.05), "cap")])
def test_rates(members, targets, scarce):
    p, n, rows = members
    steps, found = mixing.fit_rates(rows, dict(zip(mixing.DOMAINS, targets)), scarce=scarce)
    rates = np.array([r[0] for r in rows.orderBy("i").select(mixing.rate(steps)).collect()])
    reached = (p * (n * rates)[:, None]).sum(axis=0)
    np.testing.assert_allclose(reached, found["wanted"], atol=2e-4 * max(found["supply"]))
    np.testing.assert_allclose(reached, found["reached"], rtol=1e-6)
    supply = np.array(found["supply"])
    if scarce != "cap":
        # the stated weights, whatever there is of each domain
        np.testing.assert_allclose(reached / reached.sum(), targets, atol=2e-3)
    else:
        assert (np.array(found["wanted"])[1:] <= supply[1:]).all()
    if scarce == "thin":
        assert (np.array(found["wanted"]) <= supply * (1 + 1e-9)).all()
    # many rates meet the totals; the plain method, from the same start, meets them by nearly the same ones
    other = plain(p, n, np.array(found["wanted"]))
    np.testing.assert_allclose((p * (n * other)[:, None]).sum(axis=0), found["wanted"], rtol=2e-2, atol=2e-3 * supply.max())
    assert rates.min() >= 0


def test_drawn_shares(spark):
    docs, labels = (spark.read.parquet(f"{ROOT}/{x}.parquet") for x in ("documents", "labels"))
    targets = {"clean": 0.7, "low": 0.2, "toxic": 0.1}
    report = mixing.mixing_report(docs, labels, targets=targets).cache()
    told = {r.domain: (r.wanted_share, r.reached_share) for r in report.select("domain", "wanted_share", "reached_share").distinct().collect()}
    assert all(w == pytest.approx(targets[d], abs=1e-6) and w == pytest.approx(x, abs=5e-3) for d, (w, x) in told.items())
    rates = report.select("doc_id", "rate", "n_tokens")
    for scarce in ("repeat", "thin", "cap"):
        drawn = mixing.draw(docs, labels, targets=targets, scarce=scarce)
        assert drawn.columns == docs.columns
        held = drawn.join(report, "doc_id")
        got = held.agg(*[F.sum(F.col("n_tokens") * F.col(f"p_{d}")) for d in mixing.DOMAINS]).first()
        if scarce != "cap":
            assert [x / sum(got) for x in got] == pytest.approx(list(targets.values()), abs=0.06)
        if scarce != "repeat":
            assert drawn.count() == drawn.select("doc_id").distinct().count()
        else:
            copies = drawn.groupBy("doc_id").count().join(rates, "doc_id").where("n_tokens > 0 AND abs(count - rate) >= 1")
            assert copies.count() == 0
