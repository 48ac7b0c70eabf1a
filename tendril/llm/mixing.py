"""Soft-membership mixing: document rates under which expected domain token totals meet target weights.

A classifier trained on the labelled table gives every document posteriors over the domains clean, low and toxic, and its
number of tokens. Rates r >= 0 then minimise the squared distance between the expected totals sum(r * tokens * posterior)
and the targets, starting from 1 for all. Every step of the projected gradient is one aggregation of a few numbers over all
documents; a document's step depends on its posteriors alone, so rates are an expression over them and the gradients seen
so far, and no state is kept per document.

The classifier sees at most about ``max_labelled`` labelled documents (documented bound, drawn by a hash of the key); all
other numbers cover all documents. Labels with a null in key, quality or toxic are ignored; of several labels of one
document the smallest quality and the largest toxic count. Without labels all domains are equally likely. Null and empty
texts have no tokens and keep their rate. Repeated rows get equal rates. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .quality import SYMBOLS
from .words import FOLD, LETTERS, VISIBLE, distinct, slices, text_buffers, words

DOMAINS = ["clean", "low", "toxic"]
# Shares of the tokens wanted of each domain.
TARGETS = {"clean": 0.96, "low": 0.03, "toxic": 0.01}
HASHED = 1 << 14
SHAPES = 6 * 8
FEATURES = HASHED + SHAPES + 1
MAX_LABELLED = 20_000
HEADROOM = 1.1


_BYTES = np.arange(256)
_SYMBOL, _UPPER, _DIGIT = np.isin(_BYTES, [ord(c) for c in SYMBOLS]), (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 48) & (_BYTES <= 57)


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _shape(raw: np.ndarray, bounds: np.ndarray, counts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Six measures of the text, each as one of eight steps: symbols, capitals, digits and white space among the bytes, different words among the words, number of words."""
    size, n = np.maximum(np.diff(bounds), 1), np.maximum(counts, 1)
    shares = [_sums(flags[raw], bounds) / size for flags in (_SYMBOL, _UPPER, _DIGIT, ~VISIBLE)]
    steps = [np.digitize(s, [0.003, 0.01, 0.03, 0.08, 0.15, 0.25, 0.4]) for s in shares]
    steps += [np.digitize(kinds / n, [0.1, 0.2, 0.3, 0.45, 0.6, 0.75, 0.9]), np.digitize(n, [5, 15, 50, 120, 300, 1000, 4000])]
    return np.stack([8 * i + s for i, s in enumerate(steps)], 1)


def features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, feature numbers, bounds of texts among them, number of words), slice by slice.

    Which words occur (hashed), and the shape of the text; the last feature is in every text.
    """
    data, bounds = text_buffers(column)
    for w, (at, to) in zip(words(column, LETTERS, FOLD), slices(bounds), strict=True):
        values, _, own = distinct((w.hashes() % np.uint64(HASHED)).astype(np.int32), w.offsets)
        shape = HASHED + _shape(data[bounds[at] : bounds[to]], w.bounds, w.counts(), np.diff(own))
        extra = np.concatenate([shape, np.full((to - at, 1), FEATURES - 1)], 1)
        sizes = np.diff(own) + extra.shape[1]
        out_bounds = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(out_bounds[-1], np.int32)
        place = np.arange(len(values)) + np.repeat(out_bounds[:-1] - own[:-1], np.diff(own))
        out[place] = values
        for k in range(extra.shape[1]):
            out[out_bounds[1:] - 1 - k] = extra[:, k]
        yield w.first, out, out_bounds, w.counts()


def _scores(weights: np.ndarray, out: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Posteriors of texts from (domains, features) weights; every text has features."""
    z = np.stack([np.add.reduceat(w[out], bounds[:-1]) for w in weights], 1)
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
    rows.sort(key=lambda r: (r[0], r[1], r[2]))
    weights = np.zeros((len(DOMAINS), FEATURES))
    if rows:
        label = np.array([r[1] for r in rows])
        feats = [np.frombuffer(r[2], np.int32) for r in rows]
        total = np.full(weights.shape, 1e-2)
        for epoch in range(8):
            for at in range(0, len(rows), 128):
                part = feats[at : at + 128]
                bounds = np.concatenate([[0], np.cumsum([len(f) for f in part])])
                out = np.concatenate(part)
                p = _scores(weights, out, bounds)
                p[np.arange(len(part)), label[at : at + 128]] -= 1
                owner = np.repeat(np.arange(len(part)), np.diff(bounds))
                g = np.stack([np.bincount(out, weights=p[owner, k], minlength=FEATURES) for k in range(len(DOMAINS))]) / len(part)
                g += 1e-5 * weights
                total += g * g
                weights -= 0.1 / (1 + 0.3 * epoch) * g / np.sqrt(total)
    yield pa.RecordBatch.from_arrays([pa.array([weights.astype(np.float32).tobytes()], pa.binary())], ["weights"])


def _labelled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, out, bounds, _ in features(batch.column(2)):
            n = len(bounds) - 1
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array([out[bounds[r] : bounds[r + 1]].tobytes() for r in range(n)], pa.binary())], ["at", "domain", "features"])


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, 2).when(quality == 0, 1).otherwise(0)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED) -> np.ndarray:
    """Weights of (domain, feature), from at most about ``max_labelled`` labelled documents."""
    known = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy(F.col(key).alias("k")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).withColumn("at", F.xxhash64("k"))
    drawn = min(1.0, max_labelled / max(1, known.count()))
    known = known.where(F.pmod("at", F.lit(1_000_000)) < int(drawn * 1_000_000)).select("k", "at", domain_of(F.col("q"), F.col("t")).alias("domain"))
    sample = docs.select(F.col(key).alias("dk"), F.col(text).alias("text")).join(F.broadcast(known), F.col("dk") == F.col("k"))  # max_labelled rows
    # one text a label, however many rows have its key
    sample = sample.groupBy("at", "domain").agg(F.min("text").alias("text"))
    made = stored(sample.select("at", "domain", "text").mapInArrow(_labelled_features, "at long, domain int, features binary"), "labelled")
    return np.frombuffer(made.coalesce(1).mapInArrow(_train, "weights binary").first()["weights"], np.float32).reshape(len(DOMAINS), FEATURES)


def _apply(weights, n_columns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            p, n = np.zeros((len(batch), len(DOMAINS))), np.zeros(len(batch), np.int64)
            for first, out, bounds, counts in features(batch.column(n_columns)):
                to = first + len(bounds) - 1
                p[first:to], n[first:to] = _scores(w, out, bounds), counts
            yield pa.RecordBatch.from_arrays([*batch.columns[:n_columns], pa.array(n), *[pa.array(np.round(p[:, k], 6)) for k in range(len(DOMAINS))]],
                                             [*batch.schema.names[:n_columns], "n_tokens", *[f"p_{d}" for d in DOMAINS]])
    return run


def memberships(docs: DataFrame, weights: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs``, n_tokens and one posterior per domain."""
    safe = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))
    fields = ", ".join([*[f"c{i} {safe.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(keep))], "n_tokens long", *[f"p_{d} double" for d in DOMAINS]])
    # weights have a fixed size, whatever the corpus
    made = safe.mapInArrow(_apply(docs.sparkSession.sparkContext.broadcast(weights), len(keep)), fields)
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "n_tokens", *[f"p_{d}" for d in DOMAINS])


def fit_rates(members: DataFrame, targets: dict[str, float] | None = None, rounds: int = 15, tolerance: float = 1e-4, scarce: str = "repeat") -> tuple[list[list[float]], dict]:
    """Projected gradient steps (one list of a number per domain each) and the totals reached; see ``rate``.

    ``scarce`` says what becomes of a domain that has too little: with "repeat" the total is such that the first domain gets its
    supply and a little more, and others may get more than they have, by rates above 1; with "thin" the total is as large as the
    scarcest domain allows, so all wanted totals can be had without repeating; with "cap" the total is that of "repeat", but no
    domain is asked for more than its supply (then weights are not met, and ``wanted`` and ``reached`` tell by how much).
    A gradient step is the gaps between totals and targets, times a small matrix that scales it: the inverse of how the totals
    answer to the rates that are above 0. One aggregation gives both.
    """
    targets = targets or TARGETS
    n = len(DOMAINS)

    def totals(r: Column) -> tuple[np.ndarray, np.ndarray]:
        p, tokens = [F.col(f"p_{d}") for d in DOMAINS], F.col("n_tokens")
        moved = F.when(r > 0, tokens).otherwise(0)
        got = members.agg(*[F.sum(tokens * x * r) for x in p], *[F.sum(moved * x * y) for x in p for y in p]).first()
        got = np.array([float(x or 0) for x in got])
        return got[:n], got[n:].reshape(n, n)

    supply, answer = totals(F.lit(1.0))
    weights = np.array([targets[d] for d in DOMAINS])
    if scarce == "thin":
        whole = min((x / t for x, t in zip(supply, weights, strict=True) if t > 0), default=0.0)
    else:
        whole = HEADROOM * supply[0] / weights[0]
    wanted = whole * weights
    if scarce == "cap":
        wanted[1:] = np.minimum(wanted[1:], supply[1:])
    reached = supply
    steps: list[list[float]] = []
    for _ in range(rounds):
        gap = reached - wanted
        if np.abs(gap).max() <= tolerance * max(supply.max(), 1):
            break
        scaled = np.linalg.solve(answer + np.eye(n) * (1e-6 * max(np.trace(answer), 1.0)), gap)
        steps.append([round(float(x), 9) for x in scaled])  # rounded: the same numbers in every expression
        reached, answer = totals(rate(steps))
    shares = lambda x: dict(zip(DOMAINS, (x / x.sum() if x.sum() else x).tolist(), strict=True))
    return steps, {"supply": supply.tolist(), "wanted": wanted.tolist(), "reached": reached.tolist(), "rounds": len(steps), "wanted_shares": shares(wanted), "reached_shares": shares(reached)}


def rate(steps: list[list[float]]) -> Column:
    """The rate of a document: 1, less its share of each step, never below 0."""
    r = F.lit(1.0)
    for step in steps:
        r = F.greatest(F.lit(0.0), r - sum(F.col(f"p_{d}") * g for d, g in zip(DOMAINS, step, strict=True)))
    return r


def mixing_report(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", targets: dict[str, float] | None = None) -> DataFrame:
    """(key, n_tokens, posteriors, domain, rate, and the share of tokens wanted and reached of the row's domain) of each document."""
    members = stored(memberships(docs, train(docs, labels, key, text), [key], text), "memberships")
    steps, found = fit_rates(members, targets)
    best = F.greatest(*[F.col(f"p_{d}") for d in DOMAINS])
    named = F.when(F.col("p_clean") == best, "clean").when(F.col("p_low") == best, "low").otherwise("toxic")
    share = lambda of: F.create_map(*[F.lit(x) for d in DOMAINS for x in (d, round(found[of][d], 6))])
    return members.select(key, "n_tokens", *[f"p_{d}" for d in DOMAINS], named.alias("domain"), F.round(rate(steps), 6).alias("rate")).select(
        "*", share("wanted_shares")[F.col("domain")].alias("wanted_share"), share("reached_shares")[F.col("domain")].alias("reached_share"))


def draw(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", targets: dict[str, float] | None = None, scarce: str = "repeat") -> DataFrame:
    """``docs`` at their rates: as many copies as the rate has whole, and one more if a hash of key and text, between 0 and 1, is
    below the rest. With ``scarce`` "thin" all rates are divided by the largest, so nothing is repeated and the weights are kept;
    with "cap" a document stays once at most, whatever its rate.
    """
    names = docs.columns
    weights = train(docs, labels, key, text)
    safe = docs.toDF(*[f"d{i}" for i in range(len(names))])
    at, k = f"d{names.index(text)}", f"d{names.index(key)}"
    members = stored(memberships(safe.select(at), weights, [], at), "memberships")
    steps, _ = fit_rates(members, targets, scarce=scarce)
    scale = max(1.0, members.agg(F.max(F.when(F.col("n_tokens") > 0, rate(steps)))).first()[0] or 1.0) if scarce == "thin" else 1.0
    chance = F.pmod(F.xxhash64(k, at), F.lit(1 << 30)) / float(1 << 30)
    again = memberships(safe.withColumn("again", F.col(at)), weights, safe.columns, "again")
    own = F.when(F.col("n_tokens") == 0, 1.0).otherwise(rate(steps) / scale)
    copies = (F.floor(own) + (chance < own - F.floor(own)).cast("long")).cast("int")
    copies = F.when(own >= 1, F.lit(1)).otherwise(copies) if scarce == "cap" else copies
    drawn = again.withColumn("copies", copies).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return drawn.select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(names)])
