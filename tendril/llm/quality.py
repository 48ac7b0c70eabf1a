"""Quality rules that vote: each rule says good, bad or nothing about a text; expectation-maximisation estimates how far
each can be trusted, and a text is kept by its posterior probability of being good, not by passing every rule.

Rules read nothing but the text, so each document is measured where it lies. The measured table is written once; its
distinct vote patterns (at most 3 to the power of the number of rules, whatever the size of the corpus) and their counts
are all that the estimation needs.

Null text counts as empty: no words, every rule abstains, not kept. Repeated rows are judged alike. Empty tables give no
rows. Texts are never cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import once, stored
from .words import FOLD, VISIBLE, distinct, grams, hashes, repeated, runs, slices, text_buffers

# Frequent function words of the four languages of the corpus.
STOP_WORDS = ("the of and to in is that it for on with as are be by this was at from not you or have an they which "
              "le la les de des et en un une que qui dans pour par sur au est pas avec ce il sont "
              "der die das und den von zu mit sich des auf ist im dem nicht ein eine als auch es an werden "
              "el los las del y una por con para se su al lo como pero sus").split()
SYMBOLS = "#*$%&|<>"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_upper", "n_letters", "n_ended_lines", "n_alpha_words", "top_word", "n_distinct_words"]


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL, _UPPER, _LOWER, _ENDING = _flags(SYMBOLS), _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _flags("abcdefghijklmnopqrstuvwxyz"), _flags(".!?:;\"'")
_ALPHA = _UPPER | _LOWER | (np.arange(256) >= 0x80)


def _stop_hashes() -> np.ndarray:
    data = [w.encode() for w in dict.fromkeys(STOP_WORDS)]
    ends = np.cumsum([len(w) for w in data])
    return np.sort(hashes(np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], ends[:-1]]), ends))


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _measure_slice(raw: np.ndarray, bounds: np.ndarray, stop: np.ndarray) -> dict[str, np.ndarray]:
    n = len(bounds) - 1
    start, end = runs(VISIBLE[raw], bounds)
    offsets = np.searchsorted(start, bounds)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    out = {"n_words": np.diff(offsets)}
    out["word_chars"] = _sums(VISIBLE[raw] & ((raw & 0xC0) != 0x80), bounds)
    out["n_symbols"] = _sums(_SYMBOL[raw], bounds)
    out["n_upper"], out["n_letters"] = _sums(_UPPER[raw], bounds), _sums(_UPPER[raw] | _LOWER[raw], bounds)
    # lines with a word: from the first to the last byte between two line breaks
    line_start, line_end = runs(raw != 10, bounds)
    words_before = np.searchsorted(start, line_start), np.searchsorted(start, line_end)
    full = words_before[1] > words_before[0]
    line_start, line_end = line_start[full], line_end[full]
    line_bounds = np.searchsorted(line_start, bounds)
    out["n_lines"] = np.diff(line_bounds)
    _, _, kept = distinct(hashes(raw, line_start, line_end), line_bounds)
    out["n_dup_lines"] = out["n_lines"] - np.diff(kept)
    last_word = np.searchsorted(start, line_end) - 1
    out["n_ended_lines"] = _sums(_ENDING[raw[end[last_word] - 1]], line_bounds) if len(line_end) else np.zeros(n, np.int64)
    # words in three-word windows that stand twice or more
    h = hashes(raw, start, end)
    g, g_bounds = grams(h, offsets, 3, short=False)
    g_owner = np.repeat(np.arange(n), np.diff(g_bounds))
    same = repeated(g, g_bounds)
    covered = np.zeros(len(h), bool)
    first = (offsets[g_owner] + np.arange(len(g)) - g_bounds[g_owner])[same]
    for k in range(3):
        covered[first + k] = True
    out["n_repeat_words"] = _sums(covered, offsets)
    folded = hashes(FOLD[raw], start, end)
    _, times, d_bounds = distinct(folded, offsets)
    out["n_distinct_words"] = np.diff(d_bounds)
    out["top_word"] = np.zeros(n, np.int64)
    np.maximum.at(out["top_word"], np.repeat(np.arange(n), np.diff(d_bounds)), times)
    at = np.minimum(np.searchsorted(stop, folded), len(stop) - 1)
    out["n_stop_words"] = _sums(stop[at] == folded, offsets)
    out["n_alpha_words"] = np.bincount(owner, weights=_ALPHA[raw[start]], minlength=n).astype(np.int64) if len(start) else np.zeros(n, np.int64)
    return out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stop = _stop_hashes()
    for batch in batches:
        data, bounds = text_buffers(batch.column(0))
        parts = [_measure_slice(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], stop) for a, b in slices(bounds)]
        arrays = [pa.array(np.concatenate([p[m] for p in parts]).astype(np.int64) if parts else [], pa.int64()) for m in MEASURES]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], *arrays], [*batch.schema.names[1:], *MEASURES])


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but for ``text``, and one column per measure."""
    rest = [c for c in docs.columns if c != text]
    safe = docs.select(F.col(text).alias("t"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)])
    fields = ", ".join([*[f"c{i} {safe.schema[f'c{i}'].dataType.simpleString()}" for i in range(len(rest))], *[f"{m} long" for m in MEASURES]])
    made = safe.mapInArrow(_measure, fields)
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest) if c not in MEASURES], *MEASURES)


@dataclass(frozen=True)
class Rule:
    name: str
    bad: Column
    good: Column


def rules() -> list[Rule]:
    """Each rule votes bad, else good, else abstains. Texts without words get no vote."""
    def share(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))

    mean, symbols = share("word_chars", "n_words"), share("n_symbols", "n_words")
    return [
        Rule("length", F.col("n_words") < 20, F.col("n_words") >= 80),
        Rule("word_length", (mean < 2.5) | (mean > 14), mean.between(3, 10)),
        Rule("symbols", symbols > 0.15, symbols <= 0.03),
        Rule("symbol_density", share("n_symbols", "word_chars") > 0.1, share("n_symbols", "word_chars") <= 0.005),
        Rule("duplicate_lines", share("n_dup_lines", "n_lines") > 0.3, (F.col("n_dup_lines") == 0) & (F.col("n_lines") >= 3)),
        Rule("repeated_words", share("n_repeat_words", "n_words") > 0.3, share("n_repeat_words", "n_words") <= 0.05),
        Rule("stop_words", share("n_stop_words", "n_words") < 0.04, share("n_stop_words", "n_words") >= 0.12),
        Rule("capitals", share("n_upper", "n_letters") > 0.4, share("n_upper", "n_letters") <= 0.1),
        Rule("line_ends", share("n_ended_lines", "n_lines") < 0.2, share("n_ended_lines", "n_lines") >= 0.8),
        Rule("alphabetic", share("n_alpha_words", "n_words") < 0.7, share("n_alpha_words", "n_words") >= 0.9),
        Rule("top_word", share("top_word", "n_words") > 0.2, share("top_word", "n_words") <= 0.1),
        Rule("vocabulary", (share("n_distinct_words", "n_words") < 0.25) & (F.col("n_words") < 2000), (share("n_distinct_words", "n_words") >= 0.4) & (F.col("n_words") < 2000)),
    ]


def votes() -> Column:
    """One character per rule: g, b or - (abstains)."""
    some = F.col("n_words") > 0
    return F.concat(*[F.when(some & r.bad, "b").when(some & r.good, "g").otherwise("-") for r in rules()])


@dataclass(frozen=True)
class Model:
    prior: float
    accuracy: list[tuple[float, float]]  # of each rule: P(says good | good), P(says bad | bad), when it votes

    def posterior(self, pattern: str) -> float:
        good, bad = math.log(self.prior), math.log(1 - self.prior)
        for v, (g, b) in zip(pattern, self.accuracy, strict=True):
            if v != "-":
                good += math.log(g if v == "g" else 1 - g)
                bad += math.log(1 - b if v == "g" else b)
        return 1 / (1 + math.exp(max(-700, min(700, bad - good))))


def fit(patterns: dict[str, int], rounds: int = 50, prior: float = 0.8, start: tuple[float, float] = (0.95, 0.4)) -> Model:
    """Expectation-maximisation over the counted vote patterns.

    Rules start as rarely wrong about good texts and often silent about bad ones, as one fault does not show in every rule;
    each stays better than chance: it says good of good texts more often than of bad ones.
    """
    width = len(next(iter(patterns), ""))
    model = Model(prior, [start] * width)
    for _ in range(rounds if patterns else 0):
        p = {k: model.posterior(k) for k in patterns}
        total = sum(patterns.values())
        good = sum(p[k] * n for k, n in patterns.items())
        accuracy = []
        for i in range(width):
            g_vote, g_right = (sum(p[k] * n for k, n in patterns.items() if k[i] in s) for s in ("gb", "g"))
            b_vote, b_right = (sum((1 - p[k]) * n for k, n in patterns.items() if k[i] in s) for s in ("gb", "b"))
            # ten votes of the starting accuracy keep rules with few votes where they began
            g = min(0.995, max(0.55, (g_right + 10 * start[0]) / (g_vote + 10)))
            accuracy.append((g, min(0.99, max(1.05 - g, (b_right + 10 * start[1]) / (b_vote + 10)))))
        model = Model(min(0.98, max(0.02, (good + 8) / (total + 10))), accuracy)
    return model


def judge(docs: DataFrame, keys: list[str], text: str = "text", threshold: float = 0.5, min_words: int = 50, most_repeated: float = 0.5) -> tuple[DataFrame, Model]:
    """(keys, measures, votes, posterior, base_failed, kept) of each row of ``docs``, and the fitted model."""
    measured = stored(measure(docs.select(*keys, text), text).withColumn("votes", votes()), "measured")
    # at most 3 ** rules rows
    counted = {r["votes"]: r["n"] for r in measured.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = fit(counted)
    scored = docs.sparkSession.createDataFrame([(k, model.posterior(k)) for k in counted], "votes string, posterior double")
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    found = measured.join(F.broadcast(scored), "votes")  # one row per pattern
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("posterior") >= threshold)), model


def quality_report(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    found, _ = judge(docs, [key])
    return found.select(key, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("posterior", 9).alias("posterior"), "votes")


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. The texts are measured once for the model and once for the rows."""
    names = docs.columns
    safe = docs.toDF(*[f"d{i}" for i in range(len(names))])
    at = f"d{names.index(text)}"
    _, model = judge(safe, [], at)
    pattern_posterior = F.lit(math.log(model.prior) - math.log(1 - model.prior))
    own = safe.withColumn("text_again", F.col(at))
    measured = once(measure(own, "text_again"), "votes", votes())
    for i, (g, b) in enumerate(model.accuracy):
        v = F.substring("votes", i + 1, 1)
        pattern_posterior = pattern_posterior + F.when(v == "g", math.log(g / (1 - b))).when(v == "b", math.log((1 - g) / b)).otherwise(0.0)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.where(~failed & (pattern_posterior >= 0)).select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(names)])
