"""Exact histogram of encoded lengths, and what it answers about context limits.

Texts are encoded where they lie; every task sends one row per distinct length it met. All further numbers come from
the histogram: running sums from the longest length down give, for each length taken as a limit, how many documents and
tokens are cut, kept or fit. Distinct lengths are few: their sum is at most the number of tokens, so a corpus of T tokens
has fewer than sqrt(2 T) of them.

Null text is encoded as empty: a document of 0 tokens. Empty tables give no rows. Repeated rows count as often as they
stand there.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the vocabulary above.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CHUNK = 1 << 16
LEVEL = 4096


def encoder(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Pieces of a long text; cut only before a space between two letters, where the pattern always ends a match."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) - 1 and not (text[cut] == " " and text[cut - 1].isalpha() and text[cut + 1].isalpha()):
            cut += 1
        if cut >= len(text) - 1:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def _count(vocabulary: str, group_columns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, names, types = encoder(vocabulary).encode_ordinary, Counter(), None, None
        for batch in batches:
            names, types = batch.schema.names, batch.schema.types
            groups = zip(*[c.to_pylist() for c in batch.columns[:group_columns]], strict=True) if group_columns else [()] * len(batch)
            for group, text in zip(groups, batch.column(group_columns), strict=True):
                text = text.as_py() or ""
                seen[(*group, len(encode(text)) if len(text) <= CHUNK else sum(len(encode(x)) for x in chunks(text)))] += 1
        if seen:
            rows = list(zip(*seen, strict=True))
            arrays = [pa.array(rows[i], types[i]) for i in range(group_columns)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(rows[-1], pa.int64()), pa.array(list(seen.values()), pa.int64())], [*names[:group_columns], "length", "n_docs"])
    return run


def length_histogram(docs: DataFrame, by: list[str] = (), text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(group columns, length, n_docs): the number of documents of each encoded length."""
    by = list(by)
    read = docs.select(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)], F.col(text).alias("t"))
    fields = [f"g{i} {read.schema[f'g{i}'].dataType.simpleString()}" for i in range(len(by))]
    counted = read.mapInArrow(_count(vocabulary, len(by)), ", ".join([*fields, "length long, n_docs long"]))
    merged = counted.groupBy(*[f"g{i}" for i in range(len(by))], "length").agg(F.sum("n_docs").alias("n_docs"))
    return merged.select(*[F.col(f"g{i}").alias(c) for i, c in enumerate(by)], "length", "n_docs")


def context_limits(histogram: DataFrame, by: list[str] = ()) -> DataFrame:
    """For every length L of the histogram, taken as a context limit:

    docs_longer, tokens_longer: documents of more than L tokens and all their tokens; docs_within: documents that fit;
    truncated_tokens: tokens left if each document is cut at L; lost_tokens; share_within: the quantile that L is (the
    share of documents of at most L tokens); total_docs, total_tokens.

    Suffix sums have two levels: within ranges of 4,096 lengths, then over the ranges, so that no task holds all lengths.
    """
    by = list(by)
    h = histogram.select(*by, "length", "n_docs", (F.col("length") * F.col("n_docs")).alias("n_tokens"), F.expr(f"length div {LEVEL}").alias("_range"))
    later = Window.partitionBy(*by).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*by)
    ranges = h.groupBy(*by, "_range").agg(F.sum("n_docs").alias("_d"), F.sum("n_tokens").alias("_t"))
    ranges = ranges.select(
        *by, "_range", F.coalesce(F.sum("_d").over(later), F.lit(0)).alias("_docs"), F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_tokens"),
        F.sum("_d").over(every).alias("total_docs"), F.sum("_t").over(every).alias("total_tokens"))
    within = Window.partitionBy(*by, "_range").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    h = h.select("*", F.coalesce(F.sum("n_docs").over(within), F.lit(0)).alias("_d"), F.coalesce(F.sum("n_tokens").over(within), F.lit(0)).alias("_t"))
    on = [h[c].eqNullSafe(ranges[c]) for c in by] + [h["_range"] == ranges["_range"]]
    joined = h.join(ranges, on).select(
        *[h[c] for c in by], "length", "n_docs", "n_tokens", (F.col("_d") + F.col("_docs")).alias("docs_longer"), (F.col("_t") + F.col("_tokens")).alias("tokens_longer"), "total_docs", "total_tokens")
    cut = F.col("total_tokens") - F.col("tokens_longer") + F.col("length") * F.col("docs_longer")
    within_docs = F.col("total_docs") - F.col("docs_longer")
    return joined.select(
        *by, "length", "n_docs", "n_tokens", "docs_longer", "tokens_longer", within_docs.alias("docs_within"), cut.alias("truncated_tokens"),
        (F.col("total_tokens") - cut).alias("lost_tokens"), (within_docs / F.col("total_docs")).alias("share_within"), "total_docs", "total_tokens")


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """The same answers for any stated limits, also such as no document has: (limit, docs_longer, truncated_tokens, total_tokens)."""
    parts = [F.struct(F.lit(x).cast("long").alias("limit"), F.coalesce(F.sum(F.when(F.col("length") > x, F.col("n_docs"))), F.lit(0)).alias("docs_longer"),
                      F.coalesce(F.sum(F.least("length", F.lit(x)) * F.col("n_docs")), F.lit(0)).alias("truncated_tokens"),
                      F.coalesce(F.sum(F.col("length") * F.col("n_docs")), F.lit(0)).alias("total_tokens")) for x in limits]
    return histogram.agg(F.array(*parts).alias("x")).select(F.inline("x"))


def quantiles(limits: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least each share of the documents does not exceed: (share, length)."""
    return limits.agg(*[F.min(F.when(F.col("share_within") >= s, F.col("length"))).alias(f"q{i}") for i, s in enumerate(shares)]).select(
        F.inline(F.array(*[F.struct(F.lit(s).alias("share"), F.col(f"q{i}").alias("length")) for i, s in enumerate(shares)])))
