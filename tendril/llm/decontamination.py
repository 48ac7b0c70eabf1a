"""Benchmark decontamination: windows of test words looked up in every training text.

Windows of the benchmark are hashed and broadcast as one sorted array; each document's windows of the same lengths are
looked up in it, hits are verified word by word, and the words inside them are marked. A benchmark of more than
``windows_per_block`` windows is worked off in blocks of that size, each a scan of its own, so what is broadcast never
grows with the benchmark. Documents are not shuffled.

Null text has no words. Benchmark rows with null or wordless texts have no windows; repeated item rows count once.
Repeated document rows each get their result. A text of any length is worked on as a whole.
"""

from __future__ import annotations

import hashlib
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .words import FOLD, LETTERS, Words, grams, words

WINDOW = 10
WINDOWS_PER_BLOCK = 500_000

HITS = "_words long, _spans array<struct<start:long,end:long>>, _items array<string>"


def _normal(w: Words, at: int, to: int) -> bytes:
    return b" ".join(w.data[s:e].tobytes() for s, e in zip(w.start[at:to], w.end[at:to], strict=True))


def _windows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(0).to_pylist()
            for w in words(batch.column(1), LETTERS, FOLD):
                h = w.hashes()
                g, bounds = grams(h, w.offsets, n)
                for t in range(len(w)):
                    lo, hi = w.offsets[t], w.offsets[t + 1]
                    size = int(min(n, hi - lo))
                    k = bounds[t + 1] - bounds[t]
                    if k:
                        yield pa.RecordBatch.from_arrays([
                            pa.array([items[w.first + t]] * k, pa.string()), pa.array([size] * k, pa.int32()), pa.array(g[bounds[t] : bounds[t + 1]].view(np.int64)),
                            pa.array([_normal(w, lo + i, lo + i + size) for i in range(k)], pa.binary())], ["item", "size", "hash", "window"])
    return run


def _blocks(benchmark: DataFrame, item: str, text: str, n: int, per_block: int) -> Iterator[bytes]:
    """Pickled look-up tables, of up to ``per_block`` windows each."""
    rows = stored(benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).mapInArrow(_windows(n), "item string, size int, hash long, window binary")
                  .distinct(), "windows")
    total = rows.count()
    # ranges of a hash of the whole row hold equal shares of the windows; one look-up entry is one row
    parts = max(1, -(-total // (per_block * 9 // 10)))
    for k in range(parts):
        part = rows.where(F.pmod(F.xxhash64("item", "hash", "window"), F.lit(parts)) == k) if parts > 1 else rows
        got = part.sort("size", "hash", "window", "item").toArrow()
        yield zlib.compress(pickle.dumps({
            "size": got["size"].to_numpy(), "hash": got["hash"].to_numpy().view(np.uint64), "window": got["window"].to_pylist(), "item": got["item"].to_pylist()}))


def _scan(block, n_columns: int):
    """Adds the block's hits to the three last columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = pickle.loads(zlib.decompress(block.value))
        tables = {int(s): (lambda at: (x["hash"][at], np.flatnonzero(at)))(x["size"] == s) for s in np.unique(x["size"])}
        tables = {s: (h[o := np.argsort(h, kind="stable")], r[o]) for s, (h, r) in tables.items()}
        for batch in batches:
            n_words, spans, items = np.zeros(len(batch), np.int64), [[] for _ in range(len(batch))], [set() for _ in range(len(batch))]
            for w in words(batch.column(n_columns), LETTERS, FOLD):
                n_words[w.first : w.first + len(w)] = w.counts()
                h = w.hashes()
                for size, (keys, rows) in tables.items():
                    g, bounds = grams(h, w.offsets, size, short=False)
                    lo = np.searchsorted(keys, g)
                    hits = np.flatnonzero((lo < len(keys)) & (keys[np.minimum(lo, len(keys) - 1)] == g))
                    owner = np.searchsorted(bounds, hits, "right") - 1
                    for i, t in zip(hits, owner, strict=True):
                        at = w.offsets[t] + i - bounds[t]
                        seen, k, hit = _normal(w, at, at + size), lo[i], False
                        while k < len(keys) and keys[k] == g[i]:
                            if x["window"][rows[k]] == seen:
                                items[w.first + t].add(x["item"][rows[k]])
                                hit = True
                            k += 1
                        if hit:
                            spans[w.first + t].append((int(i - bounds[t]), int(i - bounds[t] + size)))
            kept, old_spans, old_items = batch.columns[:n_columns + 1], batch.column(n_columns + 2).to_pylist(), batch.column(n_columns + 3).to_pylist()
            merged = [[{"start": s, "end": e} for s, e in _union([(y["start"], y["end"]) for y in a or []] + b)] for a, b in zip(old_spans, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(n_words), pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array([sorted(b.union(a or []), key=lambda k: (k is None, k or "")) for a, b in zip(old_items, items, strict=True)], pa.list_(pa.string()))],
                names=[*batch.schema.names[: n_columns + 1], "_words", "_spans", "_items"])
    return run


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                       n: int = WINDOW, windows_per_block: int = WINDOWS_PER_BLOCK) -> DataFrame:
    """``docs`` with ``_words`` (number of words), ``_spans`` (word ranges hit, merged) and ``_items`` (sorted item ids).

    Columns of ``docs`` stay as they are, whatever their names; the three new names replace columns of the same name.
    """
    docs = docs.drop("_words", "_spans", "_items")
    names = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])
    where = [i for i, c in enumerate(names) if c.lower() == text.lower()][0]
    rest = [c for i, c in enumerate(numbered.columns) if i != where]
    state = numbered.select(*rest, F.col(f"c{where}"), F.lit(0).cast("long").alias("_words"), F.from_json(F.lit("[]"), "array<struct<start:long,end:long>>").alias("_spans"),
                            F.from_json(F.lit("[]"), "array<string>").alias("_items"))
    schema = T.StructType([*state.schema.fields[: len(names)], *T._parse_datatype_string(HITS).fields])
    blocks = _blocks(benchmark, item, item_text, n, windows_per_block)
    block, more = next(blocks), next(blocks, None)
    while True:
        state = state.mapInArrow(_scan(docs.sparkSession.sparkContext.broadcast(block), len(names) - 1), schema)
        if more is None:
            break
        state = stored(state, "scanned")  # one block in memory at a time
        block, more = more, next(blocks, None)
    return state.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "_words", "_spans", "_items")


def contamination_report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    found = find_contamination(docs.select(key, "text"), benchmark, **options)
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        key, F.col("_words").alias("n_words"), hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), (F.size("_spans") > 0).alias("contaminated"))


def _find_numbered(docs: DataFrame, benchmark: DataFrame, text: str, **options) -> tuple[DataFrame, str, list]:
    """Hits in ``docs`` with its columns renamed c0, c1, ..., so that none of them clashes; the text's new name; the way back."""
    names = docs.columns
    at = [i for i, c in enumerate(names) if c.lower() == text.lower()][0]
    found = find_contamination(docs.toDF(*[f"c{i}" for i in range(len(names))]), benchmark, text=f"c{at}", **options)
    return found, f"c{at}", [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, most_share: float = 0.0, text: str = "text", **options) -> DataFrame:
    """Documents of which at most ``most_share`` of the words stand in a benchmark window, with their own columns only."""
    found, _, own = _find_numbered(docs, benchmark, text, **options)
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.where(hit <= F.col("_words") * most_share).select(*own)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """Documents without the words that stand in a benchmark window; text between kept words stays as it was."""
    found, body, own = _find_numbered(docs, benchmark, text, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, spans = batch.schema.get_field_index(body), batch.column(batch.schema.get_field_index("_spans")).to_pylist()
            texts = batch.column(at).to_pylist()
            for w in words(batch.column(at), LETTERS, FOLD):
                for t in range(len(w)):
                    cuts = spans[w.first + t]
                    if not cuts:
                        continue
                    raw, low, off = texts[w.first + t].encode(), w.bounds[t], w.offsets[t]
                    out, done = [], 0
                    for c in cuts:
                        out.append(raw[done : w.start[off + c["start"]] - low])
                        done = w.end[off + c["end"] - 1] - low
                    texts[w.first + t] = b"".join([*out, raw[done:]]).decode()
            yield batch.set_column(at, body, pa.array(texts, pa.string()))

    return found.mapInArrow(run, found.schema).select(*own)
