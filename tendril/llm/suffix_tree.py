"""Language-model scoring by a probabilistic suffix tree over words.

The tree's nodes are contexts: the last one to ``max_depth`` words. A context is retained if its next-word distribution
diverges from that of its longest retained suffix. It lists the next words that follow it ``min_count`` times or more; the
rest of its probability, and a discount from each listed word, goes to its suffix, and at the root to add-half unigrams. Each
token is scored in the state of the longest retained suffix of what stands before it in its text. ``min_count`` is a fixed
number: contexts and listed words grow with the corpus, and none is left out for being a small share of it.

The whole tree is in tables: one of unigrams, and for each depth one of n-grams (context and listed word) and one of retained
contexts. A token's score is a sum over the n-grams that end with it: what the unigram gives, what each listed n-gram adds to
its suffix (its ``gain``), and what each retained context gives to its suffix (its ``rest``). A text's score is therefore the
sum over all n-grams in it, each looked up once by its key. The most frequent n-grams
are broadcast (at most ``HOT_MOST`` words and as many longer ones) and added up where the text is read; all others go to the
tables by a join. What is broadcast decides on the work only, never on the result. Bitmaps of bounded size tell n-grams that are surely not in a
table; those that seem to be in it are counted or joined like any other.

Words are runs without white space, A-Z lower-cased; each text ends with an end token. Null and empty texts have the end
token only. A null key counts as the empty string when texts are held out. Repeated rows count as often as they stand
there. Without training texts all tokens are equally unknown. Empty tables give no rows.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import stored
from .words import FOLD, VISIBLE, Words, mix, words

MAX_DEPTH = 2
MIN_COUNT = 3
DIVERGENCE = 0.02
DISCOUNT = 0.5
END = np.uint64(0x5851F42D4C957F2D)
# what is broadcast: n-grams that occur so often, and at most so many words and so many longer ones; results don't depend on these
HOT_COUNT = 16
HOT_MOST = 1 << 20
MOST_BITS = 28
# keys: numbers of broadcast words have 21 bits, those of n-grams of up to three of them 63; the others are hashes with the top bit
WORD_BITS = 21
TOP = np.uint64(1 << 63)
COUNTED_AT_ONCE = 1 << 21
ROWS_AT_ONCE = 1 << 16


class Lookup:
    """Positions of known 64-bit keys, through tables addressed by their bits; keys that meet move on to a next table."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(np.uint64)
        self.tables: list[tuple[np.uint64, np.ndarray]] = []
        left = np.arange(len(keys))
        while len(left):
            size = 1 << max(8, int(4 * len(left) - 1).bit_length())
            table = np.full(size, -1, np.int32)
            slot = self._slot(self.keys[left], len(self.tables), size)
            table[slot] = left
            self.tables.append((np.uint64(size), table))
            left = left[table[slot] != left]

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64(level * 2 + 1)) & np.uint64(size - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, or -1."""
        out, at = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (size, table) in enumerate(self.tables):
            got = table[self._slot(keys, level, int(size))]
            met = np.flatnonzero(got >= 0)  # a key whose slot is empty is in no later table either
            same = self.keys[got[met]] == keys[met]
            out[at[met[same]]] = got[met[same]]
            at, keys = at[met[~same]], keys[met[~same]]
            if not len(keys):
                break
        return out


def _key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)


@dataclass
class Level:
    """Contexts of one length. Numbers follow ``contexts``; entries are (context, word) with their log10 probabilities."""

    contexts: Lookup  # of words at depth 1, of (context one word shorter, word) beyond
    retained: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    log_rest: np.ndarray = field(default_factory=lambda: np.zeros(0))
    entries: Lookup = field(default_factory=lambda: Lookup(np.zeros(0, np.uint64)))
    log_p: np.ndarray = field(default_factory=lambda: np.zeros(0))
    suffix: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # each context's number at the level before, without its first word


@dataclass
class Tree:
    words: Lookup
    counts: np.ndarray
    tokens: int
    distinct: int
    levels: list[Level]

    def log_root(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))


def with_ends(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts of a slice, and the bounds of texts among them."""
    n = len(w)
    out = np.empty(len(w.start) + n, np.uint64)
    owner = np.repeat(np.arange(n), w.counts())
    out[np.arange(len(owner)) + owner] = w.hashes()
    bounds = w.offsets + np.arange(n + 1)
    out[bounds[1:] - 1] = END
    return out, bounds


def log_probability(tree: Tree, word: np.ndarray, contexts: list[np.ndarray], root: np.ndarray) -> np.ndarray:
    """log10 probability of each token in the longest retained state of its contexts; ``root`` has what the root says."""
    out, open_ = np.zeros(len(word)), np.ones(len(word), bool)
    for level, context in reversed(list(zip(tree.levels, contexts, strict=False))):
        if not len(level.retained):
            continue
        at = np.flatnonzero(open_ & (context >= 0))
        at = at[level.retained[context[at]]]
        got = np.full(len(at), -1, np.int64)
        known = word[at] >= 0
        got[known] = level.entries.find(_key(context[at][known], word[at][known]))
        listed = got >= 0
        out[at[listed]] += level.log_p[got[listed]]
        open_[at[listed]] = False
        out[at[~listed]] += level.log_rest[context[at[~listed]]]
    out[open_] += root[open_]
    return out


def _add_level(tree: Tree, level: Level, context_counts: np.ndarray, entry: np.ndarray, count: np.ndarray, suffix: np.ndarray, divergence: float) -> None:
    """Distributions of a level's contexts, from the counted followers; contexts that tell no more than their suffix are not retained.

    ``suffix``: for each context, the number of the context one word shorter at the level before (-1: the root).
    """
    context, word = (entry >> np.uint64(32)).astype(np.int64), (entry & np.uint64(0xFFFFFFFF)).astype(np.int64)
    n = len(context_counts)
    p = (count - DISCOUNT) / context_counts[context]
    shorter, up = [], suffix[context]
    for above in reversed(tree.levels):
        shorter.insert(0, up)
        up = np.where(up >= 0, above.suffix[np.maximum(up, 0)], -1)
    q = 10 ** log_probability(tree, word, shorter, tree.log_root(tree.counts[word]))
    p_sum, q_sum = np.bincount(context, p, n), np.bincount(context, q, n)
    rest_p, rest_q = np.maximum(1 - p_sum, 1e-9), np.maximum(1 - q_sum, 1e-9)
    diverges = np.bincount(context, p * np.log(p / q), n) + rest_p * np.log(rest_p / rest_q)
    level.retained = (diverges >= divergence) & (np.bincount(context, minlength=n) > 0)
    level.log_rest = np.log10(rest_p / rest_q)
    keep = level.retained[context]
    level.entries, level.log_p = Lookup(entry[keep]), np.log10(p[keep])
    level.suffix = suffix
    tree.levels.append(level)


_held: dict = {}


def _loaded(model):
    """What was broadcast; tasks that a worker runs one after the other unpack it once, each array straight from its own bytes."""
    if model not in _held:
        _held.clear()
        packed, arrays = model.value
        _held[model] = pickle.loads(packed, buffers=map(zlib.decompress, arrays))
    return _held[model]


def _sent(df: DataFrame, value):
    arrays: list[pickle.PickleBuffer] = []
    packed = pickle.dumps(value, protocol=5, buffer_callback=arrays.append)
    return df.sparkSession.sparkContext.broadcast((packed, [zlib.compress(a.raw(), 1) for a in arrays]))


def extended(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Key of each n-gram, from the key of all words but the last (0: none) and that of the last. Negative keys are hashes."""
    hashed = (mix(context.view(np.uint64) * np.uint64(0x9FB21C651E98DF25) + word.view(np.uint64)) | TOP).view(np.int64)
    small = (word >= 0) & (context >= 0) & (context < 1 << 2 * WORD_BITS)
    return np.where(context == 0, word, np.where(small, (context << WORD_BITS) | word, hashed))


@F.pandas_udf(LongType())
def _extended(context: pd.Series, word: pd.Series) -> pd.Series:
    return pd.Series(extended(context.to_numpy(), word.to_numpy()))


_extended = _extended.asNondeterministic()  # else it is also worked out for filters that are pushed below a join


@dataclass
class Bitmap:
    """Tells keys that are surely not in a table. Its size is bounded; when the table outgrows it, it tells fewer."""

    bits: np.ndarray
    size: int

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = places(keys, self.size)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def places(keys: np.ndarray, size: int) -> np.ndarray:
    return (mix(keys.view(np.uint64)) & np.uint64(size - 1)).astype(np.int64)


def _bitmap(table: DataFrame, most_bits: int = MOST_BITS) -> Bitmap | None:
    """Bitmap of the column ``key``, put together by ranges of bits; none for an empty table."""
    n = table.count()
    if not n:
        return None
    size = 1 << max(15, min(most_bits, (32 * n - 1).bit_length()))

    @F.pandas_udf(LongType())
    def place(key: pd.Series) -> pd.Series:
        return pd.Series(places(key.to_numpy(), size) + 1)

    put = table.select(place("key").alias("place")).select(F.bitmap_bucket_number("place").alias("bucket"), F.bitmap_bit_position("place").alias("bit")).repartition("bucket")
    bits = np.zeros(size // 8, np.uint8)
    got = put.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow()
    for bucket, part in zip(got["bucket"].to_pylist(), got["bits"], strict=True):
        bits[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(part.as_buffer(), np.uint8)
    return Bitmap(bits, size)


def _codes(at: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Keys of words, from their positions in the vocabulary: number from 1 of those that are broadcast, hash with the top bit of the others."""
    return np.where(at >= 0, at + 1, (tokens | TOP).view(np.int64))


def _chains(codes: np.ndarray, bounds: np.ndarray, length: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For 1 .. length the keys of the n-grams of that many words that end at each token, and each token's place in its text.

    A key counts only where the place is large enough.
    """
    chains = [codes]
    for _ in range(length - 1):
        chains.append(extended(np.concatenate([[1], chains[-1][:-1]]), codes))
    return chains, np.arange(len(codes)) - np.repeat(bounds[:-1], np.diff(bounds))


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The executor holds a batch whole, outside its heap; so it gets a large one in pieces."""
    return (batch.slice(at, ROWS_AT_ONCE) for at in range(0, batch.num_rows, ROWS_AT_ONCE))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted(seen: list[np.ndarray]) -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(seen), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["word", "n"])
    seen, size = [], 0
    for batch in batches:
        for w in words(batch.column(0), VISIBLE, FOLD):
            seen.append(with_ends(w)[0])
            size += len(seen[-1])
            if size > COUNTED_AT_ONCE:
                yield from _pieces(counted(seen))
                seen, size = [], 0
    if seen:
        yield from _pieces(counted(seen))


def _key_words(model):
    """Keys of the unigrams in place of their hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _loaded(model)
        for batch in batches:
            tokens = batch.column(0).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_codes(vocabulary.find(tokens), tokens)), batch.column(1)], ["key", "n"])
    return run


def _counted(packed: list[np.ndarray], hashed: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Distinct n-grams and how often they occur. Packed keys give back their context and word; hashed ones come with them."""
    values, n = np.unique(np.concatenate(packed), return_counts=True)
    keys, context, word = map(np.concatenate, zip(*hashed, strict=True))
    _, first, m = np.unique(keys, return_index=True, return_counts=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x)) for x in ((values >> WORD_BITS, context[first]), (values & ((1 << WORD_BITS) - 1), word[first]), (n, m))], ["context", "word", "n"])


def _count_grams(model, depth: int):
    """N-grams of ``depth`` words and one more, where both n-grams within may have been seen often enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, often = _loaded(model)
        packed, hashed, size = [], [], 0
        for batch in batches:
            for w in words(batch.column(0), VISIBLE, FOLD):
                tokens, bounds = with_ends(w)
                chains, place = _chains(_codes(vocabulary.find(tokens), tokens), bounds, depth + 1)
                ok = often.find(chains[depth - 1])
                at = np.flatnonzero(ok[1:] & ok[:-1] & (place[1:] >= depth)) + 1
                keys = chains[depth][at]
                packed.append(keys[keys >= 0])
                at = at[keys < 0]
                hashed.append((chains[depth][at], chains[depth - 1][at - 1], chains[0][at]))
                size += len(keys)
                if size > COUNTED_AT_ONCE:
                    yield from _pieces(_counted(packed, hashed))
                    packed, hashed, size = [], [], 0
        if packed:
            yield from _pieces(_counted(packed, hashed))
    return run


def _gram_counts(read: DataFrame, known: tuple[Lookup, Bitmap], depth: int) -> DataFrame:
    # blocks come counted: to add them up before the shuffle too takes out few rows, and a hash table as large as the task
    blocks = read.mapInArrow(_count_grams(_sent(read, known), depth), "context long, word long, n long").repartition("context", "word")
    return blocks.groupBy("context", "word").agg(F.sum("n").alias("n"))


@dataclass
class Hot:
    """What is broadcast for scoring: of words what the root and they as contexts give, of longer n-grams their gain."""

    vocabulary: Lookup
    root: np.ndarray
    rest: np.ndarray
    grams: Lookup
    gain: np.ndarray
    others: Bitmap | None
    depth: int


@dataclass
class Model:
    """A tree. ``nodes``: (key, n, gain) of all that is not broadcast; n is null but for words. A key may have two rows: as an n-gram and as a context."""

    hot: Hot
    nodes: DataFrame
    tokens: int
    distinct: int

    def log_root(self, n: Column) -> Column:
        return _log_root(n, self.tokens, self.distinct)


def _log_root(n, tokens: int, distinct: int):
    return (F if isinstance(n, Column) else np).log10((n + 0.5) / (tokens + 0.5 * (distinct + 1)))


def _cut(table: DataFrame, least: int, most: int = HOT_MOST) -> int:
    """Smallest n from ``least`` on that at most ``most`` rows reach, by the numbers of rows of each n."""
    got = table.where(F.col("n") >= least).groupBy("n").count().toArrow()
    n, rows = got["n"].to_numpy(), got["count"].to_numpy()
    order = np.argsort(-n)
    over = np.flatnonzero(np.cumsum(rows[order]) > most)
    return int(n[order][over[0]]) + 1 if len(over) else least


def learn(training: DataFrame, text: str = "text", max_depth: int = MAX_DEPTH, min_count: int = MIN_COUNT, divergence: float = DIVERGENCE, hot_count: int = HOT_COUNT) -> Model:
    read = training.select(F.col(text).alias("text"))
    counts = stored(read.mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "unigrams")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    word_cut = _cut(counts, hot_count)
    got = counts.where(F.col("n") >= word_cut).toArrow()
    word, n = got["word"].to_numpy(), got["n"].to_numpy()
    order = np.lexsort((word, -n))
    vocabulary, n = Lookup(word[order].view(np.uint64)), n[order]

    unigrams = stored(counts.mapInArrow(_key_words(_sent(counts, vocabulary)), "key long, n long"), "words")
    grams = unigrams.where(F.col("n") >= min_count).select("key", "n", F.lit(0).cast("long").alias("suffix"), _log_root(F.col("n"), tokens, distinct).alias("log_p"))
    p, rest_p, rest_q = (F.col("n") - DISCOUNT) / F.col("context_n"), F.greatest(1 - F.col("p_sum"), F.lit(1e-9)), F.greatest(1 - F.col("q_sum"), F.lit(1e-9))
    nodes = []
    for depth in range(1, max_depth + 1):
        often = _bitmap(grams)
        if often is None:
            break
        # (context, word) with the context's count and what the suffixes of both say of the word
        found = _gram_counts(read, (vocabulary, often), depth).where(F.col("n") >= min_count)
        contexts = grams.select(F.col("key").alias("context"), F.col("n").alias("context_n"), F.col("suffix").alias("context_suffix"))
        lower = grams.select(F.col("key").alias("suffix"), F.col("log_p").alias("lower"))
        suffix = F.col("word") if depth == 1 else _extended("context_suffix", "word")
        followers = stored(
            found.join(contexts.hint("shuffle_hash"), "context").select("context", "word", "n", "context_n", suffix.alias("suffix")).join(lower.hint("shuffle_hash"), "suffix"), "followers")
        q = F.pow(F.lit(10.0), "lower")
        sums = followers.groupBy("context").agg(F.sum(p).alias("p_sum"), F.sum(q).alias("q_sum"), F.sum(p * F.ln(p / q)).alias("diverges"), F.max("context_n").alias("n"))
        retained = stored(sums.where(F.col("diverges") + rest_p * F.ln(rest_p / rest_q) >= divergence).select("context", "n", F.log10(rest_p / rest_q).alias("rest")), "contexts")
        listed = F.col("rest").isNotNull()
        grams = stored(followers.join(retained.select("context", "rest"), "context", "left").select(
            _extended("context", "word").alias("key"), "n", "suffix", F.when(listed, F.log10(p)).otherwise(F.col("lower")).alias("log_p"),
            F.when(listed, F.log10(p) - F.col("lower") - F.col("rest")).alias("gain")), "grams")
        nodes += [retained.select(F.lit(depth).alias("length"), F.col("context").alias("key"), "n", F.col("rest").alias("gain")),
                  grams.where(F.col("gain").isNotNull()).select(F.lit(depth + 1).alias("length"), "key", "n", "gain")]

    return _model(unigrams, nodes, vocabulary, n, word_cut, hot_count, tokens, distinct)


def _model(unigrams: DataFrame, nodes: list[DataFrame], vocabulary: Lookup, n: np.ndarray, word_cut: int, hot_count: int, tokens: int, distinct: int) -> Model:
    """Parts what is broadcast from what is joined."""
    words_ = unigrams.where(F.col("n") < word_cut).select("key", "n", F.lit(0.0).alias("gain"))
    hot = Hot(vocabulary, _log_root(n.astype(np.float64), tokens, distinct), np.zeros(len(n)), Lookup(np.zeros(0, np.uint64)), np.zeros(0), None, len(nodes) // 2)
    if not nodes:
        return Model(hot, words_, tokens, distinct)
    every = reduce(DataFrame.unionByName, nodes)
    cut = F.when(F.col("length") == 1, word_cut).otherwise(_cut(every.where("length > 1"), hot_count))
    got = every.where(F.col("n") >= cut).select("length", "key", "gain").toArrow()
    length, key, gain = (got[c].to_numpy() for c in ("length", "key", "gain"))
    hot.rest[key[length == 1] - 1] = gain[length == 1]
    keys, at = np.unique(key[length > 1], return_inverse=True)
    hot.grams, hot.gain = Lookup(keys.view(np.uint64)), np.bincount(at, gain[length > 1], len(keys))
    others = every.where(F.col("n") < cut)
    hot.others = _bitmap(others.where("length > 1").select("key"))
    return Model(hot, words_.unionByName(others.select("key", F.lit(None).cast("long").alias("n"), "gain")), tokens, distinct)


SUMS = "n_tokens long, n_frequent long, base double, score double"


def _score(model, n_columns: int):
    """A row for each text, with the columns before it, the number of its tokens, of broadcast ones and their log10 probabilities so far; one for each n-gram to be joined."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, row = _loaded(model), TaskContext.get().partitionId() << 33
        root, rest = np.append(hot.root, 0.0), np.append(hot.rest, 0.0)
        for batch in batches:
            for w in words(batch.column(n_columns), VISIBLE, FOLD):
                tokens, bounds = with_ends(w)
                at = hot.vocabulary.find(tokens)
                known = at >= 0
                chains, place = _chains(_codes(at, tokens), bounds, hot.depth + 1)
                base, score, joined = root[at], root[at] + rest[at], [np.flatnonzero(~known)]
                for length, keys in enumerate(chains[1:], 1):
                    inside = np.flatnonzero(place >= length)
                    got = hot.grams.find(keys[inside].view(np.uint64))
                    score[inside[got >= 0]] += hot.gain[got[got >= 0]]
                    left = inside[got < 0]
                    joined.append(left[hot.others.find(keys[left])] if hot.others else left[:0])
                sums = [np.add.reduceat(x, bounds[:-1]) for x in (known.astype(np.int64), base, score)]
                n, owner = len(w), np.searchsorted(bounds, np.concatenate(joined), "right") - 1
                key = np.concatenate([np.arange(row, row + n), *[keys[i] for keys, i in zip(chains, joined, strict=True)]])
                # rows of texts first, which meet no node
                text = pa.array(np.concatenate([np.arange(n), np.full(len(owner), -1)]), mask=np.arange(len(key)) >= n)
                fields = [*[c.slice(w.first, n) for c in batch.columns[:n_columns]], pa.array(np.diff(bounds)), *[pa.array(x) for x in sums]]
                names = [*batch.schema.names[:n_columns], "n_tokens", "n_frequent", "base", "score"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.concatenate([np.arange(n), owner])), pa.array(key), pa.StructArray.from_arrays(fields, names).take(text)], ["row", "key", "text"])
                row += n
    return run


def held_out(key: str) -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 1


def score_report(docs: DataFrame, key: str = "doc_id", text: str = "text", held: Column | None = None, **options) -> DataFrame:
    """Per document: tokens, known ones, log10 probability under add-half unigrams and under the tree, learnt from the rows that are not held out."""
    held = held_out(key) if held is None else held
    read = docs.select(F.col(key).alias("key"), held.alias("held_out"), F.col(text).alias("text"))
    model = learn(read.where(~F.col("held_out")), text="text", **options)
    fields = f"row long, key long, text struct<key: {read.schema['key'].dataType.simpleString()}, held_out: boolean, {SUMS.replace(' ', ': ').replace(',:', ',')}>"
    scored = read.mapInArrow(_score(_sent(read, model.hot), 2), fields)

    nodes = model.nodes.select(F.col("key").alias("node"), "n", "gain")
    # a text's row has sums so far, that of an n-gram what the node gives; a word that no training text has meets none
    base, known = F.coalesce("text.base", model.log_root(F.col("n")), F.lit(0.0)), F.coalesce("text.n_frequent", F.col("n").isNotNull().cast("long"))
    joined = scored.join(nodes.hint("shuffle_hash"), (scored["key"] == nodes["node"]) & scored["text"].isNull(), "left").select(
        "row", "text.key", "text.held_out", "text.n_tokens", known.alias("n_known"), base.alias("base"), F.coalesce("text.score", base + F.coalesce("gain", F.lit(0.0))).alias("score"))
    found = joined.groupBy("row").agg(
        F.first("key", ignorenulls=True).alias("key"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base"),
        F.sum("score").alias("score"))
    unknown = (F.col("n_tokens") - F.col("n_known")) * model.log_root(F.lit(0))
    return found.select(
        F.col("key").alias(key), "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + unknown).alias("base_score"), (F.col("score") + unknown).alias("score"))
