"""Packing of token sequences: bounded-space online best-fit in every task, leftovers merged in rounds.

A task takes its rows as they come. Open bins lie in lists by their free space, and a bitset has one bit for each free space
that some open bin has: the lowest set bit from an item's length on is the bin that it fits best. What fits nowhere opens a bin;
with ``OPEN`` bins open, the fullest closes first. A closed bin is a sequence.

The open bins that a task ends with are not closed half empty: their items go on to the next round, where ``FAN`` tasks' leftovers
make one task's input, until one task is left, whose open bins are the last sequences. So no task but the first round's reads more
than ``FAN * OPEN`` bins' items. That last task may have as many bins open as items for so many can come, and takes the long items
first: the rest of all tasks is packed tightly once, whatever its number of tasks was.
The rounds number log of the tasks to base ``FAN``; the first round runs where the items are made, without a shuffle.

Null text is empty: a document of its end id alone. Equal keys are different documents, and repeated rows are packed as often as
they stand there. An empty table gives no rows; further columns of documents are not touched. Texts are encoded whole.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import record_batches, stored

VOCABULARY = "word_bpe_49k.json"
SIZE = 2048
END = 0
OPEN = 512
FAN = 8
KEPT, KEPT_PIECES, LONGEST_KEPT = 1 << 18, 1 << 19, 64
# Letters, digits and marks whose lower case and normal form are single characters, and the vocabulary's pattern on them.
LATIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017f]+")
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017f]+")
# White space of the vocabulary's pattern, and the characters that only Python takes for white space.
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
SEPARATORS = re.compile("[\x1c-\x1f]")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Pieces(dict):
    """Ids (little-endian, four bytes each) of the pieces between which the vocabulary never merges."""

    def __init__(self, coder):
        self.model = coder.model
        # the vocabulary is written in characters that stand for bytes: visible ones for themselves, the others from 256 on
        seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in set(seen)]
        self.shown = {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def __missing__(self, piece: str) -> bytes:
        ids = [token.id for token in self.model.tokenize(piece.encode().decode("latin-1").translate(self.shown))]
        return _keep(self, piece, ids, KEPT_PIECES)


def _keep(table: dict, key: str, ids: list[int], most: int) -> bytes:
    packed = struct.pack(f"<{len(ids)}I", *ids)
    if len(key) <= LONGEST_KEPT:
        if len(table) >= most:
            table.clear()
        table[key] = packed
    return packed


class Encoder(dict):
    """Ids of words, kept for the words met; the vocabulary's file is read once a worker.

    The vocabulary drops white space and no token spans it, so a text's ids are those of its words. Words of Latin letters, ASCII
    digits and marks are put together from their lower-cased pieces; others go through the tokenizer whole. At most ``KEPT`` words
    and ``KEPT_PIECES`` pieces are kept; then a table starts anew. Strings of special tokens are ordinary text.
    """

    def __init__(self, vocabulary: str):
        # one thread a task; Spark runs the tasks side by side
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(vocabulary)
        self.coder.encode_special_tokens = True
        self.pieces = _Pieces(self.coder)

    def __missing__(self, word: str) -> bytes:
        if not LATIN.fullmatch(word):
            return _keep(self, word, self.coder.encode(word, add_special_tokens=False).ids, KEPT)
        packed = b"".join(map(self.pieces.__getitem__, PIECE.findall(word.lower())))
        if len(word) <= LONGEST_KEPT:
            if len(self) >= KEPT:
                self.clear()
            self[word] = packed
        return packed

    def text(self, text: str) -> bytes:
        # these four split a text in Python, but not in the vocabulary's pattern
        if SEPARATORS.search(text):
            return b"".join(map(self.__getitem__, SPACE.split(text)))
        return b"".join(map(self.__getitem__, text.split()))


@cache
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def _pieces(vocabulary: str | None, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary or vocabulary_path()).text
        end, step = struct.pack("<I", END), 4 * size

        def rows(keys, texts):
            for key, text in zip(keys, texts, strict=True):
                ids = encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    yield key, piece, at // 4, len(part) // 4, zlib.crc32(part)
        for batch in batches:
            yield from record_batches(rows(batch.column(0).to_pylist(), batch.column(1)), ["key", "piece", "start", "length", "ids_crc32"], [batch.schema.types[0], *[pa.int64()] * 4], 4096)
    return run


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, size: int = SIZE) -> DataFrame:
    """(key, piece, start, length, ids_crc32): every document's ids and its end id; longer ones in pieces of ``size``."""
    read = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    made = read.mapInArrow(_pieces(vocabulary, size), f"key {read.schema['key'].dataType.simpleString()}, piece long, start long, length long, ids_crc32 long")
    return made.withColumnRenamed("key", key)


class Bins:
    """Open bins of one task. ``put`` gives the bins that close; a bin is [used space, [(item, offset), ...]]."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.n_open, self.bits = size, most, 0, 0
        self.by_free: list[list] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> list:
        bin_ = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits ^= 1 << free
        self.n_open -= 1
        return bin_

    def put(self, item, length: int) -> list:
        fits = self.bits >> length
        closed = []
        if fits:
            bin_ = self._take(length + (fits & -fits).bit_length() - 1)
        else:
            if self.n_open == self.most:
                closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            bin_ = [0, []]
        bin_[1].append((item, bin_[0]))
        bin_[0] += length
        free = self.size - bin_[0]
        if free:
            self.by_free[free].append(bin_)
            self.bits |= 1 << free
            self.n_open += 1
        else:
            closed.append(bin_)
        return closed

    def rest(self) -> list:
        return [bin_ for same in self.by_free for bin_ in same]


def _packed(at: int, size: int, most: int, number: int, last: bool, names: list[str], types: list[pa.DataType]):
    """Rows (column ``at`` is the length) to rows with sequence_id, offset and part; leftovers have null for the first two."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = (number << 58) | (part << 32)

        def rows():
            bins, done = Bins(size, most), 0
            for batch in batches:
                for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    for _, items in bins.put(row, row[at]):
                        for item, offset in items:
                            yield *item, first + done, offset, part
                        done += 1
            for _, items in bins.rest():
                for item, offset in items:
                    yield (*item, first + done, offset, part) if last else (*item, None, None, part)
                done += 1
        yield from record_batches(rows(), [*names, "sequence_id", "offset", "part"], [*types, pa.int64(), pa.int64(), pa.int64()], 8192)
    return run


def pack(items: DataFrame, length: str = "length", size: int = SIZE, most_open: int = OPEN, fan: int = FAN) -> DataFrame:
    """``items`` (small rows with a length of 1 to ``size``) with the sequence they are packed into and their place there."""
    names, types = items.columns, to_arrow_schema(items.schema).types
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema], "sequence_id long, offset long, part long"])
    columns = [*names, "sequence_id", "offset"]

    def one_round(df: DataFrame, number: int, last: bool) -> DataFrame:
        most = fan * most_open if last else most_open
        return stored(df.mapInArrow(_packed(names.index(length), size, most, number, last, names, types), schema), "packed")
    made = one_round(items, 0, False)
    done = made.where("sequence_id IS NOT NULL").select(columns)
    tasks, number = (made.agg(F.max("part")).first()[0] or 0) + 1, 1
    while True:
        tasks = -(-tasks // fan)
        left = made.where("sequence_id IS NULL")
        # dealt out evenly; the same order whenever a task is repeated
        order = [F.xxhash64(*names)] if tasks > 1 else [F.desc(length), F.xxhash64(*names)]
        left = left.select(names).repartition(tasks).sortWithinPartitions(*order)
        made = one_round(left, number, tasks == 1)
        done = done.unionByName(made.where("sequence_id IS NOT NULL").select(columns))
        if tasks == 1:
            return done
        number += 1


def packing_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return pack(pieces(docs, key, text))
