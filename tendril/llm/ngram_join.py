"""N-gram Jaccard join: texts whose sets of five-word shingles have a similarity of 0.8 or more, by a MinHash LSH forest.

Every tree of the forest is a prefix trie over one signature string per text: the texts in the order of their prefixes, so
texts below one trie node stand together. Matching starts at full depth; the matched prefix is shortened level by level
until a pair at the threshold is found with the target recall (1 - (1 - s^depth)^trees), and no further. Candidates are
verified exactly.

Copies are grouped first, so the forest holds different texts only. The texts below one trie node are worked off in blocks
against blocks, as matrices: no row is ever made per pair. A pair belongs to the first tree in which it meets; before any
shingles are shipped, a pass over the prefixes alone finds who has such a pair where, so shingles travel to few places.
What comes out per text is its number of links and enough edges to connect its class.

Words are lower-case (A-Z) runs of letters, digits and everything beyond ASCII. A text of one to four words is one shingle;
null, empty and wordless texts have none and are linked to nothing but exact copies. Documents with null keys belong to
classes like others; the class is named after the smallest key in it (null if there is none). Repeated rows are copies.
Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored
from .words import FOLD, LETTERS, distinct, grams, mix, words

SHINGLE = 5
THRESHOLD = 0.8
TREES = 20
DEPTH = 8
TARGET_RECALL = 0.9999
BLOCK_TEXTS = 1024
BLOCK_SHINGLES = 2_000_000
SMALL = 48
BATCH_SHINGLES = 1_000_000


def matched_depth(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, target: float = TARGET_RECALL) -> int:
    """Shorten the matched prefix from full depth until a pair at the threshold is found with the target recall."""
    while depth > 1 and 1 - (1 - threshold ** depth) ** trees < target:
        depth -= 1
    return depth


def shingles(column: pa.Array, n: int = SHINGLE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, distinct shingles, bounds of texts among them), slice by slice."""
    for w in words(column, LETTERS, FOLD):
        g, bounds = grams(w.hashes(), w.offsets, n)
        values, _, bounds = distinct(g, bounds)
        yield w.first, values, bounds


def _signatures(trees: int, depth: int, n: int):
    salt = mix(np.arange(1, 2 * trees * depth + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    multiply, add = salt[::2] | np.uint64(1), salt[1::2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = np.zeros((len(batch), trees), np.uint64)
            counts = np.zeros(len(batch), np.int64)
            for first, values, bounds in shingles(batch.column(2), n):
                some = np.flatnonzero(np.diff(bounds))
                if not len(some):
                    continue
                counts[first : first + len(bounds) - 1] = np.diff(bounds)
                at = bounds[some]
                for t in range(trees):
                    string = np.full(len(some), t + 1, np.uint64)
                    for k in range(t * depth, (t + 1) * depth):
                        h = values * multiply[k] + add[k]
                        h ^= h >> np.uint64(32)
                        string = mix(string * np.uint64(0x9FB21C651E98DF25) + np.minimum.reduceat(h, at))
                    prefix[first + some, t] = string
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts), pa.array([r.tobytes() for r in prefix], pa.binary())], ["key", "digest", "n_shingles", "prefixes"])
    return run


def _pairs_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within consecutive runs of rows of the given (small) sizes."""
    start, left, right = np.cumsum(sizes) - sizes, [], []
    for n in np.unique(sizes[sizes > 1]):
        i, j = np.triu_indices(n, 1)
        at = start[sizes == n][:, None]
        left.append((at + i).ravel())
        right.append((at + j).ravel())
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _owned(prefix: np.ndarray, left: np.ndarray, right: np.ndarray, tree: np.ndarray) -> np.ndarray:
    """Whether the tree at hand is the first in which each pair meets."""
    out = np.ones(len(left), bool)
    for t in range(int(tree.max(initial=0))):
        out &= (prefix[left, t] != prefix[right, t]) | (tree <= t)
    return out


def _by_group(batches: Iterator[pa.RecordBatch], cost: Callable[[pa.RecordBatch], np.ndarray], most: float) -> Iterator[pa.Table]:
    """Whole groups of equal (bucket, i, j) from rows that come in that order; small groups together up to a total cost."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        if sum(float(cost(b).sum()) for b in held) < most:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        key = _group_marks(table)
        last = int(np.flatnonzero(key)[-1])  # the last group may go on
        if last:
            yield table.slice(0, last)
            held = table.slice(last).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _group_marks(table: pa.Table) -> np.ndarray:
    """True where a new (bucket, i, j) begins."""
    out = np.zeros(len(table), bool)
    out[:1] = True
    for c in ("bucket", "i", "j"):
        v = table[c].to_numpy()
        out[1:] |= v[1:] != v[:-1]
    return out


def _prefix_matrix(table: pa.Table, trees: int) -> np.ndarray:
    return np.frombuffer(b"".join(table["prefixes"].to_pylist()), np.uint64).reshape(len(table), trees)


def _groups(table: pa.Table, most: int = SMALL):
    """(rows of small groups with their sizes, list of (from, to) of large ones)."""
    start = np.flatnonzero(_group_marks(table))
    size = np.diff(np.append(start, len(table)))
    small = size <= most
    rows = np.repeat(start[small], size[small]) + np.arange(size[small].sum()) - np.repeat(np.cumsum(size[small]) - size[small], size[small])
    return rows, size[small], [(int(a), int(a + n)) for a, n in zip(start[~small], size[~small], strict=True)]


def _small_pairs(table: pa.Table, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within small groups; where two blocks meet, only pairs across them."""
    left, right = (rows[x] for x in _pairs_of(sizes))
    block, alone = table["block"].to_numpy(), table["i"].to_numpy() == table["j"].to_numpy()
    ok = alone[left] | (block[left] != block[right])
    return left[ok], right[ok]


def _sides(block: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    return np.flatnonzero(block == i), np.flatnonzero(block == j)


def _block_owned(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, tree: int, same: bool) -> np.ndarray:
    out = np.ones((len(a), len(b)), bool)
    for t in range(tree):
        out &= prefix[a, t][:, None] != prefix[b, t][None, :]
    if same:
        out &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
    return out


def _who_meets(trees: int):
    """Rows that have a pair of their own in this group: (node, bucket, tree, block, i, j)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_group(batches, lambda b: np.ones(len(b)), 20_000):
            prefix, tree = _prefix_matrix(table, trees), table["tree"].to_numpy()
            meets = np.zeros(len(table), bool)
            rows, sizes, large = _groups(table)
            left, right = _small_pairs(table, rows, sizes)
            own = _owned(prefix, left, right, tree[left])
            meets[left[own]] = True
            meets[right[own]] = True
            for at, to in large:
                block, i, j = table["block"].to_numpy()[at:to], table["i"][at].as_py(), table["j"][at].as_py()
                a, b = _sides(block, i, j)
                own = _block_owned(prefix[at:to], a, b, int(tree[at]), i == j)
                meets[at + a[own.any(1)]] = True
                meets[at + b[own.any(0)]] = True
            yield from table.filter(pa.array(meets)).select(["node", "bucket", "tree", "block", "i", "j"]).to_batches()
    return run


class _Links:
    """Counts links and keeps a spanning forest of them."""

    def __init__(self, n: int):
        self.count, self.root = np.zeros(n, np.int64), np.arange(n)

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return int(x)

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        self.count += np.bincount(left, minlength=len(self.count)) + np.bincount(right, minlength=len(self.count))
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            a, b = self.find(a), self.find(b)
            if a != b:
                self.root[max(a, b)] = min(a, b)

    def add_matrix(self, link: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.count, a, link.sum(1))
        np.add.at(self.count, b, link.sum(0))
        rows, columns = (np.array([self.find(int(x)) for x in side]) for side in (a, b))
        far = len(self.root)
        low_rows, low_columns = rows, columns
        while True:  # labels flow along links until each part of the graph has one
            r = np.minimum(low_rows, np.where(link, low_columns[None, :], far).min(1))
            c = np.minimum(low_columns, np.where(link, r[:, None], far).min(0))
            if (r == low_rows).all() and (c == low_columns).all():
                break
            low_rows, low_columns = r, c
        for x, low in zip([*rows, *columns], [*low_rows, *low_columns], strict=True):
            x, low = self.find(int(x)), self.find(int(low))
            if x != low:
                self.root[max(x, low)] = min(x, low)


def _common_of_pairs(values: np.ndarray, bounds: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of common shingles of each pair of rows."""
    _, code = np.unique(values, return_inverse=True)
    width = int(code.max(initial=0)) + 1
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    composite = owner * width + code  # sorted: rows in order, shingles sorted within a row
    out = np.zeros(len(left), np.int64)
    size = np.diff(bounds)
    for at, to in _steps(size[left]):
        l, r = left[at:to], right[at:to]
        n = size[l]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        query = np.repeat(r, n) * width + code[np.repeat(bounds[l], n) + inside]
        place = np.minimum(np.searchsorted(composite, query), len(composite) - 1)
        out[at:to] = np.add.reduceat((composite[place] == query).astype(np.int64), np.cumsum(n) - n)
    return out


def _steps(cost: np.ndarray, most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    total, at = np.concatenate([[0], np.cumsum(cost)]), 0
    while at < len(cost):
        to = max(at + 1, int(np.searchsorted(total, total[at] + most, "right")) - 1)
        yield at, to
        at = to


def _common_matrix(values: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of common shingles of every row of a with every row of b: a product of 0/1 matrices over shared shingles."""
    def of(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.diff(bounds)[rows]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(np.arange(len(rows)), n), values[np.repeat(bounds[rows], n) + inside]

    (row_a, x), (row_b, y) = of(a), of(b)
    shared = np.intersect1d(x, y)
    out = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, len(shared), 4096):
        part = shared[at : at + 4096]
        sides = []
        for rows, v, n in ((row_a, x, len(a)), (row_b, y, len(b))):
            place = np.minimum(np.searchsorted(part, v), len(part) - 1)
            ok = part[place] == v
            m = np.zeros((n, len(part)), np.float32)
            m[rows[ok], place[ok]] = 1
            sides.append(m)
        out += sides[0] @ sides[1].T
    return out


def _verify(trees: int, threshold: float):
    """Per group: (node, number of links to others, root of the node within the group)."""
    def similar(common: np.ndarray, total: np.ndarray) -> np.ndarray:
        return common >= threshold * (total - common) - 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cost(b: pa.RecordBatch) -> np.ndarray:
            return b.column(b.schema.get_field_index("n_shingles")).to_numpy()

        for table in _by_group(batches, cost, BATCH_SHINGLES):
            prefix, tree, node, size = _prefix_matrix(table, trees), table["tree"].to_numpy(), table["node"].to_numpy(), table["n_shingles"].to_numpy()
            values = np.frombuffer(b"".join(table["shingles"].to_pylist()), np.uint64)
            bounds = np.concatenate([[0], np.cumsum(size)])
            links = _Links(len(table))
            rows, sizes, large = _groups(table)
            left, right = _small_pairs(table, rows, sizes)
            # a pair can't reach the threshold if one has far fewer shingles
            close = np.minimum(size[left], size[right]) >= threshold * np.maximum(size[left], size[right]) - 1e-9
            left, right = left[close], right[close]
            own = _owned(prefix, left, right, tree[left])
            left, right = left[own], right[own]
            if len(left):
                ok = similar(_common_of_pairs(values, bounds, left, right), size[left] + size[right])
                links.add(left[ok], right[ok])
            for at, to in large:
                block, i, j = table["block"].to_numpy()[at:to], table["i"][at].as_py(), table["j"][at].as_py()
                a, b = _sides(block, i, j)
                own = _block_owned(prefix[at:to], a, b, int(tree[at]), i == j)
                if own.any():
                    common = _common_matrix(values, bounds, at + a, at + b)
                    links.add_matrix(own & similar(common, size[at + a][:, None] + size[at + b][None, :]), at + a, at + b)
            some = np.flatnonzero(links.count)
            roots = np.array([links.find(int(x)) for x in some], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links.count[some]), pa.array(node[roots] if len(some) else node[:0])], ["node", "n_links", "root"])
    return run


def _pack(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, values, bounds in shingles(batch.column(1), n):
                rows = range(len(bounds) - 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(bounds) - 1), pa.array([values[bounds[r] : bounds[r + 1]].tobytes() for r in rows], pa.binary())], ["node", "shingles"])
    return run


def similar_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE, threshold: float = THRESHOLD, trees: int = TREES,
                  target_recall: float = TARGET_RECALL) -> tuple[DataFrame, DataFrame]:
    """(copies, texts): each document's key with the digest of its text; each different text (digest, smallest key, number of
    copies) with its number of links to other texts, and the smallest key of its class."""
    depth = matched_depth(threshold, trees, DEPTH, target_recall)
    read = docs.select(F.col(key).alias("key"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    key_type = read.schema["key"].dataType.simpleString()
    signed = stored(read.mapInArrow(_signatures(trees, depth, n), f"key {key_type}, digest string, n_shingles long, prefixes binary"), "signatures")
    texts = signed.groupBy("digest").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n_shingles"), F.max("prefixes").alias("prefixes"))
    texts = stored(texts.withColumn("node", F.monotonically_increasing_id()), "texts")

    strings = texts.where("n_shingles > 0").select("node", "n_shingles", F.posexplode(F.array(*[F.xxhash64(F.lit(t), F.substring("prefixes", 8 * t + 1, 8)) for t in range(trees)])).alias("tree", "bucket"))
    below = strings.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total")).where("n > 1")
    parts = F.when(F.col("n") <= SMALL, 1).otherwise(F.ceil(F.greatest(F.col("n") / BLOCK_TEXTS, F.col("total") / BLOCK_SHINGLES))).cast("int")
    placed = strings.join(below.select("bucket", parts.alias("parts")), "bucket").select("node", "tree", "bucket", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("block"), F.sequence(F.lit(0), F.col("parts") - 1).alias("others"))
    met = placed.select("node", "tree", "bucket", "block", F.explode("others").alias("other")).select("node", "tree", "bucket", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    met = met.join(texts.select("node", "prefixes"), "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    own = stored(met.mapInArrow(_who_meets(trees), "node long, bucket long, tree int, block int, i int, j int"), "meets")

    # shingles of those who have a pair somewhere, made again from their texts: one copy of each text
    wanted = own.select("node").distinct().join(texts.select("node", "digest", F.col("key").alias("first_key"), "n_shingles", "prefixes"), "node")
    bodies = read.join(wanted.select("digest", "node", "first_key"), "digest").where(F.col("key").eqNullSafe(F.col("first_key")))
    shingled = bodies.select("digest", "node", "text").dropDuplicates(["digest"]).select("node", "text").mapInArrow(_pack(n), "node long, shingles binary")
    shipped = own.join(shingled, "node").join(wanted.select("node", "n_shingles", "prefixes"), "node")
    shipped = shipped.select("node", "bucket", "tree", "block", "i", "j", "n_shingles", "prefixes", "shingles").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    verified = stored(shipped.mapInArrow(_verify(trees, threshold), "node long, n_links long, root long"), "verified")

    links = verified.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    classes = components(verified.select("node", "root"), "node", "root").withColumnRenamed("node", "member")
    joined = texts.join(links, "node", "left").join(classes, texts["node"] == classes["member"], "left")
    joined = joined.select("digest", "key", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", texts["node"]).alias("root"))
    joined = stored(joined, "classes")
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "digest")).alias("first")
    named = joined.groupBy("root").agg(first, F.count(F.lit(1)).alias("class_texts"), F.sum("copies").alias("class_docs"))
    return signed.select("key", "digest"), joined.join(named, "root").select(
        "digest", "key", "copies", "n_links", F.col("first.key").alias("class_id"), (F.col("digest") == F.col("first.digest")).alias("first_of_class"), "class_texts", "class_docs")


def similarity_report(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: its class (the smallest key in it), the number of different texts its own is linked to, and the sizes of class and copies."""
    copies, texts = similar_texts(docs, key, text, **options)
    return copies.join(texts.withColumnRenamed("key", "first_copy"), "digest").select(F.col("key").alias(key), "class_id", "n_links", "first_copy", "copies", "class_texts", "class_docs")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest key, and of rows with equal keys one."""
    names = docs.columns
    copies, texts = similar_texts(docs, key, text, **options)
    kept = texts.where("first_of_class").select("digest", F.col("key").alias("kept_key"))
    safe = docs.toDF(*[f"d{i}" for i in range(len(names))])
    k, t = f"d{names.index(key)}", f"d{names.index(text)}"
    joined = safe.join(kept, F.md5(F.coalesce(F.col(t), F.lit(""))) == F.col("digest")).where(F.col(k).eqNullSafe(F.col("kept_key")))
    return joined.dropDuplicates([k, "digest"]).select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(names)])
