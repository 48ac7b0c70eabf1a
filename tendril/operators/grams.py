"""N-grams of texts counted and weighed without a row per n-gram before the result.

Texts go by key into blocks of some 262,144 words. A block numbers its words and asks, length by length, for the frequencies of its distinct n-grams:
sorted codes, as differences, go to the part that owns them; the part adds up what all blocks sent and answers in the same order with frequencies and
numbers of the frequent ones. An n-gram is frequent only if the two shorter ones in it are, so the next length is asked for these only, and its code,
(number of the first n-1 words, number of the last word), is exact: there are no hashes to collide. What a block holds and what passes between blocks and
parts is a few bytes an n-gram; results are made within the block, which holds all n-grams of its keys.

A key of more words than a block is spread over several blocks with a tag; the parts count a tag once.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import col, settle

BLOCK_WORDS = 1 << 18
TASK_TEXTS = 1 << 14
PART_WORDS = 1 << 21
ANSWER = "_block long, _tag long, _level int, _part int, _ids binary, _dfs binary, _top long"


def _pack(values) -> bytes:
    """Numbers as compressed planes of bytes: the high ones, mostly alike, take next to nothing."""
    planes = np.ascontiguousarray(np.asarray(values, "<i8").view(np.uint8).reshape(len(values), 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    planes = pa.decompress(blob[8:], 8 * n, "zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).view("<i8").ravel()


def _pack_words(words: list[str]) -> bytes:
    data = " ".join(words).encode()
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpack_words(blob: bytes) -> list[str]:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), "zstd", asbytes=True).decode().split(" ")


def _same(a, b) -> bool:
    return a == b or (a != a and b != b)


def _block(number: int, tag: int | None, rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    keys, texts = zip(*rows)
    sizes = [t.count(" ") + 1 for t in texts]
    coded = pa.array(" ".join(texts).split(" ")).dictionary_encode()
    new = [i == 0 or not _same(k, keys[i - 1]) for i, k in enumerate(keys)]
    held = {
        "_block": [number], "_tag": pa.array([tag], pa.int64()), "_size": [len(coded)], "_keys": pa.array([[k for k, x in zip(keys, new) if x]], pa.list_(kind)),
        "_words": [_pack_words(coded.dictionary.to_pylist())], "_sizes": [_pack(sizes)], "_owners": [_pack(np.cumsum(new) - 1)], "_tokens": [_pack(coded.indices.to_numpy())],
    }
    return pa.RecordBatch.from_pydict(held)


def _blocks(most: int):
    """Rows (key, words), sorted by key, as blocks of whole keys; a key of more than ``most`` words gets tagged blocks of its own."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        held, size, own, tag, kind = [], 0, 0, None, None  # own: where the last key's rows begin
        for batch in batches:
            kind = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                new = not held or not _same(key, held[-1][0])
                if size >= most and not new:
                    if tag is None:
                        if own:
                            yield _block(number, None, held[:own], kind)
                            number += 1
                        tag = number
                    yield _block(number, tag, held[own:], kind)
                    number, held, size, own, last = number + 1, [], 0, 0, key
                elif held and new and (size >= most or tag is not None):
                    yield _block(number, tag, held, kind)
                    number, held, size, own, tag = number + 1, [], 0, 0, None
                elif not held and tag is not None and not _same(key, last):
                    tag = None
                if new and tag is None:
                    own = len(held)
                held.append((key, text))
                size += text.count(" ") + 1
        if held:
            yield _block(number, tag, held, kind)

    return run


def text_blocks(texts: DataFrame, key: str, words: str, rows: int) -> DataFrame:
    """Blocks of the texts, ``rows`` in number; ``words`` holds a text's words with one space between. A text is never cut."""
    kind = texts.schema[key].dataType.simpleString()
    fields = f"_block long, _tag long, _size long, _keys array<{kind}>, _words binary, _sizes binary, _owners binary, _tokens binary"
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // TASK_TEXTS)
    return texts.select(col(key), col(words)).repartition(parts, col(key)).sortWithinPartitions(col(key)).mapInArrow(_blocks(BLOCK_WORDS), fields)


def _dealt(distinct, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the n-grams by part, where each part's begin); within a part they stay in order."""
    if isinstance(distinct, list):
        part = np.fromiter((zlib.crc32(w.encode()) for w in distinct), np.int64, len(distinct)) % parts
    else:
        part = ((distinct.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % parts
    return np.argsort(part, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


def _grams(block: dict, answers: dict[int, list[dict]], parts: int, radix: int, longest: int):
    """By length: (places of n-grams, which distinct one stands there, the distinct ones, their order by part, ids and frequencies or None)."""
    which, distinct = _unpack(block["_tokens"]), _unpack_words(block["_words"])
    at, sizes = np.arange(len(which)), _unpack(block["_sizes"])
    text = np.repeat(np.arange(len(sizes)), sizes)
    for n in range(1, longest + 1):
        order, edges = _dealt(distinct, parts)
        if n not in answers:
            yield at, which, distinct, (order, edges), None
            return
        ids, dfs = np.full(len(distinct), -1), np.zeros(len(distinct), np.int64)
        for x in answers[n]:
            asked, told = order[edges[x["_part"]] : edges[x["_part"] + 1]], _unpack(x["_dfs"])
            dfs[asked] = told
            ids[asked[told > 0]] = np.cumsum(_unpack(x["_ids"])) * parts + x["_part"]
        yield at, which, distinct, (order, edges), (ids, dfs)
        if n == longest:
            return
        here = np.full(len(text), -1)
        here[at] = ids[which]
        if n == 1:
            word = here
        follow = (here[:-1] >= 0) & (here[1:] >= 0)
        at = np.flatnonzero(follow & (text[:-1] == text[1:]) if n == 1 else follow)
        distinct, which = np.unique(here[at] * radix + word[at + n], return_inverse=True)


def _read(table: pa.Table) -> tuple[dict, dict[int, list[dict]]]:
    """A block and the answers it got, by length."""
    rows = table.select([c for c in table.column_names if c != "_keys"]).to_pylist()
    answers: dict[int, list[dict]] = {}
    for r in rows:
        if r["_level"] is not None:
            answers.setdefault(r["_level"], []).append(r)
    return next(r for r in rows if r["_level"] is None), answers


def _asked(parts: int, radix: int, longest: int):
    def run(table):
        block, answers = _read(table)
        for at, which, distinct, (order, edges), found in _grams(block, answers, parts, radix, longest):
            pass
        owners = np.repeat(_unpack(block["_owners"]), _unpack(block["_sizes"]))
        keys = int(owners[-1]) + 1
        counts = np.bincount(np.unique(which * keys + owners[at]) // keys, minlength=len(distinct))
        rows = []
        for part in np.flatnonzero(np.diff(edges)).tolist():
            mine = order[edges[part] : edges[part + 1]]
            codes = _pack_words([distinct[i] for i in mine]) if isinstance(distinct, list) else _pack(np.diff(distinct[mine], prepend=0))
            rows.append((part, block["_block"], block["_tag"], codes, _pack(counts[mine])))
        names, kinds = ("_part", "_block", "_tag", "_codes", "_counts"), (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table({x: pa.array([r[i] for r in rows], t) for i, (x, t) in enumerate(zip(names, kinds))})

    return run


def _answered(level: int, parts: int, min_df: int):
    """Frequencies of a part's n-grams over all blocks, and numbers of the frequent ones, for each block that asked."""

    def run(table):
        rows = table.to_pylist()
        if level == 1:
            asked = [_unpack_words(r["_codes"]) for r in rows]
            which = pa.array([w for x in asked for w in x]).dictionary_encode().indices.to_numpy()
        else:
            asked = [np.cumsum(_unpack(r["_codes"])) for r in rows]
            which = np.unique(np.concatenate(asked), return_inverse=True)[1]
        edges = np.cumsum([0, *map(len, asked)])
        spans, tags = [which[a:b] for a, b in zip(edges, edges[1:])], {}
        dfs = np.zeros(int(which.max()) + 1, np.int64)
        for r, span in zip(rows, spans):
            if r["_tag"] is None:
                dfs[span] += _unpack(r["_counts"])  # distinct within a block
            else:
                tags.setdefault(r["_tag"], []).append(span)
        for some in tags.values():
            dfs[np.unique(np.concatenate(some))] += 1
        often = dfs >= min_df
        rank, dfs = np.cumsum(often) - 1, np.where(often, dfs, 0)
        told = [(_pack(np.diff(rank[s[dfs[s] > 0]], prepend=0)), _pack(dfs[s])) for s in spans]
        n = len(rows)
        made = {"_block": [r["_block"] for r in rows], "_tag": pa.array([r["_tag"] for r in rows], pa.int64()), "_level": pa.array([level] * n, pa.int32()),
                "_part": pa.array([r["_part"] for r in rows], pa.int32()), "_ids": pa.array([a for a, _ in told], pa.binary()), "_dfs": pa.array([b for _, b in told], pa.binary()),
                "_top": [(int(rank[-1]) + 1) * parts] * n}
        return pa.table(made)

    return run


def _weighed(key: str, texts: int, parts: int, radix: int, longest: int):
    """(key, term, weight) of a block's keys; where its keys have other blocks too, (key, term, number, frequency)."""

    def run(table):
        block, answers = _read(table)
        keys = table.filter(pc.is_null(table["_level"]))["_keys"].combine_chunks().flatten()
        owners, tokens = np.repeat(_unpack(block["_owners"]), _unpack(block["_sizes"])), _unpack(block["_tokens"])
        words, n_keys, square, made = pa.array(_unpack_words(block["_words"])), len(keys), np.zeros(len(keys)), []
        for n, (at, which, distinct, _, found) in enumerate(_grams(block, answers, parts, radix, longest), 1):
            if found is None:
                break
            ids, dfs = found
            kept = ids[which] >= 0
            pairs, times = np.unique(which[kept] * n_keys + owners[at[kept]], return_counts=True)
            gram, owner = pairs // n_keys, pairs % n_keys
            first = np.zeros(len(distinct), np.int64)
            first[which[::-1]] = at[::-1]
            often = np.flatnonzero(ids >= 0)
            terms = pc.binary_join_element_wise(*[words.take(pa.array(tokens[first[often] + i])) for i in range(n)], " ")
            weight = (1 + np.log(times)) * (np.log((1 + texts) / (1 + dfs[gram])) + 1)
            square += np.bincount(owner, weights=weight * weight, minlength=n_keys)
            made.append((owner, terms.take(pa.array((np.cumsum(ids >= 0) - 1)[gram])), weight, times, dfs[gram]))
        whole, norm, tables = block["_tag"] is None, np.sqrt(square), []
        for owner, terms, weight, times, df in made:
            fields = {key: keys.take(pa.array(owner)), "term": terms}
            fields |= {"weight": weight / norm[owner]} if whole else {"_tf": pa.array(times, pa.int64()), "_df": pa.array(df, pa.int64())}
            tables.append(pa.table(fields))
        return pa.concat_tables(tables)

    return run


def _by_block(blocks: DataFrame, answers: list[DataFrame], spread: int, which: str = "true"):
    """Blocks next to their answers, dealt evenly whatever their bytes: the work is in what they unpack to."""
    rows = blocks.withColumn("_level", F.lit(None).cast("int"))
    for x in answers:
        rows = rows.unionByName(x.drop("_top"), allowMissingColumns=True)
    return rows.filter(which).repartition(spread, "_block").groupBy("_block")


def gram_weights(blocks: DataFrame, key: str, texts: int, min_df: int, longest: int) -> DataFrame:
    """(key, term, weight): (1 + ln tf) * (ln((1 + texts) / (1 + df)) + 1) of the n-grams that ``min_df`` keys have, scaled to unit length per key."""
    size = blocks.agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("blocks"), F.count("_tag").alias("tagged")).first()
    parts = max(8, (size["words"] or 0) // PART_WORDS)
    spread = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), size["blocks"] // 4)
    answers, radix, top = [], 1, 1
    for level in range(1, longest + 1):
        asked = _by_block(blocks.drop("_keys"), answers, spread).applyInArrow(_asked(parts, radix, longest), "_part int, _block long, _tag long, _codes binary, _counts binary")
        told = asked.repartition(max(spread, parts), "_part").groupBy("_part").applyInArrow(_answered(level, parts, min_df), ANSWER)
        answers.append(settle(told, "answers"))
        top = answers[-1].agg(F.max("_top")).first()[0] or 1
        radix = top if level == 1 else radix
        if level < longest and top * radix >= 1 << 63:
            raise OverflowError(f"{top} n-grams of {level} words and {radix} words: numbers of pairs are beyond 64 bits")
    kind = blocks.schema["_keys"].dataType.elementType.simpleString()
    name = "`" + key.replace("`", "``") + "`"
    weigh = _weighed(key, texts, parts, radix, longest)
    made = _by_block(blocks, answers, spread, "_tag IS NULL").applyInArrow(weigh, f"{name} {kind}, term string, weight double")
    if size["tagged"]:
        cut = _by_block(blocks, answers, spread, "_tag IS NOT NULL").applyInArrow(weigh, f"{name} {kind}, term string, _tf long, _df long")
        summed = cut.groupBy(col(key), "term").agg(F.sum("_tf").alias("_tf"), F.max("_df").alias("_df"))
        raw = settle(summed.select(col(key), "term", ((1 + F.log("_tf")) * (F.log((1 + texts) / (1 + col("_df"))) + 1)).alias("_w")), "weights")
        norms = raw.groupBy(col(key)).agg(F.sqrt(F.sum(col("_w") * col("_w"))).alias("_norm"))
        made = made.unionByName(raw.join(norms, key).select(col(key), "term", (col("_w") / col("_norm")).alias("weight")))
    return made.filter(col(key).isNotNull())
