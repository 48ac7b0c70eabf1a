"""The distributed suffix tree against one held in dictionaries, with and without what is broadcast."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tendril.llm import suffix_tree

LOW = {i: i + 32 for i in range(65, 91)}


def plain(rows, depth=2, least=3, divergence=0.02, discount=0.5):
    """Score of each text, by a tree of all n-grams in memory."""
    bodies = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) + ["\n"] for _, t in rows]
    held = [zlib.crc32(("" if k is None else str(k)).encode()) % 5 == 1 for k, _ in rows]
    counts = Counter(tuple(b[i : i + n]) for b, h in zip(bodies, held, strict=True) if not h for n in range(1, depth + 2) for i in range(len(b) - n + 1))
    ones = {g: n for g, n in counts.items() if len(g) == 1}
    tokens, distinct = sum(ones.values()), len(ones)
    states = {}

    def log_p(context, word):
        rest = 0.0
        for k in range(len(context)):
            listed, log_rest = states.get(context[k:], (None, 0.0))
            if listed and word in listed:
                return rest + math.log10(listed[word])
            rest += log_rest
        return rest + math.log10((counts[(word,)] + 0.5) / (tokens + 0.5 * (distinct + 1)))

    for n in range(1, depth + 1):
        found = defaultdict(dict)
        for g, c in counts.items():
            if len(g) == n + 1 and c >= least:
                found[g[:-1]][g[-1]] = (c - discount) / counts[g[:-1]]
        new = {}
        for context, p in found.items():
            q = {w: 10 ** log_p(context[1:], w) for w in p}
            rest_p, rest_q = max(1 - sum(p.values()), 1e-9), max(1 - sum(q.values()), 1e-9)
            if sum(x * math.log(x / q[w]) for w, x in p.items()) + rest_p * math.log(rest_p / rest_q) >= divergence:
                new[context] = p, math.log10(rest_p / rest_q)
        states |= new
    return [sum(log_p(tuple(b[max(0, i - depth) : i]), w) for i, w in enumerate(b)) for b in bodies], states


def corpus():
    """Few frequent words, and phrases of rare ones that come back three to nine times: far below a ten-thousandth of the tokens."""
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(rng.randint(0, 300)))) for i in range(300)]
    for i in range(120):
        phrase = f"Rare{i} Phrase{i % 40} number{i} ends"
        rows += [(1000 + 10 * i + k, phrase if k % 2 else f"w1 {phrase} w2") for k in range(3 + i % 7)]
    return [*rows, (None, None), (None, "rare1 phrase1"), (7, ""), (8, "unseen words\x0bonly"), (9, "é É 日本 " * 50), *rows[:20]]


@pytest.mark.parametrize(("options", "depth"), [({}, 2), ({"hot_count": 1 << 40}, 2), ({"hot_count": 1}, 2), ({"hot_count": 40, "max_depth": 3}, 3)])
def test_scores_equal_a_tree_of_all_ngrams(spark, options, depth):
    rows = corpus()
    wanted, states = plain(rows, depth)
    assert sum(len(c) == 2 for c in states) > 200
    got = suffix_tree.score_report(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()
    values = lambda pairs: sorted((-1 if k is None else k, round(x, 6)) for k, x in pairs)
    assert values((r.doc_id, r.score) for r in got) == values((k, x) for (k, _), x in zip(rows, wanted, strict=True))


def test_a_context_is_kept_however_large_the_corpus(spark):
    """Contexts of three occurrences among 60,000 tokens are below the ten-thousandth that once was asked for."""
    rows = [(i, " ".join(f"w{(i * 37 + j * j) % 5000}" for j in range(200))) for i in range(300)]
    rare = [k for k in range(1000, 1100) if zlib.crc32(str(k).encode()) % 5 != 1][:4]
    rows += [(k, "seldom seen pair") for k in rare]
    got = {r.doc_id: r.score - r.base_score for r in suffix_tree.score_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k] > 8 for k in rare)


def test_large_numbers_of_words_keep_their_keys_apart():
    rng = np.random.default_rng(3)
    small, hashed = rng.integers(1, 1 << 21, 100_000), rng.integers(-(1 << 63), 0, 100_000)
    word = np.concatenate([small, hashed])
    pair = suffix_tree.extended(rng.permutation(word), word)
    triple = suffix_tree.extended(pair, rng.permutation(word))
    assert len(np.unique(np.concatenate([word, pair, triple]))) == sum(len(np.unique(x)) for x in (word, pair, triple))
    assert (suffix_tree.extended(np.zeros(len(word), np.int64), word) == word).all()


def test_the_bitmap_knows_all_keys(spark):
    keys = np.random.default_rng(4).integers(-(1 << 63), (1 << 63) - 1, 5000)
    table = spark.createDataFrame([(int(k),) for k in keys], "key long")
    for bits in (28, 15):
        bitmap = suffix_tree._bitmap(table, bits)
        assert bitmap.find(keys).all()
    other = np.random.default_rng(5).integers(-(1 << 63), (1 << 63) - 1, 5000)
    assert suffix_tree._bitmap(table).find(other).mean() < 0.1
    assert suffix_tree._bitmap(table.limit(0)) is None


def test_no_more_than_a_bound_is_broadcast(spark):
    table = spark.createDataFrame([(n,) for n in (1, 2, 2, 5, 5, 5, 9)], "n long")
    assert [suffix_tree._cut(table, 1, most) for most in (0, 1, 3, 4, 6, 7)] == [10, 6, 6, 3, 2, 1]


def test_counting_holds_neither_a_large_batch_nor_a_table_before_the_shuffle(spark):
    rows = 3 * suffix_tree.ROWS_AT_ONCE
    texts = pa.RecordBatch.from_arrays([pa.array([" ".join(f"w{i}" for i in range(k, rows, 100)) for k in range(100)] * 2)], ["text"])
    got = list(suffix_tree._count_words(iter([texts])))
    assert max(b.num_rows for b in got) <= suffix_tree.ROWS_AT_ONCE
    words = pa.Table.from_batches(got)
    assert len(set(words["word"].to_pylist())) == words.num_rows == rows + 1
    assert Counter(words["n"].to_pylist()) == {2: rows, 200: 1}

    read = spark.createDataFrame([("a b a b",), ("a b",)], "text string")
    tokens = [suffix_tree.with_ends(w)[0] for w in suffix_tree.words(pa.array(["a b"]), suffix_tree.VISIBLE, suffix_tree.FOLD)][0]
    codes = spark.createDataFrame([(k,) for k in (1, 2, 3)], "key long")
    counted = suffix_tree._gram_counts(read, (suffix_tree.Lookup(tokens), suffix_tree._bitmap(codes)), 1)
    assert sorted(map(tuple, counted.collect())) == [(1, 2, 3), (2, 1, 1), (2, 3, 2)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "Aggregate" not in plan[plan.rindex("Exchange hashpartitioning"):]
