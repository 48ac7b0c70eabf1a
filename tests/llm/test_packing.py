"""Packing: every id once, in place, few sequences; bins against a plain best-fit."""

import math
import random
import struct
import zlib
from collections import defaultdict
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from tendril.llm import packing as P

ROOT = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, key string, part int, length string, sequence_id long, offset int"
ODD = [(1, None), (2, ""), (2, "  \n "), (3, "One two, three's 12345."), (3, "One two, three's 12345."), (None, "no key"), (4, "word " * 30_000), (5, "é日本 naïve ÉCOLÉ"), (6, "x" * 70_000), (7, "<|endoftext|> text <|startoftext|>")]


@cache
def coder():
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    made.encode_special_tokens = True
    return made


def ids(text):
    return [*coder().encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, table):
    want = sorted(((d is None, d or 0), i, s, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for d, t in table for x in [ids(t)]
                  for i, s in enumerate(range(0, len(x), 2048)) for p in [x[s:s + 2048]])
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), math.ceil(sum(x[3] for x in want) / 2048)


def test_odd_rows(spark):
    odd = spark.createDataFrame([(*r, "k", 1, "l", 2, 3) for r in ODD], SCHEMA)
    check(P.packing_report(odd).collect(), ODD)
    assert P.packing_report(odd.limit(0)).count() == 0


def test_words_give_the_ids_of_the_text():
    spaces = [c for c in map(chr, range(0x10000)) if c.isspace() or P.SPACE.match(c) or ord(c) in (0, 8, 14, 27, 0x180e, 0x200b, 0xfeff)]
    texts = [f"It's{c}one{c}{c}\u0301e's {c}'re 12 Σας İX don't<|endoftext|>{c}" for c in spaces] + ["a\x1cb\u2000c", "日本 語", "e\u0301 \u0308a"]
    own = P.Encoder(P.vocabulary_path())
    for t in texts:
        assert list(struct.unpack(f"<{len(own.text(t)) // 4}I", own.text(t))) == ids(t)[:-1], repr(t)
    letters = [chr(c) for c in range(0x21, 0x250) if not chr(c).isspace()]
    for c in letters:
        word = f"x{c}Y'{c}S {c}{c}'re1{c}2 {c}"
        assert list(struct.unpack(f"<{len(own.text(word)) // 4}I", own.text(word))) == ids(word)[:-1], repr(word)
    small = P.Encoder(P.vocabulary_path())
    P_KEPT, P.KEPT = P.KEPT, 3
    try:
        assert small.text("one two three four five one " * 3) == own.text("one two three four five one " * 3) and len(small) <= 3
    finally:
        P.KEPT = P_KEPT


def test_given_table(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    n, least = check(P.packing_report(docs).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert n <= least * 1.02 + 1


@pytest.mark.parametrize("most", [1, 3, 50])
def test_bins_against_plain_best_fit(most):
    draw = random.Random(most)
    bins, plain, closed, want = P.Bins(100, most), [], [], []
    for i in range(3000):
        size = draw.choice((1, 7, 30, 55, 100, draw.randint(1, 100)))
        closed += [used for used, _ in bins.put(i, size)]
        fits = [b for b in plain if b + size <= 100]
        if fits:
            plain.remove(max(fits))
            plain.append(max(fits) + size)
        else:
            if len(plain) == most:
                want.append(max(plain))
                plain.remove(max(plain))
            plain.append(size)
        if plain[-1] == 100:
            want.append(plain.pop())
        assert bins.n_open == len(plain) <= most
    assert closed == want and sorted(b[0] for b in bins.rest()) == sorted(plain)


def test_rounds_keep_all_items(spark):
    items = spark.range(0, 5000, 1, 40).select("id", (F.abs(F.hash("id")) % 64 + 1).cast("long").alias("length"))
    got = P.pack(items, size=64, most_open=4, fan=3)
    assert got.count() == 5000 and got.select("id").distinct().count() == 5000
    used = got.groupBy("sequence_id").agg(F.sum("length").alias("s"), F.max(F.col("offset") + F.col("length")).alias("e"))
    assert used.where("s <> e OR s > 64").count() == 0
