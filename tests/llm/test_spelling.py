"""Spelling variants against brute force and the SQL, with rows of every odd kind."""

import re
import zlib
from collections import Counter

import pytest

from tendril.llm import spelling as S
from tendril.llm.queries import ORACLES, QUERIES
from tools.check import compare, connect

ROOT = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, word int, n long, gram string, place long, size int"
RUN = re.compile("[a-zÀ-ÿ]+")
LOW = {i: i + 32 for i in range(65, 91)}
WORDS = ["colour", "color", "colours", "colore", "couleur", "abcde", "bcde", "abcd", "abxde", "abcdef", "zzzzz", "zzzzzz", "zzzzzzz", "École", "écolé", "école", "aaaaab", "baaaaa", "tests", "tess", "testss"]
ODD = [(i, f"{w} " * (i % 4 + 1) + f"{w.upper()}, {w}") for i, w in enumerate(WORDS * 3)] + [
    (1, None), (2, ""), (None, "colour color colour colour"), (3, "a" * 100_000), (3, "a" * 100_000), (3, "a" * 100_000), (4, "a" * 99_999 + " b"), (5, "1 2 3 !!"), (6, "colour " * 5000), (7, "naïveté×÷x naïveté×÷y")]


def counts(table):
    n = Counter()
    for doc, text in table:
        for run in RUN.findall((text or "").translate(LOW)):
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[i + 1:] == b[i + 1:] if len(a) == len(b) else len(b) == len(a) + 1 and a[i:] == b[i + 1:])


def expected(table):
    n = counts(table)
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {w: min(near[w], key=lambda v: (-n[v], v)) if near[w] else None for w in n}
    form = {w: f if f and n[f] >= 2 * n[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w
    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def reported(df):
    return {r.word: tuple(r)[1:] for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, 2, "g", 3, 4) for r in ODD], SCHEMA)


def test_odd_rows(odd):
    want = expected(ODD)
    assert len(want) > 15 and any(v[0] for v in want.values())
    assert reported(S.spelling_report(odd)) == want
    assert S.spelling_report(odd.limit(0)).count() == 0


def test_given_tables_and_sql(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    assert reported(S.spelling_report(docs)) == expected([tuple(r) for r in docs.select("doc_id", "text").collect()])
    same, why, _ = compare(QUERIES["op12_spelling_variants"](spark, ROOT), ORACLES["op12_spelling_variants"], connect(ROOT))
    assert same, why


@pytest.mark.parametrize(("longest", "frequent"), [(3, 0), (4, 0), (4, 2), (5, 0), (4, 10**9)])
def test_the_dictionary_never_changes_the_pairs(spark, longest, frequent):
    import random

    draw = random.Random(7)
    words = sorted({"".join(draw.choice("abé") for _ in range(draw.randint(5, 8))) for _ in range(400)})
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    got = {tuple(sorted((r.a, r.b))) for r in S.near_pairs(table, longest, frequent).collect()}
    assert got == {(a, b) for i, a in enumerate(words) for b in words[i + 1:] if one_edit(a, b)}
