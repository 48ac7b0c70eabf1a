"""The training-data operators against plain versions, and the cases every one must take: nulls, empty and long texts, repeated rows, empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tendril.llm import decontamination, licenses, line_dedup, mixing, ngram_join, personal_data, quality, sharding, suffix_tree, token_counts
from tendril.llm.queries import ORACLES, QUERIES
from tools.check import compare, connect

ROOT = "/root/testdata/sf0.001"
LOW = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start string, word int, node long, key string"
BASE = " ".join(f"word{i} thing{i % 7}" for i in range(60))
ODD = [
    (1, None), (2, ""), (3, "   \n\n "), (4, "one two"), (5, BASE), (5, BASE), (6, BASE), (7, BASE.replace("word30 ", "")), (8, "\n".join([BASE[:200]] * 3)), (None, BASE + " tail"),
    (9, "mail a@b.co or x.y@z-1.org.uk, ip 10.0.0.1 not 300.1.1.1, card 4539 1488 0343 6467, call +1 (319) 555-5132"), (10, "Used under the MIT License under the MIT license; CC-BY-NC"),
    (11, "a" * 200_000), (12, "word " * 40_000), (13, None), (14, "é" * 3 + " ÉCOLE naïve 日本 words"),
]
NAMES = [n for n in QUERIES if n.startswith("op")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None, "s", None, "x", 1, 2, "k") for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{ROOT}/documents.parquet")


def texts(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


def tokens(text):
    return WORD.findall(text.translate(LOW))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    same, why, _ = compare(QUERIES[name](spark, ROOT), ORACLES[name], connect(ROOT))
    assert same, why


REPORTS = {
    "lines": line_dedup.line_report, "licenses": licenses.license_report, "personal": personal_data.personal_data_report, "quality": quality.quality_report, "shards": sharding.shard_report,
    "scores": suffix_tree.score_report, "similar": ngram_join.similarity_report,
}


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_odd_rows_and_empty_tables(odd, name):
    rows = REPORTS[name](odd).collect()
    assert len(rows) == (len({i for i, _ in ODD}) if name == "lines" else len(ODD))
    assert REPORTS[name](odd.limit(0)).count() == 0


def test_odd_rows_of_the_others(spark, odd):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (3, "one two"), (4, BASE)], "item_id long, text string")
    got = decontamination.contamination_report(odd, bench).collect()
    assert len(got) == len(ODD) and {r.doc_id for r in got if r.contaminated} == {4, 5, 6, 7, 8, None}
    assert decontamination.contamination_report(odd, bench.limit(0)).where("contaminated").count() == 0
    labels = spark.createDataFrame([(4, 0, 0), (5, 1, 0), (None, 1, 1), (6, None, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    assert mixing.mixing_report(odd, labels).count() == len(ODD)
    assert mixing.mixing_report(odd, labels.limit(0)).count() == len(ODD)
    assert mixing.mixing_report(odd.limit(0), labels).count() == 0
    histogram = token_counts.length_histogram(odd, ["source", "lang"])
    assert token_counts.context_limits(histogram, ["source", "lang"]).agg(F.max("total_docs")).first()[0] == len(ODD)
    for stage, f in corpus_pipeline.STAGES[:1]:
        assert f(spark, odd, ROOT).columns == odd.columns, stage
    for f in (ngram_join.keep_one, lambda d: decontamination.drop_contaminated(d, bench), lambda d: mixing.draw(d, labels), line_dedup.dedup_lines, personal_data.mask, lambda d: decontamination.remove_spans(d, bench)):
        assert f(odd).columns == odd.columns


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_line_dedup(spark):
    base = ["the quick brown fox jumps", "an entirely different line", "numbers 1 2 3 4 5 6 7 8 9"]
    lines = [x for b in base for x in (b, b[:-1], "x" + b[2:], b[:9] + "zz" + b[11:], b[:4] + "longer by far " + b[4:], b, b[:12] + b[13:])] + ["short", "shore", ""]
    df = spark.createDataFrame([(i, "\n".join(lines[i::4])) for i in range(4)], "doc_id long, text string")
    where = [(i, p, x) for i in range(4) for p, x in enumerate(lines[i::4])]
    near = {x: {y for _, _, y in where if len(y) >= 16 and abs(len(x) - len(y)) <= 2 and edits(x, y) <= 2} for _, _, x in where if len(x) >= 16}
    gone = set()
    for x in near:
        group, todo = {x}, [x]
        while todo:
            new = near[todo.pop()] - group
            group |= new
            todo += new
        gone |= set(sorted((i, p) for i, p, y in where if y in group)[1:])
    got = line_dedup.line_report(df).collect()
    assert {(r.doc_id, x.line) for r in got for x in r.removed} == gone
    pairs = spark.createDataFrame([(a, b) for a in near for b in near], "a string, b string")
    found = pairs.select("a", "b", line_dedup.within_edits(F.split("a", ""), F.split("b", ""), 2).alias("w")).collect()
    assert all(r.w == (edits(r.a, r.b) <= 2) for r in found)


def test_short_exact_copies_go(spark):
    df = spark.createDataFrame([(1, "Read more\n-\n \t\n\nRead more"), (2, "Read mora\n-\n\n \t"), (3, "Read more")], "doc_id long, text string")
    got = {r.doc_id: (r.n_exact, r.n_near, [(x.line, x.kept_doc, x.kept_line) for x in r.removed]) for r in line_dedup.line_report(df).collect()}
    assert got == {1: (1, 0, [(4, 1, 0)]), 2: (1, 0, [(1, 1, 1)]), 3: (1, 0, [(0, 1, 0)])}
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()} == {1: "Read more\n-\n \t\n", 2: "Read mora\n\n \t", 3: ""}


def test_license_base(docs, odd):
    phrases = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
    for df in (docs, odd.where("doc_id in (2, 10, 14)")):
        body = texts(df)
        for r in licenses.license_report(df).collect():
            w = tokens(body[r.doc_id])
            at = [(i, label) for p, label in phrases for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
            assert (r.n_words, r.n_base) == (len(w), len(at))
            assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
            assert r.base_labels == ",".join(sorted({x for _, x in at})) and {x for _, x in at} <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert len(licenses.rules()) > 300


def test_license_notices(spark):
    notices = [
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"), ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
        ("Text: CC-BY-4.0", "cc-by"), ("Photo: Jane Roe, CC BY-SA 4.0, cropped", "cc-by-sa"), ("GPLv3", "gpl-3"), ("Creative Commons Attribution-NoDerivs 3.0 Unported License", "cc-by-nd"),
        ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "bsd"), ("SPDX-License-Identifier: MPL-2.0", "mpl-2"),
        ("(c) Autor, Creative Commons Namensnennung 4.0 International", "cc-by"), ("It follows the gpl of the house, cc by mail, 4 0 in the match", ""),
    ]
    got = {r.doc_id: r.labels for r in licenses.license_report(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(notices)], "doc_id long, text string")).collect()}
    assert got == {i: label for i, (_, label) in enumerate(notices)}


def luhn(x):
    return sum(v - 9 if v > 9 else v for v in (int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(x)))) % 10 == 0


def test_personal_data_base(docs, odd):
    def size(m):
        return len(re.sub("[^0-9]", "", m))

    kinds = {"email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= size(m) <= 19 and luhn(re.sub("[^0-9]", "", m))), "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= size(m) <= 15)}
    for df in (docs, odd.where("doc_id in (2, 9, 14)")):
        body = texts(df)
        for r in personal_data.personal_data_report(df).collect():
            want = [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in kinds.items() for m in re.finditer(p, body[r.doc_id]) if ok(m.group())]
            assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
            assert set(want) <= set(r.spans.split(",")) | {""}


def test_quality_base(docs):
    body = texts(docs)
    for r in quality.quality_report(docs).collect():
        text = body[r.doc_id]
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        times = Counter(windows)
        repeat = len({i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(3)})
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat)
        assert r.base_failed == (len(w) < 50 or 100 * repeat > 50 * len(w)) and not (r.base_failed and r.kept)


def test_quality_agrees_with_labels(spark):
    root = "/root/testdata/sf0.1"
    found = quality.quality_report(spark.read.parquet(f"{root}/documents.parquet")).join(spark.read.parquet(f"{root}/labels.parquet"), "doc_id").where("not base_failed")
    right = found.agg(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.97


def test_token_counts(docs):
    encode = token_counts.encoder(token_counts.VOCABULARY).encode_ordinary
    lengths = [len(encode(t)) for t in texts(docs).values()]
    histogram = token_counts.length_histogram(docs)
    for r in token_counts.context_limits(histogram).collect():
        assert r.docs_longer == sum(x > r.length for x in lengths) and r.tokens_longer == sum(x for x in lengths if x > r.length)
        assert r.truncated_tokens == sum(min(x, r.length) for x in lengths) and r.total_tokens == sum(lengths)
    assert [r.truncated_tokens for r in token_counts.at_limits(histogram, [1, 500]).collect()] == [sum(min(x, n) for x in lengths) for n in (1, 500)]
    long = "some words, and more of them. " * 9000
    assert sum(len(encode(c)) for c in token_counts.chunks(long)) == len(encode(long))


def test_growth_moves_rows_into_the_new_shard_only(docs):
    rows = sharding.shard_report(docs).collect()
    assert all(r.grown_shard in (r.shard, 16) for r in rows) and any(r.grown_shard == 16 for r in rows)
    heavier = sharding.tree(16, weights={3: 4.0})
    moved = sharding.assign(sharding.assign(docs, root=sharding.tree(16)), root=heavier, name="then").where("shard <> then and shard < 8 and then < 8 and (shard > 3 and then > 3)")
    assert moved.count() == 0  # nothing moves within the rack whose weights stayed


def test_base_scores_and_better_than_unigrams(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = suffix_tree.score_report(df).collect()
    body = {k: re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOW)) + ["\n"] for k, t in texts(df).items()}
    counts = Counter(w for k, t in body.items() if zlib.crc32(str(k).encode()) % 5 != 1 for w in t)
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        assert math.isclose(r.base_score, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in body[r.doc_id]), rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(body[r.doc_id]), sum(counts[w] > 0 for w in body[r.doc_id]), n)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_tree_distribution_sums_to_one():
    import numpy as np

    tree = suffix_tree.Tree(suffix_tree.Lookup(np.arange(1, 4, dtype=np.uint64)), np.array([50.0, 30.0, 20.0]), 100, 3, [])
    level = suffix_tree.Level(suffix_tree.Lookup(np.array([0])))
    suffix_tree._add_level(tree, level, np.array([50.0]), suffix_tree._key(np.array([0, 0]), np.array([1, 2])), np.array([40.0, 10.0]), np.array([-1]), 0.0)
    word = np.array([0, 1, 2, -1])
    root = np.concatenate([tree.log_root(tree.counts), tree.log_root(np.zeros(1))])
    p = 10 ** suffix_tree.log_probability(tree, word, [np.zeros(4, np.int64)], root)
    assert math.isclose(p.sum(), 1, rel_tol=1e-6)


def test_ngram_join_loses_no_link(spark):
    import random

    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for family in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(9):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    base = [rng.choice(vocabulary) for _ in range(150)]
    for i in range(90):  # more than a small group holds
        rows.append((len(rows), " ".join(base[:75] + [f"own{i}"] + base[75:])))
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    first = {}
    for i, t in rows:
        first.setdefault(t, i)
    links = defaultdict(set)
    for a in first.values():
        for b in first.values():
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a].add(b)
                links[b].add(a)
    got = {r.doc_id: r for r in ngram_join.similarity_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i].n_links for i in first.values()) >= 0.999 * sum(map(len, links.values()))
    for i, t in rows:
        group, todo = {first[t]}, [first[t]]
        while todo:
            new = links[todo.pop()] - group
            group |= new
            todo += new
        assert got[i].class_id == min(group)
    assert ngram_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).count() == len({r.class_id for r in got.values()})


def test_benchmark_in_blocks_is_the_same(spark, docs):
    bench = spark.read.parquet(f"{ROOT}/benchmark.parquet")
    one, many = (sorted(map(tuple, decontamination.contamination_report(docs, bench, windows_per_block=n).collect())) for n in (500_000, 700))
    assert one == many and any(r[-1] for r in one)


def test_mixing(spark):
    root = "/root/testdata/sf0.1"
    df, labels = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "labels"))
    weights = mixing.train(df, labels.where("doc_id % 4 <> 0"))
    held = mixing.memberships(df, weights, ["doc_id"]).join(labels.where("doc_id % 4 = 0"), "doc_id").withColumn("domain", mixing.domain_of(F.col("quality"), F.col("toxic")))
    best = F.greatest("p_clean", "p_low", "p_toxic")
    right = held.agg(F.avg((F.array("p_clean", "p_low", "p_toxic")[F.col("domain")] == best).cast("int"))).first()[0]
    assert right > 0.85  # three quarters are clean; measured 0.878 here, 0.957 with the 15,000 labelled rows of a larger table
    members = mixing.stored(mixing.memberships(df, weights, ["doc_id"]), "members")
    steps, x = mixing.fit_rates(members)
    assert all(abs(a - b) < 0.02 * max(x["supply"]) for a, b in zip(x["wanted"], x["reached"], strict=True))
    assert members.where(mixing.rate(steps) < 0).count() == 0


def test_pipeline_keeps_columns_and_rows_shrink(spark):
    df = spark.read.parquet(f"{ROOT}/documents.parquet")
    before, names = df.count(), df.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = mixing.stored(stage(spark, df, ROOT), "stage")
        assert df.columns == names, name
        assert df.count() <= before
        before = df.count()
    out = corpus_pipeline.STAGES[-1][1](spark, df, ROOT)
    assert out.count() == before and out.groupBy("shard").agg((F.max("slot") + 1 - F.count("*")).alias("gap")).where("gap <> 0").count() == 0


def test_stages_take_empty_tables(spark, odd):
    bench = spark.createDataFrame([(4, BASE)], "item_id long, text string")
    labels = spark.createDataFrame([(4, 0, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    stages = [quality.keep_good, ngram_join.keep_one, lambda d: decontamination.drop_contaminated(d, bench), lambda d: mixing.draw(d, labels), sharding.shard_report]
    for stage in stages:
        assert stage(odd.limit(0)).count() == 0
    kept = [r.doc_id for r in decontamination.drop_contaminated(odd, bench).collect()]
    assert {1, 2, 3, 13} <= set(kept) and not {5, 6} & set(kept)
    one = Counter(r.doc_id for r in ngram_join.keep_one(odd).collect())
    assert one[5] == 1 and not one[6] and not one[7]
