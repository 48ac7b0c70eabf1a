"""TF-IDF in blocks of texts, against one row per term and text."""

import math
import random
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from tendril.operators import grams
from tendril.operators import text as tx
from tendril.plans import load_all
from tendril.plans.registry import QUERIES
from tendril.session import scratch_root


def plain(rows, min_df, longest):
    """(key, term): weight; a null key is a text for the frequencies and has no weights."""
    tf = defaultdict(Counter)
    for key, text in rows:
        w = (text or "").split()
        tf[key].update(" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    df = Counter(t for c in tf.values() for t in c)
    out = {}
    for key, c in tf.items():
        raw = {t: (1 + math.log(x)) * (math.log((1 + len(rows)) / (1 + df[t])) + 1) for t, x in c.items() if df[t] >= min_df}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        out |= {(key, t): w / norm for t, w in raw.items() if key is not None}
    return out


def texts(seed, n_keys, words=14, most=40):
    draw = random.Random(seed)
    some = lambda: " ".join(f"w{int(words * draw.random() ** 2)}" for _ in range(draw.randrange(most)))
    rows = [(k, some()) for k in range(n_keys)] + [(draw.randrange(n_keys), some()) for _ in range(n_keys // 2)]
    return rows + [(None, some()) for _ in range(5)] + [(0, None), (n_keys, ""), (n_keys + 1, None), *rows[:3]]


@pytest.mark.parametrize("block, part, longest, min_df", [(1 << 18, 1 << 21, 3, 4), (60, 50, 3, 3), (60, 50, 4, 1), (200, 1000, 1, 2), (3, 1 << 21, 2, 2)])
def test_blocks_and_parts_of_any_size_give_the_plain_weights(spark, monkeypatch, block, part, longest, min_df):
    monkeypatch.setattr(grams, "BLOCK_WORDS", block)
    monkeypatch.setattr(grams, "PART_WORDS", part)
    rows = texts(block, 40)
    rows += [(7, t) for _, t in texts(block + 1, 30)] + [(None, t) for _, t in texts(block + 2, 10)]  # more than a block of one key, and of none
    out = tx.tf_idf(spark.createDataFrame(rows, "k int, text string"), "k", "text", min_df=min_df, longest=longest)
    assert out.dtypes == [("k", "int"), ("term", "string"), ("weight", "double")]
    found, want = out.collect(), plain(rows, min_df, longest)
    assert len(found) == len(want) and {(r.k, r.term) for r in found} == set(want)
    assert all(math.isclose(r.weight, want[r.k, r.term], rel_tol=1e-9) for r in found)


def test_no_texts_and_no_frequent_terms_give_no_rows(spark):
    for rows in ([], [("a", None)], [("a", "one two"), ("b", "three")]):
        assert tx.tf_idf(spark.createDataFrame(rows, "k string, text string"), "k", "text", min_df=2).collect() == []


def test_terms_take_less_disk_than_their_texts(spark):
    rows = [(k, t) for k, t in texts(5, 300, 400, 900) if k is not None]
    scratch = Path(scratch_root(spark).removeprefix("file:"))
    stored = lambda: {f: f.stat().st_size for f in scratch.rglob("*.parquet")}
    before = stored()
    out = tx.tf_idf(spark.createDataFrame(rows, "k int, text string"), "k", "text", min_df=2)
    assert out.count() > 100_000
    assert sum(size for f, size in stored().items() if f not in before) < sum(len(t or "") for _, t in rows)


def test_shape_makes_the_features_once(spark):
    rows = texts(6, 60)
    features = tx.tf_idf(spark.createDataFrame(rows, "k int, text string"), "k", "text", min_df=3)
    out, want = tx.shape(features, "k"), plain(rows, 3, 3)
    assert out.dtypes == [("n_texts", "bigint"), ("n_terms", "bigint"), ("n_weights", "bigint")]
    assert out.first() == (len({k for k, _ in want}), len({t for _, t in want}), len(want))
    made = out._jdf.queryExecution().optimizedPlan().toString()
    assert made.count("FlatMapGroupsInArrow") == 1


def test_vocabulary_query_is_whole_and_takes_less_disk_than_its_texts(spark, tmp_path):
    load_all()
    english = [(k, t) for k, t in texts(8, 260, 300, 500) if k is not None]
    docs = [(str(k), t, "en") for k, t in english] + [(f"x{k}", t, "de") for k, t in english[:50]]
    spark.createDataFrame(docs, "doc_id string, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    stored = lambda: {f: f.stat().st_size for f in Path(scratch_root(spark).removeprefix("file:")).rglob("*.parquet")}
    before = stored()
    found = [r.term for r in QUERIES["a75_vocabulary"](spark, str(tmp_path)).collect()]
    assert len(found) == len(set(found)) and set(found) == {t for _, t in plain(english, 20, 3)}
    assert any(t.count(" ") == 2 for t in found)
    assert sum(size for f, size in stored().items() if f not in before) < sum(len(t or "") for _, t in english)
