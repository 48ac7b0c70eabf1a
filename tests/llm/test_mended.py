"""Rows that share a key or have none, benchmark items without a name, and columns named like the operators' own."""

from tendril.llm import decontamination, line_dedup, sharding

SHARED = "a line that stands in several documents"


def test_rows_of_one_key_keep_their_own_lines(spark):
    rows = [(5, f"first text of its own, kept\n{SHARED}"), (5, f"{SHARED}\nanother text, quite different"), (None, f"{SHARED}\nnull one, all alone here"), (None, f"null two, also alone\n{SHARED}"), (7, None), (8, SHARED), (8, SHARED)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in line_dedup.dedup_lines(docs).collect())
    kept = [t for _, _, t in got]
    for own in ("first text of its own, kept", "another text, quite different", "null one, all alone here", "null two, also alone"):
        assert sum(own in t for t in kept) == 1
    assert len(got) == len(rows) and sum(SHARED in t for t in kept) == 1
    report = line_dedup.line_report(docs)
    # the repeated row counts once; of five different documents with the line, one keeps it
    assert report.count() == 6 and sum(r.n_exact for r in report.collect()) == 4


def test_nameless_items(spark):
    passage = " ".join(f"token{i}" for i in range(14))
    docs = spark.createDataFrame([(1, passage), (2, "nothing of it here")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, passage), (3, passage)], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.contamination_report(docs, bench).collect()}
    assert got[1].n_items == 2 and got[1].n_hit == 14 and got[2].n_items == 0
    only = decontamination.contamination_report(docs, bench.where("item_id = 3")).where("doc_id = 1").first()
    # a null name counts, but has no place in the digest
    assert got[1].items_sha256 == only.items_sha256


def test_own_names_of_the_operators(spark):
    passage = " ".join(f"token{i}" for i in range(14))
    docs = spark.createDataFrame([(1, f"before {passage} after", 8, "x", [1], "t", "i"), (2, "clean words", 9, "y", [2], "u", "j")],
                                 "doc_id long, text string, _words int, _spans string, _items array<int>, _text string, c0 string")
    bench = spark.createDataFrame([(3, passage)], "item_id long, text string")
    kept = decontamination.drop_contaminated(docs, bench).collect()
    assert [tuple(r) for r in kept] == [(2, "clean words", 9, "y", [2], "u", "j")]
    cut = {r.doc_id: r for r in decontamination.remove_spans(docs, bench).collect()}
    assert cut[1].text.split() == ["before", "after"] and cut[1]._text == "t" and cut[1]._words == 8 and cut[2].text == "clean words"


def test_own_names_of_sharding(spark):
    docs = spark.createDataFrame([(1, "a", 5, "n", "c"), (None, "b", 6, "m", "d")], "doc_id long, text string, _key int, _above string, _node string")
    got = sorted((tuple(r) for r in sharding.assign(docs).collect()), key=str)
    plain = {r.doc_id: r.shard for r in sharding.assign(docs.select("doc_id")).collect()}
    assert got == sorted(((1, "a", 5, "n", "c", plain[1]), (None, "b", 6, "m", "d", plain[None])), key=str)
    assert sharding.assign(docs, name="_key").columns == ["doc_id", "text", "_above", "_node", "_key"]
