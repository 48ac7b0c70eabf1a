"""Words that differ by one edit, grouped under their more frequent spelling, by an index of variable-length grams.

Dictionary: at least two characters, and a gram is lengthened while more than ``FREQUENT`` places hold it, up to ``LONGEST``
characters. As no gram is more frequent than its beginning, the gram that starts at a place is settled by the frequent grams
among its beginnings; the dictionary is thus kept as the table of frequent grams. A word (between two marks) decomposes into the
gram of each place. Which gram stands at a place depends on the characters of that gram alone, so one edit affects exactly the
grams whose span it meets.

Merging: of two grams of a word whose spans don't meet, one edit affects at most one; every near word therefore has the other,
at the same place or moved by one. Each word picks the pair with the shortest lists and looks only these up, among words of its
own length and one less. In very long words only the first and last ``EDGE`` places are looked at: any two spans that don't meet
will do, and near words have each other's places among their own. A word of five characters or more always has such a pair (the grams at the first and the fifth place).
What the two lists give is verified by edit distance before it becomes a row.

Null texts have no words; a null document id counts as empty in the checksum that deals out the damage. Repeated rows count as
often as they stand there. Ties between near words go to the smallest in code-point order. An empty table gives no rows; further
columns of documents are not touched.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

MIN_CHARS, MIN_COUNT = 5, 3
SHORTEST, LONGEST, FREQUENT = 2, 4, 16
EDGE = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): runs of letters, each with one character less where the checksum of ``key:run`` says so."""
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"),
                       F.explode(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"[a-z\\u00C0-\\u00FF]{{{min_chars},}}"), F.lit(0))).alias("run"))
    marked = runs.select("run", F.crc32(F.concat("k", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % 97 == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    return marked.select(word.alias("word")).where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def gram_lists(words: DataFrame, longest: int = LONGEST, frequent: int = FREQUENT) -> DataFrame:
    """(word, n, size, gram, place): the gram of the dictionary at each place of each word (column ``word``, distinct)."""
    looked_at = F.filter(F.sequence(F.lit(0), F.col("size")), lambda p: (p < EDGE) | (p >= F.col("size") - EDGE))
    places = words.select("word", "n", F.length("word").alias("size"), F.concat(F.lit("^"), "word", F.lit("$")).alias("marked")).select(
        "word", "n", "size", F.explode(F.transform(looked_at, lambda p: F.struct(p.alias("place"), F.substring("marked", p + 1, F.lit(longest)).alias("rest")))).alias("at")).select(
        "word", "n", "size", "at.place", "at.rest")
    for q in range(SHORTEST, longest):
        gram = F.substring("rest", F.lit(1), F.lit(q))
        often = places.groupBy(gram.alias("gram")).agg(F.count(F.lit(1)).alias("f")).where((F.length("gram") == q) & (F.col("f") > frequent))
        often = often.select(F.col("gram").alias(f"g{q}"), F.lit(1).alias(f"is{q}"))
        places = places.withColumn(f"p{q}", gram).join(often, F.col(f"p{q}") == F.col(f"g{q}"), "left").drop(f"p{q}", f"g{q}")
    length = F.lit(SHORTEST)
    for q in range(SHORTEST, longest):
        length = length + F.coalesce(f"is{q}", F.lit(0))
    return places.select("word", "n", "size", F.substring("rest", F.lit(1), length).alias("gram"), "place")


def chosen_lists(grams: DataFrame) -> DataFrame:
    """Of each word's grams the two with the shortest lists whose spans don't meet: (word, n, size, gram, place)."""
    counts = grams.groupBy("gram", "place", "size").agg(F.count(F.lit(1)).alias("f"))
    g = grams.join(counts, ["gram", "place", "size"])
    # a word's spans by where they end and start: at each start, the shortest list that has ended
    ends = F.struct((F.col("place") + F.length("gram")).alias("at"), F.lit(0).alias("start"), F.struct("f", "place", "gram").alias("list"))
    starts = F.struct(F.col("place").alias("at"), F.lit(1).alias("start"), F.struct("f", "place", "gram").alias("list"))
    events = g.select("word", "n", "size", F.explode(F.array(ends, starts)).alias("e")).select("word", "n", "size", "e.*")
    before = Window.partitionBy("word").orderBy("at", "start").rowsBetween(Window.unboundedPreceding, -1)
    events = events.withColumn("left", F.min(F.when(F.col("start") == 0, F.col("list"))).over(before)).where("start = 1 AND left IS NOT NULL")
    best = events.groupBy("word", "n", "size").agg(F.min(F.struct((F.col("left.f") + F.col("list.f")).alias("f"), "left", "list")).alias("b"))
    return best.select("word", "n", "size", F.explode(F.array("b.left", "b.list")).alias("x")).select("word", "n", "size", "x.gram", "x.place")


def near_pairs(words: DataFrame, longest: int = LONGEST, frequent: int = FREQUENT) -> DataFrame:
    """(a, a_n, b, b_n): each pair of near words of ``words`` (word, n) once."""
    grams = stored(gram_lists(words, longest, frequent), "grams")
    probes = chosen_lists(grams).select(
        F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("size").alias("a_size"), "gram",
        F.explode(F.array(*[F.struct((F.col("place") - back).alias("place"), (F.col("size") - less).alias("size")) for back, less in ((0, 0), (0, 1), (1, 1))])).alias("to")).select(
        "a", "a_n", "a_size", "gram", "to.place", "to.size")
    index = grams.select(F.col("word").alias("b"), F.col("n").alias("b_n"), "gram", "place", "size")
    found = probes.join(index, ["gram", "place", "size"]).where((F.col("size") < F.col("a_size")) | (F.col("a") < F.col("b")))
    return found.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct()


def group_words(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of ``words`` (word, n) by their near ``pairs``.

    A form is at least twice as frequent as its word, so the way to the root has at most log2 of the largest count steps; each
    round doubles the steps made.
    """
    both = pairs.select("a", "a_n", "b", "b_n").unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form"))).alias("best"))
    is_form = -F.col("best.less") >= 2 * F.col("n")
    formed = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "forms")
    up = formed.where("form IS NOT NULL").select("word", F.col("form").alias("up"))
    most = words.agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(math.log2(most) + 1))):
        above = up.select(F.col("word").alias("via"), F.col("up").alias("above"))
        up = stored(up.join(above, F.col("up") == F.col("via"), "left").select("word", F.coalesce("above", "up").alias("up")), "roots")
    return formed.join(up, "word", "left").select("word", "form", F.coalesce("up", "word").alias("root"), "n", "n_near", "form_n")


def spelling_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    words = stored(word_counts(docs, key, text), "words")
    return group_words(words, stored(near_pairs(words), "near"))


def report_sql(source: str = "documents") -> str:
    """DuckDB SQL of ``spelling_report``: near words share a deletion or one is a deletion of the other."""
    return f"""
WITH RECURSIVE bytes AS (SELECT i, CASE WHEN i & 1 = 1 THEN xor(i >> 1, 3988292384) ELSE i >> 1 END AS c, 1 AS k FROM (SELECT unnest(range(256))::BIGINT AS i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bytes WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bytes WHERE k = 8),
runs AS (SELECT k, run, count(*) AS n FROM (SELECT coalesce(doc_id::VARCHAR, '') AS k, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM {source})
  WHERE length(run) >= {MIN_CHARS} GROUP BY k, run),
marked AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(k || ':' || run)), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda a, b: xor(a >> 8, crc_table.t[(xor(a, b) & 255) + 1]))) AS h FROM runs, crc_table),
words AS (SELECT word, sum(n)::BIGINT AS n FROM (
  SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM marked)
  WHERE length(word) >= {MIN_CHARS} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS d FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT DISTINCT * FROM (
  SELECT a.word, b.word AS other, b.n FROM less AS a JOIN less AS b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION ALL SELECT a.word, b.word, b.n FROM less AS a JOIN words AS b ON a.d = b.word
  UNION ALL SELECT b.word, a.word, a.n FROM less AS a JOIN words AS b ON a.d = b.word)),
best AS (SELECT word, count(*) AS n_near, max(n) AS most, min(other) FILTER (n = m) AS other FROM (SELECT *, max(n) OVER (PARTITION BY word) AS m FROM near) GROUP BY word),
formed AS (SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * w.n THEN other END AS form, CASE WHEN most >= 2 * w.n THEN most END AS form_n FROM words AS w LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS root, form AS up FROM formed UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN formed AS f ON walk.up = f.word)
SELECT f.word, form, root, n, n_near, form_n FROM formed AS f JOIN (SELECT word, root FROM walk WHERE up IS NULL) USING (word)"""
