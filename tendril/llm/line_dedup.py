"""Line dedup: lines within a few edits of each other are one line, found by a segment-partition edit join.

Two lines within k edits share a segment: if the shorter is split into k + 1 even segments, the longer has one of them
unchanged, at a place shifted by at most k. Every distinct line gives its segments as index entries and, for each length
from its own down to k less, the substrings at which a segment of such a line could stand. Entries are keyed by (length,
segment number, hash of the characters) and meet in one shuffle; keys with one line fall away. What is left is verified by
a banded edit distance on bit vectors: one vector of 2k + 1 diagonals per number of edits.

Exact copies are grouped before, so the join sees different lines only. A key that many lines share is cut into blocks of
index lines and each probe is held against a block as one row: there is no row per pair, only per verified link. Links
give classes by connected components; the first line (by document, then place) of a class stays, the others go.

Exact copies are grouped over all lines with a visible character; blank lines stay. Only lines of at least ``min_chars``
characters take part in the edit join (k edits turn shorter ones into anything). Null and empty texts have no lines. A document is a row's key and text:
rows of one key (null included) with different texts are different documents, and a repeated row adds nothing. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bucketed, components, once, stored

EDITS = 2
MIN_CHARS = 16
BLOCK = 32
VISIBLE = r"[^\x20\x09-\x0D]"

LETTER_GROUPS = ["ea", "tn", "ri", "os", "hl", "dcu", "mfp", "gwyb", "vkxjqz", "EATNRIOSHLDCUMFPGWYBVKXJQZ", "0123456789", " .", ",;:!?'\"-()", "éèêàçùôî", "äöüß", "ñóíá"]


def segments(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """Start (from 1) and length of each of the edits + 1 even segments of a line; the last ones are longer by one."""
    parts = edits + 1
    small, longer = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    out, start = [], F.lit(1)
    for i in range(parts):
        size = small + F.when(F.lit(i) >= parts - longer, 1).otherwise(0)
        out.append((start, size))
        start = start + size
    return out


def _entry(length: Column, i: int, text: Column, start: Column, size: Column, index: bool) -> Column:
    return F.struct(F.xxhash64(length, F.lit(i), F.substring(text, start, size)).alias("key"), F.lit(index).alias("index"))


def entries(text: Column, length: Column, edits: int) -> Column:
    """Index entries of a line and its probes of lines up to ``edits`` shorter.

    A probe's shift is limited by the edits that may come before the segment and after it; the unshifted probe of the own
    length is the index entry itself.
    """
    out = [_entry(length, i, text, start, size, True) for i, (start, size) in enumerate(segments(length, edits))]
    for less in range(edits + 1):
        other = length - less
        for i, (start, size) in enumerate(segments(other, edits)):
            after = edits - i
            for shift in range(max(-i, less - after), min(i, less + after) + 1):
                if less == 0 and shift == 0:
                    continue
                out.append(_entry(other, i, text, start + shift, size, False))
    return F.array(*out)


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether character arrays ``a`` and ``b`` are within ``edits`` edits: banded and bit-parallel.

    Bit d of vector e says: the first j characters of b and the first j + d - edits of a are within e edits. A step shifts
    and masks the vectors once per character of b.
    """
    band = 2 * edits + 1
    full = (1 << band) - 1
    start = [sum(1 << (d + edits) for d in range(e + 1)) for e in range(edits + 1)]

    def step(v: Column, j: Column) -> Column:
        c = F.get(b, j)
        hit = F.lit(0)
        for d in range(-edits, edits + 1):
            hit = hit + F.when(F.get(a, j + d) == c, 1 << (d + edits)).otherwise(0)
        return F.transform(F.array(hit), lambda m: _advance(v, m))[0]

    def _advance(v: Column, m: Column) -> Column:
        # the vectors are packed into one number, the one of no edits lowest
        old = [F.shiftright(v, band * e).bitwiseAND(full) for e in range(edits + 1)]
        new = [old[0].bitwiseAND(m)]
        for e in range(1, edits + 1):
            kept = old[e].bitwiseAND(m).bitwiseOR(old[e - 1]).bitwiseOR(F.shiftright(old[e - 1], 1))
            new.append(kept.bitwiseOR(F.shiftleft(new[e - 1], 1).bitwiseAND(full)))
        out = new[0]
        for e in range(1, edits + 1):
            out = out.bitwiseOR(F.shiftleft(new[e], band * e))
        return out

    packed = sum(s << (band * e) for e, s in enumerate(start))
    end = F.aggregate(F.sequence(F.lit(0), F.size(b) - 1), F.lit(packed).cast("long"), lambda v, j: F.when(v == 0, v).otherwise(step(v, j).cast("long")))
    reached = F.shiftright(end, band * edits).bitwiseAND(full)
    last = F.size(a) - F.size(b) + edits
    return (F.abs(F.size(a) - F.size(b)) <= edits) & (F.pmod(F.floor(reached / F.pow(F.lit(2.0), last)), F.lit(2)) == 1)


def letter_counts(text: Column) -> Column:
    """How many characters of each group a line has. One edit moves two of the counts by one at most."""
    return F.array(*[F.length(text) - F.length(F.regexp_replace(text, "[" + g.replace("-", r"\-") + "]", "")) for g in LETTER_GROUPS])


def document(key: str, text: str) -> Column:
    """What names a document: its key and a hash of its text."""
    return F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("text"))


def document_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, place, line) of all lines."""
    return docs.select(document(key, text).alias("doc"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("place", "line"))


def _identified(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("line").rlike(VISIBLE)).select("doc", "place", "line", F.length("line").alias("length"), F.xxhash64("line").alias("h"), F.crc32(F.col("line").cast("binary")).alias("c"))


def line_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> tuple[DataFrame, DataFrame]:
    """(lines, near): each distinct line (h, c, length) with its first place and number of places, and for those with near
    ones the first place of their class as well."""
    lines = _identified(document_lines(docs, key, text))
    # one row per different line, bucketed by what names it: the text is shuffled here and never again
    different = lines.groupBy("h", "c", "length").agg(F.min(F.struct("doc", "place")).alias("first"), F.count(F.lit(1)).alias("places"), F.first("line").alias("line"))
    different = bucketed(different.withColumn("id", F.monotonically_increasing_id()), "lines", ["h", "c", "length"])

    made = different.where(F.col("length") >= min_chars).select("id", F.explode(entries(F.col("line"), F.col("length"), edits)).alias("e")).select("id", "e.key", "e.index")
    # a line with many equal substrings meets itself only
    per_key = Window.partitionBy("key")
    met = (made.withColumn("n_index", F.sum(F.col("index").cast("long")).over(per_key)).withColumn("n", F.count(F.lit(1)).over(per_key))
           .where("n > 1 AND n_index > 0").distinct())
    met = stored(met.select("key", "id", "index", F.ceil(F.col("n_index") / BLOCK).cast("int").alias("blocks")), "met")
    named = different.select("id", "h", "c", "length").join(met.select("id").distinct(), "id")
    texts = once(different.drop("id").join(named, ["h", "c", "length"]).select("id", "line"), "counts", letter_counts(F.col("line")))
    texts = stored(texts, "met_lines")

    index = met.where("index").join(texts, "id").select("key", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.struct("id", "line", "counts").alias("entry"))
    blocks = index.groupBy("key", "block").agg(F.collect_list("entry").alias("entries"))
    probes = met.join(texts, "id").select("key", "id", "line", "counts", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    held = probes.join(blocks, ["key", "block"])
    moved = F.filter("entries", lambda x: (x["id"] != F.col("id")) & (F.aggregate(F.zip_with(x["counts"], F.col("counts"), lambda p, q: F.abs(p - q)), F.lit(0), lambda s, v: s + v) <= 2 * edits))
    held = once(held.select("id", "line", moved.alias("likely")).where(F.size("likely") > 0), "letters", F.split(F.col("line"), ""))
    links = held.select("id", F.explode(F.filter("likely", lambda x: F.transform(F.array(F.split(x["line"], "")), lambda a: within_edits(a, F.col("letters"), edits))[0])).alias("other"))
    links = stored(links.select("id", F.col("other.id").alias("other_id")).distinct(), "links")

    classes = components(links, "id", "other_id")
    joined = different.join(classes, different["id"] == classes["node"]).select("h", "c", "length", "first", "root")
    firsts = joined.groupBy("root").agg(F.min("first").alias("class_first"))
    near = joined.join(firsts, "root").select("h", "c", "length", "class_first")
    return different.select("h", "c", "length", "first", "places"), near


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, place, near, kept_doc, kept_place): every line that goes, whether it differs from the one that stays, and which that is."""
    different, near = line_classes(docs, key, text, edits, min_chars)
    found = different.join(near, ["h", "c", "length"], "left").withColumn("stays", F.coalesce("class_first", "first"))
    found = found.where((F.col("places") > 1) | (F.col("stays") != F.col("first")))
    places = _identified(document_lines(docs, key, text)).select("doc", "place", "h", "c", "length")
    gone = places.join(found, ["h", "c", "length"]).where(~(F.struct("doc", "place").eqNullSafe(F.col("stays"))))
    return gone.select("doc", "place", (F.col("stays") != F.col("first")).alias("near"), F.col("stays.doc.key").alias("kept_doc"), F.col("stays.place").alias("kept_place"))


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document: number of lines, of lines that go as exact and as near copies, and each of these with the line that stays."""
    gone = removed_lines(docs, key, text, edits, min_chars).distinct()
    per = gone.groupBy("doc").agg(
        F.count_if(~F.col("near")).alias("n_exact"), F.count_if("near").alias("n_near"),
        F.array_sort(F.collect_list(F.struct(F.col("place").alias("line"), "near", "kept_doc", F.col("kept_place").alias("kept_line")))).alias("removed"))
    all_docs = docs.select(document(key, text).alias("doc"), F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).cast("long").alias("n_lines"))
    all_docs = all_docs.groupBy("doc").agg(F.max("n_lines").alias("n_lines"))
    joined = all_docs.join(per.withColumnRenamed("doc", "d"), F.col("doc").eqNullSafe(F.col("d")), "left")
    none = F.array().cast(joined.schema["removed"].dataType)
    return joined.select(
        F.col("doc.key").alias(key), "n_lines", F.coalesce("n_exact", F.lit(0)).alias("n_exact"), F.coalesce("n_near", F.lit(0)).alias("n_near"), F.coalesce("removed", none).alias("removed"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the lines that go; a repeated row loses the same places."""
    names = docs.columns
    gone = removed_lines(docs, key, text, edits, min_chars).groupBy("doc").agg(F.collect_set("place").alias("gone"))
    safe = docs.toDF(*[f"d{i}" for i in range(len(names))])
    at, k = f"d{names.index(text)}", f"d{names.index(key)}"
    kept = F.filter(F.split(F.col(at), "\n"), lambda x, i: ~F.array_contains("gone", i))
    joined = safe.join(gone, document(k, at).eqNullSafe(F.col("doc")), "left").withColumn(at, F.when(F.col("gone").isNull(), F.col(at)).otherwise(F.array_join(kept, "\n")))
    return joined.select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(names)])
