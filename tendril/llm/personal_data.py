"""Personal data: candidate spans, labelers that vote on them, and a span classifier trained on what the votes agree on.

Candidates are the base spans (always kept) and wider forms: written-out addresses, national phone numbers, shorter cards,
long network addresses. Five labelers vote yes, no or nothing on each candidate: strict form, a gazetteer (domains, country
codes, card issuers, networks), words around it, grouping, and what it touches. Expectation-maximisation over the counted
vote patterns (at most 3 to the power of 5 by kind) estimates how reliable each labeler is; the posteriors then train a naive
Bayes classifier on features of the span, which decides over the wider candidates.

Expressions only: every text is searched where it lies, in one pass; candidates (without texts) are written once and all
counting is done on them. Positions are code points, ends exclusive. Patterns start only where a match can start and never
give back what they took, so a search is linear in the text.

Null and empty texts have no spans. Repeated rows give repeated results. Empty tables give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import once, stored

KINDS = ["email", "ip", "card", "phone"]

# The base forms. Same matches as [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ and so on: a match can start only
# at the start of a run of its first class, or where the match before it ended.
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?[\[(]at[\])] ?| at )[A-Za-z0-9-]{1,63}+(?: ?[\[(]dot[\])] ?| dot )[A-Za-z]{2,24}+",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])",
    "phone": r"(?<![0-9A-Za-z+().-])(?<![0-9] )\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z.-])",
}
GATE = {"email": "@", "wide_email": r"(?i)\bdot\b", "digit": "[0-9]", "ip6": "[0-9A-Fa-f]:[0-9A-Fa-f]"}

# Gazetteers.
DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|io|dev|app|ai|eu|uk|de|fr|es|it|nl|be|ch|at|pl|pt|se|no|fi|dk|ie|us|ca|mx|br|ar|au|nz|jp|cn|kr|in|ru|za"
COUNTRIES = r"\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-9][0-9]|3[578][0-9]|42[0-9]|85[0-9]|88[0-9]|9[679][0-9])"
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|36|30|38|6011|65|62|35)"
NETWORKS = "^(?:0|255|22[4-9]|23[0-9]|24[0-9]|25[0-4])[.]"
AROUND = {
    "email": "mail|contact|write|reach|addres|courriel|correo|schreib",
    "ip": "ip|host|server|address|ping|login|from|client",
    "card": "card|visa|credit|pay|account|iban|karte|carte|tarjeta",
    "phone": "call|phone|tel|mobile|fax|contact|number|ring|appel|ruf|llam",
}
AGAINST = "version|release|isbn|issn|order|invoice|sku|section|part|serial|build|doi|commit|figure|page"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """From the right, every second digit doubled, its digits added: the sum ends in 0."""
    places = F.filter(F.split(F.reverse(number), ""), lambda d: d != "")
    value = F.transform(places, lambda d, i: F.when(i % 2 == 1, (d.cast("int") * 2).cast("int")).otherwise(d.cast("int")))
    return F.aggregate(value, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """What a base match must also meet."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])$"))
    if kind == "card":
        return luhn(digits(match))
    return F.length(digits(match)).between(8, 15)


def spans(text: str, pattern: str) -> Column:
    """(start, end, match) of all matches; the pieces between them give the places."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(f"""
      aggregate(
        arrays_zip(split({text}, '{quoted}', -1), regexp_extract_all({text}, '{quoted}', 0)),
        struct(0 AS at, CAST(array() AS array<struct<start:int,end:int,match:string>>) AS got),
        (a, p) -> struct(
          a.at + length(p['0']) + coalesce(length(p['1']), 0) AS at,
          CASE WHEN p['1'] IS NULL THEN a.got ELSE concat(a.got, array(struct(
            a.at + length(p['0']) AS start, a.at + length(p['0']) + length(p['1']) AS end, p['1'] AS match))) END AS got)).got""")


NONE = "CAST(array() AS array<struct<start:int,end:int,match:string>>)"


def vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "y").when(no, "n").otherwise("-")


def _votes(kind: str, base: bool, match: Column, before: Column, after: Column) -> Column:
    """Five labelers: form, gazetteer, context, grouping, neighbours."""
    number, low = digits(match), F.lower(before)
    if kind == "email":
        form = vote(F.lit(base), F.lit(False))
        known = match.rlike(rf"(?i)(?:\.|\bdot\b|\]|\))\s?(?:{DOMAINS})$")
        parts = vote(match.rlike(r"^[A-Za-z0-9]"), match.rlike(r"\.\."))
    elif kind == "ip":
        form = vote(F.lit(base) | match.rlike("(?i)^(?:2|f)"), match.rlike("^0"))
        known = ~match.rlike(NETWORKS)
        parts = vote(F.lit(base), match.rlike("^(.+):\\1:\\1:\\1:"))
    elif kind == "card":
        form = vote(luhn(number), ~luhn(number))
        known = number.rlike(ISSUERS)
        parts = vote(match.rlike(r"^(?:[0-9]+|[0-9]{4}([\x20-])[0-9]{4,6}(?:\1[0-9]{1,7})+)$"), match.rlike(r"[\x20-]"))
    else:
        form = vote(F.lit(base), match.rlike(r"^\(?[01]"))
        known = match.rlike(f"^{COUNTRIES}") if base else ~match.rlike(r"^\(?[019]11")
        parts = vote(match.rlike(r"\([0-9]+\)|[0-9]{3}[\x20.-][0-9]{4}$"), match.rlike(r"[.]{2}|\(\("))
    context = vote(low.rlike(AROUND[kind]), low.rlike(AGAINST))
    touching = vote(before.rlike(r"(?:^|[\s(<\[\"',:;])$") & after.rlike(r"^(?:$|[\s)>\]\"',:;.!?])"), before.rlike(r"[\p{L}0-9_/#=]$") | after.rlike(r"^[\p{L}0-9_/=]"))
    return F.concat(form, vote(known, ~known), context, parts, touching)


def _features(kind: str, base: bool, match: Column) -> Column:
    """Coarse features of the span itself for the classifier; one character each."""
    n, share = F.length(match), F.length(digits(match)) / F.length(match)
    return F.concat(
        F.lit("b" if base else "w"), F.when(n < 12, "0").when(n < 16, "1").when(n < 20, "2").otherwise("3"), F.when(share < 0.3, "0").when(share < 0.8, "1").when(share < 1, "2").otherwise("3"),
        F.when(match.rlike(r"[\s-]"), "s").otherwise("-"), F.when(match.rlike(r"(.)\1\1\1"), "r").otherwise("-"))


CANDIDATE = "array<struct<kind:int,base:boolean,start:int,end:int,votes:string,features:string>>"


def _judged(found: Column, kind: str, base: bool, text: str) -> Column:
    def row(s: Column) -> Column:
        before, after = F.substring(F.col(text), F.greatest(s["start"] - 39, F.lit(1)), F.least(s["start"], F.lit(40))), F.substring(F.col(text), s["end"] + 1, F.lit(8))
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), F.lit(base).alias("base"), s["start"].alias("start"), s["end"].alias("end"),
                        _votes(kind, base, s["match"], before, after).alias("votes"), _features(kind, base, s["match"]).alias("features"))
    return F.transform(found, row).cast(CANDIDATE)


def _valid_span(kind: str):
    return lambda s: valid(kind, s["match"])


def _apart_from(base: Column):
    return lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


def _base_of(kind: int):
    return lambda s: s["base"] & (s["kind"] == kind)


def candidates(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, _spans): base spans and wider candidates that overlap none of the same kind, with votes and features."""
    df = docs.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.coalesce(F.col(text), F.lit("")).alias("_t"))
    df = once(df, "_digit", F.col("_t").rlike(GATE["digit"]))
    gates = {"email": F.col("_t").contains(GATE["email"]), "ip": F.col("_digit"), "card": F.col("_digit"), "phone": F.col("_digit") & F.col("_t").contains("+")}
    wide_gates = {"email": F.col("_t").rlike(GATE["wide_email"]), "ip": F.col("_digit") & F.col("_t").rlike(GATE["ip6"]), "card": F.col("_digit"), "phone": F.col("_digit")}
    none, all_spans = F.expr(NONE), []
    for kind in KINDS:
        df = once(df, f"_base_{kind}", F.when(gates[kind], F.filter(spans("_t", BASE[kind]), _valid_span(kind))).otherwise(none))
        df = once(df, f"_wide_{kind}", F.when(wide_gates[kind], spans("_t", WIDE[kind])).otherwise(none))
        base = F.col(f"_base_{kind}")
        apart = F.filter(f"_wide_{kind}", _apart_from(base))
        all_spans += [F.when(F.size(base) > 0, _judged(base, kind, True, "_t")), F.when(F.size(f"_wide_{kind}") > 0, _judged(apart, kind, False, "_t"))]
    empty = F.expr(f"CAST(array() AS {CANDIDATE})")
    return df.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], F.concat(*[F.coalesce(s, empty) for s in all_spans]).alias("_spans"))


def reliabilities(patterns: dict[tuple[int, str], int], rounds: int = 30) -> tuple[dict, dict]:
    """EM by kind over counted (kind, votes): the posterior of each pattern, and (P(y | real), P(n | not real)) of each labeler."""
    posterior, model = {}, {}
    for kind in sorted({k for k, _ in patterns}):
        own = {v: n for (k, v), n in patterns.items() if k == kind}
        prior, accuracy = 0.5, [(0.8, 0.8)] * len(next(iter(own)))
        for _ in range(rounds):
            post = {}
            for v in own:
                yes, no = math.log(prior), math.log(1 - prior)
                for c, (a, b) in zip(v, accuracy, strict=True):
                    if c != "-":
                        yes += math.log(a if c == "y" else 1 - a)
                        no += math.log(1 - b if c == "y" else b)
                post[v] = 1 / (1 + math.exp(max(-700, min(700, no - yes))))
            total, real = sum(own.values()), sum(post[v] * n for v, n in own.items())
            prior = min(0.95, max(0.05, (real + 5) / (total + 10)))
            accuracy = [tuple(min(0.98, max(0.55, (sum(w(v) * n for v, n in own.items() if v[i] == c) + 8) / (sum(w(v) * n for v, n in own.items() if v[i] != "-") + 10)))
                              for c, w in (("y", lambda v: post[v]), ("n", lambda v: 1 - post[v]))) for i in range(len(accuracy))]
        model[kind] = (prior, accuracy)
        posterior |= {(kind, v): p for v, p in post.items()}
    return posterior, model


def classifier(counted: list[tuple[int, str, str, int]], posterior: dict) -> dict[tuple[int, str, str], float]:
    """Naive Bayes on votes-free span features and the context votes, trained on the posteriors; its verdict for each seen combination."""
    real, not_real = {}, {}
    for kind, v, f, n in counted:
        p = posterior[kind, v]
        for i, x in enumerate([*f, *v]):
            key = (kind, i, x)
            real[key], not_real[key] = real.get(key, 0) + p * n, not_real.get(key, 0) + (1 - p) * n
    totals = {k: (sum(n * posterior[a, v] for a, v, _, n in counted if a == k), sum(n * (1 - posterior[a, v]) for a, v, _, n in counted if a == k)) for k in {c[0] for c in counted}}
    out = {}
    for kind, v, f, _ in counted:
        r, w = totals[kind]
        odds = math.log((r + 1) / (w + 1))
        for i, x in enumerate([*f, *v]):
            # evidence of the parts is not independent: half weight
            odds += 0.5 * math.log(((real.get((kind, i, x), 0) + 1) / (r + 4)) / ((not_real.get((kind, i, x), 0) + 1) / (w + 4)))
        out[kind, v, f] = 1 / (1 + math.exp(max(-700, min(700, -odds))))
    return out


def find_personal_data(docs: DataFrame, keys: list[str], text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(keys, _spans) with the base spans and the wider ones that the classifier accepts: (kind, base, start, end), by kind and start."""
    found = stored(candidates(docs, keys, text), "candidates")
    # seen combinations of five votes and coarse features of four kinds: a bounded table
    seen = [tuple(r) for r in found.select(F.explode("_spans").alias("s")).groupBy("s.kind", "s.votes", "s.features").agg(F.count(F.lit(1)).alias("n")).collect()]
    patterns: dict[tuple[int, str], int] = {}
    for kind, v, _, n in seen:
        patterns[kind, v] = patterns.get((kind, v), 0) + n
    posterior, _ = reliabilities(patterns)
    accepted = [f"{k}{v}{f}" for (k, v, f), p in classifier(seen, posterior).items() if p >= threshold and f[0] == "w"]
    taken = F.array(*[F.lit(a) for a in accepted]).cast("array<string>")
    kept = F.filter("_spans", lambda s: s["base"] | F.array_contains(taken, F.concat(s["kind"].cast("string"), s["votes"], s["features"])))
    rows = F.transform(kept, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))
    return found.select(*keys, F.array_sort(rows).alias("_spans"))


def personal_data_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    found = find_personal_data(docs.select(key, text), [key], text)
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("_spans", lambda s: s["base"])
    counts = [F.size(F.filter("_spans", _base_of(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(key, *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans"))


def mask(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with every found span replaced by its kind in angle brackets; spans that overlap an earlier one are joined to it."""
    names = docs.columns
    safe = docs.toDF(*[f"d{i}" for i in range(len(names))])
    at = f"d{names.index(text)}"
    found = find_personal_data(safe.withColumn("again", F.col(at)), safe.columns, "again", threshold)
    labels = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    ordered = F.array_sort(F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(ordered, start, lambda a, s: F.when(s["start"] < a["at"], F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).otherwise(F.struct(
        s["end"].alias("at"), F.concat(a["out"], F.substring(F.col(at), a["at"] + 1, s["start"] - a["at"]), F.get(labels, s["kind"])).alias("out"))),
        lambda a: F.concat(a["out"], F.substring(F.col(at), a["at"] + 1, F.length(at))))
    return found.withColumn(at, F.when(F.size("_spans") > 0, done).otherwise(F.col(at))).select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(names)])


