"""License scan: ordered signature rules over the words of each text.

A rule is a regular expression over whole words, with the label it detects, a priority and a keyword that must stand in
the text before the expression is tried. Overlapping detections are resolved by priority and by containment: one that
lies inside another of the same or a higher priority is dropped; equal places go to the rule listed first. The base
phrases have the highest priority and are never dropped.

The normal form of a text is its lower-case words, each with one space on either side, so expressions match at word
borders without looking around, and the position of a match in words is half the number of spaces before it. All rules are
tried within the row: no shuffle, no Python.

Null and empty texts have no words and no detections. Columns other than key and text are ignored. Repeated rows give
repeated results. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import once

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]++"

# The base phrases and their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


@dataclass(frozen=True)
class Rule:
    pattern: str  # over the normal form
    label: str
    gate: str  # a word that every match has
    keywords: tuple[str, ...]  # parts of the normal form that every match has
    priority: int
    confidence: float


def words_pattern(phrase: str) -> str:
    """Words separated by spaces; ``a|b`` are alternatives, a final ``?`` makes a word optional, ``N`` is a number."""
    out = ""
    for token in phrase.split():
        optional, token = token.endswith("?"), token.replace("?", "")
        token = "|".join("[0-9]+" if t == "N" else t for t in token.split("|"))
        out += f"(?: (?:{token}) )?" if optional else f" (?:{token}) "
    return out


# Names by which each license is called, as word expressions; the first word of each must be there.
NAMES = {
    "mit": ["mit", "expat", "massachusetts institute of technology"],
    "apache-2": ["apache v|version? 2 0?", "apache software? foundation? license version? 2 0?", "asl 2 0?"],
    "apache-1.1": ["apache software? license version? 1 1"],
    "apache-1.0": ["apache software? license version? 1 0"],
    "gpl-3": ["gnu gpl version? 3", "gpl v3|3", "gplv3", "gnu general public license version? v3|3", "general public license version 3"],
    "gpl-2": ["gnu gpl version? 2", "gpl v2|2", "gplv2", "gnu general public license version? v2|2", "general public license version 2"],
    "gpl-1": ["gpl v1|1", "gnu general public license version? v1|1"],
    "lgpl-3": ["lgpl v3|3", "lgplv3", "gnu lesser general public license version? v3|3"],
    "lgpl-2.1": ["lgpl v2|2 1?", "gnu lesser|library general public license version? v2|2 1?"],
    "agpl-3": ["agpl v3|3", "agplv3", "gnu affero general public license version? v3|3"],
    "gfdl": ["gnu free documentation license", "gfdl"],
    "bsd-2-clause": ["bsd 2 clause", "simplified bsd", "freebsd", "two clause bsd"],
    "bsd-3-clause": ["bsd 3 clause", "new bsd", "modified bsd", "revised bsd", "three clause bsd"],
    "bsd-4-clause": ["bsd 4 clause", "original bsd", "four clause bsd"],
    "0bsd": ["0bsd", "zero clause bsd"],
    "isc": ["isc", "internet systems consortium"],
    "mpl-2": ["mozilla public license version|v? 2 0?", "mpl v|version? 2 0?"],
    "mpl-1.1": ["mozilla public license version? 1 1", "mpl 1 1"],
    "epl-2": ["eclipse public license version|v? 2 0?", "epl v|version? 2 0?"],
    "epl-1": ["eclipse public license version? 1 0", "epl 1 0"],
    "edl": ["eclipse distribution license"],
    "cddl": ["common development and distribution license", "cddl"],
    "cpl": ["common public license"],
    "eupl": ["european union public licen[cs]e", "eupl"],
    "artistic-2": ["artistic license version? 2 0?"],
    "artistic-1": ["artistic license version? 1 0?", "perl artistic"],
    "zlib": ["zlib", "zlib libpng"],
    "libpng": ["libpng"],
    "boost-1": ["boost software license version? 1? 0?", "bsl 1 0"],
    "unlicense": ["unlicense"],
    "wtfpl": ["wtfpl", "do what the fuck you want to public license"],
    "cc0": ["cc0 1? 0? universal?", "creative commons zero v1|1? 0? universal?", "cc zero"],
    "cc-by": ["cc by N N?", "creative commons attribution N N? international|unported|generic?"],
    "cc-by-sa": ["cc by sa N? N? international|unported|generic?", "creative commons attribution share alike N? N? international|unported|generic?", "creative commons attribution sharealike N? N? international|unported|generic?"],
    "cc-by-nd": ["cc by nd N? N? international|unported|generic?", "creative commons attribution no derivatives|derivs N? N? international|unported|generic?", "creative commons attribution noderivatives|noderivs N? N? international|unported|generic?"],
    "cc-by-nc": ["cc by nc", "creative commons attribution non commercial N? N? international|unported|generic?", "creative commons attribution noncommercial N? N? international|unported|generic?"],
    "cc-by-nc-sa": ["cc by nc sa N? N? international|unported|generic?", "creative commons attribution non? commercial|noncommercial share|sharealike alike? N? N? international|unported|generic?"],
    "cc-by-nc-nd": ["cc by nc nd N? N? international|unported|generic?", "creative commons attribution non? commercial|noncommercial no|noderivatives|noderivs derivatives|derivs? N? N? international|unported|generic?"],
    "odbl": ["open database license", "odbl"],
    "odc-by": ["open data commons attribution", "odc by"],
    "pddl": ["public domain dedication and license", "pddl"],
    "ofl": ["sil open font license", "ofl 1 1"],
    "lppl": ["latex project public license", "lppl"],
    "python-2": ["python software foundation license", "psf license", "psfl"],
    "php-3": ["php license version? 3 N?"],
    "ruby": ["ruby license"],
    "openssl": ["openssl"],
    "x11": ["x11", "x consortium"],
    "ncsa": ["university of illinois ncsa", "ncsa open source"],
    "ms-pl": ["microsoft public license", "ms pl"],
    "ms-rl": ["microsoft reciprocal license", "ms rl"],
    "ecl-2": ["educational community license"],
    "afl-3": ["academic free license"],
    "osl-3": ["open software license"],
    "upl": ["universal permissive license"],
    "cecill": ["cecill"],
    "zpl": ["zope public license"],
    "w3c": ["w3c software notice?"],
    "unicode": ["unicode license agreement"],
    "postgresql": ["postgresql license"],
    "sleepycat": ["sleepycat"],
    "vim": ["vim license"],
    "json": ["json license"],
    "beerware": ["beerware", "beer ware"],
    "sspl": ["server side public license", "sspl"],
    "elastic-2": ["elastic license"],
    "busl": ["business source license", "busl 1 1"],
    "commons-clause": ["commons clause"],
    "rail": ["responsible ai license", "openrail", "bigscience rail"],
    "llama": ["llama N? N? community license"],
}

# Sentences of license texts and notices that need no name.
SIGNATURES = [
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies", "mit"),
    ("the software is provided as is without warranty of any kind", "mit"),
    ("permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("unless required by applicable law or agreed to in writing software distributed under the license", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("redistributions of source code must retain the above copyright notice", "bsd"),
    ("redistributions in binary form must reproduce the above copyright notice", "bsd"),
    ("neither the name of", "bsd-3-clause"),
    ("all advertising materials mentioning features or use of this software", "bsd-4-clause"),
    ("this program is free software you can redistribute it and or modify it", "gpl"),
    ("under the terms of the gnu general public license as published", "gpl"),
    ("either version 3 of the license or at your option any later version", "gpl-3"),
    ("either version 2 of the license or at your option any later version", "gpl-2"),
    ("you should have received a copy of the gnu lesser general public license", "lgpl"),
    ("you should have received a copy of the gnu general public license", "gpl"),
    ("you should have received a copy of the gnu affero general public license", "agpl-3"),
    ("this library is free software you can redistribute it and or modify it", "lgpl"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("altered source versions must be plainly marked as such", "zlib"),
    ("this software is provided as is without any express or implied warranty", "zlib"),
    ("boost software license version 1 0 august 17th 2003", "boost-1"),
    ("everyone is permitted to copy and distribute verbatim copies of this license document", "gpl"),
    ("dedicated to the public domain", "public-domain"),
    ("released into the public domain", "public-domain"),
    ("placed in the public domain", "public-domain"),
    ("all rights reserved", "proprietary"),
    ("proprietary and confidential", "proprietary"),
    ("may not be reproduced without permission", "proprietary"),
    ("unauthorized copying of this file", "proprietary"),
    ("for non commercial use only", "non-commercial"),
    ("no commercial use", "non-commercial"),
    ("no part of this publication may be reproduced", "proprietary"),
]

# Notices in the words that each license is usually announced with.
NOTICES = [
    ("released|licensed|distributed|available under mit", "mit"), ("mit licensed", "mit"), ("licensed under mit or|and apache 2 0", "apache-2"),
    ("licensed to the apache software foundation asf? under one or more contributor license agreements", "apache-2"), ("licensed under the apache license version 2 0 the license", "apache-2"),
    ("this product includes software developed by the apache software foundation", "apache-1.1"),
    ("gnu general public license version 3 as published by the free software foundation", "gpl-3"), ("gnu general public license version 2 as published by the free software foundation", "gpl-2"),
    ("gnu general public license version 3 or later", "gpl-3"), ("gnu general public license version 2 or later", "gpl-2"), ("gpl version 3 or later", "gpl-3"), ("gpl version 2 or later", "gpl-2"),
    ("under the terms of the gnu lesser general public license as published", "lgpl"), ("under the terms of the gnu library general public license as published", "lgpl"),
    ("either version 2 1 of the license or at your option any later version", "lgpl-2.1"), ("gnu lesser general public license version 2 1 or later", "lgpl-2.1"),
    ("under the terms of the gnu affero general public license as published", "agpl-3"), ("gnu affero general public license version 3 or later", "agpl-3"),
    ("under the terms of the gnu free documentation license version 1 N", "gfdl"), ("with no invariant sections no front cover texts and no back cover texts", "gfdl"),
    ("use of this source code is governed by a bsd style license", "bsd"), ("licensed under the|a bsd license", "bsd"), ("under the|a bsd N clause license", "bsd"),
    ("the name of the author may not be used to endorse or promote products derived from this software", "bsd-3-clause"), ("this product includes software developed by the university of california", "bsd-4-clause"),
    ("if a copy of the mpl was not distributed with this file you can obtain one at", "mpl-2"), ("the contents of this file are subject to the mozilla public license version 1 1", "mpl-1.1"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license v2|2 0", "epl-2"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license v1|1 0", "epl-1"),
    ("the contents of this file are subject to the terms of the common development and distribution license", "cddl"), ("licensed under the eupl version? N N?", "eupl"),
    ("subject to the boost software license", "boost-1"), ("this font software is licensed under the sil open font license version 1 1", "ofl"),
    ("this work may be distributed and or modified under the conditions of the latex project public license", "lppl"), ("under the same terms as perl itself", "artistic-1"),
    ("permission to use copy modify and distribute this software and its documentation for any purpose", "hpnd"), ("this source file is subject to version 3 N? of the php license", "php-3"),
    ("subject to the terms of the zope public license", "zpl"), ("the software shall be used for good not evil", "json"), ("this software is governed by the cecill", "cecill"),
    ("under the terms of the server side public license", "sspl"), ("licensed under the elastic license", "elastic-2"), ("as long as you retain this notice you can do whatever you want with this stuff", "beerware"),
    ("you just do what the fuck you want to", "wtfpl"), ("to the extent possible under law", "cc0"), ("has waived all copyright and related or neighboring rights to", "cc0"),
    ("this database|data is made available under the open database license", "odbl"), ("openstreetmap contributors odbl", "odbl"), ("this database|data is made available under the open data commons attribution license", "odc-by"),
    ("lizenziert unter der mit lizenz", "mit"), ("creative commons namensnennung N N? international|unported?", "cc-by"), ("creative commons reconocimiento|atribución N N? internacional?", "cc-by"),
    ("creative commons namensnennung weitergabe unter gleichen bedingungen", "cc-by-sa"), ("creative commons reconocimiento|atribución compartirigual", "cc-by-sa"),
    ("creative commons attribution partage dans les mêmes conditions", "cc-by-sa"), ("creative commons attribution pas d utilisation commerciale", "cc-by-nc"),
    ("creative commons namensnennung nicht kommerziell", "cc-by-nc"), ("licence publique générale gnu", "gpl"), ("licencia pública general de gnu", "gpl"), ("tous droits réservés", "proprietary"),
    ("alle rechte vorbehalten", "proprietary"), ("todos los derechos reservados", "proprietary"),
]

# Names and identifiers that mean a license wherever they stand.
BARE = [
    ("gplv3", "gpl-3"), ("gplv2", "gpl-2"), ("gpl v3", "gpl-3"), ("gpl v2", "gpl-2"), ("gpl 3 0", "gpl-3"), ("gpl 2 0", "gpl-2"), ("lgplv3", "lgpl-3"), ("lgplv2", "lgpl-2.1"), ("lgpl v3", "lgpl-3"), ("lgpl v2", "lgpl-2.1"),
    ("lgpl 3 0", "lgpl-3"), ("lgpl 2 1", "lgpl-2.1"), ("agplv3", "agpl-3"), ("agpl v3", "agpl-3"), ("agpl 3 0", "agpl-3"), ("gnu general public license v3", "gpl-3"), ("gnu general public license v2", "gpl-2"),
    ("gnu general public license version 3", "gpl-3"), ("gnu general public license version 2", "gpl-2"), ("gnu affero general public license", "agpl-3"), ("gfdl 1 N", "gfdl"),
    ("apache 2 0", "apache-2"), ("apachev2", "apache-2"), ("bsd 2 clause", "bsd-2-clause"), ("bsd 3 clause", "bsd-3-clause"), ("bsd 4 clause", "bsd-4-clause"), ("0bsd", "0bsd"), ("mpl 2 0", "mpl-2"), ("mpl 1 1", "mpl-1.1"),
    ("mozilla public license", "mpl"), ("epl 2 0", "epl-2"), ("epl 1 0", "epl-1"), ("eclipse public license", "epl"), ("cddl 1 N", "cddl"), ("eupl 1 N", "eupl"), ("artistic 2 0", "artistic-2"), ("bsl 1 0", "boost-1"),
    ("boost software license", "boost-1"), ("cc by N N international|unported|generic?", "cc-by"), ("cc by sa N? N?", "cc-by-sa"), ("cc by nd N? N?", "cc-by-nd"), ("cc by nc sa N? N?", "cc-by-nc-sa"), ("cc by nc nd N? N?", "cc-by-nc-nd"),
    ("cc0", "cc0"), ("creative commons attribution N N international|unported|generic?", "cc-by"), ("creative commons attribution share|sharealike alike? N? N?", "cc-by-sa"), ("odbl 1 0", "odbl"), ("odc by 1 0", "odc-by"), ("pddl 1 0", "pddl"),
    ("ofl 1 1", "ofl"), ("sil open font license", "ofl"), ("lppl 1 N", "lppl"), ("psf 2 0", "python-2"), ("php 3 01", "php-3"), ("upl 1 0", "upl"), ("ecl 2 0", "ecl-2"), ("afl 3 0", "afl-3"), ("osl 3 0", "osl-3"),
    ("cecill 2 1", "cecill"), ("zpl 2 N", "zpl"), ("sspl 1 0", "sspl"), ("busl 1 1", "busl"), ("unlicense", "unlicense"), ("wtfpl", "wtfpl"), ("openrail", "rail"),
]

# Words that stand around a license's name; {} is the name.
FRAMES = [
    ("spdx license identifier {}", 90, 0.99),
    ("licensed|released|distributed|available|published|provided|shared|covered|governed under|by the|a|an|this? terms? and? conditions? of? the|a|an|this? {}", 80, 0.95),
    ("under the|a|an|this {} licen[cs]e", 80, 0.95),
    ("{} licen[cs]e", 70, 0.85),
    ("licen[cs]e {}", 60, 0.7),
]

LINKS = [
    ("opensource org licenses? mit", "mit"), ("apache org licenses license 2 0", "apache-2"), ("gnu org licenses gpl", "gpl"), ("gnu org licenses lgpl", "lgpl"), ("gnu org licenses agpl", "agpl-3"),
    ("mozilla org mpl 2 0", "mpl-2"), ("creativecommons org licenses by N 0", "cc-by"), ("creativecommons org licenses by sa", "cc-by-sa"), ("creativecommons org licenses by nd", "cc-by-nd"),
    ("creativecommons org licenses by nc N 0", "cc-by-nc"), ("creativecommons org licenses by nc sa", "cc-by-nc-sa"), ("creativecommons org licenses by nc nd", "cc-by-nc-nd"),
    ("creativecommons org publicdomain zero", "cc0"), ("unlicense org", "unlicense"), ("eclipse org legal epl", "epl-2"), ("boost org license 1 0", "boost-1"), ("opendatacommons org licenses odbl", "odbl"),
]


def keywords(phrase: str) -> tuple[str, ...]:
    """The runs of plain words that every match of the phrase has, in the normal form."""
    found, run = [], ""
    for token in [*phrase.split(), "?"]:
        if token.isalnum() and token != "N":
            run += f" {token} "
            continue
        if token == "licen[cs]e":
            run += " licen"
        if run:
            found.append(run)
        run = ""
    return tuple(found)


def gate_word(phrase: str) -> str:
    return max((t for t in phrase.split() if t.isalnum() and t != "N"), key=len)


def rules() -> list[Rule]:
    """All rules in order: base phrases, names in frames by license, sentences of license texts, notices, links, bare names."""
    out = [Rule(words_pattern(p), label, gate_word(p), keywords(p), 100, 1.0) for p, label in BASE]
    for label, names in NAMES.items():
        for name in names:
            for frame, priority, confidence in FRAMES:
                phrase = frame.format(name)
                out.append(Rule(words_pattern(phrase), label, gate_word(name), keywords(phrase), priority, confidence))
    out += [Rule(words_pattern(p), label, gate_word(p), keywords(p), 75, 0.9) for p, label in SIGNATURES + NOTICES]
    out += [Rule(words_pattern(p), label, gate_word(p), keywords(p), 65, 0.8) for p, label in LINKS]
    out += [Rule(words_pattern(p), label, gate_word(p), keywords(p), 50, 0.6) for p, label in BARE]
    return out


def normal_form(text: Column) -> Column:
    """The lower-cased words, two spaces before, between and after them; empty without words.

    lower() also folds letters beyond A-Z. They are word characters either way, and no base phrase has one that another
    letter folds to (only the Kelvin sign and the dotted capital I fold into ASCII, to k and to i with a dot of its own).
    """
    folded = F.lower(F.coalesce(text, F.lit("")))
    spaced = F.regexp_replace(F.concat(F.lit(" "), folded, F.lit(" ")), NOT_WORD, "  ")
    return F.when(F.length(spaced) > 2, spaced).otherwise("")


def rule_table(catalog: list[Rule]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("id"), F.lit(r.pattern).alias("pattern"), F.lit(r.label).alias("label"), F.array(*[F.lit(k) for k in r.keywords]).alias("keywords"), F.lit(r.gate).alias("gate"),
                              F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence")) for i, r in enumerate(catalog)])


def detections(docs: DataFrame, text: str = "text", catalog: list[Rule] | None = None) -> DataFrame:
    """``docs`` with ``_n_words`` and ``_found``: kept detections (start, end in words, label, rule, base, confidence), by start."""
    catalog = catalog or rules()
    n_base = len(BASE)
    df = once(docs, "_normal", normal_form(F.col(text)))
    # pieces between a rule's matches give the places: a piece or a match has half as many words as spaces
    words = "CAST((length({0}) - length(replace({0}, ' ', ''))) div 2 AS int)"
    spans = f"""
      flatten(transform(filter(_rules, r -> array_contains(_gates, r.gate) AND forall(r.keywords, k -> contains(_normal, k))), r ->
        transform(
          aggregate(
            arrays_zip(split(_normal, r.pattern, -1), regexp_extract_all(_normal, r.pattern, 0)),
            struct(0 AS at, CAST(array() AS array<struct<start:int,end:int>>) AS got),
            (a, p) -> struct(
              a.at + {words.format("p['0']")} + coalesce({words.format("p['1']")}, 0) AS at,
              CASE WHEN p['1'] IS NULL THEN a.got ELSE concat(a.got, array(struct(
                a.at + {words.format("p['0']")} AS start, a.at + {words.format("p['0']")} + {words.format("p['1']")} AS end))) END AS got)).got,
          s -> struct(s.start AS start, s.end AS end, r.priority AS priority, r.id AS id, r.label AS label, r.confidence AS confidence))))"""
    none = "CAST(array() AS array<struct<start:int,end:int,priority:int,id:int,label:string,confidence:double>>)"
    gates = F.array(*[F.lit(w) for w in sorted({r.gate for r in catalog})])
    df = once(df, "_gates", F.array_intersect(F.split(F.col("_normal"), "  "), gates))
    df = df.withColumn("_rules", rule_table(catalog))
    df = once(df, "_all", F.expr(f"CASE WHEN size(_gates) > 0 THEN {spans} ELSE {none} END"))
    kept = F.expr(f"""
      array_sort(filter(_all, s -> s.id < {n_base} OR NOT exists(_all, t ->
        t.start <= s.start AND t.end >= s.end AND t.id <> s.id AND
        (t.priority > s.priority OR (t.priority = s.priority AND (t.end - t.start > s.end - s.start OR t.id < s.id))))))""")
    df = df.withColumn("_n_words", F.expr("greatest((length(_normal) - length(replace(_normal, ' ', ''))) div 2 - 1, 0)"))
    return once(df, "_found", kept).drop("_normal", "_rules", "_gates", "_all")


def license_report(docs: DataFrame, key: str = "doc_id", text: str = "text", catalog: list[Rule] | None = None) -> DataFrame:
    found = detections(docs.select(key, text), text, catalog)
    base = F.expr(f"filter(_found, s -> s.id < {len(BASE)})")
    labels = F.array_join(F.array_sort(F.array_distinct(F.transform("_found", lambda s: s["label"]))), ",")
    base_labels = F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda s: s["label"]))), ",")
    # chance that at least one detection is right, each taken by itself
    score = 1 - F.aggregate("_found", F.lit(1.0), lambda a, s: a * (1 - s["confidence"]))
    return found.select(
        key, F.col("_n_words").cast("long").alias("n_words"), F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda s: s["start"])).cast("long").alias("first_word"), F.array_max(F.transform(base, lambda s: s["start"])).cast("long").alias("last_word"),
        base_labels.alias("base_labels"), labels.alias("labels"), F.round(score, 9).alias("score"), F.size("_found").cast("long").alias("n_found"))
