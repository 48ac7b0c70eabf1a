"""String column functions beyond one built-in call."""

from __future__ import annotations

import functools
import sys
import textwrap
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def swap_case(c: Column) -> Column:
    flipped = F.transform(F.split(c, ""), lambda x: F.when(x == F.upper(x), F.lower(x)).otherwise(F.upper(x)))
    return F.array_join(flipped, "")


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def rfind(c: Column, sub: str) -> Column:
    """0-based position of the last occurrence, -1 if there is none."""
    at = F.locate(sub[::-1], F.reverse(c))
    return F.when(at == 0, -1).otherwise(F.length(c) - at - len(sub) + 1)


def find(c: Column, sub: str) -> Column:
    return F.locate(sub, c) - 1


def extract_all(df: DataFrame, column: str, pattern: str, names: list[str], match: str = "match") -> DataFrame:
    """One row per match with a column per capture group; rows without a match give none."""
    whole = df.select("*", F.posexplode(F.regexp_extract_all(F.col(column), F.lit(pattern), F.lit(0))).alias(match, "_m"))
    groups = [F.regexp_extract("_m", pattern, i + 1).alias(n) for i, n in enumerate(names)]
    return whole.select(*df.columns, match, *groups)


@functools.cache
def _foldings() -> tuple[str, str, str]:
    """(from, to, rest): letters that fold to one character, with marks that fold to none last, and a pattern of what folds to several."""
    one, none, rest = [], [], []
    for n in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= n <= 0xDFFF:
            continue
        folded = _fold(chr(n))
        if folded == chr(n):
            continue
        if len(folded) > 1 or n > 0x2FFF:
            if rest and rest[-1][1] == n - 1:
                rest[-1][1] = n
            else:
                rest.append([n, n])
        elif folded:
            one.append((chr(n), folded))
        else:
            none.append(chr(n))
    return "".join(a for a, _ in one) + "".join(none), "".join(b for _, b in one), _among(rest)


def _among(ranges: list[list[int]]) -> str:
    """Pattern of one character out of ``ranges`` beyond ASCII; an ASCII one is turned down by the first test, not by each range's."""
    return "[\\x{80}-\\x{10FFFF}&&[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]]"


@functools.cache
def _unsettled(form: str) -> str:
    """Pattern of the characters without which a text is in ``form`` already: those it changes, marks, and what joins with the one before."""
    joins = {ord(x) for n in range(0x80, sys.maxunicode + 1) if not 0xD800 <= n <= 0xDFFF for x in unicodedata.normalize("NFD", chr(n))[1:]}
    ranges = []
    for n in range(0x80, sys.maxunicode + 1):
        if not 0xD800 <= n <= 0xDFFF and (n in joins or unicodedata.combining(chr(n)) or unicodedata.normalize(form, chr(n)) != chr(n)):
            if ranges and ranges[-1][1] == n - 1:
                ranges[-1][1] = n
            else:
                ranges.append([n, n])
    return _among(ranges)


def _fold(text: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", text) if not unicodedata.combining(x))


def strip_accents(c: Column) -> Column:
    """Drop combining marks after canonical decomposition.

    Characters with a single counterpart are translated; only texts with others go to Python, the rest are sent as null.
    """

    @F.pandas_udf("string")
    def folded(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else _fold(v))

    letters, bases, several = _foldings()
    # each test reads the text as it came, so a text is translated at most once, and one of ASCII never
    more = c.rlike(several)
    plain = F.when(c.rlike("[^\\x00-\\x7F]"), F.translate(c, letters, bases)).otherwise(c)
    return F.when(more, folded(F.when(more, c))).otherwise(plain)


def normalize(c: Column, form: str = "NFC") -> Column:
    """Unicode normal form; only texts with a character that it concerns go to Python, the rest are sent as null."""

    @F.pandas_udf("string")
    def normal(s: pd.Series) -> pd.Series:
        return s.str.normalize(form)

    open_ = c.rlike(_unsettled(form))
    return F.when(open_, normal(F.when(open_, c))).otherwise(c)


def wrap(c: Column, width: int) -> Column:
    @F.pandas_udf("string")
    def wrapped(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else "\n".join(textwrap.wrap(v, width)))

    return wrapped(c)
