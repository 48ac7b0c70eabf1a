"""Repair of conversations against an exhaustive search over edits, the SQL, and rows of every odd kind."""

import hashlib
import heapq
import re
import zlib
from collections import defaultdict

import pytest

from tendril.llm import conversations as C
from tendril.llm.queries import ORACLES, QUERIES
from tools.check import compare, connect

ROOT = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, start string, block long, later int, steps string"
SHAPE = re.compile(r"(s?(ua)+)?")


def plain(rows):
    """Cheapest edits by uniform-cost search over whole edit strings, least string first; rows: (role, text)."""
    seen, faults = set(), []
    for role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        faults.append("b" if not last else "d" if (role, text) in seen else "-" if last in ".!?" else "t")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, i, initials, turns = heapq.heappop(heap)
        if i == len(rows) and SHAPE.fullmatch(initials):
            return cost, edits, hashlib.sha256("\n".join(turns).encode()).hexdigest(), faults
        # what is still possible depends on the row and on the initials' last letter only
        if (i, initials[-1:]) in done:
            continue
        done.add((i, initials[-1:]))
        more = []
        if i < len(rows):
            role, text = rows[i]
            more.append((2, "D", 1, None))
            if faults[i] in "-t":
                extra = 5 * (faults[i] == "t")
                more += [(extra, "K", 1, (role, text)), *[(1 + extra, "R", 1, (r, text)) for r in ("user", "assistant")]]
        more += [(5, "I", 0, (r, "")) for r in ("user", "assistant")]
        for price, letter, step, turn in more:
            now = initials + (turn[0][:1] if turn else "")
            if turn and (not turn[0] or not re.fullmatch(r"s?(ua)*u?", now)):
                continue
            heapq.heappush(heap, (cost + price, edits + letter, i + step, now, (*turns, f"{turn[0]}:{turn[1]}") if turn else turns))
    raise AssertionError


def expected(table):
    """Report of rows (conv_id, turn, role, text), by plain Python."""
    groups = defaultdict(list)
    for conv, turn, role, text in table:
        groups[conv]
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h:
            row = (turn is not None, turn or 0, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)
            groups[conv] += [row] * (2 if h == 3 else 1)
    out = {}
    for conv, rows in groups.items():
        rows.sort()
        turns = {t for known, t, _, _ in rows if known}
        cost, edits, digest, faults = plain([r[2:] for r in rows])
        initials = [r[2][:1] for r in rows]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in "bdt"],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, edits, digest)
    return out


def reported(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


ODD = [
    (1, None, "user", "Hello."), (1, None, "user", "Hello."), (1, 0, None, "A?"), (1, 1, "assistant", None), (2, 5, "tool", "x."), (2, 5, "tool", "y"), (2, 9, "", "z."), (3, 0, "system", "Only."),
    (None, 0, "user", "q."), (None, None, "assistant", "r."), (4, 0, "user", "  \t\n"), (5, 0, "user", "long " * 50_000 + "."), (5, 1, "assistant", "é日本."), (6, None, None, None),
    (7, 3, "user", "a "), (7, 4, "assistant", "b!\r\n"), *[(8, t, ("user", "assistant", "system")[t * 7 % 3], f"t{t % 40}" + ".?x"[t % 3]) for t in range(150)], *[(9, 0, "user", f"same turn {i % 50}.") for i in range(120)],
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "x", 1, 2, "s") for r in ODD], SCHEMA)


@pytest.mark.parametrize("rows", [[], [("s", "-")], [("a", "-"), ("u", "t")], [("u", "-"), ("u", "-"), ("a", "b"), ("s", "-")], [("t", "-")] * 5])
def test_search_is_cheapest_and_least(rows):
    roles = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    texts = [(roles[r], {"-": f"{i}.", "t": f"{i}", "b": " "}[f]) for i, (r, f) in enumerate(rows)]
    cost, edits, _, _ = plain(texts)
    assert C.search(rows, 0, C.ACCEPTED)[::2] == (cost, edits)


def test_report_against_exhaustive_search(spark, odd):
    assert reported(C.repair_report(odd)) == expected(ODD)
    table = spark.read.parquet(f"{ROOT}/conversations.parquet")
    assert reported(C.repair_report(table)) == expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_blocks_do_not_change_the_result(odd, monkeypatch):
    for size in (2, 5, 1000):
        monkeypatch.setattr(C, "BLOCK", size)
        assert reported(C.repair_report(odd)) == expected(ODD)


def test_sql(spark, odd):
    same, why, _ = compare(QUERIES["op11_conversation_repair"](spark, ROOT), ORACLES["op11_conversation_repair"], connect(ROOT))
    assert same, why
    con = connect(ROOT)
    con.register("odd_rows", odd.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    same, why, _ = compare(C.repair_report(odd), C.report_sql("odd_rows"), con)
    assert same, why


def test_repaired_turns_make_the_digest(odd):
    rows = C.damage(odd)
    turns = defaultdict(list)
    for r in C.repaired_turns(rows).collect():
        turns[r.conv_id].append((r.place, r.role, r.text, r.edit))
    for r in C.repair(rows).collect():
        got = sorted(turns[r.conv_id])
        assert [x[0] for x in got] == list(range(len(got)))
        assert "".join(x[3] for x in got) == r.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{x[1]}:{x[2]}" for x in got).encode()).hexdigest() == r.repaired_sha256


def test_empty_table(odd):
    assert C.repair_report(odd.limit(0)).count() == 0 and C.repaired_turns(odd.limit(0)).count() == 0
