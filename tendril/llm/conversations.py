"""Structure of conversations: faults of turns, and the cheapest edits that give system?, (user, assistant)+.

A conversation's rows stand in the order of turn (nulls first), then role, then text. A row's first fault counts: blank (no
visible character), duplicate (role and text stood before), truncated (the last visible character ends no sentence). Edits:
D deletes a row (2), I inserts a turn without text (5), K keeps a row, R gives it the role user or assistant (1); blank and
duplicate rows must go, a truncated row that stays costs 5 more. The initials of the roles must then read ``(s?(ua)+)?``.

The edits are found by iterative-deepening A*: depth first, in ASCII order of the edits' letters, under a bound that rises by
one; a table of failed states (row, place in the pattern) holds the budget that did not suffice there. The first path that is
accepted is the cheapest, and of these the least in ASCII order. What each state still allows is a single role, so the letters
alone fix the result.

Conversations of up to ``BLOCK`` rows are searched whole. Longer ones are cut into blocks spread over all tasks. For a block,
the search runs from each place of the pattern at which it may be entered to each at which it may be left; one pass over the
blocks in order joins them, keeping the cheapest and least path to each place. (Of two paths of a block with the same ends and
cost, none begins with the other, as the longer would have further insertions; so the least path of the whole is made of least
paths of blocks.) Duplicates across blocks are found by an aggregation over digests and a join. That last pass is one task a
conversation, as a digest over a conversation's text has to be; it streams blocks, and holds four paths and the table of choices.

Null roles and texts count as one space, which makes a text blank. A role of no character can't be kept. Null conv_id is a
conversation of its own. Repeated rows are duplicates. An empty table gives no rows; further columns are not touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import record_batches

BLOCK = 32
DELETE, INSERT, KEEP, REROLE, UNFINISHED = 2, 5, 0, 1, 5
# Places in the pattern: 0 before anything, 1 after a system turn, 2 after a user turn, 3 after an assistant turn.
ACCEPTED = (0, 3)
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = ("user", "user", "assistant", "user")
AFTER = (2, 2, 3, 2)
SPACE = " \t\n\x0b\x0c\r"


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with the faults that the checksum of ``conv_id:turn`` deals out; nulls read as one space."""
    def read(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", read("role").alias("role"), read("text").alias("text"), dealt.alias("dealt"))
    role = F.when(F.col("dealt") == 4, "user").otherwise(F.col("role"))
    text = F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("dealt") == 0, 0).when(F.col("dealt") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times")).select(
        "conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(True), F.col("times"))).alias("copy")).drop("copy")


def search(rows: list[tuple[str, str]], entry: int, exits: tuple[int, ...]) -> tuple[int, int, str] | None:
    """(cost, place, edits) of the cheapest edits of ``rows`` (initial, fault) from the place ``entry`` to one of ``exits``."""
    n = len(rows)
    if not {2, 3} & set(exits):
        # only deletions stay at 0 or 1; a system turn that may be kept leads from 0 to 1
        if entry not in exits and not (entry == 0 and 1 in exits and any(r == "s" and f not in "bd" for r, f in rows)):
            return None
    owed = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        owed[i] = owed[i + 1] + (DELETE if rows[i][1] != "-" else 0)
    left = [0 if q in exits else INSERT for q in range(4)]
    failed: dict[tuple[int, int], int] = {}
    bound = owed[0]
    while True:
        stack = [(0, entry, 0, "")]
        while stack:
            i, q, cost, path = stack.pop()
            budget = bound - cost
            if budget < (owed[i] if i < n else left[q]) or failed.get((i, q), -1) >= budget:
                continue
            if i == n and q in exits:
                return cost, q, path
            failed[i, q] = budget
            # pushed in reverse: the stack gives D, I, K, R
            if i < n:
                initial, fault = rows[i]
                if fault not in "bd":
                    more = UNFINISHED if fault == "t" else 0
                    stack.append((i + 1, AFTER[q], cost + REROLE + more, path + "R"))
                    kept = KEPT.get((q, initial))
                    if kept is not None:
                        stack.append((i + 1, kept, cost + KEEP + more, path + "K"))
            stack.append((i, AFTER[q], cost + INSERT, path + "I"))
            if i < n:
                stack.append((i + 1, q, cost + DELETE, path + "D"))
        bound += 1


def edited(edits: str, entry: int, roles: list[str], texts: list[str]) -> list[tuple[int | None, str, str]]:
    """(row or None, role, text) of the turns that ``edits`` leave or make."""
    out, i, q = [], 0, entry
    for e in edits:
        if e == "K":
            out.append((i, roles[i], texts[i]))
            q = KEPT[q, roles[i][:1]]
        elif e != "D":
            out.append((None, WANTED[q], "") if e == "I" else (i, WANTED[q], texts[i]))
            q = AFTER[q]
        i += e != "I"
    return out


def _fault(text: str, again: bool) -> str:
    seen = text.rstrip(SPACE)
    return "b" if not seen else "d" if again else "-" if seen[-1] in ".!?" else "t"


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))


class _Digest:
    """Running digest of newline-joined turns; can go on in several ways from the same beginning."""

    def __init__(self, state=None, begun: bool = False):
        self.state, self.begun = state or hashlib.sha256(), begun

    def then(self, turns: list[tuple[int | None, str, str]]) -> _Digest:
        nxt = _Digest(self.state.copy(), self.begun or bool(turns))
        if turns:
            nxt.state.update((("\n" if self.begun else "") + "\n".join(f"{r}:{t}" for _, r, t in turns)).encode("utf-8", "surrogatepass"))
        return nxt


def _groups(batches: Iterator[pa.RecordBatch], width: int, most: int | None = None) -> Iterator[tuple[tuple, int, list[tuple]]]:
    """(key, number of the part, rows) of rows sorted by their first ``width`` columns, in parts of at most ``most`` rows."""
    key, part, rows = None, 0, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if key != row[:width] or (most and len(rows) == most):
                if rows:
                    yield key, part, rows
                part, rows = (part + 1 if key == row[:width] else 0), []
                key = row[:width]
            rows.append(row[width:])
    if rows:
        yield key, part, rows


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, steps array<struct<block: long, part: long, entry: int, edits: string>>"
STEPS = pa.list_(pa.struct([("block", pa.int64()), ("part", pa.int64()), ("entry", pa.int32()), ("edits", pa.string())]))
REPORT_TYPES = [pa.int64()] * 6 + [pa.string(), pa.string(), STEPS]


def _whole(id_type: pa.DataType):
    """Rows (conv_id, turn, role, text) of whole, short conversations to their reports."""
    def report(rows):
        turns, roles, texts = (list(x) for x in zip(*rows, strict=True))
        seen, faults = set(), []
        for r, t in zip(roles, texts, strict=True):
            faults.append(_fault(t, (r, t) in seen))
            seen.add((r, t))
        cost, _, edits = search([(r[:1], f) for r, f in zip(roles, faults, strict=True)], 0, ACCEPTED)
        known = [t for t in turns if t is not None]
        gaps = known[-1] - known[0] + 1 - len(set(known)) if known else 0
        digest = _Digest().then(edited(edits, 0, roles, texts)).state.hexdigest()
        return gaps, *[faults.count(f) for f in "bdt"], _illegal(roles), cost, edits, digest, [{"block": 0, "part": 0, "entry": 0, "edits": edits}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from record_batches(((key[0], *report(rows)) for key, _, rows in _groups(batches, 1)), ["conv_id", *[f.split()[0] for f in REPORT.split(", ")[:8]], "steps"], [id_type, *REPORT_TYPES])
    return run


BLOCKS = "block long, part long, turns array<long>, roles array<string>, texts array<string>, faults string, paths array<struct<entry: int, place: int, cost: long, edits: string>>"
PATHS = pa.list_(pa.struct([("entry", pa.int32()), ("place", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))


def _blocks(id_type: pa.DataType):
    """Rows (conv_id, block, turn, role, text, later) of long conversations to blocks with their paths."""
    def made(batches):
        last = None
        for key, part, rows in _groups(batches, 2, BLOCK):
            turns, roles, texts, later = (list(x) for x in zip(*rows, strict=True))
            faults = ""
            for t, r, x, again in zip(turns, roles, texts, later, strict=True):
                faults += _fault(x, again or last == (key, t, r, x))
                last = (key, t, r, x)
            read = [(r[:1], f) for r, f in zip(roles, faults, strict=True)]
            paths = []
            for entry in range(4):
                for place in range(4):
                    if found := search(read, entry, (place,)):
                        paths.append({"entry": entry, "place": place, "cost": found[0], "edits": found[2]})
            yield *key, part, turns, roles, texts, faults, paths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.list_(pa.string())
        yield from record_batches(made(batches), ["conv_id", "block", "part", "turns", "roles", "texts", "faults", "paths"],
                            [id_type, pa.int64(), pa.int64(), pa.list_(pa.int64()), texts, texts, pa.string(), PATHS], 64)
    return run


def _chain(id_type: pa.DataType):
    """Blocks of whole conversations, in order, to reports."""
    def conversations(batches):
        key, state = None, None
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if state is None or row[0] != key:
                    if state:
                        yield key, *finish(state)
                    # (cost, edits, digest, choice) at each place that can be reached
                    key, state = row[0], {"at": {0: (0, "", _Digest(), None)}, "count": [0, 0, 0, 0], "turns": [None, None, 0], "role": None}
                follow(state, *row[1:])
        if state:
            yield key, *finish(state)

    def follow(state, block, part, turns, roles, texts, faults, paths):
        best = {}
        for p in paths:
            if p["entry"] in state["at"]:
                cost, edits = state["at"][p["entry"]][:2]
                found = (cost + p["cost"], edits + p["edits"])
                if p["place"] not in best or found < best[p["place"]][:2]:
                    best[p["place"]] = (*found, p)
        now = {}
        for place, (cost, edits, p) in best.items():
            before = state["at"][p["entry"]]
            now[place] = (cost, edits, before[2].then(edited(p["edits"], p["entry"], roles, texts)), (before[3], {"block": block, "part": part, "entry": p["entry"], "edits": p["edits"]}))
        state["at"] = now
        for i, f in enumerate("bdt"):
            state["count"][i] += faults.count(f)
        state["count"][3] += _illegal(([state["role"]] if state["role"] is not None else []) + roles)
        state["role"] = roles[-1]
        first, last, n = state["turns"]
        for t in turns:
            if t is not None and t != last:
                first, last, n = t if first is None else first, t, n + 1
        state["turns"] = [first, last, n]

    def finish(state):
        cost, edits, digest, choice = min((state["at"][q] for q in ACCEPTED if q in state["at"]), key=lambda x: x[:2])
        steps = []
        while choice:
            choice, step = choice
            steps.append(step)
        first, last, n = state["turns"]
        return last - first + 1 - n if n else 0, *state["count"], cost, edits, digest.state.hexdigest(), steps[::-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from record_batches(conversations(batches), ["conv_id", *[f.split()[0] for f in REPORT.split(", ")[:8]], "steps"], [id_type, *REPORT_TYPES], 16)
    return run


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on equal columns, null equal to null; the columns of ``on`` are the left ones."""
    renamed = right.select(*[F.col(c).alias(f"right_{c}" if c in on else c) for c in right.columns])
    return left.join(renamed, reduce(and_, [F.col(c).eqNullSafe(F.col(f"right_{c}")) for c in on]), how).drop(*[f"right_{c}" for c in on])


def _id(rows: DataFrame) -> tuple[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    return f"conv_id {kind.simpleString()}", to_arrow_type(kind)


def _parts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of conversations of up to BLOCK rows, and blocks with their paths of the longer ones."""
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    long = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK).select("conv_id")
    short = _join(rows, long, ["conv_id"], "left_anti")
    rest = _join(rows, long, ["conv_id"], "left_semi").withColumn("digest", F.sha2(F.concat_ws("\n", F.octet_length("role"), "role", "text"), 256))
    # nulls stand before every turn
    first = rest.groupBy("conv_id", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    seen = _join(rest, first, ["conv_id", "digest"]).select(
        "conv_id", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).cast("long").alias("block"), "turn", "role", "text",
        (F.struct(F.col("turn").isNotNull().alias("known"), "turn") > F.col("first")).alias("later"))
    name, kind = _id(rows)
    blocks = seen.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "turn", "role", "text").mapInArrow(_blocks(kind), f"{name}, {BLOCKS}")
    return short, blocks


def repair(rows: DataFrame) -> DataFrame:
    """One row per conv_id of ``rows`` (conv_id, turn, role, text): gaps in turns, counts of faults, adjacent roles that don't
    follow each other, the edits (``audit``), their cost, the digest of the repaired turns, and ``steps``: the edits block by block."""
    name, kind = _id(rows)
    short, blocks = _parts(rows)
    whole = short.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(_whole(kind), f"{name}, {REPORT}")
    chained = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part").mapInArrow(_chain(kind), f"{name}, {REPORT}")
    return whole.unionByName(chained)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place, turn, edit, role, text), places from 0 in order; inserted turns have no turn number."""
    name, kind = _id(rows)
    short, blocks = _parts(rows)
    steps = repair(rows).select("conv_id", F.inline("steps"))
    held = short.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("rows")).select(
        "conv_id", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("part"), F.col("rows.turn").alias("turns"), F.col("rows.role").alias("roles"), F.col("rows.text").alias("texts"))
    held = held.unionByName(blocks.select("conv_id", "block", "part", "turns", "roles", "texts"))
    joined = _join(held, steps, ["conv_id", "block", "part"]).select("conv_id", "block", "part", "turns", "roles", "texts", "entry", "edits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns():
            for batch in batches:
                for conv, block, part, numbers, roles, texts, entry, edits in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    letters = [e for e in edits if e != "D"]
                    for at, ((i, role, text), e) in enumerate(zip(edited(edits, entry, roles, texts), letters, strict=True)):
                        yield conv, block, part, at, None if i is None else numbers[i], e, role, text
        yield from record_batches(turns(), ["conv_id", "block", "part", "at", "turn", "edit", "role", "text"], [kind, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()])
    made = joined.mapInArrow(run, f"{name}, block long, part long, at long, turn long, edit string, role string, text string")
    before = made.groupBy("conv_id", "block", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("conv_id", "block", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return _join(made, before, ["conv_id", "block", "part"]).select(
        "conv_id", (F.col("before") + F.col("at")).alias("place"), "turn", "edit", "role", "text")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damage ``conversations``, repair them, and report on every conversation, also on those of which nothing is left."""
    report = repair(damage(conversations)).drop("steps")
    ids = conversations.select("conv_id").distinct()
    joined = _join(ids, report, ["conv_id"], "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def report_sql(source: str = "conversations") -> str:
    """DuckDB SQL of ``repair_report``: cheapest paths to the four places of the pattern, row by row; its checksum is built from the bits of each byte."""
    def step(letter: str, cost: str, turn: str, place: int) -> str:
        return f"CASE WHEN p{place}.c IS NOT NULL THEN {{'c': p{place}.c + {cost}, 'e': p{place}.e || '{letter}', 't': {turn}}} END"

    def added(place: int, turn: str) -> str:
        return f"list_append(p{place}.t, {turn})"

    def least(*choices: str) -> str:
        return f"list_sort(list_filter([{', '.join(choices)}], lambda x: x IS NOT NULL))[1]"
    stay = "CASE WHEN must THEN NULL ELSE {} END"
    unfinished = "CASE WHEN fault = 't' THEN 5 ELSE 0 END"

    def keep(place: int, initial: str) -> str:
        return f"CASE WHEN NOT must AND role[1] = '{initial}' THEN {step('K', unfinished, added(place, "role || ':' || text"), place)} END"

    def rerole(place: int) -> str:
        return stay.format(step("R", f"1 + {unfinished}", added(place, f"'{WANTED[place]}:' || text"), place))

    def deleted(place: int) -> str:
        return step("D", "2", f"p{place}.t", place)

    def insert(place: int) -> str:
        return step("I", "5", added(place, f"'{WANTED[place]}:'"), place)
    return f"""
WITH RECURSIVE bytes AS (SELECT i, CASE WHEN i & 1 = 1 THEN xor(i >> 1, 3988292384) ELSE i >> 1 END AS c, 1 AS k FROM (SELECT unnest(range(256))::BIGINT AS i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bytes WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bytes WHERE k = 8),
dealt AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda a, b: xor(a >> 8, crc_table.t[(xor(a, b) & 255) + 1]))) % 20 AS h FROM {source}, crc_table),
damaged AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM dealt WHERE h <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
faults AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS role_before, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS copies FROM numbered),
marked AS (SELECT *, fault IN ('b', 'd') AS must FROM (SELECT *, CASE WHEN seen = '' THEN 'b' WHEN copies > 1 THEN 'd' WHEN right(seen, 1) IN ('.', '!', '?') THEN '-' ELSE 't' END AS fault FROM faults)),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
  count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (i > 1 AND role_before[1] || role[1] NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM marked GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM {source}),
-- before row i: the cheapest path to each place, insertions not yet made
paths AS (SELECT conv_id, 1::BIGINT AS i, {{'c': 0, 'e': '', 't': []::VARCHAR[]}} AS p0, NULL::STRUCT(c INTEGER, e VARCHAR, t VARCHAR[]) AS p1, NULL::STRUCT(c INTEGER, e VARCHAR, t VARCHAR[]) AS p2,
    NULL::STRUCT(c INTEGER, e VARCHAR, t VARCHAR[]) AS p3 FROM ids
  UNION ALL
  SELECT conv_id, i + 1, {deleted(0)}, {least(deleted(1), keep(0, 's'))}, {least(deleted(2), keep(0, 'u'), keep(1, 'u'), keep(3, 'u'), rerole(0), rerole(1), rerole(3))}, {least(deleted(3), keep(2, 'a'), rerole(2))}
  FROM (SELECT conv_id, i, p0, p1, p2, {least('p3', insert(2))} AS p3, must, fault, role, text FROM (
    SELECT q.conv_id, q.i, p0, p1, {least('p2', insert(0), insert(1), insert(3))} AS p2, p3, must, fault, role, text FROM paths AS q JOIN marked AS m ON m.conv_id IS NOT DISTINCT FROM q.conv_id AND m.i = q.i))),
ends AS (SELECT conv_id, {least('p0', 'p3', insert(2))} AS best FROM (
  SELECT p.conv_id, p0, {least('p2', insert(0), insert(1))} AS p2, p3 FROM paths AS p LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM p.conv_id WHERE p.i = coalesce(c.n, 0) + 1))
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.e AS audit, sha256(array_to_string(best.t, chr(10))) AS repaired_sha256
FROM ends AS e LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""
