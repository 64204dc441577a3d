"""Conversation structure repair by divide and conquer.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles. Rows are
kept, given another role, deleted or inserted at least cost. Four states follow
the grammar, and every run of rows is a 4 x 4 table: the least cost from each
state to each, and the order of the edit strings behind these costs. Tables of
neighbouring runs combine, so the middle crossing of the cheapest repair is
found from a forward and a backward vector of four, and each half is solved for
itself (Hirschberg), in space linear in the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatt.llm.shared import stored

#: Costs of the edits, and of leaving a truncated row in place (fixed by the contract).
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAULTS = ("", "blank", "duplicate", "truncated")
#: States: nothing yet, after the system row, after a user row, after an assistant row.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_ROLE = {"u": "user", "a": "assistant"}
_ENDS = (0, 3)
_NEVER = 1 << 60
#: Pairs of neighbouring initials that are as they should be.
_FINE = ("su", "ua", "au")
#: Rows of a conversation that are solved together.
_SEGMENT = 8192

Table = tuple[tuple[tuple[int, int], ...], ...]


def _inserted(state: int) -> Iterator[tuple[str, int]]:
    """No, one or two inserted rows from ``state`` on: their edits and the state
    they lead to. More never pay, as two lead back to where one was."""
    edits = ""
    yield edits, state
    for _ in range(2):
        state = _NEXT[state].get("a", _NEXT[state].get("u"))
        edits += "I"
        yield edits, state


@lru_cache(maxsize=None)
def row_options(code: str) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest edits (the least by ASCII among equals) of one row for each entry
    and exit state, inserted rows before it included. ``code``: the role's initial
    and the fault's number."""
    initial, fault = code[0], FAULTS[int(code[1])]
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        for edits, state in _inserted(start):
            cost = INSERT * len(edits)
            ways = [("D", state, DELETE)]
            if fault not in ("blank", "duplicate"):
                extra = TRUNCATED if fault == "truncated" else 0
                if initial in _NEXT[state]:
                    ways.append(("K", _NEXT[state][initial], extra))
                ways += [("R", to, REROLE + extra) for role, to in _NEXT[state].items() if role in _ROLE]
            for letter, to, more in ways:
                option = (cost + more, edits + letter)
                if option < found.get((start, to), (_NEVER, "")):
                    found[start, to] = option
    return found


@lru_cache(maxsize=None)
def row_table(code: str) -> Table:
    """The 4 x 4 table of one row: (cost, order of the edits among the exits)."""
    options = row_options(code)
    out = []
    for start in range(4):
        order = sorted(range(4), key=lambda to: options.get((start, to), (0, "~"))[1])
        out.append(tuple((options[start, to][0], order.index(to)) if (start, to) in options else (_NEVER, 9) for to in range(4)))
    return tuple(out)


def _forward(vector: list[tuple[int, int]], table: Table) -> list[tuple[int, int]]:
    """(cost, order) per state, one table further. Two edit strings that end with
    the same row in different states are never beginnings of each other, so the
    order of longer ones is that of what they begin with, then of the table's."""
    best: list[tuple[int, int, int]] = []
    for to in range(4):
        ways = [(cost + row[to][0], order, row[to][1]) for (cost, order), row in zip(vector, table) if cost < _NEVER and row[to][0] < _NEVER]
        best.append(min(ways, default=(_NEVER, 9, 9)))
    rank = {key: i for i, key in enumerate(sorted({x[1:] for x in best if x[0] < _NEVER}))}
    return [(x[0], rank[x[1:]]) if x[0] < _NEVER else (_NEVER, 9) for x in best]


def _backward(table: Table, vector: list[int]) -> list[int]:
    """Least cost from each state to the end, one table earlier."""
    return [min(min(cost + rest for (cost, _), rest in zip(row, vector)), _NEVER) for row in table]


def combined(tables: list[Table]) -> Table:
    """The table of neighbouring runs taken as one."""
    out = []
    for start in range(4):
        vector = [(0, 0) if s == start else (_NEVER, 9) for s in range(4)]
        for table in tables:
            vector = _forward(vector, table)
        out.append(tuple(vector))
    return tuple(out)


def crossings(tables: list[Table], start: int, end: int) -> list[int]:
    """States before, between and after the runs on the cheapest way from ``start``
    to ``end``, the audit-least among equals: the forward vector up to the middle
    and the backward vector from the end meet there, the crossing with the least
    sum and the least edits up to it is taken, and both halves follow."""
    if len(tables) < 2:
        return [start, end]
    half = len(tables) // 2
    ahead = [(0, 0) if s == start else (_NEVER, 9) for s in range(4)]
    for table in tables[:half]:
        ahead = _forward(ahead, table)
    back = [0 if s == end else _NEVER for s in range(4)]
    for table in reversed(tables[half:]):
        back = _backward(table, back)
    middle = min(range(4), key=lambda s: (ahead[s][0] + back[s], ahead[s][1]))
    return crossings(tables[:half], start, middle) + crossings(tables[half:], middle, end)[1:]


def finish(tables: list[Table]) -> tuple[int, int, str]:
    """(cost, state after the last row, inserted rows after it) of the cheapest
    repair of a whole conversation."""
    vector = [(0, 0), *[(_NEVER, 9)] * 3]
    for table in tables:
        vector = _forward(vector, table)
    ways = [(cost + INSERT * len(edits), order, edits, state) for state, (cost, order) in enumerate(vector) if cost < _NEVER
            for edits, last in _inserted(state) if last in _ENDS]
    cost, _, edits, state = min(ways)
    return cost, state, edits


def _edits(codes: tuple[str, ...], start: int, end: int) -> tuple[str, ...]:
    """Edits of each row of a run, from state ``start`` to ``end``."""
    states = crossings([row_table(c) for c in codes], start, end)
    return tuple(row_options(c)[way][1] for c, way in zip(codes, zip(states, states[1:])))


_short_edits = lru_cache(maxsize=50_000)(_edits)
_short_table = lru_cache(maxsize=50_000)(lambda codes: combined([row_table(c) for c in codes]))


def edits_of(codes: tuple[str, ...], start: int, end: int) -> tuple[str, ...]:
    """As ``_edits``; short runs, which are often alike, are remembered."""
    return _short_edits(codes, start, end) if len(codes) <= 32 else _edits(codes, start, end)


def table_of(codes: tuple[str, ...]) -> Table:
    return _short_table(codes) if len(codes) <= 32 else combined([row_table(c) for c in codes])


# -- rows ---------------------------------------------------------------------

def damaged(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
            faults: int = 20) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text``, ``dropped`` of every row after the planned
    damage: crc32 of ``conv_id:turn`` modulo ``faults`` is 0: dropped (the row stays
    here, marked), 1: text emptied, 2: its ``.!?`` removed, 3: the row twice, 4: the
    role is user. Nulls count as one space in that key, in role and in text."""
    conv, turn = F.col(conv_col), F.col(turn_col)
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(space(conv), F.lit(":"), space(turn))), F.lit(faults))
    rows = convs.select(conv.alias("conv"), turn.alias("turn"), space(F.col(role_col)).alias("role"), space(F.col(text_col)).alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (F.col("kind") == 0).alias("dropped"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"))
    return rows.select("conv", "turn", "role", "text", "dropped", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("again")).drop("again")


def _same(a: str, b: str, *cols: str) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows(conv, turn, role, sha, row_id, blank, open)`` with ``code``: the role's
    initial (a space for others than s, u and a) and the number of its first fault (0 none, 1 blank, 2 duplicate,
    3 truncated). The earliest row of equal role and text in a conversation is
    an aggregate joined back, so copies of any number never form a group."""
    place = F.struct(F.col("turn").isNotNull().alias("has"), "turn", "role", "sha", "row_id")
    firsts = rows.groupBy("conv", "sha").agg(F.min(place).alias("first"), F.count("*").alias("times")).filter("times > 1")
    joined = rows.alias("a").join(firsts.alias("b"), _same("a", "b", "conv", "sha"), "left")
    later = F.col("b.first").isNotNull() & (F.col("b.first.row_id") != F.col("a.row_id"))
    fault = F.when(F.col("a.blank"), 1).when(later, 2).when(F.col("a.open"), 3).otherwise(0)
    initial = F.substring(F.col("a.role"), 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise(" ")
    return joined.select(*[F.col(f"a.{c}").alias(c) for c in ("conv", "turn", "role", "sha", "row_id")],
                         F.concat(initial, fault.cast("string")).alias("code"))


_SEGMENT_SCHEMA = ("part int, number long, turns long, low string, high string, nulls boolean, blank long, duplicate long, truncated long, "
                   "illegal long, head string, tail string, costs array<long>, codes array<string>, row_ids array<long>")


def _segments(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place → one row per run of at most ``size``
    rows of a conversation, numbered in order within the partition."""
    names = ["conv", "part", "number", "turns", "low", "high", "nulls", "blank", "duplicate", "truncated", "illegal", "head", "tail", "costs", "codes", "row_ids"]
    types = [None, pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), *[pa.int64()] * 4, pa.string(), pa.string(),
             pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64())]
    number, out = 0, []

    def closed(conv, part, rows):
        nonlocal number
        codes, turns = tuple(r[1] for r in rows), [r[0] for r in rows if r[0] is not None]
        fault = [sum(c[1] == str(k) for c in codes) for k in (1, 2, 3)]
        illegal = sum(a[0] + b[0] not in _FINE for a, b in zip(codes, codes[1:]))
        table = [x for row in table_of(codes) for cell in row for x in cell]
        number += 1
        # turns are sorted, so distinct ones are changes; those at the ends may go on in the next run
        out.append((conv, part, number, sum(a != b for a, b in zip(turns, turns[1:])) + bool(turns), str(turns[0]) if turns else None,
                    str(turns[-1]) if turns else None, len(turns) < len(rows), *fault, illegal, codes[0][0], codes[-1][0], table, list(codes), [r[2] for r in rows]))

    def flushed() -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    held, of, at = [], None, None
    for b in batches:
        types[0] = b.schema.types[0]
        for conv, part, turn, code, row_id in zip(*(c.to_pylist() for c in b.columns)):
            if held and (conv != of or len(held) >= size):
                closed(of, at, held)
                held = []
                if len(out) >= 4096 or len(out[-1][-1]) >= size:
                    yield flushed()
            of, at = conv, part
            held.append((turn, code, row_id))
    if held:
        closed(of, at, held)
    if out:
        yield flushed()


def segments(rows: DataFrame, size: int = _SEGMENT) -> DataFrame:
    """``rows(conv, turn, role, sha, row_id, code)`` range-sorted by conversation
    and place → runs of at most ``size`` rows with their tables. A conversation
    longer than a partition or a run has several, so none is ever one task's."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "sha", "row_id"]
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        "conv", F.spark_partition_id().alias("part"), "turn", "code", "row_id")
    return dealt.mapInArrow(lambda b: _segments(b, size), f"conv {dealt.dtypes[0][1]}, {_SEGMENT_SCHEMA}")


def _table(costs: list[int]) -> Table:
    cells = list(zip(costs[::2], costs[1::2]))
    return tuple(tuple(cells[4 * i:4 * i + 4]) for i in range(4))


_FOLD_SCHEMA = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, seen long, part int, number long, entry int, exit int, after string")


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by conversation and order → the states at which each run is
    entered and left; the first run's row also carries the conversation's figures."""
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "seen", "part", "number", "entry", "exit", "after"]
    types = [None, *[pa.int64()] * 7, pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
    out = []

    def closed(runs: list[dict]) -> None:
        tables = [_table(r["costs"]) for r in runs]
        cost, end, after = finish(tables)
        states = crossings(tables, 0, end)
        timed = [r for r in runs if r["low"] is not None]
        distinct = sum(r["turns"] for r in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
        gaps = int(timed[-1]["high"]) - int(timed[0]["low"]) + 1 - distinct if timed else 0
        illegal = sum(r["illegal"] for r in runs) + sum(a["tail"] + b["head"] not in _FINE for a, b in zip(runs, runs[1:]))
        seen = 0
        for i, r in enumerate(runs):
            figures = (gaps, *(sum(x[k] for x in runs) for k in ("blank", "duplicate", "truncated")), illegal, cost) if not i else (None,) * 6
            out.append((r["conv"], *figures, seen, r["part"], r["number"], states[i], states[i + 1], after if i == len(runs) - 1 else ""))
            seen += 1

    def flushed() -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    held: list[dict] = []
    for b in batches:
        types[0] = b.schema.types[0]
        for r in b.to_pylist():
            if held and r["conv"] != held[0]["conv"]:
                closed(held)
                held = []
                if len(out) >= 8192:
                    yield flushed()
            held.append(r)
    if held:
        closed(held)
    if out:
        yield flushed()


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs with their entry and exit states → every edit in order: ``place``
    within the run, its letter, the new role, and the row it is about (null: inserted)."""
    for b in batches:
        types, out = [b.schema.field("conv").type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()], []
        for r in b.to_pylist():
            place, state = 0, r["entry"]
            steps = zip(edits_of(tuple(r["codes"]), r["entry"], r["exit"]), r["codes"], r["row_ids"])
            for edits, code, row_id in [*steps, (r["after"], None, None)]:
                for letter in edits:
                    role = None
                    if letter in "IR":
                        initial = "a" if "a" in _NEXT[state] else "u"
                        role, state = _ROLE[initial], _NEXT[state][initial]
                    elif letter == "K":
                        state = _NEXT[state][code[0]]
                    out.append((r["conv"], r["seen"], place, letter, role, None if letter == "I" else row_id))
                    place += 1
            if len(out) >= 50_000:
                yield _batch(out, types)
                out = []
        if out:
            yield _batch(out, types)


def _batch(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                      names=["conv", "run", "place", "edit", "new_role", "row_id"])


def repaired(rows: DataFrame, size: int = _SEGMENT) -> tuple[DataFrame, DataFrame]:
    """``rows(conv, turn, role, text, dropped)`` → ``(figures, edits)``.

    ``figures``: one row per conversation with rows: ``conv``, ``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal``, ``cost``. ``edits``: every edit of the
    cheapest repair (ties: the audit least by ASCII) as ``conv``, ``run``, ``place``
    (their order), ``edit``, ``role`` and ``text`` (of the repaired row; null where a
    row is deleted). Rows are taken by turn, nulls first; equal turns by role, then
    by the text's SHA-256. Only ids, initials and faults are sorted and solved;
    texts join the edits at the end.
    """
    kept = stored(rows.filter(~F.col("dropped")).select(
        "conv", "turn", "role", "text", F.sha2(F.concat("role", F.lit("\0"), "text"), 256).alias("sha"),
        F.monotonically_increasing_id().alias("row_id")), "turns")
    trimmed = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    slim = kept.select("conv", "turn", "role", "sha", "row_id", (trimmed == "").alias("blank"),
                       (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("open"))
    runs = stored(segments(with_faults(slim), size), "runs")
    kind = runs.dtypes[0][1]
    # a conversation of r rows sends r / size tables of 32 numbers to one task
    small = runs.drop("codes", "row_ids").repartition("conv").sortWithinPartitions("conv", "part", "number")
    states = stored(small.mapInArrow(_folded, f"conv {kind}, {_FOLD_SCHEMA}"), "states")
    figures = states.filter("cost is not null").select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    todo = runs.select("part", "number", "codes", "row_ids").join(
        states.select("conv", "seen", "part", "number", "entry", "exit", "after"), ["part", "number"])
    edits = todo.mapInArrow(_decided, f"conv {kind}, run long, place long, edit string, new_role string, row_id long")
    texts = kept.select("row_id", "role", "text")
    full = edits.join(texts, "row_id", "left")
    stays = F.col("edit") != "D"
    return figures, full.select("conv", "run", "place", "edit", F.when(stays, F.coalesce("new_role", "role")).alias("role"),
                                F.when(stays, F.coalesce("text", F.lit(""))).alias("text"))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits sorted by conversation and order → its audit and digest, text by text."""
    of, letters, digest, lines, out = None, [], None, 0, []
    types = [None, pa.string(), pa.string()]

    def flushed() -> pa.RecordBatch:
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=["conv", "audit", "repaired_sha256"])

    for b in batches:
        types[0] = b.schema.types[0]
        for conv, edit, role, text in zip(*(c.to_pylist() for c in b.columns)):
            if digest is None or conv != of:
                if digest is not None:
                    out.append((of, "".join(letters), digest.hexdigest()))
                    if len(out) >= 8192:
                        yield flushed()
                of, letters, digest, lines = conv, [], hashlib.sha256(), 0
            letters.append(edit)
            if edit != "D":
                digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
    if digest is not None:
        out.append((of, "".join(letters), digest.hexdigest()))
    if out:
        yield flushed()


def audit(edits: DataFrame) -> DataFrame:
    """``conv``, ``audit`` (the edits' initials in order) and ``repaired_sha256`` (of
    the repaired ``role:text`` lines). A digest is one sequential computation, so
    a conversation streams through one task here, row by row."""
    rows = edits.repartition("conv").sortWithinPartitions("conv", "run", "place").select("conv", "edit", "role", "text")
    return rows.mapInArrow(_digested, f"conv {rows.dtypes[0][1]}, audit string, repaired_sha256 string")


def repair_report(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", size: int = _SEGMENT) -> DataFrame:
    """Damages the conversations as ``damaged`` says, repairs them and reports, per
    original ``conv_col``: ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``,
    ``cost``, ``audit``, ``repaired_sha256``.

    Null conversation ids are one conversation. Null turns come first and have no
    gap. Null role or text: one space, so such a text is blank and such a role is
    never kept. Repeated rows: duplicates. A conversation without rows after the
    damage has zeros, an empty audit and the empty text's digest. No rows: empty.
    Other columns are ignored.
    """
    rows = stored(damaged(convs, conv_col, turn_col, role_col, text_col), "damaged")
    figures, edits = repaired(rows, size)
    known = rows.select("conv").distinct()
    found = known.alias("a").join(figures.alias("f"), _same("a", "f", "conv"), "left").join(
        audit(edits).alias("e"), _same("a", "e", "conv"), "left")
    zero = [F.coalesce(F.col(f"f.{c}"), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.col("a.conv").alias(conv_col), *zero, F.coalesce("e.audit", F.lit("")).alias("audit"),
                        F.coalesce("e.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
