import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from kilowatt.llm import conversations as C

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        one = lambda x: " " if x is None else str(x)
        role, text = one(role), one(text)
        kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by the suffixes of the conversation: all edits tried everywhere."""
    @lru_cache(maxsize=None)
    def rest(i, state, inserts):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserts:
            for to in NEXT[state].replace("s", ""):
                cost, audit, out = rest(i, to, inserts - 1)
                ways.append((cost + 5, "I" + audit, ((ROLE[to], ""), *out)))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, out = rest(i + 1, state, 3)
            ways.append((cost + 2, "D" + audit, out))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                for to in NEXT[state]:
                    if role[:1] == to:
                        cost, audit, out = rest(i + 1, to, 3)
                        ways.append((cost + more, "K" + audit, ((role, text), *out)))
                    if to in ROLE:
                        cost, audit, out = rest(i + 1, to, 3)
                        ways.append((cost + more + 1, "R" + audit, ((ROLE[to], text), *out)))
        return min(ways, default=(10**9, "", ()))
    for i in range(len(rows), 0, -1):  # from the end, so that long ones don't recurse deeply
        for state in NEXT:
            rest(i, state, 3)
    return rest(0, "", 3)


def brute(rows):
    out = []
    after = damage(rows)
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in after if r[0] == conv), key=lambda r: (
            r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{r[1]}\0{r[2]}".encode()).hexdigest()))
        seen, marked = set(), []
        for _, role, text in own:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, fixed = cheapest(tuple(marked))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out.append((conv, gaps, *(sum(m[2] == k for m in marked) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r)[:9] for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def some_rows(seed, convs=60, most=12):
    rng = random.Random(seed)
    roles = ["user"] * 4 + ["assistant"] * 4 + ["system", "tool", "", None, "agent", "USER"]
    texts = ["One.", "Two!", "Three?", "four", "five \n", " ", "", None, "six. \t", "\u00a0", "é!", "same.", "same."]
    rows = [(rng.choice([c, c, c, None]) if c < 3 else c, rng.choice([t, t, t, None, t + 3]), rng.choice(roles), rng.choice(texts))
            for c in range(convs) for t in range(rng.randrange(1, most))]
    return rows + rows[:15]


@pytest.mark.parametrize("size", [1, 3, 8192])
def test_equals_brute_force(spark, size):
    rows = some_rows(1)
    assert found(C.repair_report(spark.createDataFrame(rows, SCHEMA), size=size)) == brute(rows)


def test_whole_table_equals_brute_force(spark):
    convs = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert found(C.repair_report(convs)) == brute([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in convs.collect()])


def test_one_conversation_over_many_tasks(spark):
    rng = random.Random(6)
    rows = [(1, t // 2, rng.choice(["user", "assistant", "assistant", "system", "tool"]), rng.choice(["a.", "b!", "c", f"{t}.", f"{t}.", f"{t}."])) for t in range(400)]
    rows += [(2, 0, "user", "x."), (2, 1, "assistant", "y.")]
    out = C.repair_report(spark.createDataFrame(rows, SCHEMA).repartition(5), size=16)
    assert found(out) == brute(rows)
    kept = C.damaged(spark.createDataFrame(rows, SCHEMA))
    slim = kept.selectExpr("conv", "turn", "role", "text AS sha", "monotonically_increasing_id() AS row_id", "'u0' AS code")
    runs = C.segments(slim, 16).filter("conv = 1")
    assert runs.count() >= 25 and runs.select("part").distinct().count() > 1


def test_all_short_role_sequences():
    """Every sequence of up to five codes, solved in halves and by all edits."""
    from itertools import product
    names = {"s": "system", "u": "user", "a": "assistant", " ": "tool"}
    codes = ["s0", "u0", "a0", " 0", "u1", "a3"]
    for n in range(6):
        for seq in product(codes, repeat=n):
            rows = tuple((names[c[0]], "t", C.FAULTS[int(c[1])]) for c in seq)
            cost, end, after = C.finish([C.row_table(c) for c in seq])
            edits = "".join(C._edits(seq, 0, end)) + after if seq else after
            assert (cost, edits) == cheapest(rows)[:2], seq


def test_tables_of_runs_combine_in_any_grouping():
    rng = random.Random(3)
    for _ in range(200):
        codes = [rng.choice(["s0", "u0", "a0", "u3", "a3", " 0", "u1"]) for _ in range(rng.randrange(2, 20))]
        tables = [C.row_table(c) for c in codes]
        cut = rng.randrange(1, len(codes))
        assert C.combined([C.combined(tables[:cut]), C.combined(tables[cut:])]) == C.combined(tables)


def test_long_conversation_needs_little_space():
    import tracemalloc
    codes = tuple(random.Random(2).choice(["u0", "a0", "u3", "s0"]) for _ in range(6000))
    cost, end, after = C.finish([C.row_table(c) for c in codes])
    tracemalloc.start()
    edits = C._edits(codes, 0, end)
    assert tracemalloc.get_traced_memory()[1] < 2_000_000
    tracemalloc.stop()
    price = {"D": 2, "I": 5, "R": 1, "K": 0}
    assert sum(price[x] for e in edits for x in e) + 5 * sum(e[-1] != "D" and c[1] == "3" for e, c in zip(edits, codes)) + 5 * len(after) == cost


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.repair_report(empty).count() == 0
    rows = [(None, None, None, None), (None, 3, "user", "x."), (5, None, "user", "x."), (5, None, "user", "x."), (6, 1, "system", "s." * 200_000),
            (6, 2, "user", "long " * 200_000 + "."), (6, 3, "assistant", "ok.")]
    clash = spark.createDataFrame([(*r, 7, "x", "y") for r in rows], SCHEMA + ", cost int, conv string, kind string")
    assert found(C.repair_report(clash)) == brute(rows)


def test_dropped_conversations_stay_in_the_report(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    r = C.repair_report(spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA)).first()
    assert (r["conv_id"], r["cost"], r["audit"], r["repaired_sha256"]) == (gone, 0, "", hashlib.sha256(b"").hexdigest())
