import hashlib
import heapq
import random
import re
import zlib

from pyspark.sql import functions as F

from levyline.llm import queries as Q
from levyline.llm import role_repair
from levyline.llm.role_repair import damage, repair

from . import helpers as H

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0d]")


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(c)}:{name(t)}".encode()) % 20
        role, text = name(role), name(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def order(row):
    _, t, role, text = row
    return (t is not None, t or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest())


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        words = WORD.findall(text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """Shortest path over (rows read, accepted prefix), ordered by (cost, audit); the audit decides the roles."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, result = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, result
        if (i, state) in done:
            continue
        done.add((i, state))
        for x, name in (("u", "user"), ("a", "assistant")):
            if (state, x) in step:
                heapq.heappush(queue, (cost + 2, audit + "I", i, x, result + (name + ":",)))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, state, result))
            if fault[i] in ("", "truncated"):
                more = int(fault[i] == "truncated")
                if (state, role[:1]) in step:
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, step[state, role[:1]], result + (f"{role}:{text}",)))
                for x, name in (("u", "user"), ("a", "assistant")):
                    if (state, x) in step:
                        heapq.heappush(queue, (cost + 2 + more, audit + "R", i + 1, x, result + (f"{name}:{text}",)))


def plain(rows, damage_=True):
    ids = {r[0] for r in rows}
    rows = damaged(rows) if damage_ else rows
    out = set()
    for c in ids:
        own = sorted((r for r in rows if r[0] == c), key=order)
        fault = faults(own)
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, result = cheapest(own, fault)
        text = hashlib.sha256("\n".join(result).encode()).hexdigest()
        out.add((c, gaps, fault.count("blank"), fault.count("duplicate"), fault.count("truncated"), illegal, cost, audit, text))
    return out


def got(df):
    return {tuple(r) for r in df.collect()}


def random_rows(n, seed, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(0, longest)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = rng.choice(["Yes.", "no", "", " \t", "Why?\n", f"word {t}.", "é!", None])
            rows.append((c, rng.choice([t, t, t, t + 2, None]), role, text))
    return rows


def test_equals_a_shortest_path_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{H.SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(Q.op12_role_repair(spark, H.SF)) == plain(rows)


def test_random_conversations_in_segments_of_any_size(spark, monkeypatch):
    rows = random_rows(500, 1) + [(None, 1, "user", "Hi."), (None, None, None, None), (-5, 2**62, "user", "Hi."), (-5, -(2**61), "user", "Hi.")]
    clash = [F.lit(1).alias(c) for c in ("n", "digest", "role_", "seg", "cost", "audit", "blank", "fault", "place", "i", "c")]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *clash)
    want = plain(rows)
    assert got(repair(damage(df), of=df)) == want
    monkeypatch.setattr(role_repair, "SEGMENT", 2)
    assert got(repair(damage(df), of=df)) == want


def test_a_conversation_that_holds_most_rows(spark):
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice([f"Line {t}.", f"open {t}", "again."])) for t in range(2000)]
    rows += [(1, 5, "user", "the same row.")] * 700 + [(2, 1, "user", "Hi."), (2, 2, "assistant", "Hello.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit(1).cast("long"))
    assert got(repair(df)) == plain(rows, damage_=False)


def test_equal_costs_never_hold_a_prefix():
    """What makes merging exact: audits of the same rows and cost between the same tops are not prefixes of each other."""
    rng = random.Random(3)
    for _ in range(300):
        symbols = "".join(rng.choice(["u-", "a-", "s-", "ut", "at", "--", "ub", "ad"]) for _ in range(rng.randrange(1, 5)))
        reached = {}
        held = {(0, 0, "")}
        for i in range(0, len(symbols), 2):
            before = set(held)
            for _ in range(2):
                before |= {(role_repair.SHIFT[t, x], c + 2, a + "I") for t, c, a in before for x in "ua" if (t, x) in role_repair.SHIFT}
            held = {(t, c + 3, a + "D") for t, c, a in before}
            if symbols[i + 1] in "-t":
                more = int(symbols[i + 1] == "t")
                held |= {(role_repair.SHIFT[t, symbols[i]], c + more, a + "K") for t, c, a in before if (t, symbols[i]) in role_repair.SHIFT}
                held |= {(role_repair.SHIFT[t, x], c + 2 + more, a + "R") for t, c, a in before for x in "ua" if (t, x) in role_repair.SHIFT}
        for t, c, a in held:
            reached.setdefault((t, c), set()).add(a)
        for audits in reached.values():
            assert not any(a != b and b.startswith(a) for a in audits for b in audits)
        best = [min(((c, a) for u, c, a in held if u == t), default=None) for t in range(4)]
        assert list(role_repair.segment_table(symbols)[0]) == best


def test_empty_tables_and_conversations_without_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert repair(damage(df), of=df).collect() == []
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    assert got(repair(damage(df), of=df)) == {(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
