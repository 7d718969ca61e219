"""Conversation structure repair by generalised LR parsing with weighted edits.

The roles of a conversation must spell ``(s?(ua)+)?`` (role initials). A parser over that grammar reads the rows
in order and follows all edits at once: keep a row, delete it, give it the role user or assistant, or insert an empty row of
either role. What it has read so far is a graph-structured stack. The grammar is left-recursive, so a
finished ``ua`` is reduced onto the list of turns and a stack differs only by its top: nothing yet, ``s``, an open ``u``,
or the list. Equal tops are merged by the minimum of (cost, audit), the audit being the initials of the edits.

Merging is exact. Two audits of the same rows and the same cost are never a proper prefix of one another (what the longer
has in excess would be inserts, and those cost), so whatever follows both keeps their order. For the same reason pieces of a conversation
can be parsed apart: a segment becomes the table of its cheapest (cost, audit) from each top to each top, and the
tables of a conversation's segments are composed in order. Rows are dealt by ranges of (conversation, order) and segments hold at most
``SEGMENT`` rows, so a conversation with a third of all rows is parsed by many tasks; only its audit (a result column) and
the hash of its repaired text, sequential by nature, are drawn through one task, as streams.

Order: turn (nulls first), then a digest of role and text; equal rows of a turn are adjacent and carried as one
with a count. The first fault of a row counts: ``blank`` (no character but white space), ``duplicate`` (role and text seen earlier),
``truncated`` (its last other character ends no sentence). Blank and duplicate rows must go; a truncated row that stays adds 1.

Defined results: null roles and texts are one space; a null conversation id is a conversation; rows with a null turn come first
and do not count for gaps; a conversation without rows has zeros, an empty audit and the hash of the empty text. Roles
count by their first character as it stands, so others than s, u and a cannot be kept.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows of a segment.
SEGMENT = 512
#: Tops of the stack: nothing, s, an open u, the list of turns (after the reduction of u a).
TOPS = 4
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
ACCEPT = (0, 3)
WHITE = " \t\n\x0b\f\r"


def damage(rows: DataFrame) -> DataFrame:
    """The given faults, by crc32 of ``conv_id:turn`` modulo 20: rows (conv_id, turn, role, text, n) with n equal copies."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    role = F.when(kind == 4, "user").otherwise(space("role"))
    rows = rows.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).cast("long").alias("n"))
    return rows


def _close(tops: list) -> list:
    """Tops after any cheapest inserts: first to an open u, then to the list."""
    tops = list(tops)
    for target, sources in ((2, (0, 1, 3)), (3, (2,))):
        for s in sources:
            if tops[s] is not None:
                new = (tops[s][0] + INSERT, tops[s][1] + "I")
                if tops[target] is None or new < tops[target]:
                    tops[target] = new
    return tops


def _step(tops: list, initial: str, fault: str) -> list:
    """Tops after one row: inserts before it, then each edit of it."""
    out: list = [None] * TOPS

    def offer(top, cost, audit):
        if out[top] is None or (cost, audit) < out[top]:
            out[top] = (cost, audit)

    for top, held in enumerate(_close(tops)):
        if held is None:
            continue
        cost, audit = held
        offer(top, cost + DELETE, audit + "D")
        if fault in "bd":
            continue
        extra = TRUNCATED if fault == "t" else 0
        if (top, initial) in SHIFT:
            offer(SHIFT[top, initial], cost + extra, audit + "K")
        for role in "ua":
            if (top, role) in SHIFT:
                offer(SHIFT[top, role], cost + REROLE + extra, audit + "R")
    return out


@lru_cache(maxsize=1 << 12)
def segment_table(symbols: str) -> tuple:
    """For each top to start from: the cheapest (cost, audit) of each top reached. Two characters a row: role initial, fault."""
    out = []
    for start in range(TOPS):
        tops: list = [None] * TOPS
        tops[start] = (0, "")
        for i in range(0, len(symbols), 2):
            tops = _step(tops, symbols[i], symbols[i + 1])
        out.append(tuple(tops))
    return tuple(out)


def _role_class(initial: str) -> str:
    return initial if initial in ("s", "u", "a") else "-"


def _pairs_illegal(symbols: str) -> int:
    initials = symbols[::2]
    return sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))


SEGMENTS = "conv_id {conv}, seg long, rows long, keys array<struct<turn:{turn},digest:binary,n:long>>, symbols string"


def _segments(batches):
    """Sorted rows (conv_id, turn, digest, n, initial, fault) of a range -> its segments in order."""
    from pyspark import TaskContext

    seg, conv, keys, symbols = TaskContext.get().partitionId() << 33, None, [], []
    ready, names = [], ["conv_id", "seg", "rows", "keys", "symbols"]
    types = None

    def close():
        nonlocal seg, keys, symbols
        if keys:
            ready.append((conv, seg, len(symbols), keys, "".join(symbols)))
            seg, keys, symbols = seg + 1, [], []

    def batch(rows):
        key = pa.struct([("turn", types[1]), ("digest", pa.binary()), ("n", pa.int64())])
        kinds = [types[0], pa.int64(), pa.int64(), pa.list_(key), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    for b in batches:
        types = [b.schema.field(0).type, b.schema.field(1).type]
        for c, turn, digest, n, initial, fault in zip(*(b.column(i).to_pylist() for i in range(6))):
            if c != conv or len(symbols) >= SEGMENT:
                close()
                conv = c
            first = _role_class(initial) + fault
            done = 0
            while done < n:  # equal rows: the first, then duplicates of it
                if len(symbols) >= SEGMENT:
                    close()
                take = min(n - done, SEGMENT - len(symbols))
                rest = _role_class(initial) + ("b" if fault == "b" else "d")
                symbols += [rest if done else first] + [rest] * (take - 1)
                keys.append({"turn": turn, "digest": digest, "n": take})
                done += take
        if len(ready) >= 256:
            yield batch(ready)
            ready.clear()
    close()
    if ready:
        yield batch(ready)


def _composed(batches):
    """Segments sorted by (conversation, seg) -> a row a conversation and the entry and exit top of each segment.

    Streams: a conversation's tops (their costs, audits and the entry tops of their segments) are all that is held.
    """
    names = ["conv_id", "seg", "entry", "exit", "cost", "audit", "illegal"]
    conv, started, out = None, False, []
    tops, paths, segs, illegal, last = [], [], [], 0, ""
    kind = pa.int64()

    def finish():
        closed = _close(tops)
        end = min((closed[t] + (t,) for t in ACCEPT if closed[t] is not None))
        # the top before the final inserts: the one whose audit the closed one extends
        t = next(x for x in range(TOPS) if tops[x] is not None and _close([tops[x] if y == x else None for y in range(TOPS)])[end[2]] == end[:2])
        way = [t]
        for entry in reversed(paths):
            way.append(entry[way[-1]])
        way.reverse()
        for i, seg in enumerate(segs):
            out.append((conv, seg, way[i], way[i + 1], None, None, None))
        out.append((conv, None, None, None, end[0], end[1], illegal))

    def batch(rows):
        kinds = [kind, pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    for b in batches:
        kind = b.schema.field(0).type
        for c, seg, symbols in zip(*(b.column(i).to_pylist() for i in range(3))):
            if not started or c != conv:
                if started:
                    finish()
                conv, started = c, True
                tops, paths, segs, illegal, last = [(0, "")] + [None] * (TOPS - 1), [], [], 0, ""
            table = segment_table(symbols)
            after, entry = [None] * TOPS, [0] * TOPS
            for s, held in enumerate(tops):
                if held is None:
                    continue
                for t, (part) in enumerate(table[s]):
                    if part is not None:
                        new = (held[0] + part[0], held[1] + part[1])
                        if after[t] is None or new < after[t]:
                            after[t], entry[t] = new, s
            tops = after
            paths.append(bytes(entry))
            segs.append(seg)
            illegal += _pairs_illegal(last + symbols)
            last = symbols[-2:]
        if len(out) >= 4096:
            yield batch(out)
            out.clear()
    if started:
        finish()
    if out:
        yield batch(out)


def edits_of(symbols: str, entry: int, exit_: int) -> list[str]:
    """The edits of each row of a segment: the inserts before it and its own letter."""
    audit, out, held = segment_table(symbols)[entry][exit_][1], [], ""
    for letter in audit:
        held += letter
        if letter != "I":
            out.append(held)
            held = ""
    return out


def _lines(batches):
    """Segments with their entry and exit top -> (conv_id, seg, nth, turn, digest, roles): the roles of the rows that result.

    ``roles`` holds the inserted ones in capitals and the row's own, if it stays, in lower case (k: its own role).
    """
    names = ["conv_id", "seg", "nth", "turn", "digest", "roles"]
    for b in batches:
        rows = []
        for c, seg, keys, symbols, entry, exit_ in zip(*(b.column(i).to_pylist() for i in range(6))):
            edits, at, top = edits_of(symbols, entry, exit_), 0, entry
            for nth, key in enumerate(keys):
                roles = ""
                for i in range(at, at + key["n"]):
                    for letter in edits[i]:
                        if letter == "D":
                            continue
                        role = symbols[2 * i] if letter == "K" else "a" if top == 2 else "u"
                        top = SHIFT[top, role]
                        roles += role.upper() if letter == "I" else "k" if letter == "K" else role
                at += key["n"]
                if roles:
                    rows.append((c, seg, nth, key["turn"], key["digest"], roles))
        key = b.schema.field(2).type.value_type
        kinds = [b.schema.field(0).type, pa.int64(), pa.int32(), key.field(0).type, pa.binary(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


ROLE = {"u": "user", "a": "assistant"}


def _hashed(batches):
    """Sorted (conv_id, roles, role, text, closing) -> (conv_id, repaired_sha256), drawn through the hash row by row."""
    names, started, conv, digest, empty, kind, out = ["conv_id", "repaired_sha256"], False, None, None, True, pa.int64(), []

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())], names)

    for b in batches:
        kind = b.schema.field(0).type
        for c, roles, role, text in zip(*(b.column(i).to_pylist() for i in range(4))):
            if not started or c != conv:
                if started:
                    out.append((conv, digest.hexdigest()))
                started, conv, digest, empty = True, c, hashlib.sha256(), True
            for x in roles:
                line = f"{ROLE[x.lower()]}:" if x.isupper() else f"{role if x == 'k' else ROLE[x]}:{text}"
                digest.update((line if empty else "\n" + line).encode())
                empty = False
        if len(out) >= 4096:
            yield batch(out)
            out.clear()
    if started:
        out.append((conv, digest.hexdigest()))
    if out:
        yield batch(out)


def _last_character() -> Column:
    return F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1)


def repair(rows: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Rows (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of ``rows`` (conv_id, turn, role, text, n).

    ``n`` is the number of equal rows that a row stands for. ``of`` names the conversations (``conv_id``) to report,
    those of ``rows`` by default; ones without rows have zeros.
    """
    ship(rows.sparkSession)
    conv, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), "n")
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    rows = rows.withColumn("digest", digest).groupBy("conv_id", "turn", "digest").agg(F.sum("n").alias("n"), F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    rows = stored(rows, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    marks = rows.select(
        "conv_id", "turn", "digest", "n", F.substring("role", 1, 1).alias("initial"), blank.alias("blank"), (~_last_character().isin(".", "!", "?")).alias("open"), place.alias("place")
    )
    first = marks.where("NOT blank").groupBy("conv_id", "digest").agg(F.min("place").alias("first")).select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    marks = marks.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    fault = F.when(F.col("blank"), "b").when(F.col("place") != F.col("first"), "d").when(F.col("open"), "t").otherwise("-")
    marks = stored(marks.select("conv_id", "turn", "digest", "n", "initial", fault.alias("fault")), "turn-marks")
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    span = F.coalesce(wide("high") - wide("low") + 1 - wide("turns"), F.lit(0)).cast("long")
    held = marks.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("fault") == "b", F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "b", 0).when(F.col("fault") == "d", F.col("n")).otherwise(F.col("n") - 1)).alias("duplicate"),
        F.sum(F.when(F.col("fault") == "t", 1).otherwise(0)).alias("truncated"),
    )
    held = held.groupBy("conv_id").agg(
        F.max("turn").alias("high"), F.min("turn").alias("low"), F.count("turn").alias("turns"), *(F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated"))
    )
    held = held.select("conv_id", span.alias("gaps"), "blank", "duplicate", "truncated")
    order = ["conv_id", "turn", "digest"]
    dealt = marks.select(*order, "n", "initial", "fault").repartitionByRange(*order).sortWithinPartitions(*order)
    segments = stored(dealt.mapInArrow(_segments, SEGMENTS.format(conv=conv, turn=turn)), "turn-segments")
    drawn = segments.select("conv_id", "seg", "symbols").repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    ways = stored(drawn.mapInArrow(_composed, f"conv_id {conv}, seg long, entry int, exit int, cost long, audit string, illegal long"), "turn-ways")
    parsed = ways.where("seg IS NULL").select(F.col("conv_id").alias("c"), "illegal", "cost", "audit")
    tops = ways.where("seg IS NOT NULL").select("seg", "entry", "exit")
    lines = segments.join(tops, "seg").select("conv_id", "seg", "keys", "symbols", "entry", "exit")
    lines = lines.mapInArrow(_lines, f"conv_id {conv}, seg long, nth int, turn {turn}, digest binary, roles string")
    same = F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & F.col("l.turn").eqNullSafe(F.col("r.turn")) & (F.col("l.digest") == F.col("r.digest"))
    lines = lines.alias("l").join(rows.alias("r"), same).select("l.conv_id", "roles", "role", "text", "seg", "nth")
    # inserts after the last row stand with no row; a segment's audit ends with a row's own letter
    tail = F.regexp_extract("audit", "(I*)$", 1)
    closing = parsed.where(tail != "").select(
        F.col("c").alias("conv_id"), F.when(tail == "I", "A").otherwise("UA").alias("roles"), *(F.lit(None).cast("string").alias(c) for c in ("role", "text")), F.lit((1 << 63) - 1).alias("seg"), F.lit(0).alias("nth")
    )
    drawn = lines.unionByName(closing).repartition("conv_id").sortWithinPartitions("conv_id", "seg", "nth")
    hashes = drawn.select("conv_id", "roles", "role", "text").mapInArrow(_hashed, f"conv_id {conv}, repaired_sha256 string")
    hashes = hashes.select(F.col("conv_id").alias("h"), "repaired_sha256")
    joined = lambda x, y, c, how: x.join(y, F.col("conv_id").eqNullSafe(F.col(c)), how)
    out = joined(joined(held, parsed, "c", "inner"), hashes, "h", "left").drop("c", "h")
    ids = (of if of is not None else rows).select(F.col("conv_id").alias("i")).distinct()
    out = ids.join(out, F.col("i").eqNullSafe(F.col("conv_id")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    sha = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return out.select(F.col("i").alias("conv_id"), *(zero(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"), sha)
