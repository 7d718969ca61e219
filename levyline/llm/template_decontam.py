"""Benchmark decontamination by template canonicalisation.

A text's words become typed placeholders where they are parameters: numbers, units that follow a number, and names
(capitalised words that do not begin a sentence, in texts that are not written in capitals); all other words are
lowered and stripped of marks. Windows of ``WINDOW`` such template words that hold at least ``MIN_PLAIN`` plain words
are hash-joined with the windows of the benchmark's items. Windows that hold names come a second time with the
names as plain words, so that copies in another case are found. For a document and an item, the matches on one
diagonal (same distance between the places in document and item) are one occurrence of the item, and so are those of
neighbouring diagonals, covering the item's words that their windows hold; the words that
stand in its placeholders there must correspond consistently: each benchmark value to one document value. Places where a
value corresponds to another than most often (itself, if that is as often) are bad: at most a third of the places of repeated values may be,
or half if all values with a bad place stand for themselves elsewhere. An occurrence covering at least ``MIN_COVER`` of the item's windows with consistent slots
is a leak: ``exact`` when all slot values are equal, ``re-parameterised`` otherwise.

A window that more than ``COMMON_ITEMS`` items share (a stem of many questions) finds no pair by itself if the item's common
windows cannot cover enough of it: such an item is joined by its other windows, and its common ones are looked up only
for the pairs so found. Nothing is lost, and documents with the stem do not meet all its items.

Document windows are first tested against a bit table of the benchmark's window hashes, of fixed size whatever the
benchmark, so only windows that may match leave the tasks that read the texts; the join then decides.

Defined results: null and empty texts have no windows; an item of fewer words than a window, or without
a window of enough plain words, is one window of all its words, which documents may hold anywhere (with fewer than
``MIN_PLAIN`` plain words the words themselves, not their placeholders, must be the same); an item of fewer than ``MIN_PLAIN`` words
must stand alone, as a whole sentence, line or text: ``True`` is not leaked by every text with that word. An empty benchmark leaks nothing; items with a null
id or text are ignored. Equal texts of several items are all reported.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored
from .shingles import PIECE, U, _powers, buffer_of, mix, pieces, span_hashes, spans

WINDOW = 8
MIN_PLAIN = 4
MIN_COVER = 0.5
#: Diagonals at most this far apart belong to one occurrence: words added or removed between its pieces.
DIAGONAL_GAP = 4
#: Items that may share a window before it is common.
COMMON_ITEMS = 16
#: Share of bad places, of those of an occurrence's repeated values.
BAD_SHARE = 1 / 3
#: Bits of the table that prefilters document windows.
TABLE_BITS = 24
# Units, as they follow a number.
UNITS = (
    "mm cm m km in inch inches ft feet foot yd yards mi mile miles mg g kg t lb lbs oz pound pounds ounce ounces ton tons ml l litre litres liter liters "
    "gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years % percent usd eur dollar dollars "
    "euro euros cent cents mph kmh kph c f k degrees degree hz khz mhz ghz w kw mw v a j kj cal kcal b kb mb gb tb"
).split()
NUMBER, UNIT, NAME = (mix(np.array([x], U))[0] for x in (101, 102, 103))

_EDGE = np.zeros(256, bool)  # marks that a word loses at its edges
_EDGE[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_SMALL = np.zeros(256, bool)
_SMALL[0x61:0x7B] = True
_STOP = np.zeros(256, bool)
_STOP[[0x21, 0x2E, 0x3A, 0x3F]] = True


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    s, e = spans(data, np.zeros(1, np.int64))
    return np.sort(span_hashes(data, s, e))


_UNIT_HASHES = _unit_hashes()


def _trimmed(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words without marks at their edges (at most 8 a side)."""
    for _ in range(8):
        cut = (s < e) & _EDGE[data[np.minimum(s, len(data) - 1)]]
        if not cut.any():
            break
        s = s + cut
    for _ in range(8):
        cut = (s < e) & _EDGE[data[np.maximum(e - 1, 0)]]
        if not cut.any():
            break
        e = e - cut
    return s, e


def template(data: np.ndarray, off: np.ndarray, low: np.ndarray, low_off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the texts at ``off``: template hash, is a slot, hash of the lowered word itself, text number, begins a sentence or line.

    ``low`` holds the same texts in lower case, whose words are hashed; its words correspond to those of ``data``.
    """
    none = np.zeros(0, U)
    s, e = spans(data, off[:-1])
    if not len(s):
        return none, np.zeros(0, bool), none, np.zeros(0, np.int64), np.zeros(0, bool)
    text = np.searchsorted(off, s, "right") - 1
    # a sentence begins with a text, after a word that closes with a stop, and after a line's end
    lines = np.concatenate([[0], np.cumsum(data == 0x0A)])
    opening = np.ones(len(s), bool)
    opening[1:] = (text[1:] != text[:-1]) | _STOP[data[e[:-1] - 1]] | (lines[s[1:]] > lines[e[:-1]])
    s, e = _trimmed(data, s, e)
    s2, e2 = _trimmed(low, *spans(low, low_off[:-1]))
    keep = s < e
    begun = np.cumsum(opening)[keep]  # a word of marks alone hands on that it begins a sentence
    begins = np.concatenate([[True], begun[1:] > begun[:-1]])[: len(begun)]
    s, e, s2, e2, text, opening = s[keep], e[keep], s2[keep], e2[keep], text[keep], opening[keep]
    if not len(s):
        return none, np.zeros(0, bool), none, text, begins
    h = span_hashes(low, s2, e2)
    small = np.concatenate([[0], np.cumsum(_SMALL[data])])
    number = _DIGIT[data[s]]
    unit = np.zeros(len(s), bool)
    at = np.minimum(np.searchsorted(_UNIT_HASHES, h), len(_UNIT_HASHES) - 1)
    unit[1:] = (_UNIT_HASHES[at[1:]] == h[1:]) & number[:-1] & (text[1:] == text[:-1])
    wide = (data[s] >= 0xC2) & (e - s > 1) & (e2 - s2 > 1)
    capital = (data[s] != low[s2]) | (wide & (data[np.minimum(s + 1, len(data) - 1)] != low[np.minimum(s2 + 1, len(low) - 1)]))
    shout = capital & (small[e] == small[s])
    texts = len(off) - 1
    shouted = np.bincount(text, shout, texts) > 0.5 * np.maximum(1, np.bincount(text, minlength=texts))
    name = capital & ~shout & ~opening & ~shouted[text] & ~number
    slot = number | unit | name
    return np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, h))), slot, h, text, begins


def windows(h: np.ndarray, slot: np.ndarray, text: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows of k words within one text that hold enough plain words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    x = h[:n].copy()
    for d in range(1, k):
        x = mix(x * U(0xD6E8FEB86659FD93) + h[d : d + n])
    plain = np.concatenate([[0], np.cumsum(~slot)])
    good = (text[:n] == text[k - 1 :]) & (plain[k:] - plain[:n] >= least)
    at = np.flatnonzero(good)
    return at, x[at]


def whole_windows(h: np.ndarray, value: np.ndarray, slot: np.ndarray, text: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and hashes of all windows of k words, as windows of a whole item; whether their placeholders count.

    With enough plain words they are windows of the template; with fewer, of the words themselves.
    """
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, bool)
    plain = np.concatenate([[0], np.cumsum(~slot)])
    rich = plain[k:] - plain[:n] >= least
    at = np.flatnonzero(text[:n] == text[k - 1 :])
    return at, np.where(rich[at], _whole(h, at, k), mix(_whole(value, at, k))), rich[at]


def _whole(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    power, inverse = _powers(len(words) + 1)
    total = np.zeros(len(words) + 1, U)
    np.cumsum((words | U(1)) * power[: len(words)], out=total[1:])
    return mix(mix((total[at + k] - total[at]) * inverse[at]) + U(k))


def _rows(k: int, least: int, table: np.ndarray | None, lengths: list[int] | None):
    """Windows (id, place, hash, slot values, their places in the window) of texts; with a table only those it may hold.

    Without ``lengths`` the texts are items: those without a window of k words are one window of all their words.
    Else windows of these lengths come as well.
    """
    types = [("place", pa.int64()), ("hash", pa.int64()), ("slots", pa.list_(pa.int64())), ("spots", pa.list_(pa.int64())), ("words", pa.int64()), ("size", pa.int64())]

    def _one(h, value, slot, a, n):
        of = slice(a, a + n)
        return whole_windows(h[of], value[of], slot[of], np.zeros(n, np.int64), n, least)[1:]

    def some(ids, ends, h, slot, value, text, begins):
        """``ends``: the last word ends its text."""
        stands = np.append(begins, ends)  # a window from here or up to here stands at a border of sentences
        first = np.searchsorted(text, np.arange(len(ids)))
        count = np.bincount(text, minlength=len(ids))
        at, x = windows(h, slot, text, k, least)
        # once more without placeholders for names, which depend on the text's case
        names = h == NAME
        loose_h, loose_slot = np.where(names, value, h), slot & ~names
        named = np.concatenate([[0], np.cumsum(names)])
        other, y = windows(loose_h, loose_slot, text, k, least) if names.any() else (at[:0], x[:0])
        again = named[other + k] > named[other]
        if lengths is None:
            again &= np.isin(other, at)
        loose = np.arange(len(at) + again.sum()) >= len(at)
        at, x = np.concatenate([at, other[again]]), np.concatenate([x, y[again]])
        size, rich = np.full(len(at), k), np.ones(len(at), bool)
        if lengths is None:
            bare = np.flatnonzero((count > 0) & (np.bincount(text[at], minlength=len(ids)) == 0))
            more = []
            for t in bare:
                for of_names, (hh, ss) in enumerate(((h, slot), (loose_h, loose_slot))[: 1 + bool(named[first[t] + count[t]] > named[first[t]])]):
                    more.append((first[t : t + 1], *_one(hh, value, ss, first[t], count[t]), np.array([of_names == 1])))
            more = [(a, y, count[text[a]], r, z) for a, y, r, z in more]
        else:
            more = []
            for n in lengths:
                for of_names, (hh, ss) in enumerate(((h, slot), (loose_h, loose_slot))):
                    a, y, r = whole_windows(hh, value, ss, text, n, least)
                    fits = (stands[a] & stands[a + n] if n < least else np.ones(len(a), bool)) & (named[a + n] > named[a] if of_names else True)
                    a, y, r = (v[fits] for v in (a, y, r))
                    more.append((a, y, np.full(len(a), n), r, np.full(len(a), of_names == 1)))
        if table is not None:
            known = lambda y: table[(y >> U(64 - TABLE_BITS)).astype(np.int64)]
            hit = known(x)
            at, x, size, rich, loose = at[hit], x[hit], size[hit], rich[hit], loose[hit]
            more = [tuple(v[known(m[1])] for v in m) for m in more]
        at, x, size, rich, loose = (np.concatenate(v) for v in zip((at, x, size, rich, loose), *more, strict=True))
        of = text[at]
        signed = value.view(np.int64)
        held = [np.flatnonzero((loose_slot if z else slot)[a : a + n]) if r else at[:0] for a, n, r, z in zip(at, size, rich, loose, strict=True)]
        slots, spots = [signed[a + x].tolist() for a, x in zip(at, held)], [x.tolist() for x in held]
        arrays = [ids.take(pa.array(of, pa.int64())), pa.array(at - first[of]), pa.array(x.view(np.int64)), pa.array(slots, types[2][1]), pa.array(spots, types[3][1]), pa.array(count[of].astype(np.int64)), pa.array(size.astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, ["id", *(n for n, _ in types)])

    def run(batches):
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            lower = pc.utf8_lower(texts)
            for i, j in pieces(texts):
                ids, both = b.column(0).slice(i, j - i), (*buffer_of(texts.slice(i, j - i)), *buffer_of(lower.slice(i, j - i)))
                for base, part, ends in _bounded(both, max([k, *(lengths or [])])):
                    words = template(*part)
                    if base:
                        words[4][:1] = False  # the part before holds the windows from here
                    out = some(ids, ends, *words)
                    if base and out.num_rows:
                        out = out.set_column(1, "place", pa.array(out.column(1).to_numpy() + base))
                    yield out

    return run


def _bounded(both: tuple[np.ndarray, ...], k: int):
    """Buffers and offsets of texts and lowered texts, as they are; those of a single long text in overlapping parts.

    Parts hold whole words and overlap by 8 * k words, so every window is whole in one part; windows in the
    overlap come twice, which changes no result. Yields the template words before the part, the part, and whether the text ends with it.
    """
    data, off, low, low_off = both
    if len(off) != 2 or len(data) <= 2 * PIECE:
        yield 0, both, True
        return
    (s, e), (s2, e2) = spans(data, off[:-1]), spans(low, low_off[:-1])
    step, at, base = max(PIECE // 8, 16 * k), 0, 0
    while at < len(s):
        to = min(len(s), at + step)
        part = data[s[at] : e[to - 1]], low[s2[at] : e2[to - 1]]
        yield base, (part[0], np.array([0, len(part[0])]), part[1], np.array([0, len(part[1])])), to == len(s)
        if to == len(s):
            return
        back = max(at + 1, to - 8 * k)
        gone = data[s[at] : e[back - 1]], low[s2[at] : e2[back - 1]]
        base += len(template(gone[0], np.array([0, len(gone[0])]), gone[1], np.array([0, len(gone[1])]))[0])
        at = back


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = WINDOW, least: int = MIN_PLAIN, cover: float = MIN_COVER) -> DataFrame:
    """Windows (item_id, item_place, hash, item_slots, item_windows) and whether many items share them."""
    ship(items.sparkSession)
    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).dropna()
    rows = rows.mapInArrow(_rows(k, least, None, None), f"id {kind}, place long, hash long, slots array<long>, spots array<long>, words long, size long").drop("spots").distinct()
    rows = stored(rows.select(F.col("id").alias("item_id"), F.col("place").alias("item_place"), "hash", F.col("slots").alias("item_slots"), F.col("size").alias("item_size"), F.col("words").alias("item_words")), "windows")
    shared = rows.groupBy("hash").agg(F.countDistinct("item_id").alias("items")).where(F.col("items") > COMMON_ITEMS).select("hash", F.lit(True).alias("common"))
    rows = rows.join(shared, "hash", "left").withColumn("common", F.coalesce("common", F.lit(False)))
    often = lambda c: F.when(F.col("common"), F.col(c))
    total = rows.groupBy("item_id").agg(F.countDistinct("item_place").alias("item_windows"), F.countDistinct(often("item_place")).alias("windows_"))
    held = rows.select("item_id", "common", F.explode(F.sequence("item_place", F.col("item_place") + F.col("item_size") - 1)).alias("word"))
    held = held.groupBy("item_id").agg(F.countDistinct("word").alias("item_held"), F.countDistinct(often("word")).alias("held_"))
    total = total.join(held, "item_id")
    # whether an item's common windows alone could cover enough of it
    alone = (F.col("windows_") >= cover * F.col("item_windows")) | (F.col("held_") >= cover * F.col("item_held"))
    return rows.join(total.withColumn("alone", alone).drop("windows_", "held_"), "item_id")


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", k: int = WINDOW, least: int = MIN_PLAIN, cover: float = MIN_COVER) -> DataFrame:
    """Rows (doc_id, item_id, matched, item_windows, coverage, kind): the leaks of items in documents."""
    ship(docs.sparkSession)
    held = stored(benchmark_windows(items, item_col, k=k, least=least, cover=cover), "benchmark")
    # positions of a table of fixed size: at most 2 ** TABLE_BITS numbers, whatever the benchmark
    on = held.select(F.shiftrightunsigned("hash", 64 - TABLE_BITS).cast("int").alias("bit")).distinct().toPandas()["bit"].to_numpy()
    table = np.zeros(1 << TABLE_BITS, bool)
    table[on] = True
    # lengths of the items that are one window, at most as many as there are lengths of items without a window of k words
    lengths = sorted(r[0] for r in held.where("item_windows = 1 AND item_size = item_words").select("item_size").distinct().collect())
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(table))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        yield from _rows(k, least, np.unpackbits(packed.value).view(bool), lengths)(batches)

    found = stored(rows.mapInArrow(run, f"id {kind}, place long, hash long, slots array<long>, spots array<long>, words long, size long"), "found")
    found = found.select(F.col("id").alias("doc_id"), "place", "hash", "slots", "spots")
    first = F.col("alone") | ~F.col("common")
    met = found.join(held.where(first).drop("common", "alone"), "hash")
    later = held.where(~first)
    if not later.isEmpty():  # common windows of items that others have found in the document
        pairs = met.join(later.select("item_id").distinct(), "item_id", "left_semi").select("doc_id", "item_id").distinct()
        wanted = pairs.join(later.drop("common", "alone"), "item_id").withColumnsRenamed({"doc_id": "d", "hash": "h"})
        more = found.join(wanted, (F.col("hash") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("d"))).drop("d", "h")
        met = met.unionByName(more)
    met = met.select("doc_id", "item_id", (F.col("place") - F.col("item_place")).alias("shift"), "place", "item_place", "item_windows", "item_size", "item_held", F.arrays_zip("item_slots", "slots", "spots").alias("pairs"))
    # an occurrence is one diagonal, or a run of neighbouring ones
    pair = Window.partitionBy("doc_id", "item_id").orderBy("shift")
    met = met.withColumn("apart", (F.coalesce(F.col("shift") - F.lag("shift").over(pair), F.lit(0)) > DIAGONAL_GAP).cast("int"))
    met = met.withColumn("run", F.sum("apart").over(pair)).withColumn("diagonal", F.col("shift")).withColumn("shift", F.explode(F.array(F.struct(F.lit(0).cast("long").alias("merged"), F.col("shift").alias("at")), F.struct(F.lit(1).cast("long").alias("merged"), F.col("run").alias("at")))))
    # slots: every benchmark value stands for one document value within an occurrence, but for a share of bad places
    key = ["doc_id", "item_id", "shift"]
    slots = met.select(*key, "item_place", F.explode("pairs").alias("p"))
    slots = slots.select(*key, (F.col("item_place") + F.col("p.spots")).alias("spot"), F.col("p.item_slots").alias("ours"), F.col("p.slots").alias("theirs")).distinct()
    slots = slots.groupBy(*key, "ours", "theirs").agg(F.count(F.lit(1)).alias("n"))
    slots = slots.groupBy(*key, "ours").agg(F.sum("n").alias("n"), F.max(F.struct("n", (F.col("ours") == F.col("theirs")).alias("itself"))).alias("most"))
    bad = F.col("n") - F.col("most.n")
    slots = slots.groupBy(*key).agg(
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("n"), F.sum(bad).alias("bad"), F.min(F.when(bad > 0, F.col("most.itself")).otherwise(True)).alias("itself"), F.min((F.col("most.itself") & (bad == 0)).cast("int")).alias("same")
    )
    share = F.when(F.col("itself"), F.lit(0.5)).otherwise(F.lit(BAD_SHARE))
    slots = slots.select(*key, (F.col("bad") <= share * F.col("n")).alias("fits"), "same")
    seen = met.groupBy(*key).agg(F.countDistinct("item_place").alias("matched"), F.first("item_windows").alias("item_windows"), F.first("item_held").alias("item_held"), F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.collect_set(F.struct("item_place", "item_size")).alias("places"))
    # a joint breaks the windows over it, so a merged run is measured by the item's words that its windows hold
    seen = seen.withColumn("held", F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p["item_place"], p["item_place"] + p["item_size"] - 1)))))).drop("places")
    null_safe = F.col("s.doc_id").eqNullSafe(F.col("t.doc_id")) & F.expr("s.item_id = t.item_id AND s.shift = t.shift")
    runs = seen.alias("s").join(slots.alias("t"), null_safe, "left").select("s.*", F.coalesce("fits", F.lit(True)).alias("fits"), F.coalesce("same", F.lit(1)).alias("same"))
    share = F.when(F.col("low") < F.col("high"), F.col("held") / F.col("item_held")).otherwise(F.col("matched") / F.col("item_windows"))
    runs = runs.withColumn("coverage", share).where((F.col("coverage") >= cover) & F.col("fits"))
    best = runs.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "same", "matched", "item_windows")).alias("b"))
    name = F.when(F.col("b.same") == 1, "exact").otherwise("re-parameterised")
    return best.select("doc_id", "item_id", "b.matched", "b.item_windows", "b.coverage", name.alias("kind"))
