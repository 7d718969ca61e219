"""Phrase collocation mining by top-order marginalisation.

Every word of a piece starts exactly one window: itself and the three words that follow it (the lead columns),
padded where the piece ends. Only these longest windows are counted; a Spark ROLLUP over their columns then
sums them into the counts of all shorter prefixes, so the counts of words, pairs, triples and quadruples come from
one table and no n-gram is exploded on its own.

Words are 64-bit hashes while they are counted. The table of all words with their hashes is checked first: if two
words share a hash, counting starts again with another seed, so counts are exact. Before the windows are counted, the phrases of
two to four words are counted by hash in ``FILTER_BITS`` places; a phrase whose place stays under ``least`` is rarer
than that, and a window is padded from its first such prefix on. Places that phrases share only make windows longer than
needed. Rare phrases may thus be counted too low, never one of ``least`` occurrences or more. The filter bounds what is broadcast, not
what is counted: with far more phrases than places it lets all pass, and windows are counted whole.

Defined results: null texts are empty; a null language is ``und`` (and shares the counts of rows that say so); rows that
repeat are counted as often as they occur; ids are not read. Phrases of words that never reach ``least`` do not appear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored
from .shingles import LOWER, U, buffer_of, mix, span_hashes

#: Words of the longest window.
ORDER = 4
#: Places of the filter of rare phrases: a bitmap of 16 MB.
FILTER_BITS = 1 << 27
#: Places of a range, the unit in which they are shuffled and summed.
RANGE = 1 << 16
#: Words counted at a time in a task, and bytes hashed at a time.
FLUSH_WORDS = 1 << 19
CHUNK = 1 << 19
#: Words a task remembers as already listed.
KNOWN_WORDS = 1 << 20
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_GAP = _ENDS.copy()
_GAP[[0x20, 0x09]] = True
_MUL = U(0xD6E8FEB86659FD93)


def _chunks(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about CHUNK bytes that end after a gap (or with the data)."""
    at = 0
    while at < len(data):
        to = min(len(data), at + CHUNK)
        while to < len(data) and not _GAP[data[to - 1]]:
            gap = np.flatnonzero(_GAP[data[to : to + CHUNK]])
            to = to + int(gap[0]) + 1 if len(gap) else min(len(data), to + CHUNK)
        yield at, to
        at = to


def _words(texts: pa.Array, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts, ends, hash, row, begins a piece) of each chunk's words."""
    data, off = buffer_of(pc.fill_null(texts, ""))
    salt = mix(np.array([seed + 1], U))[0]
    ended = True  # a piece ended between the last word and this chunk
    for at, to in _chunks(data):
        low = LOWER[data[at:to]]
        cut = np.zeros(len(low) + 1, bool)  # texts begin here
        inside = off[(off >= at) & (off <= to)] - at
        cut[inside] = True
        word = ~_GAP[low]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | cut[1:-1]
        last[:-1] &= ~word[1:] | cut[1:-1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        breaks = np.cumsum(np.concatenate([[0], _ENDS[low]]))  # piece ends before each byte
        texts_begun = np.cumsum(cut)
        here = breaks[s] + texts_begun[s]
        new = np.ones(len(s), bool)
        new[1:] = here[1:] != here[:-1]
        if len(s):
            new[0] = ended or breaks[s[0]] > 0 or texts_begun[s[0]] > 0
            ended = bool(breaks[-1] > breaks[s[-1]] or texts_begun[len(low) - 1] > texts_begun[s[-1]])
        else:
            ended = ended or bool(breaks[-1] > 0 or cut.any())
        h = mix(span_hashes(low, s, e) ^ salt)
        h[h == 0] = U(1)
        yield low, s, e, h, np.searchsorted(off, s + at, "right") - 1, new


def _strings(low: np.ndarray, s: np.ndarray, e: np.ndarray) -> pa.Array:
    size = e - s
    off = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(off[-1]) + np.repeat(s - off[:-1], size)
    return pa.Array.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(low[index].tobytes())])


def _within(keys: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(keys), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, keys), len(sorted_) - 1)] == keys


class _Stream:
    """Words of a partition in order; gives them out in runs that overlap by the look-ahead."""

    def __init__(self, seed: int):
        self.seed, self.held, self.size, self.langs = seed, [], 0, {}

    def add(self, lang: pa.Array, texts: pa.Array) -> Iterator[tuple]:
        coded = pc.dictionary_encode(lang)
        code = np.array([self.langs.setdefault(x, len(self.langs)) for x in coded.dictionary.to_pylist()] or [0], np.int64)
        code = code[coded.indices.to_numpy(zero_copy_only=False)]
        for low, s, e, h, row, new in _words(texts, self.seed):
            yield "chunk", (low, s, e, h)
            if len(h):
                self.held.append((h, code[row], new))
                self.size += len(h)
            if self.size >= FLUSH_WORDS:
                yield "run", self.run(False)

    def run(self, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(hash, language, begins a piece, words to start windows at)."""
        h, code, new = (np.concatenate([x[i] for x in self.held]) for i in range(3)) if self.held else (np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, bool))
        n = len(h) if last else len(h) - (ORDER - 1)
        self.held = [] if last else [(h[n:], code[n:], new[n:])]
        self.size = len(h) - n
        return h, code, new, n


def _lang_hashes(langs: dict) -> np.ndarray:
    out = np.zeros(len(langs), U)
    for name, i in langs.items():
        b = np.frombuffer(name.encode(), np.uint8)
        out[i] = span_hashes(b, np.zeros(1, np.int64), np.array([len(b)]))[0] if len(b) else U(7)
    return out


def _places(h: np.ndarray, code: np.ndarray, new: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For phrases of two words, three words and so on from each word: their place in the filter, and whether a piece holds them."""
    key, held = mix(of[code] * _MUL + h), np.ones(len(h), bool)
    for d in range(1, ORDER):
        key[: len(h) - d] = mix(key[: len(h) - d] * _MUL + h[d:])
        held[max(len(h) - d, 0) :] = False
        held[: len(h) - d] &= ~new[d:]
        yield (key % U(FILTER_BITS)).astype(np.uint32), held


def _cut(places: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Sorted places and their counts as one row a range."""
    ranges = places >> np.uint32(16)
    first = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1]])) if len(places) else np.zeros(0, np.int64)
    bounds = np.append(first, len(places)).astype(np.int32)
    binary = lambda x: pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((bounds * x.itemsize).tobytes()), pa.py_buffer(x.tobytes())])
    none = pa.nulls(len(first), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(ranges[first].astype(np.int64)), none, binary((places & np.uint32(RANGE - 1)).astype(np.uint16)), binary(counts)], ["key", "word", "places", "counts"])


def _counter(least: int) -> type:
    """Counts above ``least`` need not be told apart."""
    return np.uint8 if least < 256 else np.uint32


def _listed(seed: int, least: int):
    """(lang, text) -> (key, word, places, counts): each word with its hash; or, without a word, a range of the filter and counts in it."""
    def run(batches):
        known, recent = np.zeros(0, U), np.zeros(0, U)  # sorted
        stream = _Stream(seed)

        def phrases(h, code, new, n):
            found = [place[:n][held[:n]] for place, held in _places(h, code, new, _lang_hashes(stream.langs))]
            places, counts = np.unique(np.concatenate(found), return_counts=True)
            return _cut(places, np.minimum(counts, least).astype(_counter(least)))

        for b in batches:
            for what, x in stream.add(b.column(0), b.column(1)):
                if what == "run":
                    yield phrases(*x)
                    continue
                low, s, e, h = x
                keys, at = np.unique(h, return_index=True)
                fresh = ~(_within(keys, known) | _within(keys, recent))
                keys, at = keys[fresh], at[fresh]
                if len(keys):
                    recent = np.sort(np.concatenate([recent, keys]))
                    if len(recent) > 1 << 16:
                        known, recent = np.sort(np.concatenate([known if len(known) < KNOWN_WORDS else known[:0], recent])), recent[:0]
                    none = pa.nulls(len(keys), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), _strings(low, s[at], e[at]).cast(pa.large_string()).cast(pa.string()), none, none], ["key", "word", "places", "counts"])
        yield phrases(*stream.run(True))

    return run


def _frequent(least: int):
    """Sorted (key, places, counts) -> (key, bits): the places of a range that are counted ``least`` times, streamed range by range."""
    def run(batches):
        range_, total, held, size = None, None, [], 0

        def add():
            nonlocal held, size
            if held:
                places, counts = (np.concatenate([np.frombuffer(x[i], t) for x in held]) for i, t in ((0, np.uint16), (1, _counter(least))))
                total[:] += np.bincount(places, counts, RANGE).astype(np.int64)
            held, size = [], 0

        def bits():
            add()
            return pa.RecordBatch.from_arrays([pa.array([range_], pa.int64()), pa.array([np.packbits(total >= least, bitorder="little").tobytes()], pa.binary())], ["key", "bits"])

        for b in batches:
            for key, places, counts in zip(*(b.column(i).to_pylist() for i in range(3))):
                if key != range_:
                    if range_ is not None:
                        yield bits()
                    range_, total = key, np.zeros(RANGE, np.int64)
                held.append((places, counts))
                size += len(places)
                if size >= 1 << 22:
                    add()
        if range_ is not None:
            yield bits()

    return run


def _windows(seed: int, bits):
    """(lang, text) -> (lang, h1..h4, n): the longest windows and how often they occur; 0 pads."""
    def run(batches):
        mask = np.frombuffer(bits.value, np.uint8)
        stream = _Stream(seed)

        def counted(h, code, new, n):
            distinct, ids = np.unique(np.concatenate([[U(0)], h]), return_inverse=True)
            ids, size = ids[1:], len(distinct)
            lead, alive = [ids[:n]], np.ones(n, bool)
            for d, (place, held) in enumerate(_places(h, code, new, _lang_hashes(stream.langs)), 1):
                place = place[:n]
                alive = alive & held[:n] & ((mask[place >> np.uint32(3)] >> (place & np.uint32(7)).astype(np.uint8)) & 1 == 1)
                column = np.zeros(n, np.int64)
                column[alive] = ids[np.flatnonzero(alive) + d]
                lead.append(column)
            head, i = np.unique((code[:n] * size + lead[0]) * size + lead[1], return_inverse=True)
            tail, j = np.unique(lead[2] * size + lead[3], return_inverse=True)
            both, counts = np.unique(i * len(tail) + j, return_counts=True)
            head, tail = head[both // max(len(tail), 1)], tail[both % max(len(tail), 1)]
            names = pa.array(list(stream.langs), pa.string())
            lang = names.take(pa.array(head // size // size))
            columns = [distinct[x].view(np.int64) for x in (head // size % size, head % size, tail // size, tail % size)]
            return pa.RecordBatch.from_arrays([lang, *map(pa.array, columns), pa.array(counts.astype(np.int64))], ["lang", "h1", "h2", "h3", "h4", "n"])

        for b in batches:
            for what, x in stream.add(b.column(0), b.column(1)):
                if what == "run":
                    yield counted(*x)
        yield counted(*stream.run(True))

    return run


def _filter(listed: DataFrame, least: int) -> bytes:
    """The bitmap of the places counted ``least`` times: FILTER_BITS / 8 bytes."""
    ranges = listed.where("places is not null").select("key", "places", "counts").repartition("key").sortWithinPartitions("key")
    out = bytearray(FILTER_BITS // 8)
    for r in ranges.mapInArrow(_frequent(least), "key long, bits binary").collect():  # at most FILTER_BITS / RANGE rows of RANGE / 8 bytes
        out[r["key"] * (RANGE // 8) : (r["key"] + 1) * (RANGE // 8)] = r["bits"]
    return bytes(out)


def counts(docs: DataFrame, least: int = 30, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Phrase counts (lang, h1..h4, order, f) of one to four words, and the words (key, word).

    ``order`` 0 is the number of all words of a language; phrases of other orders have f >= ``least``.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    seed = 0
    while True:
        listed = stored(rows.mapInArrow(_listed(seed, least), "key long, word string, places binary, counts binary"), "phrases-listed")
        words = listed.where("word is not null").groupBy("key").agg(F.min("word").alias("word"), F.max("word").alias("other"))
        words = stored(words, "phrases-words")
        if words.where("word <> other").isEmpty():
            break
        seed += 1
    bits = spark.sparkContext.broadcast(_filter(listed, least))
    found = stored(rows.mapInArrow(_windows(seed, bits), "lang string, h1 long, h2 long, h3 long, h4 long, n long"), "phrases-windows")
    columns = [f"h{i}" for i in range(1, ORDER + 1)]
    whole = found.groupBy("lang", *columns).agg(F.sum("n").alias("n"))
    rolled = whole.rollup("lang", *columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("gid"))
    # rolled-up columns are null; a phrase must not end in padding
    order = F.length(F.regexp_replace(F.lpad(F.bin(F.col("gid")), ORDER + 1, "0"), "1", "")) - 1
    rolled = rolled.where("gid <> 31").select("lang", *(F.coalesce(c, F.lit(0)).alias(c) for c in columns), order.alias("order"), "f")
    last = F.coalesce(*(F.when(F.col("order") == i, F.col(c)) for i, c in enumerate(columns, 1)), F.lit(1))
    rolled = rolled.where((last != 0) & ((F.col("f") >= least) | (F.col("order") == 0)))
    return stored(rolled, "phrases-counts"), words.select("key", "word")


def _part(start: Column, length: Column) -> list[Column]:
    """Columns h1..h4 of ``length`` words of the phrase from ``start`` (0-based) on, padded."""
    all_ = F.array(*(F.col(f"h{i}") for i in range(1, ORDER + 1)))
    return [F.when(F.lit(i) < length, F.element_at(all_, (start + F.lit(i + 1)).cast("int"))).otherwise(F.lit(0)).alias(f"p{i + 1}") for i in range(ORDER)]


def collocations(docs: DataFrame, least: int = 30, covered: int = 80, top: int = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Rows (lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by score.

    The score of a phrase is that of its weakest cut, floor(2000000 a / (l + r)). Phrases inside a longer one that
    has at least ``covered`` percent of their occurrences are dropped.
    """
    table, words = counts(docs, least, lang_col, text_col)
    columns = [f"h{i}" for i in range(1, ORDER + 1)]
    parts = [f"p{i}" for i in range(1, ORDER + 1)]
    key = ["lang", *columns]
    known = table.where("order > 0").select("lang", *(F.col(c).alias(p) for c, p in zip(columns, parts)), F.col("f").alias("g"))
    phrases = table.where("order > 1").withColumnRenamed("f", "a")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("order") - 1)))
    zero = F.lit(0)
    left = cuts.select(*key, "order", "a", "k", *_part(zero, F.col("k"))).join(known.withColumnRenamed("g", "l"), ["lang", *parts]).drop(*parts)
    both = left.select(*key, "order", "a", "k", "l", *_part(F.col("k"), F.col("order") - F.col("k"))).join(known.withColumnRenamed("g", "r"), ["lang", *parts]).drop(*parts)
    score = F.expr("(CAST(a AS DECIMAL(20,0)) * CAST(2000000 AS DECIMAL(7,0))) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    scored = both.withColumn("score", score.cast("long")).groupBy(*key, "order", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    # every phrase inside a longer one, with the most occurrences of such a longer one
    inner = phrases.where("order > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("order") - 1)))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("order") - F.col("size"))))
    inner = inner.select("lang", F.col("a").alias("longer"), *_part(F.col("start"), F.col("size")))
    inner = inner.groupBy("lang", *parts).agg(F.max("longer").alias("longer")).select("lang", *(F.col(p).alias(c) for c, p in zip(columns, parts)), "longer")
    free = F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * covered)
    kept = scored.join(inner, key, "left").where(free)
    kept = kept.select(*key, "order", "a", F.col("m.l").alias("l"), F.col("m.r").alias("r"), F.col("m.score").alias("score"))
    spelt = kept.select(*key, F.posexplode(F.slice(F.array(*columns), 1, F.col("order"))).alias("at", "key")).join(words, "key")
    spelt = spelt.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))  # at most ORDER words
    total = table.where("order = 0").select("lang", F.col("f").alias("n"))
    rows = kept.join(spelt, key)
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = rows.select("lang", F.row_number().over(by).cast("long").alias("rank"), "phrase", "a", "l", "r", "score").where(F.col("rank") <= top)
    return rows.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
