"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built of a labelled sample text. A text is parsed against it from
left to right into longest matches: a phrase ends at the character with which it no longer occurs in the
sample. The number of phrases, normalised as phrases * log2(sample length) / text length, estimates the
cross entropy in bits per character; the language needing fewest wins (ties: the smaller name).

Text is lower-cased; everything but letters becomes single spaces. The training sample is bounded by
``SAMPLE_CHARS`` letters and spaces a language, taken from labelled rows in the order of a hash of the id
(about ``SAMPLE_ROWS`` rows of any length, the first ``SAMPLE_TEXT_CHARS`` characters of each), so it is the same on every run. Whole texts are parsed: long ones in runs of ``LANE`` characters, side by
side, whose phrases are added up (a run's end closes its last phrase). Of more than ``MAX_LANGUAGES`` labels those with the most rows are
learned (equal: the smaller name).

Defined results: null texts and texts without a letter are ``und`` with score 0; a model without any
labelled row predicts ``und`` for all. ``score`` is 1 - best / second best bits per character (1 with only one
language), ``bits`` the winning estimate (null for ``und``).
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import ship

#: Characters of the training sample of one language.
SAMPLE_CHARS = 30_000
#: Characters that one labelled text gives to the sample, from its first letter on (a long one would fill it alone).
SAMPLE_TEXT_CHARS = 4_000
#: Labelled texts of a language looked at for the sample (expected number; the bound on what the driver gets).
SAMPLE_ROWS = 120
#: Languages learned: those with the most labelled rows, so that a table with a dirty column of labels needs no more
#: memory than this many samples and automata.
MAX_LANGUAGES = 128
#: Symbols of a language with a column in the transition table: 0 is a space, 1 any letter that its sample lacks, then
#: its letters by frequency. The transitions by its other letters are kept sparse.
SYMBOLS = 64
LANE = 512
#: Characters parsed together.
BLOCK = 1 << 21
UND = "und"
LETTER = r"\p{L}"

_state: dict = {}


def letters() -> np.ndarray:
    """Is a letter, by code point."""
    if "letters" not in _state:
        _state["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _state["letters"]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def plain(text: str) -> str:
    """Lower case, letters and single spaces."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton; state 0 is the root."""
    goto: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        cur = len(goto)
        goto.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in goto[p]:
            goto[p][c] = cur
            p = link[p]
        if p >= 0:
            q = goto[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(goto)
                goto.append(dict(goto[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and goto[p].get(c) == q:
                    goto[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return goto


class Parser:
    """All languages' automata in one transition table; 0 means that there is no transition."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in samples]
        held = sorted({c for _, text in samples for c in text if c != " "})
        self.symbol = np.where(letters(), np.int32(1), np.int32(0))
        for i, c in enumerate(held):
            self.symbol[ord(c)] = i + 2
        self.local = np.ones((len(samples), len(held) + 2), np.int32)  # each language's own symbols
        self.local[:, 0] = 0
        tables, keys, targets, self.roots, at = [], [], [], [], 0
        for lang, (_, text) in enumerate(samples):
            common = Counter(c for c in text if c != " ")
            for i, (c, _) in enumerate(sorted(common.items(), key=lambda x: (-x[1], x[0]))):
                self.local[lang, self.symbol[ord(c)]] = i + 2
            goto = automaton(self.local[lang, self.symbol[points(text)]].tolist())
            table = np.zeros((len(goto), SYMBOLS), np.int32)
            for state, to in enumerate(goto):
                for c, target in to.items():
                    if c < SYMBOLS:
                        table[state, c] = target + at
                    else:
                        keys.append((state + at) << 20 | c)
                        targets.append(target + at)
            tables.append(table)
            self.roots.append(at)
            at += len(goto)
        self.table = np.concatenate(tables).ravel()
        by = np.argsort(np.array(keys, np.int64))
        self.keys, self.targets = np.array(keys, np.int64)[by], np.array(targets, np.int32)[by]
        self.base = np.array(self.roots, np.int64)[:, None]
        self.log = np.array([math.log2(max(2, len(text))) for _, text in samples])

    def follow(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The states after the languages' symbols ``c``; 0 where there is no transition."""
        if not len(self.keys):
            return self.table[state * SYMBOLS + c]
        rare = c >= SYMBOLS
        to = self.table[state * SYMBOLS + np.where(rare, 1, c)]
        if rare.any():
            key = (np.broadcast_to(state, c.shape)[rare].astype(np.int64) << 20) | c[rare]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            to[rare] = np.where(self.keys[at] == key, self.targets[at], 0)
        return to

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases by language and text; letters and spaces of each text; its letters."""
        lows = [t.lower() for t in texts]
        raw = points("".join(lows))
        sym, off = self.symbol[raw], np.concatenate([[0], np.cumsum([len(t) for t in lows])])
        first = np.zeros(len(sym), bool)
        first[off[:-1][off[:-1] < len(sym)]] = True
        keep = np.ones(len(sym), bool)
        keep[1:] = (sym[1:] > 0) | (sym[:-1] > 0)
        keep[first & (sym == 0)] = False
        total = np.concatenate([[0], np.cumsum(keep)])[off]
        alpha = np.diff(np.concatenate([[0], np.cumsum(sym > 0)])[off])
        sym = sym[keep]
        size = np.diff(total)
        lanes = -(-size // LANE)
        of = np.repeat(np.arange(len(texts)), lanes)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = total[of] + nth * LANE
        n = np.minimum(LANE, total[of + 1] - start)
        order = np.argsort(-n, kind="stable")
        of, start, n = of[order], start[order], n[order]
        active = np.searchsorted(-n, -np.arange(LANE), "left")  # lanes longer than each step
        state = np.repeat(self.base, len(of), axis=1)
        found = np.zeros(state.shape, np.int32)
        for step in range(LANE):
            m = active[step]
            if not m:
                break
            c = self.local[:, sym[start[:m] + step]]
            now = state[:, :m]
            to = self.follow(now, c)
            again = self.follow(self.base, c)
            end, unseen = to == 0, again == 0
            # a phrase ends before the symbol; a symbol that the sample lacks is a phrase of its own
            found[:, :m] += (end & (now != self.base)).astype(np.int32) + (end & unseen)
            state[:, :m] = np.where(end, np.where(unseen, self.base, again), to)
        found += state != self.base
        out = np.zeros((len(self.names), len(texts)), np.int64)
        for i in range(len(self.names)):
            out[i] = np.bincount(of, weights=found[i], minlength=len(texts)).astype(np.int64)
        return out, size, alpha

    def predict(self, texts: list[str]) -> list[tuple[str, float, float | None]]:
        found, size, alpha = self.phrases(texts)
        bits = (found + 1e-9) * self.log[:, None] / np.maximum(size, 1)
        order = np.argsort(bits, axis=0, kind="stable")
        out = []
        for i in range(len(texts)):
            if not alpha[i]:
                out.append((UND, 0.0, None))
                continue
            best = bits[order[0, i], i]
            second = bits[order[1, i], i] if len(self.names) > 1 else math.inf
            out.append((self.names[order[0, i]], float(1 - best / second), float(best)))
        return out


def blocks(texts: list[str]):
    """Row ranges of about BLOCK characters."""
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + len(texts[j]) <= BLOCK):
            n += len(texts[j])
            j += 1
        yield i, j
        i = j


def _predicted(samples: tuple[tuple[str, str], ...], column: pa.Array) -> list[pa.Array]:
    if samples and _state.get("samples") != samples:
        _state.update(samples=samples, parser=Parser(samples))
    texts = [x or "" for x in column.to_pylist()]
    out = []
    for i, j in blocks(texts):
        out += _state["parser"].predict(texts[i:j]) if samples else [(UND, 0.0, None)] * (j - i)
    lang, score, bits = zip(*out, strict=True) if out else ((), (), ())
    return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())]


def _parse(samples: tuple[tuple[str, str], ...]):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), *_predicted(samples, b.column(1))], ["key", "lang_pred", "score", "bits"])

    return run


def _parse_rows(samples: tuple[tuple[str, str], ...], text_col: str):
    def run(batches):
        for b in batches:
            row = b.column(0)
            yield pa.RecordBatch.from_arrays([row, _predicted(samples, row.field(text_col))[0]], ["row", "lang_pred"])

    return run


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[tuple[str, str], ...]:
    """(language, text) of at most SAMPLE_CHARS characters each, from rows that are not held out."""
    rows = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(LETTER))
    rank = F.xxhash64(F.col(id_col).cast("string"), F.lit("sample"))
    rows = rows.withColumn("__lang", F.col(lang_col).cast("string"))
    counts = rows.groupBy("__lang").count().orderBy(F.desc("count"), "__lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return ()
    span = 1 << 62
    bounds = [(name, int(min(1.0, SAMPLE_ROWS / n) * 2 * span) - span) for name, n in counts]
    bounds = docs.sparkSession.createDataFrame(bounds, "__lang string, __below long")
    piece = F.substring(F.regexp_replace(F.col(text_col).cast("string"), r"^\P{L}++", ""), 1, SAMPLE_TEXT_CHARS)
    taken = rows.join(F.broadcast(bounds), "__lang").where(F.shiftright(rank, 1) < F.col("__below"))
    got = taken.select(F.col("__lang").alias("lang"), rank.alias("rank"), piece.alias("text")).collect()
    samples: dict[str, str] = {}
    for r in sorted(got, key=lambda r: (r.lang, r.rank, r.text)):
        if len(samples.get(r.lang, "")) < SAMPLE_CHARS:
            samples[r.lang] = f"{samples.get(r.lang, '')} {plain(r.text)}"[:SAMPLE_CHARS]
    return tuple((k, v) for k, v in sorted(samples.items()) if v.strip())


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", samples: tuple[tuple[str, str], ...] | None = None) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score, bits), one for each row of ``docs``."""
    ship(docs.sparkSession)
    samples = training_sample(docs, id_col, text_col, lang_col) if samples is None else samples
    kind = docs.schema[id_col].dataType.simpleString()
    parsed = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")).mapInArrow(_parse(samples), f"key {kind}, lang_pred string, score double, bits double")
    return parsed.select(F.col("key").alias("doc_id"), held_out("key").alias("held_out"), "lang_pred", "score", "bits")


def in_known_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a letter and so is not ``und``; one pass, no shuffle.

    Without any learned language the rows with a letter stay as well.
    """
    ship(docs.sparkSession)
    samples = training_sample(docs, id_col, text_col, lang_col)
    if not samples:
        return docs.where(F.coalesce(F.col(text_col).cast("string").rlike(LETTER), F.lit(False)))
    whole = docs.select(F.struct("*").alias("row"))
    schema = StructType([whole.schema["row"], StructField("lang_pred", StringType())])
    return whole.mapInArrow(_parse_rows(samples, text_col), schema).where(F.col("lang_pred") != UND).select("row.*")
