"""Document fingerprints by winnowing, in DataFrame functions only.

A text is read as tokens: runs of at most ``TOKEN_CHARS`` characters that are not white space. A longer run, as of a text
without spaces, is cut where the hash of the last three characters says so (about every eighth character, ``LONGEST`` at most), so its
tokens depend on what it says and not on where it begins: a shift changes the tokens at its edge only. Every ``K`` tokens in a row make a k-gram
hash. Of every ``WINDOW`` k-grams in a row the smallest hash is kept, the rightmost of equal ones, with its
position. Two texts that share ``K + WINDOW - 1`` tokens in a row share a fingerprint entry; within a long run these are the tokens after
the first place where both are cut.

An entry packs 40 bits of hash over 24 bits of reversed position, so that the minimum of a window is found
with plain ``least`` (and equal hashes give the rightmost); minima of windows of 2, 4 and 8 entries come from
one another by pairwise minima, so a window costs three comparisons.

Defined results: fewer than ``WINDOW`` k-grams make one window, fewer than ``K`` tokens one k-gram of all of them;
null and blank texts have an empty fingerprint. Likeness is the Jaccard measure of the hashes: 1 for two empty
fingerprints, 0 for one. Positions count modulo 2**24.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from .common import split_count

TOKEN_CHARS = 16
#: Longer runs: a cut where the hash of three characters is 0 modulo this, the longest token, and the characters cut at a time.
CUT = 8
LONGEST = 64
BLOCK = 1 << 16
K = 4
WINDOW = 8
POSITION_BITS = 24
POSITIONS = (1 << POSITION_BITS) - 1
#: Documents of one range of ids, on average.
RANGE_ROWS = 1000
QUANTILES = 32


def _entry(h: Column, position: Column) -> Column:
    return h.bitwiseAND(F.lit(-1 - POSITIONS)).bitwiseOR(F.lit(POSITIONS) - F.pmod(position, F.lit(POSITIONS + 1)))


def _cut(run: Column) -> Column:
    """The tokens of a long run."""
    def marked(chars: Column) -> Column:
        ends = lambda c, i: F.pmod(F.xxhash64(F.get(chars, i - 2), F.get(chars, i - 1), c), F.lit(CUT)) == 0
        return F.array_join(F.transform(chars, lambda c, i: F.when(ends(c, i), F.concat(c, F.lit(" "))).otherwise(c)), "")

    chars = F.regexp_extract_all(run, F.lit("(?s)."), F.lit(0))
    # an array of the one array of characters, so that they are made once and not for each of them
    return F.regexp_extract_all(F.get(F.transform(F.array(chars), marked), 0), F.lit(rf"\S{{1,{LONGEST}}}"), F.lit(0))


def tokens(text: Column) -> Column:
    runs = F.regexp_extract_all(text, F.lit(rf"\S{{1,{BLOCK}}}"), F.lit(0))
    split = F.flatten(F.transform(runs, lambda w: F.when(F.length(w) <= TOKEN_CHARS, F.array(w)).otherwise(_cut(w))))
    return F.when(text.rlike(rf"\S{{{TOKEN_CHARS + 1}}}"), split).otherwise(runs)


def with_fingerprint(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Adds ``out``: the entries of the text's fingerprint, in order of position."""
    tok, n, h = f"{out}_tok", f"{out}_n", f"{out}_h"
    g, m2, m4 = f"{out}_g", f"{out}_m2", f"{out}_m4"
    df = df.withColumn(tok, tokens(F.coalesce(F.col(text_col), F.lit(""))))
    df = df.withColumn(h, F.transform(tok, lambda t: F.xxhash64(t))).withColumn(n, F.size(tok)).drop(tok)
    grams = F.transform(
        F.slice(h, F.lit(1), F.col(n) - (K - 1)),
        lambda x, i: _entry(F.xxhash64(x, *(F.get(h, i + d) for d in range(1, K))), i.cast("long")),
    )
    few = F.when(F.col(n) > 0, F.array(_entry(F.xxhash64(h), F.lit(0).cast("long")))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(g, F.when(F.col(n) >= K, grams).otherwise(few)).withColumn(n, F.size(g)).drop(h)

    def minima(of: str, shift: int, covered: int) -> Column:
        """Minimum of each entry and the one ``shift`` later; ``covered`` entries stand behind each minimum."""
        left = F.col(n) - (covered - 1)
        return F.zip_with(F.slice(of, F.lit(1), left), F.slice(of, F.lit(shift + 1), left), lambda x, y: F.least(x, y))

    long = F.col(n) >= WINDOW
    df = df.withColumn(m2, F.when(long, minima(g, 1, 2)))
    df = df.withColumn(m4, F.when(long, minima(m2, 2, 4))).drop(m2)
    one = F.when(F.col(n) > 0, F.array(F.array_min(g))).otherwise(F.col(g))
    return df.withColumn(out, F.when(long, F.array_distinct(minima(m4, 4, 8))).otherwise(one)).drop(m4, g, n)


def hashes(entries: Column) -> Column:
    return F.array_distinct(F.transform(entries, lambda x: F.shiftright(x, POSITION_BITS)))


def shown(entries: Column) -> Column:
    """``position:hash`` of the entries, comma-joined."""
    one = lambda x: F.concat((F.lit(POSITIONS) - x.bitwiseAND(F.lit(POSITIONS))).cast("string"), F.lit(":"), F.substring(F.lpad(F.hex(x), 16, "0"), 1, 10))
    return F.array_join(F.transform(entries, lambda x: one(x)), ",")


def likeness(a: str, b: str) -> Column:
    """Jaccard measure of two distinct hash arrays."""
    both = F.size(F.array_intersect(a, b))
    all_ = F.size(a) + F.size(b) - both
    return F.when(all_ == 0, F.lit(1.0)).otherwise(both / all_)


def id_ranges(docs: DataFrame, rows: int = RANGE_ROWS) -> Column:
    """A number for ranges of ids of about ``rows`` documents, ascending with the id: quantiles of the ids, each cut evenly."""
    points = [i / QUANTILES for i in range(1, QUANTILES)]
    low, high, n, inner = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1)), F.percentile_approx("doc_id", points, 1000)).first()
    if low is None:
        return F.lit(0).cast("long")
    edges = [low, *sorted(set(inner) - {low}), high + 1]
    each = split_count(n, rows * (len(edges) - 1))
    at = F.lit(0).cast("long")
    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        part = F.floor((F.col("doc_id") - a).cast("double") / float(b - a) * each)
        at = F.when(F.col("doc_id") >= a, F.least(part, F.lit(each - 1)) + k * each).otherwise(at)
    return F.coalesce(at, F.lit(0)).cast("long")


def in_ranges(docs: DataFrame) -> tuple[DataFrame, WindowSpec]:
    """``docs(doc_id, text)`` in a form where a lead over the returned window finds the next document by id
    (after the last: the first); rows with ``guard`` = 1 are to be dropped afterwards.

    Documents are dealt out by range of ids; every range also gets a copy of the first document of the range
    after it, so a lookup never crosses ranges and no order of all documents is made in one place.
    """
    docs = docs.withColumn("range", id_ranges(docs))
    first = docs.groupBy("range").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    ring = first.select("range")
    order = Window.orderBy("range")  # one row a range
    last = ring.agg(F.max("range").alias("last")).first()["last"]
    ring = ring.withColumn("to", F.coalesce(F.lag("range").over(order), F.lit(last)))
    guards = first.join(ring, "range").select(F.col("to").alias("range"), "first.*", F.lit(1).alias("guard"))
    rows = docs.select("range", "doc_id", "text", F.lit(0).alias("guard")).unionByName(guards.select("range", "doc_id", "text", "guard"))
    return rows, Window.partitionBy("range").orderBy("guard", "doc_id", "text")


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document's text.

    The edited text has the last floor(n / 2) code points replaced by the first as many of the next document.
    Rows (doc_id, text, edited, fingerprint, edited_fingerprint, next_fingerprint) with entry arrays.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows, order = in_ranges(docs)
    rows = with_fingerprint(rows, "text", "fingerprint")
    rows = rows.withColumn("next_text", F.lead("text").over(order)).withColumn("next_fingerprint", F.lead("fingerprint").over(order))
    rows = rows.where("guard = 0").drop("guard", "range")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited).drop("next_text")
    return with_fingerprint(rows, "edited", "edited_fingerprint")
