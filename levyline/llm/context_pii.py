"""Personal data: fixed patterns, and bootstrapped contextual extraction, in DataFrame functions only.

Base spans are the leftmost non-overlapping matches of four patterns, kept when they pass their check. They are
the seeds of the bootstrapping. Every other token with a digit or ``@`` is a candidate identifier; the one and two
words before a token, together with the token's shape, are its lexical patterns. Spark scores the graph of
patterns and instances in rounds until no score changes: a pattern is as reliable as the share of its distinct instances that are
believed, an instance is believed as its patterns are reliable (seeds always). Candidates in a pattern with
at least ``MIN_INSTANCES`` instances, ``MIN_SEEDS`` of them seeds or believed by ``MIN_SCORE`` in the round before, and a reliability of ``MIN_SCORE`` are spans of kind ``context``.
Long hexadecimal strings are seeds too, but not base spans.

Positions are code points, ends exclusive. A match's position is the length of everything before it: the gaps
that ``split`` leaves and the matches that ``regexp_extract_all`` returns alternate. Running totals are taken in
chunks, so a text with very many matches costs little more than linear time. The patterns are written
with possessive repeats that start only where a run starts (or the previous match ended), which matches
the same spans without backtracking on long runs.

Defined results: null and empty texts have no spans. Candidates may be of any length; those (and shapes)
of more than ``MAX_TOKEN`` characters are kept as their hash. Spans found
by context never overlap base spans. Repeated rows get the same spans, each row its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# The patterns of the kinds, in the kinds' order, and what a text must hold to match at all.
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CONTEXT = "context"
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
SECRET = "^[0-9a-f]{32,}$"

MAX_TOKEN = 256
CONTEXT_CHARS = 48
#: Decimals to which scores must have settled.
SETTLED = 4
MIN_INSTANCES = 3
MIN_SEEDS = 2
MIN_SCORE = 0.8
CHUNK = 64

SPANS = "array<struct<start:int,ord:int,end:int,kind:string>>"


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, also where ``use`` names it in an inner function."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, combine) -> Column:
    """For each place of an int array the combination (a sum, or a maximum) of what stands before it, from 0."""
    fold = lambda array, start, n: F.aggregate(F.slice(array, start, n), F.lit(0), combine)

    def by_chunks(v: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor(F.size(v) / CHUNK).cast("int"))
        parts = F.transform(chunks, lambda c: fold(v, c * CHUNK + 1, F.lit(CHUNK)))
        return let(parts, lambda p: let(F.transform(p, lambda _, c: fold(p, F.lit(1), c)), lambda heads: F.transform(v, lambda _, i: at(v, heads, i))))

    def at(v: Column, heads: Column, i: Column) -> Column:
        chunk = F.floor(i / CHUNK).cast("int")
        return combine(F.get(heads, chunk), fold(v, chunk * CHUNK + 1, i - chunk * CHUNK))

    return let(values, by_chunks)


def with_matches(df: DataFrame, text: str, needs: str, pattern: str, out: str) -> DataFrame:
    """Adds ``out``: array of (start, value, left) of the pattern's matches; ``left`` ends just before the match."""
    hits, gaps = f"{out}_hits", f"{out}_gaps"
    df = df.withColumn(hits, F.when(F.col(text).rlike(needs), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn(gaps, F.when(F.size(hits) > 0, F.split(text, pattern, -1)))

    def placed(h: Column, g: Column) -> Column:
        lengths = F.zip_with(h, F.slice(g, F.lit(1), F.size(h)), lambda x, y: F.length(x) + F.length(y))
        return let(running(lengths, lambda a, x: a + x), lambda before: F.transform(h, lambda value, i: one(h, g, before, value, i)))

    def one(h: Column, g: Column, before: Column, value: Column, i: Column) -> Column:
        gap = F.get(g, i)
        left = F.concat(F.coalesce(F.get(h, F.greatest(i - 1, F.lit(0))), F.lit("")), gap)
        left = F.when(i > 0, left).otherwise(gap)
        return F.struct((F.get(before, i) + F.length(gap)).alias("start"), value.alias("value"), F.substring(left, -CONTEXT_CHARS, CONTEXT_CHARS).alias("left"))

    empty = F.array().cast("array<struct<start:int,value:string,left:string>>")
    both = let(F.col(hits), lambda h: let(F.col(gaps), lambda g: placed(h, g)))
    return df.withColumn(out, F.coalesce(F.when(F.size(hits) > 0, both), empty)).drop(hits, gaps)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The check sum of a digit string is a multiple of 10."""
    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), lambda d, i: _doubled(d.cast("int"), i))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _doubled(d: Column, i: Column) -> Column:
    twice = d * 2
    return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))


def passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def with_base(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the base spans by start, then kind."""
    found = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        df = with_matches(df, text, NEEDS[kind], pattern, f"{out}_{kind}")
        found.append(_spans(f"{out}_{kind}", kind, n))
    return df.withColumn(out, F.array_sort(F.concat(*found))).drop(*(f"{out}_{k}" for k in PATTERNS))


def _spans(matches: str, kind: str, n: int) -> Column:
    good = F.filter(matches, lambda m: passes(kind, m["value"]))
    return F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(n).alias("ord"), (m["start"] + F.length(m["value"])).alias("end"), F.lit(kind).alias("kind")))


def _shape(core: Column) -> Column:
    """Runs of digits as 9, of letters and digits as x, of letters as a."""
    mixed = F.regexp_replace(core, "(?<![A-Za-z0-9])(?:[A-Za-z]++[0-9]|[0-9]++[A-Za-z])[A-Za-z0-9]*+", "\u0001")
    return F.translate(F.regexp_replace(F.regexp_replace(mixed, "[0-9]+", "9"), "[A-Za-z]+", "a"), "\u0001", "x")


def _brief(value: Column) -> Column:
    """The value itself, or the hash of one that is longer than ``MAX_TOKEN``."""
    return F.when(F.length(value) <= MAX_TOKEN, value).otherwise(F.sha2(value, 256))


def with_candidates(df: DataFrame, text: str, base: str, out: str) -> DataFrame:
    """Adds ``out``: candidate identifiers (start, end, instance, patterns, inside a base span, secret)."""
    df = with_matches(df, text, "[0-9@]", CANDIDATE, out)

    def one(m: Column) -> Column:
        lead = F.length(F.regexp_extract(m["value"], "^[^A-Za-z0-9+]*+", 0))
        core = F.regexp_replace(F.substring(m["value"], lead + 1, F.length(m["value"])), "(?<![^A-Za-z0-9])[^A-Za-z0-9]++$", "")
        return F.struct((m["start"] + lead).alias("start"), core.alias("core"), F.translate(F.lower(m["left"]), "0123456789", "9999999999").alias("left"))

    def two(m: Column, spans: Column) -> Column:
        end = m["start"] + F.length(m["core"])
        words = F.filter(F.split(m["left"], r"\s+"), lambda w: w != "")
        shape = _brief(_shape(m["core"]))
        patterns = F.array_distinct(F.transform(F.array(F.lit(1), F.lit(2)), lambda n: F.concat(F.array_join(F.slice(words, -F.least(n, F.greatest(F.size(words), F.lit(1))), n), " "), F.lit("\u0001"), shape)))
        inside = F.exists(spans, lambda b: (b["start"] < end) & (m["start"] < b["end"]))
        secret = m["core"].rlike(SECRET)
        return F.struct(m["start"].alias("start"), end.alias("end"), _brief(F.lower(m["core"])).alias("instance"), patterns.alias("patterns"), inside.alias("inside"), secret.alias("secret"))

    df = df.withColumn(out, F.filter(F.transform(out, one), lambda m: F.length(m["core"]) > 0))
    return df.withColumn(out, let(F.col(base), lambda spans: F.transform(out, lambda m: two(m, spans))))


def reliable_patterns(candidates: DataFrame) -> DataFrame:
    """Patterns that are believed, from ``candidates(instance, patterns, seed)``: rows (pattern, score).

    Edges are pre-aggregated to one row for each pattern and instance; each round is two joins of edges with
    one row per node and two aggregations, and its result is written to the shared folder. Scores only grow from round to
    round (belief grows with them), so they settle.
    """
    edges = candidates.select("instance", "seed", F.explode("patterns").alias("pattern"))
    edges = stored(edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    belief = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("belief"))
    before = None
    while True:
        scored = edges.join(belief, "instance").groupBy("pattern")
        scores = scored.agg((F.sum("belief") / F.count(F.lit(1))).alias("score"), F.count(F.lit(1)).alias("n"), F.sum((F.col("belief") >= MIN_SCORE).cast("int")).alias("seeds"))
        scores = stored(scores.where((F.col("n") >= MIN_INSTANCES) & (F.col("seeds") >= MIN_SEEDS) & (F.col("score") >= 0.5)), "patterns")
        now = tuple(scores.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("pattern", F.round("score", SETTLED)))).first())
        if now == before:
            return scores.where(F.col("score") >= MIN_SCORE).select("pattern", "score")
        before = now
        doubt = edges.join(scores.select("pattern", "score"), "pattern").groupBy("instance").agg(F.sum(F.log(1 - 0.95 * F.col("score"))).alias("doubt"))
        belief = edges.groupBy("instance").agg(F.max("seed").alias("seed")).join(doubt, "instance", "left")
        belief = stored(belief.select("instance", F.when(F.col("seed"), 1.0).otherwise(1 - F.exp(F.coalesce("doubt", F.lit(0.0)))).alias("belief")), "belief")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, text_key, base, spans): the base spans and all spans of every row of ``docs``.

    ``text_key`` is a hash of the text, which tells apart rows that share an id.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    rows = with_candidates(with_base(rows, "text", "base"), "text", "base", "found")
    rows = stored(rows.select("doc_id", "text_key", "base", "found"), "spans")
    each = rows.where(F.size("found") > 0).select("doc_id", "text_key", F.explode("found").alias("m")).select("doc_id", "text_key", "m.*")
    good = reliable_patterns(each.withColumn("seed", F.col("inside") | F.col("secret"))).select("pattern")
    new = each.where("not inside").select("doc_id", "text_key", "start", "end", F.explode("patterns").alias("pattern")).join(good, "pattern")
    span = F.struct("start", F.lit(len(PATTERNS)).alias("ord"), "end", F.lit(CONTEXT).alias("kind"))
    new = new.groupBy("doc_id", "text_key").agg(F.collect_set(span).cast(SPANS).alias("more"))
    same = F.col("r.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("r.text_key") == F.col("n.text_key"))
    out = rows.alias("r").join(new.alias("n"), same, "left")
    spans = F.array_sort(F.concat(F.col("r.base"), F.coalesce("n.more", F.array().cast(SPANS))))
    return out.select("r.doc_id", "r.text_key", "r.base", spans.alias("spans"))


def shown(spans: Column | str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"], F.lit(":"), s["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the first is kept."""
    def piece(s: Column, at: Column) -> Column:
        between = F.substring(text, at + 1, F.greatest(s["start"] - at, F.lit(0)))
        return F.when(s["start"] >= at, F.concat(between, F.lit("<"), s["kind"], F.lit(">"))).otherwise(F.lit(""))

    def cut_up(all_: Column) -> Column:
        ends = running(F.transform(all_, lambda s: s["end"]), lambda a, x: F.greatest(a, x))
        rest = F.substring(text, F.array_max(F.transform(all_, lambda s: s["end"])) + 1, F.length(text))
        return F.concat(F.array_join(F.zip_with(all_, ends, piece), ""), rest)

    return F.when(F.size(spans) > 0, let(spans, cut_up)).otherwise(text)
