"""Winnowing and personal data against plain Python."""

import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from levyline.llm import context_pii, winnow
from levyline.llm.context_pii import find, redact, shown
from levyline.llm.queries import op3_winnow, op8_context_pii
from levyline.llm.winnow import edited_pairs, with_fingerprint

from . import helpers as H

PYTHON_NODES = ("Python", "Pandas", "Arrow")


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def chained(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64(struct.pack("<q", v), seed=seed).intdigest()
    return signed(seed)


def tokens(text):
    """Runs up to 16 characters; longer ones cut after characters whose hash, with the two before, is 0 modulo 8."""
    for run in re.findall(r"[^ \t\n\x0b\f\r]{1,65536}", text):
        if len(run) <= 16:
            yield run
            continue
        held = ""
        for i, c in enumerate(run):
            held, seed = held + c, 42
            for x in run[max(0, i - 2) : i + 1]:
                seed = xxhash.xxh64(x.encode(), seed=seed).intdigest()
            if signed(seed) % 8 == 0 or len(held) == 64 or i == len(run) - 1:
                yield held
                held = ""


def fingerprint(text):
    """(40-bit hash, position) of the minima of all windows, rightmost of equal ones."""
    h = [signed(xxhash.xxh64(t.encode(), seed=42).intdigest()) for t in tokens(text)]
    if not h:
        return []
    grams = [chained(h[i : i + 4]) for i in range(len(h) - 3)] if len(h) >= 4 else [chained(h)]
    grams = [g >> 24 for g in grams]
    out = []
    for i in range(max(1, len(grams) - 7)):
        low = min(grams[i : i + 8])
        at = max(j for j in range(i, min(i + 8, len(grams))) if grams[j] == low)
        if (low, at) not in out[-1:]:
            out.append((low, at))
    return out


def entries(values):
    return [(v >> 24, winnow.POSITIONS - (v & winnow.POSITIONS)) for v in values]


def like(a, b):
    a, b = {x for x, _ in a}, {x for x, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_winnowing_equals_brute_force(spark):
    docs = sorted(H.documents(), key=lambda r: r["doc_id"])
    got = {r["doc_id"]: r for r in op3_winnow(spark, H.SF).collect()}
    prints = [fingerprint(r["text"] or "") for r in docs]
    for i, r in enumerate(docs):
        text, after = r["text"] or "", docs[(i + 1) % len(docs)]["text"] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        g = got[r["doc_id"]]
        assert g["n_chars"] == len(text) and g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert g["fingerprint"] == ",".join(f"{p}:{h & ((1 << 40) - 1):010X}" for h, p in prints[i])
        assert g["near_edited"] == pytest.approx(like(prints[i], fingerprint(edited)))
        assert g["near_next"] == pytest.approx(like(prints[i], prints[(i + 1) % len(docs)]))


def test_winnowing_of_odd_rows(spark):
    rows = edited_pairs(H.odd_docs(spark)).collect()
    assert len(rows) == len(H.odd_rows())
    for r in rows:
        assert entries(r["fingerprint"]) == fingerprint(r["text"]) or len(r["text"]) > 100_000
        assert entries(r["edited_fingerprint"]) == fingerprint(r["edited"]) or len(r["edited"]) > 50_000
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] and by[4]["fingerprint"] == by[6]["fingerprint"] == []
    assert by[13]["next_fingerprint"] == by[13]["fingerprint"] or by[13]["next_fingerprint"] == by[None]["fingerprint"]
    assert edited_pairs(H.empty_docs(spark)).collect() == []
    one = edited_pairs(spark.createDataFrame([(5, "alone here")], "doc_id long, text string")).collect()
    assert one[0]["edited"] == "alonealone"[: 5] + "alone" and len(one) == 1


def test_ranges_do_not_change_the_next_document(spark, monkeypatch):
    rows = spark.createDataFrame([(i * i, f"text of {i}") for i in range(60)], "doc_id long, text string")
    whole = {r["doc_id"]: r["edited"] for r in edited_pairs(rows).collect()}
    monkeypatch.setattr(winnow, "id_ranges", lambda docs: F.floor(F.sqrt("doc_id") / 7).cast("long"))
    assert {r["doc_id"]: r["edited"] for r in edited_pairs(rows).collect()} == whole


def test_match_guarantee(spark):
    """Two texts that share K + WINDOW - 1 tokens in a row share an entry's hash."""
    common = " ".join(f"c{i}" for i in range(winnow.K + winnow.WINDOW - 1))
    rows = [(i, " ".join(f"{i}x{j}" for j in range(i % 7)) + " " + common + " " + " ".join(f"{i}y{j}" for j in range(i))) for i in range(12)]
    df = with_fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), "text", "f").collect()
    sets = [{v >> 24 for v in r["f"]} for r in df]
    assert all(a & b for a in sets for b in sets)


def test_a_shift_of_a_text_without_spaces_changes_its_edge_only(spark):
    rng = random.Random(11)
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(3000))
    code = "".join(rng.choice("0123456789abcdef") for _ in range(3000))
    rows = [(i, t) for n, x in enumerate((chinese, code)) for i, t in ((10 * n, x), (10 * n + 1, "x" + x), (10 * n + 2, x[1500:] + x[:1500]), (10 * n + 3, f"Some words before {x} and after it"))]
    got = {r["doc_id"]: entries(r["f"]) for r in with_fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), "text", "f").collect()}
    for i, t in rows:
        assert got[i] == fingerprint(t)
    for n in (0, 10):
        assert like(got[n], got[n + 1]) > 0.9 and like(got[n], got[n + 2]) > 0.85 and like(got[n], got[n + 3]) > 0.85
    assert like(got[0], got[10]) < 0.05


def test_native_plans(spark):
    for query in (op3_winnow, op8_context_pii):
        plan = query(spark, H.SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in PYTHON_NODES)


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def accepted(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text):
    found = [(m.start(), n, m.end(), k) for n, (k, p) in enumerate(KINDS.items()) for m in re.finditer(p, text) if accepted(k, m.group())]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]


TRICKY = [
    "a@b.c_d@e.f and x.y@z.w.v. a@b a@b. @c.d",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 1.2.3 .1.2.3.4. 1..2.3.4.5",
    "4111 1111 1111 1111 4111-1111-1111-1111-1 41111111111111112 4111  1111 0000 0000 0000 00",
    "+1 (017) 555-7713 +1-2 ++49 30 123456 78) +1.....2 +12 345 678 9012345 6789",
    "é\U0001f600 me@host.example.com \U0001f600 10.0.0.1 ñ +49 30 1234567",
    "5555555555554444@mail.example.com 5500 0000 0000 0004 192.168.0.1 a@1.2.3.4",
    "1 2 3 4 5 6 7 8 9 0 " * 50 + "@",
    "a" * 3000 + "@" + "b" * 3000 + ".c " + "+" * 200 + "9" * 500 + "." * 100,
]


def test_base_spans_equal_brute_force(spark):
    got = {r["doc_id"]: r for r in op8_context_pii(spark, H.SF).collect()}
    for r in H.documents():
        spans = base_spans(r["text"] or "")
        g = got[r["doc_id"]]
        assert g["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert all(g[f"n_{k}"] == sum(s.startswith(k) for s in spans) for k in KINDS)
        assert [s for s in g["spans"].split(",") if s and not s.startswith("context")] == spans


def test_tricky_texts_and_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(TRICKY)]
    got = {r["doc_id"]: r["s"] for r in find(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", shown("base").alias("s")).collect()}
    assert got == {i: ",".join(base_spans(t)) for i, t in rows}
    odd = find(H.odd_docs(spark)).collect()
    assert len(odd) == len(H.odd_rows()) and all(r["spans"] == [] for r in odd)
    assert find(H.empty_docs(spark)).collect() == []


def test_context_discovers_unseen_identifiers(spark):
    card = "4111111111111111"
    rows = [(i, f"some words here, pay with card {card[:-2]}{(i * 7) % 100:02d} today") for i in range(40)]
    rows += [(100 + i, f"chapter {1000 + i} begins") for i in range(20)]
    rows += [(200 + i, f"and then please mail to user{i}@host.example.com or nobody") for i in range(5)]
    rows += [(300, "and then please mail to someone2(at)host or not"), (301, "chapter 7 of 9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in find(docs).collect()}
    assert all("context" not in got[i] for i in (*range(100, 120), 301))
    assert sum("email" in got[200 + i] for i in range(5)) == 5
    hexes = [(400 + i, f'value token = "{hashlib.sha1(str(i).encode()).hexdigest()}" end') for i in range(6)] + [(500, 'now token = "SHORT12345" end')]
    got = {r["doc_id"]: r["spans"] for r in find(spark.createDataFrame(hexes, "doc_id long, text string")).collect()}
    assert all(len(got[400 + i]) == 1 for i in range(6)) and len(got[500]) == 1
    s = got[500][0]
    assert hexes[-1][1][s["start"] : s["end"]] == "SHORT12345" and s["kind"] == context_pii.CONTEXT


def test_redact(spark):
    rows = [(1, "é mail me@host.example.com or 10.0.0.1."), (2, "nothing"), (3, "1.2.3.4"), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = docs.join(find(docs), "doc_id").select("doc_id", redact(F.col("text"), F.col("spans")).alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in out} == {1: "é mail <email> or <ip>.", 2: "nothing", 3: "<ip>", 4: ""}


def test_long_tokens_and_patterns_of_discovered_identifiers(spark):
    long = hashlib.sha512(b"x").hexdigest() * 4
    rows = [(i, f'value token = "{hashlib.sha1(str(i).encode()).hexdigest()}" end') for i in range(6)] + [(10, f'value token = "{long}" end')]
    # keys of no seed's form, known after "token =", lead to a pattern that no seed stands in
    rows += [(20 + i, f'value token = "KEY{i}A" end') for i in range(4)] + [(30 + i, f"then badge number KEY{i}A was shown") for i in range(4)]
    rows += [(40, "then badge number QRS77B was shown")]
    rows += [(50 + i, f"chapter {1000 + i} begins") for i in range(9)]
    got = {r["doc_id"]: r["spans"] for r in find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    shown_ = lambda i: [text[i][s["start"] : s["end"]] for s in got[i] if s["kind"] == context_pii.CONTEXT]
    assert shown_(10) == [long]
    assert shown_(40) == ["QRS77B"] and shown_(30) == ["KEY0A"]
    assert not any(got[50 + i] for i in range(9))


def plain_scores(rows):
    """Scores of the patterns by the rule, in plain Python, until they settle."""
    edges = {(p, i) for i, patterns, _ in rows for p in patterns}
    seeds = {i for i, _, seed in rows if seed}
    belief, before = {i: float(i in seeds) for _, i in edges}, None
    while True:
        scores = {}
        for p in {p for p, _ in edges}:
            own = [belief[i] for q, i in edges if q == p]
            if len(own) >= 3 and sum(b >= 0.8 for b in own) >= 2 and sum(own) / len(own) >= 0.5:
                scores[p] = sum(own) / len(own)
        now = {p: round(s, 4) for p, s in scores.items()}
        if now == before:
            return {p: s for p, s in scores.items() if s >= 0.8}
        before = now
        for i in belief:
            doubt = 1.0
            for p in (p for p, j in edges if j == i and p in scores):
                doubt *= 1 - 0.95 * scores[p]
            belief[i] = 1.0 if i in seeds else 1 - doubt


def test_scores_settle_as_in_plain_python(spark):
    rng = random.Random(12)
    rows = []
    for _ in range(600):  # a chain of contexts: each is believed only through the identifiers of the one before
        n = rng.randrange(12)
        rows.append((f"id{n}-{rng.randrange(4)}", [f"p{n}", f"p{min(11, n + (rng.random() < 0.5))}"], n == 0 and rng.random() < 0.9))
    rows += [(f"other{i}", [f"q{i % 5}"], i % 11 == 0) for i in range(60)]
    df = spark.createDataFrame(rows, "instance string, patterns array<string>, seed boolean")
    got = {r["pattern"]: r["score"] for r in context_pii.reliable_patterns(df).collect()}
    want = plain_scores(rows)
    assert got.keys() == want.keys() and len(want) >= 2 and all(abs(got[p] - want[p]) < 1e-3 for p in want)
    assert context_pii.reliable_patterns(df.limit(0)).collect() == []


def test_very_long_tokens_take_linear_time(spark):
    rows = [(1, "9" * 200_000), (2, "a" * 100_000 + "." * 100_000 + "9b" + "/" * 100_000 + "x"), (3, "1/a" * 50_000)]
    assert len(find(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == 3
