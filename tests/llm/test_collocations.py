import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from levyline.llm import collocations as C
from levyline.llm.collocations import collocations

from . import helpers as H


def plain(rows, least=30, covered=80, top=2000):
    """The rule on all phrases of one to four words, without windows or hashes."""
    lower = {i: i + 32 for i in range(65, 91)}
    counts = {}
    for lang, text in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            for k in range(1, 5):
                own.update(words[i : i + k] for i in range(len(words) - k + 1))
    out = set()
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i : i + m]] = max(longer[p[i : i + m]], a)
        kept = []
        for p, a in found.items():
            if p in longer and 100 * longer[p] >= covered * a:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n, -s))
    return out


def got(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("least", [3, 30])
def test_equals_plain_counts_on_the_documents(spark, least):
    rows = [(d["lang"], d["text"]) for d in H.documents()]
    docs = spark.read.parquet(f"{H.SF}/documents.parquet")
    want = plain(rows, least)
    assert len(want) > (1000 if least == 3 else 20)
    assert got(collocations(docs, least)) == want


def test_odd_rows_and_small_runs(spark, monkeypatch):
    """Runs and chunks of a few words and bytes: windows that cross them are counted whole."""
    rows = [(r[2], r[1]) for r in H.odd_rows()] + [("en", "a b a b.a b;a\nb a b a b c d e f " * 9), (None, "Und und UND, a b a b"), ("und", "und und a b"), ("", "a b a b a b"), ("en", "x" * 3000 + " y" * 5000)]
    df = spark.createDataFrame(rows, "lang string, text string").select("*", *(F.lit(1).alias(c) for c in ("h1", "n", "f", "key", "word", "rank", "order", "p1")))
    want = plain(rows, least=2)
    assert got(collocations(df, least=2)) == want
    monkeypatch.setattr(C, "FLUSH_WORDS", 50)
    monkeypatch.setattr(C, "CHUNK", 64)
    texts, langs = pa.array([r[1] for r in rows]), pa.array([r[0] or "und" for r in rows])
    found = Counter()
    full = type("Bits", (), {"value": b"\xff" * (C.FILTER_BITS // 8)})
    for b in C._windows(0, full)([pa.RecordBatch.from_arrays([langs, texts], ["lang", "text"])]):
        for lang, *h, n in zip(*(b.column(i).to_pylist() for i in range(6))):
            for k in range(1, 5):
                if h[k - 1]:
                    found[lang, tuple(h[:k])] += n
    want = {}
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate({i: i + 32 for i in range(65, 91)})):
            words = re.findall("[^\x20\x09]+", piece)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    want.setdefault((lang or "und", tuple(words[i : i + k])), 0)
                    want[lang or "und", tuple(words[i : i + k])] += 1
    assert sorted(found.values()) == sorted(want.values())


def test_words_that_share_a_hash_are_counted_with_another_seed(spark, monkeypatch):
    rows = [("en", "aa bb cc " * 40), ("en", "dd bb cc " * 40)]
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    real = C._listed

    def clashing(seed, least):
        run = real(seed, least)

        def out(batches):
            for b in run(batches):
                if seed == 0:
                    word = np.array([w is not None for w in b.column(1).to_pylist()])
                    key = np.where(word, 5, b.column(0).to_numpy())
                    b = pa.RecordBatch.from_arrays([pa.array(key), *b.columns[1:]], b.schema.names)
                yield b

        return out

    monkeypatch.setattr(C, "_listed", clashing)
    assert got(collocations(df)) == plain(rows)


def test_a_filter_that_lets_everything_pass_changes_nothing(spark, monkeypatch):
    rows = [(d["lang"], d["text"]) for d in H.documents()]
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(C, "FILTER_BITS", 1 << 16)
    assert got(collocations(docs, 5)) == plain(rows, 5)


def test_products_beyond_64_bits_and_ties(spark, monkeypatch):
    big = 6 * 10**12
    table = spark.createDataFrame(
        [("en", 1, 0, 0, 0, 1, 2 * big), ("en", 2, 0, 0, 0, 1, 3 * big), ("en", 1, 2, 0, 0, 2, big), ("en", 0, 0, 0, 0, 0, 9 * big)],
        "lang string, h1 long, h2 long, h3 long, h4 long, `order` int, f long",
    )
    words = spark.createDataFrame([(1, "one"), (2, "two")], "key long, word string")
    monkeypatch.setattr(C, "counts", lambda *a: (table, words))
    assert got(collocations(None)) == {("en", 1, "one two", big, 2 * big, 3 * big, 9 * big, 400000)}


def test_empty_table(spark):
    assert collocations(H.empty_docs(spark)).collect() == []
