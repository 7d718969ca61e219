import numpy as np
from pyspark.sql import functions as F

from levyline.llm import crossparse
from levyline.llm.crossparse import LANE, SYMBOLS, Parser, automaton, identify, in_known_language, plain, training_sample

from . import helpers as H


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = docs.select("doc_id", "lang").join(identify(docs), "doc_id").where("held_out").collect()
    assert len(got) > 200 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.98 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows(spark):
    docs = H.odd_docs(spark)
    got = identify(docs).collect()
    assert len(got) == len(H.odd_rows())
    by = {r["doc_id"]: r for r in got}
    for i in (4, 5, 6, 8):
        assert (by[i]["lang_pred"], by[i]["score"], by[i]["bits"]) == ("und", 0.0, None)
    assert by[11]["lang_pred"] in ("de", "en") and by[1]["lang_pred"] == "en"
    kept = in_known_language(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 7, 9, 10, 11, 12, 13, 13]


def test_empty_and_unlabelled(spark):
    assert identify(H.empty_docs(spark)).collect() == []
    rows = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in identify(rows).collect()] == ["und"]


def test_held_out_rows_do_not_train(spark):
    docs = spark.createDataFrame([(i, f"held{i} out words", "en") for i in range(200)], "doc_id long, text string, lang string")
    import zlib

    [(_, sample)] = training_sample(docs, "doc_id", "text", "lang")
    held = {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert len(sample) <= crossparse.SAMPLE_CHARS and sample.startswith(" held out words")
    assert len(sample.split()) == 3 * (200 - len(held)) or len(sample.split()) < 3 * 200


def naive(sample: str, text: str) -> int:
    """Greedy longest matches by substring search; a phrase ends at the character that does not fit."""
    phrases = 0
    for at in range(0, len(text), LANE):
        part, i = text[at : at + LANE], 0
        while i < len(part):
            j = i
            while j < len(part) and part[i : j + 1] in sample:
                j += 1
            phrases += 1
            i = max(j, i + 1)
    return phrases


def test_parse_equals_substring_search():
    a, b = plain("the cat sat on the mat and the hat was flat " * 4), plain("le chat est sur le tapis et il dort bien la nuit " * 4)
    parser = Parser((("en", a), ("fr", b)))
    texts = ["the cat on the flat mat", "le chat dort la nuit the", "the mat " * 300, "", "a"]
    found, size, alpha = parser.phrases(texts)
    for t, text in enumerate(texts):
        low = plain(text)
        assert size[t] - len(low) in (0, 1)  # a closing space stays
        for lang, sample in enumerate((a, b)):
            assert found[lang, t] == naive(sample, (low + " ")[: size[t]])


def test_automaton_accepts_just_the_substrings():
    rng = np.random.default_rng(3)
    s = rng.integers(1, 4, 60).tolist()
    goto = automaton(s)
    subs = {tuple(s[i:j]) for i in range(60) for j in range(i + 1, min(60, i + 5) + 1)}
    from itertools import product

    for n in range(1, 5):
        for w in product((1, 2, 3), repeat=n):
            state, ok = 0, True
            for c in w:
                if c not in goto[state]:
                    ok = False
                    break
                state = goto[state][c]
            assert ok == (w in subs)
    assert SYMBOLS > 3


def test_long_labelled_texts_train_and_nothing_learned_drops_nothing(spark):
    en, de = "the cat sat on the mat and then ", "der hund liegt auf dem boden und "
    rows = [(i, "12 " + (en if i % 2 else de) * 300, "en" if i % 2 else "de") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = dict(training_sample(docs, "doc_id", "text", "lang"))
    assert set(samples) == {"de", "en"} and all(len(x) > 1000 for x in samples.values())
    assert all(r["lang_pred"] == rows[r["doc_id"]][2] for r in identify(docs).collect())
    bare = spark.createDataFrame([(1, "some text", None), (2, "1 2", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in in_known_language(bare).collect()] == [1]


def test_languages_of_many_letters_are_told_apart():
    rng = np.random.default_rng(7)
    draw = lambda first: "".join(chr(first + i) for i in rng.integers(0, 300, 3000))
    a, b = draw(0x4E00), draw(0x5E00)
    parser = Parser((("a", a), ("b", b), ("en", plain("the cat sat on the mat " * 9))))
    texts = [a[700:760], b[100:160], a[:300] + b[:40], "the mat"]
    found, _, _ = parser.phrases(texts)
    assert found[:2].tolist() == [[naive(x, t) for t in texts] for x in (a, b)]
    assert [r[0] for r in parser.predict(texts)] == ["a", "b", "a", "en"]


def test_a_dirty_label_column_learns_the_commonest_only(spark, monkeypatch):
    monkeypatch.setattr(crossparse, "MAX_LANGUAGES", 2)
    rows = [(i, H.PROSE, "en") for i in range(40)] + [(100 + i, H.odd_rows()[10][1], "de") for i in range(30)] + [(1000 + i, f"junk text {i} here", f"x{i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = crossparse.training_sample(docs, "doc_id", "text", "lang")
    assert [name for name, _ in samples] == ["de", "en"]
    clash = docs.select("*", *(F.lit(0).alias(c) for c in ("count", "rank", "key", "piece")))
    assert crossparse.training_sample(clash, "doc_id", "text", "lang") == samples
