import collections
import re
import zlib

import numpy as np

from levyline.llm import template_decontam as T
from levyline.llm.pairwise_quality import FEATURES, RIDGE, THRESHOLD, features, fit, rank, train
from levyline.llm.template_decontam import leaks

from . import helpers as H

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = rank(docs, train(docs, labels)).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == (r["score"] >= THRESHOLD) for r in got)
    held = [r for r in got if r["held_out"]]
    good, bad = [r["score"] for r in held if r["quality"] == 1], [r["score"] for r in held if r["quality"] == 0]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert np.mean([(r["score"] >= THRESHOLD) == (r["quality"] == 1) for r in held]) > 0.93


def test_quality_of_odd_rows(spark):
    docs = H.odd_docs(spark)
    labels = spark.createDataFrame([(1, 1), (3, 1), (9, 1), (8, 0), (7, 0), (11, 0), (None, 0), (2, None), (1, 1)], "doc_id long, quality int")
    model = train(docs, labels)
    rows = rank(docs, model).collect()
    assert len(rows) == len(H.odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (4, 5)}) == 1
    one_kind = train(docs, labels.where("quality = 1"))
    assert one_kind is None and {r["score"] for r in rank(docs, one_kind).collect()} == {0.5}
    assert train(docs, labels.limit(0)) is None
    assert rank(H.empty_docs(spark), model).collect() == []


def test_ranking_learns_an_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, len(FEATURES)))
    good = x[:, 2] + 0.1 * rng.normal(size=600) > 0.5
    w, cut = fit(x, good)
    strength = np.concatenate([x, x * x], axis=1) @ w
    assert np.mean((strength > cut) == good) > 0.95
    assert len(features("")) == len(features("a b.")) == len(FEATURES)


def test_fit_equals_plain_gradient_ascent():
    """The same pairs and the same penalised logistic loss, climbed in small steps without second derivatives."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 3)) * 0.5
    good = x @ [1.0, -2.0, 0.5] + rng.logistic(size=600) * 0.7 > 0
    w, cut = fit(x, good, pairs=4000, seed=9)
    again = np.random.default_rng(9)
    z = np.concatenate([x, x * x], axis=1)
    a, b = z[good], z[~good]
    d = a[again.integers(len(a), size=4000)] - b[again.integers(len(b), size=4000)]
    v = np.zeros(6)
    for _ in range(20000):
        v += 0.5 * (d.T @ (1 / (1 + np.exp(d @ v))) / len(d) - RIDGE * v)
    assert np.abs(v - w).max() < 1e-3 and cut == np.quantile(z @ w, np.mean(~good))
    assert (np.argsort(z @ v) == np.argsort(z @ w)).mean() > 0.9


def test_a_document_repeated_often_is_collected_once(spark):
    docs = spark.createDataFrame([(1, "A good text with words.")] * 500 + [(2, "bad | | text !!!")] * 500 + [(3, "Another good text here.")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    once = docs.dropDuplicates()
    (w, cut), (v, cut2) = train(docs, labels), train(once, labels)
    assert (w == v).all() and cut == cut2


def leaked_by_words(docs, items):
    """(doc, item) whose words share at least half of the item's 6-word windows."""
    words = lambda t: [w.lower() for w in re.findall(r"\w+", t or "")]
    index, size = collections.defaultdict(set), {}
    for r in items:
        w = words(r["text"])
        size[r["item_id"]] = max(1, len(w) - 5)
        for i in range(len(w) - 5):
            index[tuple(w[i : i + 6])].add((r["item_id"], i))
    out = set()
    for r in docs:
        w, seen = words(r["text"]), collections.defaultdict(set)
        for i in range(len(w) - 5):
            for item, j in index.get(tuple(w[i : i + 6]), ()):
                seen[item].add(j)
        out |= {(r["doc_id"], item) for item, s in seen.items() if len(s) >= 0.5 * size[item]}
    return out


def test_planted_passages_are_found_and_nothing_else(spark):
    import pyarrow.parquet as pq

    items = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    got = leaks(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == leaked_by_words(H.documents(SF), items)


ITEM = "A farmer named Alice walks 12 km to the old market and then Alice sells 30 kg of fresh apples to Robert for 45 dollars."


def test_reparameterised_questions(spark):
    other = ITEM.replace("Alice", "Maria").replace("Robert", "Stefan").replace("12 km", "7 miles").replace("30", "19").replace("45 dollars", "88 euros")
    torn = other.replace("Maria sells", "Ingrid sells")  # one name for two different ones
    plain = "A farmer may walk far to any market and then sell some apples to somebody for money."
    rows = [(1, f"Some words before. {ITEM} And after."), (2, f"Intro text here.\n{other}"), (3, torn), (4, plain), (5, ITEM.upper()), (6, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(10, ITEM), (11, None), (None, ITEM), (12, "Three short words"), (13, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in leaks(docs, items).collect()}
    assert got.pop((1, 10)) == "exact" and got.pop((2, 10)) == "re-parameterised"
    assert not {k for k in got if k[0] in (3, 4, 6, 7)}


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, H.PROSE), (2, "no such text anywhere in these documents at all, really")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks(H.odd_docs(spark), items).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (13, 1)}
    assert leaks(H.empty_docs(spark), items).collect() == []
    assert leaks(H.odd_docs(spark), items.limit(0)).collect() == []


def test_windows_of_a_long_text_do_not_depend_on_its_parts(spark, monkeypatch):
    words = " ".join(f"Word{i} and plain{i % 999} 5 km." for i in range(3000))
    docs = spark.createDataFrame([(1, words)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(words.split()[5000:5060]))], "item_id long, text string")
    whole = [r["matched"] for r in leaks(docs, items).collect()]
    monkeypatch.setattr(T, "PIECE", 8192)
    parts = [len(list(T._bounded((*T.buffer_of(a), *T.buffer_of(a)), 8))) for a in [__import__("pyarrow").array([words])]]
    assert parts[0] > 3 and len(whole) == 1


def test_items_without_a_plain_window_are_found(spark):
    texts = ["Three short words", "12 + 7 = 19", "Paris Rome Oslo Bern Wien Prag Riga Kiev Baku", "Who wrote the famous book in 1851", "True"]
    docs = [(i, f"Some text that goes on before it. {t} and more words after it.") for i, t in enumerate(texts)]
    docs += [(5, texts[0]), (6, f"Some text. {texts[0]}. More of it."), (7, f"A line\n{texts[0]}\nand another"), (8, f"Look: {texts[1]}"), (9, "we see 13 + 8 = 21 here")]
    docs += [(10, "who wrote the famous book in 1900"), (11, "three long words"), (12, "It is true that nothing is true here."), (13, "True."), (14, "- True\n- False"), (15, "Not True")]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    exact = [(2, 2), (3, 3), (5, 0), (6, 0), (7, 0), (8, 1), (13, 4), (14, 4)]  # items of under four words must stand alone
    assert got == {**dict.fromkeys(exact, "exact"), (10, 3): "re-parameterised"}


def test_a_word_at_the_border_of_parts_does_not_stand_alone(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 64)
    docs = [(1, " ".join(["never", "stands", "alone", "true", "here"] * 400)), (2, " ".join(["plain"] * 700) + ". True. " + " ".join(["plain"] * 700))]
    items = spark.createDataFrame([(1, "True")], "item_id long, text string")
    found = leaks(spark.createDataFrame(docs, "doc_id long, text string"), items)
    assert {r["doc_id"] for r in found.collect()} == {2}


def test_one_changed_value_of_several_equal_ones(spark):
    item = (
        "In the old town hall a clerk counts 5 ledgers on the left shelf and then 5 ledgers on the right shelf before the mayor "
        "asks him to carry 5 ledgers down the narrow stairs to the cellar archive"
    )
    parts = item.split("5")
    made = lambda *v: "".join(x + str(y) for x, y in zip(parts, (*v, "")))
    rows = [(1, made(5, 5, 5)), (2, made(5, 6, 5)), (3, made(8, 8, 8)), (4, made(8, 9, 8)), (5, made(7, 8, 9)), (6, item.replace("mayor", "owner")), (7, made(5, 5, 6)), (8, made(6, 5, 5))]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r["doc_id"]: r["kind"] for r in leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {1: "exact", 2: "re-parameterised", 3: "re-parameterised", 4: "re-parameterised", 6: "exact", 7: "re-parameterised", 8: "re-parameterised"}


def test_a_common_stem_does_not_pair_documents_with_all_items(spark, monkeypatch):
    """300 items on one stem: documents with the stem meet the items that also hold another window, and no leak is lost."""
    words = lambda i, n: " ".join(f"w{(i * 131 + j * 17) % 5003}x{i}" for j in range(n))
    stem = "which one of the following answers to the question below is the most correct"
    items = [(i, f"{stem} {words(i, 16)}") for i in range(300)] + [(900 + i, f"{stem} and why {i}") for i in range(30)]
    docs = [(i, f"{stem} {words(1000 + i, 20)}") for i in range(200)] + [(500 + i, f"Before. {items[i * 7][1]} and after") for i in range(40)] + [(600, f"{stem} and why 7 then")]
    items_df, docs_df = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    counts = {}
    real = T.stored
    monkeypatch.setattr(T, "stored", lambda df, name: counts.setdefault(name, real(df, name)))
    rows = {(r["doc_id"], r["item_id"], r["coverage"], r["kind"]) for r in leaks(docs_df, items_df).collect()}
    held, found = counts["benchmark"], counts["found"].withColumnRenamed("id", "doc_id")
    all_pairs = found.join(held, "hash").select("doc_id", "item_id").distinct().count()
    met = found.join(held.where("alone OR NOT common"), "hash").select("doc_id", "item_id").distinct().count()
    assert met < all_pairs / 5
    monkeypatch.setattr(T, "COMMON_ITEMS", 10**9)
    monkeypatch.setattr(T, "stored", real)
    assert rows == {(r["doc_id"], r["item_id"], r["coverage"], r["kind"]) for r in leaks(docs_df, items_df).collect()}
    assert {(d, i) for d, i, _, _ in rows} >= {(500 + i, i * 7) for i in range(40)} | {(600, 907)}


def test_an_added_or_removed_word_does_not_split_an_occurrence(spark):
    words = "a farmer walks along the muddy road to sell some fresh apples and pears at a small market nearby".split()[:20]
    rows = [(i, " ".join(words[:i] + ["very"] + words[i:])) for i in range(8, len(words) - 7)]
    rows += [(100 + i, " ".join(words[:i] + words[i + 1 :])) for i in range(8, len(words) - 8)]
    rows += [(200, " ".join(words[:9] + ["far"] * 30 + words[9:]))]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    got = {r["doc_id"] for r in leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {i for i, _ in rows[:-1]}


def test_copies_in_another_case_are_found(spark):
    names = "Paris Rome Oslo Bern Wien Prag Riga Kiev Baku"
    rows = [(5, ITEM.upper()), (6, ITEM.lower()), (7, "LOUD WORDS EVERYWHERE " * 30 + ITEM), (8, "so " + names.lower()), (9, f"SO {names.upper()}")]
    rows += [(10, ITEM.upper().replace("ALICE", "MARIA").replace("ROBERT", "JOHN"))]
    items = spark.createDataFrame([(10, ITEM), (11, names), (12, ITEM.lower())], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert {k: v for k, v in got.items() if k[0] < 10} == {(d, i): "exact" for d, i in [(5, 10), (6, 10), (7, 10), (5, 12), (6, 12), (7, 12), (8, 11), (9, 11)]}
