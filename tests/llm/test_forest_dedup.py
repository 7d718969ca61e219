import random
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from levyline.llm import lsh_forest
from levyline.llm.common import components
from levyline.llm.lsh_forest import near_duplicates
from levyline.llm.shingles import PIECE, shingle_sets, word_hashes

from tests.conftest import ROOT

from . import helpers as H


def result(df):
    return {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_equals_all_pairs_on_the_documents(spark):
    docs = spark.read.parquet(f"{H.SF}/documents.parquet")
    sets = {r["doc_id"]: H.shingles(r["text"], 4) for r in H.documents()}
    root = H.classes(sets)
    assert result(near_duplicates(docs, k=4)) == {(i, len(s), root[i], root[i] == i) for i, s in sets.items()}


def test_odd_rows(spark):
    rows = near_duplicates(H.odd_docs(spark), k=4).collect()
    assert len(rows) == len(H.odd_rows())
    by = {r["doc_id"]: r for r in rows}
    assert [by[i]["component_id"] for i in (1, 2, 13)] == [1, 1, 1] and [by[i]["kept"] for i in (1, 2, 13)] == [True, False, False]
    for i in (4, 5, 6):  # no words: linked with nothing
        assert (by[i]["n_shingles"], by[i]["component_id"], by[i]["kept"]) == (0, i, True)
    assert by[7]["n_shingles"] == 1 and by[9]["n_shingles"] == len(H.shingles(H.odd_rows()[8][1], 4))
    assert by[None]["component_id"] is None and by[None]["kept"]


def test_empty_table(spark):
    assert near_duplicates(H.empty_docs(spark)).collect() == []


def near_copies(n: int, seed: int = 1):
    """A large group of near copies, each with its own few changes, and lone documents."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**9)}"
        rows.append((i, " ".join(words)))
    rows += [(n + i, " ".join(f"q{rng.randrange(10**9)}" for _ in range(50))) for i in range(40)]
    return rows


def test_dense_region_goes_deeper_and_keeps_all_links(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION_ROWS", 20)
    rows = near_copies(240)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    root = H.classes({i: H.shingles(t, 4) for i, t in rows})
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, k=4).collect()}
    assert got == root and len(set(root.values())) < 60


def test_candidates_grow_with_the_rows_not_their_square(spark):
    rows = spark.createDataFrame(near_copies(400), "id long, text string")
    signed = rows.mapInArrow(lsh_forest._sign(4), "id long, n long, set_key binary, sig binary")
    assert lsh_forest.candidates(lsh_forest.forest(signed)).count() <= 400 * lsh_forest.TREES * lsh_forest.NEIGHBOURS


def test_components_against_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000, i) for i in range(1001, 1100)] + [(i, i + 1) for i in range(2000, 2100)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in parent}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_of_a_long_text_do_not_depend_on_the_pieces():
    import pyarrow as pa

    text = " ".join(f"w{i}" for i in range(400_000))
    assert len(text) > 2 * PIECE
    whole, _ = word_hashes(pa.array([text]))
    parts = [word_hashes(pa.array([" ".join(f"w{i}" for i in range(a, a + 1000))]))[0] for a in range(0, 400_000, 100_000)]
    for k, p in enumerate(parts):
        assert (whole[k * 100_000 : k * 100_000 + 1000] == p).all()
    assert len(next(shingle_sets(pa.array([text]), 4))) == 399_997
    assert [len(s) for s in shingle_sets(pa.array(["a b", None, "", "a b c d e"]), 4)] == [1, 0, 0, 2]


def family(n: int, seed: int = 2):
    """One template; members are below 0.8 to each other, but every 20th is a pair above it with the one before."""
    rng = random.Random(seed)
    rows, last = [], []
    for i in range(n):
        places = rng.sample(range(4, 296, 5), 6)
        own = [(p, f"z{i}x{p}") for p in places]
        if i % 20 == 19:  # keeps three of its predecessor's changes
            taken = {p for p, _ in last[:3]}
            own = last[:3] + [(p, w) for p, w in own if p not in taken][:3]
        last, words = own, [f"w{j}" for j in range(300)]
        for p, w in own:
            words[p] = w
        rows.append((i * 7919 % 1000003, " ".join(words)))
    return rows


def test_pairs_in_a_family_that_is_itself_below_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION_ROWS", 20)
    rows = family(500)
    root = H.classes({i: H.shingles(t, 4) for i, t in rows})
    assert 20 < sum(root[i] != i for i in root) < 150
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, k=4).collect()} == root


def background(n: int, share: int, seed: int = 3):
    """One template of 300 words of which every member changes ``share``; every 25th takes most changes of the one before."""
    rng = random.Random(seed)
    rows, last = [], []
    for i in range(n):
        own = [(p, f"z{i}x{p}") for p in rng.sample(range(4, 296, 4), share)]
        if i % 25 == 24:
            taken = {p for p, _ in last[: share - 2]}
            own = last[: share - 2] + [x for x in own if x[0] not in taken][:2]
        last, words = own, [f"w{j}" for j in range(300)]
        for p, w in own:
            words[p] = w
        rows.append((i * 7919 % 1000003, " ".join(words)))
    return rows


@pytest.mark.parametrize("share", [13, 11, 9])  # background likeness about 0.70, 0.75, 0.79
def test_families_just_below_the_threshold(spark, monkeypatch, share):
    monkeypatch.setattr(lsh_forest, "REGION_ROWS", 50)
    rows = background(600, share)
    sets = {i: H.shingles(t, 4) for i, t in rows}
    root = H.classes(sets)
    assert 10 < sum(root[i] != i for i in root) < 400
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, k=4).collect()} == root


def test_compared_pairs_grow_with_a_family_not_its_square(spark):
    """All members open: the pairs to be compared are about the planted ones, whatever the size."""
    share = {}
    for n in (1000, 4000):
        docs = spark.createDataFrame(background(n, 11), "id long, text string")
        sets = docs.mapInArrow(lsh_forest._sets(4), "id long, n long, shingles binary")
        sets = sets.withColumns({"component": F.col("id"), "open": F.lit(True)})
        share[n] = lsh_forest.rare_pairs(sets, 80).count() / n
    assert share[4000] < 1.5 * max(share[1000], 0.04) and share[4000] < 3


def test_rare_pairs_hold_every_link(spark):
    rng = random.Random(8)
    rows = []
    for i in range(150):
        base = [f"b{rng.randrange(60)}" for _ in range(rng.choice([3, 5, 20, 30]))] if i % 3 == 0 or not rows else rows[rng.randrange(len(rows))][1].split()
        words = [w if rng.random() > 0.02 else f"n{i}" for w in base] + ([f"t{i}"] if rng.random() < 0.3 else [])
        rows.append((i, " ".join(words)))
    for k, percent in ((1, 80), (2, 60), (4, 80)):
        sets = {i: H.shingles(t, k) for i, t in rows}
        want = {(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) > 0}
        df = spark.createDataFrame(rows, "id long, text string").mapInArrow(lsh_forest._sets(k), "id long, n long, shingles binary")
        pairs = lsh_forest.rare_pairs(df.withColumns({"component": F.col("id"), "open": F.lit(True)}), percent)
        assert want <= {(min(r["a"], r["b"]), max(r["a"], r["b"])) for r in pairs.collect()} and len(want) > 20


def test_in_a_session_that_has_shipped_nothing():
    """The operator called on its own: executors get the package from it, not from a query that ran before."""
    code = """
import sys, tempfile
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.python.worker.reuse", "false").getOrCreate()
spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="levyline-test-"))
from levyline.llm.lsh_forest import near_duplicates
docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words in this one text")], "doc_id long, text string")
print(sorted(r["component_id"] for r in near_duplicates(docs).collect()))
"""
    out = subprocess.run([sys.executable, "-c", code.format(root=ROOT)], capture_output=True, text=True, cwd=tempfile.mkdtemp(prefix="levyline-test-"), timeout=300)
    assert out.stdout.strip().endswith("[1, 1, 3]"), out.stderr[-2000:]
