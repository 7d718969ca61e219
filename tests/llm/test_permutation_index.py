import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from levyline.llm import permutation_index as ann
from levyline.llm import queries as Q
from levyline.llm.permutation_index import nearest

from . import helpers as H

VECTORS = "vec_id long, embedding array<float>, label int"


def multiples():
    return F.col("id") % 20 == 0


def plain(rows, divisor=20, k=20):
    """All pairs: {query: [(vec_id, score)]}, nearest first."""
    width = max((len(v) for _, v in rows if v), default=0)
    ok = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        v = [float(x) for x in np.array(v, np.float32)]
        ok[i] = min(ok[i], v) if i in ok else v
    ids = sorted(ok)
    m = np.array([ok[i] + [0.0] * (width - len(ok[i])) for i in ids])
    out = {}
    for i in ids:
        if i % divisor == 0:
            s = np.add.accumulate(m * np.array(ok[i] + [0.0] * (width - len(ok[i]))), axis=1)[:, -1]
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(ids[j], s[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got = out.setdefault(r["query_id"], [])
        got.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got)
    return out


@pytest.mark.parametrize("sf", [H.SF, "/root/testdata/sf0.1"])
def test_recall_against_all_pairs(spark, sf):
    rows = pq.read_table(f"{sf}/embeddings.parquet").to_pylist()
    want = plain([(r["vec_id"], r["embedding"]) for r in rows])
    got = found(Q.op11_permutation_index(spark, sf))
    assert got.keys() == want.keys()
    scores = {i: dict(plain_all) for i, plain_all in plain([(r["vec_id"], r["embedding"]) for r in rows], k=len(rows)).items()}
    for q, list_ in got.items():
        assert len(list_) == min(20, len(rows) - 1) and all(s == scores[q][i] for i, s in list_)
        assert list_ == sorted(list_, key=lambda x: (-x[1], x[0]))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_odd_vectors(spark):
    rng = random.Random(3)
    v = lambda n=6: [rng.gauss(0, 1) for _ in range(n)]
    same = v()
    rows = [(i, v()) for i in range(1, 30)] + [(40, same), (41, same), (42, same), (60, same), (60, same)]
    rows += [(80, v(3)), (81, v(2)), (100, [0.0] * 6), (101, [1.0, float("nan")]), (102, [1.0, None]), (103, [float("inf")]), (104, []), (105, None), (None, v()), (120, None), (140, [1.0] * 6), (140, [0.5] * 6)]
    clash = [F.lit(1).alias(c) for c in ("id", "v", "cls", "q", "score", "rank", "side", "file", "place", "nth")]
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], VECTORS).select("*", *clash)
    assert found(nearest(df, multiples())) == plain(rows)


def test_many_equal_vectors_and_few_rows(spark):
    rng = random.Random(4)
    other = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(300)]
    rows = [(i, [1.0] * 8) for i in range(0, 400)] + [(1000 + i, x) for i, x in enumerate(other)]
    got = found(nearest(spark.createDataFrame([(i, x, 0) for i, x in rows], VECTORS), multiples()))
    want = plain(rows)
    assert got.keys() == want.keys() and all(got[q] == want[q] for q in want if q < 400)
    few = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [-1.0, 0.0])]
    assert found(nearest(spark.createDataFrame([(i, x, 0) for i, x in few], VECTORS), multiples())) == plain(few)


def test_queries_that_find_too_few_are_compared_with_all_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "PROBES", 1)
    monkeypatch.setattr(ann, "LISTS", 1)
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(200)]
    assert found(nearest(spark.createDataFrame([(i, x, 0) for i, x in rows], VECTORS), multiples())) == plain(rows)


def test_blocks_change_nothing(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(400)]
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], VECTORS)
    monkeypatch.setattr(ann, "STEP", 10**6)
    one = found(nearest(df, multiples()))
    monkeypatch.setattr(ann, "BLOCK_ROWS", 7)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 3)
    assert found(nearest(df, multiples())) == one


def test_vectors_of_differing_length(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) * 10 ** rng.uniform(-1, 1)] * 1 + [rng.gauss(0, 3) for _ in range(5)]) for i in range(600)]
    want, got = plain(rows), found(nearest(spark.createDataFrame([(i, x, 0) for i, x in rows], VECTORS), multiples()))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_empty_and_all_unusable(spark):
    assert nearest(spark.createDataFrame([], VECTORS), multiples()).collect() == []
    assert nearest(spark.createDataFrame([(0, [0.0], 1), (20, None, 1)], VECTORS), multiples()).collect() == []
