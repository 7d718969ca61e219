import corpus_pipeline as P
from levyline.llm.queries import ORACLE, QUERIES

from . import helpers as H
from .test_native import base_spans
from .test_packing import check
from .test_quality_decontam import leaked_by_words


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["language_id", "near_dedup", "decontamination", "pii", "packing"]
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES} and set(ORACLE) <= set(QUERIES)


def test_every_stage_against_brute_force(spark):
    """Each stage on its predecessor's rows; the last rows are those of run()."""
    import pyarrow.parquet as pq

    docs = spark.read.parquet(f"{H.SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in H.documents()}
    steps = dict(P.STAGES)

    def step(name, df):
        out = steps[name](spark, df, H.SF).collect()
        assert out[0].__fields__ == docs.columns
        return {r["doc_id"]: r.asDict() for r in out}

    frame = lambda rs: spark.createDataFrame([tuple(r[c] for c in docs.columns) for r in rs.values()], docs.schema)
    known = step("language_id", docs)
    assert known == {i: r for i, r in rows.items() if any(c.isalpha() for c in r["text"] or "")}
    kept = step("near_dedup", frame(known))
    root = H.classes({i: H.shingles(r["text"], 5) for i, r in known.items()})
    assert kept == {i: r for i, r in known.items() if root[i] == i}
    clean = step("decontamination", frame(kept))
    leaked = {d for d, _ in leaked_by_words(kept.values(), pq.read_table(f"{H.SF}/benchmark.parquet").to_pylist())}
    assert clean == {i: r for i, r in kept.items() if i not in leaked} and leaked
    masked = step("pii", frame(clean))
    assert set(masked) == set(clean)
    for i, r in masked.items():
        assert r["n_chars"] == len(r["text"]) and not base_spans(r["text"])
        if not base_spans(clean[i]["text"]) and "<context>" not in r["text"]:
            assert r["text"] == clean[i]["text"]
    packed = P.packing(spark, frame(masked), H.SF).collect()
    check(packed, {i: r["text"] for i, r in masked.items()})
    key = lambda rs: sorted(tuple(r) for r in rs)
    assert key(P.run(spark, H.SF).collect()) == key(packed)


def test_odd_and_empty_documents(spark):
    for docs in (H.odd_docs(spark), H.empty_docs(spark)):
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, H.SF)
            assert out.columns == docs.columns, name
            rows = out.collect()
            ids = [r["doc_id"] for r in rows]
            if name == "near_dedup" and rows:
                assert ids.count(13) == 0 and ids.count(1) == 1 and ids.count(None) == 1 and {4, 5, 6} <= set(ids)
            if name == "pii":
                assert len(rows) == docs.count()
    twice = spark.createDataFrame([(1, "same words again and again here", "en", "a", 1)] * 3, H.SCHEMA)
    assert len(P.near_dedup(spark, twice, H.SF).collect()) == 1
