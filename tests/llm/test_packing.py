import collections
import struct
import zlib

import numpy as np

from levyline.llm import harmonic_pack
from levyline.llm.harmonic_pack import cut, first_fit, pack, token_bytes

from . import helpers as H


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return [*tokenizer().encode(text or "", add_special_tokens=False).ids, 2]


def check(rows, texts):
    by, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append(r)
    assert set(by) == set(texts)
    tok = tokenizer()
    for doc, parts in by.items():
        ids, at = [*tok.encode(texts[doc] or "", add_special_tokens=False).ids, 2], 0
        for p in sorted(parts, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(struct.pack(f"<{p['length']}I", *ids[at : at + p["length"]]))
            at += p["length"]
        assert at == len(ids)
    for parts in seqs.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 4096
    assert sorted(seqs) == list(range(len(seqs)))
    return seqs


def test_round_trip_and_little_padding(spark):
    docs = spark.read.parquet(f"{H.SF}/documents.parquet")
    seqs = check(pack(docs).collect(), {r["doc_id"]: r["text"] for r in H.documents()})
    total = sum(p["length"] for s in seqs.values() for p in s)
    assert len(seqs) * 4096 <= 1.03 * total + 4096


def test_odd_rows(spark):
    docs = H.odd_docs(spark).where("doc_id <> 13")
    check(pack(docs).collect(), {r[0]: r[1] for r in H.odd_rows() if r[0] not in (13, None)})
    twice = [r for r in pack(H.odd_docs(spark).where("doc_id = 13")).collect()]
    assert sum(r["length"] for r in twice) == 2 * twice[0]["doc_tokens"]
    assert len(pack(H.odd_docs(spark).where("doc_id IS NULL")).collect()) >= 1


def test_empty_table(spark):
    assert pack(H.empty_docs(spark)).collect() == []


def test_classes_hold_a_fixed_number(spark):
    rows = [(i, "a " * (1500 + i % 3)) for i in range(40)]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    full = collections.Counter((r["sequence_id"], r["length"]) for r in got)
    assert max(n for (_, length), n in full.items() if length == 1365) == 3
    seqs = collections.Counter()
    for r in got:
        seqs[r["sequence_id"]] += r["length"]
    assert sum(1 for n in seqs.values() if n < 4090) <= 1


def test_with_ids(spark):
    rows = [(1, "hello world " * 3000), (2, "short")]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string"), with_ids=True).collect()
    for doc, text in rows:
        parts = sorted((r for r in got if r["doc_id"] == doc), key=lambda r: r["start"])
        assert [i for p in parts for i in p["ids"]] == ids_of(text)


def test_word_memory_equals_whole_encoding(monkeypatch):
    odd = ["It's 3.14, isn't it?!", "<|endoftext|> and <|STARTOFTEXT|>", "don't.,;", "Ünïcode… wörd.", "naïve space x y", "é. ä,", "??!", "1,2.3:", "ΣΑΣ. İx", "tab\x0bx\x1cy", "can't've'll.", "\U0001f600, ok."]
    for limit in (500_000, 3):
        monkeypatch.setattr(harmonic_pack, "REMEMBERED", limit)
        for text in odd * 2:
            assert np.frombuffer(token_bytes(text, None), "<u4").tolist() == ids_of(text)[:-1], text


def test_cut_and_first_fit():
    for n in (1, 63, 64, 100, 1365, 1366, 2048, 4095, 4096, 4097, 100_000):
        parts = cut(n, 4096, 64)
        assert sum(parts) == n and all(0 < p <= 4096 for p in parts)
    lengths = np.array([3000, 2000, 1000, 96, 50])
    bins, offsets = first_fit(lengths, 4096)
    assert bins.tolist() == [0, 1, 0, 0, 1] and offsets.tolist() == [0, 0, 3000, 4000, 2000]
