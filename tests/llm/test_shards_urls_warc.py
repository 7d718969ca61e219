import collections
import gzip
import hashlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from levyline.llm import url_filter, warc
from levyline.llm.hyper_shard import _hypergeometric, draw, shares, shuffle
from levyline.llm.queries import op4_hyper_shard, op6_url_filter, op10_warc
from levyline.llm.url_filter import RULES, judge
from levyline.llm.warc import assemble, parse, read_archives, resolve, write_archives

from . import helpers as H


# sharding
def test_shards_are_exact_and_repeatable(spark):
    got = op4_hyper_shard(spark, H.SF).collect()
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in H.documents()}
    import zlib

    assert all(r["size"] == len(docs[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(docs[r["doc_id"]]) and r["law"] == "rows" for r in got)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in op4_hyper_shard(spark, H.SF).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in got}


def test_shards_of_odd_rows_keep_all_columns(spark):
    docs = H.odd_docs(spark)
    got = shuffle(docs, shards=4, block_rows=3)
    assert got.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    rows = got.collect()
    assert sorted(map(str, (r[:5] for r in rows))) == sorted(map(str, H.odd_rows()))
    sizes = collections.Counter(r["shard"] for r in rows)
    assert sorted(sizes.values()) == [3, 4, 4, 4]
    assert shuffle(H.empty_docs(spark)).collect() == []


def test_shuffle_is_uniform(spark):
    rows = spark.range(64)
    place = collections.Counter()
    for seed in range(12):
        for r in shuffle(rows, shards=2, seed=seed * 1000, block_rows=8).collect():
            place[r["id"] < 32, r["shard"]] += 1
    # 12 * 32 low ids, half of them expected in each shard; five deviations allowed
    assert abs(place[True, 0] - 192) < 5 * np.sqrt(384 * 0.25)


def test_matrix_has_its_sums_and_law():
    rng = np.random.default_rng(3)
    m = np.array([draw(rng, np.array([5, 3, 0, 8]), shares(16, 3)) for _ in range(3000)])
    assert (m.sum(axis=2) == [5, 3, 0, 8]).all() and (m.sum(axis=1) == [6, 5, 5]).all()
    # entry (0, 0) is hypergeometric: mean 5 * 6 / 16, variance n K/N (N-K)/N (N-n)/(N-1)
    assert m[:, 0, 0].mean() == pytest.approx(5 * 6 / 16, abs=0.08)
    assert m[:, 0, 0].var() == pytest.approx(5 * (6 / 16) * (10 / 16) * (11 / 15), abs=0.08)
    big = _hypergeometric(rng, 3_000_000_000, 1_000_000_000, 1000)
    assert 650 < big < 850


# URLs
def plain_verdict(url):
    url = url or ""
    if "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), v, h + p) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[1]) if fits else (host, path, None, "allow")


URLS = [
    "http://a.example.net/en/x?y#z", "http://EXAMPLE.NET/en", "https://example.net", "https://example.net/en/", "http://x.org/fr/", "http://org/fr/1",
    "http://porg/fr/1", "http://example.com/de/", "ftp://www.Example.com/de/q/", "http://a.net?x=/en/", "http://a.net#/", "no scheme", "://net/", "a://b://net/",
    None, "", "http://", "http:///en/", "http://net./", "http://xn--ä.NET/Ü", "http://example.net/en/\nx", "http://a.example.net//en/", "x" * 5000 + "://net/" + "a/" * 3000,
]


@pytest.mark.parametrize("limit", [url_filter.BROADCAST_CHARS, 0])
def test_urls_equal_plain_rules(spark, monkeypatch, limit):
    monkeypatch.setattr(url_filter, "BROADCAST_CHARS", limit)
    rows = [(i, u, None, "clash") for i, u in enumerate(URLS)] + [(0, URLS[0], "again", "clash"), (None, URLS[3], None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule string")
    rules = spark.createDataFrame([*RULES, RULES[0], (None, "net", "/"), ("block", None, "/")], "verdict string, host string, path string")
    got = collections.Counter(tuple(r) for r in judge(pages, rules).collect())
    assert got == collections.Counter((i, *plain_verdict(u)) for i, u, *_ in rows)
    assert judge(pages.limit(0), rules).collect() == []
    assert {r["verdict"] for r in judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_rules_that_end_within_a_path_part(spark):
    pages = spark.createDataFrame([(1, "http://h.com/abc/def"), (2, "http://h.com/ab"), (3, "http://h.com/"), (4, "http://h.com/abc/x")], "page_id long, url string")
    rules = spark.createDataFrame([("block", "h.com", "/ab"), ("allow", "h.com", "/abc/d"), ("block", "h.com", "/abc/d")], "verdict string, host string, path string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge(pages, rules).collect()}
    assert got == {1: ("h.com/abc/d", "block"), 2: ("h.com/ab", "block"), 3: (None, "allow"), 4: ("h.com/ab", "block")}


def test_registered_url_query(spark):
    got = op6_url_filter(spark, H.SF).count()
    assert got == spark.read.parquet(f"{H.SF}/pages.parquet").count()


# WARC
PAGE = "page_id long, url string, html string, digest string"


def test_round_trip_with_revisits(spark):
    long = "<html>" + "ä\r\n\r\nWARC/1.1\r\n" * 300 + "</html>"
    rows = [(5, "http://a/x", long, "c"), (2, "http://b", long, "c"), (9, "http://c\r\nEvil: 1", long, None), (1, None, "short", "c"), (3, "u", "short", "c")]
    rows += [(4, "http://d", None, "c"), (6, "http://e", "", "c"), (7, "http://f", "x" * 99, "c"), (8, "http://f", "x" * 99, "c"), (10, "http://g", "x" * 100, "c"), (11, "http://h", "x" * 100, "c")]
    pages = spark.createDataFrame(rows, PAGE)
    captures = assemble(read_archives(spark, write_archives(pages)))
    got = {int(r["value"]): (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in resolve(captures).collect()}
    payload = {r[0]: (r[2] or "").encode() for r in rows}
    first = {2: None, 5: "2", 9: "2", 11: "10"}
    for i, p in payload.items():
        to = first.get(i)
        assert got[i] == (len(p), hashlib.sha256(p).hexdigest(), "revisit" if to else "response", to)
    for c in captures.collect():
        assert c["request"] is not None and len(c["metadata"]) == 1
        if c["response"]["type"] == "response":
            assert hashlib.sha256(c["response"]["payload"]).hexdigest() == c["response"]["declared_digest"]


def test_repeated_and_null_ids(spark):
    rows = [(1, "u", "y" * 200, ""), (1, "u", "y" * 200, ""), (1, "v", "z" * 200, ""), (None, "w", "y" * 200, "")]
    got = collections.Counter((r["value"], r["record_type"]) for r in resolve(assemble(read_archives(spark, write_archives(spark.createDataFrame(rows, PAGE))))).collect())
    assert sum(got.values()) == 4 and got["1", "response"] + got["1", "revisit"] == 3
    # a row without an id is a response of its own: others do not refer to it, nor it to them
    shared = [(None, "w", "y" * 200, ""), (None, "v", "y" * 200, ""), (5, "a", "y" * 200, ""), (3, "b", "y" * 200, "")]
    df = spark.createDataFrame(shared, PAGE)
    found = {(r["value"], r["record_type"], r["refers_to"]) for r in resolve(assemble(read_archives(spark, write_archives(df)))).collect()}
    assert found == {(None, "response", None), ("3", "response", None), ("5", "revisit", "3")}
    assert resolve(assemble(read_archives(spark, write_archives(spark.createDataFrame([], PAGE))))).collect() == []


def test_assembly_through_either_side_and_another_record(spark):
    def one(kind, rid, to=(), body=b"", ctype="application/http"):
        return warc.record(kind, rid, [("WARC-Concurrent-To", t) for t in to] + [("Content-Type", ctype)], body)

    blob = one("response", "<r1>", ["<q1>"], b"HTTP/1.1 200 OK\r\n\r\nhello") + one("request", "<q1>") + one("metadata", "<m1>", ["<q1>"], b"k: v", "application/warc-fields")
    blob += one("request", "<q9>", ["<gone>"]) + one("revisit", "<r2>") + one("warcinfo", "<i>", (), b"software: x", "application/warc-fields")
    import tempfile

    folder = tempfile.mkdtemp(prefix="levyline-warc-")
    for name, data in (("a.warc", blob), ("b.warc.gz", gzip.compress(one("metadata", "<m2>", ["<r2>", "<r1>"], b"n: 2", "application/warc-fields")))):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(data)
    files = spark.createDataFrame([(f"{folder}/a.warc",), (f"file://{folder}/b.warc.gz",)], "path string")
    got = {r["capture_id"]: r for r in assemble(read_archives(spark, files)).collect()}
    assert got["<r1>"]["request"]["record_id"] == "<q1>" and {m["record_id"] for m in got["<r1>"]["metadata"]} == {"<m1>", "<m2>"}
    assert bytes(got["<r1>"]["response"]["payload"]) == b"hello"
    assert got["<q9>"]["response"] is None and got["<r2>"]["response"]["type"] == "revisit"


def test_broken_archives_are_reported():
    good = warc.record("response", "<r>", [("Content-Type", "application/http")], b"HTTP/1.1 200 OK\r\n\r\nx" * 50)
    assert len(list(parse(io.BytesIO(good), True))) == 1
    with pytest.raises(ValueError, match="within a record"):
        list(parse(io.BytesIO(good[:-200]), True))
    with pytest.raises(ValueError, match="not a WARC record"):
        list(parse(io.BytesIO(b"hello\r\n"), True))


def test_clashing_columns_and_a_very_long_payload(spark):
    rows = [(1, "u", "long é " * 700_000, ""), (2, "u", "long é " * 700_000, ""), (3, None, None, "")]
    df = spark.createDataFrame(rows, PAGE)
    df = df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(("page", "html_", "digest", "size", "nth", "first", "to", "n", "path", "record_id", "payload"))))
    got = {r["value"]: r for r in resolve(assemble(read_archives(spark, write_archives(df), with_payload=False))).collect()}
    size = len(rows[0][2].encode())
    assert {i: (r["payload_bytes"], r["record_type"], r["refers_to"]) for i, r in got.items()} == {"1": (size, "response", None), "2": (size, "revisit", "1"), "3": (0, "response", None)}
    assert got["2"]["payload_digest"] == hashlib.sha256(rows[0][2].encode()).hexdigest()


def test_registered_warc_query(spark):
    assert op10_warc(spark, H.SF).count() == spark.read.parquet(f"{H.SF}/pages.parquet").count()
