"""Fixtures shared by the corpus operators' tests: documents with every odd case, and plain versions of the rules."""

from __future__ import annotations

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that clash with result and internal columns of the operators.
CLASHING = ["key", "row", "id", "n", "shard", "slot", "score", "hash", "base", "spans", "range", "guard", "component_id", "kept", "lang_pred", "label", "x", "sequence_id"]
PROSE = "The quick brown fox jumps over the lazy dog while a slow grey cat sleeps in the warm afternoon sun near an old wooden gate. "


def odd_rows() -> list[tuple]:
    """Nulls, empties, white space, ties, repeats and a very long text."""
    long = " ".join(f"word{i % 977} and thing{i % 31}" for i in range(60_000))
    rows = [
        (1, PROSE * 3, "en", "a", 1),
        (2, PROSE * 3, "en", "a", 1),
        (3, PROSE * 3 + "One more closing sentence.", "en", None, None),
        (4, None, "en", "a", 0),
        (5, "", "en", "a", 0),
        (6, " \t\n\r\x0b\x0c ", None, "a", 7),
        (7, "word", "en", "a", 4),
        (8, "12 34 !! 56", None, None, 11),
        (9, long, "en", "b", len(long)),
        (10, "x" * 200_000, None, "b", 200_000),
        (11, "Der schnelle braune Fuchs springt über den faulen Hund und schläft danach lange unter dem großen Baum im Garten. " * 3, "de", "b", 1),
        (12, "Über ÉTÉ ñandú ßtraße 日本語 text \U0001f600 end", None, "b", 1),
        (13, PROSE * 3, "en", "a", 1),
        (13, PROSE * 3, "en", "a", 1),
        (None, "A text whose id is missing altogether but has some words.", None, None, None),
    ]
    return rows


def odd_docs(spark, clash: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows(), SCHEMA)
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHING))) if clash else df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(sf: str = SF) -> list[dict]:
    return pq.read_table(f"{sf}/documents.parquet").to_pylist()


def classes(sets: dict[int, frozenset], percent: int = 80) -> dict[int, int]:
    """Smallest id reachable over links of Jaccard percent, by comparing all pairs."""
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) > 0:
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def shingles(text: str | None, k: int) -> frozenset:
    w = (text or "").encode().lower().split()
    if len(w) >= k:
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)]) if w else frozenset()
