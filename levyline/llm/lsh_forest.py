"""MinHash near-duplicate detection with an LSH forest.

Every document becomes the set of its distinct k-word shingles and a MinHash signature. The forest holds
several sorted orders of the signatures ("trees"): tree t reads the signature cyclically from its own offset, and
its order is that of the label so read. A region is a run of an order whose rows share a prefix; the prefix starts
``BASE_DEPTH`` hashes long and is lengthened only where a region holds more than ``REGION_ROWS`` rows (adaptive
depth), so dense parts of the space go deep and sparse parts stay shallow. Candidates are the next
``NEIGHBOURS`` rows in a region's order, which share the longest prefixes. Rows that agree beyond the deepest
prefix are split into blocks and each is also linked to the region's first row. In regions too large for
that to compare all pairs, rows that are then still outside the region's largest component are open. They are joined with
all rows of such regions on their rarest shingles: two sets of Jaccard 0.8 share a shingle among the first ninth of the
smaller and the first fifth of the larger, in any order common to all sets, so no link is lost, and in order of rarity few
other pairs share one, also in a family of texts whose members are all but 0.8 alike.

Equal shingle sets are one class from the start (partial aggregation, however many copies), so only different
sets meet in the forest. Candidates pass a bound on set sizes and on signature agreement, and every link is
then confirmed on the full sets rebuilt from the texts. Confirmation takes the best candidates of each row
first, contracts what they link, and then confirms every candidate that still joins two components; a
candidate inside a component cannot change the result.

Defined results: null or blank texts have an empty set, link with nothing, and keep their own id as component;
rows with a null id are never linked and have a null component. Repeated rows of an id share its component.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, ship, stored
from .shingles import U, mix, shingle_sets

TREES = 24
BASE_DEPTH = 4
HASHES = TREES * BASE_DEPTH
#: Prefix lengths a region may have; a label has as many hashes as the longest.
DEPTHS = (4, 5, 6, 8, 10, 12, 16)
#: A region with more rows is split by the next depth.
REGION_ROWS = 10_000
#: Neighbours on one side of a row in a region's order.
NEIGHBOURS = 2
#: Counters of each of the two rows of the sketch that orders shingles by rarity (8 MB in all; it only saves work).
COUNTERS = 1 << 20
COUNTER_RANGE = 1 << 15
#: Words of 64 bits of the parity bitmap of a set: sets differ in at least as many shingles as their bitmaps in bits.
PARITY = 8
_R = np.random.RandomState(20240229)
_XOR = _R.randint(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_MUL = _R.randint(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (shingles >> U(32)).astype(np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(low, ((x[i : i + 2048, None] ^ _XOR) * _MUL).min(axis=0), out=low)
    return low


def _sign(k: int):
    def run(batches):
        for b in batches:
            n, keys, sigs = [], [], []
            for s in shingle_sets(b.column(1), k):
                n.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sigs.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())], ["id", "n", "set_key", "sig"])

    return run


def _read_from(sig: np.ndarray, tree: int, depth: int) -> np.ndarray:
    return sig[:, (tree * BASE_DEPTH + np.arange(depth)) % HASHES]


def _regions(batches):
    """(id, sig) -> (id, tree, region) for each tree; a region is named by a hash of tree and prefix."""
    for b in batches:
        if not b.num_rows:
            continue
        sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, HASHES)
        out = []
        for t in range(TREES):
            h = np.full(len(sig), mix(np.array([t + 1], U))[0])
            for c in _read_from(sig, t, BASE_DEPTH).T:
                h = mix(h * U(0xD6E8FEB86659FD93) + c.astype(U))
            out.append(h.view(np.int64))
        ids = pa.chunked_array([b.column(0)] * TREES).combine_chunks()
        trees = np.repeat(np.arange(TREES, dtype=np.int32), len(sig))
        yield pa.RecordBatch.from_arrays([ids, pa.array(trees), pa.array(np.concatenate(out))], ["id", "tree", "region"])


def _labels(batches):
    """(id, sig, trees) -> (id, tree, label) for the given trees; labels compare as their hashes in order."""
    for b in batches:
        rows = [(i, t) for i, trees in enumerate(b.column(2).to_pylist()) for t in trees]
        if not rows:
            continue
        at, tree = np.array(rows).T
        sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, HASHES)
        columns = (tree[:, None] * BASE_DEPTH + np.arange(DEPTHS[-1])) % HASHES
        label = sig[at[:, None], columns].astype(">u4")
        labels = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * DEPTHS[-1]), len(at), [None, pa.py_buffer(label.tobytes())]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(tree.astype(np.int32)), labels], ["id", "tree", "label"])


def _agreement(least: int):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint32).reshape(-1, HASHES) for i in (2, 3))
            same = (x == y).sum(axis=1)
            out = pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(same.astype(np.int32))], ["a", "b", "same"])
            yield out.filter(pa.array(same >= least))

    return run


def _confirm(k: int, percent: int):
    def run(batches):
        last, kept = None, None
        for b in batches:
            keep = []
            for i in range(b.num_rows):
                a = b.column(0)[i].as_py()
                if a != last:
                    last, kept = a, next(shingle_sets(b.column(2).slice(i, 1), k))
                other = next(shingle_sets(b.column(3).slice(i, 1), k))
                both = len(np.intersect1d(kept, other, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(kept) + len(other) - both))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def _prefix(depth: int) -> Column:
    return F.xxhash64("tree", F.substring("label", 1, 4 * depth))


def forest(sets: DataFrame) -> DataFrame:
    """Rows (id, tree, label, size, region, first) of ``sets(id, sig)`` that share a region with others.

    ``size`` counts the region's rows; ``first`` is the smallest id of a region that no depth could split.
    """
    rows = sets.select("id", "sig").mapInArrow(_regions, "id long, tree int, region long")
    shared = rows.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    trees = rows.join(shared, "region").groupBy("id").agg(F.collect_list("tree").alias("trees"))  # at most TREES each
    rows = sets.select("id", "sig").join(trees, "id").mapInArrow(_labels, "id long, tree int, label binary")
    rows = stored(rows.withColumn("region", _prefix(BASE_DEPTH)), "labels")
    sizes = rows.groupBy("region").agg(F.count(F.lit(1)).alias("size"))
    rows = stored(rows.join(sizes, "region").select("id", "tree", "label", "region", "size", F.lit(None).cast("long").alias("first")), "forest")
    for depth in DEPTHS[1:]:  # lengthen the prefix where a region is still too large
        deep = rows.where(F.col("size") > REGION_ROWS)
        if deep.isEmpty():
            return rows
        deep = deep.select("id", "tree", "label", _prefix(depth).alias("region"))
        sizes = deep.groupBy("region").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("first"))
        rows = stored(rows.where(F.col("size") <= REGION_ROWS).unionByName(deep.join(sizes, "region").select(*rows.columns)), "forest")
    blocks = F.ceil(F.col("size") / REGION_ROWS)
    block = F.xxhash64("region", F.pmod(F.xxhash64("id"), blocks))
    too_large = F.col("size") > REGION_ROWS
    return rows.withColumn("region", F.when(too_large, block).otherwise(F.col("region"))).withColumn("first", F.when(too_large, F.col("first")))


def _pairs(rows: DataFrame, of: str, others: str) -> DataFrame:
    rows = rows.select(F.col(of).alias("x"), F.explode(others).alias("y")).where("x <> y")
    return rows.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def candidates(rows: DataFrame) -> DataFrame:
    """Next neighbours (a, b), a < b, in the orders of ``forest`` rows."""
    order = Window.partitionBy("region").orderBy("label", "id")
    near = [F.lead("id", i).over(order) for i in range(1, NEIGHBOURS + 1)]
    return _pairs(rows.select("id", F.array(*near, "first").alias("near")), "id", "near")


def open_groups(rows: DataFrame, components_: DataFrame) -> DataFrame:
    """Rows (id, component, open) of the regions in which not all pairs were compared and several components remain.

    Regions are those of the shortest prefix, so pairs that adaptive depth or blocks took apart count as well. Open
    rows are outside the largest component of such a region.
    """
    rows = rows.select("id", _prefix(BASE_DEPTH).alias("region"))
    rows = rows.join(components_.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    held = rows.groupBy("region", "component").agg(F.count(F.lit(1)).alias("n"))
    main = held.groupBy("region").agg(F.max(F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("n").alias("all"))
    main = main.where((F.col("parts") > 1) & (F.col("all") > NEIGHBOURS + 1))
    rows = rows.join(main.select("region", F.col("main.component").alias("main")), "region")
    return stored(rows.groupBy("id").agg(F.first("component").alias("component"), F.max(F.col("component") != F.col("main")).alias("open")), "open")


def _sets(k: int):
    """(id, text) -> (id, n, set): the shingles of each text."""
    def run(batches):
        for b in batches:
            sets = [s for s in shingle_sets(b.column(1), k)]
            n, out = pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), n, out], ["id", "n", "shingles"])

    return run


def _counters(shingles: np.ndarray) -> np.ndarray:
    """The counter of each shingle in the two rows of the sketch, one row after the other."""
    return np.stack([(shingles >> U(8)) & U(COUNTERS - 1), ((shingles >> U(36)) & U(COUNTERS - 1)) + U(COUNTERS)]).astype(np.int64)


def _counted(batches):
    """(shingles) -> (key, counts): how often the shingles of a task fall on each counter, a row a range of counters."""
    total = np.zeros(2 * COUNTERS, np.uint32)
    for b in batches:
        for x in b.column(0).to_pylist():
            np.add.at(total, _counters(np.frombuffer(x, U)).ravel(), 1)
    if total.any():
        parts = total.reshape(-1, min(COUNTER_RANGE, COUNTERS))
        held = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int64)), pa.array([parts[i].tobytes() for i in held], pa.binary())], ["key", "counts"])


def _summed(batches):
    """Sorted (key, counts) -> (key, counts): the sum of each range, streamed."""
    key, total = None, None
    row = lambda: pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["key", "counts"])
    for b in batches:
        for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if k != key:
                if key is not None:
                    yield row()
                key, total = k, np.zeros(len(x) // 4, np.int64)
            total += np.frombuffer(x, np.uint32)
    if key is not None:
        yield row()


def rarity(sets: DataFrame) -> np.ndarray:
    """A sketch of how often shingles occur in ``sets``: two rows of COUNTERS numbers; neither counts a shingle too low."""
    counts = sets.select("shingles").mapInArrow(_counted, "key long, counts binary")
    counts = counts.repartition("key").sortWithinPartitions("key").mapInArrow(_summed, "key long, counts binary")
    out = np.zeros((2 * COUNTERS // min(COUNTER_RANGE, COUNTERS), min(COUNTER_RANGE, COUNTERS)), np.uint32)
    for r in counts.collect():  # 2 * COUNTERS numbers in all
        out[r["key"]] = np.minimum(np.frombuffer(r["counts"], np.int64), 0xFFFFFFFF)
    return out.ravel()


WORDS = [f"w{i}" for i in range(PARITY)]


def _prefixes(percent: int, sketch):
    """(id, n, shingles, component, open) -> (token, id, n, alone, place, indexed, component, open, w0..): the rarest shingles of each set.

    ``w0`` and on are the set's parity bitmap. ``alone`` counts the set's shingles that no other set holds (as far as the sketch tells); they come first. Of two sets with 100 * both >= percent * union the larger shares one of its first n - ceil(percent n / 100) + 1 shingles with the
    first n - ceil(2 percent n / (100 + percent)) + 1 of the smaller (``indexed``), in any order common to both.
    """
    def run(batches):
        counts = sketch.value
        for b in batches:
            out, parity = [], []
            for i, x in enumerate(b.column(2).to_pylist()):
                x = np.frombuffer(x, U)
                n = len(x)
                probe, index = n + (-percent * n // 100) + 1, n + (-2 * percent * n // (100 + percent)) + 1
                often = counts[_counters(x)].min(axis=0)
                alone = int((often == 1).sum())
                order = np.lexsort((x, often))[alone:probe]
                place = np.arange(alone, alone + len(order))
                out.append((np.full(len(order), i), x[order], place, place < index, np.full(len(order), alone)))
                odd = np.bincount(((x >> U(20)) & U(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
                parity.append(np.packbits(odd.astype(bool), bitorder="little").view(np.int64))
            if not out:
                continue
            at, token, place, indexed, alone = (np.concatenate(c) for c in zip(*out))
            of = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), b.column(0).take(of), b.column(1).take(of), pa.array(alone.astype(np.int64)), pa.array(place.astype(np.int64)), pa.array(indexed), b.column(3).take(of), b.column(4).take(of)]
                + [pa.array(w) for w in np.array(parity)[at].T],
                ["token", "id", "n", "alone", "place", "indexed", "component", "open", *WORDS],
            )

    return run


def rare_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, c_a, c_b) of sets, one of them open, of two components, that may be linked: they share a rare shingle
    at places that leave enough others in common."""
    sketch = sets.sparkSession.sparkContext.broadcast(rarity(sets))
    kind = "token long, id long, n long, alone long, place long, indexed boolean, component long, open boolean" + "".join(f", {w} long" for w in WORDS)
    rows = stored(sets.select("id", "n", "shingles", "component", "open").mapInArrow(_prefixes(percent, sketch), kind), "prefixes")
    side = lambda of, s: of.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "alone", "place", "component", "open", *WORDS)))
    met = side(rows.where("indexed"), "x").join(side(rows, "y"), "token")
    met = met.where("(n_x < n_y OR (n_x = n_y AND id_x < id_y)) AND (open_x OR open_y) AND component_x <> component_y")
    need = F.ceil(F.expr(f"{percent} * (n_x + n_y)") / (100 + percent))
    # before a common shingle both hold at most the others that are not alone, after it at most all the rest
    room = F.least(F.expr("place_x - alone_x"), F.expr("place_y - alone_y")) + 1 + F.least(F.expr("n_x - place_x - 1"), F.expr("n_y - place_y - 1"))
    differ = sum((F.bit_count(F.col(f"{w}_x").bitwiseXOR(F.col(f"{w}_y"))) for w in WORDS[1:]), F.bit_count(F.col("w0_x").bitwiseXOR(F.col("w0_y"))))
    met = met.where(F.expr(f"100 * n_x >= {percent} * n_y") & (room >= need) & (differ <= F.expr("n_x + n_y") - 2 * need))
    return met.select(F.col("id_x").alias("a"), F.col("id_y").alias("b"), F.col("component_x").alias("c_a"), F.col("component_y").alias("c_b")).distinct()


def _linked(percent: int):
    """(a, b, c_a, c_b, shingles of a, of b) -> (a, b): the components of pairs that are linked."""
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist()):
                both, n = len(np.intersect1d(np.frombuffer(x, U), np.frombuffer(y, U), assume_unique=True)), (len(x) + len(y)) // 8
                keep.append(both > 0 and 100 * both >= percent * (n - both))
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(3)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def exact_links(docs: DataFrame, open_: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of components joined by a link of an open row with any row of ``open_``, on the full sets."""
    rows = docs.join(open_.select("id"), "id", "left_semi").select("id", "text").mapInArrow(_sets(k), "id long, n long, shingles binary")
    rows = rows.where("n > 0").dropDuplicates(["id", "shingles"]).join(open_, "id")
    rows = stored(rows, "sets")
    pairs = stored(rare_pairs(rows, percent), "rare-pairs")
    of = lambda s: rows.select(F.col("id").alias(s), F.col("shingles").alias(f"shingles_{s}"))
    pairs = pairs.join(of("b"), "b").join(of("a"), "a").select("a", "b", "c_a", "c_b", "shingles_a", "shingles_b")
    return stored(pairs.mapInArrow(_linked(percent), "a long, b long").distinct(), "links")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of ``docs``.

    Documents are linked when 100 * intersection >= percent * union of their shingle sets.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = stored(docs.mapInArrow(_sign(k), "id long, n long, set_key binary, sig binary"), "signed")
    classes = stored(
        signed.where("set_key is not null and id is not null").groupBy("set_key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "classes",
    )
    least = math.floor(HASHES * percent / 100 - 5 * math.sqrt(HASHES * percent * (100 - percent)) / 100)
    side = lambda c: classes.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}"))
    texts = lambda c: docs.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}"))
    fits = F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")

    def likely(p: DataFrame) -> DataFrame:
        """Pairs that sizes and signatures allow, with the number of equal hashes."""
        p = p.join(side("a"), "a").join(side("b"), "b").where(fits).select("a", "b", "sig_a", "sig_b")
        return stored(p.mapInArrow(_agreement(least), "a long, b long, same int"), "pairs")

    def confirmed(p: DataFrame) -> DataFrame:
        p = p.select("a", "b").join(texts("b"), "b").join(texts("a"), "a").select("a", "b", "text_a", "text_b")
        return stored(p.mapInArrow(_confirm(k, percent), "a long, b long").distinct(), "links")

    def between(p: DataFrame, whole: DataFrame) -> DataFrame:
        """Pairs that would still join two components, with those."""
        of = lambda c: whole.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}"))
        p = p.join(of("a"), "a", "left").join(of("b"), "b", "left")
        return stored(p.select("a", "b", "same", F.coalesce("c_a", "a").alias("c_a"), F.coalesce("c_b", "b").alias("c_b")).where("c_a <> c_b"), "open")

    def joined(whole: DataFrame, open_: DataFrame) -> DataFrame:
        """Components after the confirmed ones among ``open_`` have been linked."""
        if open_.isEmpty():
            return whole
        return merged(whole, confirmed(open_).join(open_, ["a", "b"]).select(F.col("c_a").alias("a"), F.col("c_b").alias("b")))

    def merged(whole: DataFrame, links: DataFrame) -> DataFrame:
        """Components after ``links`` of components."""
        more = stored(components(links), "more")
        out = whole.join(more.select(F.col("node").alias("component"), F.col("component").alias("c2")), "component", "left")
        out = out.select("node", F.coalesce("c2", "component").alias("component"))
        return stored(out.unionByName(more.join(whole, "node", "left_anti")), "whole")

    rows = forest(classes)
    pairs = likely(candidates(rows))
    ends = pairs.select(F.col("a").alias("node"), "a", "b", "same").union(pairs.select(F.col("b").alias("node"), "a", "b", "same"))
    best = ends.groupBy("node").agg(F.max(F.struct("same", F.struct(-F.col("a"), -F.col("b")))).alias("m"))
    best = best.select((-F.col("m.col2.col1")).alias("a"), (-F.col("m.col2.col2")).alias("b")).distinct()
    whole = stored(components(confirmed(best)), "whole")
    whole = joined(whole, between(pairs, whole))
    open_rows = open_groups(rows, whole)
    if not open_rows.isEmpty():
        whole = merged(whole, exact_links(docs, open_rows, k, percent))
    classes = classes.select("set_key", "id").join(whole.withColumnRenamed("node", "id"), "id", "left").select("set_key", F.coalesce("component", "id").alias("component"))
    out = signed.select("id", "n", "set_key").join(classes, "set_key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")
    )
