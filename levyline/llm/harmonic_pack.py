"""Harmonic packing of tokenised documents into sequences of at most ``capacity`` tokens.

A document's tokens (end token included) are cut into pieces whose lengths are reciprocals of the capacity:
whole sequences first, then again and again the largest ``capacity // k`` that fits the rest, down to
``MIN_CUT``; a shorter rest is a piece as it is. All pieces of one length form a class, and a class's
sequences each take the fixed number ``capacity // length`` of them. Workers (blocks of pieces) need only
know how many pieces of a class the blocks before them hold: then each places its own pieces independently.

What remains of the classes' last sequences is bounded by a constant (fewer than ``capacity // length``
pieces a class, whatever the input) and is packed first-fit by decreasing length in one small group.

Defined results: null and empty texts have only the end token; repeated rows are packed as rows of their own;
an empty table gives no rows. A null id is kept. ``sequence_id`` counts from 0 without gaps.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, split_count, stored

CAPACITY = 4096
END_TOKEN = 2
#: Shortest piece that is cut off a longer rest.
MIN_CUT = 64
#: Pieces a block holds.
BLOCK_PIECES = 50_000
TOKENIZER = "word_bpe_49k.json"
#: Words whose ids a worker remembers; a full memory is emptied.
REMEMBERED = 800_000
PUNCTUATION = b".,;:!?"
#: Letters up to here lower one by one.
LAST_LATIN = "\u024f"

_state: dict = {}


def _tokenizer(path: str | None):
    if _state.get("path", "") != path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        _state.update(path=path, bytes=pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False), tok=Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER)), ids={})
    return _state["tok"], _state["ids"]


def _pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _word(core: str, tok) -> bytes | None:
    """Ids of a word of Latin letters, which the vocabulary's normalisation leaves whole; None for any other."""
    if not core.isascii():
        core = unicodedata.normalize("NFC", core).lower()
        if not core.isalpha() or max(core) > LAST_LATIN:
            return None
        core = "".join(part for part, _ in _state["bytes"].pre_tokenize_str(core))
    elif not core.isalpha():
        return None
    return _pack_ids([t.id for t in tok.model.tokenize(core)])


def _learn(words: set[bytes], tok, known: dict[bytes, bytes]) -> dict[bytes, bytes]:
    """Ids of new words, remembered. A word of letters goes straight to the vocabulary's merges; its closing
    punctuation is encoded apart from it, as the vocabulary's own word split cuts there. All else is encoded in full."""
    out, rest, ends = {}, set(), {}
    for w in words:
        core = w.rstrip(PUNCTUATION)
        ids = known.get(core) or out.get(core) or _word(core.decode("utf-8", "replace"), tok) if core else None
        if ids is None:
            rest.add(w)
        elif len(core) == len(w):
            out[w] = ids
        else:
            out[core], ends[w] = ids, (core, w[len(core) :])
    marks = {end for _, end in ends.values() if end not in known}
    todo = [*rest, *marks]
    for w, e in zip(todo, tok.encode_batch_fast([w.decode("utf-8", "replace") for w in todo], add_special_tokens=False) if todo else (), strict=True):
        out[w] = _pack_ids(e.ids)
    for w, (core, end) in ends.items():
        out[w] = out[core] + (out.get(end) or known.get(end, b""))
    if len(known) + len(out) > REMEMBERED:
        known.clear()
    known.update((w, ids) for w, ids in out.items() if len(w) <= 64)
    return out


def token_bytes(text: str, path: str | None) -> bytes:
    """The text's ids as little-endian unsigned 32-bit numbers.

    White space separates the vocabulary's words and is dropped, so words can be encoded one by one and
    remembered; ASCII letters are lowered as the vocabulary does. Texts that may hold a special token's
    string are encoded whole.
    """
    tok, known = _tokenizer(path)
    if "<|" in text:
        return _pack_ids(tok.encode(text, add_special_tokens=False).ids)
    words = text.encode("utf-8", "replace").lower().split()
    try:
        return b"".join(map(known.__getitem__, words))
    except KeyError:
        new = {w for w in words if w not in known}
        here = {w: known[w] for w in words if w not in new}
        here.update(_learn(new, tok, known))
        return b"".join(map(here.__getitem__, words))


def cut(n: int, capacity: int, min_cut: int) -> list[int]:
    """Lengths of the pieces of n tokens."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        size = rest if rest < min_cut else capacity // -(-capacity // rest)
        out.append(size)
        rest -= size
    return out


def _pieces(capacity: int, min_cut: int, path: str | None, with_ids: bool):
    end = _pack_ids([END_TOKEN])

    def run(batches):
        for b in batches:
            rows, start, length, crc, total, ids = [], [], [], [], [], []
            for i in range(b.num_rows):
                blob = token_bytes(b.column(1)[i].as_py() or "", path) + end
                n = len(blob) // 4
                at = 0
                for size in cut(n, capacity, min_cut):
                    part = blob[4 * at : 4 * (at + size)]
                    rows.append(i)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4"))
                    at += size
            arrays = [b.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; the lengths come in decreasing order."""
    room, bins, offsets = np.zeros(0, np.int64), [], []
    for n in lengths:
        fits = np.flatnonzero(room >= n)
        if not len(fits):
            room = np.append(room, capacity)
            fits = [len(room) - 1]
        bins.append(fits[0])
        offsets.append(capacity - room[fits[0]])
        room[fits[0]] -= n
    return np.array(bins, np.int64), np.array(offsets, np.int64)


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, min_cut: int = MIN_CUT) -> DataFrame:
    """A row for each piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    cut_up = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    ids = ", ids array<int>" * with_ids
    schema, packed = cut_up + ids, f"{cut_up}, sequence_id long, offset long{ids}"
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(_pieces(capacity, min_cut, tokenizer_path, with_ids), schema)
    rows = stored(rows, "pieces")
    blocks = split_count(rows.count(), BLOCK_PIECES)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(blocks)))
    held = rows.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("each", F.floor(F.lit(capacity) / F.col("length")))
    held = stored(held, "classes")
    # one row a class: at most as many as lengths are possible, whatever the input
    classes = held.groupBy("length").agg(F.first("each").alias("each"), F.sum("n").alias("all")).withColumn("full", F.floor(F.col("all") / F.col("each")))
    base = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    classes = classes.select("length", "each", "full", F.coalesce(F.sum("full").over(base), F.lit(0)).alias("base"), F.sum("full").over(everything).alias("used"))
    nth = F.row_number().over(Window.partitionBy("block", "length").orderBy("doc_id", "start", "ids_crc32"))
    placed = rows.withColumn("nth", nth - 1).join(held.select("block", "length", "before"), ["block", "length"])
    placed = placed.join(F.broadcast(classes), "length").withColumn("nth", F.col("before") + F.col("nth"))
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
    whole = placed.where("nth < full * each").withColumn("sequence_id", (F.col("base") + F.floor(F.col("nth") / F.col("each"))).cast("long"))
    whole = whole.withColumn("offset", (F.col("nth") % F.col("each") * F.col("length")).cast("long")).select(*out)

    def rest(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        bins, group["offset"] = first_fit(group["length"].to_numpy(), capacity)
        group["sequence_id"] = group["used"] + bins
        return group[out]

    left = placed.where("nth >= full * each").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    bins = left.select(*out, "used", F.lit(0).alias("all")).groupBy("all").applyInPandas(rest, packed)
    return whole.unionByName(bins)
