"""Line dedup: repeated lines go from every document but the first that holds them.

Two Bloom filters over 64-bit line hashes find the lines worth comparing.
Every document's distinct keys set their bits in a *once* filter; a bit set a
second time is set in a *twice* filter.  A key held by two documents has all
its bits in *twice*, so a key with a bit missing there is unique and never
leaves its task.  Only the others, the suspected repeats, are shuffled and
compared as text, and the smallest document id holding a key is its first.

Size and skew.  Each task keeps the positions it saw (not the lines) and
passes them on per filter segment; a segment's reducer ORs them into two
bitmaps as they stream in.  What is broadcast is the *twice* filter alone, of
at most ``max_filter_bits`` bits (32 MB by default) whatever the input: a
larger corpus fills it more and more lines become suspects, which costs
shuffle, never results.  A key's first document is min(doc_id), summed up map
side, and its decisions join back to the suspects through a skew-splittable
join, so a line held by a third of all documents is no hot spot.

Cases: null or empty text is one empty line; a line without '\\n' is one line;
repeated rows of a document id are one document (the first document keeps its
own repeats); rows with a null id are returned whole, count for nothing and
drop nothing.  Keys shorter than ``min_chars`` always stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import few_rows, short_batches, written

# Fixed value: the white space stripped from both ends of a line.
STRIP = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10
BITS_PER_LINE = 16
MAX_FILTER_BITS = 1 << 28
SEGMENT_BITS = 1 << 20
# positions a task holds before it passes them on
FLUSH_POSITIONS = 4_000_000


def line_key(line: bytes) -> bytes:
    """The compared form of a line, in UTF-8 (``bytes.lower`` changes A-Z only)."""
    return line.strip(STRIP).lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    """At least ``min_chars`` code points; one takes 1 to 4 bytes."""
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


def _keys(text: bytes, min_chars: int) -> set[bytes]:
    """Distinct keys of a text that are long enough to be compared."""
    return {k for x in text.lower().split(b"\n") if _long_enough(k := x.strip(STRIP), min_chars)}


def _positions(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bit positions of each 64-bit hash in a filter of ``bits`` (a power of 2)."""
    mask = np.uint64(bits - 1)
    return hashes & mask, (hashes >> np.uint64(32)) * np.uint64(0x9E3779B1) + hashes & mask


_hash, _digest = xxhash.xxh3_64_intdigest, xxhash.xxh3_128_digest


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in few_rows(batches):
        yield from zip(*(c.to_pylist() for c in b.columns))


def _twice_filter(lines: DataFrame, bits: int, min_chars: int) -> np.ndarray:
    """The *twice* filter of all documents as a packed bitmap (uint8)."""
    segment = min(bits, SEGMENT_BITS)
    n_segments = bits // segment

    def packed(hashes: list[int]) -> pa.RecordBatch:
        a, b = _positions(np.array(hashes, dtype=np.uint64), bits)
        same = a == b                                   # both positions of a key are one bit
        pos, count = np.unique(np.concatenate([a, b[~same]]), return_counts=True)
        out = []
        cut = np.searchsorted(pos, np.arange(n_segments + 1, dtype=np.uint64) * np.uint64(segment))
        for s in range(n_segments):
            p = (pos[cut[s]:cut[s + 1]] & np.uint64(segment - 1)).astype(np.uint32)
            if len(p):
                again = p[count[cut[s]:cut[s + 1]] > 1]
                out.append((s, _pack(p, segment), _pack(again, segment)))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary()),
             pa.array([r[2] for r in out], pa.binary())], names=["segment", "once", "twice"])

    def partial(batches):
        held: list[int] = []
        for doc_id, text in _rows(batches):
            if doc_id is not None and text:
                held.extend(map(_hash, _keys(text, min_chars)))
                if len(held) * 2 >= FLUSH_POSITIONS:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    def merged(batches):
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for s, one, two in _rows(batches):
            if s not in once:
                once[s], twice[s] = (np.zeros(segment // 8, np.uint8) for _ in range(2))
            one, two = _unpack(one, segment), _unpack(two, segment)
            twice[s] |= two | (once[s] & one)
            once[s] |= one
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(twice), pa.int32()), pa.array([v.tobytes() for v in twice.values()], pa.binary())],
            names=["segment", "twice"])

    partials = lines.mapInArrow(partial, "segment int, once binary, twice binary")
    tasks = min(n_segments, 64)
    rows = (partials.repartition(tasks, "segment").mapInArrow(merged, "segment int, twice binary").collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[r.segment * (segment // 8):(r.segment + 1) * (segment // 8)] = np.frombuffer(r.twice, np.uint8)
    return out


def _pack(positions: np.ndarray, bits: int) -> bytes:
    """Sorted positions as they are, or as a bitmap where that is shorter (first byte tells which)."""
    if positions.nbytes <= bits // 8:
        return b"p" + positions.tobytes()
    flags = np.zeros(bits, np.uint8)
    flags[positions] = 1
    return b"b" + np.packbits(flags, bitorder="little").tobytes()


def _unpack(data: bytes, bits: int) -> np.ndarray:
    if data[:1] == b"b":
        return np.frombuffer(data, np.uint8, offset=1)
    flags = np.zeros(bits, np.uint8)
    flags[np.frombuffer(data, np.uint32, offset=1)] = 1
    return np.packbits(flags, bitorder="little")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                   min_chars: int = MIN_CHARS, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """(doc, drops): per document that loses lines, the 128-bit digests of the keys it loses."""
    spark = docs.sparkSession
    lines = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    n_lines = lines.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
                              + 1)).first()[0] or 0
    lines = short_batches(lines.withColumn("text", F.col("text").cast("binary")))
    bits = 1 << 13
    while bits < n_lines * BITS_PER_LINE and bits < max_filter_bits:
        bits *= 2
    twice = spark.sparkContext.broadcast(_twice_filter(lines, bits, min_chars))

    def suspected(batches):
        flt = twice.value
        for b in few_rows(batches):
            ids, keys = [], []
            for doc_id, text in _rows([b]):
                if doc_id is not None and text:
                    own = _keys(text, min_chars)
                    ids.extend([doc_id] * len(own))
                    keys.extend(own)
            if not keys:
                continue
            hashes = np.fromiter(map(_hash, keys), np.uint64, len(keys))
            hit = np.ones(len(keys), bool)
            for p in _positions(hashes, bits):
                p = p.astype(np.int64)
                hit &= (flt[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
            at = np.flatnonzero(hit)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in at], pa.int64()), pa.array([keys[i] for i in at], pa.binary()),
                 pa.array([_digest(keys[i]) for i in at], pa.binary())], names=["doc", "key", "digest"])

    suspects = written(lines.mapInArrow(suspected, "doc long, key binary, digest binary"), "line-suspects")
    firsts = written(suspects.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                     .filter("first < last").select("key", "first"), "line-firsts")
    return (suspects.join(firsts, "key").filter("doc > first")
            .groupBy("doc").agg(F.collect_set("digest").alias("drops")))


def without_lines(docs: DataFrame, drops: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with the lines of ``drops`` taken out of ``text_col``, null texts made empty, and two columns
    (replaced if there): n_lines before dropping, n_dropped."""
    made = ["n_lines", "n_dropped"]
    kept = docs.drop(*made)
    others = [c for c in kept.columns if c != text_col]
    joined = (kept.withColumn("__doc", F.col(id_col).cast("long"))
              .join(drops.withColumnRenamed("doc", "__doc").withColumnRenamed("drops", "__drops"), "__doc", "left")
              .select(*others, F.col(text_col).cast("string").cast("binary").alias(text_col), "__drops"))

    def keep(batches):
        for b in few_rows(batches):
            out = []
            for text, gone in _rows([b.select([b.num_columns - 2, b.num_columns - 1])]):
                text = text or b""
                n_lines, n_dropped = text.count(b"\n") + 1, 0
                if gone:
                    gone = set(gone)
                    lines = [x for x in text.split(b"\n")
                             if not _long_enough(k := line_key(x), min_chars) or _digest(k) not in gone]
                    text, n_dropped = b"\n".join(lines), n_lines - len(lines)
                out.append((text, n_lines, n_dropped))
            cols = list(zip(*out)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-2], pa.array(cols[0], pa.binary()).cast(pa.string()), pa.array(cols[1], pa.int64()),
                 pa.array(cols[2], pa.int64())], names=[*others, text_col, *made])

    schema = T.StructType([*(kept.schema[c] for c in others), T.StructField(text_col, T.StringType()),
                           *(T.StructField(c, T.LongType()) for c in made)])
    return short_batches(joined).mapInArrow(keep, schema)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                min_chars: int = MIN_CHARS, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """(id, text, n_lines, n_dropped): ``text`` is what stays, joined by '\\n'.

    n_lines counts the lines before dropping.  One row per input row.
    """
    docs = docs.select(id_col, text_col)
    drops = repeated_lines(docs, id_col, text_col, min_chars=min_chars, max_filter_bits=max_filter_bits)
    return without_lines(docs, drops, id_col, text_col, min_chars=min_chars)
