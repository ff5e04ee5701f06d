"""Byte-level BPE with a hierarchical-bitmap rank queue.

Merging.  The bytes of many pre-tokens lie in one array with links to the
next and previous token of their pre-token.  A bucket per merge rank holds the
positions of pairs with that rank; a bitmap of 64-bit words, with a bitmap of
its non-zero words above it, and so on, finds the lowest rank with a bucket by
find-first-set.  Entries whose pair has changed since are stale and skipped.
A popped bucket is merged at once where that equals the one-by-one order:
overlapping pairs merge leftmost first, and if a merge would create a pair of
a lower rank than the bucket's, only the leftmost entry of each pre-token is
merged and the others go back.  The cost of a pre-token is near linear in its
length, so one of megabytes is as cheap per byte as many short ones.

Encoding.  Texts are split by the pattern, each distinct pre-token of a task
is encoded once and the ids of all texts are gathered from that table in
numpy.  A task keeps at most ``MAX_PIECES`` pre-tokens and starts afresh
beyond that, so its memory is bounded; the ids do not depend on it.

Cases: null and empty texts have no ids and decode to no bytes; special-token
strings in a text are ordinary text; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import few_rows, short_batches

MAX_PIECES = 200_000
NONE = np.int32(2**31 - 1)      # rank of a pair that does not merge
ENCODE_ROWS = 2000              # texts encoded together


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines "base64 rank"."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class RankQueue:
    """Buckets of positions by rank; ``pop`` takes the bucket of the lowest rank."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.levels: list[list[int]] = []
        n = ranks
        while True:
            n = -(-n // 64)
            self.levels.append([0] * n)
            if n == 1:
                break

    def push(self, rank: int, positions: np.ndarray) -> None:
        held = self.buckets.get(rank)
        if held is not None:
            held.append(positions)
            return
        self.buckets[rank] = [positions]
        for words in self.levels:
            old = words[rank >> 6]
            words[rank >> 6] = old | 1 << (rank & 63)
            if old:
                break
            rank >>= 6

    def push_all(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cut = np.flatnonzero(np.diff(ranks)) + 1
        at = [0, *cut.tolist(), len(ranks)]
        for r, lo, hi in zip(ranks[at[:-1]].tolist(), at, at[1:]):
            self.push(r, positions[lo:hi])

    def pop(self) -> tuple[int, np.ndarray] | None:
        """(rank, its positions in order), or None."""
        if not self.buckets:
            return None
        rank = 0
        for words in reversed(self.levels):          # find-first-set from the top down
            w = words[rank]
            rank = rank << 6 | (w & -w).bit_length() - 1
        held = self.buckets.pop(rank)
        at = rank
        for words in self.levels:
            words[at >> 6] &= ~(1 << (at & 63))
            if words[at >> 6]:
                break
            at >>= 6
        return rank, np.unique(np.concatenate(held)) if len(held) > 1 else held[0]


class Merger:
    """Encodes pre-tokens by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.bytes_ = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    values.append(rank)
        order = np.argsort(keys)
        self.keys = np.array(keys, np.int64)[order]
        self.values = np.array(values, np.int32)[order]

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.values[i], NONE)

    def encode(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): ids[offsets[i]:offsets[i+1]] encode pieces[i]."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        tok = self.bytes_[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), lengths)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        n = len(tok)
        live = np.ones(n, bool)
        known = np.flatnonzero((whole >= 0) & (lengths > 0))      # a token of the vocabulary: nothing to merge
        live[np.isin(piece, known)] = False
        live[starts[known]] = True
        tok[starts[known]] = whole[known]
        todo = np.flatnonzero(whole[piece] < 0)
        self._merge(tok, live, todo, piece)
        ids = tok[live]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(piece[live], minlength=len(pieces)))])
        return ids, offsets

    def _merge(self, tok: np.ndarray, live: np.ndarray, todo: np.ndarray, piece: np.ndarray) -> None:
        """Merge the byte tokens at ``todo`` in place; consumed positions lose ``live``."""
        if len(todo) < 2:
            return
        n = len(tok)
        nxt, prv = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        same = (np.diff(todo) == 1) & (piece[todo[1:]] == piece[todo[:-1]])
        left, right = todo[:-1][same], todo[1:][same]
        nxt[left], prv[right] = right, left
        rank_at = np.full(n, NONE, np.int32)           # rank of the pair that starts here
        rank_at[left] = self.pair_ranks(tok[left], tok[right])
        queue = RankQueue(self.size)
        first = left[rank_at[left] < NONE]
        if len(first):
            queue.push_all(rank_at[first], first)
        while (top := queue.pop()) is not None:
            rank, pos = top
            pos = pos[rank_at[pos] == rank]            # the others are stale
            if not len(pos):
                continue
            if len(pos) > 1:
                pos = self._leftmost(pos, nxt)
                pos, back = self._safe(pos, rank, tok, nxt, prv, piece)
                if len(back):
                    queue.push(rank, back)
            gone = nxt[pos]
            after = nxt[gone]
            tok[pos] = rank
            live[gone] = False
            rank_at[gone] = NONE
            nxt[pos] = after
            has = after >= 0
            prv[after[has]] = pos[has]
            before = prv[pos]
            before = before[before >= 0]
            changed = np.concatenate([pos[has], before])
            ranks = self.pair_ranks(tok[changed], tok[nxt[changed]])
            rank_at[pos] = NONE
            rank_at[changed] = ranks
            merges = ranks < NONE
            if merges.any():
                queue.push_all(ranks[merges], changed[merges])

    @staticmethod
    def _leftmost(pos: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        """Without the pairs whose left token the pair before takes (runs of overlapping pairs)."""
        overlaps = np.concatenate([[False], nxt[pos[:-1]] == pos[1:]])
        if not overlaps.any():
            return pos
        index = np.arange(len(pos))
        run = np.maximum.accumulate(np.where(overlaps, 0, index))
        return pos[(index - run) % 2 == 0]

    def _safe(self, pos, rank, tok, nxt, prv, piece) -> tuple[np.ndarray, np.ndarray]:
        """(entries to merge now, entries to put back)."""
        own = piece[pos]
        again = np.concatenate([[False], own[1:] == own[:-1]])
        if not again.any():
            return pos, pos[:0]
        x = np.full(len(pos), rank, np.int32)
        before, after = prv[pos], nxt[nxt[pos]]
        lower = self.pair_ranks(x[:1], x[:1])[0] < rank
        lower = lower or (self.pair_ranks(x[:(after >= 0).sum()], tok[after[after >= 0]]) < rank).any()
        lower = lower or (self.pair_ranks(tok[before[before >= 0]], x[:(before >= 0).sum()]) < rank).any()
        return (pos[~again], pos[again]) if lower else (pos, pos[:0])


class PieceTable(dict):
    """Pre-token -> its number; ids of all numbered pre-tokens."""

    def __init__(self, merger: Merger):
        self.merger = merger
        self.fresh: list[str] = []
        self.ids, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.fresh.append(piece)
        return n

    def settle(self) -> None:
        """Encode the pre-tokens met since the last call."""
        if self.fresh:
            ids, offsets = self.merger.encode([p.encode() for p in self.fresh])
            self.starts = np.concatenate([self.starts, self.starts[-1] + offsets[1:]])
            self.ids = np.concatenate([self.ids, ids])
            self.fresh = []

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        begin = self.starts[numbers]
        lengths = self.starts[numbers + 1] - begin
        ends = np.cumsum(lengths)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + lengths, lengths)]


class Encoder:
    """Token ids of texts, with a bounded table of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern).findall
        self.table = PieceTable(Merger(ranks))

    def __call__(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        if len(self.table) > MAX_PIECES:
            self.table = PieceTable(self.table.merger)
        numbers = []
        for text in texts:
            pieces = self.split(text) if text else []
            numbers.append(np.fromiter(map(self.table.__getitem__, pieces), np.int32, len(pieces)))
        self.table.settle()
        return [self.table.gather(x) for x in numbers]


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int32()))


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every whole text.

    ``vocabulary`` is a rank file on the driver; the ranks (under 1 MB of file)
    are broadcast.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    id_type = docs.schema[id_col].dataType.simpleString()

    def encode(batches):
        encoder = Encoder(ranks.value, pattern)
        for b in few_rows(batches, ENCODE_ROWS):
            yield pa.RecordBatch.from_arrays([b.column(0), _lists(encoder(b.column(1).to_pylist()))],
                                             names=["id", "ids"])

    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return short_batches(texts).mapInArrow(
        encode, f"id {id_type}, ids array<int>").withColumnRenamed("id", id_col)


def decode_ids(ids: np.ndarray, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids.tolist()))


def token_table(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def _id_arrays(column: pa.Array) -> Iterator[np.ndarray]:
    values, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()     # of the whole batch
    for lo, hi in zip(at, at[1:]):
        yield values[lo:hi]


def decode_documents(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids"
                     ) -> DataFrame:
    """(id, decoded binary) of every row of ids; null ids decode to no bytes."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    id_type = encoded.schema[id_col].dataType.simpleString()

    def decode(batches):
        tokens = token_table(ranks.value)
        for b in few_rows(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([decode_ids(x, tokens) for x in _id_arrays(b.column(1))], pa.binary())],
                names=["id", "decoded"])

    rows = encoded.selectExpr(f"`{id_col}` as id", f"coalesce(`{ids_col}`, array()) as ids")
    return short_batches(rows).mapInArrow(
        decode, f"id {id_type}, decoded binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", *,
               keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded again in one task,
    and the ids themselves if asked for."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(vocabulary))
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids]

    def digests(batches):
        encoder, tokens = Encoder(ranks.value, pattern), token_table(ranks.value)
        for b in few_rows(batches, ENCODE_ROWS):
            ids = encoder(b.column(1).to_pylist())
            rows = [(len(x), hashlib.sha256(x.astype("<u4").tobytes()).hexdigest(),
                     hashlib.sha256(decode_ids(x, tokens)).hexdigest()) for x in ids]
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.string()), *([_lists(ids)] if keep_ids else [])], names=names)

    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    schema = f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return short_batches(texts).mapInArrow(digests, schema).withColumnRenamed("id", id_col)
