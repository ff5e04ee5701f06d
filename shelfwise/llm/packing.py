"""Hierarchical multi-length packing of tokenised documents.

Contexts come in tiers, ``smallest`` tokens and each the double of the one
before, up to ``window``.  A document's tokens fill whole windows first; what
is left is routed to the shortest context that holds it.  The tiers are packed
from the longest to the shortest: each context is opened by the longest piece
of its tier, its gap filled with the longest pieces that fit, which come from
the shorter tiers, and what no piece fits is filled by cutting one.  So a
context has at most one cut and no padding.  The pieces that fill no context at the end are
cut at powers of two, which need no padding either.  Each tier's sequences
are then dealt into step groups of equally many tokens, by their cost in
descending order and back again, so that the attention work of the steps (the
squares of the piece lengths) is near equal.

Documents are packed in groups of about ``GROUP_TOKENS`` tokens as a task
reads them: nothing is shuffled, a task holds one group (or one document, if
that is longer), and a group's tail is all that is ever cut short.  Sequence
and step numbers lead with the number of the task's partition; they are gapless
inside one.  Rows must come in the same order when a task is retried, which
files and written tables do.

Tokens are those of the ``tokenizers`` library for the given file (``Encoder``).

Cases: null and empty texts are their end token alone; null ids and repeated
rows are packed like others; a document may be longer than a window or the
group; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import LOWER, UPPER, few_rows, short_batches

WINDOW, SMALLEST = 1024, 128
END_ID = 0
STEP_TOKENS = 1 << 16
GROUP_TOKENS = 1 << 20
# sequences (and steps) a partition may number
_NUMBERS = 1 << 36


def _gather(values: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that begin and are as long as told, one after another."""
    end = np.cumsum(lengths)
    return values[np.repeat(begin - (end - lengths), lengths) + np.arange(end[-1] if len(end) else 0)]


# longest part in bytes that tiktoken's core gets
_FAST_BYTES = 500


def _merge_ranks(tokenizer: dict) -> dict[bytes, int] | None:
    """The file's vocabulary as bytes with ranks, where its ids are the order of its merges and its cuts are the
    common byte-level pattern; else None."""
    model, cuts = tokenizer["model"], tokenizer["pre_tokenizer"] or {}
    if (model["type"], cuts.get("type"), cuts.get("use_regex"), cuts.get("add_prefix_space"), tokenizer["normalizer"],
            model.get("ignore_merges", False)) != ("BPE", "ByteLevel", True, False, None, False):
        return None
    vocabulary = model["vocab"]
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if made != sorted(set(made)):
        return None
    # bytes stand as themselves where they print, as U+0100 and on in their order elsewhere
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [i for i in range(256) if i not in shown]
    byte = {chr(i): i for i in shown} | {chr(256 + n): i for n, i in enumerate(hidden)}
    special = {t["content"] for t in tokenizer["added_tokens"]}
    return {bytes(map(byte.__getitem__, t)): i for t, i in vocabulary.items() if t not in special}


_BLANK, _STOP, _LETTER = (np.isin(np.arange(256), list(x)) for x in (b" \t\n\r", b",.;:!?", (LOWER + UPPER).encode()))


def _after_text(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each byte position is surely not white space, from its last two bytes: a
    printing ASCII one, or one of U+00C0 to U+07FF."""
    last, before = data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    return ((last > 0x20) & (last < 0x7F)) | ((last >= 0x80) & (before >= 0xC3) & (before < 0xE0))


def _cuts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where texts, which begin at ``texts``, can be cut: before blanks that follow text, and before stops that
    follow a letter."""
    at = np.flatnonzero(_BLANK[data] | _STOP[data])
    blank = _BLANK[data[at]]
    at = at[(blank & _after_text(data, at)) | (~blank & _LETTER[data[np.maximum(at - 1, 0)]])]
    begins = np.zeros(len(data) + 1, bool)
    begins[texts] = True
    return at[~begins[at]]


def _per_run(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of flags in each run between offsets."""
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


class Encoder:
    """Whole texts to token ids, each ended by ``end_id``.

    Texts are cut into parts where no token crosses, and each distinct part of
    a batch is encoded once.  The library takes several times
    longer for it than tiktoken's core with the same merges, so that one gets
    the plain parts, joined, and the library all others: long ones, special
    tokens, characters above U+027F (whose classes may be newer than one of
    the two), and what begins without a blank or ends with one.
    """

    def __init__(self, tokenizer: str, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_str(tokenizer), end_id
        spec = json.loads(tokenizer)
        self.special = [t["content"] for t in spec["added_tokens"]]
        if any(" " in s for s in self.special):
            raise ValueError("a special token with a space would be cut")
        ranks = _merge_ranks(spec)
        self.fast = ranks and tiktoken.Encoding("parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                                special_tokens={})
        if ranks:
            self.width = np.zeros(max(ranks.values()) + 1, np.int64)
            self.width[list(ranks.values())] = [len(t) for t in ranks]

    def _plain(self, parts: pa.LargeBinaryArray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which parts both libraries agree on, with tokens that end at both ends however they stand in a row."""
        size = np.diff(offsets)
        if not self.fast or not len(data):
            return np.zeros(len(size), bool)
        out = (size > 0) & (size <= _FAST_BYTES) & _BLANK[data[np.minimum(offsets[:-1], len(data) - 1)]]
        out &= _after_text(data, offsets[1:]) & (_per_run(data >= 0xCA, offsets) == 0)
        for s in self.special:
            out &= ~pc.match_substring(parts, s).to_numpy(zero_copy_only=False)
        return out

    def _encoded(self, parts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the parts in one array, and the number of them per part."""
        data, offsets = _bytes_of(parts)
        plain = self._plain(parts, data, offsets)
        lengths, ids = np.zeros(len(parts), np.int64), [np.zeros(0, np.uint32)] * 2
        if plain.any():
            joined, ends = _bytes_of(parts.filter(pa.array(plain)))
            ids[0] = np.array(self.fast.encode_ordinary(joined.tobytes().decode()), np.uint32)
            lengths[plain] = np.diff(np.searchsorted(np.cumsum(self.width[ids[0]]), ends[1:]) + 1, prepend=0)
        if not plain.all():
            rest = parts.filter(pa.array(~plain)).cast(pa.large_string()).to_pylist()
            found = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
            ids[1] = np.fromiter(chain.from_iterable(found), np.uint32)
            lengths[~plain] = [len(x) for x in found]
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        begin = np.empty(len(parts), np.int64)
        begin[order] = np.cumsum(lengths[order]) - lengths[order]
        return _gather(np.concatenate(ids), begin, lengths), lengths

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and the number of them per text."""
        data, docs = _bytes_of(texts.fill_null("").cast(pa.large_binary()))
        cut = _cuts(data, docs)
        per_text = np.diff(np.searchsorted(cut, docs)) + 1
        offsets = np.sort(np.concatenate([cut, docs]))
        distinct = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        flat, length = self._encoded(distinct.dictionary)
        # one more part, the end of a text, after each
        part = np.insert(distinct.indices.to_numpy(), np.cumsum(per_text), len(length))
        flat, length = np.append(flat, np.uint32(self.end_id)), np.append(length, 1)
        lengths = length[part]
        ids = _gather(flat, (np.cumsum(length) - length)[part], lengths)
        begin = np.cumsum(per_text + 1) - per_text - 1
        return ids, np.add.reduceat(lengths, begin) if len(begin) else lengths


def _bytes_of(values: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values in a row, and where each begins and the last ends."""
    _, at, data = values.buffers()
    offsets = np.frombuffer(at, np.int64)[values.offset:values.offset + len(values) + 1] if at and len(values) else \
        np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


class _Pool:
    """Pieces (document, start) by length; finds the longest one that fits a gap."""

    def __init__(self):
        self.by_length: dict[int, list[tuple[int, int]]] = {}
        self.some = 0                                        # bit n: there is a piece of n tokens

    def add(self, length: int, doc: int, start: int) -> None:
        if length:
            self.by_length.setdefault(length, []).append((doc, start))
            self.some |= 1 << length

    def longest(self, at_most: int) -> int:
        """0 if there is none."""
        return max((self.some & ((2 << at_most) - 1)).bit_length() - 1, 0)

    def take(self, length: int) -> tuple[int, int]:
        own = self.by_length[length]
        piece = own.pop()
        if not own:
            self.some &= ~(1 << length)
        return piece


def pack(lengths: np.ndarray, window: int = WINDOW, smallest: int = SMALLEST
         ) -> tuple[np.ndarray, np.ndarray]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths in the order of
    document and start, and the context of each sequence.

    Both sizes are powers of two.  Every sequence is full: its pieces add up to its context.
    """
    whole = lengths // window
    doc = np.repeat(np.arange(len(lengths)), whole)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)
    full = np.column_stack([doc, nth * window, np.full_like(doc, window), np.arange(len(doc)), np.zeros_like(doc)])
    contexts, pieces, pool = [window] * len(doc), [], _Pool()
    for i, (n, left) in enumerate(zip((whole * window).tolist(), (lengths % window).tolist())):
        pool.add(left, i, n)

    def place(content: list[tuple[int, int, int]], context: int) -> None:
        at = 0
        for d, start, length in content:
            pieces.append((d, start, length, len(contexts), at))
            at += length
        contexts.append(context)

    tier = window
    while pool.some:
        # tiers are left when their own pieces are used up; the last one takes all
        own = pool.longest(tier)
        if own <= tier // 2 and tier > smallest:
            tier //= 2
            continue
        content, gap = [(*pool.take(own), own)], tier - own
        while gap and pool.some:
            fits = pool.longest(gap)
            if fits:
                content.append((*pool.take(fits), fits))
            else:
                cut = pool.longest(tier)
                d, start = pool.take(cut)
                pool.add(cut - gap, d, start + gap)
                content.append((d, start, fits := gap))
            gap -= fits
        if not gap:
            place(content, tier)
            continue
        left = tier - gap                                    # the last pieces of all
        while left:
            size = 1 << (left.bit_length() - 1)
            part, need = [], size
            while need:
                d, start, length = content.pop(0)
                part.append((d, start, min(length, need)))
                if length > need:
                    content.insert(0, (d, start + need, length - need))
                need -= part[-1][2]
            place(part, size)
            left -= size
    out = np.concatenate([full, np.array(pieces, np.int64).reshape(-1, 5)])
    return out[np.lexsort((out[:, 1], out[:, 0]))], np.array(contexts, np.int64)


def step_groups(contexts: np.ndarray, costs: np.ndarray, step_tokens: int = STEP_TOKENS) -> tuple[np.ndarray, int]:
    """Step of each sequence, and the number of steps.

    A step holds sequences of one context and at most ``step_tokens`` tokens;
    the steps of a context differ by at most one sequence, and are dealt the
    costs in descending order, forth and back.
    """
    step, first = np.zeros(len(contexts), np.int64), 0
    for context in np.unique(contexts):
        own = np.flatnonzero(contexts == context)
        own = own[np.argsort(-costs[own], kind="stable")]
        groups = -(-len(own) // max(1, step_tokens // int(context)))
        turn, at = np.divmod(np.arange(len(own)), groups)
        step[own] = first + np.where(turn % 2, groups - 1 - at, at)
        first += groups
    return step, first


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", *,
                   window: int = WINDOW, smallest: int = SMALLEST, end_id: int = END_ID,
                   step_tokens: int = STEP_TOKENS, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """(id, start, length, ids, doc_tokens, sequence_id, offset, context, step) of every piece.

    ``ids`` are the piece's tokens as little-endian unsigned 32-bit integers,
    ``start`` the tokens of its document before it, ``offset`` those of its
    sequence.  ``tokenizer`` is a file of the tokenizers library on the driver;
    it is broadcast (a vocabulary, a few MB).
    """
    if window & (window - 1) or smallest & (smallest - 1) or not 0 < smallest <= window:
        raise ValueError("window and smallest must be powers of two, smallest the lesser")
    vocabulary = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "context", "step"]

    def packed(held: list[tuple[pa.Array, np.ndarray, np.ndarray]], sequence: int, step: int
               ) -> tuple[pa.RecordBatch, int, int]:
        doc_ids = pa.concat_arrays([h[0] for h in held])
        ids, lengths = (np.concatenate([h[i] for h in held]) for i in (1, 2))
        pieces, contexts = pack(lengths, window, smallest)
        d, start, length, of, offset = pieces.T
        group, groups = step_groups(contexts, np.bincount(of, length.astype(float) ** 2, len(contexts)), step_tokens)
        # pieces stand in the order of their tokens: one buffer holds them all
        cuts = np.concatenate([[0], np.cumsum(length)]) * 4
        data = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(d), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
        cols = [doc_ids.take(pa.array(d)), start, length, data, lengths[d], sequence + of, offset, contexts[of],
                step + group[of]]
        out = pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in cols],
                                         names=names)
        return out, sequence + len(contexts), step + groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value, end_id)
        sequence = step = TaskContext.get().partitionId() * _NUMBERS
        held, tokens = [], 0

        def emit():
            nonlocal sequence, step, held, tokens
            if held:
                out, sequence, step = packed(held, sequence, step)
                held, tokens = [], 0
                for b in few_rows([out]):
                    at = b.schema.get_field_index("ids")
                    yield b.set_column(at, "ids", b.column(at).cast(pa.binary()))

        for b in few_rows(batches):
            ids, lengths = encoder(b.column(1))
            held.append((b.column(0), ids, lengths))
            tokens += len(ids)
            if tokens >= group_tokens:
                yield from emit()
        yield from emit()

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    schema = (f"id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
              "context long, step long")
    return short_batches(rows).mapInArrow(run, schema).withColumnRenamed("id", id_col)
