"""Phrase collocation mining: exact counts of frequent phrases by Toivonen's sampling.

1. A sample of the documents proposes phrases: level by level, those of its
   phrases that reach a lowered threshold and whose parts (all but the last
   word, all but the first) are proposed too.
2. A full pass over all texts counts every occurrence of the proposed phrases
   and of their *negative border*: all words, and all phrases both of whose
   parts are proposed.  Frequent phrases of the border are failures of the
   sample.
3. A second full pass expands the failures and gives the counted phrases their
   text.  It counts, by text, the frequent phrases of the first pass, and all
   phrases of frequent words that contain a failure.  No further pass can find
   more: a frequent phrase that the first pass left out has a smallest part
   that was not proposed; the parts of that one were, so it was counted in the
   border, is frequent, and so is one of the failures.

The sample decides how much is counted, never the result.  Counts of the first
pass are by 64-bit hash, so one may be that of two phrases; those of the second
pass, the results, are by text.

What a task asks of a set of phrases is a Bloom filter, 12 bits each: a false
positive counts a phrase more, it never loses one.  Filters grow with the sets
up to ``MAX_FILTER_BITS`` (32 MB).  Beyond that a pass is made in slices by the
hash of a phrase's first word, each with its own filter of that size (in the
first pass a slice checks the part without the last word only, as the other
one belongs to another slice); the filters of frequent words and of failures
then hold more than 12 bits can tell apart, and more is counted.  Results are
the same.

A phrase scores floor(scale * a / (l + r)) at the cut into two parts where that
is lowest, a, l and r being the counts of the phrase and the parts.  Candidates
that nearly always stand in a longer one are dropped.

Counts are added up per task and shuffled by phrase, so a phrase or language
that holds a third of all rows is no hot spot, and the first ranks of a
language are cut off per task before they meet.

Cases: null and empty texts have no words; a null language is ``und``; an empty
table gives an empty result; repeated rows all count; ties in score go to the
greater count, then to the phrase first in byte order; very long texts are
counted whole, in one group of a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, few_rows, short_batches, written

MIN_COUNT, SCALE, COVER = 30, 2_000_000, 80
NO_LANGUAGE = "und"
SAMPLE, SEED = 1 / 8, 11
FILTER_BITS_EACH, MAX_FILTER_BITS, PROBES = 12, 1 << 28, 3
# bytes of text whose phrases a task counts at once
GROUP_BYTES = 8 << 20

# What separates pieces, and what separates words.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_FOLD = bytes.maketrans(UPPER.encode() + PIECE_ENDS + BLANKS,
                        LOWER.encode() + b"." * len(PIECE_ENDS) + b" " * len(BLANKS))
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
# A phrase's key: 54 bits of hash, 8 bits of its first word's, its number of words less one.
_HASH, _FIRST = np.uint64((1 << 64) - (1 << 10)), np.uint64(0xFF)
MOST_SLICES, MOST_WORDS = 256, 4


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _joined(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of the phrase without its last word and of that word."""
    return _mixed(first * _ODD + last)


def _keys(first_words: np.ndarray, hashes: np.ndarray, words: int) -> np.ndarray:
    return hashes & _HASH | (first_words >> np.uint64(56)) << np.uint64(2) | np.uint64(words - 1)


def _slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    return (keys >> np.uint64(2) & _FIRST) % np.uint64(slices)


def _word_hashes(language: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(language)
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _positions(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    h = _mixed(keys * _ODD)
    step = h >> np.uint64(32) | np.uint64(1)
    return [(h + np.uint64(i) * step & np.uint64(bits - 1)).astype(np.int64) for i in range(PROBES)]


@dataclass
class Filter:
    """Bloom filter of phrases by key."""
    flags: np.ndarray          # packed bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for p in _positions(keys, len(self.flags) * 8):
            out &= (self.flags[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
        return out


def _filter(keys: DataFrame, bits: int, slices: int = 1, number: int = 0) -> Filter:
    """Filter of the keys (key long) of one slice; at most ``bits`` / 8 bytes come to the driver."""

    def positions(batches):
        for b in few_rows(batches, 50_000):
            k = b.column(0).to_numpy().view(np.uint64)
            k = k[_slice_of(k, slices) == number]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_positions(k, bits)))], names=["bit"])

    # Spark's bitmap functions count positions from 1
    at = F.col("bit") + 1
    maps = (keys.select("key").mapInArrow(positions, "bit long")
            .groupBy(F.bitmap_bucket_number(at).alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect())
    flags = np.zeros(bits // 8, np.uint8)
    for m in maps:
        own = np.frombuffer(m.bits, np.uint8)
        begin = (m.part - 1) * len(own)
        flags[begin:begin + len(own)] = own[:len(flags) - begin]
    return Filter(flags)


def _bits(keys: DataFrame) -> int:
    """Bits of a filter of these keys (a power of two)."""
    return 1 << (max(1 << 16, keys.count() * FILTER_BITS_EACH) - 1).bit_length()


def _slices(keys: DataFrame, max_bits: int) -> Iterator[tuple[Filter, int, int]]:
    """(filter, slice, slices) of the keys; one slice unless they need more than ``max_bits``."""
    need = _bits(keys)
    slices = min(MOST_SLICES, max(1, need // max_bits))
    for number in range(slices):
        yield _filter(keys, min(need // slices, max_bits), slices, number), number, slices


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number and piece of each word of the texts in order, and the distinct words."""
    data = np.frombuffer(b".".join(texts).translate(_FOLD), np.uint8)
    in_word = (data != ord(" ")) & (data != ord("."))
    edge = np.diff(in_word.astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
    piece = np.cumsum(data == ord("."), dtype=np.int32)[begin]
    offsets = np.concatenate([[0], np.cumsum(end - begin)])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data[in_word])]).dictionary_encode()
    return words.indices.to_numpy(), piece, words.dictionary


def border_counts(language: str, texts: list[bytes], known: Filter | None, levels: range, number: int = 0,
                  slices: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) per level of the texts' phrases both of whose parts are ``known``; words have no parts."""
    word, piece, distinct = _words(texts)
    if not len(word):
        return
    hashes = of_word = _word_hashes(language, distinct.to_pylist())
    first = np.arange(len(distinct))                          # first word of each phrase of the level
    keys = _keys(of_word, hashes, 1)
    own = _slice_of(keys, slices) == number
    if 1 in levels:
        yield keys[own], np.bincount(word, minlength=len(distinct))[own]
    # gram: the phrase of the last level that begins at each word, -1 where none does or it is not known
    gram = np.where(own[word], word, -1)
    for m in range(2, levels[-1] + 1):
        gram = np.where((gram >= 0) & known.has(keys)[gram], gram, -1)
        begin = len(word) - m + 1
        at = np.flatnonzero((gram[:max(begin, 0)] >= 0) & (piece[:max(begin, 0)] == piece[m - 1:]))
        if slices == 1:
            at = at[gram[at + 1] >= 0]
        if not len(at):
            return
        code, pairs = pd.factorize(gram[at] * np.int64(len(distinct)) + word[at + m - 1])
        part, last = np.divmod(pairs, len(distinct))
        hashes, first = _joined(hashes[part], of_word[last]), first[part]
        keys = _keys(of_word[first], hashes, m)
        gram = np.full(len(word), -1)
        gram[at] = code
        if m in levels:
            yield keys, np.bincount(code)


@dataclass
class Found:
    """What the first pass found: frequent phrases (of one slice), frequent words, failures."""
    frequent: Filter
    words: Filter
    failures: Filter
    number: int
    slices: int


def text_counts(language: str, texts: list[bytes], found: Found, max_words: int
                ) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(words, phrases, counts) of the texts' phrases of frequent words that are frequent or contain a failure.

    Level 0 is one empty phrase, counted as often as there are words.
    """
    word, piece, distinct = _words(texts)
    if found.number == 0:
        yield 0, pa.array([b""], pa.large_binary()), np.array([len(word)])
    if not len(word):
        return
    of_word = _word_hashes(language, distinct.to_pylist())
    keys = _keys(of_word, of_word, 1)
    often = found.words.has(keys)
    own = (_slice_of(keys, found.slices) == found.number)
    named = often & own & found.frequent.has(keys)
    n = np.bincount(word, minlength=len(distinct))
    yield 1, distinct.filter(pa.array(named)), n[named]

    width = np.int64(len(distinct))
    hashes, failed = of_word[word], found.failures.has(keys)[word]
    at = np.flatnonzero(often[word])                          # phrases of frequent words of the level begin here
    pair, pairs, code = np.full(len(word), -1), None, None
    for m in range(2, max_words + 1):
        at = at[at < len(word) - m + 1]
        at = at[often[word[at + m - 1]] & (piece[at] == piece[at + m - 1])]
        if not len(at):
            return
        last = word[at + m - 1]
        if m == 2:                                            # longer phrases are told apart by their pairs
            code, pairs = pd.factorize(word[at] * width + last)
            pair[at] = code
        longer = _joined(hashes[at], of_word[last])
        begins = of_word[word[at]]
        keys = _keys(begins, longer, m)
        bad = failed[at] | failed[at + 1]
        if m < max_words:
            bad |= found.failures.has(keys)
        take = found.frequent.has(keys) | bad
        if found.slices > 1:
            take &= _slice_of(keys, found.slices) == found.number
        hashes[at], failed[at] = longer, bad
        some = at[take]
        if not len(some):
            continue
        codes = [pair[some]] if m == 2 else [pair[some], word[some + 2]] if m == 3 else [pair[some], pair[some + 2]]
        code, which = pd.factorize(codes[0] if m == 2 else codes[0] * np.int64(max(len(pairs), width)) + codes[1])
        place = np.empty(len(which), np.int64)                # a place of each phrase
        place[code] = some
        phrases = pc.binary_join_element_wise(*(distinct.take(pa.array(word[place + i])) for i in range(m)),
                                              pa.scalar(b" ", pa.large_binary()))
        yield m, phrases, np.bincount(code)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts by language, about GROUP_BYTES at once."""
    texts, size = {}, 0
    for b in batches:
        for language, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            texts.setdefault(language, []).append(text)
            size += len(text)
        if size >= GROUP_BYTES:
            yield from texts.items()
            texts, size = {}, 0
    yield from texts.items()


def _border(docs: DataFrame, known: DataFrame | None, levels: range, least: int, max_filter_bits: int) -> DataFrame:
    """(key, n), written: the phrases that reach ``least`` of those that ``border_counts`` counts in all texts."""
    context, out = docs.sparkSession.sparkContext, None
    for flt, number, slices in _slices(known, max_filter_bits) if known is not None else [(None, 0, 1)]:
        held = context.broadcast(flt)

        def count(batches, held=held, number=number, slices=slices):
            for language, texts in _groups(batches):
                for keys, n in border_counts(language, texts, held.value, levels, number, slices):
                    yield from few_rows([pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])], 50_000)

        part = written(docs.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
                       .filter(F.col("n") >= least), "phrase-keys")
        held.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def _named(docs: DataFrame, counted: DataFrame, known: DataFrame, min_count: int, max_words: int,
           max_filter_bits: int) -> DataFrame:
    """(lang, phrase, words, n): the second pass."""
    context, out = docs.sparkSession.sparkContext, None
    size = F.col("key").bitwiseAND(F.lit(3)) + 1
    words = counted.filter(size == 1)
    failures = written(counted.filter(size < max_words).join(known, "key", "left_anti"), "phrase-failures")
    small = [_filter(x, min(_bits(x), max_filter_bits)) for x in (words, failures)]
    for flt, number, slices in _slices(counted, max_filter_bits):
        held = context.broadcast(Found(flt, *small, number, slices))

        def count(batches, held=held):
            for language, texts in _groups(batches):
                for m, phrases, n in text_counts(language, texts, held.value, max_words):
                    yield from few_rows([pa.RecordBatch.from_arrays(
                        [pa.array([language]).take(pa.array(np.zeros(len(n), np.int32))),
                         phrases.cast(pa.binary()).cast(pa.string()), pa.array(np.full(len(n), m, np.int32)),
                         pa.array(n, pa.int64())], names=["lang", "phrase", "words", "n"])], 50_000)

        part = written(docs.mapInArrow(count, "lang string, phrase string, words int, n long")
                       .groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
                       .filter((F.col("words") == 0) | (F.col("n") >= min_count)), "phrase-counts")
        held.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, min_count: int = MIN_COUNT,
                     max_words: int = MOST_WORDS, sample: float = SAMPLE, seed: int = SEED,
                     max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """(lang, phrase, words, n) of every phrase of up to ``max_words`` (at most 4) words that occurs ``min_count``
    times or more, and per language one row with an empty phrase and no words: its number of words."""
    if not 1 <= max_words <= MOST_WORDS or max_filter_bits & (max_filter_bits - 1):
        raise ValueError("phrases have 1 to 4 words, and max_filter_bits is a power of two")
    texts = short_batches(docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text")))
    some, least, known = written(texts.sample(sample, seed), "phrase-sample"), max(1, round(min_count * sample / 2)), None
    for m in range(1, max(max_words, 2)):
        own = _border(some, known, range(m, m + 1), least, max_filter_bits).select("key")
        known = own if known is None else known.unionByName(own)
    counted = _border(texts, known, range(1, max_words + 1), min_count, max_filter_bits)
    return _named(texts, counted, known, min_count, max_words, max_filter_bits)


def _part(first, words):
    return F.array_join(F.slice("w", first, words), " ")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, top: int = 2000,
                 scale: int = SCALE, cover: int = COVER, **mining) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two words or more of each language.

    A phrase inside a longer one that occurs at least ``cover`` percent as
    often is dropped.  ``mining``: the options of ``frequent_phrases``.
    """
    counts = frequent_phrases(docs, text_col, lang_col, **mining)
    totals = counts.filter("words = 0").select("lang", F.col("n").alias("n"))
    known = counts.filter("words > 0").select("lang", "phrase", "n")
    # words hold no blanks, so a phrase gives them back
    long = counts.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"),
                                             F.split("phrase", " ").alias("w"))

    cuts = long.select("lang", "phrase", "a", "w", "words",
                       F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")) \
               .select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("first"),
                       _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    left = known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    # exact: products may pass 64 bits
    score = F.expr(f"cast(a as decimal(20,0)) * {scale}BD div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
            .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r"))
                                                .alias("cut")))

    inner = long.filter("words > 2").select("lang", "words", "a", "w", F.explode(
        F.sequence(F.lit(2), F.col("words") - 1)).alias("size")) \
        .select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1))
                .alias("at")).select("lang", _part(F.col("at"), F.col("size")).alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    covered = F.expr(f"100BD * cast(longer as decimal(20,0)) >= {cover}BD * cast(a as decimal(20,0))")
    kept = best.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | ~covered)

    rank = F.row_number().over(Window.partitionBy("lang").orderBy(
        F.desc("cut.score"), F.desc("a"), F.asc("phrase")))
    return (kept.withColumn("rank", rank).filter(F.col("rank") <= top).join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n",
                    "cut.score"))
