"""License scans by template markup.

A template is wording with two kinds of marked regions, in the markup of the
public SPDX license templates:

* ``<<beginOptional>> ... <<endOptional>>``: may be left out (may be nested);
* ``<<var;name=NAME;max=N>>``: replaceable, stands for 1 to N words of any kind.

All templates are compiled into one token automaton.  Words (A-Z lower-cased,
of 0-9, a-z and everything above 0x7F) are its tokens, so punctuation, case and line breaks do not
matter; a place is accepted when every mandatory word of a template matches
exactly, in order, with nothing but its marked regions in between.  State sets
are memoised per word as they are met (a lazy DFA), and matching starts only
at words that some template can start with.

The base templates are plain phrases; the others add labels of their own.

Cases: null or empty text has no words and no places; texts of any length are
scanned whole, one row at a time; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import few_rows, short_batches

# the word pattern in UTF-8: a character above 0x7F has only bytes above 0x7F
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MARKUP = re.compile(r"<<(beginOptional|endOptional|var;[^>]*)>>")

# Base phrases and their labels.
BASE = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]
# Public license wording, marked up by hand.
TEMPLATES = [
    ("apache-2.0", "apache license <<beginOptional>>version<<endOptional>> 2.0"),
    ("apache-grant", "licensed under the apache license <<beginOptional>>version <<var;name=major;max=1>>"
                     "<<beginOptional>>.<<var;name=minor;max=1>><<endOptional>><<endOptional>>"),
    ("gpl-2.0", "gnu general public license <<beginOptional>>as published by the free software foundation"
                " either<<endOptional>> version 2"),
    ("gpl-3.0", "gnu general public license <<beginOptional>>as published by the free software foundation"
                " either<<endOptional>> version 3"),
    ("gpl-grant", "<<beginOptional>>this <<var;name=work;max=3>> is<<endOptional>> licensed under the "
                  "<<beginOptional>>terms of the<<endOptional>> gnu general public license"),
    ("lgpl", "gnu <<beginOptional>>lesser<<endOptional>><<beginOptional>>library<<endOptional>>"
             " general public license <<beginOptional>>version<<endOptional>> 2.1"),
    ("mit-grant", "<<beginOptional>>released<<endOptional>><<beginOptional>>licensed<<endOptional>>"
                  " under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software"
                 " <<beginOptional>>and associated documentation files the software<<endOptional>> to deal in"
                 " the software without restriction"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted"
                 " provided that the following conditions are met"),
    ("cc-by-4.0", "cc by 4.0"),
    ("cc-by-sa", "cc by sa <<var;name=major;max=1>>.<<var;name=minor;max=1>>"),
    ("cc-by-nc", "cc by nc <<var;name=major;max=1>>.<<var;name=minor;max=1>>"),
    ("cc-by-nc-4.0", "cc by nc 4.0"),
    ("mpl-2.0", "mozilla public license <<beginOptional>>v <<endOptional>><<beginOptional>>version"
                "<<endOptional>> 2.0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "copyright <<beginOptional>>c<<endOptional>> <<var;name=owner;max=8>>"
                            " all rights reserved"),
]


def words_of(text: bytes | None) -> list[bytes]:
    """Words in UTF-8 (``bytes.lower`` changes A-Z only)."""
    return _WORD.findall(text.lower()) if text else []


def parse(markup: str) -> list[tuple]:
    """Template markup as a flat list of ("word", w), ("var", n), ("begin",), ("end",)."""
    out: list[tuple] = []
    for i, piece in enumerate(_MARKUP.split(markup)):
        if i % 2 == 0:
            out += [("word", w) for w in words_of(piece.encode())]
        elif piece == "beginOptional":
            out.append(("begin",))
        elif piece == "endOptional":
            out.append(("end",))
        else:
            out.append(("var", int(re.search(r"max=(\d+)", piece)[1])))
    return out


def mandatory_words(markup: str) -> int:
    """Words outside every marked region."""
    depth = n = 0
    for x in parse(markup):
        depth += (x[0] == "begin") - (x[0] == "end")
        n += x[0] == "word" and not depth
    return n


@dataclass(frozen=True)
class Match:
    template: int
    start: int
    end: int      # exclusive


class Automaton:
    """All templates as one token automaton.

    A state is (template, k): k steps of that template's word sequence are
    behind.  Each step reads one word, exactly or any; ``skip`` edges leave
    out an optional region or the rest of a replaceable one.
    """

    OTHER = None      # stands for every word that no template names

    def __init__(self, templates: Sequence[tuple[str, str]]):
        self.labels = [label for label, _ in templates]
        self.mandatory = [mandatory_words(m) for _, m in templates]
        self.read: dict[tuple[int, int], bytes | None] = {}        # state -> word it reads (OTHER: any)
        skips: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.final: dict[tuple[int, int], int] = {}
        for t, (_, markup) in enumerate(templates):
            k, open_at = 0, []
            for x in parse(markup):
                if x[0] == "word":
                    self.read[t, k] = x[1]
                    k += 1
                elif x[0] == "var":
                    for i in range(x[1]):
                        self.read[t, k + i] = self.OTHER
                        if i:
                            skips.setdefault((t, k + i), []).append((t, k + x[1]))
                    k += x[1]
                elif x[0] == "begin":
                    open_at.append(k)
                else:
                    skips.setdefault((t, open_at.pop()), []).append((t, k))
            self.final[t, k] = t
        self._skips = skips
        start = self._closed((t, 0) for t in range(len(templates)))
        self.alphabet = {w for w in self.read.values() if w is not self.OTHER}
        self._ids: dict[frozenset, int] = {}
        self._sets: list[frozenset] = []
        self.accepts: list[tuple[int, ...]] = []
        self._moves: list[dict] = []
        self._start = self._id(start)
        self.firsts = frozenset(self.read[s] for s in start if s in self.read)
        if self.OTHER in self.firsts or self.accepts[self._start]:
            raise ValueError("a template must start with a word and must not match nothing")

    def _closed(self, states) -> frozenset:
        out, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s not in out:
                out.add(s)
                todo += self._skips.get(s, ())
        return frozenset(out)

    def _id(self, states: frozenset) -> int:
        if states not in self._ids:
            self._ids[states] = len(self._sets)
            self._sets.append(states)
            self.accepts.append(tuple(sorted(self.final[s] for s in states if s in self.final)))
            self._moves.append({})
        return self._ids[states]

    def _move(self, at: int, word: bytes) -> int:
        """Next state-set id, or -1 when nothing is left; memoised per word of the alphabet."""
        key = word if word in self.alphabet else self.OTHER
        if key not in self._moves[at]:
            to = self._closed((t, k + 1) for t, k in self._sets[at]
                              if (t, k) in self.read and self.read[t, k] in (self.OTHER, key))
            self._moves[at][key] = self._id(to) if to else -1
        return self._moves[at][key]

    def scan(self, words: list[bytes]) -> Iterator[Match]:
        """The longest match of each template at each place it starts."""
        firsts, move, accepts = self.firsts, self._move, self.accepts
        for i in [i for i, w in enumerate(words) if w in firsts]:
            at, j, ends = self._start, i, {}
            while j < len(words):
                at = move(at, words[j])
                if at < 0:
                    break
                j += 1
                for t in accepts[at]:
                    ends[t] = j
            for t, end in ends.items():
                yield Match(t, i, end)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  templates: Sequence[tuple[str, str]] = tuple(TEMPLATES)) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    ``matches`` lists (label, start, end) in words, end exclusive.  ``score`` is
    m / (m + 4) with m the mandatory words of the longest accepted template,
    0 without any.
    """
    every = [*BASE, *templates]
    id_type = docs.schema[id_col].dataType.simpleString()

    def scan(batches):
        automaton = Automaton(every)
        n_base_templates = len(BASE)
        for b in few_rows(batches):
            out = []
            for text in b.column(1).to_pylist():
                words = words_of(text)
                found = list(automaton.scan(words))
                base = [m.start for m in found if m.template < n_base_templates]
                longest = max((automaton.mandatory[m.template] for m in found), default=0)
                out.append((
                    len(words), len(base), min(base, default=None), max(base, default=None),
                    ",".join(sorted({automaton.labels[m.template] for m in found
                                     if m.template < n_base_templates})),
                    ",".join(sorted({automaton.labels[m.template] for m in found})),
                    longest / (longest + 4),
                    [{"label": automaton.labels[m.template], "start": m.start, "end": m.end} for m in found]))
            cols = list(zip(*out)) or [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
                [("label", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                       "matches"])

    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").cast("binary").alias("text"))
    return short_batches(texts).mapInArrow(
        scan, f"id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
              "labels string, score double, matches array<struct<label:string,start:int,end:int>>"
    ).withColumnRenamed("id", id_col)
