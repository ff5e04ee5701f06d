"""License scan, chat formatting, byte-level BPE, line dedup, decontamination, n-gram join against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from shelfwise.llm import byte_bpe, chat_format, decontaminate, license_scan, line_dedup, ngram_join

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def rows_of(df, *cols):
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.select(*cols).collect())


# --- license scan

def labels(text):
    found = license_scan.Automaton([*license_scan.BASE, *license_scan.TEMPLATES])
    return {(found.labels[m.template], m.start, m.end) for m in found.scan(license_scan.words_of(text.encode()))}


@pytest.mark.parametrize("text, expected", [
    ("Licensed under the Apache License, Version 2.0.",
     {("apache", 3, 5), ("apache-2.0", 3, 8), ("apache-grant", 0, 8)}),
    ("licensed UNDER the apache\nlicense", {("apache", 3, 5), ("apache-grant", 0, 5)}),
    ("Apache License 2.0", {("apache", 0, 2), ("apache-2.0", 0, 4)}),
    ("Apache License, release 2.0", {("apache", 0, 2)}),
    ("CC BY-NC 4.0; cc by", {("cc-by", 0, 2), ("cc-by-nc", 0, 5), ("cc-by-nc-4.0", 0, 5), ("cc-by", 5, 7)}),
    ("MIT License MIT License", {("mit", 0, 2), ("mit", 2, 4)}),
    ("Copyright (c) 2024 A B C. All rights reserved.", {("all-rights-reserved", 0, 9)}),
    ("copyright all rights reserved", set()),
    ("", set()),
])
def test_templates(text, expected):
    assert labels(text) == expected


def test_nested_optional_and_replaceable_regions():
    a = license_scan.Automaton([("x", "a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>>"
                                      " <<var;name=v;max=2>> d")])
    yes = ["a q d", "a b q d", "a b c q r d", "a q r d", "a b q r d"]
    no = ["a d", "a q r s t d", "a c"]
    for t in yes:
        n = len(t.split())
        assert [(m.start, m.end) for m in a.scan(t.encode().split())] == [(0, n)], t
    for t in no:
        assert not list(a.scan(t.encode().split())), t
    with pytest.raises(ValueError):
        license_scan.Automaton([("y", "<<var;name=v;max=2>> d")])
    with pytest.raises(ValueError):
        license_scan.Automaton([("y", "<<beginOptional>>d<<endOptional>>")])


def test_license_scan_rows(spark, documents, empty):
    rows = [*documents[0], (200, "x MIT License y mit-license. GNU General Public License"), (201, "cc cc by by")]
    got = rows_of(license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")),
                  "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")

    def expected(doc_id, text):
        w, places = words(text), []
        for label, phrase in license_scan.BASE:
            p = phrase.split()
            places += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
        at = [i for i, _ in places]
        return (doc_id, len(w), len(at), min(at, default=None), max(at, default=None),
                ",".join(sorted({x for _, x in places})))

    assert got == Counter(expected(*r) for r in rows)
    assert license_scan.scan_licenses(empty).count() == 0


# --- chat formatting

def test_chat_round_trip(spark):
    tricky = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\nhi", "\\", "\\n", "<\\|", "", None, "é😀" * 9,
              "<<SYS>>x<</SYS>>", "a" * 50_000, "<|", "\\\\<|im_end|>"]
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "sys\ntem", None, "<|x", "n\\n"]), rng.choice(tricky))
            for c in [None, 5, 6, 7, 8] for t in range(rng.randint(1, 9))]
    rows += [(9, 1, "assistant", "same"), (9, 1, "assistant", "same"), (9, None, "user", "first"), (9, 0, "user", "z")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, part string, loss int")
    formatted = chat_format.format_conversations(df)
    got = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    low = (-1,)
    for conv, group in itertools.groupby(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), lambda r: r[0]):
        turns = sorted(group, key=lambda r: (r[1] if r[1] is not None else -1, (r[2] is not None, r[2] or ""),
                                             (r[3] is not None, r[3] or "")))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[conv].loss_chars == len(loss)
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    parts = formatted.collect()
    assert sum(len(r.formatted) for r in parts) == sum(r.formatted_chars for r in got.values())
    for r in parts:      # control strings stand only where the template puts them
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == r.n_turns
        assert "[INST]" not in r.formatted and "</s>" not in r.formatted
    assert low and chat_format.read_back(chat_format.format_conversations(df.limit(0))).count() == 0


def test_chat_parts_of_a_long_conversation(spark, monkeypatch):
    rows = [(1, t, "assistant" if t % 2 else "user", "x%d " % t * 200) for t in range(80)] + [(2, 0, "user", "end")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(chat_format, "RUN_BYTES", 5000)
    runs = list(chat_format._runs(__import__("pyarrow").RecordBatch.from_pydict(
        {"conv": [1] * 81, "role": ["user"] * 81, "text": [r[3] for r in rows]})))
    assert len(runs) > 5 and runs[0][0] == 0 and runs[-1][1] == 81
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(df)).collect()}
    assert got[1].n_turns == 80 and got[1].loss_chars == sum(len(r[3]) for r in rows if r[2] == "assistant")


# --- byte-level BPE

@pytest.fixture(scope="module")
def reference_encoding():
    ranks = byte_bpe.load_ranks(VOCABULARY)
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                    special_tokens={})


def test_bpe_matches_library(spark, documents, empty, reference_encoding):
    ranks, enc = reference_encoding
    rng = random.Random(1)
    parts = ["a", "ab", "é", "the", "ing", " ", "\n", "\x1c", "　", "１", "😀", "--", "=", "0", "'ll", "中文", "\u0301"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 80))) for _ in range(600)]
    texts += ["a" * 30_001, "ab" * 9000, "-" * 999, " " * 500, "=-" * 500 + "aaa", "<|endoftext|>"]
    rows = [*documents[0], *((1000 + i, t) for i, t in enumerate(texts))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string").repartition(5)
    encoded = byte_bpe.encode_documents(df, VOCABULARY, public_tokenizers.PATTERN)
    expected = Counter((i, tuple(enc.encode_ordinary(t or ""))) for i, t in rows)
    assert rows_of(encoded, "doc_id", "ids") == expected
    trip = byte_bpe.round_trip(df, VOCABULARY, public_tokenizers.PATTERN, keep_ids=True)
    assert rows_of(trip, "doc_id", "ids") == expected
    digests = rows_of(trip, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert digests == Counter(
        (i, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(),
         hashlib.sha256((t or "").encode()).hexdigest())
        for (i, t), x in ((r, enc.encode_ordinary(r[1] or "")) for r in rows))
    decoded = Counter((r.doc_id, bytes(r.decoded)) for r in byte_bpe.decode_documents(encoded, VOCABULARY).collect())
    assert decoded == Counter((i, (t or "").encode()) for i, t in rows)
    assert byte_bpe.encode_documents(empty, VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_bpe_table_restart_keeps_ids(reference_encoding, monkeypatch):
    ranks, enc = reference_encoding
    monkeypatch.setattr(byte_bpe, "MAX_PIECES", 10)
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for t in ["some words here", "other words there and many more of them, not the same", "some words here"]:
        assert [x.tolist() for x in encoder([t, None, ""])] == [enc.encode_ordinary(t), [], []]


def test_rank_queue_finds_the_lowest_rank():
    rng, q, held = random.Random(2), byte_bpe.RankQueue(50_000), {}
    for _ in range(3000):
        if rng.random() < 0.6 or not held:
            r = rng.choice([0, 63, 64, 4095, 4096, 49_999, rng.randrange(50_000)])
            pos = sorted(rng.sample(range(1000), 3))
            q.push(r, np.array(pos))
            held.setdefault(r, set()).update(pos)
        else:
            rank, pos = q.pop()
            assert rank == min(held) and pos.tolist() == sorted(held.pop(rank))
    while held:
        assert q.pop()[0] == min(held)
        held.pop(min(held))
    assert q.pop() is None


# --- line dedup

def line_oracle(rows, min_chars=10):
    def key(x):
        return x.strip(" \t\n\x0b\x0c\r").translate(UPPER)

    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for x in (t or "").split("\n"):
                holders[key(x)].add(i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(key(x)) < min_chars or min(holders[key(x)]) == i]
        out[i, "\n".join(keep), len(lines), len(lines) - len(keep)] += 1
    return out


@pytest.mark.parametrize("bits", [1 << 13, line_dedup.MAX_FILTER_BITS])
def test_line_dedup(documents, empty, bits):
    rows, df = documents
    got = rows_of(line_dedup.dedup_lines(df, max_filter_bits=bits), "doc_id", "text", "n_lines", "n_dropped")
    assert got == line_oracle(rows)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_line_dedup_keeps_other_columns(documents):
    _, df = documents
    out = line_dedup.without_lines(df, line_dedup.repeated_lines(df))
    assert out.columns == ["doc_id", "key", "block", "n", "text", "n_lines", "n_dropped"]
    assert rows_of(out, "key", "block", "n") == rows_of(df, "key", "block", "n")


def test_filter_positions_survive_packing():
    rng = np.random.default_rng(0)
    for n in (0, 1, 50, 3000):
        p = np.unique(rng.integers(0, 1 << 14, n)).astype(np.uint32)
        flags = np.unpackbits(line_dedup._unpack(line_dedup._pack(p, 1 << 14), 1 << 14), bitorder="little")
        assert np.flatnonzero(flags).tolist() == p.tolist()


# --- decontamination

def contamination_oracle(rows, items):
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(len(w), 10)
        for p in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[p:p + n])].add("" if i is None else str(i))
    out = Counter()
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                ids = windows.get(tuple(w[p:p + n]))
                if ids:
                    hit |= set(range(p, p + n))
                    found |= ids
        out[i, len(w), len(hit), len(found), tuple(sorted(found))] += 1
    return out


@pytest.mark.parametrize("broadcast_rows", [0, decontaminate.BROADCAST_ROWS])
def test_contamination(spark, documents, empty, broadcast_rows):
    rng = random.Random(9)
    rows = list(documents[0])
    some = [t for _, t in rows if t and 30 < len(words(t)) < 400]
    items = [(7, None), (8, ""), (9, "one two"), (10, "ONE, two!"), (11, "emoji"), (None, "negative id text here"),
             (12, "longer line"), (13, "a b " * 30), (14, "the and nothing else that occurs in any of them at all")]
    for i in range(20):
        w = words(rng.choice(some))
        p = rng.randrange(max(1, len(w) - 15))
        items.append((100 + i, " ".join([*["zz"] * rng.randint(0, 3), *w[p:p + rng.randint(4, 40)], "qq"])))
    items += [items[-1], (300, items[-1][1]), (8, "emoji 😀 é😀 emoji")]
    planted = " ".join(words(items[-4][1])[2:14])
    rows += [(500, "before it " + planted + " after it"), (501, planted.upper().replace(" ", " - "))]
    docs = spark.createDataFrame([(*r, 1, "h") for r in rows], "doc_id long, text string, n_words int, hash string")
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, class string")
    out = decontaminate.contamination(docs, bench, broadcast_rows=broadcast_rows)
    got = rows_of(out, "doc_id", "n_words", "n_hit", "n_items", "item_ids")
    expected = contamination_oracle(rows, items)
    assert got == expected
    assert sum(1 for r in expected if r[2]) > 10
    assert decontaminate.contamination(empty, bench).count() == 0
    clean = decontaminate.without_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == sum(n for r, n in expected.items() if not r[2])
    assert {r[2] for r in rows_of(decontaminate.contamination(docs, bench.limit(0)), "doc_id", "n_words", "n_hit")} == {0}


def test_texts_with_equal_64_bit_hashes_are_told_apart(spark):
    """Two texts of one xxhash64, found by solving its second round; only the first holds the item."""
    texts = ["lilypond".ljust(32) + "crossing".ljust(32), "fvguaoxu".ljust(32) + "SIqzf{*M".ljust(32)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string")
    assert docs.select(F.xxhash64("text")).distinct().count() == 1
    bench = spark.createDataFrame([(1, "lilypond")], "item_id long, text string")
    out = decontaminate.contamination(docs, bench)
    assert rows_of(out, "doc_id", "n_hit") == Counter((i, 1 - i % 2) for i in range(6))
    clean = decontaminate.without_contaminated(docs, bench)
    assert sorted(r.doc_id for r in clean.collect()) == [1, 3, 5]


@pytest.mark.parametrize("limit", ["rows", "bytes"])
def test_only_few_fingerprint_rows_are_broadcast(spark, monkeypatch, limit):
    """Items that share a passage in contexts of their own have few hashes but many rows."""
    passage = "the rest of the lily and stone with another thane over there " + " ".join(f"w{i}" for i in range(40))
    items = [(i, f"{passage} c{i}") for i in range(60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, f"x y {passage} z") for i in range(5)] + [(5, "x y z"), (6, items[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sent, broadcast = [], F.broadcast
    monkeypatch.setattr(decontaminate.F, "broadcast", lambda df: sent.append((df.columns, df.count())) or broadcast(df))
    if limit == "bytes":
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 20_000)
    most = decontaminate.BROADCAST_ROWS if limit == "bytes" else 250
    out = decontaminate.contamination(docs, bench, broadcast_rows=most)
    got = rows_of(out, "doc_id", "n_words", "n_hit", "n_items", "item_ids")
    assert got == contamination_oracle(rows, items)
    assert [columns for columns, _ in sent] == [["hash"]] and sent[0][1] <= 250


# --- n-gram join

def jaccard_oracle(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
        s = {tuple(w[p:p + n]) for p in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
        sets.setdefault(i, []).append(s)
    ids = [i for i in sets if i is not None]
    comp = {i: i for i in ids}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        for x, y in itertools.product(sets[a], sets[b]):
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = sorted((root(a), root(b)))
                comp[rb] = ra
    return Counter((i, len(next(s for s in sets[i])) if i is not None else None, root(i) if i is not None else None)
                   for i, t in rows)


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80), (1, 60)])
@pytest.mark.parametrize("broadcast_rows", [0, 1_000_000])
def test_ngram_components(documents, empty, monkeypatch, n, percent, broadcast_rows):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", broadcast_rows)
    rows, df = documents
    got = ngram_join.ngram_components(df, words=n, percent=percent)
    expected = jaccard_oracle(rows, n, percent)
    assert Counter((r.doc_id, r.n_shingles if r.doc_id is not None else None, r.component_id)
                   for r in got.collect()) == expected
    assert len({r[2] for r in expected}) < len({r[0] for r in expected}) - 3
    assert ngram_join.ngram_components(empty, words=n, percent=percent).count() == 0


def test_ngram_components_without_rounds(documents, monkeypatch):
    """Block visits alone find every link: the rounds only save work."""
    monkeypatch.setattr(ngram_join, "ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "BLOCK", 2)
    monkeypatch.setattr(ngram_join, "SLICE", 3)
    rows, df = documents
    got = Counter((r.doc_id, r.n_shingles if r.doc_id is not None else None, r.component_id)
                  for r in ngram_join.ngram_components(df, words=4, percent=85).collect())
    assert got == jaccard_oracle(rows, 4, 85)
