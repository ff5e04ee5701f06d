"""Packing, phrase mining and centroid clustering against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shelfwise.llm import centroids, packing, phrases

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# --- packing

def check_pieces(rows, texts, window=1024):
    """Every token of every document in one piece, sequences without gaps and without padding."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = collections.Counter()
    for i, t in texts:
        want[i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (0,)] += 1
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        assert len(r.ids) == 4 * r.length
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == own[0].context <= window and at & (at - 1) == 0
    # repeated rows of one id: their pieces are told apart by what they hold
    got = collections.Counter()
    of_doc = collections.defaultdict(list)
    for r in rows:
        of_doc[r.doc_id].append(r)
    for i, own in of_doc.items():
        total = sum(n * len(ids) for (j, ids), n in want.items() if j == i)
        assert sum(r.length for r in own) == total
        if sum(n for (j, _), n in want.items() if j == i) == 1:
            own.sort(key=lambda r: r.start)
            assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
            ids = tuple(np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist())
            assert {r.doc_tokens for r in own} == {len(ids)}
            got[i, ids] += 1
    assert all(want[k] == n for k, n in got.items()) and set(of_doc) == {i for i, _ in texts}
    return sequences


def test_packed_documents(spark, documents):
    rows, df = documents
    out = packing.pack_documents(df, VOCABULARY)
    assert out.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "context", "step"]
    got = out.collect()
    check_pieces(got, rows)
    steps = collections.defaultdict(set)
    for r in got:
        steps[r.step].add((r.context, r.sequence_id))
    assert all(len({c for c, _ in s}) == 1 and sum(c for c, _ in s) <= packing.STEP_TOKENS for s in steps.values())
    check_pieces(packing.pack_documents(df, VOCABULARY, window=64, smallest=8, group_tokens=500).collect(), rows, 64)
    assert packing.pack_documents(df.limit(0), VOCABULARY).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(df, VOCABULARY, window=1000)


def test_encoder_matches_the_library(documents):
    rng = random.Random(3)
    bits = ["a", "Zürich", "é", " ", "  ", "\n", "\t", "\xa0", " ", "\x1c", "\x85", "don't", "'s", "12", "½", "٣", ",",
            "...", ").", "日本", "ſ", "ɐ", "😀", "<|endoftext|>", "x" * 700, "word", " word", ".\n", "\r\n", "́", "_"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += [t for _, t in documents[0]]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    spec = open(VOCABULARY, encoding="utf-8").read()
    encoder = packing.Encoder(spec)
    assert encoder.fast
    column = pa.array(texts, pa.string())
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    for part in (column, column.slice(5, 300), column.slice(0, 0)):
        ids, lengths = encoder(part)
        own = want if len(part) == len(texts) else want[5:5 + len(part)]
        assert lengths.tolist() == list(map(len, own)) and ids.tolist() == [x for w in own for x in w]
    encoder.fast = None                                      # a file whose merges tiktoken's core does not know
    assert encoder(column)[0].tolist() == [x for w in want for x in w]


def test_tiers_fill_without_padding():
    rng = np.random.default_rng(1)
    for lengths in ([1], [1024], [5000], [600] * 50, [3] * 700, [1023, 1, 1, 1], rng.integers(1, 3000, 500).tolist(), []):
        lengths = np.array(lengths, np.int64)
        pieces, contexts = packing.pack(lengths)
        filled = np.bincount(pieces[:, 3], pieces[:, 2], len(contexts)).astype(int)
        assert (filled == contexts).all() and filled.sum() == lengths.sum()
        assert (np.bincount(pieces[:, 0], pieces[:, 2], len(lengths)) == lengths).all()
    # short pieces stay whole: each context has one cut at most
    lengths = rng.integers(1, 1024, 4000)
    pieces, contexts = packing.pack(lengths)
    assert len(pieces) - len(lengths) <= len(contexts)
    assert (contexts == 1024).mean() > 0.5


def test_steps_are_balanced():
    rng = np.random.default_rng(2)
    contexts = rng.choice([1024, 512, 128], 1000)
    costs = rng.integers(1, 10**6, 1000).astype(float)
    step, n = packing.step_groups(contexts, costs, 8192)
    assert set(step.tolist()) == set(range(n))
    for c in (1024, 512, 128):
        own = [costs[step == s] for s in np.unique(step[contexts == c])]
        assert max(map(len, own)) - min(map(len, own)) <= 1 and max(map(len, own)) <= 8192 // c
        means = [x.mean() for x in own]
        assert max(means) < 1.6 * min(means)


# --- phrase mining

def words_of(text):
    text = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [re.findall(r"[^ \t]+", p) for p in re.split("[.,;:!?\n-\r]", text)]


def mined(rows, least, top=2000, max_words=4):
    """(lang, rank, phrase, a, l, r, n, score) by brute force."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in words_of(text):
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    out = collections.defaultdict(list)
    frequent = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    covered = collections.Counter()
    for (lang, p), a in frequent.items():
        for size in range(2, len(p)):
            for i in range(len(p) - size + 1):
                key = lang, p[i:i + size]
                covered[key] = max(covered[key], a)
    for (lang, p), a in frequent.items():
        if 100 * covered[lang, p] >= 80 * a:
            continue
        score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s)
                  for lang, own in out.items() for i, (s, a, p, x, y) in enumerate(sorted(own)[:top]))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    vocabulary = ["wo%d" % i for i in range(60)] + ["É", "é", "New", "YORK", "　x", "\x1c"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = []
    for i in range(300):
        w = rng.choices(vocabulary, weights, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            w.insert(rng.randint(0, len(w)), rng.choice(["new york City", "a b c d e", "of the", "a a a a a"]))
        rows.append((rng.choice(["en", "fr", None, ""]), rng.choice([" ", "  ", "\t", ". ", " , "]).join(w)))
    rows += [("en", None), (None, ""), ("de", "..."), ("en", "same old story " * 5000), *[("xx", "one two three")] * 40]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, g, "w", 1, i) for i, (g, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, phrase string, n long, words long")
    return rows, df.repartition(5)


@pytest.mark.parametrize("options", [
    {"min_count": 30}, {"min_count": 3, "sample": 0.5}, {"min_count": 12, "sample": 0.02, "seed": 4},
    {"min_count": 5, "max_filter_bits": 1 << 14}])
def test_phrases_match_brute_force(corpus, options):
    """Whatever the sample proposes, and with filters too small for one slice."""
    rows, df = corpus
    got = sorted(map(tuple, phrases.collocations(df, **options).collect()))
    assert got == mined(rows, options["min_count"]) and got


def test_phrase_cases(corpus):
    rows, df = corpus
    top = sorted(map(tuple, phrases.collocations(df, top=3, min_count=5).collect()))
    assert top == mined(rows, 5, top=3)
    assert phrases.collocations(df.limit(0)).count() == 0
    for wrong in ({"max_words": 5}, {"max_filter_bits": 1000}):
        with pytest.raises(ValueError):
            phrases.frequent_phrases(df, **wrong)
    two = {tuple(r) for r in phrases.frequent_phrases(df, max_words=2, min_count=40).select("lang", "phrase").collect()}
    assert ("en", "same old") in two and ("und", "") in two and ("xx", "one two") in two


# --- clustering

def clustered(rows, k=40, rounds=5, dims=64):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    key = {i: hashlib.sha256(("2:" + ("null" if i is None else str(i))).encode()).hexdigest() for i, _ in kept}
    cents = [v for _, v in sorted(kept, key=lambda r: (key[r[0]], r[1]))[:k]]

    def assign():
        c, x = np.array(cents).reshape(-1, dims), np.array([v for _, v in kept]).reshape(-1, dims)
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        return d.argmin(1).tolist(), d.min(1).tolist()

    for _ in range(rounds):
        who, _ = assign()
        for c in set(who):
            own = [v for w, (_, v) in zip(who, kept) if w == c]
            cents[c] = [sum(x) // len(own) for x in zip(*own)]
    who, d = assign()
    return sorted(((i, w, x) for (i, _), w, x in zip(kept, who, d)), key=repr), cents


def test_clusters_match_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(0, 0.3, (12, 64))
    rows = [(i, (base[i % 12] + rng.normal(0, 0.1, 64)).tolist()) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(150)]                     # a third are copies
    rows += [(3, rows[3][1]), (None, rows[7][1]), (600, None), (601, [0.0] * 63), (602, [float("nan")] * 64),
             (603, [None] + [1.0] * 63), (604, [float("inf")] * 64), (605, [0.0] * 64), (606, [])]
    df = spark.createDataFrame([(i, v, i, 0) for i, v in rows],
                               "vec_id long, embedding array<float>, id long, cluster int").repartition(6)
    rows = [(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows]
    assigned, table = centroids.cluster(df)
    want, cents = clustered(rows)
    assert assigned.columns == ["vec_id", "cluster", "distance"]
    assert sorted(map(tuple, assigned.collect()), key=repr) == want
    table = {r.cluster: r for r in table.collect()}
    assert [table[i].components for i in range(len(cents))] == cents
    for c, r in table.items():
        own = [d for _, w, d in want if w == c]
        assert (r.n, r.inertia) == (len(own), sum(own))
    assert centroids.components_sha256([1, -2]) == hashlib.sha256(b"1,-2").hexdigest()
    # fewer vectors than centroids, and none
    few, table = centroids.cluster(df.filter("vec_id < 7"))
    assert {r.distance for r in few.collect()} == {0} and table.count() == 8
    none, table = centroids.cluster(df.limit(0))
    assert none.count() == table.count() == 0
    large = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(large)[0].count()


def test_tree_search_is_exact():
    rng = np.random.default_rng(9)
    for k, dims, spread in ((1, 3, 5), (4, 2, 3), (5, 2, 2), (40, 64, 300), (500, 8, 20), (300, 2, 2), (60, 3, 1 << 27)):
        c = rng.integers(-spread, spread + 1, (k, dims))
        c[k // 2:] = c[:k - k // 2][::-1] if k % 5 == 0 else c[k // 2:]      # equal centroids
        x = np.concatenate([rng.integers(-spread, spread + 1, (500, dims)), c])
        who, d = centroids.search(centroids.build(c), x)
        each = ((x[:, None] - c[None]) ** 2).sum(2)
        assert (d == each.min(1)).all() and (who == each.argmin(1)).all()
