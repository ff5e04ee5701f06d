"""N-gram Jaccard join with a token-group matrix.

Documents whose sets of word n-grams (shingles) have a Jaccard similarity of
``percent`` / 100 or more are linked; the result is each document's component.

1. Tokens are 64-bit shingle hashes.  A sketch counts all of them in hashed
   buckets; (bucket count, hash) is one global order, rare tokens first.
2. A set x linked to y lacks at most ``|x| - ceil(t |x|)`` tokens of y, so the
   first ``|x| - ceil(t |x|) + EXTRA`` tokens in that order, x's *prefix*,
   meet y's prefix, in at least ``_need`` tokens.  Prefixes are all that is
   shuffled for the candidate search; tokens that are in one prefix only go
   next, and the number that is left bounds what a prefix shares with any other.
3. Documents with equal sets are one node.  Similar nodes are put into groups:
   in a few rounds each visits one leader, a holder of enough of its tokens
   (first those with the fewest tokens of their own, the middle of a family of
   near copies), and linked nodes form a group.  A large family becomes one
   group this way by comparisons that grow as its size.
4. Groups are cut into blocks of about ``BLOCK`` nodes of like size, and the token-group
   matrix has a row (token, block) for the union of a block's prefix tokens.
   A node's overlap with a block of another group is bounded by the number of
   its prefix tokens in that union; only where that reaches what a link needs
   is the block opened and the node compared with its members.  Nodes of one
   group are never compared, as they are in one component, and of two groups
   the smaller one's nodes visit the larger one's blocks.

A visit compares whole sets, recomputed from the texts of the nodes that share
tokens.  A task holds one block and streams its visitors, in slices of about
``SLICE``.  The order, and so the sketch, and the rounds decide only how many
visits there are, never the result: no link is lost to hot tokens.

Cases: a text of fewer than ``words`` words has its whole sequence as its one
shingle; one without words has an empty set, is linked with nothing and is its
own component; rows that share an id count as one node; null ids have no
component (null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import few_rows, short_batches, written
from .components import relabel

# buckets of the token sketch: 4 MB as it is broadcast, one byte each
BUCKETS = 1 << 22
SEGMENTS = 64
# prefix tokens beyond those that a link may lack
EXTRA = 3
# rounds of grouping before blocks are opened
ROUNDS = 1
# nodes of a group in a block, and visitors of a block in one slice
BLOCK = 128
SLICE = 512
# node ids or tokens (8 bytes) that may be sent to every executor
BROADCAST_ROWS = 1_000_000

_MULTIPLIERS = (np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text in UTF-8.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` splits at exactly
    0x20 and 0x09-0x0D.
    """
    tokens = text.lower().split() if text else []
    if not tokens:
        return np.zeros(0, np.uint64)
    if len(tokens) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    n = len(h) - words + 1
    x = np.zeros(n, np.uint64)
    for i in range(words):
        x += h[i:i + n] * _MULTIPLIERS[i]
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    x.sort()
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


class Block:
    """Sets of a block's members, compared with a visitor's at once."""

    def __init__(self, members: list[tuple[int, np.ndarray]], percent: int):
        self.ids = np.array([m for m, _ in members], np.int64)
        self.sizes = np.array([len(t) for _, t in members], np.int64)
        tokens = np.concatenate([t for _, t in members])
        order = np.argsort(tokens, kind="stable")
        self.tokens = tokens[order]
        self.owner = np.repeat(np.arange(len(members)), self.sizes)[order]
        self.percent = percent

    def links(self, visitor: int, tokens: np.ndarray) -> np.ndarray:
        """Members whose sets are similar enough to the visitor's."""
        lo, hi = (np.searchsorted(self.tokens, tokens, side) for side in ("left", "right"))
        n = hi - lo
        at = np.repeat(hi - np.cumsum(n), n) + np.arange(n.sum())
        both = np.bincount(self.owner[at], minlength=len(self.ids))
        similar = 100 * both >= self.percent * (self.sizes + len(tokens) - both)
        return self.ids[similar & (both > 0) & (self.ids != visitor)]


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - -(-percent * n // 100) + EXTRA)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in few_rows(batches):
        yield from zip(*(c.to_pylist() for c in b.columns))


def token_ranks(texts: DataFrame, words: int, buckets: int = BUCKETS) -> np.ndarray:
    """A byte per bucket that grows with its number of tokens (8 steps per doubling)."""
    width = buckets // SEGMENTS

    def partial(batches):
        counts = np.zeros(buckets, np.int32)
        for (text,) in _rows(batches):
            np.add.at(counts, shingles(text, words) & np.uint64(buckets - 1), np.int32(1))
        parts = counts.reshape(SEGMENTS, width)
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()),
             pa.array([parts[s].astype(np.min_scalar_type(parts[s].max())).tobytes() for s in used], pa.binary())],
            names=["segment", "counts"])

    def summed(batches):
        total: dict[int, np.ndarray] = {}
        for s, data in _rows(batches):
            part = np.frombuffer(data, f"<u{len(data) // width}")
            total[s] = total[s] + part if s in total else part.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()),
             pa.array([np.minimum(255, 8 * np.log2(np.maximum(v, 1))).astype(np.uint8).tobytes()
                       for v in total.values()], pa.binary())], names=["segment", "ranks"])

    out = np.zeros(buckets, np.uint8)
    for r in (texts.mapInArrow(partial, "segment int, counts binary").repartition(SEGMENTS, "segment")
              .mapInArrow(summed, "segment int, ranks binary").collect()):       # SEGMENTS rows
        out[r.segment * width:(r.segment + 1) * width] = np.frombuffer(r.ranks, np.uint8)
    return out


def _prefixes(docs: DataFrame, ranks: np.ndarray, words: int, percent: int) -> DataFrame:
    """(id, n, digest, prefix): set size, 128-bit digest of the set, prefix tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def prefixes(batches):
        rank = shared.value
        mask = np.uint64(len(rank) - 1)
        for b in few_rows(batches):
            sizes, digests, prefix = [], [], []
            for text in b.column(1).to_pylist():
                t = shingles(text, words)
                sizes.append(len(t))
                digests.append(xxhash.xxh3_128_digest(t.tobytes()))
                m = prefix_length(len(t), percent)
                # t is sorted, so a stable sort by rank orders by (rank, hash)
                prefix.append(t[np.argsort(rank[t & mask], kind="stable")[:m]].view(np.int64))
            offsets = np.cumsum([0, *map(len, prefix)]).astype(np.int32)
            values = np.concatenate(prefix) if prefix else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))],
                names=["id", "n", "digest", "prefix"])

    return docs.mapInArrow(prefixes, "id long, n int, digest binary, prefix array<long>")


def _small(df: DataFrame) -> DataFrame:
    """Hinted for broadcast only if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _shared(index: DataFrame) -> DataFrame:
    """The rows of (token, doc, n) whose token another node holds too.

    One shuffle, streamed in order: no token's holders are ever collected.
    """
    names = ["token", "doc", "n"]

    def held(batches):
        carry, told = None, False                # last row so far, and whether it went out already
        for b in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1)
            if carry is not None:
                rows = np.concatenate([carry, rows])
            new = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
            rows = rows[new]                     # a node's repeated rows are one
            if not len(rows):
                continue
            same = rows[1:, 0] == rows[:-1, 0]
            keep = np.zeros(len(rows), bool)
            keep[1:] |= same
            keep[:-1] |= same
            last = keep[-1]
            if told:
                keep[0] = False
            told = bool(last) or (told and len(rows) == 1)
            carry = rows[-1:]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows[keep].T], names=names)

    return (index.select("token", "doc", F.col("n").cast("long").alias("n")).repartition("token")
            .sortWithinPartitions("token", "doc").mapInArrow(held, "token long, doc long, n long"))


def _links(visits: DataFrame, blocks: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): visitor and member of each visit whose sets are similar enough.

    ``visits``: (block, part, x); ``blocks``: (block, part, member).
    """
    def compare(batches):
        at, members, block = None, [], None
        for b in batches:
            out = []
            for key, part, piece, kind, doc, text in _rows([b]):
                if (key, part, piece) != at:
                    at, members, block = (key, part, piece), [], None
                tokens = shingles(text, words)
                if kind == 0:
                    members.append((doc, tokens))
                else:
                    if block is None:
                        block = Block(members, percent)
                    out += [(doc, m) for m in block.links(doc, tokens).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)],
                                             names=["a", "b"])

    slices = written(visits.groupBy("block", "part").agg(F.count(F.lit(1)).alias("visitors"))
                     .select("block", "part", F.ceil(F.col("visitors") / SLICE).cast("int").alias("slices")), "slices")
    slices = _small(slices)
    every = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    rows = (blocks.join(slices, ["block", "part"])
            .select("block", "part", every.alias("slice"), F.lit(0).alias("kind"), F.col("member").alias("doc"))
            .unionByName(visits.join(slices, ["block", "part"])
                         .select("block", "part", F.pmod(F.xxhash64("x"), F.col("slices")).cast("int").alias("slice"),
                                 F.lit(1).alias("kind"), F.col("x").alias("doc"))))
    return (_small(written(rows, "visits")).join(texts, "doc").repartition("block", "part", "slice")
            .sortWithinPartitions("block", "part", "slice", "kind")
            .select("block", "part", "slice", "kind", "doc", "text").mapInArrow(compare, "a long, b long"))


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5,
                     percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id): one row per document row; component_id is the smallest id reachable."""
    rows = short_batches(docs.select(F.col(id_col).cast("long").alias("id"),
                                     F.col(text_col).cast("string").cast("binary").alias("text")))
    ranks = token_ranks(rows.select("text"), words)
    prefixes = written(_prefixes(rows, ranks, words, percent), "prefixes")
    nodes = written(prefixes.filter("n > 0 and id is not null").groupBy("digest").agg(F.min("id").alias("node")),
                    "nodes")
    members = written(prefixes.select("id", "n", "digest").join(_small(nodes), "digest", "left")
                      .select("id", "n", F.when(F.col("id").isNotNull(), F.col("node")).alias("node")), "members")
    heads = members.filter("id = node").select("id").distinct()
    index = written(_shared(prefixes.filter("n > 0").join(_small(heads), "id", "left_semi")
                            .select(F.col("id").alias("doc"), "n", F.explode("prefix").alias("token"))), "index")
    # met: a node's prefix tokens that are in other prefixes too
    sizes = written(index.groupBy("doc", "n").agg(F.count(F.lit(1)).alias("met"))
                    .filter(f"met >= {_need_between('n', '1', '100 * n', percent)}"), "sizes")
    labels = written(sizes.select(F.col("doc").alias("node")).distinct()
                     .select("node", F.col("node").alias("comp")), "labels")
    texts = written(rows.join(_small(labels.select(F.col("node").alias("id"))), "id", "left_semi")
                    .select(F.col("id").alias("doc"), "text"), "texts")
    for turn in range(ROUNDS):
        led = written(_led(index, sizes, labels, turn, percent), "led")
        visits = written(_leader_visits(led, percent), "leader-visits")
        leaders = visits.select("block", "part", F.col("block").alias("member")).distinct()
        labels = relabel(labels, written(_links(visits, leaders, texts, words, percent), "links"))
        index = led.select("token", "doc", "n")
    held = written(_open(index, sizes, labels), "open-blocks")
    visits = written(_block_visits(held, percent), "block-visits")
    blocks = held.select("block", "part", F.col("doc").alias("member")).distinct()
    labels = relabel(labels, written(_links(visits, blocks, texts, words, percent), "links"))
    return (members.join(_small(labels), "node", "left")
            .select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                    F.coalesce("comp", "node", "id").alias("component_id")))


def _prefix(n: str, percent: int) -> str:
    """SQL of ``prefix_length``."""
    return f"least({n}, {n} - ({percent} * {n} + 99) div 100 + {EXTRA})"


def _common(x: str, y: str, percent: int) -> str:
    """SQL of the least number of tokens that linked sets of sizes x and y share."""
    return f"(({percent} * ({x} + {y}) + {99 + percent}) div {100 + percent})"


def _need(x: str, y: str, percent: int) -> str:
    """SQL of the least number of tokens in both prefixes of linked sets of sizes x and y.

    Of x's tokens at most ``x - common`` are not y's, so at least ``prefix(x) -
    x + common`` of its prefix are; the prefixes share the first of these in
    the order, as many as the smaller of the two numbers.
    """
    return (f"greatest(1, least({_prefix(x, percent)} - {x}, {_prefix(y, percent)} - {y}) "
            f"+ {_common(x, y, percent)})")


def _need_between(x: str, lo: str, hi: str, percent: int) -> str:
    """SQL of the least ``_need`` of x with a size from lo to hi that allows a link; more than x if there is none.

    ``_need`` rises and then falls with the other size, so it is least at an end; 2 less for what rounding
    may do in between.
    """
    first, last = f"greatest({lo}, ({percent} * {x} + 99) div 100)", f"least({hi}, 100 * {x} div {percent})"
    ends = f"least({_need(x, first, percent)}, {_need(x, last, percent)})"
    return f"if({first} > {last}, {x} + 1, {ends} - if({first} < {last}, 2, 0))"


def _fits(x: str, met_x: str, y: str, met_y: str, percent: int) -> str:
    """SQL: sets of these sizes, with so many prefix tokens that others have too, may be linked."""
    return (f"(100 * least({x}, {y}) >= {percent} * greatest({x}, {y}) "
            f"and least({met_x}, {met_y}) >= {_need(x, y, percent)})")


def _grouped(index: DataFrame, sizes: DataFrame, labels: DataFrame) -> DataFrame:
    """(token, doc, n, met, group) of the nodes that may be linked."""
    known = sizes.join(labels.select(F.col("node").alias("doc"), F.col("comp").alias("group")), "doc")
    return index.join(_small(known), ["doc", "n"])


def _led(index: DataFrame, sizes: DataFrame, labels: DataFrame, turn: int, percent: int) -> DataFrame:
    """(token, doc, n, met, group, lead, lead_n, lead_met, lead_group) of the tokens that two groups hold.

    The lead is one holder of the token: in the first turn the one with the
    fewest prefix tokens of its own, then one by a hash.
    """
    held = _grouped(index, sizes, labels)
    own = F.expr(f"{_prefix('n', percent)} - met") if turn == 0 else F.lit(0)
    ends = written(held.groupBy("token").agg(
        F.min("group").alias("lo"), F.max("group").alias("hi"),
        F.min(F.struct(own.alias("own"), F.xxhash64("doc", F.lit(turn)).alias("h"), "doc", "n", "met", "group"))
        .alias("lead"))
        .filter("lo < hi").select("token", "lead.doc", "lead.n", "lead.met", "lead.group")
        .toDF("token", "lead", "lead_n", "lead_met", "lead_group"), "leads")
    return held.join(_small(ends), "token").select("token", "doc", "n", "met", "group", "lead", "lead_n",
                                                   "lead_met", "lead_group")


def _leader_visits(led: DataFrame, percent: int) -> DataFrame:
    """(block, part, x): each node visits the leader it shares most of its tokens with, if enough for a
    link; the leader is the block."""
    shared = (led.filter("group != lead_group").filter(_fits("n", "met", "lead_n", "lead_met", percent))
              .groupBy("doc", "n", "lead", "lead_n").agg(F.count(F.lit(1)).alias("shared"))
              .filter(f"shared >= {_need('n', 'lead_n', percent)}"))
    return (shared.groupBy(F.col("doc").alias("x")).agg(F.max_by("lead", F.struct("shared", "lead")).alias("block"))
            .select("block", F.lit(0).cast("long").alias("part"), "x"))


def _open(index: DataFrame, sizes: DataFrame, labels: DataFrame) -> DataFrame:
    """(token, doc, n, met, block, part, nodes) of the tokens that two groups hold: block is the group, cut
    into parts of about BLOCK nodes whose sizes differ by 3 % at most; nodes is their number in the group."""
    held = _grouped(index, sizes, labels)
    open_ = held.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi")) \
        .filter("lo < hi").select("token")
    held = written(held.join(_small(written(open_, "open-tokens")), "token")
                   .withColumn("class", F.floor(F.log("n") / 0.03)), "open")
    counts = written(held.select("group", "class", "doc").distinct().groupBy("group", "class")
                     .agg(F.count(F.lit(1)).alias("like")), "group-sizes")
    counts = counts.join(counts.groupBy("group").agg(F.sum("like").alias("nodes")), "group")
    parts = F.ceil(F.col("like") / BLOCK)
    return held.join(_small(written(counts, "group-classes")), ["group", "class"]).select(
        "token", "doc", "n", "met", F.col("group").alias("block"),
        (F.col("class") * (1 << 32) + F.pmod(F.xxhash64("doc"), parts)).alias("part"), "nodes")


def _candidates(held: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc, n, other, part): nodes and blocks of larger groups that may share as many tokens as a link
    needs; and (other, part, lo, hi, tokens): each block's sizes and token union, its row of the matrix.

    If a node and a block share ``need`` tokens, the first of them in any one order is among the first
    ``own - need + 1`` tokens of each; tokens in the fewest blocks come first, and only those are looked up.
    """
    blocks = written(held.groupBy(F.col("block").alias("other"), "part").agg(
        F.max("nodes").alias("other_nodes"), F.min("n").alias("lo"), F.max("n").alias("hi"),
        F.max("met").alias("other_met"), F.collect_set("token").alias("tokens")), "blocks")
    matrix = blocks.select("other", "part", "other_nodes", "lo", "hi", "other_met",
                           F.explode("tokens").alias("token"))
    spread = written(matrix.groupBy("token").agg(F.count(F.lit(1)).alias("blocks"),
                                                 F.max(F.struct("other_nodes", "other")).alias("top")), "spread")
    node, whole = Window.partitionBy("doc", "n"), Window.partitionBy("other", "part")
    matrix = (matrix.join(_small(spread.select("token", "blocks")), "token")
              .withColumn("other_place", F.row_number().over(whole.orderBy("blocks", "token")))
              .withColumn("other_own", F.count(F.lit(1)).over(whole)).drop("blocks"))
    probes = (held.select("token", "doc", "n", "met", "block", "nodes").join(_small(spread), "token")
              .withColumn("place", F.row_number().over(node.orderBy("blocks", "token")))
              .withColumn("own", F.count(F.lit(1)).over(node))
              .filter("block != top.other").drop("top", "blocks"))
    need = _need_between("n", "lo", "hi", percent)
    met = probes.join(matrix, "token").filter(
        f"struct(nodes, block) < struct(other_nodes, other) and least(met, other_met) >= {need} "
        f"and place <= own - {need} + 1 and other_place <= other_own - {need} + 1")
    return met.select("doc", "n", "other", "part").distinct(), blocks.select("other", "part", "lo", "hi", "tokens")


def _block_visits(held: DataFrame, percent: int) -> DataFrame:
    """(block, part, x): nodes and the blocks of larger groups that their matrix bound lets qualify."""
    candidates, blocks = _candidates(held, percent)
    own = held.groupBy("doc", "n").agg(F.collect_set("token").alias("own"))
    return (candidates.join(own, ["doc", "n"]).join(blocks, ["other", "part"])
            .filter(F.size(F.array_intersect("own", "tokens")) >= F.expr(_need_between("n", "lo", "hi", percent)))
            .select(F.col("other").alias("block"), "part", F.col("doc").alias("x")).distinct())
