"""Benchmark decontamination by winnowing.

A document word is *hit* if it lies inside an occurrence of an item window:
``span`` consecutive words of an item, or all its words if it has fewer.
From every window of ``span`` words only the smallest hash of its k-grams is
kept as a fingerprint.  Two equal windows keep the same one, so joining the
fingerprints of documents and items finds every shared span of ``span`` words
or more.  Items of fewer words keep the hash of all their words, and documents
the hashes of all runs of that many words, for each such length that occurs
(at most ``span - 1`` of them).

Joined fingerprints are then extended word by word to both sides, on the words
themselves: only real occurrences count, however the hashes collide.

Native: tokens, hashes and winnowing are array functions in one scan, written
as one row per document; the rest are joins on (hash) and (text hash).
Documents with equal texts share one candidate, so copies are extended once.
The items' distinct hashes are broadcast only up to ``broadcast_rows`` of them,
their fingerprint rows, which carry words, only up to ``broadcast_rows`` rows
and BROADCAST_BYTES; beyond, each is joined by a shuffle.

Cases: null or empty text has no words, is never hit and, as an item, has no
window; items with equal words count separately by their ids; a null item id
counts as the empty string; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, lower_ascii, written

SPAN = 10
K = 5
# hashes of 8 bytes, or fingerprint rows with their words, that may be sent to every executor
BROADCAST_ROWS = 1_000_000
# bytes of fingerprint rows, as Spark holds them, that may be sent to every executor
BROADCAST_BYTES = 64 << 20
# shares the copies of one text are dealt into
SALTS = 16


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))


def _no_hashes() -> Column:
    return F.array().cast("array<bigint>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    An expression used inside a lambda is otherwise computed again for each
    element, as the optimizer inlines the projection that made it.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def gram_hashes(words: Column, k: int) -> Column:
    """Hash of the k words at each position; k seeds it, so grams of one size only are compared."""
    return _let(words, lambda w: F.when(F.size(w) >= k, F.transform(
        F.sequence(F.lit(1), F.size(w) - k + 1),
        lambda i: F.xxhash64(F.slice(w, i, k), F.lit(k)))).otherwise(_no_hashes()))


def winnowed(hashes: Column, window: int) -> Column:
    """The distinct smallest hashes of all runs of ``window`` hashes."""
    return _let(hashes, lambda h: F.when(F.size(h) >= window, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(h) - window + 1),
        lambda i: F.array_min(F.slice(h, i, window))))).otherwise(_no_hashes()))


def _text_hash(text: Column) -> tuple[Column, Column]:
    """The 128 bits of a text's MD5, which stand for it, as columns t1 and t2."""
    digest = F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
    return tuple(F.conv(F.substring(digest, at, 16), 16, -10).cast("long").alias(name)
                 for at, name in ((1, "t1"), (17, "t2")))


def _common_prefix(a: Column, b: Column, most: int) -> Column:
    """Number of equal leading words, up to ``most``."""
    return F.size(F.filter(F.sequence(F.lit(1), F.lit(most)),
                           lambda j: (F.size(a) >= j) & (F.size(b) >= j)
                           & (F.slice(a, F.lit(1), j) == F.slice(b, F.lit(1), j))))


def _before(words: Column, at: Column, most: int) -> Column:
    """Up to ``most`` words before position ``at`` (from 0), nearest first."""
    first = F.greatest(at - most, F.lit(0))
    return F.reverse(F.slice(words, first + 1, at - first))


def item_classes(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(class, words, ids): one row per distinct word sequence of the items."""
    return (items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                         words_of(F.col(text_col)).alias("words"))
            .filter(F.size("words") > 0).groupBy("words").agg(F.collect_set("id").alias("ids"))
            .select(F.md5(F.concat_ws(" ", "words")).alias("class"), "words", "ids"))


def hit_texts(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_id_col: str = "item_id", item_text_col: str = "text", *, span: int = SPAN, k: int = K,
              broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """Two written tables: (id, t1, t2, n_words, prints) of every document row, and (t1, t2, n_hit, item_ids)
    of every text that is hit; t1 and t2 stand for the text."""
    classes = written(item_classes(items, item_id_col, item_text_col), "items")
    short = sorted(r.n for r in classes.select(F.least(F.size("words"), F.lit(span)).alias("n"))
                   .distinct().collect() if r.n < span)                  # at most span - 1 lengths
    window = span - k + 1

    def fingerprints(words: Column) -> Column:
        return winnowed(gram_hashes(words, k), window)

    # per gram size: (hash, class, gram, words that must match, words before and from the gram)
    sizes = sorted({*short, k})
    long_item = F.size("words") >= span
    grams = []
    for size in sizes:
        own = (F.size("words") == size) & ~long_item
        keep = F.when(long_item, fingerprints(F.col("words"))).otherwise(gram_hashes(F.col("words"), size))
        grams.append(classes.filter(own | long_item if size == k else own)
                     .select("class", "words", keep.alias("kept"),
                             F.posexplode(gram_hashes(F.col("words"), size)).alias("at", "hash"))
                     .filter(F.array_contains("kept", F.col("hash")))
                     .select("hash", "class", F.lit(size).alias("gram"),
                             F.least(F.size("words"), F.lit(span)).alias("need"),
                             _before(F.col("words"), F.col("at"), window - 1).alias("item_before"),
                             F.slice("words", F.col("at") + 1, F.lit(span)).alias("item_from"))
                     .dropDuplicates())
    item_grams = grams[0]
    for g in grams[1:]:
        item_grams = item_grams.unionByName(g)
    item_grams = written(item_grams, "item-grams")
    hashes = item_grams.select("hash").distinct()
    n_hashes = hashes.count()
    held = F.size("item_before") + F.size("item_from")
    extent = item_grams.agg(F.count(F.lit(1)).alias("rows"), F.sum(
        128 + 16 * held + F.octet_length(F.concat_ws("", "item_before", "item_from"))).alias("bytes")).first()

    words = F.col("words")
    all_runs = [gram_hashes(words, m) for m in short]
    rows = written(docs.select(F.col(id_col).alias("id"),
                               *_text_hash(F.col(text_col)),
                               words_of(F.col(text_col)).alias("words"))
                   .select("id", "t1", "t2", F.size("words").alias("n_words"),
                           F.array_distinct(F.concat(fingerprints(words), *all_runs)).alias("prints")),
                   "document-prints")
    met = (rows.select("t1", "t2", F.explode("prints").alias("hash"))
           .join(F.broadcast(hashes) if n_hashes <= broadcast_rows else hashes, "hash", "left_semi"))
    found = written(met.groupBy("t1", "t2").agg(F.collect_set("hash").alias("hashes")), "met-prints")

    # salted, as one text may have any number of copies; one of them is kept
    salts = F.array(*[F.lit(i) for i in range(SALTS)])
    texts = (docs.select(F.col(text_col).alias("text"), *_text_hash(F.col(text_col)),
                         F.pmod(F.xxhash64(F.col(id_col)), F.lit(SALTS)).cast("int").alias("salt"))
             .join(found.withColumn("salt", F.explode(salts)), ["t1", "t2", "salt"]).dropDuplicates(["t1", "t2"])
             .select("t1", "t2", "hashes", words_of(F.col("text")).alias("words")))
    places = None
    for size in sizes:
        at = F.filter(F.transform(gram_hashes(words, size),
                                  lambda h, i: F.struct(i.alias("at"), h.alias("hash"))),
                      lambda x: F.array_contains(F.col("hashes"), x["hash"]))
        p = texts.select("t1", "t2", "words", F.explode(at).alias("p")).select(
            "t1", "t2", "p.at", "p.hash", _before(words, F.col("p.at"), window - 1).alias("before"),
            F.slice("words", F.col("p.at") + 1, F.lit(span)).alias("from"))
        places = p if places is None else places.unionByName(p)
    small = extent.rows <= broadcast_rows and (extent.bytes or 0) <= BROADCAST_BYTES
    pairs = places.join(F.broadcast(item_grams) if small else item_grams, "hash")
    right = _common_prefix(F.col("from"), F.col("item_from"), span)
    left = _common_prefix(F.col("before"), F.col("item_before"), window - 1)
    hits = written(pairs.select("t1", "t2", "at", "class", "gram", "need", left.alias("l"), right.alias("r"))
                   .filter("r >= gram and l + r >= need")
                   .select("t1", "t2", "class", (F.col("at") - F.col("l")).alias("lo"),
                           (F.col("at") + F.col("r")).alias("hi")).distinct(), "hits")
    n_hit = (hits.select("t1", "t2", "lo", "hi").distinct()
             .select("t1", "t2", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)).alias("at")).distinct()
             .groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n_hit")))
    ids = (hits.select("t1", "t2", "class").distinct().join(classes.select("class", "ids"), "class")
           .groupBy("t1", "t2")
           .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("item_ids")))
    return rows, written(n_hit.join(ids, ["t1", "t2"]), "hit-texts")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
                  ) -> DataFrame:
    """(id, n_words, n_hit, n_items, item_ids): one row per document row.

    ``item_ids`` are the ids, as sorted strings, of the items with a window in the text.
    """
    rows, hit = hit_texts(docs, items, id_col, text_col, **options)
    return (rows.select("id", "t1", "t2", "n_words").join(hit, ["t1", "t2"], "left")
            .select(F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))


def without_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         **options) -> DataFrame:
    """The rows of ``docs`` whose text no item window occurs in, with all their columns."""
    _, hit = hit_texts(docs, items, id_col, text_col, **options)
    t1, t2 = _text_hash(F.col(text_col))
    hit = hit.select(F.col("t1").alias("__t1"), F.col("t2").alias("__t2"))
    return (docs.select("*", t1.alias("__t1"), t2.alias("__t2")).join(hit, ["__t1", "__t2"], "left_anti")
            .select(*docs.columns))
