"""URL filters: rules first, then naive Bayes on segmented host and path words.

A rule is ``host + path`` and fits its host and all subdomains, if the url's
path starts with the rule's; the longest rule that fits decides.  Urls that no
rule fits are judged by a multinomial naive Bayes model:

* Words.  Host labels and path segments are split at everything but letters
  and digits, numbers become ``<num>``, and the remaining names, often several
  words run together, are segmented by a unigram Viterbi: the split with the
  highest product of word frequencies.  Frequencies are those of all words in
  the text of all pages (tags removed).  A piece that is not among them has a
  probability that falls with its length.
* Training.  Every url that a rule decides counts as an example of its
  verdict.  The odds of block of every word of ``seeds`` are multiplied by
  ``SEED_ODDS`` on top of what is learned, however many examples there are, so
  that words no rule ever meets can block too.  The words of the rules
  themselves weigh nothing, as the examples were chosen by them, and for the
  same reason both verdicts have the same prior.  Words that no page holds
  are one word, ``<unk>``.

Word counts and the model are tables of any size; nothing of them is gathered
but totals.  The substrings of the distinct names are joined with the counts,
each name is segmented once with the counts of its own substrings, and its
words are joined with the model.  Keys that many rows share ("com", single
letters) are broadcast, all others shuffled.

Cases: a null url, or one without ``://``, has an empty host and path, fits no
rule and has no words, which is a tie; null html has no words; ties
between the verdicts go to allow; repeated rows get equal results; an empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, short_batches, written

MAX_WORD_LENGTH = 24
# odds of block of a seed word, besides those learned; those of 20 blocked examples of a word no rule meets
SEED_ODDS = 21
# a key of more than 1 / HOT of the rows is looked up in a broadcast of at most HOT rows
HOT = 1000
# The rules of the query, as (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
# Words that speak for blocking a site.
SEEDS = ["adult", "bet", "betting", "casino", "cheap", "crack", "download", "escort", "farm", "free", "gambling",
         "keygen", "loan", "lottery", "pills", "poker", "porn", "sex", "spam", "viagra", "warez", "xxx"]

_SPLIT = re.compile(r"[^0-9a-z\x80-\U0010ffff]+")
_NUMBER = re.compile(r"[0-9]+")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    after = F.when(at > 0, F.expr("substring(u, instr(u, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(after, "^[^/?#]*", ""), "^[^?#]*", 0)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def with_rules(pages: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str, url_col: str) -> DataFrame:
    """(id, host, path, rule, rule_verdict)."""
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("u"))
    host, path = host_and_path(F.col("u"))
    parsed = urls.select("id", host.alias("host"), path.alias("path"))
    rule = verdict = None
    for h, p, v in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return parsed.select("id", "host", "path", (none if rule is None else rule).alias("rule"),
                         (none if verdict is None else verdict).alias("rule_verdict"))


def word_counts(pages: DataFrame, html_col: str) -> DataFrame:
    """(word, count) of every word in the text of all pages."""
    text = lower_ascii(F.regexp_replace(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "<[^>]*>", " "))
    words = F.regexp_extract_all(text, F.lit(f"[a-z\\x{{80}}-\\x{{10ffff}}]{{1,{MAX_WORD_LENGTH}}}"), F.lit(0))
    return pages.select(F.explode(words).alias("word")).groupBy("word").count()


def lexicon(pages: DataFrame, html_col: str, seeds: Sequence[str]) -> tuple[DataFrame, int, int]:
    """(word, count) of all words, with the seeds and some labels of hosts; the Viterbi's total; the longest word.

    A seed that no page holds has the mean count, a label 1.
    """
    counts = written(word_counts(pages, html_col), "words")
    sizes = counts.agg(F.count(F.lit(1)).alias("words"), F.sum("count").alias("total"),
                       F.max(F.length("word")).alias("longest")).first()
    words, total = sizes.words, sizes.total or 0
    wanted = [*seeds, "com", "net", "org", "www"]
    there = {r.word for r in counts.filter(F.col("word").isin(wanted)).collect()}
    added: dict[str, int] = {}
    for w in wanted:
        if w not in there and w not in added:
            added[w] = max(1, total // max(words, 1)) if w in seeds else 1
            words, total = words + 1, total + added[w]
    every = counts.unionByName(pages.sparkSession.createDataFrame(list(added.items()), "word string, count long"))
    return every, total + 1, min(MAX_WORD_LENGTH, max([sizes.longest or 1, *map(len, added)]))


class Segmenter:
    """Unigram Viterbi over names without separators.

    ``counts`` need only hold the words that occur in the names, if the
    lexicon's ``total`` and the length of its ``longest`` word are given.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None, longest: int | None = None):
        self.total = sum(counts.values()) + 1 if total is None else total
        self.cost = {w: -math.log(n / self.total) for w, n in counts.items()}
        self.longest = min(MAX_WORD_LENGTH, max(map(len, counts), default=1)) if longest is None else longest

    def _unknown(self, length: int) -> float:
        return math.log(self.total) + length * math.log(10)

    def split(self, name: str) -> tuple[str, ...]:
        """The cheapest split; a run of unknown letters stays one piece."""
        n = len(name)
        best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for begin in range(max(0, end - self.longest), end):
                piece = name[begin:end]
                c = best[begin] + self.cost.get(piece, self._unknown(end - begin))
                if c < best[end]:
                    best[end], back[end] = c, begin
        out, end = [], n
        while end:
            out.append(name[back[end]:end])
            end = back[end]
        return tuple(reversed(out))

    def words(self, name: str) -> list[str]:
        """Words of a name: ``<unk>`` for what is not in the lexicon."""
        return ["<num>"] if name == "<num>" else [w if w in self.cost else "<unk>" for w in self.split(name)]


def names_of(host: str, path: str) -> list[str]:
    """Names of a url in order, ``<num>`` for numbers."""
    return ["<num>" if _NUMBER.fullmatch(part) else part
            for name in _SPLIT.split(f"{host}/{path.lower()}") for part in re.split(r"([0-9]+)", name) if part]


def _looked_up(rows: DataFrame, table: DataFrame, key: str, uses: str) -> DataFrame:
    """``rows`` joined with ``table``, where ``key`` is unique and ``uses`` the number of rows that have it.

    Rows of frequent keys are joined where they are, so no task gets all rows of one key.
    """
    most = (table.agg(F.sum(uses)).first()[0] or 0) / HOT
    hot, rest = table.filter(F.col(uses) > most).drop(uses), table.filter(F.col(uses) <= most).drop(uses)
    return (rows.join(F.broadcast(hot), key)
            .unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key)))


def segmented(names: DataFrame, counts: DataFrame, total: int, longest: int) -> DataFrame:
    """``names`` (nid, name, ...) with the words of each name."""
    def pieces(batches):
        for b in batches:
            nids, out = [], []
            for nid, name in zip(*(c.to_pylist() for c in b.columns)):
                own = {name[i:j] for i in range(len(name)) for j in range(i + 1, min(i + longest, len(name)) + 1)}
                nids += [nid] * len(own)
                out += own
            yield pa.RecordBatch.from_arrays([pa.array(nids, pa.int64()), pa.array(out, pa.string())],
                                             names=["nid", "word"])

    def split(batches):
        for b in batches:
            words = [Segmenter({f["word"]: f["count"] for f in found or ()}, total, longest).words(name)
                     for name, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.list_(pa.string()))],
                                             names=["nid", "words"])

    inside = written(names.filter("name <> '<num>'").select("nid", "name")
                     .mapInArrow(pieces, "nid long, word string"), "name-pieces")
    known = written(inside.groupBy("word").agg(F.count(F.lit(1)).alias("uses")).join(counts, "word"), "known-pieces")
    found = (_looked_up(inside, known, "word", "uses").groupBy("nid")
             .agg(F.collect_list(F.struct("word", "count")).alias("found")))
    words = names.select("nid", "name").join(found, "nid", "left").mapInArrow(split, "nid long, words array<string>")
    return names.join(words, "nid")


def log_odds(block, allow, total, log=math.log):
    """Add-one smoothed log odds of block against allow, of numbers or (by ``F.log``) of columns."""
    return log((block + 1) / total["block"]) - log((allow + 1) / total["allow"])


def _chosen_by(rules: Sequence[tuple[str, str, str]]) -> set[str]:
    return {w for host, path, _ in rules for w in _SPLIT.split(host + path)}


def bayes(counts: dict[tuple[str, str], int], seeds: Sequence[str], rules: Sequence[tuple[str, str, str]]
          ) -> dict[str, float]:
    """Log odds of block against allow of each word, add-one smoothed: ``weighed`` of a few counts at hand."""
    chosen_by = _chosen_by(rules)
    counts = {k: n for k, n in counts.items() if k[1] not in chosen_by}
    vocabulary = {w for _, w in counts} | set(seeds)
    total = {v: sum(n for (x, _), n in counts.items() if x == v) + len(vocabulary) for v in ("block", "allow")}
    return {w: log_odds(counts.get(("block", w), 0), counts.get(("allow", w), 0), total)
            + math.log(SEED_ODDS) * (w in seeds) for w in sorted(vocabulary)}


def weighed(words: DataFrame, seeds: Sequence[str], rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``words`` (word, block, allow, ...: examples of each verdict) with each word's log odds of block against
    allow as ``weight``; 0 for words that neither an example nor the seeds hold."""
    chosen, seed = F.col("word").isin(sorted(_chosen_by(rules))), F.col("word").isin(list(seeds))
    block, allow = (F.when(chosen, 0).otherwise(F.col(v)) for v in ("block", "allow"))
    met = block + allow > 0
    sums = words.agg(F.sum(block).alias("block"), F.sum(allow).alias("allow"),
                     F.count_if(met & ~seed).alias("words")).first()
    vocabulary = sums.words + len(set(seeds))
    total = {v: (sums[v] or 0) + vocabulary for v in ("block", "allow")}
    weight = log_odds(block, allow, total, F.log) + F.when(seed, math.log(SEED_ODDS)).otherwise(0.0)
    return words.withColumn("weight", F.when(met | seed, weight).otherwise(0.0))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
               rules: Sequence[tuple[str, str, str]] = tuple(RULES), seeds: Sequence[str] = tuple(SEEDS)) -> DataFrame:
    """(id, host, path, rule, verdict, words, score): ``score`` is the model's probability of block."""
    counts, total, longest = lexicon(pages, html_col, seeds)
    urls = written(with_rules(pages, rules, id_col, url_col).withColumn("uid", F.monotonically_increasing_id()), "urls")

    def parts_of(batches):
        for b in batches:
            names = [names_of(h, p) for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            at = np.repeat(np.arange(b.num_rows), [len(n) for n in names])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at)), pa.array([i for n in names for i in range(len(n))], pa.int32()),
                 pa.array([x for n in names for x in n], pa.string()), b.column(3).take(pa.array(at))],
                names=["uid", "at", "name", "rule_verdict"])

    parts = written(short_batches(urls.select("uid", "host", "path", "rule_verdict")).mapInArrow(
        parts_of, "uid long, at int, name string, rule_verdict string"), "url-names")
    names = written(parts.groupBy("name").agg(
        F.count(F.lit(1)).alias("uses"), F.count_if(F.col("rule_verdict") == "block").alias("block"),
        F.count_if(F.col("rule_verdict") == "allow").alias("allow"))
        .withColumn("nid", F.monotonically_increasing_id()), "names")
    names = written(segmented(names, counts, total, longest), "segmented-names")
    words = written(names.select(F.explode("words").alias("word"), "block", "allow").groupBy("word").agg(
        F.count(F.lit(1)).alias("names"), F.sum("block").alias("block"), F.sum("allow").alias("allow")), "url-words")
    model = weighed(words, seeds, rules).select("word", "names", "weight")
    tokens = (_looked_up(names.select("nid", F.posexplode("words").alias("place", "word")), model, "word", "names")
              .groupBy("nid").agg(F.array_sort(F.collect_list(F.struct("place", "word", "weight"))).alias("tokens")))
    names = written(names.select("nid", "name", "uses").join(tokens, "nid").drop("nid"), "weighed-names")
    of_url = (_looked_up(parts.select("uid", "at", "name"), names, "name", "uses").groupBy("uid")
              .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "tokens"))),
                                         lambda p: p["tokens"])).alias("tokens")))
    odds = F.coalesce(F.aggregate("tokens", F.lit(0.0), lambda z, t: z + t["weight"]), F.lit(0.0))
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), odds))))
    return urls.join(of_url, "uid", "left").withColumn("score", score).select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"),
        F.coalesce(F.transform("tokens", lambda t: t["word"]), F.array().cast("array<string>")).alias("words"),
        "score")
