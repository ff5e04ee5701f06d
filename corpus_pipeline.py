"""Corpus pipeline: toxicity, line dedup, near duplicates, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet to the shared folder and hands it, read back,
to the next one.  All stages but the last return the columns of documents.

Rows with null ids or null texts pass through the filters like others (a null
text has no toxic sentence, no lines to drop, no shingles and no benchmark
words); repeated rows stay repeated, except that near duplicates keep the rows
of one document id per group.  Columns besides doc_id and text are carried as
they are, whatever their names; n_chars, if there, follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import byte_bpe, decontaminate, line_dedup, ngram_join, toxicity
from shelfwise.llm.common import read_table, scratch_tables, write_table
from shelfwise.llm.queries import VOCABULARY
from shelfwise.session import release

# Not SQL: the first stage is a trained model and the last a tokenizer.
ORACLE_SQL = None

# A document that loses this share of its characters (blanks aside) to earlier documents' lines is a copy of them.
HOLLOW_PERCENT = 80


def _carried(docs: DataFrame) -> DataFrame:
    """doc_id, text and all other columns as one, so that no stage meets their names or makes one of them."""
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("none"), *others).alias("__rest"))


def _restored(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, from what a stage left of ``_carried(docs)``."""
    return out.select([F.col(c) if c in ("doc_id", "text") else F.col(f"__rest.c{i}").alias(c)
                       for i, c in enumerate(docs.columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the multiple-instance model scores below its threshold.

    The model learns from the labels of documents still there.
    """
    model = toxicity.fit(docs.select("doc_id", "text"), read_table(spark, sf_dir, "labels"))
    return _restored(toxicity.score(_carried(docs), model).filter("predicted = 0"), docs)


def _filled(text: Column) -> Column:
    return F.length(F.translate(F.coalesce(text, F.lit("")), " \t\n\x0b\x0c\r", ""))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document (by doc_id) holds.

    One that is left with a fifth of its characters or less (blanks aside) was
    a copy of earlier ones, of which the next stage could no longer tell: it
    goes as a whole.  A document that loses no line stays, also if it is blank.
    """
    drops = line_dedup.repeated_lines(docs.select("doc_id", "text"))
    carried = _carried(docs).withColumn("__filled", _filled(F.col("text")))
    left = line_dedup.without_lines(carried, drops)
    hollow = (F.col("n_dropped") > 0) & (100 * _filled(F.col("text")) <= (100 - HOLLOW_PERCENT) * F.col("__filled"))
    out = _restored(left.filter(~hollow), docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of similar ones (five words, 0.8)."""
    groups = ngram_join.ngram_components(docs.select("doc_id", "text"), words=5, percent=80)
    others = groups.filter("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    clean = decontaminate.without_contaminated(_carried(docs), read_table(spark, sf_dir, "benchmark"))
    return _restored(clean, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the text, and digests of the ids and of the text decoded from them."""
    return byte_bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.

    A stage's result is all that stays of it: what its operators wrote goes
    once it is written, and the stage before with it.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch_tables(spark):
            out = stage(spark, docs, sf_dir)
            path = write_table(out, f"stage-{name}", keep=True)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            release(spark, before)
        before = path
    return docs
