"""The corpus pipeline against its operators' brute-force versions, stage by stage."""

import hashlib
import os

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from shelfwise.llm import byte_bpe, toxicity
from shelfwise.session import list_names, staging_dir

from .test_text_operators import VOCABULARY, contamination_oracle, jaccard_oracle, line_oracle

SF, SF_SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


def without_hollow(rows):
    """What line dedup leaves, and the ids of documents that go as they are left with a fifth or less."""
    def filled(t):
        return sum(c not in " \t\n\x0b\x0c\r" for c in t or "")

    whole, out, hollow = dict(rows), [], set()
    for i, t, _, dropped in line_oracle(rows):
        if i is not None and dropped and 5 * filled(t) <= filled(whole[i]):
            hollow.add(i)
        else:
            out.append((i, t))
    return sorted(out, key=repr), hollow


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_stages_match_brute_force(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "ngram_jaccard", "decontamination", "byte_bpe"]

    def step(name, docs):
        out = stages[name](spark, docs, SF)
        path = os.path.join(scratch, name)
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if name != "byte_bpe":
            assert out.columns == columns
        return out

    rows = texts(docs)
    model = toxicity.fit(docs, labels)
    kept = [(i, t) for i, t in rows
            if toxicity.noisy_or([s for _, s in model.sentences((t or "").encode())]) < toxicity.THRESHOLD]
    docs = step("toxicity", docs)
    assert texts(docs) == kept and 0 < len(rows) - len(kept)

    want, hollow = without_hollow(kept)
    docs = step("line_dedup", docs)
    assert texts(docs) == want != kept and hollow
    # copies of one document that reach the next stage are few: most were hollowed by this one
    links = [r for r in jaccard_oracle(kept, 5, 80) if r[2] != r[0]]
    assert len([r for r in links if r[0] in hollow]) > 0.9 * len(links)
    assert all(r.n_chars == len(r.text) for r in docs.collect())

    first = {r[0] for r in jaccard_oracle(want, 5, 80) if r[2] == r[0]}
    unique = [r for r in want if r[0] in first]
    docs = step("ngram_jaccard", docs)
    assert texts(docs) == unique

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {r[0] for r in contamination_oracle(unique, items) if r[2]}
    clean = [r for r in unique if r[0] not in hit]
    docs = step("decontamination", docs)
    assert texts(docs) == clean and hit

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=byte_bpe.load_ranks(VOCABULARY))
    got = {r.doc_id: r for r in step("byte_bpe", docs).collect()}
    assert len(got) == len(clean)
    for i, t in clean:
        ids = enc.encode_ordinary(t)
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert corpus_pipeline.run(spark, SF).count() == len(clean)


def test_odd_rows_pass_through(spark, documents):
    """Null ids and texts, empty and very long texts, repeated rows."""
    rows, _ = documents
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        if name != "byte_bpe":
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            docs = out
    kept = docs.collect()
    assert sum(r.doc_id is None for r in kept) == 2
    by_id = {r.doc_id: r.text for r in kept}
    assert by_id[77] == by_id[78] == "" and by_id[79] == dict(rows)[79]
    assert 76 not in by_id and 86 not in by_id                          # their one line is 60's, 85's
    assert 75 - 60 > sum(60 <= i < 75 for i in by_id if i is not None)
    assert sum(r.doc_id == 85 for r in kept) == 2
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_stages_keep_columns_of_any_name(spark, documents):
    """Columns named like what the operators add, with dots and blanks, of any type; no n_chars."""
    rows, _ = documents
    own = [(i, 42.5, 7, 3, "o", [1, k], (k, "x"), "t%d" % k, -1, t) for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(
        own, "doc_id long, score double, predicted int, n_dropped long, offending string, n_lines array<int>, "
             "doc struct<a: int, `b c`: string>, `a.b c` string, digest int, text string")
    lines = {(i, t) for i, t, *_ in line_oracle(rows)} | {(i, t or "") for i, t in rows}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        docs = out
    got = docs.collect()
    by_key = {r[7]: r for r in own}
    assert 40 < len(got) < len(own)
    for r in got:
        want = by_key[r["a.b c"]]
        assert tuple(r)[:9] == want[:9] and (r.doc_id, r.text or "") in lines
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == len(got)


def test_run_leaves_its_result_alone(spark):
    """Tables of the operators and of earlier stages are deleted."""
    folder = f"{staging_dir(spark)}/llm"
    before = set(list_names(spark, folder))
    out = corpus_pipeline.run(spark, SF_SMALL)
    left = set(list_names(spark, folder)) - before
    assert len(left) == 1 and out.count() > 0 and all(n.startswith("stage-byte_bpe") for n in left)
