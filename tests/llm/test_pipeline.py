"""The five stages in a row, each against a plain computation of its own decision."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pytest
from eventmarts.llm import mixing, packing, rff_quality, secret_scan
from eventmarts.llm.common import stored
from pyspark.sql import functions as F

from tests.llm.test_ngram_join import brute

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage, written and read as the pipeline does."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, SF), name)
        out.append((name, docs, result))
        docs = result
    return out


def test_stages_keep_the_columns(stages):
    assert [n for n, *_ in stages] == ["quality_classifier", "ngram_jaccard_join", "secret_scan",
                                       "source_mixing", "best_fit_packing"]
    assert all(out.columns == COLUMNS for _, _, out in stages[:-1])


def test_rejected_documents_go(spark, stages):
    _, docs, out = stages[0]
    scored = rff_quality.score_documents(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in scored.where("predicted = 1").collect()}
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(good)
    assert 0 < len(good) < docs.count()


def test_one_document_of_each_class_stays(stages):
    _, docs, out = stages[1]
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    want = sorted({c for c, _ in brute(rows).values()})
    assert sorted(r.doc_id for r in out.collect()) == want and len(want) < len(rows)


def test_spans_are_masked_and_nothing_else(stages):
    _, docs, out = stages[2]
    before, after = ({r.doc_id: r for r in df.collect()} for df in (docs, out))
    assert before.keys() == after.keys()
    for i, r in before.items():
        spans = secret_scan.find_spans(r.text)
        assert after[i].text == (secret_scan.mask(r.text, spans) if spans else r.text)
        assert after[i].n_chars == (len(after[i].text) if spans else r.n_chars)


def test_the_mix_takes_its_targets(stages):
    _, docs, out = stages[3]
    words = lambda df: {r.source: r.n for r in df.groupBy("source").agg(
        F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    sizes = words(docs)
    plan = mixing.make_plan(list(sizes.items()))
    assert words(out) == {s: p.quota for s, p in plan.items() if p.quota}
    texts = {r.doc_id: r.text for r in docs.collect()}
    per_doc: dict = {}
    for r in out.collect():
        assert r.text in texts[r.doc_id]
        per_doc[r.doc_id] = per_doc.get(r.doc_id, 0) + len(mixing._WORD.findall(r.text))
    assert all(n <= 2 * len(mixing._WORD.findall(texts[i])) for i, n in per_doc.items())


def test_sequences_hold_the_mixed_ids(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    _, docs, out = stages[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.collect())
    rows = out.collect()
    assert sum(r.length for r in rows) == tokens
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1])
        assert sum(n for _, n in parts) <= packing.WIDTH
    assert len(by) <= 1.02 * tokens / packing.WIDTH + 2


def test_run_gives_the_last_stage(spark, stages):
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).select(*cols).collect())
    assert got == sorted(tuple(r) for r in stages[4][2].select(*cols).collect())
