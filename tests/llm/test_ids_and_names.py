"""Large ids beside null ones, nullable whole-number columns and clashing names, wherever rows
pass through Python."""

from __future__ import annotations

from eventmarts.llm import exact_dedup, html_extract, mixing, ngram_join, secret_scan
from pyspark.sql import functions as F

BIG = (1 << 60) + 1
CLASH = ["row", "__row", "__rows", "__size", "__shard", "__place", "doc", "id", "size", "shard", "first",
         "words", "place", "rows", "k", "segments", "start"]


def _docs(spark):
    rows = [(BIG, "alpha beta password=abcdef123 gamma", "s", 30, BIG + 2), (None, "one two three four five six", "s", None, None),
            (BIG + 4, None, "t", None, BIG), (None, "", None, 0, None), (7, "token: zzzzzzzz9 " * 40, "t", 640, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, extra long").withColumn("lang", F.lit("en"))
    for i, c in enumerate(CLASH):
        df = df.withColumn(c, F.when(F.col("doc_id").isNotNull(), F.lit(BIG + i)))
    return df.coalesce(1)


def _ids(df, column="doc_id"):
    return sorted((r[column] for r in df.collect()), key=lambda x: (x is None, x or 0))


WANT = [7, BIG, BIG + 4, None, None]


def test_scan_mix_extract_and_dedup_keep_ids(spark):
    docs = _docs(spark)
    assert _ids(secret_scan.scan(docs)) == WANT
    assert _ids(mixing.mix(docs)) == WANT
    assert _ids(exact_dedup.dedup(docs)) == WANT
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    assert _ids(html_extract.extract(pages), "page_id") == WANT


def _untouched(before, after):
    """Rows keep every column but the text and its length."""
    same = [c for c in before.columns if c not in ("text", "n_chars")]
    assert after.columns == before.columns and after.schema == before.schema
    had = {str([r[c] for c in same]) for r in before.collect()}
    assert {str([r[c] for c in same]) for r in after.collect()} <= had


def test_redact_keeps_columns(spark):
    docs = _docs(spark)
    out = secret_scan.redact(docs)
    _untouched(docs, out)
    got = {r["doc_id"]: r for r in out.where("doc_id is not null").collect()}
    assert _ids(out) == WANT and got[BIG]["n_chars"] == len(got[BIG]["text"]) and "abcdef123" not in got[BIG]["text"]
    assert got[BIG + 4]["n_chars"] is None and got[BIG + 4]["text"] is None


def test_mixed_documents_keep_columns(spark):
    docs = _docs(spark)
    out = mixing.mixed_documents(docs)
    _untouched(docs, out)
    taken = {r["doc_id"]: r["n"] for r in mixing.mix(docs).where("doc_id is not null").select(
        "doc_id", mixing.words_taken(F.col("segments")).alias("n")).collect()}
    words = {r["doc_id"]: r["n"] for r in out.where("doc_id is not null").groupBy("doc_id").agg(
        F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert words == {i: n for i, n in taken.items() if n}


def test_keep_one_keeps_columns(spark):
    docs = _docs(spark)
    twice = docs.unionByName(docs.where("doc_id = 7").withColumn("doc_id", F.lit(9).cast("long")))
    out = ngram_join.keep_one(twice)
    _untouched(twice, out)
    assert _ids(out) == WANT
