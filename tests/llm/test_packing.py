"""Ids against the tokenizer itself, packing against its rules and a lower bound."""

from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from eventmarts.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_remembered_words_give_the_ids_of_whole_texts(tokenizer):
    rng = random.Random(1)
    parts = ["word", "it's", "we'll", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", "　", "日本", "é", "12",
             "...", "!?", "<|endoftext|>", "\x1c", "\x85", "​", "😀", "'s", "A", "#$%", "﻿"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(1500)]
    letters = "aZÀÖØößøÿé"
    texts += [" ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) + rng.choice([".", ",", "", "?!", "'s"])
                       for _ in range(20)) for _ in range(200)]
    got = P.Encoder(PATH).encode(texts)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_remembered_words_are_bounded(tokenizer, monkeypatch):
    """Workers outlive their stage: two of them, full of words, leave the JVM its room."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("aeiounrstlc", k=rng.randint(6, 12)))
    texts = [" ".join(word() for _ in range(100)) for _ in range(200)]
    encoder = P.Encoder(PATH)
    tracemalloc.start()
    encoder.encode(texts)
    per_word = tracemalloc.get_traced_memory()[0] / 20_000
    tracemalloc.stop()
    assert per_word > 80 and per_word * P.CACHED_WORDS < 170e6
    monkeypatch.setattr(P, "CACHED_WORDS", 1000)
    encoder = P.Encoder(PATH)
    for text in [*texts, " ".join(texts)]:  # one text may hold more words than are remembered
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == \
            tokenizer.encode(text, add_special_tokens=False).ids
        assert len(encoder.known) + len(encoder.known.older) <= 1000


def test_words_after_line_ends(tokenizer):
    words = ["Wort", " Wort", "ÀÖé", " éa", "Wortungetüm" * 5, "x1", "'s", "", " "]
    texts = [start + a + end + w for a in ("\n", "\n\n", " \n", "\n \n") for w in words
             for start in ("", "so") for end in ("", "so.\n")]
    for _ in range(2):  # new words, then remembered ones
        for text, ids in zip(texts, P.Encoder.load(PATH).encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == \
                tokenizer.encode(text, add_special_tokens=False).ids, text


def test_a_word_is_looked_up_once_however_often_it_occurs():
    class Counted(P._Words):
        lookups = 0

        def __getitem__(self, word):
            self.lookups += 1
            return super().__getitem__(word)

    encoder = P.Encoder(PATH)
    encoder.known = Counted(encoder.tokenizer.model.tokenize, encoder._encode)
    encoder.encode(["some words, some more words.\nWords again***\n" * 50] * 20)  # 11,000 words
    assert 0 < encoder.known.lookups <= 12


@pytest.mark.parametrize("limit", [1, 40, 1 << 20])
def test_chunks_of_a_column(tokenizer, monkeypatch, limit):
    """Texts end where they end, whatever lies beside them in the column's bytes."""
    monkeypatch.setattr(P, "CHUNK_BYTES", limit)
    texts = ["left out", "ends\n", "Word", None, "", "\n\n", "it", "'s x1y2", "Straße,Ö×é;7", "\ttab",
             " ", "a<|endoftext|>b endoftext|>", "日本.ab12", "\n \nno  end \n", "\n", "left out"]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(texts, kind).slice(1, len(texts) - 2)
        got = [ids for row, chunk in P.Encoder.load(PATH).chunks(column) for ids in enumerate(chunk, row)]
        assert [row for row, _ in got] == list(range(len(column)))
        for row, ids in got:
            assert np.frombuffer(ids, "<u4").tolist() == \
                tokenizer.encode(column[row].as_py() or "", add_special_tokens=False).ids, row
    assert list(P.Encoder.load(PATH).chunks(pa.array([], pa.string()))) == []


def test_cut():
    ids = lambda n: np.arange(n, dtype="<u4").tobytes()
    sizes = lambda n: [(s, len(b) // 4) for s, b in P.cut(ids(n), 10)]
    assert sizes(1) == [(0, 1)] and sizes(10) == [(0, 10)]
    assert sizes(11) == [(0, 1), (1, 10)] and sizes(30) == [(0, 10), (10, 10), (20, 10)]
    assert b"".join(b for _, b in P.cut(ids(37), 10)) == ids(37)


def test_best_fit_equals_a_plain_search():
    rng = random.Random(2)
    for _ in range(200):
        lengths = np.array(sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 40))), reverse=True))
        rooms: list[int] = []
        for n in lengths:
            fits = [r for r in rooms if r >= n]
            room = min(fits) if fits else 20
            if fits:
                rooms.remove(room)
            rooms.append(room - n)
        bins = P.best_fit(lengths, 20)
        assert sorted(20 - int(lengths[b].sum()) for b in bins) == sorted(rooms)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))


def _check(rows, width):
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0] + [n for _, n in parts])[:-1])
        assert sum(n for _, n in parts) <= width
    return len(by)


@pytest.mark.parametrize("kind", ["mixed", "large", "tiny", "full"])
def test_rounds_of_residual_packing(spark, kind):
    rng = random.Random(kind)
    pick = {"mixed": lambda: rng.randint(1, 100), "large": lambda: rng.choice([60, 60, 60, 35]),
            "tiny": lambda: rng.randint(1, 3), "full": lambda: 100}[kind]
    lengths = [pick() for _ in range(5000)]
    df = spark.createDataFrame(list(enumerate(lengths)), "key long, length long")
    out = P.pack(df, "key", 100, items_per_task=150).join(df, "key").collect()  # 34 partitions, 3 rounds
    assert sorted(r["key"] for r in out) == list(range(len(lengths)))
    n, bound = _check(out, 100), -(-sum(lengths) // 100)
    if kind == "large":
        bound = max(bound, sum(x > 50 for x in lengths))
    # 150 pieces of 1 to 100 in a partition leave some room; far more pieces leave next to none
    assert n <= bound * (1.04 if kind == "mixed" else 1.02) + 3
    assert P.pack(df.limit(0), "key", 100).count() == 0


def test_documents(spark, documents, tokenizer):
    texts = [None, "", "short text", "short text", "word " * 3000, "x" * 5000, "ends here\n" * 200]
    rows = P.pack_documents(documents([(i, t, "s") for i, t in enumerate(texts)]), PATH).collect()
    assert _check(rows, P.WIDTH) == -(-sum(r["length"] for r in rows) // P.WIDTH)
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
        own = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == i)
        assert own == [(k, s, len(b) // 4, zlib.crc32(b)) for k, (s, b) in enumerate(P.cut(ids))]
    assert P.pack_documents(documents([]), PATH).count() == 0
    kept = P.pieces(documents([(1, "one two", "s")]), PATH, keep_ids=True).first()
    assert kept["ids"] == tokenizer.encode("one two", add_special_tokens=False).ids + [2]
