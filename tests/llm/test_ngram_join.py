"""Links and classes against brute force, on small tables with planted copies."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from eventmarts.llm import ngram_join as J
from eventmarts.llm.words import chunks


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    """(id -> (class, links)) for distinct ids."""
    sets = [(i, shingles(t)) for i, t, _ in rows]
    near = {i: {j for j, b in sets if j != i and a and b and 5 * len(a & b) >= 4 * len(a | b)} for i, a in sets}
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (min(seen), len(near[i]))
    return out


def _text(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def _planted(seed=1):
    rng = random.Random(seed)
    passage = _text(rng, 40)
    rows = [(i, passage + " " + _text(rng, 60) if i % 3 == 0 else _text(rng, rng.choice([1, 3, 5, 30, 200])), "s")
            for i in range(120)]
    base = _text(rng, 150)
    for k in range(80):  # near copies of one text, and of near copies
        words = base.split()
        for _ in range(rng.choice([1, 1, 2, 4])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
        rows.append((1000 + k, " ".join(words), "s"))
        if k % 9 == 0:
            base = " ".join(words)
    rows += [(2000 + k, rows[5][1].replace(" ", "  \n"), "s") for k in range(30)]
    return rows + [(3000, None, "s"), (3001, "", "s"), (3002, " \n", "s"), (3003, "one two", "s"), (3004, "one two", "s")]


def test_stop_depth_reaches_the_recall():
    for recall in (0.9, 0.99, 0.999):
        k = J.stop_depth(recall)
        assert 1 - (1 - 0.8 ** k) ** J.TREES >= recall
        assert k == J.DEPTH or 1 - (1 - 0.8 ** (k + 1)) ** J.TREES < recall


@pytest.mark.parametrize("small", [False, True])
def test_join_equals_brute_force(documents, monkeypatch, small):
    if small:  # every node and group in many tiles
        monkeypatch.setattr(J, "NODE_TEXTS", 8)
        monkeypatch.setattr(J, "TILE_SHINGLES", 800)
    rows = _planted()
    out = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in J.jaccard_join(documents(rows)).collect()}
    assert out == brute(rows)


def test_repeated_rows_null_ids_and_empty_tables(documents):
    text, other = "a b c d e f g h", "q r s t u v w x y"
    rows = [(5, text, "s"), (5, text, "s"), (5, other, "s"), (9, other, "s"), (None, text, "s"), (None, "lone text", "s")]
    out = sorted((r["doc_id"] or 0, r["class_id"] or 0, r["n_links"]) for r in J.jaccard_join(documents(rows)).collect())
    assert out == [(0, 0, 0), (0, 5, 2), (5, 5, 1), (5, 5, 2), (5, 5, 2), (9, 5, 1)]
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in J.keep_one(documents(rows)).collect())
    assert kept == sorted([(0, text), (0, "lone text"), (5, text), (5, other)])
    assert J.jaccard_join(documents([])).count() == 0 and J.keep_one(documents([])).count() == 0


def test_one_row_of_each_class_stays(documents):
    rows = _planted(2)
    classes = brute(rows)
    kept = J.keep_one(documents(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for c, _ in classes.values()})
    assert kept.columns == documents(rows).columns


def test_similar_sets_equal_brute_force():
    rng = np.random.default_rng(1)
    for m in (2, 5, 9, 40):
        core = rng.choice(2000, 60, replace=False)
        sets = [np.unique(np.concatenate([rng.choice(core, 55, replace=False), rng.choice(5000, 4)])).astype(np.uint64)
                for _ in range(m)]
        want = [[j for j, b in enumerate(sets)
                 if j != i and 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b))]
                for i, a in enumerate(sets)]
        assert [near.tolist() for _, near in J.similar(sets)] == want


def test_words_of_arrow_strings():
    texts = ["a b  c d e f a b c d e", "", None, " x\ty\n", "é ü \x0b z w q r s", "a b c d e", "x" * 10, "a\xa0b"]
    column = pa.array(["cut off", *texts]).slice(1)
    seen = 0
    for most in (1, 8, 1 << 20):
        for row, part in chunks(column, most):
            hashes, first = part.shingles()
            for i in range(len(part)):
                words = [bytes(part.data[s:e]).decode() for s, e in
                         zip(part.start[part.first[i]:part.first[i + 1]], part.end[part.first[i]:part.first[i + 1]])]
                text = texts[row + i] or ""
                assert words == [w for w in text.replace("\xa0", "~").split() for w in [w.replace("~", "\xa0")]]
                assert len(set(hashes[first[i]:first[i + 1]])) == len(shingles(text.replace("\xa0", "~")))
                seen += 1
    assert seen == 3 * len(texts)


def test_a_very_long_text_hashes_like_its_parts(monkeypatch):
    rng = random.Random(9)
    text = " ".join("".join(rng.choices("abcé", k=rng.randint(1, 12))) for _ in range(60_000)) + " " + "y" * 5000
    (_, whole), = chunks(pa.array([text]))
    monkeypatch.setattr("eventmarts.llm.words.CHUNK_BYTES", 1000)
    (_, parts), = chunks(pa.array([text]))
    assert (whole.hash == parts.hash).all() and len(whole.hash) == 60_001
    assert len(np.unique(whole.hash)) == len(set(text.split()))
