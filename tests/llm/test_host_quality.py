"""Measures against a plain count, host verdicts against the formula."""

from __future__ import annotations

import random
import re

from eventmarts.llm import host_quality as Q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen: dict = {}
    for i in range(len(w) - 4):
        seen.setdefault(tuple(w[i:i + 5]), []).append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_measures(documents):
    rng = random.Random(1)
    texts = [None, "", " \n\t ", "one", "a b c d e", "a b c d e a b c d e", "a " * 30, "x\n\nx\n x\nx",
             "é#ü *\x0b$ 😀 |", "a b\xa0c", "\n".join(["same line of five words"] * 7)]
    texts += [" ".join(rng.choices("ab", k=rng.randint(1, 80))) for _ in range(30)]
    texts += [rng.choice([" ", "\n"]).join(rng.choices("abcdefgh", k=3000))]
    out = Q.measure(documents([(i, t, "s") for i, t in enumerate(texts)])).collect()
    for r in out:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
                r["n_repeat_words"]) == brute(texts[r["doc_id"]]), repr(texts[r["doc_id"]])


def test_a_bad_host_goes_and_clean_ones_stay(documents):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, good + str(i), f"h{i % 5}") for i in range(200)]
    rows += [(1000 + i, "### ** $$ && || " * 4 + f"junk{i} " * 1 + " ".join(f"u{k}" for k in range(8)), "bad")
             for i in range(60)]
    rows += [(2000 + i, good, "bad") for i in range(3)] + [(3000, "short", "new"), (3001, good, None)]
    out = {r["doc_id"]: r for r in Q.host_rules(documents(rows)).collect()}
    assert all(out[i]["kept"] for i in range(200)) and out[3001]["kept"]
    assert not any(out[2000 + i]["kept"] for i in range(3)) and not out[2000]["base_failed"]
    assert out[3000]["base_failed"] and not out[3000]["kept"]
    verdicts = {r["host"]: r for r in Q.host_verdicts(Q.measure(documents(rows))).collect()}
    # one failure of one document is shrunk below the host's raw rate
    assert 0 < verdicts["new"]["rate_short"] < 1 and verdicts["bad"]["rate_symbols"] > 0.5


def test_empty_and_repeated(documents):
    assert Q.host_rules(documents([])).count() == 0
    same = [(7, "the same text of rather more than just ten words in all", "s")] * 3
    assert [r["kept"] for r in Q.host_rules(documents(same)).collect()] == [True] * 3
