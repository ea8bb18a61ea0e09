"""Quotation linking against small conversations worked out by hand."""

from __future__ import annotations

from eventmarts.llm import quote_links


def _rows(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, extra string")
    out = quote_links.conversations(df).collect()
    assert len(out) == len(rows)
    return out


def _by_turn(out, conv=1):
    return {r["turn"]: r for r in out if r["conv_id"] == conv}


def test_nested_quotes_link_to_their_originals(spark):
    out = _by_turn(_rows(spark, [
        (1, 0, "user", "How do I sort\nthis list quickly?", "x"),
        (1, 1, "assistant", "Use the built-in sort.", "x"),
        (1, 2, "user", "Bob wrote:\n> use the BUILT-IN sort\n\nAnd in reverse?", "x"),
        (1, 3, "user", "> > Use the built-in sort.\n> And in reverse?\nPass a flag.", "x"),
        (1, 4, "user", "> How do I sort this list quickly?\nAsk again.", "x"),
        (1, 5, "user", "> never said\nNo link.", "x"),
    ]))
    assert out[2]["own_text"] == "And in reverse?"
    assert (out[2]["quoted_turn"], out[2]["reply_to"], out[2]["branch"]) == (1, 1, 0)
    assert (out[3]["quote_depth"], out[3]["n_quotes"], out[3]["n_linked"]) == (2, 2, 2)
    assert (out[3]["quoted_turn"], out[3]["branch"]) == (2, 0)  # outermost level wins
    # turn 0 has its first reply already: a second one opens a branch
    assert (out[4]["quoted_turn"], out[4]["branch"]) == (0, 4)
    assert (out[5]["n_linked"], out[5]["reply_to"], out[5]["branch"]) == (0, 4, 4)


def test_a_late_first_reply_continues_the_branch(spark):
    out = _by_turn(_rows(spark, [
        (1, 0, "u", "alpha", "x"), (1, 1, "u", "beta", "x"),
        (1, 2, "u", "> alpha\ngamma", "x"),  # second reply of 0: branch 2
        (1, 3, "u", "> beta\ndelta", "x"),  # first reply of 1: continues branch 0
        (1, 4, "u", "epsilon", "x"),
        (1, 5, "u", "> gamma\nzeta", "x"),  # first reply of 2: continues branch 2
    ]))
    assert [out[t]["branch"] for t in range(6)] == [0, 0, 2, 0, 0, 2]


def test_latest_owner_across_runs_of_turns(spark):
    n = quote_links.RUN_TURNS
    rows = [(1, 0, "u", "origin", "x"), (1, n + 3, "u", "filler", "x"),
            (1, 2 * n + 1, "u", "> origin\nlate", "x"), (1, 3 * n, "u", "origin", "x"),
            (1, 3 * n + 1, "u", "> origin\nlater", "x")]
    out = _by_turn(_rows(spark, rows))
    assert out[2 * n + 1]["quoted_turn"] == 0
    assert out[3 * n + 1]["quoted_turn"] == 3 * n


def test_nulls_repeats_and_other_conversations(spark):
    out = _rows(spark, [
        (1, 0, "u", "said here", "x"), (1, 0, "u", "said here", "x"), (1, 1, None, None, None),
        (2, 1, "u", "> said here", "x"), (None, 0, "u", "> said here", "x"), (1, None, "u", "lost", "x"),
    ])
    assert sum(r["conv_id"] == 1 and r["turn"] == 0 for r in out) == 2
    nothing = [r for r in out if r["conv_id"] is None or r["turn"] is None]
    assert all(r["reply_to"] is None and r["n_linked"] == 0 for r in nothing)
    assert [r["n_linked"] for r in out if r["conv_id"] == 2] == [0]
    assert _by_turn(out)[1]["own_text"] == ""
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quote_links.conversations(empty).count() == 0


def test_a_long_conversation_needs_no_group(spark):
    rows = [(7, t, "u", "same line" if t % 3 else f"line {t}", "x") for t in range(3000)]
    rows.append((7, 3000, "u", "> line 0\nend", "x"))
    out = _by_turn(_rows(spark, rows), 7)
    assert out[2999]["reply_to"] == 2998 and out[2999]["branch"] == 0
    assert (out[3000]["quoted_turn"], out[3000]["branch"]) == (0, 3000)
