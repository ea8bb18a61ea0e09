"""Quality rules judged by host (DataFrame functions only).

1. Every document is measured by expressions over its word array.
2. Each rule fails or passes; a host's failures are counted per rule by one
   partial aggregate, so a host with a third of all rows is one row per task.
3. A rule's failure rates over hosts give an empirical beta prior (method of
   moments on the rates, hosts weighted by their documents).  Each host's rate
   is shrunk to (failures + a) / (documents + a + b).
4. A host whose shrunk rate of any rule exceeds ``max_rate`` is rejected, and
   its verdict is joined back to its documents.  The host table is one row per
   host, so the join side is left to adaptive execution.

Defined results: a null text has no words, no lines and no symbols (it fails
``n_words``); a null host is a host of its own; an empty table gives an empty
table; repeated rows are counted and returned each.  Only the named columns
are read, so extra or clashing columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmarts.llm.common import SPACES, stored

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 50
WINDOW_WORDS = 5
MAX_RATE = 0.5
RULES = ("short", "repeats", "symbols", "dup_lines")


def let(value: Column, body) -> Column:
    """``body(x)`` with ``x`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; null text: none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), "")


def repeat_words(w: Column, size: int = WINDOW_WORDS) -> Column:
    """Words inside ``size``-word windows that occur at least twice in the text.

    Windows are compared by a 64-bit hash.  Only texts with an equal pair sort
    (hash, position); the covered words are then summed along the positions, so
    the work stays n log n for any text.
    """
    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda p, k: F.least(
                F.coalesce(F.get(at, k + 1) - p, F.lit(size)), F.lit(size))),
            F.lit(0).cast("long"), lambda acc, x: acc + x)

    def repeated(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: let(F.array_sort(F.transform(
            F.filter(s, lambda x, k: F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.when(k > 0, F.get(s, k - 1)["h"]) == x["h"], F.lit(False))),
            lambda x: x["i"])), covered))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(
            *[F.get(w, i + k) for k in range(size)]))

    return F.when(F.size(w) < size, F.lit(0).cast("long")).otherwise(let(
        windows(w), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), repeated(h))
        .otherwise(F.lit(0).cast("long"))))


def measure(docs: DataFrame, host_col: str = "source", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    return docs.select(
        F.col(id_col), F.col(host_col).alias("host"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("_l"),
        let(words(F.col("text")), lambda w: F.struct(
            F.size(w).cast("long").alias("n"), repeat_words(w).alias("rep"))).alias("_w"),
    ).select(id_col, "host", F.col("_w.n").alias("n_words"), "word_chars", "n_symbols",
             F.col("_l.dup").alias("n_dup_lines"), F.col("_l.n").alias("n_lines"),
             F.col("_w.rep").alias("n_repeat_words"))


def rule_failures() -> dict[str, Column]:
    """Failure of each rule, over the columns of :func:`measure`."""
    return {
        "short": F.col("n_words") < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"),
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
    }


def host_verdicts(measured: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """``host, n_docs, fail_<rule>, rate_<rule>, host_ok`` (one row per host)."""
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(c.cast("long")).alias(f"fail_{r}") for r, c in rule_failures().items()])
    n = F.col("n_docs")
    # moments of the rates: mean m, variance v over hosts (weights n), and the
    # mean of 1/n, whose binomial share is taken off v
    prior = hosts.agg(
        F.sum(n).alias("docs"), F.count(F.lit(1)).alias("hosts"),
        *[F.sum(F.col(f"fail_{r}")).alias(f"f_{r}") for r in RULES],
        *[F.sum(F.col(f"fail_{r}") * F.col(f"fail_{r}") / n).alias(f"q_{r}") for r in RULES])
    totals = prior.first()  # one row
    docs = F.lit(float(totals["docs"] or 0))
    joined = hosts
    for r in RULES:
        m = F.try_divide(F.lit(float(totals[f"f_{r}"] or 0)), docs)
        between = F.try_divide(F.lit(float(totals[f"q_{r}"] or 0)), docs) - m * m
        noise = F.try_divide(m * (1 - m) * float(totals["hosts"]), docs)
        var = F.greatest(between - noise, m * (1 - m) / 1000)
        strength = F.greatest(F.coalesce(F.try_divide(m * (1 - m), var) - 1, F.lit(0.0)), F.lit(2.0))
        joined = joined.withColumn(
            f"rate_{r}", (F.col(f"fail_{r}") + m * strength) / (n + strength))
    ok = F.lit(True)
    for r in RULES:
        ok = ok & (F.col(f"rate_{r}") <= max_rate)
    return joined.select("host", "n_docs", *[f"fail_{r}" for r in RULES],
                         *[f"rate_{r}" for r in RULES], ok.alias("host_ok"))


def judge(measured: DataFrame, verdicts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents with ``base_failed``, the verdict of their host, and ``kept``."""
    failures = rule_failures()
    hosts = verdicts.select(F.col("host").alias("_host"), "host_ok")
    return (measured.withColumn("base_failed", failures["short"] | failures["repeats"])
            .join(hosts, F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_ok")))


def host_rules(docs: DataFrame, host_col: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """Measures, host verdict and ``kept`` of every document."""
    measured = stored(measure(docs, host_col), "host-quality")  # read twice below
    return judge(measured, host_verdicts(measured, max_rate))
