"""URL filters: a trie over reversed host labels and path segments.

The rules become one trie.  Its edges are the host's labels from the right,
then a path marker, then whole path segments; a rule path that ends inside a
segment is kept at the node before that segment and compared as a prefix.  A
url is judged by one walk that remembers the most specific rule it passes.

Precedence: more host labels, then a longer path; a block entry beats an allow
entry for the very same host and path.

The trie is broadcast only while the rules hold at most ``max_broadcast_chars``
characters (counted first).  Larger rule sets are joined: every url is exploded
into its host suffixes, equi-joined with the rules by host, filtered by path
prefix and reduced to the most specific match.  Both ways give the same rows.

Defined results: a null url, or one without ``://``, has an empty host and path
and matches no rule; so does an empty host.  A url without a path matches only
rules with an empty path.  Null rules are ignored.  Repeated rows are judged
each; an empty table gives an empty table.  Only the named columns are read, so
extra or clashing columns of the input do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
DEFAULT_VERDICT = "allow"
MAX_BROADCAST_CHARS = 64_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, rest = rule.partition("/")
    return host.lower(), slash + rest


class UrlTrie:
    """Longest-match lookup of (host, path)."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root: dict = {}
        for rule, verdict in sorted(rules, key=lambda r: (r[0], r[1] != "block")):
            host, path = split_rule(rule)
            if not host:
                continue
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault("." + label, {})
            *segments, last = path.split("/")
            for segment in segments:
                node = node.setdefault("/" + segment, {})
            node.setdefault("", {}).setdefault(last, (rule, verdict))

    def find(self, host: str, path: str) -> tuple[str, str] | None:
        if not host:
            return None
        best, node, segments = None, self.root, path.split("/")
        for label in reversed(host.split(".")):
            node = node.get("." + label)
            if node is None:
                break
            best = self._path(node, segments) or best
        return best

    @staticmethod
    def _path(node: dict, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for i, segment in enumerate(segments):
            entries = node.get("")
            if entries:
                # longest stored prefix of this segment
                for k in range(len(segment), -1, -1):
                    if segment[:k] in entries:
                        best = entries[segment[:k]]
                        break
            if i == len(segments) - 1:
                break
            node = node.get("/" + segment)
            if node is None:
                break
        return best


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = DEFAULT_VERDICT,
               max_broadcast_chars: int = MAX_BROADCAST_CHARS) -> DataFrame:
    """``id_col, url, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` has string columns ``rule`` (``host/path``) and ``verdict``.
    """
    rules = rules.select("rule", "verdict").dropna().dropDuplicates()
    parsed = pages.select(F.col(id_col), F.col(url_col).alias("url"),
                          url_host(F.col(url_col)).alias("host"),
                          url_path(F.col(url_col)).alias("path"))
    chars = rules.agg(F.sum(F.length("rule"))).first()[0] or 0
    match = _by_trie if chars <= max_broadcast_chars else _by_join
    return match(parsed, rules, id_col).withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def _by_trie(parsed: DataFrame, rules: DataFrame, id_col: str) -> DataFrame:
    trie = parsed.sparkSession.sparkContext.broadcast(UrlTrie(map(tuple, rules.collect())))

    @F.pandas_udf("rule string, verdict string")
    def look_up(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        find = trie.value.find
        hits = [find(h, p) or (None, None) for h, p in zip(host, path)]
        return pd.DataFrame(hits, columns=["rule", "verdict"], dtype=object)

    return (parsed.withColumn("_hit", look_up("host", "path"))
            .select(id_col, "url", "host", "path", "_hit.rule", "_hit.verdict"))


def _by_join(parsed: DataFrame, rules: DataFrame, id_col: str) -> DataFrame:
    slash = F.instr("rule", "/")
    host = F.when(slash > 0, F.substring("rule", F.lit(1), slash - 1)).otherwise(F.col("rule"))
    path = F.when(slash > 0, F.substring("rule", slash, F.length("rule"))).otherwise(F.lit(""))
    keyed = (rules.select("rule", "verdict", F.translate(host, _UPPER, _LOWER).alias("suffix"),
                          path.alias("rule_path")).where(F.col("suffix") != ""))
    names = parsed.select("host", "path").where(F.col("host") != "").distinct()
    labels = F.split("host", r"\.")
    suffixes = names.select("host", "path", F.posexplode(F.transform(
        labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    ).alias("_skip", "suffix"))
    # most specific first: few skipped labels, long path, block before allow
    best = (suffixes.join(keyed, "suffix").where(F.col("path").startswith(F.col("rule_path")))
            .groupBy("host", "path")
            .agg(F.min(F.struct("_skip", (-F.length("rule_path")).alias("_len"),
                                (F.col("verdict") != "block").alias("_soft"),
                                "rule", "verdict")).alias("_hit")))
    return (parsed.join(best, ["host", "path"], "left")
            .select(id_col, "url", "host", "path", "_hit.rule", "_hit.verdict"))
