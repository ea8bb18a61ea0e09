"""Quotation linking (DataFrame functions only).

1. A line's quote level is the number of its leading ``>`` marks.  Runs of lines
   of one level, cut at blank lines, are passages.  A line that announces a quote
   ("... wrote:") right before a deeper line is an attribution, not own text.
2. Passages and single lines are normalised (case, punctuation and white space
   folded) and hashed.  Those of level 0 are originals, deeper ones quotations.
3. A quotation is joined by hash, within its conversation, to the latest earlier
   message that has the passage as its own.
4. A message replies to the latest message quoted at its outermost linked level, or
   to the message before it when it quotes none.  The first reply of a message
   continues its branch; later ones open branches.  ``(branch, turn)`` is the
   reply order: every message comes after the one it replies to.

"The latest earlier one" (steps 3 and 4) is an as-of join over runs of turns: a
partial aggregate keeps the last turn of each run, a window over that small table
carries it forward, and only the rows of one run meet.  So neither a
conversation nor a passage with a third of all rows is one group.  The equi-key
(conversation, turn) spreads a large conversation in all other joins.

Defined results: a null text is empty; a message whose conversation or turn is
null links to nothing and is its own branch.  Rows of the same (conv_id, turn) are
returned each and link alike.  A quotation that no earlier message holds is
counted in ``n_quotes`` only.  An empty table gives an empty table; only the four
named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmarts.llm.common import stored

RUN_TURNS = 1024  # turns per run of the as-of join
_QUOTE = r"^(?:[ \t]*>)+[ \t]?"
_ATTRIBUTION = r"(?i)\b(wrote|writes|said|schrieb|écrit|escribió)[ \t]*:[ \t\r]*$"


def normalise(passage: Column) -> Column:
    """Lower case, letters and digits only, single spaces."""
    return F.trim(F.regexp_replace(F.lower(passage), r"[^\p{L}\p{N}]+", " "))


def parse_lines(text: Column) -> Column:
    """Array of (level, line): the quote level and the line without its marks."""
    def line(x: Column) -> Column:
        marks = F.regexp_extract(x, _QUOTE, 0)
        return F.struct(
            F.length(F.translate(marks, " \t", "")).alias("level"),
            F.when(F.length(marks) > 0, F.regexp_replace(x, _QUOTE, "")).otherwise(x).alias("line"))
    # the two marks used below to cut passages may not occur in the text
    return F.transform(F.split(F.translate(F.coalesce(text, F.lit("")), "\x01\x02", "  "), "\n"), line)


def _passages(lines: Column) -> Column:
    """Array of (level, line) with the lines of each passage joined."""
    def starts(x: Column, i: Column) -> Column:
        before = F.get(lines, i - 1)
        return (i == 0) | (before["level"] != x["level"]) | (F.trim(before["line"]) == "")
    marked = F.array_join(F.transform(lines, lambda x, i: F.concat(
        F.when(starts(x, i), F.concat(F.lit("\x01"), x["level"].cast("string"), F.lit("\x02")))
        .otherwise(F.lit("\n")), x["line"])), "")
    parts = F.filter(F.split(marked, "\x01"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        F.substring_index(p, "\x02", 1).cast("int").alias("level"),
        F.substring_index(p, "\x02", -1).alias("line")))


def parse(messages: DataFrame) -> DataFrame:
    """Messages with ``own_text``, ``quote_depth`` and ``spans`` (level, hash)."""
    lines = F.col("_lines")
    own = F.filter(lines, lambda x, i: (x["level"] == 0) & ~(
        F.coalesce(F.get(lines, i + 1)["level"] > 0, F.lit(False)) & x["line"].rlike(_ATTRIBUTION)))
    own_text = F.btrim(F.regexp_replace(
        F.array_join(F.transform(own, lambda x: x["line"]), "\n"), r"\n{3,}", "\n\n"),
        F.lit(" \t\r\n"))
    spans = F.filter(F.transform(
        F.concat(lines, _passages(lines)),
        lambda x: F.struct(x["level"].alias("level"), normalise(x["line"]).alias("said"))),
        lambda x: x["said"] != "")
    hashed = F.array_distinct(F.transform(spans, lambda x: F.struct(
        x["level"].alias("level"), F.sha2(x["said"], 256).alias("hash"))))
    depth = F.coalesce(F.array_max(F.transform(lines, lambda x: x["level"])), F.lit(0))
    return (messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role",
                            F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("_lines", parse_lines(F.col("text")))
            .withColumn("quote_depth", depth)
            .select("conv_id", "turn", "role", "quote_depth",
                    F.when(F.col("quote_depth") > 0, own_text).otherwise(F.col("text")).alias("own_text"),
                    hashed.alias("spans")))


def latest_before(asked: DataFrame, owners: DataFrame, keys: list[str]) -> DataFrame:
    """``asked`` rows with ``found``: the greatest ``turn`` of ``owners`` below theirs.

    Both have ``keys`` and ``turn``, none null.  Distinct rows are expected.
    """
    run = F.floor(F.col("turn") / RUN_TURNS)
    owners = owners.select(*keys, "turn", run.alias("run"), F.lit(True).alias("_own"))
    asked = asked.select(*keys, "turn", run.alias("run"), F.lit(False).alias("_own"))
    both = owners.unionByName(asked)
    ends = both.groupBy(*keys, "run").agg(F.max(F.when(F.col("_own"), F.col("turn"))).alias("end"))
    over_runs = Window.partitionBy(*keys).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*keys, "run", F.max("end").over(over_runs).alias("_carried"))
    in_run = (Window.partitionBy(*keys, "run").orderBy("turn")
              .rangeBetween(Window.unboundedPreceding, -1))
    seen = both.withColumn("_seen", F.max(F.when(F.col("_own"), F.col("turn"))).over(in_run))
    return (seen.where(~F.col("_own")).join(ends, [*keys, "run"])
            .select(*keys, "turn", F.coalesce("_seen", "_carried").alias("found")))


def links(parsed: DataFrame) -> DataFrame:
    """``conv_id, turn, n_quotes, n_linked, quoted_turn`` of messages with quotations."""
    spans = (parsed.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
             .select("conv_id", "turn", F.explode("spans").alias("s"))
             .select("conv_id", "turn", "s.level", "s.hash"))
    quoted = spans.where(F.col("level") > 0)
    owners = spans.where(F.col("level") == 0).select("conv_id", "hash", "turn").distinct()
    # only passages that somebody quotes can be owned to any use
    wanted = quoted.select("conv_id", "hash").distinct()
    owners = owners.join(wanted, ["conv_id", "hash"], "left_semi")
    asked = quoted.groupBy("conv_id", "hash", "turn").agg(F.min("level").alias("level"))
    found = latest_before(asked, owners, ["conv_id", "hash"])
    both = asked.join(found, ["conv_id", "hash", "turn"])
    outermost = F.min(F.when(F.col("found").isNotNull(), F.col("level")))
    by_level = (both.groupBy("conv_id", "turn", "level")
                .agg(F.count(F.lit(1)).alias("n"), F.count("found").alias("hits"),
                     F.max("found").alias("found")))
    return by_level.groupBy("conv_id", "turn").agg(
        F.sum("n").alias("n_quotes"), F.sum("hits").alias("n_linked"),
        F.min(F.when(F.col("found").isNotNull(), F.struct("level", "found")))["found"]
        .alias("quoted_turn"))


def branches(replies: DataFrame) -> DataFrame:
    """``conv_id, turn, branch`` from distinct ``conv_id, turn, before, reply_to``.

    The first reply of a message continues its branch.  Most messages continue the
    turn right before them; such runs are found by one as-of join on their heads.
    Only heads that continue an earlier message point elsewhere, and doubling
    these pointers until none moves leads each to its branch's first turn.
    """
    first = (replies.where(F.col("reply_to").isNotNull()).groupBy("conv_id", "reply_to")
             .agg(F.min("turn").alias("first")))
    known = replies.join(first, ["conv_id", "reply_to"], "left")
    continues = F.coalesce(F.col("first") == F.col("turn"), F.lit(False))
    inline = continues & (F.col("reply_to") == F.col("before"))
    known = known.select("conv_id", "turn", "reply_to", continues.alias("continues"),
                         F.coalesce(inline, F.lit(False)).alias("inline"))
    heads = known.where(~F.col("inline"))
    inner = known.where("inline").select("conv_id", "turn")
    runs = stored(latest_before(inner, heads.select("conv_id", "turn"), ["conv_id"])
                  .select("conv_id", "turn", F.col("found").alias("head"))
                  .unionByName(heads.select("conv_id", "turn", F.col("turn").alias("head"))),
                  "quote-runs")
    jumps = heads.where("continues").select("conv_id", F.col("turn").alias("head"), "reply_to")
    up = stored(jumps.join(runs.select("conv_id", F.col("turn").alias("reply_to"),
                                       F.col("head").alias("up")), ["conv_id", "reply_to"])
                .select("conv_id", "head", "up"), "quote-up")
    while True:
        further = up.select("conv_id", F.col("head").alias("up"), F.col("up").alias("next"))
        moved = stored(up.join(further, ["conv_id", "up"], "left")
                       .select("conv_id", "head", F.coalesce("next", "up").alias("up"),
                               F.col("next").isNotNull().alias("moved")), "quote-up")
        up = moved.select("conv_id", "head", "up")
        if not moved.where("moved").limit(1).count():
            break
    return (runs.join(up, ["conv_id", "head"], "left")
            .select("conv_id", "turn", F.coalesce("up", "head").alias("branch")))


def conversations(messages: DataFrame) -> DataFrame:
    """Every message without its quotes, with its links and place in reply order.

    ``conv_id, turn, role, own_text, quote_depth, n_quotes, n_linked, quoted_turn,
    reply_to, branch``; order a conversation by ``branch, turn``.
    """
    parsed = stored(parse(messages), "quote-parsed")
    quoting = links(parsed)
    turns = (parsed.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
             .select("conv_id", "turn").distinct())
    before = latest_before(turns, turns, ["conv_id"])
    replies = stored(before.join(quoting, ["conv_id", "turn"], "left")
                     .withColumn("reply_to", F.coalesce("quoted_turn", "found"))
                     .withColumnRenamed("found", "before"),
                     "quote-replies")
    placed = replies.join(branches(replies.select("conv_id", "turn", "before", "reply_to")),
                          ["conv_id", "turn"])
    zero = F.lit(0).cast("long")
    return (parsed.drop("spans").join(placed, ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "role", "own_text", "quote_depth",
                    F.coalesce("n_quotes", zero).alias("n_quotes"),
                    F.coalesce("n_linked", zero).alias("n_linked"),
                    "quoted_turn", "reply_to", F.coalesce("branch", "turn").alias("branch")))
