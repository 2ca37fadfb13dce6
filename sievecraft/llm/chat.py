"""Chat formatting by quotation linking.  Native.

Each message is parsed into passages: runs of lines of one quote level, the level
being the number of leading ``>`` marks (blanks may stand between them).  Passages
of level 0 are the message's own body.  Passages and their lines are normalised
(A-Z lower-cased, words joined by single blanks) and hashed.  A quoted passage
belongs to the earliest message of the same conversation whose own body holds
that passage, as a whole body, a paragraph or a line, if that message stands
before the quoting one; a passage without such a whole match is looked up by
its lines.  The parent of a message is the latest message that its level-1
passages come from; deeper levels are linked too and counted, but they cite
ancestors.  Following parents gives the root and depth of each message by
pointer jumping, and ``(conv_id, root_turn, turn)`` is the reply order: threads
by their first message, replies after what they answer.

Originals are pre-aggregated to one row per (conversation, hash), so a line that
every message repeats joins once per quote, never message by message, and no
step gathers a conversation in one task.

Defined cases: a null text is an empty body; rows with a null conversation or
turn are kept as roots without links; rows that repeat (conversation, turn)
count as one message in links and are both returned; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sievecraft.llm.common import WORD, lower_ascii, materialise, no_clash, table

#: A line's quote marks, at most three blanks before each.
MARKS = r"^((?:[ \t]{0,3}>)*)"


def normalised(col: Column) -> Column:
    return F.array_join(F.regexp_extract_all(lower_ascii(col), F.lit(f"({WORD})"), F.lit(1)), " ")


def _key(col: Column) -> Column:
    return F.md5(normalised(col))


def parse(messages: DataFrame) -> DataFrame:
    """Adds ``body`` (the text without quotes), ``max_level`` and ``passages`` (array of level and text, quoted only)."""
    text = F.coalesce("text", F.lit(""))
    lines = F.transform(
        F.split(text, r"\r?\n"),
        lambda x: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 1), "[^>]", "")).alias("level"),
            F.regexp_replace(x, MARKS, "").alias("rest"),
            x.alias("whole"),
        ),
    )
    quoted = F.exists("_lines", lambda x: x["level"] > 0)
    own = F.array_join(F.transform(F.filter("_lines", lambda x: x["level"] == 0), lambda x: x["whole"]), "\n")
    # A passage starts where the level changes; its text is the lines up to the next start.
    starts = F.filter(
        F.sequence(F.lit(1), F.size("_lines")),
        lambda i: (F.element_at("_lines", i)["level"] > 0) & ((i == 1) | (F.element_at("_lines", F.greatest(i - 1, F.lit(1)))["level"] != F.element_at("_lines", i)["level"])),
    )
    changes = F.filter(
        F.sequence(F.lit(1), F.size("_lines") + 1),
        lambda i: (i == 1) | (i > F.size("_lines")) | (F.element_at("_lines", F.greatest(i - 1, F.lit(1)))["level"] != F.element_at("_lines", F.least(i, F.size("_lines")))["level"]),
    )
    passages = F.transform(
        starts,
        lambda i: F.struct(
            F.element_at("_lines", i)["level"].alias("level"),
            F.transform(F.slice("_lines", i, F.array_min(F.filter("_changes", lambda c: c > i)) - i), lambda x: F.trim(x["rest"])).alias("lines"),
        ),
    )
    out = messages.withColumn("_lines", lines).withColumn("_quoted", quoted)
    out = out.withColumn("_changes", F.when(F.col("_quoted"), changes))
    return out.select(
        *messages.columns,
        F.when(F.col("_quoted"), F.trim(F.regexp_replace(own, r"^\n+|\n+$", ""))).otherwise(text).alias("body"),
        F.when(F.col("_quoted"), F.array_max(F.transform("_lines", lambda x: x["level"]))).otherwise(F.lit(0)).cast("long").alias("max_level"),
        F.when(F.col("_quoted"), passages).alias("passages"),
    )


def link(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, level, passage, original) of every quoted passage that has an original."""
    quotes = parsed.filter(F.col("passages").isNotNull() & F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    quotes = quotes.select("conv_id", "turn", F.posexplode("passages").alias("passage", "p"))
    whole = quotes.select("conv_id", "turn", "passage", F.col("p.level").alias("level"), F.lit(0).alias("by_line"), _key(F.array_join("p.lines", "\n")).alias("key"))
    by_line = quotes.select("conv_id", "turn", "passage", F.col("p.level").alias("level"), F.lit(1).alias("by_line"), F.explode("p.lines").alias("line"))
    by_line = by_line.withColumn("key", _key(F.col("line"))).drop("line")
    empty = F.md5(F.lit(""))
    wanted = whole.unionByName(by_line).filter(F.col("key") != empty).distinct()
    pieces = F.flatten(F.array(F.array(F.col("body")), F.split("body", r"\n[ \t]*\n"), F.split("body", r"\n")))
    convs = wanted.select("conv_id").distinct()
    originals = parsed.filter(F.col("turn").isNotNull()).join(convs, "conv_id", "left_semi").select("conv_id", "turn", F.explode(F.array_distinct(pieces)).alias("piece"))
    originals = originals.select("conv_id", "turn", _key(F.col("piece")).alias("key")).groupBy("conv_id", "key").agg(F.min("turn").alias("original"))
    found = wanted.join(originals, ["conv_id", "key"]).filter(F.col("original") < F.col("turn"))
    # A whole match beats lines; among lines the latest original.
    best = F.min_by(F.col("original"), F.struct("by_line", -F.col("original"))).alias("original")
    return found.groupBy("conv_id", "turn", "level", "passage").agg(best)


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, root_turn, depth) of messages that answer another one, by pointer jumping."""
    parents = links.filter("level = 1").groupBy("conv_id", "turn").agg(F.max("original").alias("parent_turn"))
    hops = materialise(parents.select("*", F.col("parent_turn").alias("root_turn"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        up = hops.select(F.col("conv_id"), F.col("turn").alias("root_turn"), F.col("root_turn").alias("_root"), F.col("depth").alias("_depth"))
        joined = hops.join(up, ["conv_id", "root_turn"], "left")
        if joined.filter(F.col("_root").isNotNull()).isEmpty():
            return hops
        hops = materialise(joined.select("conv_id", "turn", "parent_turn", F.coalesce("_root", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth")), "threads")


def conversations(messages: DataFrame) -> DataFrame:
    """One row a message, in reply order, without quotes."""
    parsed = materialise(parse(no_clash(messages, "conv_id", "turn", "role", "text")).drop("text"), "chat")
    links = materialise(link(parsed), "links")
    linked = links.groupBy("conv_id", "turn").agg(F.count("*").alias("n_linked"))
    answers = threads(links).join(linked, ["conv_id", "turn"], "full")
    out = parsed.join(answers, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", "body", "max_level",
        F.coalesce(F.size("passages"), F.lit(0)).cast("long").alias("n_passages"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )
    return out.orderBy("conv_id", "root_turn", "turn")


def op1_chat_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations(table(spark, sf_dir, "conversations"))


_MARKS = r"^((?:[ \t]{0,3}>)*)"
_KEY = rf"md5(array_to_string(regexp_extract_all(translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), ' '))"
SQL = rf"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS r, conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
l AS (SELECT r, conv_id, turn, generate_subscripts(parts, 1) AS n, unnest(parts) AS line FROM (SELECT *, string_split_regex(text, '\r?\n') AS parts FROM m) x),
v AS (SELECT *, len(regexp_replace(regexp_extract(line, '{_MARKS}', 1), '[^>]', '', 'g')) AS level, trim(regexp_replace(line, '{_MARKS}', '')) AS rest FROM l),
b AS (SELECT m.r, m.conv_id, m.turn, m.role, max(v.level) AS max_level,
  CASE WHEN max(v.level) = 0 THEN m.text ELSE trim(regexp_replace(coalesce(string_agg(v.line, chr(10) ORDER BY v.n) FILTER (WHERE v.level = 0), ''), '^\n+|\n+$', '', 'g')) END AS body
  FROM m JOIN v ON m.r = v.r GROUP BY m.r, m.conv_id, m.turn, m.role, m.text),
s AS (SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER (PARTITION BY r ORDER BY n) THEN 1 ELSE 0 END AS starts FROM v),
g AS (SELECT *, sum(starts) OVER (PARTITION BY r ORDER BY n) AS passage FROM s),
p AS (SELECT r, conv_id, turn, passage, level, string_agg(rest, chr(10) ORDER BY n) AS whole FROM g WHERE level > 0 GROUP BY r, conv_id, turn, passage, level),
w AS (SELECT conv_id, turn, passage, level, 0 AS by_line, {_KEY % "whole"} AS key FROM p UNION SELECT conv_id, turn, passage, level, 1, {_KEY % "rest"} FROM g WHERE level > 0),
pieces AS (SELECT conv_id, turn, unnest(list_concat(list_concat([body], string_split_regex(body, '\n[ \t]*\n')), string_split_regex(body, '\n'))) AS piece FROM b WHERE conv_id IN (SELECT conv_id FROM p)),
o AS (SELECT conv_id, {_KEY % "piece"} AS key, min(turn) AS original FROM pieces GROUP BY ALL),
f AS (SELECT w.*, o.original FROM w JOIN o ON w.conv_id = o.conv_id AND w.key = o.key WHERE w.key <> md5('') AND o.original < w.turn),
k AS (SELECT conv_id, turn, level, passage, original FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, level, passage ORDER BY by_line, original DESC) AS best FROM f) x WHERE best = 1),
a AS (SELECT conv_id, turn, max(original) AS parent_turn FROM k WHERE level = 1 GROUP BY conv_id, turn),
c AS (SELECT conv_id, turn, parent_turn AS root_turn, CAST(1 AS BIGINT) AS depth FROM a UNION ALL SELECT c.conv_id, c.turn, a.parent_turn, c.depth + 1 FROM c JOIN a ON a.conv_id = c.conv_id AND a.turn = c.root_turn),
t AS (SELECT conv_id, turn, min(root_turn) AS root_turn, max(depth) AS depth FROM c GROUP BY conv_id, turn),
n AS (SELECT conv_id, turn, count(*) AS n_linked FROM k GROUP BY conv_id, turn), q AS (SELECT r, count(*) AS n_passages FROM p GROUP BY r)
SELECT b.conv_id, b.turn, b.role, b.body, CAST(b.max_level AS BIGINT) AS max_level, coalesce(q.n_passages, 0) AS n_passages, coalesce(n.n_linked, 0) AS n_linked, a.parent_turn,
  coalesce(t.root_turn, b.turn) AS root_turn, CAST(coalesce(t.depth, 0) AS BIGINT) AS depth
FROM b LEFT JOIN q ON b.r = q.r LEFT JOIN n ON b.conv_id = n.conv_id AND b.turn = n.turn LEFT JOIN a ON b.conv_id = a.conv_id AND b.turn = a.turn LEFT JOIN t ON b.conv_id = t.conv_id AND b.turn = t.turn
"""

#: The table's messages, every second one with the message before it as a quote; the same text is SQL for both engines.
QUOTED = """SELECT c.conv_id, c.turn, c.role, CASE WHEN p.text IS NULL THEN c.text ELSE concat('> ', replace(p.text, chr(10), concat(chr(10), '> ')), chr(10), c.text) END AS text
FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1 AND c.turn % 2 = 1"""


def chat_quoted_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator on messages that quote, as the given ones hold no quotes."""
    rows = table(spark, sf_dir, "conversations")
    return conversations(spark.sql(QUOTED.replace("conversations", "{conversations}"), conversations=rows))


QUERIES = {"op1_chat_threads": op1_chat_threads, "chat_quoted_threads": chat_quoted_threads}
ORACLES = {"op1_chat_threads": SQL, "chat_quoted_threads": SQL.replace("AS text FROM conversations)", f"AS text FROM ({QUOTED}) z)")}
