"""License scans: exact set-similarity join of text blocks with license templates.  Native.

A text is cut into blocks: each line, and each paragraph (lines between blank
lines).  A template is a set of words; a block holds it when it has at least
``threshold`` of those words.  The join is exact and runs in four steps:

1. one scan reduces each block to its words that occur in any template (only
   those can count), and takes the fixed phrases on the way;
2. the words' document frequencies over the whole corpus give the global order;
3. blocks are joined with the *prefixes* of the templates (their
   ``size - need + 1`` rarest words: a block without any of them can't reach
   ``need``) under the length filter (``n_block >= need``) and the positional
   filter (what stands before and after the shared word bounds the overlap);
4. surviving pairs are verified by counting the intersection.

The templates are constants of this module, so everything derived from them
(vocabulary, prefixes, ranks) has a fixed size and may be broadcast; documents
are only shuffled as one thin row each.

Defined cases: a null or empty text has no words, no labels and score 0;
repeated rows are answered one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sievecraft.llm.common import WORD, lower_ascii, materialise, no_clash, table

#: Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Label, block kind, wording of well-known license notices.
TEMPLATES = [
    ("mit", "line", "released under the mit license"),
    ("mit", "line", "licensed under the terms of the mit license"),
    ("apache-2", "line", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "line", "licensed under cc by nc 4 0"),
    ("cc-by", "line", "licensed under a creative commons attribution 4 0 international license"),
    ("gpl-3", "line", "this work is licensed under the gnu general public license version 3"),
    ("mpl-2", "line", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    (
        "mit-text", "paragraph",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    ),
    (
        "apache-2-text", "paragraph",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied see the license for the "
        "specific language governing permissions and limitations under the license",
    ),
    (
        "bsd-text", "paragraph",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer",
    ),
    (
        "gpl-text", "paragraph",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version of the license or at your option any later version",
    ),
    (
        "unlicense-text", "paragraph",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use "
        "compile sell or distribute this software either in source code form or as a compiled binary for any purpose",
    ),
]

THRESHOLD = 0.8


def _sets(templates: list[tuple[str, str, str]]) -> list[tuple[int, str, str, list[str]]]:
    return [(i, label, kind, sorted(set(text.split()))) for i, (label, kind, text) in enumerate(templates)]


def _need(n: int, threshold: float) -> int:
    """The least overlap that reaches the threshold."""
    return next(k for k in range(n + 1) if k >= threshold * n - 1e-9)


def _template_rows(spark: SparkSession, templates, threshold: float) -> DataFrame:
    rows = ", ".join(
        f"({i}, '{label}', '{kind}', {len(words)}, {_need(len(words), threshold)}, '{w}')"
        for i, label, kind, words in _sets(templates)
        for w in words
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(tid, label, kind, size, need, token)")


def _phrase_columns(norm: Column) -> dict[str, Column]:
    """Places of the phrases in ``norm``, the words joined and enclosed by single blanks."""
    place = rf"(?<= )(?:{'|'.join(PHRASES)})(?= )"
    blanks = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    n = F.regexp_count(norm, F.lit(place)).cast("long")
    first = blanks(F.substring(norm, F.lit(1), F.regexp_instr(norm, F.lit(place)) - 1)) - 1
    last = blanks(F.regexp_extract(norm, f"(?s)^(.*){place}", 1)) - 1
    labels = F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(F.contains(norm, F.lit(f" {p} ")), F.lit(x)) for p, x in PHRASES.items()]), lambda x: x.isNotNull())))
    return {
        "n_base": n,
        "first_word": F.when(n > 0, first.cast("long")),
        "last_word": F.when(n > 0, last.cast("long")),
        "base": labels,
    }


def _reduced(docs: DataFrame, templates, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """One thin row per document: phrase columns, template words, and the blocks that may hold a template."""
    sets = _sets(templates)
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for *_, ws in sets for w in ws})])
    least = {kind: min((_need(len(ws), threshold) for *_, k, ws in sets if k == kind), default=1 << 30) for kind in ("line", "paragraph")}
    separator = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

    def blocks(kind: str, cut: str) -> Column:
        held = F.transform(F.split("lower", cut), lambda b: F.array_intersect(F.split(b, separator), F.col("tokens")))
        return F.transform(F.filter(held, lambda t: F.size(t) >= least[kind]), lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("tokens")))

    out = no_clash(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("doc_id"), lower_ascii(F.col(f"`{text_col}`")).alias("lower"))
    out = out.withColumn("words", F.regexp_extract_all("lower", F.lit(f"({WORD})"), F.lit(1)))
    out = out.withColumn("tokens", F.array_intersect("words", vocabulary)).withColumn("norm", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    return out.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"), "tokens",
        *[c.alias(k) for k, c in _phrase_columns(F.col("norm")).items()],
        F.when(F.size("tokens") >= min(least.values()), F.concat(blocks("line", r"\n"), blocks("paragraph", r"\n[ \t\r]*\n"))).otherwise(F.expr("array()")).alias("blocks"),
    )


def matches(thin: DataFrame, templates, threshold: float) -> DataFrame:
    """(row, block, label, containment) of every block that holds a template."""
    spark = thin.sparkSession
    rows = _template_rows(spark, templates, threshold)
    frequency = thin.select(F.explode("tokens").alias("token")).groupBy("token").count()
    ranked = (
        rows.select("token").distinct().join(frequency, "token", "left")
        .select("token", F.row_number().over(W.orderBy(F.coalesce("count", F.lit(0)), "token")).alias("rank"))
    )
    lookup = ranked.agg(F.map_from_entries(F.collect_list(F.struct("token", "rank")))).scalar()
    whole = rows.join(ranked, "token").groupBy("tid", "label", "kind", "size", "need").agg(F.array_sort(F.collect_list("rank")).alias("ranks"))
    prefix = whole.select("tid", "label", "kind", "size", "need", "ranks", F.posexplode(F.slice("ranks", F.lit(1), F.col("size") - F.col("need") + 1)).alias("i", "rank"))
    blocks = thin.select("row", F.posexplode("blocks").alias("block", "b"), lookup.alias("lookup")).select(
        "row", "block", F.col("b.kind").alias("kind"), F.array_sort(F.transform("b.tokens", lambda t: F.element_at("lookup", t))).alias("held")
    )
    words = blocks.select("*", F.size("held").alias("n"), F.posexplode("held").alias("j", "rank"))
    before, after = F.least(F.col("i"), F.col("j")) + 1, F.least(F.col("size") - F.col("i"), F.col("n") - F.col("j")) - 1
    # F.broadcast: the prefixes are made of the constant templates alone, a few hundred rows.
    pairs = words.join(F.broadcast(prefix), ["kind", "rank"]).filter((F.col("n") >= F.col("need")) & (before + after >= F.col("need")))
    shared = F.size(F.array_intersect("held", "ranks"))
    return pairs.filter(shared >= F.col("need")).select("row", "block", "tid", "label", (shared / F.col("size")).alias("containment")).distinct()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: phrase places, labels of phrases and templates, and the best containment."""
    templates = templates or TEMPLATES
    thin = materialise(_reduced(docs, templates, threshold, id_col, text_col), "licenses")
    found = matches(thin, templates, threshold).groupBy("row").agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    joined = thin.select("row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base").join(found, "row", "left")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("found", F.expr("array()")))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same rows by brute force: every block against every template."""
    place = "|".join(PHRASES)
    words = ", ".join(f"({i}, '{label}', '{kind}', {ws!r}, {_need(len(ws), THRESHOLD)})" for i, label, kind, ws in _sets(TEMPLATES))
    labels = "list_concat(" * (len(PHRASES) - 1) + ", ".join(
        (f"CASE WHEN contains(norm, ' {p} ') THEN ['{x}'] ELSE [] END" + (")" if k else "")) for k, (p, x) in enumerate(PHRASES.items())
    )
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, {lower} AS low FROM documents),
w AS (SELECT row_no, doc_id, low, regexp_extract_all(low, '{pattern}') AS words FROM d),
n AS (SELECT *, ' ' || replace(array_to_string(words, ' '), ' ', '  ') || ' ' AS norm2, ' ' || array_to_string(words, ' ') || ' ' AS norm FROM w),
p AS (SELECT *, string_split_regex(norm2, ' ({place.replace(' ', '  ')}) ') AS parts, list_sort(list_distinct({labels})) AS base FROM n),
t(tid, label, kind, ws, need) AS (VALUES {words}),
b AS (SELECT row_no, 'line' AS kind, unnest(string_split(low, chr(10))) AS block FROM d
      UNION ALL SELECT row_no, 'paragraph', unnest(string_split_regex(low, '\\n[ \\t\\r]*\\n')) FROM d),
bw AS (SELECT row_no, kind, list_distinct(regexp_extract_all(block, '{pattern}')) AS ws FROM b),
m AS (SELECT row_no, t.label, len(list_intersect(bw.ws, t.ws)) AS k, len(t.ws) AS n FROM bw JOIN t ON bw.kind = t.kind WHERE len(list_intersect(bw.ws, t.ws)) >= t.need),
g AS (SELECT row_no, list_distinct(list(label)) AS found, max(k / n) AS best FROM m GROUP BY row_no)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(parts) - 1 AS BIGINT) AS n_base,
  CASE WHEN len(parts) > 1 THEN CAST(len(regexp_extract_all(parts[1], '[^ ]+')) AS BIGINT) END AS first_word,
  CASE WHEN len(parts) > 1 THEN CAST(len(words) - len(regexp_extract_all(parts[len(parts)], '[^ ]+'))
    - len(string_split(regexp_extract(norm, '^.* ({place}) ', 1), ' ')) AS BIGINT) END AS last_word,
  array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ',') AS labels,
  CASE WHEN len(parts) > 1 THEN 1.0 ELSE CAST(coalesce(best, 0) AS DOUBLE) END AS score
FROM p LEFT JOIN g USING (row_no)
"""


QUERIES = {"op5_license_scan": op5_license_scan}
ORACLES = {"op5_license_scan": _sql()}
