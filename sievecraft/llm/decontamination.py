"""Benchmark decontamination with an FM-index per training shard.

A benchmark item is cut into windows of ``window`` consecutive words (a shorter item
is one window); a document word inside any occurrence of a window is hit.

Each task cuts its documents into shards of bounded size.  A shard's text is the
sequence of its words as numbers of the benchmark's vocabulary; words outside it can
be in no window, so only runs of vocabulary words as long as the shortest window are
kept, with a separator between them.  Over that sequence the shard builds an FM-index:
the suffix array (by prefix doubling), the Burrows-Wheeler transform, a wavelet tree of
it with rank directories, and every ``SAMPLE``-th text position at its row.
All windows are searched at once, backwards, by two wavelet ranks a step; occurrences
are located by walking back to a sampled position; their spans are merged.  Words are
compared by 64-bit fingerprints, and every located span is verified by its text.

The benchmark is read in blocks of at most ``BLOCK_WORDS`` words, so what goes to the tasks
is bounded; a larger benchmark takes more passes, whose spans are merged by document.

Defined cases: a null text or item has no words; an item without words has no window;
repeated items count once, items without an id hit words but are not listed; repeated
documents are answered one by one; empty tables give no rows or no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievecraft.llm import bytescan as bs
from sievecraft.llm.common import materialise, no_clash, releasing, small_batches, table

WINDOW = 10
SAMPLE = 16
BLOCK_WORDS = 1 << 21
SHARD_BYTES = 1 << 24


class Rank:
    """Bits with the number of ones before every position."""

    def __init__(self, bits: np.ndarray):
        self.before = np.zeros(len(bits) + 1, np.int32)
        np.cumsum(bits, out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        return self.before[at]


class WaveletTree:
    """Ranks of symbols, level by level from the most significant bit (in matrix form: zeros before ones)."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.levels.append(Rank(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            symbols = np.concatenate((symbols[bit == 0], symbols[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        low = np.zeros_like(at)
        for level, zeros, shift in zip(self.levels, self.zeros, range(self.bits - 1, -1, -1), strict=True):
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = level.ones(low), level.ones(at)
            low, at = np.where(one, zeros + a, low - a), np.where(one, zeros + b, at - b)
        return at - low

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and how often it stands before."""
        low, symbol = np.zeros_like(at), np.zeros_like(at)
        for level, zeros in zip(self.levels, self.zeros, strict=True):
            a, b = level.ones(low), level.ones(at)
            one = (level.ones(at + 1) - b).astype(bool)
            low, at = np.where(one, zeros + a, low - a), np.where(one, zeros + b, at - b)
            symbol = 2 * symbol + one
        return symbol, at - low


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffix array, by prefix doubling."""
    n, done = len(text), 1
    _, rank = np.unique(text, return_inverse=True)
    order = np.argsort(rank, kind="stable")
    while rank.max(initial=0) < n - 1:
        second = np.zeros(n, np.int64)
        second[:-done] = rank[done:] + 1
        pair = rank.astype(np.int64) * (n + 1) + second
        order = np.argsort(pair, kind="stable")
        step = np.concatenate(([0], np.diff(pair[order]) > 0))
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        done *= 2
    return order


class FMIndex:
    """Of a sequence of symbols from 1 up; 0 ends it."""

    def __init__(self, text: np.ndarray, alphabet: int):
        self.text = np.concatenate((text, np.zeros(1, text.dtype))).astype(np.int64)
        order = suffix_order(self.text)
        bwt = self.text[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(self.text, minlength=alphabet + 1))))
        self.tree = WaveletTree(bwt, max(1, int(alphabet).bit_length()))
        sampled = order % SAMPLE == 0
        self.sampled = Rank(sampled)
        self.positions = order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns, which stand right-aligned in the rows of a matrix."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self.text), np.int64)
        for step in range(patterns.shape[1]):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, -1 - step]
            low[live] = self.first[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, steps, open_ = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64), np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            at = rows[open_]
            hit = (self.sampled.ones(at + 1) - self.sampled.ones(at)).astype(bool)
            done = open_[hit]
            out[done] = self.positions[self.sampled.ones(rows[done])] + steps[done]
            open_ = open_[~hit]
            symbol, rank = self.tree.symbol_and_rank(rows[open_])
            rows[open_] = self.first[symbol] + rank
            steps[open_] += 1
        return out


class Benchmark:
    """Windows of a block of items: vocabulary (fingerprints, sorted), patterns, and the items of each pattern."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        texts, names, marks, vocabulary = {}, [], [], {}
        for item, text in items:
            data = np.frombuffer(text, np.uint8) if text else np.zeros(0, np.uint8)
            start, end, name = bs.words(data)
            low = bs._LOWER[data].tobytes()
            for s, e, x in zip(start.tolist(), end.tolist(), name.tolist(), strict=True):
                vocabulary[x] = low[s:e]
            for at in range(max(1, len(name) - window + 1) if len(name) else 0):
                names.append(tuple(name[at : at + window].tolist()))
                marks.append(item)
        for pattern, item in zip(names, marks, strict=True):
            texts.setdefault(pattern, set()).add(item)
        self.vocabulary = np.array(sorted(vocabulary), np.uint64)
        self.words = [vocabulary[int(x)] for x in self.vocabulary]
        self.lengths = np.array([len(p) for p in texts], np.int64)
        self.patterns = np.zeros((len(texts), window), np.int64)
        for row, p in enumerate(texts):
            self.patterns[row, window - len(p) :] = np.searchsorted(self.vocabulary, np.array(p, np.uint64)) + 1
        self.items = [sorted(x for x in own if x is not None) for own in texts.values()]
        self.shortest = int(self.lengths.min(initial=window))


def _runs_of(known: np.ndarray, least: int) -> np.ndarray:
    """Start and end of the runs of true values that are long enough."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], known, [False])).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    long = end - start >= least
    return np.stack((start[long], end[long]), axis=1)


def search_shard(data: np.ndarray, offsets: np.ndarray, bench: Benchmark) -> list[tuple[int, list[tuple[int, int, int, int]], list[str]]]:
    """For each document: number of words, merged spans (first word, word after, first byte, byte after), items."""
    n_docs, base = len(offsets) - 1, int(offsets[0])
    text = data[offsets[0] : offsets[-1]]
    # a blank between documents keeps words apart: mask by splitting at offsets
    starts, ends, names, counts = [], [], [], []
    for a, b in zip(offsets[:-1] - base, offsets[1:] - base, strict=True):
        s, e, x = bs.words(text[a:b])
        starts.append(s + a)
        ends.append(e + a)
        names.append(x)
        counts.append(len(x))
    start, end, name = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (starts, ends, names))
    first = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
    out = [(c, [], []) for c in counts]
    if not len(bench.patterns) or not len(name):
        return out
    at = np.searchsorted(bench.vocabulary, name)
    known = bench.vocabulary[np.minimum(at, len(bench.vocabulary) - 1)] == name
    symbol = np.where(known, at + 1, 0)
    # Runs end at documents: look at the words with a gap between documents.
    spread = np.arange(len(name)) + np.repeat(np.arange(n_docs), counts)
    wide = np.zeros(len(name) + n_docs, bool)
    wide[spread] = known
    runs = _runs_of(wide, bench.shortest)
    if not len(runs):
        return out
    size = runs[:, 1] - runs[:, 0]
    place = np.cumsum(size + 1) - (size + 1)  # of each run in the index's text, a separator after each
    within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    word_of_wide = np.full(len(wide), -1, np.int64)
    word_of_wide[spread] = np.arange(len(name))
    word = word_of_wide[np.repeat(runs[:, 0], size) + within]
    separator = len(bench.vocabulary) + 1
    sequence = np.full(int((size + 1).sum()), separator, np.int64)
    back = np.full(len(sequence), -1, np.int64)
    where = np.repeat(place, size) + within
    sequence[where], back[where] = symbol[word], word
    index = FMIndex(sequence, separator + 1)
    low, high = index.search(bench.patterns, bench.lengths)
    found = np.flatnonzero(high > low)
    rows = np.concatenate([np.arange(low[p], high[p]) for p in found]) if len(found) else np.empty(0, np.int64)
    pattern = np.repeat(found, (high - low)[found])
    hit = back[index.locate(rows)]
    order = np.argsort(hit, kind="stable")
    low_text = bs._LOWER[text].tobytes() if len(order) else b""
    doc_of = np.searchsorted(first, hit, side="right") - 1
    items: dict[int, set[str]] = {}
    spans: dict[int, list[list[int]]] = {}
    for k in order.tolist():
        w, p, d = int(hit[k]), int(pattern[k]), int(doc_of[k])
        n = int(bench.lengths[p])
        mine, theirs = symbol[w : w + n], bench.patterns[p, -n:]
        if not np.array_equal(mine, theirs) or any(low_text[start[w + i] : end[w + i]] != bench.words[int(x) - 1] for i, x in enumerate(theirs)):
            continue
        items.setdefault(d, set()).update(bench.items[p])
        own = spans.setdefault(d, [])
        if own and w <= own[-1][1]:
            own[-1][1] = max(own[-1][1], w + n)
        else:
            own.append([w, w + n])
    for d, own in spans.items():
        a = int(offsets[d]) - base
        out[d] = (counts[d], [(int(x - first[d]), int(y - first[d]), int(start[x] - a), int(end[y - 1] - a)) for x, y in own], sorted(items[d]))
    return out


_SPAN = "array<struct<first_word: long, end_word: long, first_byte: long, end_byte: long>>"


def _scan(bench: Benchmark):
    span = pa.list_(pa.struct([(x, pa.int64()) for x in ("first_word", "end_word", "first_byte", "end_byte")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            _, every = bs.texts(whole.column("text"))
            at = 0
            while at < whole.num_rows:
                stop = min(max(at + 1, int(np.searchsorted(every, every[at] + SHARD_BYTES))), whole.num_rows)
                batch = whole.slice(at, stop - at)
                at = stop
                found = search_shard(*bs.texts(batch.column("text")), bench)
                rest = batch.drop_columns(["text"])
                cols = [pa.array([f[0] for f in found], pa.int64()), pa.array([[dict(zip(("first_word", "end_word", "first_byte", "end_byte"), s, strict=True)) for s in f[1]] for f in found], span), pa.array([f[2] for f in found], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*rest.columns, *cols], names=[*rest.schema.names, "n_words", "spans", "items"])

    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items in blocks; the driver holds one block at a time."""
    block, size = [], 0
    items = no_clash(benchmark, item_col, text_col).toDF("item", "text").select(F.col("item").cast("string"), "text").filter(F.col("text").isNotNull()).distinct()
    for item, text in items.toLocalIterator():
        n = len(text) // 2 + 1  # no more words than that
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((item, text.encode()))
        size += n
    yield block


def _merge_spans(spans: list) -> list:
    out: list = []
    for s in sorted(spans):
        if out and s[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]), out[-1][2], max(out[-1][3], s[3]))
        else:
            out.append(tuple(s))
    return out


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents (id and ``keep``) with n_words, merged ``spans`` of words and bytes, and the sorted ``items`` found."""
    small_batches(docs.sparkSession)
    names = [f"c{i}" for i in range(len(keep))]
    rows = no_clash(docs, id_col, text_col, *keep).toDF("doc_id", "text", *names).withColumn("text", F.coalesce("text", F.lit("")))
    types = [docs.schema[c].dataType.simpleString() for c in (id_col, *keep)]
    blocks = _blocks(benchmark, "item_id", "text", block_words)
    bench, more = Benchmark(next(blocks), window), next(blocks, None)
    if more is None:
        ddl = ", ".join([f"{n} {t}" for n, t in zip(["doc_id", *names], types, strict=True)])
        found = rows.select("doc_id", *names, "text").mapInArrow(releasing(_scan(bench)), f"{ddl}, n_words long, spans {_SPAN}, items array<string>")
        return found.toDF(id_col, *keep, "n_words", "spans", "items")
    # A pass for each block; a row number ties the passes together.
    numbered = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    passes = None
    while bench is not None:
        one = materialise(numbered.select("row", "text").mapInArrow(releasing(_scan(bench)), f"row long, n_words long, spans {_SPAN}, items array<string>"), "pass")
        passes = one if passes is None else passes.unionByName(one)
        bench = None if more is None else Benchmark(more, window)
        more = next(blocks, None)
    merge = F.udf(lambda s: _merge_spans([tuple(x) for x in s]), _SPAN)
    merged = passes.groupBy("row").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    joined = numbered.drop("text").join(merged, "row").withColumn("spans", merge("spans"))
    return joined.select("doc_id", *names, "n_words", "spans", "items").toDF(id_col, *keep, "n_words", "spans", "items")


def summary(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end_word"] - s["first_word"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), {WINDOW}) AS n, array_to_string(w[i : i + {WINDOW - 1}], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, CAST(greatest(len(w) - {WINDOW - 1}, 1) AS BIGINT) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT row_no, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT row_no, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM d JOIN sizes ON len(w) >= n)),
hits AS (SELECT dw.row_no, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.gram = bw.gram),
covered AS (SELECT row_no, count(DISTINCT p) AS n_hit FROM (SELECT row_no, unnest(range(i, i + n)) AS p FROM hits) GROUP BY row_no),
found AS (SELECT row_no, count(DISTINCT item) AS n_items, array_to_string(list_sort(list_distinct(list(item))), ',') AS items FROM hits GROUP BY row_no)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (row_no) LEFT JOIN found USING (row_no)
"""

QUERIES = {"op2_decontaminate": op2_decontaminate}
ORACLES = {"op2_decontaminate": SQL}
