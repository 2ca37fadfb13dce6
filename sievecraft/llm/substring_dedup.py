"""Suffix-array dedup: repeated strings of a fixed length, by distributed prefix doubling.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere
else in the corpus.  Positions are named by the rank of their prefix; two rounds
double the prefix from half the length to the whole of it, and whatever is unique
after a round leaves.  Names need only be equal for equal strings, so a round names
a prefix by its fingerprint instead of by the position of its class in a total
order; sorting within hash ranges then finds the classes.

*Round 1, half the length.*  Sorting every position of the corpus is not needed:
each window of ``length`` is represented by the least-fingerprint half-length
string in it (its *anchor*, the leftmost on a tie), and equal windows have equal
anchors at equal offsets.  So only anchors are ranked, about one in 100 bytes for
a length of 400.  An anchor whose half-length string is unique takes its windows out.

*Between the rounds*, anchors are compared with all the text that their windows cover
(their *context*).  If an anchor always has the same context, all its windows are
repeated.  Otherwise each distinct context sends one copy of its windows on.

*Round 2, the whole length.*  A window is ranked by the pair of the ranks of its two
halves, the second one half the length further on.  Pairs that occur twice are repeats.

Rows of both rounds travel packed, as arrays by hash range, in order of document and place.  Each batch first
settles what it can decide alone and sends one row for each distinct name, so a passage that a
third of all documents hold costs a row a batch, not a row a document.  Texts stay where they are read: only those
that a first answer may concern (by a bitmap of fixed size) are shuffled and written, once.

*Bytes and words.*  Positions are bytes, strings ``length`` of them; or words (lower-cased), strings ``words`` of
them, whatever stands between: 51 words are often fewer than 400 bytes.  Both are the same job on an array of symbols
and share all rounds; names of one kind never equal those of the other.  What is reported as removed is by bytes
alone; runs of words are reported beside it, and ``kept`` is what is left when both are cut.

Equal names are taken as equal strings: a window is named by 95 bits in all (fingerprints modulo 2**64 over random
byte values), which differ for different windows but for a chance of about 10**-3 over 100 TB of text.

Defined cases: a null text is an empty one; texts shorter than ``length`` lose nothing;
repeated rows are documents of their own (they share one row key, so their results
agree); periodic texts are repeats of themselves; long texts are cut into pieces that
overlap by ``length - 1`` symbols; columns that are not asked for are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievecraft.llm import bytescan as bs
from sievecraft.llm.common import materialise, maybe_in, no_clash, releasing, row_key, small_batches, table

LENGTH, WORDS = 400, 51
PIECE = 1 << 22
#: Bytes of text for each hash range and partition.
RANGE_BYTES = 1 << 23
_INDEX = np.uint64((1 << 24) - 1)

#: Queries (kind: what their symbols are) and answers (kind REPLY; ``extra`` says what is known of a range), by hash range.
_PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), *[(x, pa.binary()) for x in ("names", "extra", "doc", "start", "n", "k1", "k2")]])
_PACKED_DDL = "bucket int, kind int, names binary, extra binary, doc binary, start binary, n binary, k1 binary, k2 binary"
_BY_DOC = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ranges", pa.binary())])
_BY_DOC_DDL = "k1 long, k2 long, ranges binary"
BYTE, WORD, REPLY = 0, 1, 2
#: What is known of a range of windows: they are repeats; they are to be ranked in round 2.  Shifted by two bits for words.
FULL, RANK = 1, 2
_SALT = np.array([0, 0xA0761D6478BD642F], np.uint64)


def word_symbols(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and fingerprints of the words of a text, a piece at a time."""
    inside = bs.in_word(data)
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    names, at = np.empty(len(start), np.uint64), 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + PIECE // 4)))
        base = start[at]
        names[at:stop] = bs.words(data[base : end[stop - 1]])[2]
        at = stop
    return start, end, names


def _values(data: np.ndarray, kind: int) -> np.ndarray:
    return bs.byte_values(data) if kind == BYTE else word_symbols(data)[2]


def anchors(values: np.ndarray, length: int, kind: int = BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Name, context, first window and number of windows of each anchor of one text."""
    half, out = length // 2, []
    for at in range(0, max(1, len(values) - length + 1), PIECE):
        piece = values[at : at + PIECE + length - 1]
        if len(piece) < length:
            break
        sums = bs.value_sums(piece)
        name = bs.all_fingerprints(sums, half) ^ _SALT[kind]
        keyed = (name & ~_INDEX) | np.arange(len(name), dtype=np.uint64)
        chosen = (bs.sliding_min(keyed, length - half + 1) & _INDEX).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        n = np.diff(np.concatenate((first, [len(chosen)])))
        anchor = chosen[first]
        context = bs.fingerprints(sums, first, first + n - 1 + length)
        context = bs.mixed(context + (anchor - first).astype(np.uint64) * np.uint64(1 << 32) + n.astype(np.uint64))
        out.append((name[anchor], context, first + at, n))
    if not out:
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _runs(order_by: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Sort order and, for the sorted rows, the number of their run of equals (most significant key first)."""
    order = np.lexsort(order_by[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in order_by:
        y = x[order]
        new[1:] |= y[1:] != y[:-1]
    return order, np.cumsum(new) - 1


def _narrow(x: np.ndarray) -> bytes:
    """Numbers from 0 in two, four or eight bytes each."""
    top = int(x.max(initial=0))
    return x.astype(np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.int64).tobytes()


def _wide(packed: bytes, count: int) -> np.ndarray:
    return np.frombuffer(packed, {2: np.uint16, 4: np.uint32, 8: np.int64}[len(packed) // count] if count else np.uint16).astype(np.int64)


def _packed(bucket: np.ndarray, kind: int, names: np.ndarray | None, extra: np.ndarray, doc, start, n, keys) -> pa.RecordBatch:
    """One row for each bucket: names and ranges in order of document and place, which are told by counts and steps."""
    order = np.lexsort((start, doc, bucket))
    rows = []
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
        docs, count = np.unique(doc[part], return_counts=True)
        step = np.diff(start[part], prepend=0)
        first = np.cumsum(count) - count
        step[first] = start[part][first]
        sizes = b"" if n is None else _narrow(n[part])
        rows.append((int(bucket[part[0]]), kind, b"" if names is None else names[part].tobytes(), extra[part].tobytes(), _narrow(count), _narrow(step), sizes, keys[0][docs].tobytes(), keys[1][docs].tobytes()))
    cols = list(zip(*rows, strict=True)) or [[]] * len(_PACKED)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PACKED, strict=True)], schema=_PACKED)


def _unpacked(batch: pa.RecordBatch, extra_type) -> Iterator[tuple]:
    """Kind, names, extra, document, start, number and the documents' keys of each row."""
    for kind, names, extra, count, step, n, k1, k2 in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
        extra = np.frombuffer(extra, np.uint8 if kind == REPLY else extra_type)
        count = _wide(count, len(k1) // 8)
        start = np.cumsum(_wide(step, len(extra)))
        first = np.cumsum(count) - count
        # steps begin anew with each document
        start -= np.repeat(np.concatenate(([0], start[first[1:] - 1])), count)
        yield kind, np.frombuffer(names, np.uint64), extra, np.repeat(np.arange(len(count)), count), start, _wide(n, len(extra)) if n else np.ones(len(extra), np.int64), np.frombuffer(k1, np.int64), np.frombuffer(k2, np.int64)


def _replies(known, doc, start, n, keys, parts: int) -> pa.RecordBatch:
    """What is known of ranges, packed by part (a hash range of row keys)."""
    part = (keys[0][doc].view(np.uint64) % np.uint64(parts)).astype(np.int64)
    return _packed(part, REPLY, None, np.asarray(known, np.uint8), doc, np.asarray(start, np.int64), np.asarray(n, np.int64), keys)


def merged(start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of windows without overlaps, in order."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate((start + n)[order])
    first = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1])))
    return start[first], np.append(end[first[1:] - 1], end[-1:]) - start[first]


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All ranges of a part, one row for each document."""
    found = []
    for b in batches:
        for _, _, known, doc, start, n, k1, k2 in _unpacked(b, np.uint8):
            found.append((k1[doc], k2[doc], known, start, n))
    if not found:
        return
    k1, k2, known, start, n = (np.concatenate(x) for x in zip(*found, strict=True))
    order, by = _runs((k1, k2))
    cuts = np.flatnonzero(np.diff(by, prepend=-1))
    known, start, n = known[order], start[order], n[order]
    ends = np.append(cuts, len(order))[1:]
    for at in range(0, len(cuts), 5000):
        rows = []
        for a, b in zip(cuts[at : at + 5000], ends[at : at + 5000], strict=True):
            own = []
            for bit in (FULL, RANK, FULL << 2, RANK << 2):
                if (has := known[a:b] & bit > 0).any():
                    first, count = merged(start[a:b][has], n[a:b][has])
                    own.append(np.stack((np.full(len(first), bit), first, count), axis=1))
            rows.append(np.concatenate(own).astype(np.int64).tobytes())
        heads = order[cuts[at : at + 5000]]
        yield pa.RecordBatch.from_arrays([pa.array(k1[heads]), pa.array(k2[heads]), pa.array(rows, pa.binary())], schema=_BY_DOC)


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("k1", "k2"))


def _gather(found: list[tuple]) -> tuple[np.ndarray, ...]:
    """Arrays of a batch from (row, array, ...) of each text."""
    doc = np.concatenate([np.full(len(x[1]), x[0], np.int64) for x in found])
    return doc, *(np.concatenate([x[i] for x in found]) for i in range(1, len(found[0])))


def _slices(batch: pa.RecordBatch, column: str, most: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` bytes of text."""
    _, offsets = bs.texts(batch.column(column))
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most)))
        yield batch.slice(at, min(end, len(offsets) - 1) - at)
        at = end


def _round1_map(lengths: dict[int, int], buckets: int):
    def asked(kind: int, found: list[tuple], keys):
        doc, name, context, start, n = _gather(found)
        order, by_context = _runs((name, context))
        doc, name, context, start, n = (x[order] for x in (doc, name, context, start, n))
        head = np.flatnonzero(np.diff(by_context, prepend=-1))  # first row of each (name, context)
        copies = np.diff(np.concatenate((head, [len(order)])))
        h_name = name[head]
        by_name = np.cumsum(np.concatenate(([True], h_name[1:] != h_name[:-1]))) - 1
        many = np.bincount(by_name)[by_name] > 1  # the anchor has several contexts here: its windows are ranked in any case
        known = np.where(copies[by_context] > 1, FULL, 0)
        known[head] |= np.where(many, RANK, 0)
        if (local := np.flatnonzero(known)).size:
            yield _replies(known[local] << 2 * kind, doc[local], start[local], n[local], keys, buckets)
        sent = head[np.concatenate(([True], h_name[1:] != h_name[:-1]))]  # one row a name
        state = np.where(many[by_context[sent]], 3, np.where(copies[by_context[sent]] > 1, 2, 1)).astype(np.uint64)
        extra = (context[sent] & ~np.uint64(3)) | state
        yield _packed((name[sent] % np.uint64(buckets)).astype(np.int64), kind, name[sent], extra, doc[sent], start[sent], n[sent], keys)

    def run(batches):
        for whole in batches:
            for batch in _slices(whole, "text"):
                data, offsets = bs.texts(batch.column("text"))
                for kind, length in lengths.items():
                    shortest = length if kind == BYTE else 2 * length - 1
                    found = [(i, *anchors(_values(data[a:b], kind), length, kind)) for i, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)) if b - a >= shortest]
                    if found:
                        yield from asked(kind, found, _keys(batch))

    return run


def _collect(batches: Iterator[pa.RecordBatch], extra_type):
    """Pass answers on at once; return the queries as arrays."""
    parts, k1, k2, base = [], [], [], 0
    for b in batches:
        reply = pa.compute.equal(b.column("kind"), REPLY)
        if (own := b.filter(reply)).num_rows:
            yield own
        for kind, names, extra, doc, start, n, x1, x2 in _unpacked(b.filter(pa.compute.invert(reply)), extra_type):
            parts.append((np.full(len(names), kind, np.uint8), names, extra, doc + base, start, n))
            k1.append(x1)
            k2.append(x2)
            base += len(x1)
    if not parts:
        return None
    return (*(np.concatenate(x) for x in zip(*parts, strict=True)), (np.concatenate(k1), np.concatenate(k2)))


def _round1_reduce(buckets: int):
    def run(batches):
        got = yield from _collect(batches, np.uint64)
        if got is None:
            return
        kind, name, extra, doc, start, n, keys = got
        state, context = extra & np.uint64(3), extra & ~np.uint64(3)
        order, runs = _runs((name, context))
        state, doc, start, n = (x[order] for x in (state, doc, start, n))
        new_context = np.diff(runs, prepend=-1) > 0
        by_name = np.cumsum(np.concatenate(([True], name[order][1:] != name[order][:-1]))) - 1
        several = (np.bincount(by_name, weights=new_context) > 1) | (np.bincount(by_name, weights=state == 3) > 0)
        repeated = (np.bincount(runs)[runs] > 1) | (state == 2)
        # One row of each context is ranked on; rows of state 3 are so already where they come from.
        known = np.where(repeated, FULL, 0) | np.where(several[by_name] & new_context & (state != 3), RANK, 0)
        if (out := np.flatnonzero(known)).size:
            yield _replies(known[out] << 2 * kind[order][out], doc[out], start[out], n[out], keys, buckets)

    return run


def _read_ranges(packed: bytes | None, what: int) -> np.ndarray:
    """First window and number of windows of the ranges of which this is known."""
    ranges = np.frombuffer(packed, np.int64).reshape(-1, 3) if packed else np.empty((0, 3), np.int64)
    return ranges[ranges[:, 0] == what][:, 1:]


def _round2_map(lengths: dict[int, int], buckets: int):
    def ranked(values: np.ndarray, ranges: np.ndarray, length: int):
        """First and second rank, and position, of the windows in ``ranges``."""
        half = length // 2
        at = np.unique(np.concatenate([np.arange(s, s + n) for s, n in ranges]))
        out = []
        for piece in range(0, len(values), PIECE):
            own = at[(at >= piece) & (at < piece + PIECE)] - piece
            if len(own):
                sums = bs.value_sums(values[piece : piece + PIECE + length])
                out.append((bs.fingerprints(sums, own, own + half), bs.fingerprints(sums, own + half, own + length), own + piece))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def asked(kind: int, found: list[tuple], keys):
        doc, one, two, start = _gather(found)
        order, by = _runs((one, two))
        doc, one, two, start = (x[order] for x in (doc, one, two, start))
        head = np.flatnonzero(np.diff(by, prepend=-1))
        twice = np.diff(np.concatenate((head, [len(order)]))) > 1
        if (local := np.flatnonzero(twice[by])).size:
            yield _replies(np.full(len(local), FULL << 2 * kind), doc[local], start[local], np.ones(len(local)), keys, buckets)
        check = (two[head] >> np.uint64(32)).astype(np.uint32) & ~np.uint32(1) | twice.astype(np.uint32)
        pair = bs.mixed(one[head] * np.uint64(3) + two[head] + _SALT[kind])
        yield _packed((pair % np.uint64(buckets)).astype(np.int64), kind, pair, check, doc[head], start[head], None, keys)

    def run(batches):
        for whole in batches:
            for batch in _slices(whole, "text"):
                data, offsets = bs.texts(batch.column("text"))
                packed = batch.column("ranges").to_pylist()
                for kind, length in lengths.items():
                    found = []
                    for i, parts in enumerate(packed):
                        ranges = _read_ranges(parts, RANK << 2 * kind)
                        if len(ranges):
                            found.append((i, *ranked(_values(data[offsets[i] : offsets[i + 1]], kind), ranges, length)))
                    if found:
                        yield from asked(kind, found, _keys(batch))

    return run


def _round2_reduce(buckets: int):
    def run(batches):
        got = yield from _collect(batches, np.uint32)
        if got is None:
            return
        kind, pair, check, doc, start, _, keys = got
        order, by = _runs((pair, check >> np.uint32(1)))
        known = (check[order] & np.uint32(1)) > 0
        repeated = ((np.bincount(by) > 1) | (np.bincount(by, weights=known) > 0))[by] & ~known
        if (out := order[repeated]).size:
            yield _replies(np.uint8(FULL) << 2 * kind[out], doc[out], start[out], np.ones(len(out)), keys, buckets)

    return run


def spans(ranges: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what the windows of the ranges cover."""
    if not len(ranges):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start, n = merged(ranges[:, 0], ranges[:, 1] + length - 1)
    return start, start + n


def without(data: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    keep = zip(np.concatenate(([0], end)), np.concatenate((start, [len(data)])), strict=True)
    return b"".join(data[x:y] for x, y in keep)


def _finish(lengths: dict[int, int], with_text: bool):
    schema = pa.schema([(x, pa.int64()) for x in ("n_removed", "n_spans", "n_run_words", "n_runs")] + [("kept_sha256", pa.string()), ("kept", pa.string())])

    def of(data: np.ndarray, one: bytes | None, two: bytes | None) -> tuple:
        raw, full = data.tobytes(), lambda kind: np.concatenate([_read_ranges(x, FULL << 2 * kind) for x in (one, two)])
        a, b = spans(full(BYTE), lengths.get(BYTE, 0))
        left = without(raw, a, b)
        first, last = spans(full(WORD), lengths.get(WORD, 0))
        counts = int((b - a).sum()), len(a), int((last - first).sum()), len(first)
        kept = None
        if with_text and len(first):
            start, end, _ = word_symbols(data)
            cut = np.concatenate((np.stack((a, b - a), axis=1), np.stack((start[first], end[last - 1] - start[first]), axis=1)))
            kept = without(raw, *spans(cut, 1))
        elif with_text:
            kept = left
        return *counts, hashlib.sha256(left).hexdigest(), None if kept is None else kept.decode("utf-8", "ignore")

    def run(batches):
        for whole in batches:
            for b in _slices(whole, "text"):
                data, offsets = bs.texts(b.column("text"))
                ranges = zip(b.column("ranges").to_pylist(), b.column("more").to_pylist(), strict=True)
                out = [of(data[offsets[i] : offsets[i + 1]], one, two) for i, (one, two) in enumerate(ranges)]
                made = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
                rest = b.drop_columns(["text", "ranges", "more"])
                yield pa.RecordBatch.from_arrays(rest.columns + made, names=[*rest.schema.names, *schema.names])

    return run


def dedup(docs: DataFrame, length: int | None = LENGTH, words: int | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """One row per document: n_bytes; n_removed, n_spans and kept_sha256 by strings of ``length`` bytes; n_run_words
    and n_runs by strings of ``words`` words; and ``kept``, the text without either.  None: not looked for.

    ``keep`` names further columns to carry along.  Kept bytes that are no whole
    character any more, at the ends of a cut, are dropped from ``kept`` alone.
    """
    lengths = {k: n for k, n in ((BYTE, length), (WORD, words)) if n}
    names, made = [f"c{i}" for i in range(len(keep))], ["n_bytes", "n_removed", "n_spans", "n_run_words", "n_runs", "kept_sha256", "kept"]
    rows = no_clash(docs, id_col, text_col, *keep).toDF("doc_id", "text", *names).withColumn("text", F.coalesce("text", F.lit("")))
    small_batches(docs.sparkSession)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-total // RANGE_BYTES))
    rows = rows.withColumns(row_key("doc_id", "text"))

    def ranked(source: DataFrame, to, reduce) -> DataFrame:
        sent = source.mapInArrow(releasing(to), _PACKED_DDL).repartition(buckets, "bucket")
        back = sent.mapInArrow(releasing(reduce), _PACKED_DDL).repartition(buckets, "bucket")
        return back.mapInArrow(releasing(_by_document), _BY_DOC_DDL)

    least = min(n if k == BYTE else 2 * n - 1 for k, n in lengths.items())
    long = rows.select("k1", "k2", "text").filter(F.octet_length("text") >= least)
    first = materialise(ranked(long, _round1_map(lengths, buckets), _round1_reduce(buckets)), "ranges")
    marked = maybe_in(rows, first, "k1", "k2")
    touched = materialise(marked.filter("maybe").drop("maybe").join(first, ["k1", "k2"], "left"), "touched")
    second = ranked(touched.filter("ranges IS NOT NULL").select("k1", "k2", "text", "ranges"), _round2_map(lengths, buckets), _round2_reduce(buckets))
    own = [f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in zip(["doc_id", *names], [id_col, *keep], strict=True)]
    size = F.octet_length("text").cast("long").alias("n_bytes")
    done = touched.join(second.withColumnRenamed("ranges", "more"), ["k1", "k2"], "left").select("doc_id", *names, size, "ranges", "text", "more")
    done = done.mapInArrow(releasing(_finish(lengths, with_text)), f"{', '.join(own)}, n_bytes long, n_removed long, n_spans long, n_run_words long, n_runs long, kept_sha256 string, kept string")
    zeros = [F.lit(0).cast("long").alias(x) for x in made[1:5]]
    same = marked.filter("NOT maybe").select("doc_id", *names, size, *zeros, F.sha2("text", 256).alias("kept_sha256"), F.when(F.lit(with_text), F.col("text")).alias("kept"))
    out = done.unionByName(same).toDF(id_col, *keep, *made)
    return out if with_text else out.drop("kept")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns by strings of 400 bytes; n_run_words and n_runs tell repeated runs of 51 words and more, however few bytes they have."""
    return dedup(table(spark, sf_dir, "documents"), words=WORDS)


QUERIES = {"op9_substring_dedup": op9_substring_dedup}
ORACLES = {}
