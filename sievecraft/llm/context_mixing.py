"""LM scoring by online logistic mixing of hashed-context bit predictors.

A text is the sequence of its lower-cased tokens and an end mark.  A token is coded by binary
decisions, each of which says whether a context tells the token:

* *again*: the two tokens before stood earlier in the document, and the same token follows;
* *third*: the two tokens before and this one stood in the training corpus one after the other;
* *second*: the token before and this one did;
* *known*: the token did.

The first that holds ends the decisions; the token then has its share of what follows that context
(all of it for *again*), or, if none holds, it is spelled byte by byte, eight decisions a byte.  A token that only
*known* holds for is told further by five decisions, the bits of its class (how often the training corpus has it, by doublings), and
has its share of that class.  Decisions
are skipped where their context is new, and a share counts tokens that an earlier decision has
ruled out, so all probabilities add up to one at most.

Each decision is predicted from counts of how it fell in several contexts (how often the two contexts
occurred, which decisions told the two tokens before, how many *again* held in a row; for classes the bits before and the
counts of the two tokens before).  Their log odds are
mixed by weights that a gate selects, in small online steps, and the mixture is refined by
an adaptive map from rounded log odds to what came of them.  Decisions of the same contexts are counted
together over the whole training corpus before the steps, so steps see every training token, in an order that does
not depend on partitions.  The spelling is mixed in the same way from five predictors whose contexts (the 1 to 4
bytes before, the whole token so far) are hashed into tables; each task trains weights and map online on all tokens of its hash
ranges that the corpus has once, which are the ones that are spelled, and the means over tasks are used.

Contexts grow with the corpus.  Pairs and triples of tokens are counted exactly by hashes of six to seven bits more than the
text has bytes, so a new one is taken for a known one in under 1 of 140 cases at any size.  The spelling's tables have
a fixed size and serve tokens that occur nowhere else; contexts share slots when there are many more than
the three million slots.

Tokens of training documents are scored as if they themselves had not been counted, so a text that
occurs nowhere else is not told by its own counts.  ``base_score`` takes all counts as they are.

How it is distributed.  One scan turns texts into chunks: token numbers by document, and the chunk's distinct
tokens, pairs and triples with their counts, dealt over hash ranges.  Each range adds up its counts and answers the
chunks.  A chunk then tells its documents' decisions, and sums of them by context, which are
the only things that meet on the driver, 92,160 contexts at any size of corpus.  Nothing of the vocabulary's size is broadcast or collected.

Defined cases: a null or blank text is its end mark alone; documents without an id are
learned from; repeated rows count as often as they stand; without training documents
every count is 0 and all decisions are even; other columns are not read; long texts are never cut; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievecraft.llm import bytescan as bs
from sievecraft.llm.common import deal, discard, materialise, no_clash, releasing, small_batches, table

CHUNK_BYTES = 1 << 23
#: Bytes of text for each hash range.
RANGE_BYTES = 1 << 24
END = b"\n"
TOKEN_BITS = 46
#: Kinds of rows: a chunk's documents; tokens and hashes asked for and their counts; a range's tokens.
DOCS, WORDS, GRAMS, RANGE = range(4)
_ROW = pa.schema([("chunk", pa.string()), ("kind", pa.int32()), ("part", pa.int32()), ("what", pa.binary()), ("counts", pa.binary())])
_ROW_DDL = "chunk string, kind int, part int, what binary, counts binary"


def _row(*rows: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ROW, strict=True)], schema=_ROW)


# ------------------------------------------------------------------------ packing


def _steps(x: np.ndarray) -> bytes:
    """Ascending numbers as steps of two or four bytes; the largest step stands for itself and goes on."""
    step = np.diff(x, prepend=np.zeros(1, x.dtype)).astype(np.uint64)
    kind = np.uint16 if not len(x) or int(x[-1]) // len(x) < 1 << 15 else np.uint32
    top = np.uint64(np.iinfo(kind).max)
    more = (step // top).astype(np.int64)
    out = np.full(len(x) + more.sum(), top, np.uint64)
    out[np.cumsum(more + 1) - 1] = step % top
    return bytes([kind().itemsize]) + out.astype(kind).tobytes()


def _from_steps(packed: bytes) -> np.ndarray:
    step = np.frombuffer(packed, np.uint16 if packed[0] == 2 else np.uint32, offset=1)
    return np.cumsum(step, dtype=np.uint64)[step != np.iinfo(step.dtype).max]


def _small(x: np.ndarray) -> bytes:
    """Counts: a byte each, and those from 255 on in full."""
    large = x[x >= 255].astype(np.int64)
    return zlib.compress(np.int64(len(large)).tobytes() + large.tobytes() + np.minimum(x, 255).astype(np.uint8).tobytes(), 1)


def _from_small(packed: bytes) -> np.ndarray:
    raw = zlib.decompress(packed)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    out = np.frombuffer(raw, np.uint8, offset=8 + 8 * n).astype(np.int64)
    out[out == 255] = np.frombuffer(raw, np.int64, n, 8)
    return out


def _part_of(hashes: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """Ranges by the leading bits."""
    lead = max(0, bits - 32)
    return ((hashes >> np.uint64(lead)) * np.uint64(parts) >> np.uint64(bits - lead)).astype(np.int64)


def _low_of(part: int, bits: int, parts: int) -> np.uint64:
    """The least hash of a range."""
    lead = max(0, bits - 32)
    return np.uint64(-(-(part << (bits - lead)) // parts) << lead)


# ------------------------------------------------------------------------- chunks


class Tokens:
    """The documents of a chunk as numbers of its distinct tokens, the most frequent first."""

    def __init__(self, doc_id: list, texts: pa.Array):
        texts = texts.fill_null("")
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = split.values.dictionary_encode()
        codes, words = coded.indices.to_numpy().astype(np.int32), coded.dictionary.cast(pa.binary()).to_pylist()
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(split.offsets.to_numpy()))
        if b"" in words:  # white space at the ends of a text
            real = codes != words.index(b"")
            codes, doc = codes[real], doc[real]
        self.size = np.bincount(doc, minlength=len(texts)) + 1
        last = np.cumsum(self.size) - 1
        flat, inner = np.full(self.size.sum(), len(words), np.int32), np.ones(self.size.sum(), bool)
        inner[last] = False
        flat[inner] = codes
        words.append(END)
        count = np.bincount(flat, minlength=len(words))
        order = np.argsort(-count, kind="stable")[: np.count_nonzero(count)]
        place = np.empty(len(words), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.flat = place[flat]
        self.words = [words[i] for i in order]
        self.hash = np.fromiter((xxhash.xxh64_intdigest(w) >> (64 - TOKEN_BITS) for w in self.words), np.uint64, len(self.words))
        self.known_id = np.array([x is not None for x in doc_id], np.int8)
        self.doc_id = np.array([0 if x is None else x for x in doc_id], np.int64)
        self.held = np.array([x is not None and zlib.crc32(str(x).encode()) % 10 == 0 for x in doc_id], np.int8)
        self.n_bytes = pc.binary_length(texts).to_numpy().astype(np.int64)

    def pack(self) -> bytes:
        head = np.array([len(self.size), len(self.hash), len(self.flat)], np.int64)
        codes = np.minimum(self.flat, 0xFFFF).astype(np.uint16)
        raw = (head, self.doc_id, self.size, self.n_bytes, self.known_id, self.held, self.hash.view(np.uint8).reshape(-1, 8)[:, :6], codes, self.flat[self.flat >= 0xFFFF])
        return zlib.compress(b"".join(x.tobytes() for x in raw), 1)

    @classmethod
    def unpack(cls, packed: bytes) -> Tokens:
        raw, at, out = zlib.decompress(packed), 0, cls.__new__(cls)

        def take(kind, n):
            nonlocal at
            x = np.frombuffer(raw, kind, n, at)
            at += x.nbytes
            return x

        docs, tokens, length = take(np.int64, 3)
        out.doc_id, out.size, out.n_bytes, out.known_id, out.held = (take(k, docs) for k in (np.int64, np.int64, np.int64, np.int8, np.int8))
        out.hash = np.zeros((tokens, 8), np.uint8)
        out.hash[:, :6] = take(np.uint8, 6 * tokens).reshape(-1, 6)
        out.hash = out.hash.view(np.uint64).ravel()
        codes = take(np.uint16, length)
        out.flat = codes.astype(np.int32)
        out.flat[codes == 0xFFFF] = take(np.int32, int((codes == 0xFFFF).sum()))
        return out

    @property
    def first(self) -> np.ndarray:
        return np.cumsum(self.size) - self.size

    def before(self, x: np.ndarray, start) -> np.ndarray:
        """What stands one token before each, and ``start`` before a document."""
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[self.first] = start
        return out

    def grams(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each token with the one before it, and with the two before it."""
        end = np.uint64(xxhash.xxh64_intdigest(END) >> (64 - TOKEN_BITS))
        own = self.hash[self.flat]
        one = self.before(own, end)
        two = self.before(one, end)
        pair = bs.mixed(one * np.uint64(0x9E3779B97F4A7C15) + own)
        triple = bs.mixed(bs.mixed(two * np.uint64(0xC2B2AE3D27D4EB4F) + one + np.uint64(1)) + own)
        return pair >> np.uint64(64 - bits), triple >> np.uint64(64 - bits)


def _chunks(parts: int, bits: int):
    """Documents of a chunk; its distinct tokens, pairs and triples by part with their counts in training documents."""

    def rows(name: str, batch: pa.RecordBatch) -> pa.RecordBatch:
        t = Tokens(batch.column("doc_id").to_pylist(), batch.column("text"))
        home = zlib.crc32(name.encode()) % parts
        out = [(name, DOCS, home, t.pack(), b"")]
        learned = np.bincount(t.flat[np.repeat(t.held == 0, t.size)], minlength=len(t.words))
        part = _part_of(t.hash, TOKEN_BITS, parts)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(cuts)):
            own = order[cuts[p] : cuts[p + 1]]
            out.append((name, WORDS, int(p), b" ".join([t.words[i] for i in own]), _small(learned[own])))  # tokens hold no blank
        held = np.repeat(t.held, t.size).astype(np.uint64)
        keys = np.concatenate([x << np.uint64(1) | held for x in t.grams(bits)])
        keys.sort()
        own = keys >> np.uint64(1)
        head = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        learned, own = np.add.reduceat(1 - (keys & np.uint64(1)).astype(np.int64), head), own[head]
        cuts = np.searchsorted(own, np.array([_low_of(p, bits, parts) for p in range(parts)] + [1 << bits], np.uint64))
        for p in np.flatnonzero(np.diff(cuts)):
            a, b = cuts[p], cuts[p + 1]
            out.append((name, GRAMS, int(p), _steps(own[a:b] - _low_of(p, bits, parts)), _small(learned[a:b])))
        return _row(*out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            _, offsets = bs.texts(batch.column("text"))
            at = 0
            while at < batch.num_rows:
                stop = min(max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES))), batch.num_rows)
                number += 1
                yield rows(f"{task}-{number}", batch.slice(at, stop - at))
                at = stop

    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answer with the counts of the whole corpus; tokens that are counted once at most come back spelled out, for their chunk needs them."""
    asked: dict[int, list[tuple]] = {}
    grams: dict[int, list[tuple]] = {}
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if row[1] == DOCS:
                yield _row(row)
            else:
                (asked if row[1] == WORDS else grams).setdefault(row[2], []).append((row[0], row[3], row[4]))
    for part, rows in grams.items():
        parts = [_from_steps(x) for _, x, _ in rows]
        keys, counts = np.concatenate(parts), np.concatenate([_from_small(n) for *_, n in rows])
        order = np.argsort(keys, kind="stable")
        own = keys[order]
        new = np.concatenate(([True], own[1:] != own[:-1]))
        total = np.add.reduceat(counts[order], np.flatnonzero(new))
        counts[order] = total[np.cumsum(new) - 1]
        ends = np.cumsum([len(x) for x in parts])
        for (chunk, *_), a, b in zip(rows, ends - [len(x) for x in parts], ends, strict=True):
            yield _row((chunk, GRAMS, part, b"", _small(counts[a:b])))
    grams.clear()
    for part, rows in asked.items():
        split = pc.split_pattern(pa.array([words for _, words, _ in rows], pa.large_binary()), pattern=b" ")
        coded = split.values.dictionary_encode()
        code, ends = coded.indices.to_numpy(), split.offsets.to_numpy()
        total = np.bincount(code, np.concatenate([_from_small(n) for *_, n in rows]), len(coded.dictionary)).astype(np.int64)
        for (chunk, *_), a, b in zip(rows, ends[:-1], ends[1:], strict=True):
            counts = total[code[a:b]]
            yield _row((chunk, WORDS, part, b" ".join(split.values.slice(a, b - a).filter(pa.array(counts < 2)).to_pylist()), _small(counts)))
        if total.any():
            yield _row((None, RANGE, part, b" ".join(coded.dictionary.filter(pa.array(total > 0)).to_pylist()), total[total > 0].tobytes()))


# ----------------------------------------------------------------------- spelling

#: Slots of each predictor, as powers of two; a slot has two counters of 2 bytes where it is shared.
SLOT_BITS = (16, 19, 20, 20, 20)
_STARTS = np.concatenate(([0], np.cumsum([1 << b for b in SLOT_BITS])))
BLOCK = 1 << 16
LEVELS = (1, 3, 16)
CELLS = 33


class Decisions:
    """All binary decisions of a list of spelled tokens: slots by predictor, the bit, the tree node, and the token."""

    def __init__(self, words: list[bytes]):
        spelled = [w if w == END else w + b" " for w in words]
        size = np.fromiter(map(len, spelled), np.int64, len(spelled))
        data = np.frombuffer(b"".join(spelled), np.uint8)
        start = np.repeat(np.cumsum(size) - size, size)
        token = np.repeat(np.arange(len(words), dtype=np.int32), size)
        place = np.arange(len(data)) - start
        contexts, recent = [], np.zeros(len(data), np.uint64)
        for back in range(1, 5):
            before = np.full(len(data), 0x20, np.uint8)
            before[back:] = data[:-back]
            before[place < back] = 0x20
            recent = recent * np.uint64(256) + before
            contexts.append(recent.copy())
        contexts.append(bs.fingerprints(bs.prefix_sums(data), start, np.arange(len(data))) + place.astype(np.uint64))
        self.n_tokens, bits, nodes, slots = len(words), [], [], [[] for _ in SLOT_BITS]
        for j in range(8):
            node = (1 << j) | (data >> (8 - j) if j else np.zeros(len(data), np.uint8)).astype(np.int64)
            nodes.append(node.astype(np.int16))
            bits.append((data >> (7 - j)) & 1)
            for o, (context, width) in enumerate(zip(contexts, SLOT_BITS, strict=True)):
                if o == 0:
                    at = (context * np.uint64(256)).astype(np.int64) + node
                else:
                    at = (bs.mixed(context * np.uint64(0x9E3779B97F4A7C15) + (node + 977 * o).astype(np.uint64)) >> np.uint64(64 - width)).astype(np.int64)
                slots[o].append((at + _STARTS[o]).astype(np.int32))
        self.bit, self.node = np.concatenate(bits), np.concatenate(nodes)
        self.slots = [np.concatenate(s) for s in slots]
        self.token, self.place = np.tile(token, 8), np.repeat(np.arange(8, dtype=np.int8), len(data))


def _some(words: list[bytes], n: int) -> Iterator[list[bytes]]:
    """Parts of a list of tokens of about ``8 * n`` bytes."""
    size = np.cumsum([len(w) + 1 for w in words])
    at = 0
    while at < len(words):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + 8 * n)))
        yield words[at:end]
        at = end


def _log_odds(one: np.ndarray, zero: np.ndarray) -> np.ndarray:
    return np.log((one + np.float32(0.05)) / (zero + np.float32(0.05)))


class Speller:
    """Predictor tables with gated weights and the adaptive map."""

    def __init__(self, pairs: np.ndarray, state: np.ndarray | None = None):
        """``pairs``: two counters of each slot; ``state``: weights and map, as ``state`` gives them."""
        n = len(SLOT_BITS) + 1
        self.pairs, self.weights = pairs, np.full((8 * 16, n), 0.25)
        self.weights[:, -1] = 0.0
        self.map = np.tile(1 / (1 + np.exp(-(np.arange(CELLS) - CELLS // 2) / 2.0)), (256, 1))
        if state is not None:
            self.weights, self.map = state[: 128 * n].reshape(128, n).astype(np.float64), state[128 * n :].reshape(256, CELLS).astype(np.float64)

    def state(self) -> np.ndarray:
        return np.concatenate((self.weights.ravel(), self.map.ravel()))

    def _mixed(self, d: Decisions, without: bool) -> tuple:
        """Inputs, gates and mixed log odds of decisions; ``without``: as if these had not been counted."""
        odds, seen = [], []
        for s in d.slots:
            c = self.pairs[s].astype(np.float32)
            one, zero = c[:, 1], c[:, 0]
            if without:
                one, zero = np.maximum(one - d.bit, 0), np.maximum(zero - (1 - d.bit), 0)
            odds.append(_log_odds(one, zero))
            seen.append(one + zero)
        x = np.stack([*odds, np.ones(len(d.bit), np.float32)], axis=1)
        level = lambda n: sum((n >= x).astype(np.int16) for x in LEVELS)
        gate = (level(seen[4]) * 4 + level(seen[2])) * 8 + d.place
        return x, gate, np.clip(np.einsum("ij,ij->i", x, self.weights[gate]), -30, 30)

    def _refined(self, z, node):
        at = np.clip(2 * z + CELLS // 2, 0, CELLS - 1.001)
        low = at.astype(np.int64)
        high = at - low
        return low, high, self.map[node, low] * (1 - high) + self.map[node, low + 1] * high

    def log10(self, words: list[bytes], without: np.ndarray | None = None) -> np.ndarray:
        """The log10 probability of each token's spelling; ``without``: whether it is scored as if it had not been counted."""
        if without is not None:
            out = np.empty(len(words))
            for kind in (False, True):
                at = np.flatnonzero(without == kind)
                out[at] = self._log10([words[i] for i in at], kind)
            return out
        return self._log10(words, False)

    def _log10(self, words: list[bytes], without: bool) -> np.ndarray:
        out = [np.empty(0)]
        for some in _some(words, 10_000):
            d = Decisions(some)
            _, _, z = self._mixed(d, without)
            p = 0.5 / (1 + np.exp(-z)) + 0.5 * self._refined(z, d.node)[2]
            out.append(np.bincount(d.token, np.log10(np.clip(np.where(d.bit == 1, p, 1 - p), 1e-6, 1)), len(some)))
        return np.concatenate(out)

    def train(self, words: list[bytes], rate: float = 0.02, step: int = 1000) -> None:
        """Online steps over tokens in their given order; each is taken out of the counts first."""
        for some in _some(words, step):
            d = Decisions(some)
            x, gate, z = self._mixed(d, True)
            miss = d.bit - 1 / (1 + np.exp(-z))
            grads, hits = np.zeros_like(self.weights), np.bincount(gate, minlength=len(self.weights))
            for k in range(x.shape[1]):
                grads[:, k] = np.bincount(gate, x[:, k] * miss, len(self.weights))
            self.weights += rate * grads / np.sqrt(1 + hits)[:, None]
            low, high, _ = self._refined(z, d.node)
            heavy = np.bincount(d.node, minlength=256)[d.node]
            for cell, share in ((low, 1 - high), (low + 1, high)):
                place = d.node.astype(np.int64) * CELLS + cell
                moved = 0.02 * share * (d.bit - self.map.ravel()[place]) / np.sqrt(1 + heavy)
                self.map += np.bincount(place, moved, self.map.size).reshape(self.map.shape)
        self.map = np.clip(self.map, 1e-4, 1 - 1e-4)


def _halved(pairs: np.ndarray) -> np.ndarray:
    """Counters in two bytes; large pairs keep their proportion."""
    scale = np.maximum(1.0, pairs.max(axis=1, keepdims=True) / 65535.0)
    return np.round(pairs / scale).astype(np.uint16)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How the decisions of a task's tokens fell, by block of slots; each distinct token counts once."""
    counters = None
    for b in batches:
        for words in b.column("what").to_pylist():
            counters = np.zeros(2 * _STARTS[-1], np.float32) if counters is None else counters
            for some in _some(words.split(b" "), 25_000):
                d = Decisions(some)
                for o, slot in enumerate(d.slots):
                    a, z = 2 * _STARTS[o], 2 * _STARTS[o + 1]
                    counters[a:z] += np.bincount(2 * slot.astype(np.int64) - a + d.bit, minlength=z - a)
    if counters is None:
        return
    for block in range(0, len(counters), BLOCK):
        own = counters[block : block + BLOCK]
        if own.any():
            yield _row((None, RANGE, block // BLOCK, zlib.compress(own.tobytes(), 1), b""))


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays of numbers added up by part."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for part, packed in zip(b.column("part").to_pylist(), b.column("what").to_pylist(), strict=True):
            own = np.frombuffer(zlib.decompress(packed), np.float32).astype(np.float64)
            total[part] = total[part] + own if part in total else own
    for part, own in total.items():
        yield _row((None, RANGE, part, zlib.compress(own.astype(np.float32).tobytes(), 1), b""))


def _trained(pairs):
    """Weights and map after all tokens of a task's ranges that stand once, weighted by their number, for a sum over tasks.

    A token that stands more often is never spelled: it is known when one of its places is scored.
    """

    def run(batches):
        speller, n = Speller(pairs.value), 0
        for b in batches:
            for words, counts in zip(b.column("what").to_pylist(), b.column("counts").to_pylist(), strict=True):
                words = words.split(b" ")
                once = [words[i] for i in np.flatnonzero(np.frombuffer(counts, np.int64) == 1)]
                n += len(once)
                speller.train(once)
        if n:
            state = np.append(speller.state(), 1.0) * n
            yield _row((None, RANGE, 0, zlib.compress(state.astype(np.float32).tobytes(), 1), b""))

    return run


def _summed(rows: DataFrame, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Arrays added up by part, in two steps, so that no task and not the driver gets more than about the root of their number each."""
    some = rows.withColumn("part", F.col("part") * width + F.pmod(F.xxhash64("what"), F.lit(width)).cast("int"))
    once = deal(some, 8 * width, "part").mapInArrow(releasing(_sum_rows), _ROW_DDL)
    twice = deal(once.withColumn("part", F.floor(F.col("part") / width).cast("int")), 8, "part").mapInArrow(releasing(_sum_rows), _ROW_DDL)
    for part, packed in zip(*twice.select("part", "what").toArrow().columns, strict=True):
        yield part.as_py(), np.frombuffer(zlib.decompress(packed.as_py()), np.float32)


# ---------------------------------------------------------------------- decisions

AGAIN, THIRD, SECOND, KNOWN, SPELLED = range(5)
#: Decision, how often the two and the one token before occurred, what told the two tokens before, and *agains* in a row.
_SHAPE = (4, 8, 16, 5, 5, 4)
N_CELLS = int(np.prod(_SHAPE))
#: Bits of a class so far, how often the one and the two tokens before occurred, and what told the token before.
_CLASS_SHAPE = (32, 16, 16, 5)
ALL_CELLS = N_CELLS + int(np.prod(_CLASS_SHAPE))


def _scale(x: np.ndarray, top: int) -> np.ndarray:
    """0, and then one for each doubling, up to ``top``."""
    return np.minimum(np.frexp(np.maximum(x, 0).astype(np.float64))[1], top).astype(np.int32)


def _last_again(t: Tokens) -> np.ndarray:
    """The token that followed the same two tokens when they last stood in the document; -1 if they did not."""
    one = t.before(t.flat, -1).astype(np.int64)
    two = t.before(one, -1)
    doc = np.repeat(np.arange(len(t.size)), t.size)
    key = bs.mixed((two * len(t.hash) + one).astype(np.uint64) + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = np.flatnonzero((key[order][1:] == key[order][:-1]) & (two[order[1:]] >= 0))
    out = np.full(len(t.flat), -1, np.int32)
    out[order[same + 1]] = t.flat[order[same]]
    return out


def decisions(t: Tokens, count: np.ndarray, pair: np.ndarray, triple: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """What tells each token; the decisions as (token, cell, outcome); and the log10 share of each told token (of known ones, of all tokens, without their number)."""
    own = np.repeat(t.held == 0, t.size).astype(np.int64)  # what a training token itself has added to its counts
    end = count[t.flat[t.first + t.size - 1][:1]][0]
    before = t.before(count[t.flat], end) - own
    before2 = t.before(pair, end) - own
    c1, c2, c3 = count[t.flat] - own, pair - own, triple - own
    guess = _last_again(t)
    there = [guess >= 0, before2 > 0, before > 0, np.ones(len(t.flat), bool)]
    holds = [guess == t.flat, c3 > 0, c2 > 0, c1 > 0]
    told = np.full(len(t.flat), SPELLED, np.int8)
    for d in (KNOWN, SECOND, THIRD, AGAIN):
        told[there[d] & holds[d]] = d
    last = t.before(told, SPELLED)
    hit = guess == t.flat
    run = np.arange(len(hit)) - np.maximum.accumulate(np.where(hit, -1, np.arange(len(hit))))
    run = t.before(run, 0)
    place = _scale(before2, 7) * 16 + _scale(before, 15)
    place = ((place * 5 + last) * 5 + t.before(last, SPELLED)) * 4 + _scale(run, 3)
    made, open_ = [], np.ones(len(t.flat), bool)
    for d in (AGAIN, THIRD, SECOND, KNOWN):
        at = np.flatnonzero(open_ & there[d])
        made.append((at, place[at] + d * (N_CELLS // 4), holds[d][at]))
        open_[at[holds[d][at]]] = False
    share = np.zeros(len(t.flat))
    for d, one, all_ in ((THIRD, c3, before2), (SECOND, c2, before), (KNOWN, c1, np.ones(1, np.int64))):
        at = np.flatnonzero(told == d)
        share[at] = np.log10(np.minimum(1.0, one[at] / all_[at]) if d != KNOWN else one[at])
    return told, made, share


def class_of(count: np.ndarray) -> np.ndarray:
    """Doublings of a count, in five bits."""
    return np.clip(np.frexp(count.astype(np.float64))[1] - 1, 0, 31)


def classes(t: Tokens, count: np.ndarray, told: np.ndarray, masses: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """The tokens that only *known* holds for; the decisions on their classes as (token, cell, outcome); and the log10 share that each has of its class.

    ``masses``: training tokens by class.  A training token is taken out of them, by which its word may change its class.
    """
    at = np.flatnonzero(told == KNOWN)
    own = np.repeat(t.held == 0, t.size).astype(np.int64)
    c1 = count[t.flat[at]] - own[at]
    kind = class_of(c1)
    left = masses[kind] + np.where(class_of(c1 + own[at]) == kind, -1, c1) * own[at]
    before = t.before(count[t.flat] - own, 0)
    place = np.ravel_multi_index((np.zeros(len(at), np.int64), _scale(before, 15)[at], _scale(t.before(before, 0), 15)[at], t.before(told, SPELLED)[at]), _CLASS_SHAPE)
    made, node, wide = [], np.ones(len(at), np.int64), ALL_CELLS - N_CELLS
    for bit in range(4, -1, -1):
        holds = (kind >> bit & 1).astype(bool)
        made.append((at, N_CELLS + node * (wide // 32) + place, holds))
        node = 2 * node + holds
    return at, made, np.log10(c1 / left)


def _sparse(x: np.ndarray, by: np.ndarray, n: int) -> list[bytes]:
    """Each document's numbers, counted: how many distinct ones, these, and their counts."""
    keys = by.astype(np.int64) << 32 | x
    keys.sort()
    head = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)
    count = np.diff(np.append(head, len(keys)))
    x, cuts = keys & 0xFFFFFFFF, np.searchsorted(keys[head], np.arange(n + 1) << 32)
    return [x[head[a:b]].astype(np.uint32).tobytes() + count[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _from_sparse(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(packed, np.uint32).reshape(2, -1)
    return both[0], both[1]


_TOLD_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, n_bytes long, base double, shares double, cells binary, learned binary"
_TOLD = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), *[(x, pa.int64()) for x in ("n_tokens", "n_known", "n_bytes")], ("base", pa.float64()), ("shares", pa.float64()), ("cells", pa.binary()), ("learned", pa.binary())])


def _documents(pairs, state: np.ndarray | None, masses: np.ndarray, bits: int, parts: int):
    """The documents of each chunk with their decisions by cell, and one row of all decisions of the chunk's training documents."""

    def told(docs: bytes, answers: dict[int, list[tuple]]) -> Iterator[pa.RecordBatch]:
        t = Tokens.unpack(docs)
        words = sorted(answers[WORDS])
        order = np.argsort(_part_of(t.hash, TOKEN_BITS, parts), kind="stable")
        counts = np.concatenate([_from_small(c) for _, _, c in words])
        assert len(counts) == len(order), "every part answers"
        count = np.empty(len(order), np.int64)
        count[order] = counts
        spelled = [w for _, x, c in words if (_from_small(c) < 2).any() for w in x.split(b" ")]
        at = order[counts < 2]
        spelling = np.zeros(len(order))
        spelling[at] = Speller(pairs.value, state).log10(spelled, count[at] > 0)
        grams = np.concatenate(t.grams(bits))
        order = np.argsort(grams, kind="stable")
        run = np.concatenate(([True], grams[order][1:] != grams[order][:-1]))
        of = np.empty(len(grams), np.int64)
        of[order] = np.concatenate([_from_small(c) for _, _, c in sorted(answers[GRAMS])])[np.cumsum(run) - 1]
        del grams, order, run
        told, made, share = decisions(t, count, of[: len(t.flat)], of[len(t.flat) :])
        del of
        unknown = told == SPELLED
        share[unknown] = spelling[t.flat[unknown]]
        known, more, among = classes(t, count, told, masses)
        share[known] = among
        made += more
        n, first = len(t.size), t.first
        add = lambda x: np.add.reduceat(x, first)
        doc = np.repeat(np.arange(n, dtype=np.int32), t.size)
        cell = np.concatenate([2 * c + y for _, c, y in made])
        by = np.concatenate([doc[i] for i, _, _ in made])
        learned = np.bincount(cell[t.held[by] == 0], minlength=2 * ALL_CELLS)
        some = np.flatnonzero(learned)
        cols = [
            pa.array(t.doc_id, mask=t.known_id == 0), pa.array(t.held == 1), pa.array(t.size), pa.array(add((count[t.flat] > 0).astype(np.int64))), pa.array(t.n_bytes),
            pa.array(add(np.log10(count + 0.1)[t.flat])), pa.array(add(share)), pa.array(_sparse(cell, by, n), pa.binary()), pa.nulls(n, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(cols, schema=_TOLD)
        whole = some.astype(np.uint32).tobytes() + learned[some].astype(np.uint32).tobytes()
        yield pa.RecordBatch.from_pylist([{"learned": whole}], schema=_TOLD)

    def run(batches):
        now, docs, answers = None, b"", {}
        for b in batches:
            for chunk, kind, part, what, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if chunk != now:
                    if now is not None:
                        yield from told(docs, answers)
                    now, answers = chunk, {WORDS: [], GRAMS: []}
                if kind == DOCS:
                    docs = what
                else:
                    answers[kind].append((part, what, counts))
        if now is not None:
            yield from told(docs, answers)

    return run


def _cell_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        for packed in b.column("learned").to_pylist():
            at, n = _from_sparse(packed)
            total = np.zeros(2 * ALL_CELLS) if total is None else total
            total[at] += n
    if total is not None:
        yield _row((None, RANGE, 0, zlib.compress(total.astype(np.float32).tobytes(), 1), b""))


def _context(*parts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.int64)
    for p in parts:
        out = out * 32 + p
    return np.unique(out, return_inverse=True)[1]


def _contexts(classed: bool) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Kind of decision and what told the token before, by cell; and the contexts, which are parts of a cell."""
    if classed:
        d, q1, q2, l1 = np.unravel_index(np.arange(ALL_CELLS - N_CELLS), _CLASS_SHAPE)
        return d, l1, [_context(d), _context(d, q1), _context(d, q2), _context(d, q1, l1), _context(d, q1, q2), np.arange(len(d))]
    d, q2, q1, l1, l2, again = np.unravel_index(np.arange(N_CELLS), _SHAPE)
    return d, l1, [_context(d, q2, q1), _context(d, q1, l1), _context(d, l1, l2, again), _context(d, q2, l1, again), _context(d, q2, q1, l1, again), np.arange(N_CELLS)]


def mix_cells(counts: np.ndarray, classed: bool = False, sweeps: int = 12, rate: float = 0.5, step: int = 256) -> np.ndarray:
    """The log10 probability of either outcome of each cell, from how often each occurred (cells by 2); ``classed``: of the cells of classes.

    The contexts of a decision are parts of its cell.  A step takes some cells, with all their decisions, as
    if one decision of each kind had not been counted; it moves the weights of the gates that the cells select, and the map.
    """
    d, l1, contexts = _contexts(classed)
    kinds = d.max() + 1
    sums = [np.stack([np.bincount(c, counts[:, y]) for y in (0, 1)], axis=1)[c] for c in contexts]
    gate, gates = _context(d, l1, np.minimum(_scale(counts.sum(axis=1), 15) // 3, 4)), None
    gates = gate.max() + 1
    weights = np.full((gates, len(contexts) + 1), 1.0 / len(contexts))
    weights[:, -1] = 0.0
    grid = (np.arange(CELLS) - CELLS // 2) / 2.0
    prior = np.tile(1 / (1 + np.exp(-grid)), (kinds, 1))
    hits, total = 20.0 * prior, np.full((kinds, CELLS), 20.0)

    def inputs(cells, outcome=None):
        cols = []
        for s in sums:
            one, zero = s[cells, 1].astype(np.float64), s[cells, 0].astype(np.float64)
            if outcome is not None:
                one, zero = np.maximum(one - outcome, 0), np.maximum(zero - (1 - outcome), 0)
            cols.append(np.log((one + 0.4) / (zero + 0.4)))
        return np.stack([*cols, np.ones(len(cells))], axis=1)

    def refined(z, cells):
        at = np.clip(2 * z + CELLS // 2, 0, CELLS - 1.001)
        low = at.astype(np.int64)
        high, m = at - low, hits / total
        return low, high, m[d[cells], low] * (1 - high) + m[d[cells], low + 1] * high

    cells, outcome = np.nonzero(counts)
    order = np.argsort(bs.mixed(cells.astype(np.uint64) * np.uint64(2) + outcome.astype(np.uint64) + np.uint64(1)), kind="stable")
    cells, outcome = cells[order], outcome[order]
    heavy = counts[cells, outcome].astype(np.float64)
    x, seen = inputs(cells, outcome), np.full(gates, 1.0)
    for sweep in range(sweeps):
        for at in range(0, len(cells), step):
            own = slice(at, at + step)
            z = np.clip(np.einsum("ij,ij->i", x[own], weights[gate[cells[own]]]), -30, 30)
            miss = heavy[own] * (outcome[own] - 1 / (1 + np.exp(-z)))
            mass = np.bincount(gate[cells[own]], heavy[own], gates)
            seen += mass
            for k in range(x.shape[1]):
                weights[:, k] += rate * np.bincount(gate[cells[own]], x[own, k] * miss, gates) / (1 + np.sqrt(mass * seen)) / 4
            if sweep == sweeps - 1:
                low, high, _ = refined(z, cells[own])
                for cell, share in ((low, 1 - high), (low + 1, high)):
                    np.add.at(hits, (d[cells[own]], cell), heavy[own] * share * outcome[own])
                    np.add.at(total, (d[cells[own]], cell), heavy[own] * share)
    every = np.arange(len(d))
    z = np.clip(np.einsum("ij,ij->i", inputs(every), weights[gate]), -30, 30)
    p = np.clip(0.5 / (1 + np.exp(-z)) + 0.5 * refined(z, every)[2], 1e-6, 1 - 1e-6)
    return np.log10(np.stack((1 - p, p), axis=1))


def _cells_of(outcomes):
    """The log10 probability of each document's decisions."""

    def run(batches):
        for b in batches:
            sums = [float(outcomes.value[at] @ n) for at, n in map(_from_sparse, b.column("cells").to_pylist())]
            yield b.drop_columns(["cells"]).append_column("decisions", pa.array(sums, pa.float64()))

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits and bits_per_byte (of the text and its end mark)."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = no_clash(docs, id_col, text_col).toDF("doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, bits = max(8, -(-total // RANGE_BYTES)), max(24, min(60, int(total).bit_length() + 5))
    asked = deal(rows.mapInArrow(releasing(_chunks(parts, bits)), _ROW_DDL), parts, "part")
    answers = materialise(asked.mapInArrow(releasing(_count), _ROW_DDL), "answers", partition_by="kind")
    ranges = answers.filter(F.col("kind") == RANGE).select("part", "what", "counts")
    masses, n_types = np.zeros(32, np.int64), 0
    for r in ranges.mapInArrow(_range_sizes, "class int, tokens long, types long").groupBy("class").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types")).collect():  # 32 rows
        masses[r["class"]], n_types = r.tokens, n_types + r.types
    n_all = int(masses.sum())

    width = max(1, int(parts**0.5) // 8)
    counters = np.zeros(2 * _STARTS[-1], np.float32)
    for block, own in _summed(ranges.select("what").coalesce(max(4, parts // 8)).mapInArrow(releasing(_tables), _ROW_DDL), width):
        counters[block * BLOCK : block * BLOCK + len(own)] = own
    sent = spark.sparkContext.broadcast(_halved(counters.reshape(-1, 2)))  # of fixed size
    state = None
    for _, own in _summed(ranges.select("what", "counts").mapInArrow(releasing(_trained(sent)), _ROW_DDL), width):
        state = own[:-1] / own[-1]

    back = deal(answers.filter(F.col("kind") < RANGE).select("chunk", "kind", "part", "what", "counts"), parts, F.xxhash64("chunk"))
    told = materialise(back.sortWithinPartitions("chunk", "kind", "part").mapInArrow(releasing(_documents(sent, state, masses, bits, parts)), _TOLD_DDL), "told")
    discard(answers)
    learned = np.zeros(2 * ALL_CELLS)
    for _, own in _summed(told.filter("learned IS NOT NULL").select("learned").mapInArrow(releasing(_cell_sums), _ROW_DDL), width):
        learned = own.astype(np.float64)
    learned = learned.reshape(-1, 2)
    outcomes = spark.sparkContext.broadcast(np.concatenate((mix_cells(learned[:N_CELLS]), mix_cells(learned[N_CELLS:], classed=True))).ravel())
    known = "doc_id", "held_out", "n_tokens", "n_known", "n_bytes", "base", "shares"
    ddl = ", ".join(x for x in _TOLD_DDL.split(", ") if x.split()[0] in known)
    done = told.filter("learned IS NULL").select(*known, "cells").mapInArrow(releasing(_cells_of(outcomes)), f"{ddl}, decisions double")
    n = F.lit(n_all).cast("long")
    base = F.col("base") - F.col("n_tokens") * F.log10(F.lit(n_all + 0.1 * (n_types + 1)))
    whole = F.col("shares") + F.col("decisions")
    out = done.select("doc_id", "held_out", "n_tokens", "n_known", n.alias("train_tokens"), base.alias("base_score"), whole.alias("score"), "n_bytes")
    bits_ = F.col("score") * F.lit(-np.log2(10.0).item())
    return out.withColumn("bits", bits_).withColumn("bits_per_byte", F.col("bits") / (F.col("n_bytes") + 1))


def _range_sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens and distinct tokens of the ranges by class."""
    for b in batches:
        for packed in b.column("counts").to_pylist():
            counts = np.frombuffer(packed, np.int64)
            kind = class_of(counts)
            tokens = np.zeros(32, np.int64)
            np.add.at(tokens, kind, counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(32, dtype=np.int32)), pa.array(tokens), pa.array(np.bincount(kind, minlength=32))], names=["class", "tokens", "types"])


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


QUERIES = {"op4_lm_scores": op4_lm_scores}
ORACLES = {}
