"""Toxic spans by a linear-chain conditional random field with two tags.

Training rows carry one label per document, so tokens are labelled from them: in a
toxic document a token is toxic if one of its features (the word, and its prefixes of
4 to 6 bytes, which catch inflected and compound forms) is much more frequent in toxic
than in clean documents; every other token is clean.  The field has one weight per such
feature and four transition weights; it is trained by gradient ascent on the likelihood
of the tags of token segments.  Fitting uses at most ``FIT_DOCS`` labelled documents of
each class, taken by a hash of their ids; that is the bounded sample.  Scoring reads all.

Inference is exact and covers whole texts.  Tokens without a weighted feature all have
the same potentials, so a stretch of them is one power of the transition matrix (by its
eigenvectors); forward and backward steps are only taken at tokens with features.  The
marginals of those tokens are the tagged spans, and their sum and maximum go through a
fitted logistic curve to give the document score.

Defined cases: a null or empty text has no token and gets the score of a text without
features; documents without a label are only scored; without labelled rows of both
classes every score is 0; repeated rows are scored one by one; empty tables give an
empty result.  Ids, languages and sources are never looked at by the score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sievecraft.llm.common import no_clash, releasing, small_batches, table

FIT_DOCS = 2000
#: Bytes of text of each class that are fitted on at most.
FIT_BYTES = 32 << 20
#: Segments without any known feature weigh so many times all others at most, so that the few toxic ones tell.
PLAIN_WEIGHT = 20
THRESHOLD = 0.3
SEGMENT = 48
#: Standard errors between a feature's shares of toxic and clean documents, from which it counts.
SURE = 2.8
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(word: bytes) -> list[bytes]:
    return [b"=" + word, *(word[:n] for n in (4, 5, 6) if len(word) >= n)]


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Field:
    """Weights of features and transitions (tag before, tag), and the curve from marginals to a score."""

    weights: dict[bytes, float]
    start: np.ndarray
    step: np.ndarray
    bias: float
    curve: np.ndarray
    memo: dict[bytes, float] = field(default_factory=dict)

    def __post_init__(self):
        # powers of the neutral step: scaled by its larger eigenvalue
        neutral = np.exp(self.step) * np.array([1.0, math.exp(self.bias)])
        values, right = np.linalg.eig(neutral)
        order = np.argsort(-values.real)
        values, right = values.real[order], right.real[:, order]
        left = np.linalg.inv(right)
        self.ratio, self.main, self.other = values[1] / values[0], np.outer(right[:, 0], left[0]), np.outer(right[:, 1], left[1])

    def emission(self, word: bytes) -> float:
        """What the word's features add for the toxic tag; 0 for a neutral one."""
        got = self.memo.get(word)
        if got is None:
            if len(self.memo) > 100_000:
                self.memo.clear()
            got = self.memo[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return got

    def _run(self, n: int) -> np.ndarray:
        return self.main + self.ratio**n * self.other if n else np.eye(2)

    def marginals(self, n: int, at: list[int], emissions: list[float]) -> np.ndarray:
        """P(toxic) of the tokens at ``at`` among ``n`` tokens, all others neutral."""
        neutral, step = np.array([1.0, math.exp(self.bias)]), np.exp(self.step)
        potential = [np.array([1.0, math.exp(self.bias + e)]) for e in emissions]
        ahead, last, v = [], -1, None
        for i, p in zip(at, potential, strict=True):
            if v is None:
                v = np.exp(self.start) * (p if i == 0 else neutral)
                if i:
                    v = (v @ self._run(i - 1)) @ step * p
            else:
                v = (v @ self._run(i - last - 1)) @ step * p
            v, last = v / v.sum(), i
            ahead.append(v)
        out, back, after = [], self._run(n - 1 - at[-1]) @ np.ones(2), None
        for k in range(len(at) - 1, -1, -1):
            if after is not None:
                back = self._run(after - at[k] - 1) @ (step @ (potential[k + 1] * back))
            back = back / back.sum()
            both = ahead[k] * back
            out.append(both[1] / both.sum())
            after = at[k]
        return np.array(out[::-1])

    def tag(self, text: bytes) -> tuple[list[bytes], list[int], np.ndarray]:
        """Words, the numbers of those with features, and their marginals."""
        words = _WORD.findall(text.lower())
        emission, memo = self.emission, self.memo
        values = [memo[w] if w in memo else emission(w) for w in words]
        at = [i for i, e in enumerate(values) if e]
        return words, at, self.marginals(len(words), at, [values[i] for i in at]) if at else np.empty(0)

    def score(self, marginals: np.ndarray) -> float:
        return float(_logistic(_summary([marginals]) @ self.curve)[0])

    def offsets(self, text: bytes, at: list[int], marginals: np.ndarray, least: float = 0.5) -> list[dict]:
        """First byte and byte after of the tokens tagged toxic."""
        want = {i: float(p) for i, p in zip(at, marginals, strict=True) if p >= least}
        if not want:
            return []
        return [{"start": m.start(), "end": m.end(), "p": want[i]} for i, m in enumerate(_WORD.finditer(text.lower())) if i in want]


def _summary(marginals: list[np.ndarray]) -> np.ndarray:
    return np.array([[1.0, m.max(initial=0), math.log1p(m.sum())] for m in marginals])


def _distinct(texts: list[list[bytes]], toxic: np.ndarray) -> list[int]:
    """Documents that share neither of two min-hashes of three-word shingles with an earlier one of their class."""
    seen: set[tuple] = set()
    out = []
    for i, (words, y) in enumerate(zip(texts, toxic.tolist(), strict=True)):
        shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
        marks = {(y, seed, min(zlib.crc32(x, seed) for x in shingles)) for seed in (1, 0x5EED)}
        if not marks & seen:
            out.append(i)
        seen |= marks
    return out


def _token_labels(texts: list[list[bytes]], toxic: np.ndarray) -> dict[bytes, float]:
    """Log odds of the features that speak for toxic documents; copies count once."""
    seen, n = [Counter(), Counter()], [0, 0]
    for i in _distinct(texts, toxic):
        seen[toxic[i]].update({f for w in set(texts[i]) for f in features(w)})
        n[toxic[i]] += 1
    least = max(3, 0.01 * n[1])
    odds = {}
    for f, c in seen[1].items():
        if c >= least:
            p, q = (c + 0.5) / (n[1] + 1), (seen[0][f] + 0.5) / (n[0] + 1)
            # much more frequent, and not by chance
            if p > 8 * q and (p - q) / math.sqrt(p * (1 - p) / n[1] + q * (1 - q) / n[0] + 1e-12) > SURE:
                odds[f] = math.log(p / q)
    return odds


def fit(texts: list[bytes], toxic: list[int], rounds: int = 80, rate: float = 0.5, l2: float = 1e-4) -> Field | None:
    """Train on document texts and labels."""
    y = np.array(toxic, np.int64)
    if not len(y) or y.min() == y.max():
        return None
    split = [_WORD.findall(t.lower()) for t in texts]
    odds = _token_labels(split, y)
    index = {f: i for i, f in enumerate(sorted(odds))}
    # Segments of tokens with their active features; those without any toxic tag or feature count by weight.
    rows, cols, tags, seg, at = [], [], [], 0, 0
    plain = 0
    for words, doc in zip(split, y.tolist(), strict=True):
        for a in range(0, len(words), SEGMENT):
            active = [(i, f) for i, w in enumerate(words[a : a + SEGMENT]) for f in features(w) if f in index]
            if not active:
                plain += 1
                continue
            for i, f in active:
                rows.append(seg * SEGMENT + i)
                cols.append(index[f])
            tags += [(seg * SEGMENT + i) for i in {i for i, _ in active}] if doc else []
            seg += 1
            at = max(at, len(words[a : a + SEGMENT]))
    rows, cols = np.array(rows, np.int64), np.array(cols, np.int64)
    seg += 1  # the last one stands for all plain segments
    tag = np.zeros((seg, SEGMENT), np.int64)
    tag.ravel()[np.array(tags, np.int64)] = 1
    weight = np.ones(seg)
    weight[-1] = max(1, min(plain, PLAIN_WEIGHT * seg))
    w, start, step, bias = np.zeros(len(index)), np.zeros(2), np.zeros((2, 2)), -2.0
    total = weight.sum()
    momentum = None
    for _ in range(rounds):
        e = np.bincount(rows, w[cols], seg * SEGMENT).reshape(seg, SEGMENT) + bias if len(rows) else np.full((seg, SEGMENT), bias)
        potential = np.stack((np.zeros_like(e), np.clip(e, -30, 30)), axis=2)
        forward, backward = np.empty_like(potential), np.zeros_like(potential)
        v = start + potential[:, 0]
        forward[:, 0] = v
        for t in range(1, SEGMENT):
            v = np.logaddexp(v[:, :1] + step[0], v[:, 1:] + step[1]) + potential[:, t]
            forward[:, t] = v
        for t in range(SEGMENT - 2, -1, -1):
            u = backward[:, t + 1] + potential[:, t + 1]
            backward[:, t] = np.logaddexp(step[:, 0] + u[:, :1], step[:, 1] + u[:, 1:])
        norm = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])[:, None]
        p = np.exp(forward[..., 1] + backward[..., 1] - norm)
        miss = (tag - p) * weight[:, None]
        pair = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                want = ((tag[:, :-1] == a) & (tag[:, 1:] == b)).sum(axis=1)
                got = np.exp(forward[:, :-1, a] + step[a, b] + potential[:, 1:, b] + backward[:, 1:, b] - norm).sum(axis=1)
                pair[a, b] = ((want - got) * weight).sum()
        g_w = np.bincount(cols, miss.ravel()[rows], len(index)) if len(rows) else np.zeros(0)
        support = np.bincount(cols, minlength=len(index)) + 1.0
        grads = [g_w / support * 4 - l2 * w, np.array([-(miss[:, 0].sum()), miss[:, 0].sum()]) / total, pair / (total * SEGMENT) * 20, miss.sum() / (total * SEGMENT) * 20]
        momentum = grads if momentum is None else [0.8 * m + g for m, g in zip(momentum, grads, strict=True)]
        w, start, step, bias = w + rate * momentum[0], start + rate * momentum[1], step + rate * momentum[2], bias + rate * momentum[3]
    model = Field({f: float(w[i]) for f, i in index.items() if w[i]}, start, step, float(bias), np.zeros(3))
    x = _summary([model.tag(t)[2] for t in texts])
    curve = np.zeros(3)
    for _ in range(30):  # Newton steps with a little damping
        p = _logistic(x @ curve)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        curve += np.linalg.solve(hessian, x.T @ (y - p) - 1e-2 * curve)
    model.curve = curve
    model.memo.clear()
    return model


def fold(doc_id: Column, n: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, fit_bytes: int = FIT_BYTES) -> Field | None:
    """From labelled rows whose fold of 4 is not 2: at most ``fit_docs`` of each class and ``fit_bytes`` of text of each, in the order of a hash of the id.

    An id that names several texts is taken with the one of the smallest hash.
    """
    known = no_clash(labels, "doc_id", "toxic").filter(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), 4) != 2)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = None
    for y in (0, 1):
        own = known.filter((F.col("toxic") > 0) == bool(y)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)
        picked = own if picked is None else picked.unionByName(own)
    rows = no_clash(docs, "doc_id", "text").join(picked, "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = rows.withColumn("o", F.xxhash64("doc_id"))
    # At most 2 * fit_docs rows meet here.
    sofar = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(W.partitionBy("toxic").orderBy("o", "doc_id"))
    rows = rows.withColumn("sofar", sofar).filter(F.col("sofar") <= fit_bytes).select("text", "toxic", "o").collect()
    rows.sort(key=lambda r: (r.o, r.text or ""))
    return fit([(r.text or "").encode() for r in rows], [int(r.toxic > 0) for r in rows])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))


def _scored(model: Field | None, with_text: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores, spans = [], []
            for text in b.column("text").cast(pa.binary()).to_pylist():
                if model is None:
                    scores.append(0.0)
                    spans.append([])
                    continue
                _, at, marginals = model.tag(text or b"")
                scores.append(model.score(marginals))
                spans.append(model.offsets(text or b"", at, marginals))
            rest = b if with_text else b.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(scores, pa.float64()), pa.array(spans, _SPANS)], names=[*rest.schema.names, "score", "spans"])

    return run


def score(docs: DataFrame, model: Field | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """Documents with ``score`` and the byte offsets of toxic tokens with their marginals; ``keep``: columns to carry along."""
    small_batches(docs.sparkSession)
    names = [f"c{i}" for i in range(len(keep))]
    rows = no_clash(docs, id_col, text_col, *keep).toDF("doc_id", "text", *names)
    types = [f"{n} {rows.schema[n].dataType.simpleString()}" for n in ("doc_id", *(["text"] if with_text else []), *names)]
    out = rows.mapInArrow(releasing(_scored(model, with_text)), ", ".join(types) + ", score double, spans array<struct<start: long, end: long, p: double>>")
    return out.toDF(id_col, *([text_col] if with_text else []), *keep, "score", "spans")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_toxic_tokens"))


QUERIES = {"op6_toxicity": op6_toxicity}
ORACLES = {}
