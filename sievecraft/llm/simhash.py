"""SimHash near-dedup by a byte-position inverted index with count filtering.

A fingerprint has a bit where more than half of the shingle hashes have it.  Two
fingerprints of 8 bytes that differ in at most 4 bits share at least 4 bytes at
their places: each differing bit spoils one byte at most.  So a pair must reach a
tally of 4 shared positional bytes, and only such pairs are verified by Hamming
distance.

Single positional bytes make poor posting lists (each holds 1/256 of all rows), so the
index is kept by *triples* of positions chosen such that any four positions contain
one of them: a pair with a tally of 4 meets in some list, and nothing is missed.  20
such triples exist (two groups of four positions; all triples within a group, and
pairs of a group with single positions of the other as the Turan construction has it).

Only distinct fingerprints are indexed.  A list is not expanded into pairs: its members
are linked by search from member to not yet reached members, which yields a spanning
forest of exactly the links that the list holds, in one comparison per member and
step.  Lists of more than ``LIST_ROWS`` members are cut into blocks that meet pairwise,
in as many tasks.  The forest's components are those of all links.

Defined cases: a null or blank text has fingerprint zero, and such rows are linked
like any others; repeated rows share fingerprint and component; a null id has a
fingerprint, counts as no member of any component and gets a null component unless
other rows share its fingerprint's component; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievecraft.llm.bytescan import mixed
from sievecraft.llm.common import discard, materialise, maybe_in, no_clash, releasing, row_key, small_batches, table
from sievecraft.llm.components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
LIST_ROWS = 20_000


def triples() -> list[tuple[int, int, int]]:
    """20 triples of the 8 positions that meet every four of them: positions in three
    groups, triples within a group and pairs of a group with one of the next group."""
    groups = [(0, 1, 2), (3, 4, 5), (6, 7)]
    inside = [t for g in groups for t in combinations(g, 3)]
    across = [(*p, x) for i, g in enumerate(groups) for p in combinations(g, 2) for x in groups[(i + 1) % 3]]
    return [tuple(sorted(t)) for t in inside + across]


TRIPLES = triples()


def _hashes(text: bytes, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of the shingles of lower-cased tokens, repeats included; shorter texts are one shingle."""
    words = text.lower().split()  # ASCII white space of bytes.split() is exactly that of the token rule
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    n = max(1, len(words) - shingle + 1)
    start, stop = (end - size)[:n].tolist(), end[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(start, stop, strict=True)), np.uint64, n)


def _ones(words: np.ndarray) -> np.ndarray:
    """How many rows have each bit; sums of 255 rows fit into bytes."""
    bits = words.shape[1] * 64
    counts = np.zeros(bits, np.int64)
    for part in range(0, len(words), 255 * 64):
        own = np.unpackbits(words[part : part + 255 * 64].view(np.uint8).reshape(-1, bits // 8), axis=1, bitorder="little")
        for k in range(0, len(own), 255):
            counts += own[k : k + 255].sum(axis=0, dtype=np.uint8)
    return counts


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, set where over half of the shingle hashes have them; blank texts have zero."""
    hashes = _hashes(text, shingle, seed)
    return int(np.packbits(2 * _ones(hashes[:, None]) > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.array([fingerprint(t or b"", shingle) for t in b.column("text").cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.drop_columns(["text"]).columns, pa.array(values.view(np.int64))], names=[*b.drop_columns(["text"]).schema.names, "fingerprint"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    rows = no_clash(docs, id_col, text_col).toDF("doc_id", "text")
    return rows.mapInArrow(releasing(_fingerprints(shingle)), f"doc_id {docs.schema[id_col].dataType.simpleString()}, fingerprint long")


def _forest(codes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join all codes which chains of links within ``codes`` join."""
    out, rest = [], np.arange(len(codes))
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            here = front.pop()
            x = codes[rest] ^ codes[here]
            tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)  # shared positional bytes
            near = tally >= 8 - radius
            near[near] = np.bitwise_count(x[near]) <= radius
            out += [(int(here), int(r)) for r in rest[near]]
            front += rest[near].tolist()
            rest = rest[~near]
    return out


def _lists(radius: int):
    """Links within the posting lists of a partition, which comes sorted by list."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def linked(key: np.ndarray, code: np.ndarray):
        cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        size = np.diff(cuts)
        first = cuts[:-1][size == 2]  # most lists have one or two members
        near = np.bitwise_count(code[first] ^ code[first + 1]) <= radius
        pairs = [(code[first[near]], code[first[near] + 1])]
        for i in np.flatnonzero(size > 2):
            own = code[cuts[i] : cuts[i + 1]]
            if forest := _forest(own, radius):
                a, b = np.array(forest).T
                pairs.append((own[a], own[b]))
        a, b = (np.concatenate(x).view(np.int64) for x in zip(*pairs, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, code = np.empty(0, np.int64), np.empty(0, np.uint64)
        for b in batches:
            key = np.concatenate((key, b.column("list").to_numpy()))
            code = np.concatenate((code, b.column("fingerprint").to_numpy().view(np.uint64)))
            done = np.searchsorted(key, key[-1]) if len(key) else 0  # the last list may go on
            if done:
                yield linked(key[:done], code[:done])
                key, code = key[done:], code[done:]
        if len(key):
            yield linked(key, code)

    return run


def links(codes: DataFrame, radius: int = RADIUS, list_rows: int = LIST_ROWS) -> DataFrame:
    """(a, b): a spanning forest, list by list, of all links between the distinct fingerprints in ``codes``."""
    if radius > 4:
        raise ValueError("beyond 4 bits four shared bytes are not guaranteed")
    byte = lambda i: F.shiftrightunsigned("fingerprint", 8 * i).bitwiseAND(255)
    keys = [F.lit(n << 24).cast("long") + F.shiftleft(byte(i), 16) + F.shiftleft(byte(j), 8) + byte(k) for n, (i, j, k) in enumerate(TRIPLES)]
    posted = codes.select("fingerprint", F.explode(F.array(*keys)).alias("key"))
    large = posted.groupBy("key").count().filter(F.col("count") > list_rows)
    large = materialise(large.select("key", F.ceil(2 * F.col("count") / list_rows).alias("blocks")), "lists")
    if large.isEmpty():
        dealt = posted.select(F.xxhash64("key").alias("list"), "fingerprint")
    else:
        # A large list becomes blocks; each pair of blocks is a list of its own.
        joined = posted.join(large, "key", "left")
        block = F.pmod(F.xxhash64("fingerprint"), F.coalesce("blocks", F.lit(1)))
        other = joined.select("key", "fingerprint", "blocks", block.alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)).alias("other"))
        name = F.when(F.col("blocks").isNull(), F.xxhash64("key")).otherwise(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")))
        dealt = other.select(name.alias("list"), "fingerprint")
    return dealt.repartition("list").sortWithinPartitions("list").mapInArrow(releasing(_lists(radius)), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, list_rows: int = LIST_ROWS) -> DataFrame:
    """One row per document: doc_id, fingerprint (long), component_id."""
    small_batches(docs.sparkSession)
    rows = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = materialise(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "classes")
    # Nodes are fingerprints here; the smallest id of a component is taken at the end.
    joined = components(links(classes, radius, list_rows))
    named = classes.join(joined.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    found = named.join(smallest, "component").select("fingerprint", "component_id")
    return rows.join(found, "fingerprint").select("doc_id", "fingerprint", "component_id")


#: Wide fingerprints, for similarities that 64 bits cannot tell: 512 bits, in lists by two bytes.
WIDE_WORDS, WIDE_SHINGLE, SIMILARITY = 8, 5, 0.8
_SPREAD = np.array([(2 * i + 1) * 0x9E3779B97F4A7C15 % 2**64 for i in range(WIDE_WORDS)], np.uint64)
_PAIRS = [(2 * i, 2 * i + 1) for i in range(32)] + [(i, i + 32) for i in range(32)]
#: Words of a fingerprint that the entries of a list carry.
LIST_WORDS = 2
#: Lists of up to so many entries are compared in common, longer ones each by itself.
SHORT_LIST = 48
#: Shingle hashes of a block of texts that are compared with each other, in bytes.
BLOCK_BYTES = 1 << 23


def _wide_bits(hashes: np.ndarray) -> bytes:
    """Bits that over half of the distinct shingles have."""
    out = np.zeros(WIDE_WORDS * 64, np.int64)
    for part in range(0, len(hashes), 1 << 15):
        out += _ones(mixed(hashes[part : part + (1 << 15), None] * _SPREAD[None, :]))
    return np.packbits(2 * out > len(hashes), bitorder="little").tobytes()


def most_bits(similarity: float, words: int, deviations: float) -> int:
    """The expected distance in so many words of the fingerprints of texts of this Jaccard similarity, and some deviations more."""
    angle = math.acos(2 * similarity / (1 + similarity)) / math.pi
    bits = words * 64
    return int(bits * angle + deviations * math.sqrt(bits * angle * (1 - angle)))


def _wide(shingle: int):
    def run(batches):
        for b in batches:
            sets = (np.unique(_hashes(t or b"", shingle, SEED)) for t in b.column("text").cast(pa.binary()).to_pylist())
            values, sizes = zip(*((_wide_bits(x), len(x)) for x in sets), strict=True) if b.num_rows else ((), ())
            rest = b.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(values, pa.binary()), pa.array(sizes, pa.int64())], names=[*rest.schema.names, "fingerprint", "size"])

    return run


def _sets(shingle: int):
    """The hashes of each text's distinct shingles, ascending, eight bytes each."""

    def run(batches):
        for b in batches:
            sets = [np.unique(_hashes(t or b"", shingle, SEED)).tobytes() for t in b.column("text").cast(pa.binary()).to_pylist()]
            rest = b.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(sets, pa.binary())], names=[*rest.schema.names, "shingles"])

    return run


def _postings(buckets: int, blocks: dict[int, int]):
    """Entries of the lists by two positional bytes, packed by bucket: list, first words of the bits, node.

    A list named in ``blocks`` is cut into so many blocks by node; each pair of blocks is a list of its own.
    """
    schema = pa.schema([("bucket", pa.int32()), ("key", pa.binary()), ("code", pa.binary()), ("node", pa.binary())])

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            codes = np.frombuffer(b"".join(b.column("fingerprint").to_pylist()), np.uint8).reshape(b.num_rows, -1)
            node = b.column("node").to_numpy().view(np.uint64)
            key, row = list_keys(codes).ravel(), np.repeat(np.arange(len(codes)), len(_PAIRS))
            key = mixed(key.astype(np.uint64))
            if blocks:
                large = np.isin(key, np.array(list(blocks), np.uint64))
                more = [(key[~large], row[~large])]
                for i in np.flatnonzero(large):
                    n = blocks[int(key[i])]
                    own, other = int(mixed(node[row[i] : row[i] + 1])[0] % np.uint64(n)), np.arange(n)
                    pair = np.minimum(own, other) * n + np.maximum(own, other)
                    more.append((mixed(key[i] + pair.astype(np.uint64) + np.uint64(1)), np.full(n, row[i])))
                key, row = (np.concatenate(x) for x in zip(*more, strict=True))
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((key, bucket))
            words = codes[:, : 8 * LIST_WORDS]
            rows = [(int(bucket[p[0]]), (key[p] >> np.uint64(32)).astype(np.uint32).tobytes(), words[row[p]].tobytes(), node[row[p]].tobytes()) for p in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return run


def list_keys(codes: np.ndarray) -> np.ndarray:
    """The lists of each fingerprint (a row of bytes)."""
    return np.stack([(n << 16) + codes[:, i].astype(np.int64) * 256 + codes[:, j] for n, (i, j) in enumerate(_PAIRS)], axis=1)


def near_pairs(key: np.ndarray, code: np.ndarray, limit: int) -> np.ndarray:
    """Rows (i, j) of entries of one list within ``limit`` bits that join all that such pairs join; ``key`` is ascending.

    Entries of short lists are compared with those 1, 2, ... places further on, in all lists
    at once; a long list is searched from entry to entries not yet reached.
    """
    cuts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    size = np.diff(cuts)
    found = [np.empty((0, 2), np.int64)]
    at, lag = np.flatnonzero(np.repeat(size <= SHORT_LIST, size)), 0
    while len(at):
        lag += 1
        at = at[at < len(key) - lag]
        at = at[key[at] == key[at + lag]]
        for part in range(0, len(at), 1 << 16):
            i = at[part : part + (1 << 16)]
            far = np.bitwise_count(code[i] ^ code[i + lag]).sum(axis=1, dtype=np.int32)
            i = i[far <= limit]
            found.append(np.stack((i, i + lag), axis=1))
    for k in np.flatnonzero(size > SHORT_LIST):
        rest = np.arange(cuts[k], cuts[k + 1])
        while len(rest):
            front, rest = [rest[0]], rest[1:]
            while front and len(rest):
                here = front.pop()
                near = np.bitwise_count(code[rest] ^ code[here]).sum(axis=1, dtype=np.int32) <= limit
                found.append(np.stack((np.full(near.sum(), here), rest[near]), axis=1))
                front += rest[near].tolist()
                rest = rest[~near]
    return np.concatenate(found)


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (node, least node) that join what the pairs join, one for each node but the least ones."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    least = np.arange(len(nodes))
    while True:
        before = least.copy()
        low = np.minimum(least[x], least[y])
        for z in (x, y, least[x], least[y]):
            np.minimum.at(least, z, low)
        least = least[least]
        if (least == before).all():
            break
    moved = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[moved], nodes[least[moved]]


_STARS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _as_stars(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in stars(a, b)], schema=_STARS)


def _families(limit: int):
    """What the lists of a bucket join."""

    def run(batches):
        parts = [x for b in batches for x in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True)]
        if not parts:
            return
        key = np.frombuffer(b"".join(p[0] for p in parts), np.uint32)
        code = np.frombuffer(b"".join(p[1] for p in parts), np.uint64).reshape(len(key), -1)
        node = np.frombuffer(b"".join(p[2] for p in parts), np.int64)
        del parts
        order = np.argsort(key, kind="stable")
        key, code, node = key[order], code[order], node[order]
        pairs = near_pairs(key, code, limit)
        yield _as_stars(node[pairs[:, 0]], node[pairs[:, 1]])

    return run


def similar_pairs(sets: list[np.ndarray], codes: np.ndarray, similarity: float, limit: int) -> list[tuple[int, int]]:
    """Pairs of sets of this Jaccard similarity or more that join all that such pairs join.

    Sets whose fingerprints or sizes are too far apart are not intersected, nor are sets that are joined already.
    """
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(size)
    flag, label, out = np.zeros(ids.max(initial=0) + 1, bool), np.arange(len(sets)), []
    for i in range(len(sets) - 1):
        near = np.bitwise_count(codes[i + 1 :] ^ codes[i]).sum(axis=1, dtype=np.int32) <= limit
        rest = size[i + 1 :]
        near &= (label[i + 1 :] != label[i]) & (np.minimum(rest, size[i]) >= similarity * np.maximum(rest, size[i]))
        if not near.any():
            continue
        mine = ids[ends[i] - size[i] : ends[i]]
        flag[mine] = True
        for j in np.flatnonzero(near) + i + 1:
            if label[j] != label[i]:
                shared = np.count_nonzero(flag[ids[ends[j] - size[j] : ends[j]]])
                if shared >= similarity * (size[i] + size[j] - shared):
                    out.append((i, int(j)))
                    label[label == label[j]] = label[i]
        flag[mine] = False
    return out


def _exact(similarity: float, limit: int):
    """What the texts of each block join; rows come sorted by block."""

    def block(rows: list[tuple]) -> pa.RecordBatch:
        node = np.array([r[0] for r in rows], np.int64)
        codes = np.frombuffer(b"".join(r[1] for r in rows), np.uint64).reshape(len(rows), -1)
        pairs = np.array(similar_pairs([np.frombuffer(r[2], np.uint64) for r in rows], codes, similarity, limit), np.int64).reshape(-1, 2)
        return _as_stars(node[pairs[:, 0]], node[pairs[:, 1]])

    def run(batches):
        now, rows = None, []
        for b in batches:
            for own, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if own != now and rows:
                    if len(rows) > 1:
                        yield block(rows)
                    rows = []
                now = own
                rows.append(row)
        if len(rows) > 1:
            yield block(rows)

    return run


def _large_lists(nodes: DataFrame, list_rows: int, sample: int = 20_000) -> dict[int, int]:
    """Lists of more than ``list_rows`` entries, and how many blocks they become, judged by about ``sample`` nodes.

    A list that is judged too small is compared whole: the estimate bears on the tasks' sizes, not on the result.
    """
    n = nodes.count()
    share = max(1, n // sample)
    if n <= list_rows:
        return {}
    got = nodes.filter(F.pmod("node", F.lit(share)) == 0).select("fingerprint").toArrow().column(0).to_pylist()
    codes = np.frombuffer(b"".join(got), np.uint8).reshape(len(got), -1)
    key, count = np.unique(list_keys(codes), return_counts=True)
    large = count * share > list_rows
    return {int(k): int(-(-2 * c * share // list_rows)) for k, c in zip(mixed(key[large].astype(np.uint64)), count[large], strict=True)}


def families(nodes: DataFrame, similarity: float = SIMILARITY, list_rows: int = LIST_ROWS) -> DataFrame:
    """(node, family) of the nodes that meet another within reach in some list, and of those these meet."""
    buckets = max(8, -(-nodes.count() // 2000))
    posted = nodes.select("fingerprint", "node").mapInArrow(releasing(_postings(buckets, _large_lists(nodes, list_rows))), "bucket int, key binary, code binary, node binary")
    met = posted.repartition(buckets, "bucket").mapInArrow(releasing(_families(most_bits(similarity, LIST_WORDS, 2.5))), "a long, b long")
    return components(met).withColumnRenamed("component", "family")


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = WIDE_SHINGLE, similarity: float = SIMILARITY, list_rows: int = LIST_ROWS) -> DataFrame:
    """doc_id, k1 and k2 (``row_key``), component, component_id, and ``stays`` for one row key of each component.

    Texts are linked whose distinct shingles have this Jaccard similarity or more.  Fingerprints of
    512 bits only find candidates.  Two such texts share each positional byte with a chance of
    a quarter at 0.8, so they nearly always meet in some of 64 lists by two bytes; unlike the
    search within 4 bits, that is a matter of chance.  Entries that differ in few of 128 bits join
    a family.  Within a family all texts are compared, by all bits, by the sizes of their sets, and what
    remains by the sets themselves, block by block; each block answers with what it joins, so a large
    group does not yield the square of its size.  Texts of equal fingerprints are one node, for
    which one of them stands.

    Defined cases: null and blank texts have no shingles and are one node; texts of fewer words are one
    shingle; repeated rows share key and component; rows with a null id are told apart by their text and
    stay only if no row with an id is in their component; other columns are not read; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = no_clash(docs, id_col, text_col).toDF("doc_id", "text").withColumns(row_key("doc_id", "text"))
    kind = docs.schema[id_col].dataType.simpleString()
    wide = materialise(rows.mapInArrow(releasing(_wide(shingle)), f"doc_id {kind}, k1 long, k2 long, fingerprint binary, size long"), "wide")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("lone"), "doc_id", "k1", "k2", "size")).alias("first")
    nodes = materialise(wide.groupBy("fingerprint").agg(first, F.xxhash64("fingerprint").alias("node")), "nodes")
    family = families(nodes, similarity, list_rows)
    member = nodes.join(family, "node").select("node", "family", "fingerprint", "first.k1", "first.k2", "first.size")
    heavy = member.groupBy("family").agg(F.ceil(F.sum(8 * F.col("size") + 72) / BLOCK_BYTES).alias("blocks"))
    member = materialise(member.join(heavy, "family").drop("size"), "members")

    texts = maybe_in(rows.select("k1", "k2", "text"), member, "k1", "k2").filter("maybe").select("k1", "k2", "text").dropDuplicates(["k1", "k2"])
    texts = texts.join(member, ["k1", "k2"]).select("family", "blocks", "node", "fingerprint", "text")
    sets = materialise(texts.mapInArrow(releasing(_sets(shingle)), "family long, blocks long, node long, fingerprint binary, shingles binary"), "sets")
    dealt = sets.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select(F.xxhash64("family", F.least("own", "other"), F.greatest("own", "other")).alias("block"), "node", "fingerprint", "shingles")
    reach = most_bits(similarity, WIDE_WORDS, 4.0)
    links = dealt.repartition("block").sortWithinPartitions("block").mapInArrow(releasing(_exact(similarity, reach)), "a long, b long")

    joined = components(links)
    discard(member, sets)
    named = nodes.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    chosen = named.groupBy("component").agg(F.min("first").alias("chosen"))
    named = named.select("fingerprint", "component").join(chosen, "component")
    found = wide.join(named, "fingerprint")
    stays = (F.col("k1") == F.col("chosen.k1")) & (F.col("k2") == F.col("chosen.k2"))
    return found.select("doc_id", "k1", "k2", "component", F.col("chosen.doc_id").alias("component_id"), stays.alias("stays"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component of ``similar``, the one with the smallest id.

    Rows of another id or text that stay are not moved: only those that may go are shuffled.
    """
    found = similar(docs, id_col, text_col, **options)
    keys = found.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.first("stays").alias("stays"))
    doubtful = materialise(keys.filter("NOT stays OR n > 1").select("k1", "k2", "stays"), "doubtful")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumns(row_key(f"row.`{id_col}`", f"row.`{text_col}`"))
    marked = maybe_in(whole, doubtful, "k1", "k2")
    unsure = marked.filter("maybe").join(doubtful, ["k1", "k2"], "left")
    unsure = unsure.filter("coalesce(stays, true)").dropDuplicates(["k1", "k2"])
    return marked.filter("NOT maybe").select("row").unionByName(unsure.select("row")).select("row.*")


def op10_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op10_simhash_groups": op10_simhash_groups}
ORACLES = {}
