"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

1. toxicity: documents whose score reaches the threshold go.
2. SimHash near-dedup: of each group of texts of an exact Jaccard similarity of five-word
   shingles of 0.8 or more, the one with the smallest id stays.
3. suffix-array dedup: runs of over 50 words that occur elsewhere are cut out, and so are
   strings of 400 bytes and more; a document goes if nothing but white space is left
   of its text.
4. benchmark decontamination: spans of benchmark windows are cut out; a document goes
   if no word is left of its text.
5. mixing: documents with the words that the mix takes of them; documents it takes
   nothing of go.

All stages but the last return the columns of ``documents``, with ``n_chars`` of the
text as it is then.  Documents without a finding keep their text unchanged.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievecraft.llm import decontamination, mixing, simhash, substring_dedup, toxicity
from sievecraft.llm.common import delete, releasing, shared_folder, sweep, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REST = COLUMNS[2:]
#: Repeated runs of so many words are cut out.
PASSAGE_WORDS = 51
#: A character of a word, before lower-casing.
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, keep=REST, with_text=True)
    return scored.filter(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group, the document with the smallest id stays; rows without an id only where their group has none with one."""
    return simhash.one_of_each(docs.select(*COLUMNS))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = substring_dedup.dedup(docs, words=PASSAGE_WORDS, keep=REST, with_text=True)
    cut = (F.col("n_removed") > 0) | (F.col("n_run_words") > 0)
    left = left.filter(~cut | F.col("kept").rlike(mixing.TOKEN))
    return left.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.when(cut, F.length("kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def _without_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = []
        for text, spans in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("spans").to_pylist(), strict=True):
            if spans:
                edges = [0, *(x for s in spans for x in (s["first_byte"], s["end_byte"])), len(text)]
                text = b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
            texts.append(None if text is None else text.decode("utf-8", "ignore"))
        at = b.schema.get_field_index("text")
        out = b.set_column(at, "text", pa.array(texts, pa.string()))
        yield out.drop_columns(["spans"]).append_column("cut", pa.array([bool(s) for s in b.column("spans").to_pylist()]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontamination.scan(docs.withColumn("whole", F.col("text")), table(spark, sf_dir, "benchmark"), keep=("whole", *REST))
    found = found.select("doc_id", F.col("whole").alias("text"), *REST, "spans")
    clean = found.mapInArrow(releasing(_without_spans), "doc_id long, text string, lang string, source string, n_chars long, cut boolean")
    clean = clean.filter(~F.col("cut") | F.col("text").rlike(ANY_WORD))
    return clean.select("doc_id", "text", "lang", "source", F.when(F.col("cut"), F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    sized = docs.select("doc_id", "source", "lang", mixing.size_of(F.col("text")).alias("size"))
    return mixing.mix(sized).filter("taken > 0").select("doc_id", "source", "lang", "size", "source_size", "target", "taken")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _swept(stage: Stage) -> Stage:
    """A stage that first deletes the tables of the stage before, whose result is written by then."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        sweep(spark, _left)
        before = written()
        out = stage(spark, docs, sf_dir)
        _left[:] = [x for x in written() if x not in before]
        return out

    return run


_left: list[str] = []
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _swept(reject_toxic)),
    ("SimHash near-dedup", _swept(drop_near_copies)),
    ("suffix-array dedup", _swept(cut_repeated_passages)),
    ("benchmark decontamination", _swept(decontaminate)),
    ("mixing sources to target weights", _swept(mix)),
]
#: No stage but the last can be put into SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each one's result is written to the shared folder and read again.

    Only the last result is left there: a stage's input goes when its output is written.
    """
    docs, folder, before = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/tables/pipeline-{uuid.uuid4().hex}", None
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
