"""The corpus pipeline on planted cases, against plain Python for what it must keep and remove."""

import random
import re

import corpus_pipeline as cp

from sievecraft.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_planted_cases(spark, tmp_path):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    docs, marks = {}, {}
    for i in range(200):
        docs[i] = text(rng.randint(60, 200))
        marks[i] = 0
    for i in range(200, 280):  # toxic ones
        words = text(80).split()
        for _ in range(4):
            words[rng.randrange(80)] = rng.choice(["vermin", "wretch"])
        docs[i], marks[i] = " ".join(words), 1
    for i in range(280, 290):  # exact copies, near copies
        docs[i] = docs[i - 280]
    for i in range(290, 300):
        words = docs[i - 280].split()
        words[len(words) // 2] = "changed"
        docs[i] = " ".join(words)
    passage = text(80)
    for i in range(300, 306):
        docs[i] = f"{text(60)} {passage} {text(60)}"
    item = text(30)
    for i in range(306, 310):
        docs[i] = f"{text(60)} {item} {text(60)}"
    docs[400], docs[401], docs[402] = None, "", "   \n"
    rows = [(i, t, "en", f"s{i % 3}" if i % 50 else None, len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, y) for i, y in marks.items()], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    state, after = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, state, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        state = spark.read.parquet(str(tmp_path / f"out{k}"))
        after.append(state.collect())
        if k < 4:
            assert tuple(state.columns) == cp.COLUMNS
    kept = [{r.doc_id: r.text for r in a} for a in after[:4]]
    assert not kept[0].keys() & set(range(200, 280)) and set(range(200)) <= kept[0].keys()
    assert set(range(200)) <= kept[1].keys() and not kept[1].keys() & set(range(280, 300)) and len(kept[1].keys() & {400, 401, 402}) == 1
    assert all(passage not in kept[2][i] for i in range(300, 306)) and all(kept[2][i] == docs[i] for i in range(200))
    assert all(item not in kept[3][i] and len(kept[3][i]) > 300 for i in range(306, 310)) and all(kept[3][i] == docs[i] for i in range(200))
    taken = {r.doc_id: r for r in after[4]}
    sizes = {}
    for r in after[3]:
        sizes[r.source] = sizes.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    got = {}
    for r in taken.values():
        assert 0 < r.taken <= 3 * r.size
        got[r.source] = got.get(r.source, 0) + r.taken
    assert all(abs(got.get(s, 0) - min(r.target for r in taken.values() if r.source == s)) <= 1 for s in got)
    again = cp.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, again)) == sorted(map(str, after[4]))


def test_similar_texts(spark):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(4000)}" for _ in range(200)] for _ in range(30)]
    rows = []
    for i, words in enumerate(base):
        near = list(words)
        for k in rng.sample(range(200), 3):
            near[k] = "changed"
        rows += [(2 * i, " ".join(words), "en", "s", 0), (2 * i + 1, " ".join(near), "en", "s", 0)]
    got = {r.doc_id: r.component_id for r in simhash.similar(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sum(got[2 * i + 1] == 2 * i for i in range(30)) >= 28 and all(got[2 * i] == 2 * i for i in range(30))


def test_passages_of_51_words_are_cut(spark):
    rng = random.Random(12)
    text = lambda n: " ".join("".join(rng.choices("abcdefghijklm", k=rng.randint(1, 7))) for _ in range(n))
    passage, fewer = text(51), text(50)
    texts = [f"{text(60)} {p} {text(60)}" for p in (passage, passage, fewer, fewer)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r.text for r in cp.cut_repeated_passages(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert len(passage.encode()) < 400
    assert [got[i] for i in range(4)] == [texts[i].replace(passage, "") if i < 2 else texts[i] for i in range(4)]


def test_odd_documents(spark, tmp_path):
    rng = random.Random(21)
    text = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n))
    copied, long = text(70), text(30_000)
    docs = [(1, copied), (2, copied), (3, text(80)), (3, text(80)), (None, text(60)), (None, copied), (4, None), (5, ""), (6, long), (7, long + " end"), (8, text(90)), (8, text(5))]
    repeated = (9, text(75))
    rows = [(i, t, "en", None if i == 3 else "s", len(t or ""), i, True) for i, t in [*docs, repeated, repeated]]
    schema = f"{SCHEMA}, k1 long, maybe boolean"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    state, after = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, state, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        state = spark.read.parquet(str(tmp_path / f"out{k}"))
        after.append(state.collect())
    assert len(after[0]) == len(rows)  # no labels: nothing is rejected
    kept = sorted((r.doc_id or 0, r.text or "") for r in after[1])
    assert kept == sorted([(1, copied), *[(3, t) for i, t in docs if i == 3], (0, docs[4][1]), (4, ""), (6, long), *[(8, t) for i, t in docs if i == 8], repeated])
    assert sorted((r.doc_id or 0, r.text or "") for r in after[3]) == kept
    assert {r.doc_id for r in after[4]} <= {None, 1, 3, 6, 8, 9}
    empty = spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0)
    for k, (_, stage) in enumerate(cp.STAGES):
        empty = stage(spark, empty, str(tmp_path))
        empty.write.parquet(str(tmp_path / f"none{k}"))
        empty = spark.read.parquet(str(tmp_path / f"none{k}"))
        assert empty.count() == 0
