"""Chat threads, mixing and license scans on small fixtures."""

import hashlib

from sievecraft.llm import chat, licenses, mixing

DOCS = "doc_id long, text string, source string, label string, row string"


def test_quotes_are_linked_and_removed(spark):
    rows = [
        (1, 0, "user", "How do I sort a list?\n\nIt has Many items.", "x"),
        (1, 1, "assistant", "> how do I sort a LIST\n\nUse sorted().", "x"),
        (1, 2, "user", ">> How do I sort a list?\n> Use sorted().\nThanks, and reversed?", "x"),
        (1, 3, "user", "> It has many items.\nHow many?", "x"),
        (1, 4, "user", "> nobody said this\nHm.", "x"),
        (2, 0, "user", None, "x"),
        (2, 1, None, "> \nplain", "x"),
        (None, 0, "user", "> How do I sort a list?", "x"),
        (3, None, "user", "lost", "x"),
        (4, 0, "user", "same", "x"), (4, 0, "user", "same", "x"), (4, 1, "user", "> same\nyes", "x"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string")
    got = chat.conversations(df).collect()
    by = {(r.conv_id, r.turn): r for r in got}
    assert len(got) == len(rows)
    assert by[1, 1].parent_turn == 0 and by[1, 1].depth == 1 and by[1, 1].body == "Use sorted()."
    assert by[1, 2].parent_turn == 1 and by[1, 2].root_turn == 0 and by[1, 2].depth == 2 and by[1, 2].max_level == 2 and by[1, 2].n_linked == 2
    assert by[1, 2].body == "Thanks, and reversed?"
    assert by[1, 3].parent_turn == 0 and by[1, 4].parent_turn is None and by[1, 4].n_passages == 1
    assert by[2, 0].body == "" and by[2, 1].n_linked == 0 and by[None, 0].n_linked == 0 and by[3, None].body == "lost"
    assert by[4, 1].parent_turn == 0
    assert [r.turn for r in got if r.conv_id == 1] == [0, 1, 2, 3, 4]
    assert chat.conversations(df.limit(0)).count() == 0


def brute_mix(rows, weights=(5, 2, 1), epochs=3):
    size = {}
    for _, s, n in rows:
        size[s] = size.get(s, 0) + n
    order = sorted(size, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    capped, whole = set(), sum(size.values())
    while True:
        rest = whole - sum(epochs * size[s] for s in capped)
        free = sum(w[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and rest * w[s] / free > epochs * size[s] + 1e-9}
        if not over:
            return {s: epochs * size[s] if s in capped else rest * w[s] / free for s in order}, size
        capped |= over


def test_mixing_matches_clamp_and_reshare(spark):
    rows = [(i, f"a {'w ' * (i % 7)}", "abc"[i % 3] if i % 11 else None, "l", "r") for i in range(300)] + [(i, "x " * 400, "z", "l", "r") for i in range(5)] + [(7, None, "a", "l", "r"), (None, "one two", "e", "l", "r"), (9, "", "f", "l", "r")]
    df = spark.createDataFrame(rows, DOCS).withColumn("size", mixing.size_of(mixing.F.col("text")))
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    targets, sizes = brute_mix([(r.doc_id, r.source, r.size) for r in got])
    taken = {}
    for r in got:
        assert abs(r.target - targets[r.source]) < 1e-6 and r.source_size == sizes[r.source] and 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - targets[s]) < 1 + 1e-6 for s in targets)
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(df.limit(0)).count() == 0


def brute_license(text):
    import re

    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = pattern.findall(low)
    places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    best, labels = 0.0, {x for _, x in places}
    for kind, cut in (("line", r"\n"), ("paragraph", r"\n[ \t\r]*\n")):
        for block in re.split(cut, low):
            held = set(pattern.findall(block))
            for label, k, wording in licenses.TEMPLATES:
                t = set(wording.split())
                if k == kind and len(t & held) / len(t) >= licenses.THRESHOLD:
                    labels.add(label)
                    best = max(best, len(t & held) / len(t))
    return len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted(labels)), 1.0 if places else best


def test_license_blocks(spark):
    bsd = licenses.TEMPLATES[9][2]
    texts = [
        None, "", "  \n", "Released under the MIT License. Cc by-nc! cc by nc cc  BY nc", "x " * 50000 + "\nApache License, Version 2", bsd[:-30].replace(" use", "\nuse"), "é under the mit licenses",
        "This work is licensed under the GNU General Public License, version 3.", bsd + "\n\n" + licenses.TEMPLATES[7][2], "the work is under version of software license",
    ]
    rows = [(i, t, "s", "l", "r") for i, t in enumerate(texts)] + [(3, texts[3], "s", "l", "r"), (None, "cc by nc", None, "l", "r")]
    got = licenses.scan(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    want = sorted(str((i, *brute_license(t))) for i, t, *_ in rows)
    assert sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.labels, r.score)) for r in got) == want
    assert licenses.scan(spark.createDataFrame([], DOCS)).count() == 0


def test_seeded_order_is_a_digest(spark):
    assert spark.range(1).select(mixing.order_of(mixing.F.lit(5), 42)).first()[0] == hashlib.md5(b"42:5").hexdigest()
