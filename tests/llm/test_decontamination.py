import random

import numpy as np
import pytest

from marketlane.llm import decontamination as d
from marketlane.llm.common import table
from tests.llm.frames import ODD, documents


def plain_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            h[i + 1, j + 1] = max(0, h[i, j] + (d.MATCH if x == y and x > 0 else d.MISMATCH), h[i, j + 1] + d.GAP, h[i + 1, j] + d.GAP)
    return h.max()


def test_alignment_equals_the_plain_table():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = rng.integers(1, 6, rng.integers(1, 12)), rng.integers(0, 6, rng.integers(0, 20))
        score, first, last = d.align(a, b)
        assert score == plain_align(a, b)
        if score:
            assert plain_align(a, b[first : last + 1]) == score


def plain_hits(docs, items):
    """Every document against every item, whole tables."""
    vocabulary = {}
    number = lambda t: np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in d.plain_words((t or "").encode())], dtype=int)
    found = []
    held = [(i, number(t)) for i, t in items if t is not None]
    for doc_id, text in docs:
        words = number(text)
        for item_id, item in held:
            if len(item) >= d.MIN_WORDS and np.isin(item, words).mean() >= d.MIN_SCORE:
                share = d.align(item, words)[0] / (d.MATCH * len(item))
                if share >= d.MIN_SCORE:
                    found.append((doc_id, item_id, round(share, 9)))
    return sorted(found, key=lambda r: (r[0] is None, r))


def got(docs, items, **options):
    rows = d.contaminated(docs, items, **options).collect()
    return sorted(((r["doc_id"], r["item_id"], round(r["score"], 9)) for r in rows), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("block_words", [d.BLOCK_WORDS, 300])
def test_whole_table_equals_brute_force(spark, small, block_words):
    docs, items = table(spark, small, "documents"), table(spark, small, "benchmark")
    want = plain_hits([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert want and got(docs, items, block_words=block_words) == want


def test_edited_copies_are_found_and_clean_documents_are_not(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(400)] + ["the", "of", "and"] * 60
    items = [(k, " ".join(rng.choices(words, k=rng.randint(20, 60)))) for k in range(20)]
    docs = []
    for k in range(60):
        text = rng.choices(words, k=200)
        if k % 2:
            copy = items[k % 20][1].split()
            for at in range(3, len(copy), 7):
                copy[at] = "changed"
            if k % 3 == 0:
                del copy[len(copy) // 2]
            text[50:50] = copy
        docs.append((k, " ".join(text)))
    frame = spark.createDataFrame(items, "item_id long, text string")
    hits = d.contaminated(documents(spark, docs), frame).collect()
    assert sorted({(r["doc_id"], r["item_id"]) for r in hits}) == [(k, k % 20) for k in range(60) if k % 2]
    left = d.without_contaminated(documents(spark, docs), frame)
    assert sorted(r["doc_id"] for r in left.collect()) == [k for k in range(60) if k % 2 == 0]


def test_odd_rows(spark):
    rows = [*ODD, (20, "x " + ODD[5][1]), (20, "x " + ODD[5][1])]
    own = [(1, ODD[5][1], 1.0), (1, ODD[5][1], 1.0), (2, None, 1.0), (3, "", 1.0), (None, "too short", 1.0)]
    docs, items = documents(spark, rows), spark.createDataFrame(own, "item_id long, text string, score double")
    want = plain_hits(rows, [r[:2] for r in own])
    assert got(docs, items) == want and {r[:2] for r in want} == {(4, 1), (20, 1), (None, 1)}  # the last shares two thirds
    assert got(docs.limit(0), items) == [] and got(docs, items.limit(0)) == []
    kept = d.without_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == len(ODD) - 2


def test_copies_without_a_long_unbroken_run_are_found(spark):
    """No exact copy is present, so the broken pairs occur nowhere; the last kind keeps no run of three words."""
    rng = random.Random(11)
    items = [(k, " ".join(f"i{k}w{rng.randrange(4000)}" for _ in range(rng.randint(5, 60)))) for k in range(24)]

    def edited(words, step, insert):
        return " ".join(f"{w} new{at}" if insert and at % step == step - 1 else f"new{at}" if at % step == step - 1 else w for at, w in enumerate(words))

    docs = []
    for k, text in items:
        words = text.split()
        for kind, copy in enumerate((edited(words, 5, False), edited(words, 6, False), edited(words, 2, True), edited(words, 1, True))):
            docs.append((4 * k + kind, f"{' '.join(rng.choices('the of and to'.split(), k=40))} {copy} the end of it"))
    frame = spark.createDataFrame(items, "item_id long, text string")
    want = plain_hits(docs, items)
    assert {(4 * k + kind, k) for k in range(24) for kind in (0, 1, 2)} <= {r[:2] for r in want}
    assert got(documents(spark, docs), frame) == want


def test_a_five_word_item_without_a_pair_is_found(spark):
    frame = spark.createDataFrame([(1, "one two three four five")], "item_id long, text string")
    docs = [(1, "one a two b three c four d five"), (2, "one two three"), (3, "five four three two one")]
    assert got(documents(spark, docs), frame) == plain_hits(docs, [(1, "one two three four five")]) == [(1, 1, 0.6), (2, 1, 0.6)]
