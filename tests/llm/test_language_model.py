import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from marketlane.llm import language_model as lm
from marketlane.llm.common import table
from marketlane.llm.elias_fano import EliasFano, TrieLevel
from marketlane.llm.queries import op8_lm_scoring
from tests.llm.frames import ODD, documents


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (5, 6), (1000, 1200), (1000, 1 << 50), (3000, 1 << 62)])
def test_sequences_round_trip(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
    s = EliasFano.of(values)
    assert (s[np.arange(n)] == values).all()
    asked = np.concatenate([values, rng.integers(0, top, 500, dtype=np.uint64), np.array([0, top + 5], dtype=np.uint64)])
    at, equal = s.find(asked)
    assert (equal == np.isin(asked, values)).all()
    assert (at[equal] == np.searchsorted(values, asked[equal])).all()


def test_level_answers_from_a_memory_map():
    rng = np.random.default_rng(2)
    contexts = np.unique(rng.integers(0, 1 << 62, 300, dtype=np.uint64))
    sizes = rng.integers(1, 9, len(contexts))
    words = np.concatenate([np.sort(rng.choice(2000, k, replace=False)) for k in sizes]).astype(np.uint64) << np.uint64(25)
    codes, weights = rng.integers(0, 60000, len(words)).astype("<u2"), rng.integers(0, 60000, len(contexts)).astype("<u2")
    level = TrieLevel.of(contexts, sizes, words, codes, weights).mapped()
    place = level.context(contexts)
    assert (place == np.arange(len(contexts))).all() and (level.context(contexts + np.uint64(1)) == -1).all()
    assert (level.successor(np.repeat(place, sizes), words) == np.arange(len(words))).all()
    own = {(c, w) for c, w in zip(np.repeat(place, sizes).tolist(), words.tolist())}
    for c in range(0, len(contexts), 17):
        for w in words[::23].tolist():
            at = level.successor(np.array([c]), np.array([w], dtype=np.uint64))[0]
            assert (at >= 0) == ((c, w) in own)
    begin, end = level.range(place)
    assert (end - begin == sizes).all() and (level.codes == codes).all() and (level.weights == weights).all()


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def plain(rows, order):
    train = [tokens(t) for i, t in rows if not held(i)]
    counts = [Counter() for _ in range(order + 1)]
    for words in train:
        padded = ["<s>"] * (order - 1) + words
        for k in range(order - 1, len(padded)):
            for m in range(1, order + 1):
                counts[m][tuple(padded[k - m + 1 : k + 1])] += 1
    n, v = sum(counts[1].values()), len(counts[1])
    take = {m: lm.discounts(np.array(list(counts[m].values()) or [0])) for m in range(2, order + 1)}
    total, removed = Counter(), Counter()
    for m in range(2, order + 1):
        for gram, c in counts[m].items():
            total[gram[:-1]] += c
            removed[gram[:-1]] += take[m][min(c, 3) - 1]
    for i, text in rows:
        words = tokens(text)
        padded = ["<s>"] * (order - 1) + words
        base = score = known = 0
        for k in range(order - 1, len(padded)):
            c = counts[1][padded[k],]
            known += c > 0
            p = (c + 1) / (n + v + 1)
            base += math.log10(p)
            for m in range(2, order + 1):
                gram = tuple(padded[k - m + 1 : k + 1])
                if total[gram[:-1]]:
                    c = counts[m][gram]
                    own = (c - take[m][min(c, 3) - 1]) if c else 0
                    p = (own + removed[gram[:-1]] * p) / total[gram[:-1]]
            score += math.log10(p)
        yield i, held(i), len(words), known, n, base, score


def close(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 4))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)
        assert abs(a[6] - b[6]) <= a[2] / (2 * lm.STEPS) + 1e-6  # half a step of each token's code


@pytest.mark.parametrize("order", [2, 3])
def test_one_shard_equals_plain_counting(spark, small, order):
    docs = table(spark, small, "documents")
    close(lm.scores(docs, order).collect(), list(plain([(r["doc_id"], r["text"]) for r in docs.collect()], order)))


def test_more_shards_change_only_the_discounts(spark, small):
    docs = table(spark, small, "documents")
    one = {r["doc_id"]: r for r in lm.scores(docs).collect()}
    for r in lm.scores(docs, group_bytes=60_000).collect():
        assert tuple(r)[:5] == tuple(one[r["doc_id"]])[:5]
        assert r["base_score"] == pytest.approx(one[r["doc_id"]]["base_score"])
        assert r["score"] == pytest.approx(one[r["doc_id"]]["score"], rel=0.05, abs=0.5)


def test_held_out_texts_score_better_than_the_base(spark, small):
    rows = [r for r in lm.scores(table(spark, small, "documents")).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    close(lm.scores(docs).collect(), list(plain(ODD, 2)))
    assert lm.scores(docs.limit(0)).count() == 0
    only_held = next(k for k in range(1000) if held(k))
    rows = lm.scores(documents(spark, [(only_held, "some words")])).collect()
    assert [tuple(r) for r in rows] == [(only_held, True, 3, 0, 0, 0.0, 0.0)]


def test_model_is_kept_as_levels(spark, small):
    rows = lm.tries(table(spark, small, "documents"), group_bytes=200_000).collect()
    assert rows and all(TrieLevel.from_buffer(bytes(r["trie"])).contexts.n > 0 for r in rows)


def prose(n=300):
    """Texts of few words, so that n-grams of every length repeat, some texts twice."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{int(w)}" for w in rng.zipf(1.3, rng.integers(1, 60)) % 40) for _ in range(n)]
    return list(enumerate(texts + texts[:40]))


def test_query_scores_by_trigrams_of_the_whole_corpus(spark, tmp_path):
    documents(spark, prose()).write.parquet(f"{tmp_path}/documents.parquet")
    close(op8_lm_scoring(spark, str(tmp_path)).collect(), list(plain(prose(), 3)))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_the_cut_changes_no_score(spark, order):
    docs = documents(spark, prose())
    one = {r["doc_id"]: tuple(r) for r in lm.scores(docs, order).collect()}
    for r in lm.scores(docs, order, group_bytes=2_000).collect():
        assert tuple(r) == pytest.approx(one[r["doc_id"]], rel=1e-9)


def test_kept_levels_hold_one_set_of_discounts(spark):
    docs = documents(spark, prose())
    kept = {}
    for size in (1 << 20, 2_000):
        found = [(r["level"], TrieLevel.from_buffer(bytes(r["trie"]))) for r in lm.tries(docs, 3, size).collect()]
        kept[size] = sorted((k, *map(int, x)) for k, t in found for x in zip(t.contexts[np.arange(t.contexts.n)], t.weights))
    assert {k for k, *_ in kept[2_000]} == {2, 3}
    assert kept[2_000] == kept[1 << 20]


def test_sequences_answer_few_and_many_alike():
    rng = np.random.default_rng(5)
    values = np.sort(rng.integers(0, 1 << 40, 2000, dtype=np.uint64))
    s = EliasFano.of(values)
    asked = np.concatenate([values[::3], rng.integers(0, 1 << 41, 4000, dtype=np.uint64)])
    at, equal = s.find(asked)
    few = [s.find(part) for part in np.array_split(asked, 50)]
    assert (equal == np.concatenate([e for _, e in few])).all() and (at[equal] == np.concatenate([a for a, _ in few])[equal]).all()
