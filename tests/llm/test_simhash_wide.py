import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from marketlane.llm import simhash_wide as wide
from marketlane.llm.common import table
from tests.llm.frames import ODD, documents

ONES = 2**64 - 1


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[k : k + size]) for k in range(len(words) - size + 1)} or ({" ".join(words)} if words else set())


def plain_print(text):
    """128 bits as one number, the low half first."""
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text)]
    more = []
    for h in hashes:
        z = (h + 0x9E3779B97F4A7C15) & ONES
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & ONES
        z = (z ^ z >> 27) * 0x94D049BB133111EB & ONES
        more.append(z ^ z >> 31)
    bits = lambda hs: sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    return bits(hashes) | bits(more) << 64


def meet(x, y):
    """Whether two prints share a table entry: one differing bit, or two of which each has one, in some segment."""
    for offset in range(0, 128, wide.STEP):
        ring = lambda v: (v >> offset | v << 128 - offset) & (1 << wide.SEGMENT) - 1
        a, b = ring(x), ring(y)
        if bin(a & ~b).count("1") <= 1 and bin(b & ~a).count("1") <= 1:
            return True
    return False


def similarity(x, y):
    return len(x & y) / (len(x | y) or 1)


def linked_pairs(rows):
    """Roots of the rows by all pairs of prints, and all pairs of similar texts beside."""
    prints = [plain_print(t) for _, t in rows]
    sets = [shingles(t) for _, t in rows]
    halves = np.array([[p & ONES, p >> 64] for p in prints], dtype=np.uint64)
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k in range(len(rows)):
        apart = np.bitwise_count(halves[k + 1 :] ^ halves[k]).sum(axis=1)
        for j in (np.flatnonzero(apart <= wide.RADIUS) + k + 1).tolist():
            if prints[j] == prints[k] or meet(prints[j], prints[k]) and similarity(sets[j], sets[k]) >= wide.SIMILARITY:
                root[find(j)] = find(k)
    return [find(k) for k in range(len(rows))]


def plain_first(rows):
    groups = {}
    for row, root in zip(rows, linked_pairs(rows)):
        groups.setdefault(root, []).append(row)
    return [min(own, key=lambda r: (r[0] is None, r[0] or 0)) for own in groups.values()]


def edited(rng, words, changes):
    words = list(words)
    for k in rng.choice(len(words), changes, replace=False):
        words[k] = f"new{rng.integers(1 << 30)}"
    return " ".join(words)


def copies(seed, groups=8, each=14):
    """Groups whose members differ from the first and from each other by edits around the threshold."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        words = [f"w{rng.integers(1 << 30)}" for _ in range(300)]
        for _ in range(each):
            rows.append((len(rows), edited(rng, words, int(rng.integers(0, 9)))))
    return rows


def kept_ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_groups_equal_all_candidates(spark):
    rows = copies(1)
    assert kept_ids(wide.keep_first(documents(spark, rows))) == sorted(i for i, _ in plain_first(rows))


def test_blocks_join_what_all_pairs_join(spark):
    """One tree of many refused pairs, in one block and in many: never more links than members of a block pair."""
    rows = copies(2, groups=1, each=60)
    prints = [plain_print(t) for _, t in rows]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    made = [(k, signed(p & ONES), signed(p >> 64), 0, k, sorted(signed(xxhash.xxh64_intdigest(g.encode(), 42)) for g in shingles(t))) for k, (p, (_, t)) in enumerate(zip(prints, rows))]
    members = spark.createDataFrame(made, "node long, low long, high long, root long, label long, grams array<long>")
    want = linked_pairs(rows)
    for block in (wide.BLOCK, 40_000):
        links = [(r["a"], r["b"]) for r in wide.joining(members, wide.SIMILARITY, block=block).collect()]
        root = list(range(len(rows)))
        for a, b in links:
            root = [root[a] if r == root[b] else r for r in root]
        assert len({*zip(root, want)}) == len(set(root)) == len(set(want)) < len(rows)
        if block == wide.BLOCK:
            assert len(links) == len(rows) - len(set(want))


def test_links_of_a_large_group_are_few(spark, monkeypatch):
    """Of one group that meets in many runs, no more rows are compared or followed than a few per member."""
    rng = np.random.default_rng(9)
    words = [f"w{rng.integers(1 << 30)}" for _ in range(300)]
    rows = [(k, edited(rng, words, int(rng.integers(0, 9)))) for k in range(300)]
    sizes = {"components": [], "checked": []}
    for name, seen in sizes.items():
        true = getattr(wide, name)
        monkeypatch.setattr(wide, name, lambda links, *more, true=true, seen=seen: (seen.append(links.count()), true(links, *more))[1])
    assert kept_ids(wide.keep_first(documents(spark, rows))) == sorted(i for i, _ in plain_first(rows))
    assert all(n <= 3 * len(rows) for seen in sizes.values() for n in seen) and len(sizes["checked"]) == 1


def test_whole_table_equals_brute_force(spark, small):
    docs = table(spark, small, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert kept_ids(wide.keep_first(docs)) == sorted(i for i, _ in plain_first(rows))


def test_similar_texts_share_a_group(spark):
    """Pairs of similarity 0.8 to 1, found or not: at least nine of ten."""
    rng = np.random.default_rng(5)
    rows, sets = [], []
    for _ in range(150):
        words = [f"w{rng.integers(1 << 30)}" for _ in range(300)]
        for text in (" ".join(words), edited(rng, words, int(rng.integers(1, 7)))):
            rows.append((len(rows), text))
            sets.append(shingles(text))
    first = {r["doc_id"]: r["first"]["doc_id"] for r in wide.grouped(documents(spark, rows)).collect()}
    near = [k for k in range(0, len(rows), 2) if similarity(sets[k], sets[k + 1]) >= 0.8]
    together = [k for k in near if first[k] == first[k + 1]]
    assert len(near) > 100 and len(together) >= 0.9 * len(near)
    assert all(first[k] != first[k + 1] for k in range(0, len(rows), 2) if k not in near)


def test_odd_rows_and_columns(spark):
    docs = documents(spark, ODD).withColumn("a.b", F.lit(1)).withColumn("m", F.create_map(F.lit("k"), F.lit(2)))
    kept = wide.keep_first(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert len(got) == len(plain_first(ODD))
    assert (1, None) in got and (6, ODD[8][1]) in got and (7, ODD[9][1]) not in got and (5, None) not in got
    assert wide.keep_first(docs.limit(0)).count() == 0
