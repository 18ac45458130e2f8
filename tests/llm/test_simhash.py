import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from marketlane.llm import simhash
from marketlane.llm.common import table
from tests.llm.frames import ODD, documents


def plain_fingerprint(text, size=3):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, distance=3):
    values = sorted(set(fps))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    array = np.array(values, dtype=np.uint64)
    for k, v in enumerate(values):
        for near in array[k + 1 :][np.bitwise_count(array[k + 1 :] ^ np.uint64(v)) <= distance].tolist():
            a, b = find(v), find(near)
            root[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


def expected(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(fps)
    least = defaultdict(lambda: None)
    for (i, _), fp in zip(rows, fps):
        if i is not None and (least[roots[fp]] is None or i < least[roots[fp]]):
            least[roots[fp]] = i
    return [(i, f"{fp:016x}", least[roots[fp]]) for (i, _), fp in zip(rows, fps)]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


def test_whole_table_equals_brute_force(spark, small):
    docs = table(spark, small, "documents")
    want = expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert in_order(simhash.near_duplicates(docs).collect()) == in_order(want)


def test_odd_rows(spark):
    docs = documents(spark, ODD)
    assert in_order(simhash.near_duplicates(docs).collect()) == in_order(expected(ODD))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("max_run", [1 << 14, 4])
def test_links_keep_dense_groups_connected(spark, max_run):
    rng = np.random.default_rng(max_run)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64) * np.uint64(2)
    fps = set()
    for c in centres.tolist():
        for _ in range(60):
            flips = rng.choice(64, int(rng.integers(0, 5)), replace=False)
            fps.add(c ^ sum(1 << int(b) for b in flips))
    signed = [(int(np.uint64(v).view(np.int64)),) for v in fps]
    links = simhash.fingerprint_links(spark.createDataFrame(signed, "fp long"), max_run=max_run).collect()
    for r in links:
        assert bin((r["a"] ^ r["b"]) & (1 << 64) - 1).count("1") <= 3
    assert len(links) < 40 * len(fps)
    found = {v: v for v in fps}

    def find(v):
        while found[v] != v:
            v = found[v]
        return v

    for r in links:
        a, b = find(r["a"] & (1 << 64) - 1), find(r["b"] & (1 << 64) - 1)
        found[max(a, b)] = min(a, b)
    assert {v: find(v) for v in fps} == plain_components(fps)


def test_long_chains_are_one_component(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 2000)], "a long, b long")
    roots = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    assert all(roots[k] == 0 for k in range(301)) and roots[2000] == 1000
    assert simhash.components(links.limit(0)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark, ODD)
    kept = in_order((r["doc_id"], r["text"]) for r in simhash.keep_first(docs, size=5).collect())
    assert simhash.keep_first(docs).columns == docs.columns
    groups = {(i, t): g for (i, t), (_, _, g) in zip(ODD, expected_of_size(ODD, 5))}
    assert len(kept) == len(set(groups.values()))
    assert (1, None) in kept and (6, ODD[8][1]) in kept and (7, ODD[9][1]) not in kept and (5, None) not in kept


def expected_of_size(rows, size):
    fps = [plain_fingerprint(t, size) for _, t in rows]
    roots = plain_components(fps)
    return [(i, fp, roots[fp]) for (i, _), fp in zip(rows, fps)]
