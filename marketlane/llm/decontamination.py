"""Benchmark decontamination: word pairs find candidates, Smith-Waterman alignment decides.

A score of ``min_score`` can't be reached without a certain number of an item's
neighbouring word pairs standing unbroken in the passage: of ``m`` matches with
``e`` penalties at least ``m - e - 1`` pairs are whole, and ``2 m - e`` is the
score.  Items too short for one sure pair are looked up by single words.  Up to
half of that number, the most frequent ones over all documents, need not be
looked up if as many fewer are asked for, so no copy is lost and common pairs
cost little.  A document that has enough of them close to one diagonal is
aligned with the item there, in the task that found it: nothing is shuffled but
counts.  Items come in blocks of bounded size, one pass over the documents
each, so that what is broadcast does not grow with the test set.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marketlane.llm.common import Memo, slices, texts, written

#: Alignment score, as a share of the item's score against itself, from which a passage counts as a copy.
MIN_SCORE = 0.6
#: Items of fewer words match by chance and are left out.
MIN_WORDS = 5
#: Words of one block of items.
BLOCK_WORDS = 500_000
#: Places of seeds in texts that are held at once.
HELD = 2_000_000

MATCH, MISMATCH, GAP = 2, -1, -1
#: Marks at the ends of most words; they are no letters or digits.
MARKS = ".,;:!?|*#%&$\"'()"

HITS = "doc_id long, item_id long, score double, first_word int, last_word int"


def plain_word(chunk: bytes) -> str:
    """Letters and digits of a white-space separated chunk in lower case."""
    word = chunk.decode("utf-8", "replace").lower().strip(MARKS)
    return word if word.isalnum() else re.sub(r"[\W_]+", "", word)


def plain_words(text: bytes) -> list[str]:
    return [w for w in map(plain_word, text.split()) if w]


NOTHING = np.zeros(1, dtype=np.int64)


def gram_keys(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit keys of the runs of ``size`` word numbers; those that hold an unknown word (0) are 0."""
    if len(words) < size:
        return np.empty(0, dtype=np.uint64)
    key = np.zeros(len(words) - size + 1, dtype=np.uint64)
    known = np.ones(len(key), dtype=bool)
    for k in range(size):
        part = words[k : len(words) - size + 1 + k]
        known &= part > 0
        key = (key ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return np.where(known, np.maximum(key, np.uint64(1)), np.uint64(0))


def sure_grams(n: int, min_score: float) -> tuple[int, int]:
    """``size, number``: how many pairs (or, where no pair is sure, words) of an item of ``n`` words every passage that scores enough keeps."""
    pairs = math.ceil((2 * min_score - 1) * n - 1 - 1e-9)
    return (2, pairs) if pairs >= 1 else (1, max(1, math.ceil(min_score * n - 1e-9)))


@dataclass
class Items:
    """One block of items: word numbers and, once counted, the seeds with their places."""

    ids: list[int]
    min_score: float = MIN_SCORE
    vocabulary: dict[str, int] = field(default_factory=dict)
    words: list[np.ndarray] = field(default_factory=list)
    sure: list[tuple[int, int]] = field(default_factory=list)
    grams: np.ndarray | None = None
    seeds: np.ndarray | None = None
    seed_item: np.ndarray | None = None
    seed_place: np.ndarray | None = None
    need: np.ndarray | None = None
    memo: Memo | None = None

    @classmethod
    def of(cls, rows: list[tuple[int, list[str]]], min_score: float = MIN_SCORE) -> Items:
        items = cls([r[0] for r in rows], min_score)
        for _, words in rows:
            numbers = [items.vocabulary.setdefault(w, len(items.vocabulary) + 1) for w in words]
            items.words.append(np.array(numbers, dtype=np.int64))
        items.sure = [sure_grams(len(w), min_score) for w in items.words]
        keys = [gram_keys(w, size) for w, (size, _) in zip(items.words, items.sure)]
        items.grams = np.unique(np.concatenate(keys)) if keys else np.empty(0, dtype=np.uint64)
        return items

    @property
    def sizes(self) -> list[int]:
        return sorted({size for size, _ in self.sure})

    @property
    def shifts(self) -> np.ndarray:
        """By how many words gaps can shift a passage that scores enough against each item."""
        return np.array([int(MATCH * len(w) * (1 - self.min_score) + 1e-9) // -GAP for w in self.words], dtype=np.int64)

    def choose_seeds(self, counts: np.ndarray):
        """All grams of each item that occur, but for the most frequent ones that may be missed; ``need`` of them must meet."""
        found, need = [], []
        for item, (words, (size, sure)) in enumerate(zip(self.words, self.sure)):
            keys = gram_keys(words, size)
            rarity = counts[np.searchsorted(self.grams, keys)]
            left_out = sure // 2
            places = np.argsort(rarity, kind="stable")[: len(keys) - left_out]
            found += [(int(keys[p]), item, int(p)) for p in places if rarity[p] > 0]
            need.append(sure - left_out)
        found.sort()
        self.seeds = np.array([f[0] for f in found], dtype=np.uint64)
        self.seed_item = np.array([f[1] for f in found], dtype=np.int64)
        self.seed_place = np.array([f[2] for f in found], dtype=np.int64)
        self.need = np.array(need, dtype=np.int64)

    def numbers(self, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of several texts, 0 for words that no item has and after each text; where each text begins."""
        if self.memo is None:
            self.memo = Memo(self._number, 300_000)  # kept with the block: the worker's next task goes on with it
        memo, texts_of = self.memo, []
        for text in docs:
            own = np.array([memo[c] for c in text.split()], dtype=np.int64)
            texts_of += [own[own >= 0], NOTHING]  # chunks without letters or digits are no words
        sizes = [len(a) + 1 for a in texts_of[::2]]
        return np.concatenate(texts_of), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    def _number(self, chunk: bytes) -> int:
        word = plain_word(chunk)
        return self.vocabulary.get(word, 0) if word else -1


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman over words: best score, and first and last word of the passage that it covers.

    One row of the table per word of the item; gaps along the passage are a
    running maximum, so a row is a few array operations.
    """
    n = len(passage)
    steps = np.arange(n + 1) * -GAP
    score, origin = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
    best = (0, 0, -1)
    for word in item:
        diagonal = score[:-1] + np.where((passage == word) & (word > 0), MATCH, MISMATCH)
        above = score[1:] + GAP
        fresh = np.concatenate([[0], np.maximum(np.maximum(diagonal, above), 0)])
        start = np.concatenate([[0], np.where(diagonal >= above, origin[:-1], origin[1:])])
        start = np.where(fresh > 0, start, np.arange(n + 1))
        raised = fresh + steps
        left = np.maximum.accumulate(raised)
        source = np.maximum.accumulate(np.where(raised == left, np.arange(n + 1), 0))
        origin, score = start[source], left - steps
        top = int(score.argmax())
        if score[top] > best[0]:
            best = (int(score[top]), int(origin[top]), top - 1)
    return best


def candidates(items: Items, numbers: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int, list[list[int]]]]:
    """``text, item, spans``: where enough seeds of an item stand close to one diagonal; ``begins`` are the places of the texts."""
    places = []
    for size in items.sizes:
        keys = gram_keys(numbers, size)
        at = np.flatnonzero(keys)
        at = at[np.isin(keys[at], items.seeds)]
        lo, hi = (np.searchsorted(items.seeds, keys[at], side=s) for s in ("left", "right"))
        places.append((at, lo, hi - lo))
    if not places:
        return
    at, lo, fan = (np.concatenate(x) for x in zip(*places))
    text = np.searchsorted(begins, at, side="right") - 1
    per_text = np.bincount(text, weights=fan, minlength=len(begins))
    part = (np.cumsum(per_text) // HELD).astype(np.int64)[text]
    shifts = items.shifts
    for p in np.unique(part):
        own = np.flatnonzero(part == p)
        row = np.repeat(own, fan[own])
        seed = lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(fan[own]) - fan[own], fan[own])
        item = items.seed_item[seed]
        # text and item above 32 bits, where the item would begin below them
        key = np.sort(((text[row] * len(items.ids) + item) << 32) + (at[row] - items.seed_place[seed] + (1 << 30)))
        item = (key >> 32) % len(items.ids)
        enough = np.searchsorted(key, key + shifts[item], side="right") - np.arange(len(key)) >= items.need[item]
        spans: dict[tuple[int, int], list[list[int]]] = {}
        for both, begin in zip((key[enough] >> 32).tolist(), ((key[enough] & 0xFFFFFFFF) - (1 << 30)).tolist()):
            k, i = divmod(both, len(items.ids))
            shift = int(shifts[i])
            a, b = max(int(begins[k]), begin - shift), min(int(begins[k + 1]) - 1, begin + len(items.words[i]) + shift)
            found = spans.setdefault((k, i), [])
            if found and a <= found[-1][1]:  # near ones are one passage
                found[-1][1] = max(b, found[-1][1])
            else:
                found.append([a, b])
        for (k, i), found in spans.items():
            yield k, i, found


def matches(items: Items, numbers: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
    """``text, item number, score, first word, last word`` of the best passage of each item that scores enough."""
    for k, item, spans in candidates(items, numbers, begins):
        words = items.words[item]
        best = None
        for a, b in spans:
            passage = numbers[a:b]
            # every match takes a word of its own, so shared words bound the score
            if MATCH * int(np.isin(words, passage).sum()) < items.min_score * MATCH * len(words):
                continue
            score, first, last = align(words, passage)
            share = score / (MATCH * len(words))
            if share >= items.min_score and (best is None or share > best[2]):
                best = (k, item, share, a + first - int(begins[k]), a + last - int(begins[k]))
        if best:
            yield best


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word``: the best passage of every item in every document that copies it.

    ``score`` is the alignment's share of the item's score against itself, words
    are counted from 0 over the document's words of letters and digits.
    Missing texts match nothing, items of fewer than five words are left out,
    repeated documents and repeated items give a row each, and empty tables on
    either side give no rows.  Further columns are ignored.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _hits(keyed, benchmark, min_score, block_words, HITS)


def _hits(keyed: DataFrame, benchmark: DataFrame, min_score: float, block_words: int, schema: str) -> DataFrame:
    spark = keyed.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    size = F.size(F.split("text", r"\s+"))
    total = items.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-total // block_words))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = None
    for block in range(blocks):
        rows = [(r["item_id"], plain_words(r["text"].encode())) for r in items.where(number == block).orderBy("item_id", "text").collect()]
        held = Items.of([r for r in rows if len(r[1]) >= MIN_WORDS], min_score)
        held.choose_seeds(_counts(keyed, held) if held.ids else np.empty(0, dtype=np.int64))
        part = _search(keyed, spark.sparkContext.broadcast(held), schema)
        found = part if found is None else found.unionByName(part)
    return found


def _counts(docs: DataFrame, items: Items) -> np.ndarray:
    """How often each n-gram of the block occurs in all documents: each task sends one sum per n-gram that it saw."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        sums = np.zeros(len(own.grams) + 1, dtype=np.int64)
        for batch in slices(batches):
            numbers = own.numbers(texts(batch))[0]
            for size in own.sizes:
                keys = gram_keys(numbers, size)
                keys = keys[keys > 0]
                at = np.minimum(np.searchsorted(own.grams, keys), len(own.grams) - 1)
                sums += np.bincount(at[own.grams[at] == keys], minlength=len(sums))
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], names=["gram", "n"])

    out = np.zeros(len(items.grams), dtype=np.int64)
    for r in docs.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[r["gram"]] = r["n"]
    return out


def _search(docs: DataFrame, shared, schema: str) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in slices(batches):
            out: list[tuple] = []
            numbers, begins = items.numbers(texts(batch))
            ids = batch.column("doc_id").to_pylist()
            for k, item, score, first, last in matches(items, numbers, begins):
                out.append((ids[k], items.ids[item], score, first, last))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
            columns = list(zip(*out)) or [()] * 5
            names = ["doc_id", "item_id", "score", "first_word", "last_word"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.mapInArrow(search, schema)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the rows that copy an item; equal texts share their fate."""
    keyed = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("doc_id"), "text")
    bad = written(_hits(keyed, benchmark, min_score, BLOCK_WORDS, HITS).select(F.col("doc_id").alias("__key")).distinct(), "contaminated")
    return docs.join(bad, F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__key"), "left_anti")
