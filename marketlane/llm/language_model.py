"""Smoothed n-gram scores from an Elias-Fano trie whose shards are built and queried where their contexts meet.

Documents are dealt into groups of bounded text.  A group sends each of its
n-grams once: the count over its training texts, for building, which is at the
same time the question about it.  N-grams meet by the hash of their context, in
shards that hold whole contexts; a shard adds up the counts, builds its trie
level, and answers each group's n-grams in the order asked: how often each was
seen, and how many tokens and successors its context has.  Discounts come from
the counts of counts of all shards, so no cut of the corpus changes a score.
The group then scores its texts token by token, with quantised probabilities:

    p(w | context) = discounted(w) + weight(context) * p(w | shorter context)

with add-one unigrams at the bottom.  An n-gram of one level is a context of the
next.  Longer n-grams go level by level, so that only one level's are under way.
Groups and shards grow in number with the corpus; a shard grows with the
successors of its most frequent context.  No model is ever held in one place.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
import xxhash
from pyspark.sql import DataFrame, functions as F

from marketlane.llm.common import fold, row_key, written
from marketlane.llm.elias_fano import TrieLevel

FOLDS = 7
#: Remainder of the ids that are held out.
HELD = 2
ORDER = 2
#: Text of one group; one longer text is a group of its own size.
GROUP_BYTES = 12 << 20
#: Steps of a decade in which probabilities are quantised; the last code means "not seen".
STEPS = 4096
UNSEEN = 65535

WORD_BITS = np.uint64(40)
#: Contexts are sent by the upper 56 of their 63 bits.
CONTEXT_CUT = np.uint64(7)
#: Hashes of the end and of the start, of texts that no word can be.
END, START = (np.uint64(xxhash.xxh64_intdigest(t) >> 1) for t in (b" end", b" start"))

BLOCKS = "level int, shard int, grp int, contexts binary, sizes binary, words binary, counts binary"
#: Of a context its tokens, and its successors seen once, twice and more often; of a shard its tokens, types, and types seen 1 to 4 times.
COUNTED = ["counts", "totals", "ones", "twos", "more"]
REPLIES = "grp int, level int, shard int, counts binary, totals binary, ones binary, twos binary, more binary, tokens long, types long, n array<long>, trie binary"


def quantise(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.clip(np.rint(-np.log10(p) * STEPS), 0, UNSEEN - 1).astype("<u2")


def restore(codes: np.ndarray, unseen: float) -> np.ndarray:
    return np.append(10.0 ** (-np.arange(UNSEEN) / STEPS), unseen)[codes]


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """63-bit hash of two hashes in order."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0x7F4A7C159E3779B9))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) >> np.uint64(1)


class Tokens:
    """Tokens of the texts of one group, one end after each text, as places in the rising hashes of its vocabulary."""

    def __init__(self, texts: pa.ChunkedArray):
        parts = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(_one(texts).cast(pa.string()).fill_null("")))
        flat, bounds = parts.values, parts.offsets.to_numpy()
        full = pa.compute.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves an empty word
        before = np.concatenate([[0], np.cumsum(full)])[bounds]
        self.sizes = np.diff(before) + 1
        coded = flat.filter(pa.array(full)).dictionary_encode()
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) >> 1 for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
        self.vocabulary, rank = np.unique(np.append(hashes, END), return_inverse=True)
        rank = rank.astype(np.int32)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.words = np.full(int(self.sizes.sum()), rank[-1])
        place = np.ones(len(self.words), dtype=bool)
        place[self.first + self.sizes - 1] = False
        self.words[place] = rank[coded.indices.to_numpy()]


class GroupLevel:
    """The distinct n-grams of a group at one level, in order of context hash and then word hash.

    ``ngram`` is which of them each token ends, ``suffix`` which n-gram of the level
    below each is without its first word, ``hashes`` and ``opening`` their hashes, and
    that of starts alone, as contexts of the level above.
    """

    def __init__(self, tokens: Tokens, below: GroupLevel | None = None):
        self.number = below.number + 1 if below else 1
        vocabulary = tokens.vocabulary
        if below is None:
            self.contexts, self.word = np.zeros(1, np.uint64), np.arange(len(vocabulary), dtype=np.int32)
            self.context, self.suffix = np.zeros_like(self.word), None
            self.ngram, self.hashes, self.opening = tokens.words, vocabulary, START
            return
        heads = np.append(below.hashes, below.opening)
        before = np.concatenate([[0], below.ngram[:-1]])
        before[tokens.first] = len(below.hashes)
        used = np.zeros(len(heads), dtype=bool)
        used[before] = True
        place = np.zeros(len(heads), dtype=np.int64)
        self.contexts, place[used] = np.unique(heads[used] >> CONTEXT_CUT, return_inverse=True)
        bits = len(vocabulary).bit_length()
        keys = (place[before] << bits) | tokens.words
        order = np.argsort(keys)
        keys = keys[order]
        begins, _ = _runs(keys)
        new = np.zeros(len(keys), dtype=np.int32)
        new[begins] = 1
        self.ngram = np.empty(len(keys), dtype=np.int32)
        self.ngram[order] = np.cumsum(new, dtype=np.int32) - 1
        keys, order = keys[begins], order[begins]
        self.context, self.word = (keys >> bits).astype(np.int32), (keys & ((1 << bits) - 1)).astype(np.int32)
        self.suffix = below.ngram[order]
        self.hashes = mix(heads[before[order]], vocabulary[self.word])
        self.opening = mix(np.array([below.opening]), START)[0]

    def counts(self, training: np.ndarray) -> np.ndarray:
        """How often each n-gram ends at a training token."""
        return np.bincount(self.ngram[training], minlength=len(self.word))


def levels_of(tokens: Tokens, order: int) -> Iterator[GroupLevel]:
    """One level after the other; those further below are let go."""
    level = None
    for _ in range(order):
        level = GroupLevel(tokens, level)
        yield level


def _shard_of(hashes: np.ndarray, shards: int, bits: int) -> np.ndarray:
    """Shard of a hash of so many bits, rising with the hash."""
    return ((hashes >> np.uint64(bits - 32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _layout(level: GroupLevel, vocabulary: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shards that have n-grams of the level, the bounds of these, and those of their contexts."""
    if level.number == 1:
        shard, bounds = np.unique(_shard_of(vocabulary, shards, 63), return_index=True)
        return shard, np.append(bounds, len(vocabulary)), None, None
    first, _ = _runs(level.context)
    shard, heads = np.unique(_shard_of(level.contexts, shards, 56), return_index=True)
    return shard, np.append(first[heads], len(level.context)), np.append(heads, len(first)), np.append(first, len(level.context))


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in as many bytes each as the largest needs, lowest bytes first, compressed after that number and theirs."""
    width = max(1, -(-int(numbers.max()).bit_length() // 8)) if len(numbers) else 1
    plain = np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
    head = np.array([width, len(numbers)], dtype="<u4").tobytes()
    return head + pa.compress(np.ascontiguousarray(plain.T), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    width, size = np.frombuffer(data, "<u4", 2).tolist()
    out = np.zeros((size, 8), dtype=np.uint8)
    if size:
        out[:, :width] = np.frombuffer(pa.decompress(data[8:], width * size, codec="zstd"), dtype=np.uint8).reshape(width, size).T
    return out.view("<u8").ravel()


def _rising(numbers: np.ndarray) -> bytes:
    """Rising numbers by their steps."""
    return numbers[:1].astype("<u8").tobytes() + _packed(np.diff(numbers))


def _risen(data: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate([np.frombuffer(data, "<u8", 1), _unpacked(data[8:])]), dtype=np.uint64)


def _five_bytes(words: np.ndarray) -> bytes:
    return np.ascontiguousarray((words >> np.uint64(23)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_five(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begins = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)
    return begins, np.diff(np.concatenate([begins, [len(values)]]))


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _table(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def ngram_blocks(docs: DataFrame, numbers: Sequence[int], shards: int) -> DataFrame:
    """Per group, level (of those listed) and shard the group's n-grams with their counts in training texts."""

    def send(group: pa.Table) -> pa.Table:
        tokens = Tokens(group.column("text"))
        training = np.repeat(~group.column("held_out").to_numpy(), tokens.sizes)
        rows: list[tuple] = []
        for level in levels_of(tokens, max(numbers)):
            if level.number not in numbers:
                continue
            counts = level.counts(training)
            shard, bounds, heads, first = _layout(level, tokens.vocabulary, shards)
            for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                if level.number == 1:
                    block = (_rising(tokens.vocabulary[a:b]), b"", b"")
                else:
                    c, d = heads[k : k + 2]
                    words = tokens.vocabulary[level.word[a:b]]
                    block = (_rising(level.contexts[c:d]), _packed(np.diff(first[c : d + 1])), _five_bytes(words))
                rows.append((level.number, int(shard[k]), group.column("grp")[0].as_py(), *block, _packed(counts[a:b])))
        return _table(rows, ["level", "shard", "grp", "contexts", "sizes", "words", "counts"], [pa.int32()] * 3 + [pa.binary()] * 4)

    return docs.groupBy("grp").applyInArrow(send, BLOCKS)


def tallies(counts: np.ndarray) -> np.ndarray:
    """How many n-grams are seen 1, 2, 3 and 4 times."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5]


def discounts_of(n: Sequence[int]) -> np.ndarray:
    """What is taken from n-grams seen once, twice and more often, from how many are seen 1 to 4 times.

    The closed-form leave-one-out estimate; where counts are too few for it, a half.
    """
    n = np.asarray(n, dtype=np.float64)
    out = np.full(3, 0.5)
    if n[0] and n[1]:
        y = n[0] / (n[0] + 2 * n[1])
        for k in range(3):
            if n[k] and n[k + 1]:
                out[k] = (k + 1) - (k + 2) * y * n[k + 1] / n[k]
    return np.clip(out, 0.05, np.array([0.999, 1.9, 2.9]))


def discounts(counts: np.ndarray) -> np.ndarray:
    return discounts_of(tallies(counts))


def codes_of(counts: np.ndarray, totals: np.ndarray, take: np.ndarray) -> np.ndarray:
    """Codes of the discounted probabilities of n-grams, given the tokens of their contexts."""
    codes = np.full(len(counts), UNSEEN, dtype="<u2")
    seen = counts > 0
    own = counts[seen]
    codes[seen] = quantise((own - take[np.minimum(own, 3) - 1]) / totals[seen])
    return codes


def weights_of(totals: np.ndarray, types: np.ndarray, take: np.ndarray) -> np.ndarray:
    """Codes of the weights of contexts; ``types`` are the successors seen once, twice and more often."""
    codes = np.full(len(totals), UNSEEN, dtype="<u2")
    seen = totals > 0
    codes[seen] = quantise(take @ types[:, seen] / totals[seen])
    return codes


def _summed(heads: np.ndarray, sizes: np.ndarray, words: np.ndarray, counts: np.ndarray):
    """Contexts that are seen, their numbers of successors, the successors in order, and how often each is seen."""
    every, place = np.unique(heads, return_inverse=True)
    seen = counts > 0
    key = ((np.repeat(place, sizes).astype(np.uint64) << WORD_BITS) | words)[seen]
    order = np.argsort(key)
    key, own = key[order], counts[seen][order]
    first, _ = _runs(key)
    key, own = key[first], np.add.reduceat(own, first) if len(first) else own
    context = (key >> WORD_BITS).astype(np.int64)
    begins, sizes = _runs(context)
    return every[context[begins]], sizes, key & np.uint64((1 << 40) - 1), own


def answers(blocks: DataFrame, take: dict[int, np.ndarray] | None = None) -> DataFrame:
    """Per block how often its n-grams are seen, with the figures of its contexts; per shard its sums.

    With discounts per level, each shard's level itself as well.
    """
    names = ["grp", "level", "shard", "counts", "totals", "ones", "twos", "more", "tokens", "types", "n", "trie"]
    kinds = [pa.int32()] * 3 + [pa.binary()] * 5 + [pa.int64()] * 2 + [pa.list_(pa.int64()), pa.binary()]

    def unigrams(groups: list[int], columns: dict, level: int) -> list[tuple]:
        words = [_risen(c) for c in columns["contexts"]]
        counts = np.concatenate([_unpacked(c) for c in columns["counts"]]).astype(np.int64)
        every, place = np.unique(np.concatenate(words), return_inverse=True)
        total = np.zeros(len(every), dtype=np.int64)
        np.add.at(total, place, counts)
        rows: list[tuple] = [(-1, *[None] * 5, int(total.sum()), int((total > 0).sum()), None, None)]
        for group, own in zip(groups, np.split(total[place], np.cumsum([len(w) for w in words])[:-1])):
            rows.append((group, _packed(own), *[None] * 8))
        return rows

    def longer(groups: list[int], columns: dict, level: int) -> list[tuple]:
        parts = [_risen(c) for c in columns["contexts"]]
        heads = np.concatenate(parts)
        sizes = np.concatenate([_unpacked(c) for c in columns["sizes"]]).astype(np.int64)
        words = _from_five(b"".join(columns["words"]))
        counts = np.concatenate([_unpacked(c) for c in columns["counts"]]).astype(np.int64)
        contexts, successors, word, own = _summed(heads, sizes, words, counts)
        bounds = np.cumsum(successors) - successors
        each = lambda x: np.add.reduceat(x.astype(np.int64), bounds) if len(bounds) else np.empty(0, np.int64)
        total, types = each(own), np.stack([each(own == 1), each(own == 2), each(own > 2)])
        codes = weights = np.empty(0, "<u2")
        if take:
            codes, weights = codes_of(own, np.repeat(total, successors), take[level]), weights_of(total, types, take[level])
        trie = TrieLevel.of(contexts, successors, word, codes, weights).mapped()
        rows: list[tuple] = [(-1, *[None] * 5, int(own.sum()), len(own), tallies(own).tolist(), trie.to_bytes() if take else None)]
        place = trie.context(heads)  # -1 is unseen
        found = np.append(own, 0)[trie.successor(np.repeat(place, sizes), words)]
        asked = [np.append(x, 0)[place] for x in (total, *types)]
        ends = np.cumsum([len(p) for p in parts])[:-1]
        last = np.cumsum(sizes)[ends - 1]
        for group, seen, *figures in zip(groups, np.split(found, last), *(np.split(x, ends) for x in asked)):
            rows.append((group, _packed(seen), *map(_packed, figures), *[None] * 4))
        return rows

    def answer(key: tuple, block: pa.Table) -> pa.Table:
        level, shard = (k.as_py() for k in key)
        columns = {n: block.column(n).to_pylist() for n in ("contexts", "sizes", "words", "counts")}
        make = unigrams if level == 1 else longer
        return _table([(r[0], level, shard, *r[1:]) for r in make(block.column("grp").to_pylist(), columns, level)], names, kinds)

    return blocks.groupBy("level", "shard").applyInArrow(answer, REPLIES)


def discounts_of_levels(replies: DataFrame) -> dict[int, np.ndarray]:
    """Discounts of each level above words, from the sums of all shards."""
    sums = replies.where("grp = -1 AND level > 1").groupBy("level").agg(*[F.sum(F.col("n")[k]).alias(f"n{k}") for k in range(4)])
    return {r["level"]: discounts_of(r[1:]) for r in sums.collect()}


def grouped(docs: DataFrame, group_bytes: int) -> tuple[DataFrame, int]:
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0)).alias("b")).first()["b"]
    groups = max(1, -(-size // group_bytes))
    rows = docs.select(
        F.pmod(row_key(), F.lit(groups)).cast("int").alias("grp"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        (fold(FOLDS) == HELD).alias("held_out"),
    )
    return rows, groups


def scores(docs: DataFrame, order: int = ORDER, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs`` (``doc_id, text``).

    Learns from the rows whose ``crc32(doc_id) mod 7`` is not 2.  Missing texts
    are empty: one end token.  Without training texts every probability of the
    base is one over one word, so scores are 0.  Repeated rows are texts of
    their own; further columns are ignored; an empty table gives no rows.
    """
    rows, groups = grouped(docs, group_bytes)
    parts = [range(1, order + 1)[:2], *([k] for k in range(3, order + 1))]
    replies = reduce(DataFrame.unionByName, [written(answers(ngram_blocks(rows, list(p), groups)), "lm-replies") for p in parts])
    total = replies.where("level = 1 AND grp = -1").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("types"), F.lit(0)).alias("v")).first()
    n, v = total["n"], total["v"]
    take = discounts_of_levels(replies)

    def score(key: tuple, group: pa.Table, answered: pa.Table) -> pa.Table:
        tokens = Tokens(group.column("text"))
        held = sorted(answered.to_pylist(), key=lambda r: (r["level"], r["shard"]))
        p = known = base = None
        for level in levels_of(tokens, order):
            own = [r for r in held if r["level"] == level.number]
            count, *figures = (np.concatenate([_unpacked(r[c]) for r in own]).astype(np.int64) for c in COUNTED[: 1 if level.number == 1 else 5])
            if level.number == 1:
                p = (count + 1) / (n + v + 1)
                known, base = count > 0, np.log10(p)
            else:
                totals, types = figures[0], np.stack(figures[1:])
                codes = codes_of(count, totals[level.context], take[level.number])
                weights = weights_of(totals, types, take[level.number])
                p = restore(codes, 0.0) + restore(weights, 1.0)[level.context] * p[level.suffix]
        p = np.log10(np.minimum(p, 1.0))[level.ngram]
        sums = lambda x: np.add.reduceat(x, tokens.first)
        return pa.table(
            {
                "doc_id": group.column("doc_id"),
                "held_out": group.column("held_out"),
                "n_tokens": pa.array(tokens.sizes),
                "n_known": pa.array(sums(known[tokens.words].astype(np.int64))),
                "train_tokens": pa.array(np.full(len(tokens.sizes), n, dtype=np.int64)),
                "base_score": pa.array(sums(base[tokens.words])),
                "score": pa.array(sums(p)),
            }
        )

    def joined(key: tuple, group: pa.Table, answered: pa.Table) -> pa.Table:
        if not group.num_rows:
            return RESULT.empty_table()
        return score(key, group, answered)

    by_group = replies.where("grp >= 0").select("grp", "level", "shard", *COUNTED).groupBy("grp")
    return rows.groupBy("grp").cogroup(by_group).applyInArrow(
        joined, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), *[(n, pa.int64()) for n in ("n_tokens", "n_known", "train_tokens")], ("base_score", pa.float64()), ("score", pa.float64())]
)


def tries(docs: DataFrame, order: int = ORDER, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``level, shard, trie``: the model itself, one memory-mappable level per row (read by ``TrieLevel.from_buffer``)."""
    rows, groups = grouped(docs, group_bytes)
    blocks = ngram_blocks(rows, list(range(2, order + 1)), groups)
    take = discounts_of_levels(answers(blocks))
    return answers(blocks, take).where("grp = -1").select("level", "shard", "trie")
