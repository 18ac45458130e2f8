"""Best-fit-decreasing packing of tokenised documents into sequences of bounded length.

Best fit looks only at lengths, and lengths are integers of at most ``capacity``.
So the packing is decided on the histogram of lengths: a segment tree over the
remaining capacities (one leaf per capacity, counting the open sequences that
have it) finds the tightest open sequence in logarithmic time, and a run of
equal lengths goes into a run of equally full sequences at once.  The result is
the same number of sequences that document-by-document best fit over the whole
corpus gives, while the driver holds the histogram (``capacity`` rows at most)
and the list of moves, whose number depends on ``capacity`` and not on the data.
Documents find their place by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from marketlane.llm.common import Memo, slices, written

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
#: Chunks whose ids a task keeps at hand; beyond it the memory starts anew.
CHUNKS = 800_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


#: Rows and bytes of text whose chunks are looked up together: the more, the fewer different ones to each.
ROWS, BYTES = 4096, 8 << 20

#: A word of Latin letters that are one character in any normal form, and marks that are one pre-token.
PLAIN = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,;:!?|*#%&$]*)$"


def _listed(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


class ChunkIds:
    """Places of token ids by white-space separated chunk; each chunk is encoded once.

    The tokenizer folds white space and its pre-tokens never hold any, so the
    ids of a text are those of its chunks in order.  Only the ASCII white space
    that the tokenizer itself folds separates chunks here; other spaces stay
    inside a chunk and are handled by the tokenizer.  A plain word goes to the
    tokenizer's merges directly, as its normaliser and pre-tokenizer would only
    lower its letters and part it from its marks; all else takes the whole way.

    Splitting, finding the different chunks of a batch and taking words apart are
    Arrow kernels; Python sees each different chunk of a batch once.
    """

    def __init__(self, path: str, end_id: int):
        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        spelt = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = {c: spelt(chr(c))[0][0] for c in range(0xDF, 0x100) if chr(c).isalpha()}
        merges = self.tokenizer.model.tokenize
        self.words = Memo(lambda w: tuple([t.id for t in merges(w)]), CHUNKS // 2)
        self.reset()

    def reset(self):
        # place 0 is the end of a document, place 1 the nothing before leading white space
        self.place: dict[str, int] = {"": 1}
        self.flat, self.first, self.size = array("I", [self.end_id]), array("q", [0, 1]), array("q", [1, 0])

    def learn(self, chunks: list[str]) -> list[int]:
        """Encode chunks that have no place yet; their places."""
        parts = pc.extract_regex(pa.array(chunks, pa.string()), PLAIN)
        columns = parts.is_valid(), pc.utf8_lower(parts.field("word")), parts.field("marks")
        begin, at = len(self.first), len(self.flat)
        for chunk, known, word, marks in zip(chunks, *map(_listed, columns)):
            if known:
                ids = self.words[word if word.isascii() else word.translate(self.letters)]
                if marks:
                    ids += self.words[marks]
            else:
                ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            self.flat.extend(ids)
            self.first.append(at)
            self.size.append(len(ids))
            at += len(ids)
        places = list(range(begin, len(self.first)))
        self.place.update(zip(chunks, places))
        return places

    def encode(self, docs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents with the end id after each, and the number of ids of each document."""
        if len(self.place) > CHUNKS:
            self.reset()
        split = pc.ascii_split_whitespace(docs.cast(pa.string()).fill_null(""))
        ends = np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))
        coded = split.flatten().dictionary_encode()
        different = _listed(coded.dictionary)
        places = np.fromiter(map(self.place.get, different, repeat(-1)), np.int64, len(different))
        new = np.flatnonzero(places < 0)
        if len(new):
            places[new] = self.learn([different[k] for k in new.tolist()])
        index = np.insert(places[coded.indices.to_numpy()], ends, 0)
        size, first = np.array(self.size)[index], np.array(self.first)[index]
        upto = np.cumsum(size)
        ids = np.array(self.flat, dtype=np.uint32)[np.arange(upto[-1]) + np.repeat(first - upto + size, size)]
        last = upto[ends + np.arange(len(ends))]  # with the end id
        return ids, np.diff(np.concatenate([[0], last]))


@lru_cache(maxsize=1)
def chunk_ids(path: str) -> ChunkIds:
    """One coder per Python worker: the next task goes on with what this one has learnt."""
    return ChunkIds(path, END_ID)


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of every document, cut only where it exceeds ``capacity``."""
    path = path or public_tokenizers.path(TOKENIZER)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = chunk_ids(path)
        for batch in slices(batches, rows=ROWS, size=BYTES):
            ids, counts = coder.encode(batch.column("text"))
            held = batch.column("doc_id").to_pylist()
            rows: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            begin = 0
            for doc_id, count in zip(held, counts.tolist()):
                for piece, start in enumerate(range(0, count, capacity)):
                    own = ids[begin + start : begin + min(count, start + capacity)]
                    rows["doc_id"].append(doc_id)
                    rows["piece"].append(piece)
                    rows["start"].append(start)
                    rows["length"].append(len(own))
                    rows["ids_crc32"].append(zlib.crc32(own.astype("<u4").tobytes()))
                    rows["ids"].append(own.astype(np.int32) if keep_ids else None)
                begin += count
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows["doc_id"], pa.int64()),
                    pa.array(rows["piece"], pa.int32()),
                    *[pa.array(rows[n], pa.int64()) for n in ("start", "length", "ids_crc32")],
                    pa.array(rows["ids"], pa.list_(pa.int32())),
                ],
                names=list(rows),
            )

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)
    return pieces if keep_ids else pieces.drop("ids")


class OpenCapacities:
    """Segment tree over remaining capacities 0 to ``top``: how many open sequences have each."""

    def __init__(self, top: int):
        self.width = 1 << top.bit_length()
        self.tree = [0] * (2 * self.width)

    def add(self, capacity: int, sequences: int):
        node = self.width + capacity
        while node:
            self.tree[node] += sequences
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """Smallest remaining capacity of at least ``length`` that an open sequence has."""
        node = self.width + length
        if self.tree[node]:
            return length
        while node > 1:  # up to the first right sibling that holds something, then down its left edge
            if node % 2 == 0 and self.tree[node + 1]:
                node += 1
                while node < self.width:
                    node = 2 * node if self.tree[2 * node] else 2 * node + 1
                return node - self.width
            node >>= 1
        return None


def best_fit_moves(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows ``length, first rank, first sequence, offset``, sorted: where runs of equally long pieces go.

    Best fit decreasing: lengths from long to short, each piece into the open
    sequence with the least sufficient room, or into a new one.
    """
    tree = OpenCapacities(capacity)
    open_runs: dict[int, list[tuple[int, int]]] = {}
    moves, opened = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                # nothing else has room, so each new sequence takes this length until it is full
                fits = capacity // length
                full, rest = divmod(left, fits)
                for sequences, items in ((full, fits), (1, rest)):
                    if not sequences or not items:
                        continue
                    for k in range(items):
                        moves.append((length, rank, opened, k * length))
                        rank += sequences
                    _reopen(tree, open_runs, capacity - items * length, opened, sequences)
                    opened += sequences
                break
            first, count = open_runs[room].pop()
            tree.add(room, -count)
            if count > left:
                _reopen(tree, open_runs, room, first + left, count - left)
                count = left
            moves.append((length, rank, first, capacity - room))
            rank, left = rank + count, left - count
            _reopen(tree, open_runs, room - length, first, count)
    return np.array(sorted(moves), dtype=np.int64).reshape(-1, 4)


def _reopen(tree: OpenCapacities, open_runs: dict, room: int, first: int, count: int):
    if room and count:
        open_runs.setdefault(room, []).append((first, count))
        tree.add(room, count)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have ``doc_id, piece, length``.

    Lengths must lie in 1 to ``capacity``.  Offsets in a sequence are gapless
    from 0.  Equal rows are interchangeable.  An empty input stays empty.
    """
    spark = pieces.sparkSession
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    counts = written(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "packing-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if histogram and not 1 <= min(histogram) <= max(histogram) <= capacity:
        raise ValueError(f"piece lengths {min(histogram)} to {max(histogram)} do not fit sequences of {capacity}")
    moves = spark.sparkContext.broadcast(best_fit_moves(histogram, capacity))
    before = counts.select(
        "length",
        "salt",
        (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("earlier"),
    )
    own_rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1
    ranked = (
        salted.withColumn("own_rank", own_rank)
        .join(before, ["length", "salt"])
        .withColumn("sequence_id", F.col("earlier") + F.col("own_rank"))  # the rank, until it is placed
        .withColumn("offset", F.lit(0).cast("long"))
        .select(*pieces.columns, "sequence_id", "offset")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first_rank, first_sequence, offset = moves.value.T
        begins = np.searchsorted(length, np.arange(capacity + 2))
        for batch in batches:
            own, rank = (batch.column(n).to_numpy() for n in ("length", "sequence_id"))
            at = np.empty(len(own), dtype=np.int64)
            for value in np.unique(own):
                lo, hi = begins[value], begins[value + 1]
                mine = own == value
                at[mine] = lo + np.searchsorted(first_rank[lo:hi], rank[mine], side="right") - 1
            sequence = pa.array(first_sequence[at] + rank - first_rank[at])
            columns = {n: batch.column(n) for n in batch.schema.names} | {"sequence_id": sequence, "offset": pa.array(offset[at])}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return ranked.mapInArrow(place, ranked.schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Documents (``doc_id, text``) as packed pieces: ``doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset``.

    A missing or empty text is the end id alone, one piece of length 1; a
    missing id stays missing; repeated rows are packed each.  Further columns
    are ignored, whatever their names.  An empty table gives no rows.
    """
    return pack(written(token_pieces(docs, capacity, path, keep_ids), "packing-pieces"), capacity)
