"""SimHash fingerprints and near-duplicate groups by multi-index hashing.

A fingerprint is cut into two segments of 32 bits.  Two fingerprints at three
or fewer differing bits differ in at most one bit of some segment, so each
looks up, per segment, its small Hamming ball (radius one) in the table of that
segment, and whole distances decide.  Of two segments that differ in one bit one
has it clear, so it is enough that each fingerprint enumerates its clear bits.

Rows of one segment value meet in one sorted run of a task, and only a spanning
forest of the links found there leaves it, never all pairs.  Runs longer than
``max_run`` are cut further by the other half: within a run the other halves of
linked fingerprints differ in at most three bits, so one of their two 16-bit
parts differs in at most one, and the same lookup is made on these parts.  Such
a run holds at most 2^16 table rows, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from marketlane.llm.common import row_key, slices, texts, written

SEED = 42
DISTANCE = 3
#: Rows of one segment value that are compared without being cut further.
MAX_RUN = 1 << 14

LANES = np.uint64(0x0101010101010101)


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words; fewer words are one shingle, none give nothing."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - size + 1)


def majority_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """One fingerprint per array: a bit is set if more than half of the hashes have it."""
    sizes = np.array([len(h) for h in hashes], dtype=np.int64)
    out = np.zeros(len(hashes), dtype=np.uint64)
    if not sizes.sum():
        return out
    every = np.concatenate(hashes)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # byte lanes hold counts up to 255, so sums run over blocks of at most that many hashes
    blocks = np.concatenate([np.arange(f, f + n, 255) for f, n in zip(first, sizes) if n])
    per_doc = -(-sizes[sizes > 0] // 255)
    doc_first = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
    some = np.zeros(int((sizes > 0).sum()), dtype=np.uint64)
    for bit in range(8):
        lanes = np.add.reduceat((every >> np.uint64(bit)) & LANES, blocks)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), doc_first, axis=0)
        majority = (2 * counts > sizes[sizes > 0, None]).astype(np.uint64)
        some |= (majority << (np.arange(8, dtype=np.uint64) * np.uint64(8) + np.uint64(bit))).sum(axis=1, dtype=np.uint64)
    out[sizes > 0] = some
    return out


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``doc_id, key, fp`` of every document row: its identity and 64 bits as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes = [shingle_hashes(t.lower().split(), size) for t in texts(batch)]
            fp = majority_bits(hashes).view(np.int64)
            ids = [batch.column("doc_id"), batch.column("key"), pa.array(fp)]
            yield pa.RecordBatch.from_arrays(ids, names=["doc_id", "key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text")
    return rows.mapInArrow(compute, "doc_id long, key long, fp long")


def _ball(value, bits: int, offset: int):
    """``value`` and what it becomes when one clear bit of the ``bits`` above ``offset`` is set."""
    flips = F.array(*[F.lit(1 << (offset + b) if offset + b < 63 else -(1 << 63)).cast("long") for b in range(bits)])
    return F.transform(F.filter(flips, lambda m: value.bitwiseAND(m) == 0), lambda m: value.bitwiseOR(m))


def _mask(bits: int, offset: int) -> int:
    mask = ((1 << bits) - 1) << offset
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _lookups(rows: DataFrame, level: str, parts: list[tuple[int, int]]) -> DataFrame:
    """Each row at its own value and at its ball of every part (``bits, offset``): column ``level``."""
    places = []
    for number, (bits, offset) in enumerate(parts):
        value = F.col("fp").bitwiseAND(F.lit(_mask(bits, offset)))
        near = F.concat(F.array(value), _ball(value, bits, offset))
        own = F.array_repeat(F.lit(number), F.size(near))
        places.append(F.arrays_zip(own.alias("part"), near.alias("value")))
    return rows.withColumn(level, F.explode(F.concat(*places)))


def _forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one run at ``distance`` or less, thinned to a spanning forest: each row is claimed once."""
    a, b = [], []
    free = np.unique(fps)
    while len(free):
        frontier, free = [free[0]], free[1:]
        while frontier and len(free):
            head = frontier.pop()
            near = np.bitwise_count(free ^ head) <= distance
            if near.any():
                claimed = free[near]
                a.append(np.full(len(claimed), head))
                b.append(claimed)
                frontier.extend(claimed)
                free = free[~near]
    empty = np.empty(0, dtype=np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def _links(rows: DataFrame, keys: list[str], distance: int) -> DataFrame:
    """Links within each run of equal ``keys``: the rows of a run arrive sorted, in one task."""
    count = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    flat = rows.select(F.xxhash64(*keys).alias("run"), "fp").repartition(int(count), "run")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            part = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("run", "fp")]
            if held is not None:
                part = [np.concatenate(x) for x in zip(held, part)]
            last = np.searchsorted(part[0], part[0][-1]) if len(part[0]) else 0
            held = [x[last:] for x in part]
            yield from linked(*(x[:last] for x in part))
        if held is not None:
            yield from linked(*held)

    def linked(run: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(run):
            return
        fp = fp.view(np.uint64)
        begins = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        ends = np.concatenate([begins[1:], [len(run)]])
        lengths = ends - begins
        pairs = [(np.empty(0, np.uint64), np.empty(0, np.uint64))]
        two = begins[lengths == 2]  # most runs of more than one row
        close = np.bitwise_count(fp[two] ^ fp[two + 1]) <= distance
        pairs.append((fp[two][close], fp[two + 1][close]))
        for k in np.flatnonzero(lengths > 2):
            pairs.append(_forest(fp[begins[k] : ends[k]], distance))
        a, b = (np.concatenate(x) for x in zip(*pairs))
        differ = a != b
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)[differ].view(np.int64)), pa.array(np.maximum(a, b)[differ].view(np.int64))],
            names=["a", "b"],
        )

    return flat.sortWithinPartitions("run").mapInArrow(find, "a long, b long")


def fingerprint_links(distinct: DataFrame, distance: int = DISTANCE, max_run: int = MAX_RUN) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that keep every group at ``distance`` connected."""
    if not 0 <= distance <= 3:
        raise ValueError("two segments of radius one find distances up to 3")
    rows = _lookups(distinct.select("fp"), "half", [(32, 0), (32, 32)])
    counts = rows.groupBy("half").agg(F.count("*").alias("rows")).where(F.col("rows") > max_run)
    large = written(counts, "simhash-large")
    usual = rows.join(large, "half", "left_anti")
    links = _links(usual, ["half"], distance)
    low, high = F.col("fp").bitwiseAND(F.lit(_mask(32, 0))), F.shiftrightunsigned("fp", 32)
    hot = rows.join(large.select("half"), "half").select(
        "half", F.col("fp").alias("whole"), F.when(F.col("half.part") == 0, high).otherwise(low).alias("fp")
    )
    cut = _lookups(hot, "quarter", [(16, 0), (16, 16)]).select("half", "quarter", F.col("whole").alias("fp"))
    more = _links(cut, ["half", "quarter"], distance)
    return links.unionByName(more).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root``: smallest node reachable over ``a, b``, for the nodes that have links.

    Each round hooks every root to the smallest root next to it and then halves
    the paths; both work on one row per node, and each round's state is a table
    of the shared folder.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    edges = written(both.distinct(), "components-edges")
    state = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "components")
    for _ in range(rounds):
        seen = state.select(F.col("node").alias("b"), F.col("root").alias("near"))
        offers = edges.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        own = state.join(offers, "node").select("node", "root", F.least("root", "near").alias("best"))
        hooks = own.where("best < root").groupBy(F.col("root").alias("node")).agg(F.min("best").alias("hook"))
        hooked = own.select("node", "best", "root").join(hooks, "node", "left").select(
            "node", F.least("best", F.coalesce("hook", "best")).alias("next"), F.col("root").alias("old")
        )
        up = hooked.select(F.col("node").alias("next"), F.col("next").alias("above"))
        new = written(
            hooked.join(up, "next", "left").select("node", F.least("next", F.coalesce("above", "next")).alias("root"), "old"),
            "components",
        )
        moved = new.where("root <> old").limit(1).count()
        state = new.drop("old")
        if not moved:
            return state
    raise RuntimeError(f"components still move after {rounds} rounds")


def grouped(docs: DataFrame, size: int = 3, distance: int = DISTANCE, max_run: int = MAX_RUN) -> DataFrame:
    """``doc_id, key, fp, first``: every row with the first document (``doc_id, key``) of its group."""
    fps = written(fingerprints(docs, size), "simhash")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    distinct = written(fps.groupBy("fp").agg(F.min(rank).alias("least")), "simhash-distinct")
    roots = components(fingerprint_links(distinct, distance, max_run))
    labelled = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = labelled.groupBy("root").agg(F.min("least").alias("first"))
    return fps.join(labelled.join(firsts, "root").select("fp", "first"), "fp")


def near_duplicates(docs: DataFrame, size: int = 3, distance: int = DISTANCE, max_run: int = MAX_RUN) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs`` (``doc_id, text``).

    Text is lower-cased in A-Z, words are runs of anything but ASCII white
    space, shingles are ``size`` words.  Missing and blank texts have the
    fingerprint zero and are linked like any other.  ``component_id`` is the
    smallest id reachable over links of at most ``distance`` differing bits; it
    is missing only where no row of the group has an id.  Repeated rows give
    repeated results; further columns are ignored; an empty table gives no rows.
    """
    rows = grouped(docs, size, distance, max_run)
    return rows.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, the one with the smallest id.

    Rows that repeat its id and text are the same document; the first of them in the order of the other columns stays.
    """
    kept = grouped(docs, **options).select(F.col("first.key").alias("__key")).distinct()
    keyed = docs.withColumn("__key", row_key())
    order = Window.partitionBy("__key").orderBy(*[F.col(c) for c in docs.columns])
    return (
        keyed.join(kept, "__key", "left_semi")
        .withColumn("__n", F.row_number().over(order))
        .where("__n = 1")
        .select(*docs.columns)
    )
