"""Near copies of five-word similarity 0.8 and more: SimHash fingerprints of 128 bits, multi-index hashing, exact check.

Two sets of shingles of Jaccard similarity J have a cosine of at least
2J / (1 + J), and their fingerprints differ in a share of acos(cosine) / pi of
the bits: at J = 0.8 in 15 %, 19 of 128 on average.  Three differing bits of 64,
as exact copies with small slips have, are far too few for that, so the
fingerprint is longer here and the radius wider.

The bits form a ring that is covered by overlapping segments.  In each segment a
fingerprint enters the table of that segment at its own value and at its ball of
one more set bit; two fingerprints meet if the segment differs in one bit, or in
two of which each has one.  Rows of one segment value meet in one sorted run,
and whole distances over all 128 bits decide which of them are candidates.

Candidates are links if the sets themselves have the similarity.  A run first
gives only a spanning forest of its candidates, never all pairs.  The forests of
all runs make trees, and of each row's links in them two at most are held against
the sets, however many runs have given it one.  Where these make one group of a
tree, no other pair in it matters any more.  Where they don't, the members of the
tree meet once more with their sets, dealt into blocks of bounded size, two blocks to a task's
group.  Candidates between different groups are held against their sets there, and
only those that join two groups leave the task: fewer than the rows that came in.
So the groups are those of all candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marketlane.llm.common import every_column, row_key, slices, texts, written
from marketlane.llm.simhash import components, majority_bits, shingle_hashes

SIZE = 5
#: Jaccard similarity of the different shingles from which two texts are near copies.
SIMILARITY = 0.8
#: Differing bits of 128 up to which two fingerprints are candidates: the mean at 0.8 and some of its spread.
RADIUS = 24
#: Bits of a segment, and the step from one segment to the next on the ring of 128 bits.
SEGMENT, STEP = 22, 16

#: Fixed constants of the 64-bit finaliser that derives the second half's hashes from the first's.
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(hashes: np.ndarray) -> np.ndarray:
    """A second, independent hash of each hash."""
    z = hashes + MIX[0]
    z = (z ^ (z >> np.uint64(30))) * MIX[1]
    z = (z ^ (z >> np.uint64(27))) * MIX[2]
    return z ^ (z >> np.uint64(31))


def wide_fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id, key, low, high`` of every row: two halves of 64 bits over its different shingles."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes = [np.unique(shingle_hashes(t.lower().split(), size)) for t in texts(batch)]
            halves = [majority_bits(h).view(np.int64) for h in (hashes, [mixed(x) for x in hashes])]
            columns = [batch.column("doc_id"), batch.column("key"), *map(pa.array, halves)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "low", "high"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text")
    return rows.mapInArrow(compute, "doc_id long, key long, low long, high long")


def segment_of(low: np.ndarray, high: np.ndarray, offset: int, bits: int) -> np.ndarray:
    """``bits`` (at most 32) of the ring from ``offset`` on."""
    first, second = (low, high) if offset < 64 else (high, low)
    shift = offset % 64
    value = first >> np.uint64(shift)
    if shift:
        value = value | (second << np.uint64(64 - shift))
    return value & np.uint64((1 << bits) - 1)


def entries(low: np.ndarray, high: np.ndarray, bits: int, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``row, run``: places of each fingerprint in the tables of all segments."""
    rows = np.arange(len(low))
    for number, offset in enumerate(range(0, 128, step)):
        value = segment_of(low, high, offset, bits)
        tag = np.uint64(number << 32)
        yield rows, value | tag
        for bit in range(bits):
            flag = np.uint64(1 << bit)
            clear = np.flatnonzero((value & flag) == 0)
            yield clear, value[clear] | flag | tag


def forest(low: np.ndarray, high: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one run, thinned to a spanning forest: every row is claimed once, by a row within ``radius``."""
    a, b = [], []
    free = np.arange(len(low))
    while len(free):
        frontier, free = [free[0]], free[1:]
        while frontier and len(free):
            head = frontier.pop()
            apart = np.bitwise_count(low[free] ^ low[head]) + np.bitwise_count(high[free] ^ high[head])
            near = apart <= radius
            if near.any():
                a.append(np.full(int(near.sum()), head))
                b.append(free[near])
                frontier.extend(free[near])
                free = free[~near]
    none = np.empty(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _small_runs(low: np.ndarray, high: np.ndarray, begins: np.ndarray, length: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links in all runs of one small ``length`` at once."""
    a, b = [], []
    for i in range(length):
        for j in range(i + 1, length):
            x, y = begins + i, begins + j
            near = np.bitwise_count(low[x] ^ low[y]) + np.bitwise_count(high[x] ^ high[y]) <= radius
            a.append(x[near])
            b.append(y[near])
    return np.concatenate(a), np.concatenate(b)


#: Runs up to this length are compared together, by place in the run.
SMALL = 4


def node() -> Column:
    return F.xxhash64("low", "high")


def candidates(distinct: DataFrame, radius: int = RADIUS, bits: int = SEGMENT, step: int = STEP) -> DataFrame:
    """``a, b``: fingerprints (``node, low, high``) that meet in a segment and are ``radius`` apart or less, as structs of ``low, node``.

    Of each run a spanning forest, in which ``a`` claims ``b``.  A row enters a bounded number of runs, so it is
    claimed a bounded number of times, whatever the size of its group; runs in order of their fingerprints share claimers.
    """

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                low, high = (part.column(n).to_numpy(zero_copy_only=False).view(np.uint64) for n in ("low", "high"))
                rows, runs = (np.concatenate(x) for x in zip(*entries(low, high, bits, step)))
                columns = [pa.array(runs.view(np.int64)), *(c.take(pa.array(rows)) for c in part.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=["run", *part.schema.names])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            part = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(part[0]):
                continue
            last = int(np.searchsorted(part[0], part[0][-1]))
            if last == 0 and (not held or held[-1][0][-1] == part[0][0]):
                held.append(part)  # one run goes on
                continue
            yield from linked(*(np.concatenate(x) for x in zip(*held, [c[:last] for c in part])))
            held = [[c[last:] for c in part]]
        if held:
            yield from linked(*(np.concatenate(x) for x in zip(*held)))

    def linked(run: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[pa.RecordBatch]:
        low, high = low.view(np.uint64), high.view(np.uint64)
        begins = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        lengths = np.diff(np.concatenate([begins, [len(run)]]))
        for length in range(2, SMALL + 1):
            yield pairs(low, high, *_small_runs(low, high, begins[lengths == length], length, radius))
        for k in np.flatnonzero(lengths > SMALL):
            own = slice(begins[k], begins[k] + lengths[k])
            yield pairs(low[own], high[own], *forest(low[own], high[own], radius))

    def pairs(low: np.ndarray, high: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(x.view(np.int64)) for x in (low[a], high[a], low[b], high[b])]
        return pa.RecordBatch.from_arrays(columns, names=["low", "high", "low2", "high2"])

    count = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = distinct.select("low", "high").mapInArrow(enter, "run long, low long, high long")
    found = table.repartition(count, "run").sortWithinPartitions("run", "low", "high").mapInArrow(find, "low long, high long, low2 long, high2 long")
    ends = [F.struct(F.col(low).alias("low"), F.xxhash64(low, high).alias("node")) for low, high in (("low", "high"), ("low2", "high2"))]
    return found.select(ends[0].alias("a"), ends[1].alias("b")).where("a <> b").distinct()


def claimed(pairs: DataFrame) -> DataFrame:
    """``b, claimers``: the different ``a`` of each ``b``."""
    return pairs.groupBy("b").agg(F.collect_set("a").alias("claimers"))


def contracted(claims: DataFrame) -> DataFrame:
    """``a, b``: links of nodes, not candidates all of them, that connect what ``claims`` (``b, claimers``) connect.

    A row and its claimers all go to the least of them, twice over.  Many rows share that one, so far fewer
    links than claims remain, and no join is needed for it.
    """
    for again in (True, False):
        star = F.array_append("claimers", F.col("b"))
        links = claims.select(F.array_min(star).alias("a"), F.explode(star).alias("b")).where("a <> b").distinct()
        claims = claimed(links) if again else claims
    return links.select("a.node", F.col("b.node").alias("b")).toDF("a", "b")


def branches(claims: DataFrame) -> DataFrame:
    """``a, b``: nodes of the candidates in ``claims`` that join each row to its first and to its last claimer."""
    ends = F.array_distinct(F.array(F.array_min("claimers"), F.array_max("claimers")))
    return claims.select(F.explode(ends).alias("a"), "b").select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def shingle_sets(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """``node, grams``: the different shingles of each text (``node, text``) as sorted hashes."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            grams = [np.unique(shingle_hashes(t.lower().split(), size)).view(np.int64) for t in texts(batch)]
            columns = [batch.column("node"), pa.array(grams, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "grams"])

    return rows.mapInArrow(compute, "node long, grams array<long>")


def checked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a, b, same``: whether the shingle sets (``node, grams``) of two nodes are that similar."""
    second = sets.select(F.col("node").alias("b"), F.col("grams").alias("grams2"))
    first = sets.select(F.col("node").alias("a"), "grams")
    common = F.size(F.array_intersect("grams", "grams2"))
    met = pairs.join(second, "b").join(first, "a").select("a", "b", common.alias("common"), (F.size("grams") + F.size("grams2")).alias("sizes"))
    return met.select("a", "b", (F.col("common") >= F.lit(similarity) * (F.col("sizes") - F.col("common"))).alias("same"))


def meets(low: np.ndarray, high: np.ndarray, low2: np.uint64, high2: np.uint64, bits: int, step: int) -> np.ndarray:
    """Which fingerprints share an entry of some segment with the one given."""
    met = np.zeros(len(low), dtype=bool)
    for offset in range(0, 128, step):
        own, other = segment_of(low, high, offset, bits), segment_of(low2, high2, offset, bits)
        met |= (np.bitwise_count(own & ~other) <= 1) & (np.bitwise_count(other & ~own) <= 1)
    return met


#: Bytes of shingle sets in a block, about; a group of two blocks meets in one task.
BLOCK = 8 << 20


def joining(
    members: DataFrame, similarity: float, radius: int = RADIUS, bits: int = SEGMENT, step: int = STEP, block: int = BLOCK
) -> DataFrame:
    """``a, b``: links that join the labels of a tree as all of its similar candidates do.

    ``members`` are ``node, low, high, root, label, grams``, one row per node, ``root`` naming the tree.
    A tree is dealt into blocks by hash and each two blocks meet, so rows grow
    with the size of a tree only beyond a block.
    """
    weight = F.sum(8 * F.size("grams") + 64)
    sizes = members.groupBy("root").agg(F.ceil(weight / block).cast("int").alias("blocks"))
    dealt = members.join(sizes, "root").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = spread.withColumns({"first": F.least("own", "other"), "second": F.greatest("own", "other")})

    def link(group: pa.Table) -> pa.Table:
        column = lambda name: group.column(name).combine_chunks().to_numpy(zero_copy_only=False)
        node, own, (low, high) = column("node"), column("own"), (column(n).view(np.uint64) for n in ("low", "high"))
        label = np.unique(column("label"), return_inverse=True)[1]
        grams = group.column("grams").combine_chunks()
        grams = grams.combine_chunks() if isinstance(grams, pa.ChunkedArray) else grams
        sizes = np.diff(grams.offsets.to_numpy())
        words, codes = np.unique(grams.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        between = group.column("first")[0] != group.column("second")[0]
        held = np.zeros(len(words), dtype=bool)
        a, b = [], []
        for head in range(len(node) - 1):
            apart = np.bitwise_count(low[head + 1 :] ^ low[head]) + np.bitwise_count(high[head + 1 :] ^ high[head])
            near = np.flatnonzero((apart <= radius) & (label[head + 1 :] != label[head])) + head + 1
            if between:
                near = near[own[near] != own[head]]
            near = near[meets(low[near], high[near], low[head], high[head], bits, step)]
            if not len(near):
                continue
            held[codes[starts[head] : starts[head + 1]]] = True
            for k in near:
                if label[k] == label[head]:
                    continue  # joined by a link just found
                common = np.count_nonzero(held[codes[starts[k] : starts[k + 1]]])
                if common >= similarity * (sizes[head] + sizes[k] - common):
                    a.append(node[head])
                    b.append(node[k])
                    label[label == label[k]] = label[head]
            held[codes[starts[head] : starts[head + 1]]] = False
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return met.groupBy("root", "first", "second").applyInArrow(link, "a long, b long")


def wide_links(
    distinct: DataFrame, docs: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, size: int = SIZE, bits: int = SEGMENT, step: int = STEP
) -> DataFrame:
    """``a, b``: links between nodes (``node, low, high, least``) that keep each group of similar candidates connected."""

    def sets_of(nodes: DataFrame) -> DataFrame:
        named = distinct.join(nodes, "node", "left_semi").select("node", F.col("least.key").alias("key"))
        rows = docs.select(row_key().alias("key"), "text").join(named, "key")
        one = rows.groupBy("node").agg(F.any_value("text").alias("text"))
        return written(shingle_sets(one, size), "wide-sets")

    claims = written(claimed(candidates(distinct, radius, bits, step)), "wide-claims")
    trees = components(contracted(claims))
    sets = sets_of(trees.select("node"))
    links = written(checked(branches(claims), sets, similarity).where("same").select("a", "b"), "wide-judged")
    group = components(links).withColumnRenamed("root", "label")
    members = trees.join(group, "node", "left").select("node", "root", F.coalesce("label", "node").alias("label"))
    parted = members.groupBy("root").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    again = members.join(parted, "root", "left_semi").join(distinct.select("node", "low", "high"), "node").join(sets, "node")
    return written(links.union(joining(again, similarity, radius, bits, step)), "wide-links")


def grouped(
    docs: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, size: int = SIZE, bits: int = SEGMENT, step: int = STEP
) -> DataFrame:
    """``doc_id, key, first``: every row with the first document (``doc_id, key``) of its group.

    Links join into groups over shared members.  Missing and blank texts have
    no shingles and form one group, as do texts of equal fingerprints; texts of fewer words than a shingle are
    compared whole.  Repeated rows share a key.  An empty table gives no rows.
    """
    prints = written(wide_fingerprints(docs, size), "wide-prints")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    distinct = written(prints.groupBy("low", "high").agg(F.min(rank).alias("least")).withColumn("node", node()), "wide-distinct")
    roots = components(wide_links(distinct, docs, similarity, radius, size, bits, step))
    labelled = distinct.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = labelled.groupBy("root").agg(F.min("least").alias("first"))
    first_of = labelled.join(firsts, "root").select("node", "first")
    return prints.withColumn("node", node()).join(first_of, "node").select("doc_id", "key", "first")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of near copies, the one with the smallest id.

    Rows that repeat its id and text are the same document; the least of them by
    the JSON text of the other columns stays, whatever their names and types.
    """
    kept = grouped(docs, **options).select(F.col("first.key").alias("__key")).distinct()
    others = [column for name, column in zip(docs.columns, every_column(docs)) if name not in ("doc_id", "text")]
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    rows = docs.select(row_key().alias("__key"), F.struct(*every_column(docs)).alias("__row"), order.alias("__order"))
    chosen = rows.join(kept, "__key", "left_semi").groupBy("__key").agg(F.min_by("__row", "__order").alias("__row"))
    return chosen.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns])
