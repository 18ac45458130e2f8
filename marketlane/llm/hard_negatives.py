"""Hard negatives by threshold joins over an inverted index (in the manner of L2AP).

Components become whole numbers, so every score is exact.  Two joins run, each with
a threshold that is lowered until the windows it serves are full:

* positives: per anchor one window, the best rows of its label;
* negatives: per anchor and positive one window, from half the positive's score to
  95 % of it, over rows of other labels.

One join at one threshold: dimensions are ordered by falling energy, and a row is
indexed only in its leading dimensions, up to where the length of its remaining
suffix, times the longest suffix of an anchor relative to the anchor's threshold,
can no longer reach that threshold.  Rows of a block stand in falling order of their
indexed length, so the postings of a dimension are a leading run of rows.  Partial
scores are accumulated over groups of dimensions; after each, pairs whose partial
score and remaining lengths stay below the threshold, or that can't enter a full
window any more, are dropped.

Anchors and rows meet in a grid of cells, each of a bounded number of both, dealt by
hash: neither a common label nor a repeated vector makes a larger cell.  A task gives
at most the wanted number of rows per window and cell.  Anchors whose windows are full
leave; the others come again with a lower threshold, down to the window's own floor,
where nothing can be missing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlane.llm.common import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: Bytes of the anchors, and of the rows, of one cell; rows of a cell where the data are small.
CELL_BYTES = 8 << 20
LEAST_CELL = 2_048
#: Rows and anchors of one tile of partial scores.
TILE = 512
#: Dimensions whose postings are added before pairs are pruned.
STEP = 8
#: Thresholds tried one after the other: shares of the greatest score an anchor can have, and of a positive's score.
POSITIVE_SHARES = (0.5, 0.25, 0.125, 0.0)
NEGATIVE_SHARES = (0.85, 0.65, 0.5)
#: Whole components beyond this could leave the range of a long when multiplied and added.
LIMIT = 1 << 24

WINDOW = "array<struct<w:int,lo:long,hi:long,t:long>>"


def whole_rows(vectors: DataFrame, label: Column | None = None) -> DataFrame:
    """``vec_id, label, v, norm, row``: rows that take part, each distinct one once, with whole components."""
    v = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * SCALE))
    entry = F.col("embedding").cast("array<double>")
    bad = F.exists(entry, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * SCALE) >= LIMIT))
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"), "embedding")
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
        .where(~bad)
        .select("vec_id", "label", v.cast("array<int>").alias("v"))
        .distinct()
    )
    square = F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x)
    return rows.select("*", F.sqrt(square).alias("norm"), F.size("v").alias("width"), F.xxhash64("vec_id", "label", "v").alias("row"))


def relabelled(step: int = 7, labels: int = 10) -> Column:
    """The label, moved on by one where the id is divisible by ``step``."""
    label = F.col("label").cast("long")
    return F.when(F.col("vec_id") % step == 0, (label + 1) % labels).otherwise(label)


def dimension_order(rows: DataFrame, width: int) -> np.ndarray:
    """Dimensions by falling energy over all rows (ties by number): suffixes get short early."""
    energy = (
        rows.where(F.col("width") == width)
        .select(F.posexplode("v").alias("d", "x"))
        .groupBy("d")
        .agg(F.sum(F.col("x").cast("double") * F.col("x")).alias("e"))
        .collect()
    )
    size = {r["d"]: r["e"] for r in energy}
    return np.array(sorted(range(width), key=lambda d: (-size.get(d, 0.0), d)), dtype=np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _suffixes(matrix: np.ndarray, cuts: list[int]) -> np.ndarray:
    """Length of each row from each cut on, a little too long rather than too short."""
    tails = np.cumsum((matrix[:, ::-1].astype(np.float64)) ** 2, axis=1)[:, ::-1]
    tails = np.concatenate([tails, np.zeros((len(matrix), 1))], axis=1)
    return np.sqrt(tails[:, cuts]) * (1 + 1e-12)


class Windows:
    """Windows of one set of anchors, flat: ``lo <= score <= hi``, the best ``k`` held of each."""

    def __init__(self, anchor: np.ndarray, number: np.ndarray, lo: np.ndarray, hi: np.ndarray, t: np.ndarray, anchors: int, k: int):
        self.anchor, self.number, self.lo, self.hi, self.t, self.k = anchor, number, lo, hi, t, k
        self.score = np.full((len(anchor), k), np.iinfo(np.int64).min)
        self.id = np.zeros((len(anchor), k), dtype=np.int64)
        self.held = np.zeros(len(anchor), dtype=np.int64)
        self.least = np.full(anchors, np.iinfo(np.int64).max)
        np.minimum.at(self.least, anchor, t)
        most = np.bincount(anchor, minlength=anchors).max(initial=0)
        self.of = np.full((anchors, most), -1, dtype=np.int64)  # windows of each anchor
        rank = np.zeros(anchors, dtype=np.int64)
        for w, a in enumerate(anchor.tolist()):
            self.of[a, rank[a]] = w
            rank[a] += 1

    def floors(self) -> np.ndarray:
        """Score a pair must reach to enter some window of each anchor."""
        kth = self.score[:, -1]
        need = np.where(self.held >= self.k, np.maximum(self.t, kth), self.t)
        out = np.full(len(self.least), np.iinfo(np.int64).max)
        np.minimum.at(out, self.anchor, need)
        return out

    def offer(self, anchor: np.ndarray, ids: np.ndarray, score: np.ndarray):
        """Pairs of one tile, each pair once."""
        for slot in range(self.of.shape[1]):
            w = self.of[anchor, slot]
            ok = w >= 0
            ok[ok] = (score[ok] >= self.t[w[ok]]) & (score[ok] <= self.hi[w[ok]])
            full = self.held[w] >= self.k
            last = self.score[w, -1]
            ok &= ~full | (score > last) | ((score == last) & (ids < self.id[w, -1]))
            if not ok.any():
                continue
            w, i, s = w[ok], ids[ok], score[ok]
            touched = np.unique(w)
            have = np.arange(self.k)[None, :] < self.held[touched][:, None]
            w = np.concatenate([w, np.repeat(touched, self.held[touched])])
            i = np.concatenate([i, self.id[touched][have]])
            s = np.concatenate([s, self.score[touched][have]])
            order = np.lexsort((i, -s, w))
            w, i, s = w[order], i[order], s[order]
            first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            rank = np.arange(len(w)) - np.repeat(first, np.diff(np.r_[first, len(w)]))
            best = rank < self.k
            self.score[w[best], rank[best]], self.id[w[best], rank[best]] = s[best], i[best]
            self.held[touched] = np.minimum(self.k, np.bincount(np.searchsorted(touched, w), minlength=len(touched)))


def threshold_join(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, windows: Windows):
    """Offer the windows every pair that may enter them.  Dimensions of both sides are in index order.

    Pairs of one id take no part.  Partial scores are whole numbers below 2^53, so they are exact.
    """
    width = q.shape[1]
    if not len(q) or not len(x) or not width:
        return
    exact = np.float64
    if float(np.abs(q).max()) * float(np.abs(x).max()) * width >= 2.0**53:
        exact = np.int64
    cuts = list(range(0, width, STEP)) + [width]
    q_tail, x_tail = _suffixes(q, cuts), _suffixes(x, cuts)
    # an anchor's suffix relative to its threshold; a threshold of 0 or less indexes all dimensions
    t = windows.least.astype(np.float64)
    reach = np.where(t[:, None] > 0, q_tail / np.where(t > 0, t, 1.0)[:, None], np.inf).max(axis=0)
    reach[-1] = 0.0
    with np.errstate(invalid="ignore"):
        covered = np.nan_to_num(x_tail * reach[None, :], nan=np.inf) < 1.0
    covered[:, -1] = True
    indexed = covered.argmax(axis=1)  # groups of dimensions that stay in the index; none if no score can reach
    order = np.lexsort((x_ids, -indexed))
    x, x_ids, x_tail, indexed = x[order], x_ids[order], x_tail[order], indexed[order]
    listed = int((indexed > 0).sum())
    q, x = q.astype(exact), x.astype(exact)
    for a in range(0, len(q), TILE):
        own = slice(a, a + TILE)
        for b in range(0, listed, 8 * TILE):
            end = min(listed, b + 8 * TILE)
            floor = windows.floors()[own].astype(np.float64)
            rows, part = np.arange(b, end), np.zeros((len(q[own]), end - b), dtype=exact)
            alive = np.flatnonzero(np.ones(len(q[own]), dtype=bool))
            for g in range(len(cuts) - 1):
                dims = slice(cuts[g], cuts[g + 1])
                upto = int((indexed[rows] > g).sum())  # postings of these dimensions: a leading run of rows
                if upto == 0:
                    break
                part[:, :upto] += q[own][alive][:, dims] @ x[rows[:upto], dims].T
                # a row whose index ends before this group still has its tail from there
                done = np.minimum(indexed[rows], g + 1)
                bound = q_tail[own][alive][:, done]
                bound *= x_tail[rows, done][None, :]
                bound += part
                keep = bound >= floor[alive][:, None]
                some, which = keep.any(axis=1), keep.any(axis=0)
                if not some.any():
                    part = part[:0]
                    break
                if some.mean() < 0.7 or which.mean() < 0.7:
                    alive, rows, part, keep = alive[some], rows[which], part[np.ix_(some, which)], keep[np.ix_(some, which)]
                if keep.mean() < 0.02:
                    break
            if not len(part):
                continue
            i, j = np.nonzero(keep)
            sums, whole = part[i, j], (indexed[rows] == len(cuts) - 1) & (g == len(cuts) - 2)
            whole = whole[j]
            i, j = alive[i] + a, rows[j]
            for c in range(0, len(i), 1 << 16):
                ii, jj, score, rest = (z[c : c + (1 << 16)] for z in (i, j, sums, ~whole))
                score[rest] = np.einsum("nd,nd->n", q[ii[rest]], x[jj[rest]])
                score = score.astype(np.int64)
                ok = (score >= windows.least[ii]) & (q_ids[ii] != x_ids[jj])
                windows.offer(ii[ok], x_ids[jj[ok]], score[ok])


def _groups(count: int, width: int) -> int:
    """Groups of a side, none above ``CELL_BYTES`` on average."""
    return max(1, -(-count * 4 * width // CELL_BYTES))


def _join(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, order: np.ndarray, k: int, same_label: bool) -> DataFrame:
    """``anchor, w, vec_id, score, label``: the best ``k`` of every window, merged over the cells."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = len(order)
    high = _groups(n_anchors, width)
    wide = max(_groups(n_rows, width), min(-(-n_rows // LEAST_CELL), tasks))  # work for every task where there is enough
    up, across = F.pmod(F.col("row"), F.lit(high)), F.pmod(F.xxhash64("row"), F.lit(wide))
    left = anchors.select("row", "vec_id", "label", "v", "wins", (up * wide).alias("base")).select(
        "row", "vec_id", "label", "v", "wins", F.explode(F.sequence(F.lit(0), F.lit(wide - 1))).alias("c"), "base"
    )
    left = left.select((F.col("base") + F.col("c")).alias("cell"), "row", "vec_id", "label", "v", "wins")
    right = rows.select("vec_id", "label", "v", across.alias("c")).select(
        "vec_id", "label", "v", "c", F.explode(F.sequence(F.lit(0), F.lit(high - 1))).alias("g")
    )
    right = right.select((F.col("g") * wide + F.col("c")).alias("cell"), "vec_id", "label", "v")

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        out = []
        if left.num_rows and right.num_rows:
            one = lambda t, n: t.column(n).chunk(0)
            number = lambda t, n: one(t, n).to_numpy(zero_copy_only=False)
            q, x = _matrix(one(left, "v"), width)[:, order], _matrix(one(right, "v"), width)[:, order]
            wins, (key_, q_id, q_label) = one(left, "wins"), (number(left, n) for n in ("row", "vec_id", "label"))
            x_id, x_label = number(right, "vec_id"), number(right, "label")
            owner = np.repeat(np.arange(len(q)), wins.value_lengths().to_numpy(zero_copy_only=False))
            flat = {f: wins.flatten().field(f).to_numpy(zero_copy_only=False) for f in ("w", "lo", "hi", "t")}
            for name in np.unique(q_label):
                mine = np.flatnonzero(q_label == name)
                others = np.flatnonzero((x_label == name) == same_label)
                place = np.full(len(q), -1)
                place[mine] = np.arange(len(mine))
                has = place[owner] >= 0
                own = Windows(place[owner][has], *(flat[f][has] for f in ("w", "lo", "hi", "t")), len(mine), k)
                threshold_join(q[mine], q_id[mine], x[others], x_id[others], own)
                w, r = np.nonzero(np.arange(k)[None, :] < own.held[:, None])
                out.append((key_[mine][own.anchor[w]], own.number[w], own.id[w, r], own.score[w, r]))
        parts = [np.concatenate(c) if out else np.empty(0, dtype=np.int64) for c in (zip(*out) if out else [[]] * 4)]
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(p, t) for p, t in zip(parts, types)], names=["anchor", "w", "id", "score"])

    found = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(meet, "anchor long, w int, id long, score long")
    best = Window.partitionBy("anchor", "w").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _fill(anchors: DataFrame, rows: DataFrame, n_rows: int, order: np.ndarray, k: int, same_label: bool, shares, top: Column) -> DataFrame:
    """``anchor, w, id, score, rank`` of every window, by joins at falling thresholds.

    ``anchors`` has ``row, vec_id, label, v, w, lo, hi``, one row per window;
    ``top`` is the score of which the shares are taken.
    """
    done: DataFrame | None = None
    opened = anchors
    for n, share in enumerate(shares):
        least = F.greatest("lo", F.ceil(top * share)) if share else F.col("lo")
        asked = opened.withColumn("t", F.col("lo") if n == len(shares) - 1 else least.cast("long"))
        packed = asked.groupBy("row").agg(
            *(F.first(c).alias(c) for c in ("vec_id", "label", "v")), F.collect_list(F.struct("w", "lo", "hi", "t")).cast(WINDOW).alias("wins")
        )
        packed = written(packed, "negatives-anchors")
        n_anchors = packed.count()
        if not n_anchors:
            break
        found = written(_join(packed, rows, n_anchors, n_rows, order, k, same_label), "negatives-found")
        full = found.groupBy("anchor", "w").agg(F.count("*").alias("held"))
        state = asked.join(full.withColumnRenamed("anchor", "row"), ["row", "w"], "left")
        closed = (F.coalesce("held", F.lit(0)) >= k) | (F.col("t") <= F.col("lo"))
        shut = state.where(closed).select(F.col("row").alias("anchor"), "w")
        ready = found.join(shut, ["anchor", "w"], "left_semi").select("anchor", "w", "id", "score", "rank")
        done = ready if done is None else done.unionByName(ready)
        opened = written(state.where(~closed).drop("held", "t"), "negatives-open")
    if done is None:
        done = rows.sparkSession.createDataFrame([], "anchor long, w int, id long, score long, rank int")
    return done


def mine(vectors: DataFrame, anchor_step: int, label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor and positive.

    ``vectors`` has ``vec_id, embedding, label``; other columns are ignored.  Anchors are
    rows whose id is divisible by ``anchor_step``.  Positives are an anchor's best rows of
    its own label; negatives its best rows of other labels between 50 % and 95 % of the
    positive's score.  Higher scores come first, ties by smaller id.

    Missing ids, labels and vectors, missing, NaN and infinite components and components
    whose whole number leaves +-2^24 take their row out.  Equal rows count once; rows that
    share an id but not their vector or label each take part, but never as each other's
    partner.  Only vectors of the commonest width are compared (ties: the wider).  Positives
    with a negative score have an empty window.  An empty table gives no rows.
    """
    rows = written(whole_rows(vectors, label), "negatives-rows")
    widths = sorted(((r["n"], r["width"]) for r in rows.groupBy("width").agg(F.count("*").alias("n")).collect()), reverse=True)
    if not widths or not widths[0][1]:
        return rows.sparkSession.createDataFrame([], RESULT)
    n_rows, width = widths[0]
    rows = rows.where(F.col("width") == width)
    order = dimension_order(rows, width)
    longest = rows.agg(F.max("norm")).first()[0]
    anchors = rows.where(F.col("vec_id") % anchor_step == 0).select("row", "vec_id", "label", "v", "norm")
    # a positive below 0 has no window, so scores below 0 are never needed
    first = anchors.select("*", F.lit(0).alias("w"), F.lit(0).cast("long").alias("lo"), F.lit((1 << 62)).cast("long").alias("hi"))
    near = written(_fill(first, rows, n_rows, order, positives, True, POSITIVE_SHARES, F.col("norm") * longest), "negatives-positives")
    windows = near.select(
        F.col("anchor").alias("row"),
        F.col("rank").alias("w"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
        F.expr("(score + 1) div 2").alias("lo"),
        F.expr("(score * 19) div 20").alias("hi"),
    ).where("lo <= hi")
    asked = windows.join(anchors.drop("norm"), "row")
    far = _fill(asked.drop("positive_id"), rows, n_rows, order, negatives, False, NEGATIVE_SHARES, F.col("positive_score"))
    return far.withColumnsRenamed({"anchor": "row", "id": "negative_id", "score": "negative_score"}).join(
        asked.select("row", "w", F.col("vec_id").alias("anchor_id"), "positive_id", "positive_score"), ["row", "w"]
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
